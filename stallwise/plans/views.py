"""The three datasets a dashboard reads."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallwise import fixed_values as V
from stallwise.functions import bands
from stallwise.functions.numeric import exact_mean, exact_share, half_up, mean_rating
from stallwise.operators import segments as G


def listings_enriched(listings: DataFrame) -> DataFrame:
    """Renamed listing columns with their bands; narrow.

    `restaurant_id` is there when the listings carry ids.
    """
    cost, rating = F.col("cost_for_two"), F.col("rating")
    ids = [F.col("id").alias("restaurant_id")] if "id" in listings.columns else []
    return listings.select(
        *ids,
        "restaurant_name",
        F.col("location").alias("city"),
        "area",
        F.col("cuisine").alias("all_cuisines"),
        "primary_cuisine",
        "cuisine_count",
        "rating",
        "rating_status",
        F.coalesce("rating_count", F.lit(0.0)).alias("review_count"),
        "cost_for_two",
        "is_pure_veg",
        "offer_count",
        "offer_name",
        bands.tier(cost, V.VIEW_PRICE_TIERS).alias("price_tier"),
        bands.tier(cost, V.VIEW_PRICE_TIERS, ranks=True).alias("price_tier_sort"),
        bands.rating_tier(rating).alias("rating_tier"),
        bands.rating_tier(rating, ranks=True).alias("rating_tier_sort"),
        bands.tier(F.col("cuisine_count"), V.VIEW_KITCHEN_MODELS).alias("kitchen_model"),
        bands.tier(F.col("offer_count"), V.VIEW_PROMO_TIERS).alias("promotional_tier"),
        F.when(F.col("is_pure_veg"), V.VEG_LABEL).otherwise(V.NON_VEG_LABEL).alias("veg_category"),
    )


def city_summary(listings: DataFrame) -> DataFrame:
    veg, unrated = F.col("is_pure_veg"), F.col("rating").isNull()
    reviews = F.coalesce(F.sum("rating_count"), F.lit(0.0))
    return listings.groupBy(F.col("location").alias("city")).agg(
        F.count("*").alias("total_restaurants"),
        mean_rating(F.col("rating"), 2).alias("avg_rating"),
        exact_mean("cost_for_two", 0).alias("avg_cost_for_two"),
        F.count_if(veg).alias("pure_veg_count"),
        exact_share(veg, 1).alias("veg_percentage"),
        F.count_if(unrated).alias("unrated_count"),
        exact_share(unrated, 1).alias("unrated_percentage"),
        half_up(reviews, F.lit(1), 0, unit=3).alias("total_reviews_volume"),
        F.countDistinct("primary_cuisine").alias("unique_cuisines_count"),
    )


def cuisine_matrix(listings: DataFrame, min_listings: int = V.CUISINE_MATRIX_MIN_LISTINGS) -> DataFrame:
    """Cuisines with enough listings; the market share is of all listings."""
    heavy = F.col("offer_count") >= V.HEAVY_DISCOUNT_OFFERS
    cuisines = listings.groupBy("primary_cuisine").agg(
        F.count("*").alias("total_outlets"),
        exact_mean("cost_for_two", 0).alias("avg_cost"),
        mean_rating(F.col("rating"), 2).alias("avg_rating"),
        F.coalesce(exact_mean("rating_count", 0, unit=3), F.lit(0.0)).alias("avg_review_count"),
        F.count_if(heavy).alias("heavy_discount_outlets"),
        exact_share(heavy, 1).alias("discount_reliance_pct"),
        exact_share(F.col("is_pure_veg"), 1).alias("veg_share_pct"),
    )
    large = cuisines.filter(F.col("total_outlets") >= min_listings)
    return G.with_exact_share(large, listings, "total_outlets", "market_share_pct", 2)
