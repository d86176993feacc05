"""The fifteen business reports over the warehouse table.

Each takes the listings and the thresholds it uses. Sorts end with the key, so
a limit always cuts at the same row.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallwise import fixed_values as V
from stallwise.functions import bands
from stallwise.functions.numeric import exact_mean, exact_share, half_up, mean_rating, rating_total
from stallwise.operators import ranking as R
from stallwise.operators import segments as G


def _rated(listings: DataFrame) -> DataFrame:
    return listings.filter(F.col("rating").isNotNull())


def _mean_rating(name: str, rating: Column | None = None) -> Column:
    return mean_rating(F.col("rating") if rating is None else rating, 2).alias(name)


def _mean_cost(name: str) -> Column:
    return exact_mean("cost_for_two", 0).alias(name)


def _mean_reviews(name: str) -> Column:
    return exact_mean("rating_count", 0, unit=3).alias(name)


def _mean_offers(name: str) -> Column:
    return exact_mean("offer_count", 1).alias(name)


def _rows(name: str) -> Column:
    return F.count("*").alias(name)


def q01_city_share(listings: DataFrame, top: int = V.REPORT_TOP) -> DataFrame:
    """Largest cities with their share of all listings and their rank."""
    counts = listings.groupBy("location").agg(_rows("restaurant_count"))
    shared = G.with_exact_share(counts, listings, "restaurant_count", "pct_market_share", 2)
    largest = R.top_k(shared, top, F.desc("restaurant_count"), F.asc("location"))
    ranked = R.dense_rank_of_top(largest, F.desc("restaurant_count"), "city_rank")
    return ranked.orderBy(F.asc("city_rank"), F.asc("location"))


def q02_veg_penetration(
    listings: DataFrame, min_listings: int = V.CITY_MIN_LISTINGS, top: int = V.REPORT_TOP
) -> DataFrame:
    """Pure-veg share by city, and mean ratings on both sides."""
    veg, rating = F.col("is_pure_veg"), F.col("rating")
    cities = listings.groupBy("location").agg(
        _rows("total_restaurants"),
        F.count_if(veg).alias("pure_veg_count"),
        exact_share(veg, 1).alias("veg_percentage"),
        _mean_rating("avg_veg_rating", F.when(veg, rating)),
        _mean_rating("avg_nonveg_rating", F.when(~veg, rating)),
    )
    large = cities.filter(F.col("total_restaurants") >= min_listings)
    return R.top_k(large, top, F.desc("veg_percentage"), F.asc("location"))


def q03_city_top_cuisine(listings: DataFrame, cities: Sequence[str] = V.MAJOR_CITIES) -> DataFrame:
    """The leading cuisine of each named city and its share of the city."""
    # The share and the rank stay inside a city, so other cities are left out
    # before anything is counted.
    named = listings.filter(F.col("location").isin(*cities))
    counts = named.groupBy("location", "primary_cuisine").agg(_rows("outlet_count"))
    leaders = R.leader_per_group(counts, "location", "primary_cuisine", "outlet_count")
    share = half_up(F.col("outlet_count") * 100, F.col("group_total"), 1)
    shown = leaders.select(
        "location",
        F.col("primary_cuisine").alias("top_cuisine"),
        "outlet_count",
        share.alias("market_share_percentage"),
    )
    return shown.orderBy(F.desc("outlet_count"), F.asc("location"))


def q04_cold_start(
    listings: DataFrame, min_listings: int = V.CITY_MIN_LISTINGS, top: int = V.REPORT_TOP
) -> DataFrame:
    """Cities with the highest share of unrated listings."""
    unrated = F.col("rating").isNull()
    cities = listings.groupBy("location").agg(
        _rows("total_listings"),
        F.count_if(unrated).alias("unrated_count"),
        exact_share(unrated, 1).alias("unrated_percentage"),
        F.count("rating").alias("rated_count"),
    )
    large = cities.filter(F.col("total_listings") >= min_listings)
    return R.top_k(large, top, F.desc("unrated_percentage"), F.asc("location"))


def q05_dominant_cuisines(listings: DataFrame, top: int = V.REPORT_TOP) -> DataFrame:
    """Most frequent cuisines with price, rating and offer means."""
    cuisines = listings.groupBy("primary_cuisine").agg(
        _rows("outlet_count"),
        _mean_cost("avg_cost_for_two"),
        _mean_rating("avg_rating"),
        _mean_offers("avg_offers"),
    )
    shared = G.with_exact_share(cuisines, listings, "outlet_count", "cuisine_share_pct", 2)
    return R.top_k(shared, top, F.desc("outlet_count"), F.asc("primary_cuisine"))


def q06_cuisine_prices(
    listings: DataFrame, min_listings: int = V.CUISINE_PRICE_MIN_LISTINGS, top: int = V.REPORT_TOP
) -> DataFrame:
    """Most expensive cuisines."""
    cuisines = listings.groupBy("primary_cuisine").agg(
        _rows("restaurant_count"),
        _mean_cost("avg_cost"),
        F.min("cost_for_two").alias("min_cost"),
        F.max("cost_for_two").alias("max_cost"),
        _mean_rating("avg_rating"),
    )
    large = cuisines.filter(F.col("restaurant_count") >= min_listings)
    return R.top_k(large, top, F.desc("avg_cost"), F.asc("primary_cuisine"))


def q07_menu_models(listings: DataFrame) -> DataFrame:
    """Specialists against wider menus, rated listings only."""
    model = bands.tier(F.col("cuisine_count"), V.REPORT_MENU_MODELS)
    models = (
        _rated(listings)
        .groupBy(model.alias("restaurant_model"))
        .agg(
            _rows("total_restaurants"),
            _mean_rating("avg_rating"),
            _mean_cost("avg_cost"),
            _mean_reviews("avg_review_count"),
        )
    )
    return models.orderBy(F.asc("restaurant_model"))


def q08_rating_consistency(
    listings: DataFrame, min_listings: int = V.CUISINE_CONSISTENCY_MIN_LISTINGS, top: int = V.REPORT_TOP
) -> DataFrame:
    """Cuisines by mean rating and its spread, rated listings only."""
    cuisines = (
        _rated(listings)
        .groupBy("primary_cuisine")
        .agg(
            _rows("total_outlets"),
            _mean_rating("mean_rating"),
            F.round(F.stddev_samp("rating"), 2).alias("rating_std_dev"),
            F.min("rating").alias("min_rating"),
            F.max("rating").alias("max_rating"),
        )
    )
    large = cuisines.filter(F.col("total_outlets") >= min_listings)
    order = (F.desc("mean_rating"), F.asc_nulls_last("rating_std_dev"), F.asc("primary_cuisine"))
    return R.top_k(large, top, *order)


def q09_price_tiers(listings: DataFrame) -> DataFrame:
    """Ratings, reviews and offers by price tier, cheapest first, rated listings only."""
    tier = bands.tier(F.col("cost_for_two"), V.REPORT_PRICE_TIERS)
    tiers = (
        _rated(listings)
        .groupBy(tier.alias("price_tier"))
        .agg(
            _rows("total_restaurants"),
            _mean_rating("avg_rating"),
            _mean_reviews("avg_review_volume"),
            _mean_offers("avg_active_offers"),
            F.min("cost_for_two").alias("cheapest"),
        )
    )
    return tiers.orderBy(F.asc("cheapest")).drop("cheapest")


def q10_metro_top(
    listings: DataFrame,
    cities: Sequence[str] = V.METRO_CITIES,
    min_reviews: int = V.METRO_MIN_REVIEWS,
    top: int = V.METRO_TOP,
) -> DataFrame:
    """Best listings of each named city by dense rank; a missing rating ranks first."""
    columns = ["location", "restaurant_name", "primary_cuisine", "rating", "rating_count", "cost_for_two"]
    reviewed = listings.filter(F.col("location").isin(*cities) & (F.col("rating_count") >= min_reviews))
    best = R.top_dense_per_group(
        reviewed.select(*columns), "location", ["rating", "rating_count"], top, "city_rank", groups_are_few=True
    )
    # The further columns only spread a large group of ties over the sorting tasks.
    return best.orderBy("location", "city_rank", "restaurant_name", "primary_cuisine", "cost_for_two")


def q11_city_ticket_size(
    listings: DataFrame, min_listings: int = V.TICKET_CITY_MIN_LISTINGS, top: int = V.REPORT_TOP
) -> DataFrame:
    """Most expensive cities with ratings and review volume, rated listings only."""
    reviews_in_k = half_up(F.sum("rating_count"), F.lit(1000), 1, unit=3)
    cities = (
        _rated(listings)
        .groupBy("location")
        .agg(
            _rows("restaurant_count"),
            _mean_cost("avg_ticket_size"),
            _mean_rating("avg_city_rating"),
            reviews_in_k.alias("total_reviews_in_k"),
        )
    )
    large = cities.filter(F.col("restaurant_count") >= min_listings)
    return R.top_k(large, top, F.desc("avg_ticket_size"), F.asc("location"))


def q12_promotion_effect(listings: DataFrame) -> DataFrame:
    """Ratings, reviews and prices by number of offers, rated listings only."""
    tier = bands.tier(F.col("offer_count"), V.REPORT_PROMO_TIERS)
    tiers = (
        _rated(listings)
        .groupBy(tier.alias("promotional_activity"))
        .agg(
            _rows("restaurant_count"),
            _mean_rating("avg_rating"),
            _mean_reviews("avg_reviews_received"),
            _mean_cost("avg_price"),
            F.min("offer_count").alias("fewest"),
        )
    )
    return tiers.orderBy(F.asc("fewest")).drop("fewest")


def q13_discount_reliance(
    listings: DataFrame, min_listings: int = V.CUISINE_DISCOUNT_MIN_LISTINGS, top: int = V.REPORT_TOP
) -> DataFrame:
    """Cuisines with the highest share of heavily discounted listings."""
    heavy = F.col("offer_count") >= V.HEAVY_DISCOUNT_OFFERS
    cuisines = listings.groupBy("primary_cuisine").agg(
        _rows("total_outlets"),
        F.count_if(heavy).alias("heavy_discount_outlets"),
        exact_share(heavy, 1).alias("discount_reliance_pct"),
        _mean_cost("avg_cost"),
    )
    large = cuisines.filter(F.col("total_outlets") >= min_listings)
    return R.top_k(large, top, F.desc("discount_reliance_pct"), F.asc("primary_cuisine"))


def q14_quadrants(listings: DataFrame) -> DataFrame:
    """Rated listings in four quadrants around the mean rating and the mean cost."""
    rated = _rated(listings)
    means = rated.agg(
        rating_total(F.col("rating")).alias("rating_total"),
        F.sum("cost_for_two").alias("cost_total"),
        F.count("*").alias("rated_total"),
    )
    # Rating and cost have few values, so listings merge in each task before
    # they are compared with the means. Comparing products keeps ties exact.
    cells = rated.groupBy("rating", "cost_for_two").agg(
        F.count("*").alias("n"),
        F.sum("rating_count").alias("reviews"),
        F.count("rating_count").alias("reviewed"),
    )
    size = F.col("rated_total")
    group = bands.quadrant(
        F.col("rating") * size >= F.col("rating_total"), F.col("cost_for_two") * size < F.col("cost_total")
    )
    rows = F.sum("n")
    quadrants = (
        cells.crossJoin(F.broadcast(means))
        .groupBy(group.alias("strategic_quadrant"))
        .agg(
            rows.alias("restaurant_count"),
            half_up(rows * 100, F.max("rated_total"), 1).alias("pct_of_rated"),
            half_up(F.sum(F.col("rating") * F.col("n")), rows, 2, unit=1).alias("avg_rating"),
            half_up(F.sum(F.col("cost_for_two") * F.col("n")), rows, 0).alias("avg_cost_for_two"),
            half_up(F.sum("reviews"), F.sum("reviewed"), 0, unit=3).alias("avg_ratings_volume"),
        )
    )
    return quadrants.orderBy(F.asc("strategic_quadrant"))


def q15_national_chains(
    listings: DataFrame, min_cities: int = V.CHAIN_MIN_CITIES, top: int = V.REPORT_TOP
) -> DataFrame:
    """Names present in the most cities."""
    names = listings.groupBy("restaurant_name").agg(
        F.countDistinct("location").alias("cities_present"),
        _rows("total_outlets"),
        _mean_rating("avg_brand_rating"),
        _mean_cost("avg_brand_cost"),
        half_up(F.sum("rating_count"), F.lit(1), 0, unit=3).alias("total_customer_reviews"),
    )
    chains = names.filter(F.col("cities_present") >= min_cities)
    return R.top_k(chains, top, F.desc("cities_present"), F.desc("total_outlets"), F.asc("restaurant_name"))
