"""Checks before and after cleaning, and the first figures of a loaded table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallwise import schema
from stallwise.functions.numeric import (
    exact_mean,
    exact_share,
    half_up,
    hundredths,
    mean_rating,
    rating_total,
    ratio,
    round_even,
)
from stallwise.operators import quality, stats
from stallwise.operators import segments as G


def row_counts(raw: DataFrame, clean: DataFrame) -> DataFrame:
    """Rows and columns before and after cleaning, which removes duplicates and nothing else."""
    return quality.shape(raw, "raw").unionAll(quality.shape(clean, "clean"))


def stored_row_counts(figures: DataFrame) -> DataFrame:
    """The same from a store's rows: each knows how many raw rows it stands for."""
    raw = figures.agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("row_count"))
    raw = raw.select(F.lit("raw").alias("stage"), "row_count", F.lit(len(schema.RAW.names)).alias("column_count"))
    return raw.unionAll(quality.shape(figures.select(*schema.CLEAN.names), "clean"))


def stored_duplicate_count(figures: DataFrame) -> DataFrame:
    return figures.agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicate_rows"))


def stored_price_corrections(figures: DataFrame) -> DataFrame:
    after = F.col("cost_for_two").cast("long").alias("price_after")
    return figures.filter("price_before IS NOT NULL").select("restaurant_name", "location", "price_before", after)


def stored_imputed_counts(figures: DataFrame) -> DataFrame:
    return figures.agg(F.count_if("no_area").alias("missing_area"), F.count_if("no_cuisine").alias("missing_cuisine"))


def stored_null_profile(figures: DataFrame) -> DataFrame:
    return quality.raw_null_profile(figures, schema.RAW, 2)


def status_distribution(clean: DataFrame) -> DataFrame:
    return G.value_counts(clean, "rating_status").orderBy(F.desc("n"), F.asc("rating_status"))


def veg_distribution(clean: DataFrame) -> DataFrame:
    return G.value_counts(clean, "is_pure_veg").orderBy(F.desc("n"), F.asc("is_pure_veg"))


def describe_cost(clean: DataFrame) -> DataFrame:
    return stats.describe(clean, F.col("cost_for_two").cast("long"), 1, 1)


def describe_rating(clean: DataFrame) -> DataFrame:
    return stats.describe(clean, hundredths(F.col("rating")), 100, 2)


def top_cuisines(listings: DataFrame, top: int = 5) -> DataFrame:
    return G.top_counts(listings, "primary_cuisine", top)


def top_locations(listings: DataFrame, top: int = 5) -> DataFrame:
    return G.top_counts(listings, "location", top)


def veg_mean_cost(clean: DataFrame) -> DataFrame:
    mean = round_even(ratio(F.sum("cost_for_two"), F.count("cost_for_two")), 2)
    return clean.groupBy("is_pure_veg").agg(mean.alias("avg_cost"))


def warehouse_kpis(listings: DataFrame) -> DataFrame:
    """Key figures of the loaded table."""
    veg = F.col("is_pure_veg")
    return listings.agg(
        exact_mean("cost_for_two", 1).alias("avg_cost"),
        mean_rating(F.col("rating"), 2).alias("avg_rating"),
        F.count_if(veg).alias("veg_count"),
        F.count("*").alias("total"),
        exact_share(veg, 1).alias("veg_pct"),
    )


def executive_kpis(listings: DataFrame) -> DataFrame:
    """Listings, mean and median cost, mean rating, reviews and veg share in one pass."""
    veg = F.col("is_pure_veg")
    cells = listings.groupBy("cost_for_two").agg(
        F.count("*").alias("n"),
        rating_total(F.col("rating")).alias("ratings"),
        F.count("rating").alias("rated"),
        F.sum("rating_count").alias("reviews"),
        F.count_if(veg).alias("veg"),
    )
    n = F.sum("n")
    return cells.agg(
        n.alias("outlets"),
        half_up(F.sum(F.col("cost_for_two") * F.col("n")), n, 2).alias("mean_cost"),
        stats.quantile("cost_for_two", 0.5).alias("median_cost"),
        half_up(F.sum("ratings"), F.sum("rated"), 2, unit=1).alias("mean_rating"),
        F.sum("reviews").alias("total_reviews"),
        F.sum("veg").alias("pure_veg"),
        half_up(F.sum("veg") * 100, n, 1).alias("veg_pct"),
    )
