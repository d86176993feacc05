"""The city summary and the cuisine matrix, kept up to date by batches of changes.

The state holds one row per city and primary cuisine, with counts and exact sums.
All of it adds up, so inserts, deletes (negative) and revisions (both) are merged
without looking at other listings, and a cuisine stops counting for a city when
its last listing there goes. A batch of changes is summed in its tasks and after
one shuffle: a city with a third of all listings arrives as a few rows a task.

Each batch writes one part and a commit record; a batch whose name is committed
is not applied again. After `MERGE_AT` parts the next batch writes them merged,
so a reader sums few parts of a size that is bounded by cities times cuisines,
and never the listings.
"""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stallwise import fixed_values as V
from stallwise.functions.numeric import half_up
from stallwise.sources.commits import CommitLog

MERGE_AT = 8

KEYS = ("location", "primary_cuisine")
_SUMS = {
    "listings": "long",
    "rated": "long",
    "rating_tenths": "long",
    "priced": "long",
    "cost": "long",
    "veg": "long",
    "heavy": "long",
    "reviewed": "long",
    "reviews": "decimal(38,3)",
}
_LAYOUT = ", ".join([*(f"{key} string" for key in KEYS), *(f"{name} {kind}" for name, kind in _SUMS.items())])


def contributions(listings: DataFrame, sign: int = 1) -> DataFrame:
    """What each listing adds to the state, or takes from it with a negative sign."""
    rating, reviews = F.col("rating"), F.col("rating_count")
    values = {
        "listings": F.lit(1),
        "rated": rating.isNotNull().cast("long"),
        "rating_tenths": F.coalesce((rating.cast("decimal(8,1)") * 10).cast("long"), F.lit(0)),
        "priced": F.col("cost_for_two").isNotNull().cast("long"),
        "cost": F.coalesce(F.col("cost_for_two").cast("long"), F.lit(0)),
        "veg": F.coalesce(F.col("is_pure_veg"), F.lit(False)).cast("long"),
        "heavy": F.coalesce(F.col("offer_count") >= V.HEAVY_DISCOUNT_OFFERS, F.lit(False)).cast("long"),
        "reviewed": reviews.isNotNull().cast("long"),
        "reviews": F.coalesce(reviews.cast("decimal(32,3)"), F.lit(0)),
    }
    return listings.select(*KEYS, *[(sign * value).cast(_SUMS[name]).alias(name) for name, value in values.items()])


def summed(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(*[F.sum(name).cast(kind).alias(name) for name, kind in _SUMS.items()])


class ViewState:
    """The state below `root`."""

    def __init__(self, spark: SparkSession, root: str, merge_at: int = MERGE_AT) -> None:
        self.spark, self.log, self.merge_at = spark, CommitLog(spark, root), merge_at

    def _now(self) -> dict:
        return self.log.last() or {"number": 0, "parts": [], "batches": []}

    def _parts(self, parts: list[str]) -> DataFrame:
        if not parts:
            return self.spark.createDataFrame([], _LAYOUT)
        return self.spark.read.schema(_LAYOUT).parquet(*[f"{self.log.root}/parts/{part}" for part in parts])

    def apply(self, batch: str, inserted: DataFrame | None = None, deleted: DataFrame | None = None) -> bool:
        """Add listings and take listings away; False if the batch was applied before. A revision does both."""
        now = self._now()
        if batch in now["batches"]:
            return False
        changes = [contributions(rows, sign) for rows, sign in ((inserted, 1), (deleted, -1)) if rows is not None]
        rows, parts = self._parts([]), now["parts"]
        for change in changes:
            rows = rows.unionByName(change)
        if len(parts) >= self.merge_at:
            rows, parts = rows.unionByName(self._parts(parts)), []
        part = uuid.uuid4().hex
        some = " OR ".join(f"{name} <> 0" for name in _SUMS)
        summed(rows, *KEYS).filter(some).write.parquet(f"{self.log.root}/parts/{part}")
        number = now["number"] + 1
        while number in self.log.numbers() and self.log.read(number) is None:
            number += 1
        self.log.commit(number, {"number": number, "parts": [*parts, part], "batches": [*now["batches"], batch]})
        return True

    def cells(self) -> DataFrame:
        """One row per city and primary cuisine that has listings."""
        return summed(self._parts(self._now()["parts"]), *KEYS).filter("listings <> 0")

    def city_summary(self) -> DataFrame:
        """The rows of views.city_summary."""
        cells = self.cells()
        cities = summed(cells, "location").join(
            cells.groupBy(F.col("location").alias("city")).agg(F.count("primary_cuisine").alias("unique_cuisines_count")),
            F.col("location").eqNullSafe(F.col("city")),
        )
        listings, unrated = F.col("listings"), F.col("listings") - F.col("rated")
        return cities.select(
            F.col("location").alias("city"),
            listings.alias("total_restaurants"),
            half_up(F.col("rating_tenths"), F.col("rated") * 10, 2).alias("avg_rating"),
            half_up(F.col("cost"), F.col("priced"), 0).alias("avg_cost_for_two"),
            F.col("veg").alias("pure_veg_count"),
            half_up(F.col("veg") * 100, listings, 1).alias("veg_percentage"),
            unrated.alias("unrated_count"),
            half_up(unrated * 100, listings, 1).alias("unrated_percentage"),
            half_up(F.col("reviews"), F.lit(1), 0, unit=3).alias("total_reviews_volume"),
            "unique_cuisines_count",
        )

    def cuisine_matrix(self, min_listings: int = V.CUISINE_MATRIX_MIN_LISTINGS) -> DataFrame:
        """The rows of views.cuisine_matrix."""
        cells = self.cells()
        total = F.broadcast(cells.agg(F.sum("listings").alias("total_rows")))
        outlets = F.col("listings")
        return summed(cells, "primary_cuisine").filter(outlets >= min_listings).crossJoin(total).select(
            "primary_cuisine",
            outlets.alias("total_outlets"),
            half_up(outlets * 100, F.col("total_rows"), 2).alias("market_share_pct"),
            half_up(F.col("cost"), F.col("priced"), 0).alias("avg_cost"),
            half_up(F.col("rating_tenths"), F.col("rated") * 10, 2).alias("avg_rating"),
            F.coalesce(half_up(F.col("reviews"), F.col("reviewed"), 0, unit=3), F.lit(0.0)).alias("avg_review_count"),
            F.col("heavy").alias("heavy_discount_outlets"),
            half_up(F.col("heavy") * 100, outlets, 1).alias("discount_reliance_pct"),
            half_up(F.col("veg") * 100, outlets, 1).alias("veg_share_pct"),
        )
