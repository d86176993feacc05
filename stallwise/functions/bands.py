"""Band operators: values to labels, as chains of conditions."""

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stallwise import fixed_values as V


def _first_match(cases: list[tuple[Column, Column]], rest: Column | None) -> Column:
    (condition, value), *others = cases
    chain = reduce(lambda c, case: c.when(*case), others, F.when(condition, value))
    return chain if rest is None else chain.otherwise(rest)


def tier(value: Column, tiers, ranks: bool = False) -> Column:
    """Label (or 1-based rank) of the closed whole-number range that holds the value.

    The last tier takes every value no range holds, null included. Costs with
    decimals are not expected: ranges have gaps between whole numbers.
    """
    cases = []
    for position, (label, low, high) in enumerate(tiers[:-1], start=1):
        inside = value <= high if low is None else value.between(low, high)
        cases.append((inside, F.lit(position if ranks else label)))
    return _first_match(cases, F.lit(len(tiers) if ranks else tiers[-1][0]))


def rating_tier(rating: Column, ranks: bool = False) -> Column:
    """Label (or rank) of the enriched view's rating tier; null has a tier of its own."""
    cases = []
    for position, (label, low) in enumerate(V.VIEW_RATING_TIERS, start=1):
        inside = rating.isNotNull() if low is None else rating >= F.lit(low).cast("decimal(3,1)")
        cases.append((inside, F.lit(position if ranks else label)))
    rest = len(V.VIEW_RATING_TIERS) + 1 if ranks else V.VIEW_RATING_NONE
    return _first_match(cases, F.lit(rest))


def bin_order(value: Column, bins) -> Column:
    """1-based position of the right-closed bin; null outside all bins.

    (A left-closed bucketizer would move every value that lies on an edge.)
    """
    cases = [
        ((value > low) & (value <= high), F.lit(position))
        for position, (_, low, high) in enumerate(bins, start=1)
    ]
    return _first_match(cases, None)


def bin_frame(spark: SparkSession, bins) -> DataFrame:
    """One row per bin: bin_order, band. A handful of rows, fixed by the bin list."""
    labels = F.array(*[F.lit(label) for label, _, _ in bins])
    order = F.col("id").cast("int")
    return spark.range(1, len(bins) + 1, 1, 1).select(
        order.alias("bin_order"), F.element_at(labels, order).alias("band")
    )


def fill_bins(spark: SparkSession, bins, per_bin: DataFrame, counts: list[str]) -> DataFrame:
    """All bins in order with their row of `per_bin`; empty bins show 0 in `counts`.

    `per_bin` holds at most one row per bin, so it is safe to broadcast.
    """
    filled = bin_frame(spark, bins).join(F.broadcast(per_bin), "bin_order", "left")
    return filled.withColumns({c: F.coalesce(F.col(c), F.lit(0).cast("long")) for c in counts})


def quadrant(well_rated: Column, cheap: Column) -> Column:
    """Position in the 2x2 grid of rating against cost."""
    return (
        F.when(well_rated & cheap, V.QUADRANTS[True, True])
        .when(well_rated, V.QUADRANTS[True, False])
        .when(cheap, V.QUADRANTS[False, True])
        .otherwise(V.QUADRANTS[False, False])
    )
