"""Exact statistics from value counts.

Rows are first counted per distinct value, which merges in each task. What is
left is bounded by the value range (costs are at most 50,000, ratings have two
decimals), so exact quantiles and ranks stay cheap at any number of rows, and
their state does not depend on how many keys a task sees.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stallwise.functions.numeric import ratio, round_even

_WIDE = "decimal(38,0)"


def histogram(frame: DataFrame, *values: Column) -> DataFrame:
    """Rows per distinct combination, as column `n`; rows with a null are left out."""
    rows = frame.select(*values)
    # One condition per column, so that a later join on a column finds its own
    # condition already there and the counting is shared between branches.
    for name in rows.columns:
        rows = rows.filter(F.col(name).isNotNull())
    return rows.groupBy(*rows.columns).agg(F.count("*").alias("n"))


def quantile(value: Column | str, share: float, weight: str = "n") -> Column:
    """Exact quantile of counted values with linear interpolation, an aggregate."""
    return F.percentile(value, share, F.col(weight))


def mode_of(value: str, weight: str = "n") -> Column:
    """Most frequent counted value, the smallest on ties, an aggregate."""
    return F.min_by(value, F.struct(-F.col(weight), F.col(value)))


def moments(value: str, weight: str = "n") -> tuple[Column, Column, Column]:
    """Count, sum and sum of squares of counted whole numbers, as exact aggregates."""
    v, n = F.col(value).cast(_WIDE), F.col(weight).cast(_WIDE)
    return F.sum(n), F.sum(v * n), F.sum(v * v * n)


def summary(frame: DataFrame, value: Column, per_unit: int, places: int) -> DataFrame:
    """One row of statistics of a column that counts whole units of 1/per_unit.

    Columns: count, mean, std (sample), min, q1, median, q3, max, mode.
    """
    counts = histogram(frame, value.alias("v"))
    n, total, squares = moments("v")
    measured = counts.agg(
        n.alias("n"),
        total.alias("total"),
        squares.alias("squares"),
        F.min("v").alias("min"),
        quantile("v", 0.25).alias("q1"),
        quantile("v", 0.5).alias("median"),
        quantile("v", 0.75).alias("q3"),
        F.max("v").alias("max"),
        mode_of("v").alias("mode"),
    )
    size = F.col("n").cast("double")
    # n * sum of squares - square of sum, on whole numbers: nothing cancels.
    spread = (F.col("n") * F.col("squares") - F.col("total") * F.col("total")).cast("double")
    std = F.sqrt(F.try_divide(spread, size * (size - 1.0)))

    def shown(name: str, units: Column) -> Column:
        return round_even(units.cast("double") / float(per_unit), places).alias(name)

    return measured.select(
        F.coalesce("n", F.lit(0)).cast("long").alias("count"),
        shown("mean", ratio(F.col("total"), F.col("n"))),
        shown("std", std),
        *[shown(name, F.col(name)) for name in ("min", "q1", "median", "q3", "max", "mode")],
    )


def describe(frame: DataFrame, value: Column, per_unit: int, places: int) -> DataFrame:
    """Count, mean, std, min, quartiles and max as rows (statistic, value)."""
    names = {"count": "count", "mean": "mean", "std": "std", "min": "min",
             "q1": "25%", "median": "50%", "q3": "75%", "max": "max"}
    row = summary(frame, value, per_unit, places)
    wide = row.select(*[F.col(name).cast("double").alias(label) for name, label in names.items()])
    return wide.unpivot([], list(names.values()), "statistic", "value")


def average_ranks(counts: DataFrame, value: str, weight: str = "n", width: int = 1000) -> DataFrame:
    """Average-tie rank of each distinct whole number: columns value, `rank_value`.

    The rank is the number of rows below plus half the rows at the value. Rows
    below are added up in two steps: inside buckets of `width` neighbouring
    numbers, then over the bucket totals. So no window holds more than `width`
    rows, or one row per bucket.
    """
    per_value = counts.groupBy(value).agg(F.sum(weight).alias("at"))
    bucket = F.floor(F.col(value) / width).alias("bucket")
    bucketed = per_value.select("*", bucket)
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = bucketed.groupBy("bucket").agg(F.sum("at").alias("bucket_rows"))
    starts = totals.select("bucket", F.sum("bucket_rows").over(before).alias("lower_buckets"))
    inside = Window.partitionBy("bucket").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    below = F.coalesce("lower_buckets", zero) + F.coalesce("lower_values", zero)
    return (
        bucketed.withColumn("lower_values", F.sum("at").over(inside))
        .join(starts, "bucket", "left")
        .select(value, (below + (F.col("at") + 1) / 2.0).alias("rank_value"))
    )


def correlations(counts: DataFrame, x: str, y: str) -> DataFrame:
    """Pearson and Spearman correlation of counted pairs (x, y, n) of whole numbers: one row."""
    rank_x = average_ranks(counts, x).withColumnRenamed("rank_value", "rank_x")
    rank_y = average_ranks(counts, y).withColumnRenamed("rank_value", "rank_y")
    ranked = counts.join(rank_x, x).join(rank_y, y)
    n = F.col("n").cast(_WIDE)
    vx, vy = F.col(x).cast(_WIDE), F.col(y).cast(_WIDE)
    size = F.sum("n").alias("size")
    totals = counts.agg(size)
    # Average-tie ranks always have the mean (size + 1) / 2: centre first.
    middle = (F.col("size") + 1) / 2.0
    dx, dy = F.col("rank_x") - middle, F.col("rank_y") - middle
    weight = F.col("n").cast("double")
    sums = ranked.crossJoin(F.broadcast(totals)).agg(
        F.sum(n).alias("n"),
        F.sum(vx * n).alias("sx"),
        F.sum(vy * n).alias("sy"),
        F.sum(vx * vx * n).alias("sxx"),
        F.sum(vy * vy * n).alias("syy"),
        F.sum(vx * vy * n).alias("sxy"),
        F.sum(dx * dy * weight).alias("rxy"),
        F.sum(dx * dx * weight).alias("rxx"),
        F.sum(dy * dy * weight).alias("ryy"),
    )

    def centred(product: str, left: str, right: str) -> Column:
        exact = F.col("n") * F.col(product) - F.col(left) * F.col(right)
        return exact.cast("double")

    def correlation(both: Column, first: Column, second: Column) -> Column:
        return F.try_divide(both, F.sqrt(first) * F.sqrt(second))

    return sums.select(
        correlation(
            centred("sxy", "sx", "sy"), centred("sxx", "sx", "sx"), centred("syy", "sy", "sy")
        ).alias("pearson"),
        correlation(F.col("rxy"), F.col("rxx"), F.col("ryy")).alias("spearman"),
    )


def min_max_score(frame: DataFrame, weights: dict[str, float], name: str, places: int | None = None) -> DataFrame:
    """Add 100 * the weighted sum of min-max scaled columns; null where a column is constant.

    The extremes are one row, joined by broadcast.
    """
    extremes = frame.agg(
        *[F.min(c).alias(f"low_{c}") for c in weights], *[F.max(c).alias(f"high_{c}") for c in weights]
    )
    scaled = [
        F.try_divide(F.col(c) - F.col(f"low_{c}"), F.col(f"high_{c}") - F.col(f"low_{c}")) * weight
        for c, weight in weights.items()
    ]
    score = sum(scaled[1:], scaled[0]) * 100.0
    shown = score if places is None else round_even(score, places)
    return frame.crossJoin(F.broadcast(extremes)).select(*frame.columns, shown.alias(name))
