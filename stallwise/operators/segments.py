"""Counts and profiles by key."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallwise.functions.numeric import half_up, percent


def value_counts(frame: DataFrame, key: str, count_name: str = "n") -> DataFrame:
    """Rows per non-null value of the key."""
    return frame.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias(count_name))


def top_counts(frame: DataFrame, key: str, k: int, count_name: str = "n") -> DataFrame:
    """The k most frequent values, most frequent first, ties by value."""
    counts = value_counts(frame, key, count_name)
    return counts.orderBy(F.desc(count_name), F.asc(key)).limit(k)


def with_row_total(frame: DataFrame, listings: DataFrame, name: str = "total_rows") -> DataFrame:
    """Add the number of listings to every row.

    Counting reads no columns, and the broadcast side is always one row. A
    window over all rows would bring them together in one task.
    """
    return frame.crossJoin(F.broadcast(listings.agg(F.count("*").alias(name))))


def with_exact_share(frame: DataFrame, listings: DataFrame, count: str, name: str, places: int) -> DataFrame:
    """Add the percentage of all listings after the count, rounded half away from zero."""
    share = half_up(F.col(count) * 100, F.col("total_rows"), places).alias(name)
    position = frame.columns.index(count) + 1
    columns = frame.columns[:position] + [share] + frame.columns[position:]
    return with_row_total(frame, listings).select(*columns)


def with_percent(frame: DataFrame, listings: DataFrame, count: str, name: str, places: int = 2) -> DataFrame:
    """Add the percentage of all listings, rounded half to even."""
    share = percent(F.col(count), F.col("total_rows"), places).alias(name)
    return with_row_total(frame, listings).select(*frame.columns, share)


def lift(profile: DataFrame, segment: str, first: str, second: str, metric: str) -> DataFrame:
    """Compare one metric of two segments: both values, their ratio, and the lift in percent."""

    def of(label: str) -> Column:
        return F.max(F.when(F.col(segment) == label, F.col(metric).cast("double")))

    both = profile.filter(F.col(segment).isin(first, second)).agg(
        of(first).alias("first_value"), of(second).alias("second_value")
    )
    ratio = F.try_divide("first_value", "second_value")
    return both.select(
        F.lit(first).alias("first_segment"),
        F.lit(second).alias("second_segment"),
        "first_value",
        "second_value",
        F.round(ratio, 4).alias("ratio"),
        F.round((ratio - 1) * 100, 1).alias("lift_pct"),
    )
