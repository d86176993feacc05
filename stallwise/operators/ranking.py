"""Ranking, overall and per group.

No operator here sorts or gathers a whole group: groups are reduced by
aggregation first, so a group that holds a third of all rows costs no more
than any other.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stallwise.functions.numeric import percent


def top_k(frame: DataFrame, k: int, *order: Column) -> DataFrame:
    """First k rows of an order; each task keeps its own k first."""
    return frame.orderBy(*order).limit(k)


def dense_rank_of_top(top: DataFrame, order: Column, name: str) -> DataFrame:
    """Dense rank within the first rows of the same order.

    The first k rows hold every value that ranks above them, so ranks of the
    cut rows equal ranks over the whole. The window sees k rows only.
    """
    return top.withColumn(name, F.dense_rank().over(Window.orderBy(order)))


def running_percent(top: DataFrame, order: list[Column], count: str, total: str, name: str) -> DataFrame:
    """Cumulative percentage over the first rows of an order, rounded after summing."""
    so_far = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return top.withColumn(name, percent(F.sum(count).over(so_far), F.col(total), 2))


def leader_per_group(counts: DataFrame, group: str, item: str, count: str) -> DataFrame:
    """Per group: the item with the highest count (ties by item) and the group's total.

    An aggregate, not a window, so partial results merge in each task.
    """
    best = F.min(F.struct((-F.col(count)).alias("minus"), F.col(item).alias("item")))
    grouped = counts.groupBy(group).agg(best.alias("best"), F.sum(count).alias("group_total"))
    return grouped.select(
        group,
        F.col("best.item").alias(item),
        (-F.col("best.minus")).alias(count),
        "group_total",
    )


def top_dense_per_group(
    frame: DataFrame, group: str, ranked: list[str], k: int, rank: str, groups_are_few: bool = False
) -> DataFrame:
    """Rows whose dense rank within the group is at most k; every tied row stays.

    `ranked` columns order descending with nulls first. Only distinct
    combinations are ranked, and each task keeps its own best k per group before
    the shuffle. The rows are then picked where they lie, so a large group of
    ties is never gathered. The picking side holds at most k rows per group;
    `groups_are_few` says the caller named the groups, which bounds it for a
    broadcast.
    """
    keys = [group, *ranked]
    order = [F.desc_nulls_first(name) for name in ranked]
    best = (
        frame.select(*keys)
        .distinct()
        .withColumn(rank, F.dense_rank().over(Window.partitionBy(group).orderBy(*order)))
        .filter(F.col(rank) <= k)
    )
    renamed = best.select(*[F.col(name).alias(f"best_{name}") for name in keys], rank)
    same = reduce(
        Column.__and__, [F.col(name).eqNullSafe(F.col(f"best_{name}")) for name in keys]
    )
    picked = frame.join(F.broadcast(renamed) if groups_are_few else renamed, same)
    return picked.select(rank, *frame.columns)
