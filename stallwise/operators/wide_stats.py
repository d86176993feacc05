"""Exact ranks and quantiles of values without a limit: any doubles, nearly all of them different.

`stats` counts rows per value and relies on few values. Here nothing that one
task holds grows with the values:

* ranks: counted values are dealt by ranges, each range adds up its own rows, and
  only one total a range passes through an ordered window;
* quantiles per group: rounds of selection. Each round takes splitters from a
  sketch of fixed size, counts the rows between them exactly, and keeps the part
  that holds the wanted rank, until that part is a single value. A round divides
  the rows of a part by about the number of splitters, so rounds grow with the
  logarithm of the rows.

Rows with a null (or not-a-number) value are left out.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stallwise.sources import store

#: Distinct values that one range of ranks may hold, about.
RANGE_VALUES = 1_000_000
SPLITTERS, ACCURACY = 64, 1_000


def _stored(frame: DataFrame, name: str) -> DataFrame:
    path = store.scratch_path(frame.sparkSession, name)
    if path is None:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def _there(value: str) -> Column:
    return F.col(value).isNotNull() & ~F.isnan(value)


def average_ranks(counted: DataFrame, value: str, weight: str = "n", range_values: int = RANGE_VALUES) -> DataFrame:
    """(value, rank_value): the average-tie rank of each distinct value; a row of `counted` stands for `weight` rows."""
    counts = _stored(counted.groupBy(value).agg(F.sum(weight).alias("at")), "rank-counts")
    parts = max(1, -(-counts.count() // range_values))
    # Written with the number of their range: dealt again, the ranges would not be the same.
    dealt = _stored(counts.repartitionByRange(parts, value).withColumn("part", F.spark_partition_id()), "rank-ranges")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = dealt.groupBy("part").agg(F.sum("at").alias("part_rows"))
    zero = F.lit(0).cast("long")
    starts = totals.select("part", F.coalesce(F.sum("part_rows").over(before), zero).alias("lower"))
    inside = Window.partitionBy("part").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.withColumn("inside", F.coalesce(F.sum("at").over(inside), zero)).join(F.broadcast(starts), "part")
    return placed.select(value, (F.col("lower") + F.col("inside") + (F.col("at") + 1) / 2.0).alias("rank_value"))


def spearman(frame: DataFrame, x: str, y: str, range_values: int = RANGE_VALUES) -> DataFrame:
    """One row: the number of pairs and the rank correlation of two columns of any numbers."""
    pairs = frame.filter(_there(x) & _there(y)).groupBy(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    pairs = _stored(pairs.agg(F.count("*").alias("n")), "rank-pairs")
    ranked = pairs
    for name in ("x", "y"):
        ranks = average_ranks(pairs, name, range_values=range_values).withColumnRenamed("rank_value", f"rank_{name}")
        ranked = ranked.join(ranks, name)
    middle = (pairs.agg(F.sum("n")).first()[0] or 0) / 2.0 + 0.5
    dx, dy, n = F.col("rank_x") - middle, F.col("rank_y") - middle, F.col("n").cast("double")
    sums = ranked.agg(F.sum("n").alias("n"), F.sum(dx * dy * n).alias("xy"), F.sum(dx * dx * n).alias("xx"), F.sum(dy * dy * n).alias("yy"))
    return sums.select(F.coalesce("n", F.lit(0)).alias("pairs"), F.try_divide("xy", F.sqrt("xx") * F.sqrt("yy")).alias("spearman"))


def quantiles_by(frame: DataFrame, key: str, value: str, shares: list[float], splitters: int = SPLITTERS) -> DataFrame:
    """(key, share, quantile, rows): exact quantiles of each group, with linear interpolation between neighbours."""
    rows = frame.filter(_there(value)).select(F.col(key).alias("key"), F.col(value).cast("double").alias("v"))
    about = rows.groupBy("key").agg(F.count("*").alias("rows"), F.min("v").alias("low"), F.max("v").alias("high"))
    about = about.withColumn("share", F.explode(F.array(*[F.lit(float(s)) for s in shares])))
    place = F.col("share") * (F.col("rows") - 1)
    ends = F.array(F.floor(place), F.ceil(place))
    wanted = about.select("key", "share", "rows", "low", "high", place.alias("place"), F.explode(F.array_distinct(ends)).alias("target"))
    wanted = _stored(wanted.withColumn("rank", F.col("target")), "quantile-targets")
    done = []
    while True:
        done.append(wanted.filter("low = high"))
        wanted = wanted.filter("low < high")
        if wanted.isEmpty():
            break
        wanted = _stored(_narrowed(rows, wanted, splitters), "quantile-round")
    found = done[0]
    for more in done[1:]:
        found = found.unionByName(more)
    weight = F.col("place") - F.floor("place")
    low, high = F.max(F.when(F.col("target") == F.floor("place"), F.col("low"))), F.max(F.when(F.col("target") == F.ceil("place"), F.col("low")))
    exact = found.groupBy("key", "share").agg(low.alias("a"), high.alias("b"), F.max(weight).alias("w"), F.max("rows").alias("rows"))
    return exact.select(F.col("key").alias(key), "share", (F.col("a") + (F.col("b") - F.col("a")) * F.col("w")).alias("quantile"), "rows")


def _narrowed(rows: DataFrame, wanted: DataFrame, splitters: int) -> DataFrame:
    """The targets, each with the part of its range that holds its rank."""
    one = ["key", "share", "target"]
    ranges = wanted.select(*[F.col(c).alias(f"_{c}") for c in one], "low", "high")
    # One row a target; groups are cities or the like, and the engine knows the table's size.
    inside = rows.join(ranges, F.col("key").eqNullSafe(F.col("_key")) & F.col("v").between(F.col("low"), F.col("high")))
    inside = inside.select("v", *[F.col(f"_{c}").alias(c) for c in one])
    marks = F.percentile_approx("v", [(i + 1) / (splitters + 1) for i in range(splitters)], ACCURACY)
    cuts = inside.groupBy(*one).agg(F.array_distinct(F.concat(F.array(F.min("v")), marks)).alias("cuts"))
    cuts = _stored(cuts.select(*[F.col(c).alias(f"_{c}") for c in one], F.array_sort("cuts").alias("cuts")), "quantile-cuts")
    same = F.col("key").eqNullSafe(F.col("_key")) & (F.col("share") == F.col("_share")) & (F.col("target") == F.col("_target"))
    # Part i holds the values above cut i - 1, up to cut i; the first one is the least value alone.
    part = F.size(F.filter("cuts", lambda c: c < F.col("v"))).alias("part")
    counted = inside.join(cuts, same).select(*one, "v", part).groupBy(*one, "part")
    counted = counted.agg(F.count("*").alias("n"), F.min("v").alias("new_low"), F.max("v").alias("new_high"))
    before = Window.partitionBy(*one).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counted = counted.withColumn("below", F.coalesce(F.sum("n").over(before), F.lit(0)))
    counted = counted.select(*[F.col(c).alias(f"_{c}") for c in one], "n", "below", "new_low", "new_high")
    found = wanted.join(counted, same & (F.col("rank") >= F.col("below")) & (F.col("rank") < F.col("below") + F.col("n")))
    return found.select(
        *one, "rows", "place", (F.col("rank") - F.col("below")).alias("rank"), F.col("new_low").alias("low"), F.col("new_high").alias("high")
    )
