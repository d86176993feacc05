import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from stallwise.functions.numeric import hundredths
from stallwise.operators import ranking as R
from stallwise.operators import segments as G
from stallwise.operators import stats as S


@pytest.fixture(scope="module")
def numbers():
    random = np.random.default_rng(5)
    x = random.integers(0, 5000, 4000)
    y = np.round(np.clip(2 + x / 2500 + random.normal(0, 0.7, 4000), 0, 5), 2)
    return pd.DataFrame({"x": x, "y": y})


def test_summary_matches_pandas(spark, numbers):
    frame = spark.createDataFrame(numbers)
    got = S.summary(frame, hundredths(F.col("y")), 100, 6).first()
    y = numbers.y
    expected = [len(y), y.mean(), y.std(), y.min(), y.quantile(0.25), y.median(), y.quantile(0.75), y.max(), y.mode()[0]]
    assert list(got) == pytest.approx(expected, abs=2e-6)


def test_summary_of_nothing(spark):
    got = S.summary(spark.createDataFrame([(None,)], "x long"), F.col("x"), 1, 2).first()
    assert list(got) == [0] + [None] * 8


def test_mode_takes_the_smallest_on_ties(spark):
    frame = spark.createDataFrame([(3,), (1,), (3,), (1,), (2,)], "x long")
    assert S.summary(frame, F.col("x"), 1, 0).first().mode == 1.0


@pytest.mark.parametrize("width", [1, 7, 1000, 10**6])
def test_average_ranks(spark, numbers, width):
    counts = S.histogram(spark.createDataFrame(numbers), F.col("x"))
    got = S.average_ranks(counts, "x", width=width).toPandas().set_index("x").rank_value
    expected = numbers.x.rank().groupby(numbers.x).first()
    assert got.sort_index().tolist() == expected.tolist()


def test_correlations_match_pandas(spark, numbers):
    frame = spark.createDataFrame(numbers).repartition(7)
    counts = S.histogram(frame, F.col("x"), hundredths(F.col("y")).alias("h"))
    got = S.correlations(counts, "x", "h").first()
    assert got.pearson == pytest.approx(numbers.x.corr(numbers.y), abs=1e-12)
    assert got.spearman == pytest.approx(numbers.x.rank().corr(numbers.y.rank()), abs=1e-12)


def test_correlation_of_a_constant_is_null(spark):
    counts = S.histogram(spark.createDataFrame([(1, 2), (1, 3)], "a long, b long"), F.col("a"), F.col("b"))
    assert tuple(S.correlations(counts, "a", "b").first()) == (None, None)


def test_min_max_score(spark):
    frame = spark.createDataFrame([("a", 1.0, 5.0), ("b", 3.0, 7.0), ("c", 2.0, 9.0)], "k string, x double, y double")
    got = {r.k: r.score for r in S.min_max_score(frame, {"x": 0.25, "y": 0.75}, "score").collect()}
    assert got == pytest.approx({"a": 0.0, "b": 62.5, "c": 87.5})
    flat = S.min_max_score(frame.withColumn("x", F.lit(1.0)), {"x": 1.0}, "score")
    assert [r.score for r in flat.collect()] == [None] * 3


def test_dense_rank_of_top_equals_rank_over_all(spark):
    frame = spark.createDataFrame([("a", 5), ("b", 5), ("c", 4), ("d", 3), ("e", 3)], "k string, n long")
    top = R.top_k(frame, 4, F.desc("n"), F.asc("k"))
    ranked = R.dense_rank_of_top(top, F.desc("n"), "rank").collect()
    assert {r.k: r["rank"] for r in ranked} == {"a": 1, "b": 1, "c": 2, "d": 3}


def test_leader_per_group_breaks_ties_by_name(spark):
    rows = [("p", "b", 3), ("p", "a", 3), ("p", "c", 1), ("q", "z", 9)]
    got = R.leader_per_group(spark.createDataFrame(rows, "g string, i string, n long"), "g", "i", "n")
    assert sorted(map(tuple, got.collect())) == [("p", "a", 3, 7), ("q", "z", 9, 9)]


@pytest.mark.parametrize("few", [True, False])
def test_top_dense_keeps_ties_and_puts_nulls_first(spark, few):
    random = np.random.default_rng(3)
    rows = [
        (f"g{g}", None if r == 0 else float(r), float(c), i)
        for i, (g, r, c) in enumerate(zip(*random.integers(0, [[3], [6], [4]], (3, 600))))
    ]
    frame = spark.createDataFrame(rows, "g string, r double, c double, i long").repartition(5)
    got = R.top_dense_per_group(frame, "g", ["r", "c"], 3, "rank", groups_are_few=few)
    pdf = pd.DataFrame(rows, columns=["g", "r", "c", "i"])
    pdf["order"] = list(zip(pdf.r.fillna(99), pdf.c))
    expected = set()
    for _, group in pdf.groupby("g"):
        best = sorted(set(group.order), reverse=True)[:3]
        expected |= {(best.index(o) + 1, i) for o, i in zip(group.order, group.i) if o in best}
    assert {(row["rank"], row.i) for row in got.collect()} == expected


def test_lift(spark):
    profile = spark.createDataFrame([("a", 592.0), ("b", 523.0), ("c", 1.0)], "s string, m double")
    row = G.lift(profile, "s", "a", "b", "m").first()
    assert (row.first_value, row.second_value, row.lift_pct) == (592.0, 523.0, 13.2)
