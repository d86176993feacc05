import math

import numpy as np
import pytest

from stallwise.operators import wide_stats as W


def frame(spark, rows, layout):
    return spark.createDataFrame([tuple(None if x is None else x.item() if hasattr(x, "item") else x for x in r) for r in rows], layout)


@pytest.mark.parametrize("splitters", [1, 3, 64])
def test_quantiles_of_groups(spark, splitters):
    pick = np.random.default_rng(splitters)
    # A hot group, a small one, one value only, ties, extremes, and what is left out.
    groups = {
        "hot": pick.normal(0, 1e6, 4000), "few": pick.random(3), "same": np.full(50, 2.5), "one": np.array([7.0]),
        "ties": pick.integers(0, 4, 200).astype(float), "far": np.array([-1e300, 1e-300, 0.0, 1e300, 5.0]), None: pick.random(10),
    }
    rows = [(k, v) for k, vs in groups.items() for v in vs] + [("hot", None), ("few", float("nan")), ("void", None)]
    shares = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = {(r["city"], r["share"]): (r["quantile"], r["rows"]) for r in W.quantiles_by(frame(spark, rows, "city string, v double"), "city", "v", shares, splitters).collect()}
    assert got.keys() == {(k, s) for k in groups for s in shares}
    for k, values in groups.items():
        for s in shares:
            assert got[k, s][1] == len(values) and math.isclose(got[k, s][0], np.quantile(values, s), rel_tol=1e-12, abs_tol=1e-12), (k, s)
    assert W.quantiles_by(frame(spark, [], "city string, v double"), "city", "v", shares).collect() == []


def brute_ranks(values):
    values = np.asarray(values)
    return np.array([(values < v).sum() + ((values == v).sum() + 1) / 2 for v in values])


def test_spearman_with_ties_over_many_ranges(spark):
    pick = np.random.default_rng(2)
    x = np.concatenate([pick.normal(size=500), np.full(250, 0.25)])
    y = np.round(x + pick.normal(size=750), 1)
    rows = [*zip(x, y), (None, 1.0), (1.0, float("nan"))]
    got = W.spearman(frame(spark, rows, "a double, b double"), "a", "b", range_values=40).first()
    assert got.pairs == 750 and math.isclose(got.spearman, np.corrcoef(brute_ranks(x), brute_ranks(y))[0, 1], rel_tol=1e-12)
    empty = W.spearman(frame(spark, [], "a double, b double"), "a", "b").first()
    assert empty.pairs == 0 and empty.spearman is None
    assert W.spearman(frame(spark, [(1.0, 2.0)] * 3, "a double, b double"), "a", "b").first().spearman is None


def test_no_window_holds_all_values(spark):
    rows = frame(spark, [(float(i), 1) for i in range(3000)], "v double, n long")
    ranks = W.average_ranks(rows, "v", range_values=100)
    plan = ranks._jdf.queryExecution().executedPlan().toString().split("\n")
    for i, line in enumerate(plan):
        if "Exchange SinglePartition" in line:
            assert "HashAggregate(keys=[part" in plan[i + 1]
    assert [r["rank_value"] for r in ranks.orderBy("v").collect()] == [float(i) for i in range(1, 3001)]
