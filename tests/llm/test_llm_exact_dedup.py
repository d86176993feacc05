import hashlib
import re

import pytest
from llm_cases import clashing, frame, odd_rows, rows_of
from pyspark.sql import functions as F

from stallwise.llm import common, exact_dedup


def brute(rows):
    groups = {}
    lowered = [re.sub("[A-Z]+", lambda m: m[0].lower(), t or "") for _, t in rows]
    for (i, _), t in zip(rows, lowered):
        groups.setdefault(t, []).append(i)
    out = []
    for (i, _), t in zip(rows, lowered):
        keep = max((x for x in groups[t] if x is not None), default=None)
        out.append((i, keep, len(groups[t]), i == keep, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("digest", [exact_dedup.sha256, lambda t: F.encode(F.length(t).cast("string"), "utf-8")])
def test_matches_brute_force_even_if_digests_clash(spark, digest):
    rows = odd_rows() + [(i, f"text {i % 7}") for i in range(100, 150)]
    got = rows_of(exact_dedup.exact_groups(frame(spark, rows).repartition(3), salts=3, digest=digest))
    assert got == brute(rows)


def test_hot_groups_are_joined_by_broadcast(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "LEAST_HOT", 5)
    rows = [(i, "same" if i % 3 else f"own {i}") for i in range(60)]
    assert rows_of(exact_dedup.exact_groups(frame(spark, rows))) == brute(rows)


def test_only_a_to_z_are_lowered(spark):
    rows = [(1, "ÄBC"), (2, "Äbc"), (3, "äbc"), (4, "İX")]
    assert [r[1] for r in rows_of(exact_dedup.exact_groups(frame(spark, rows)))] == [2, 2, 3, 4]


def test_plan_is_native(spark):
    plan = exact_dedup.exact_groups(frame(spark, odd_rows()))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_dropping_keeps_all_columns(spark):
    docs = clashing(frame(spark, odd_rows()))
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(5) == 0 and ids.count(8) == 2 and 4 in ids


def test_empty(spark):
    assert exact_dedup.exact_groups(frame(spark, [])).collect() == []
    assert exact_dedup.drop_copies(frame(spark, [])).collect() == []


def test_lower_az_agrees_on_ascii_and_other_texts(spark):
    rows = frame(spark, [(1, "AbZ"), (2, "ÉAbZß"), (3, "")]).select("doc_id", common.lower_az(F.col("text")).alias("t"))
    assert [r["t"] for r in rows.orderBy("doc_id").collect()] == ["abz", "Éabzß", ""]
