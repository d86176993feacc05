import re
from pathlib import Path

import duckdb
import pytest
from conftest import SMALL
from llm_cases import DOCUMENTS, clashing, frame, odd_rows, rows_of

import __spark_entry__
import corpus_pipeline
from stallwise.checks import compare
from stallwise.llm import decontamination, exact_dedup, ngram_join, toxicity
from stallwise.llm import queries as llm

ROOT = Path(__file__).resolve().parents[2]


@pytest.mark.parametrize("name", list(llm.oracle_sql()))
def test_matches_sql(spark, name):
    found = llm.queries()[name](spark, SMALL)
    expected = compare.duckdb_tables(SMALL).execute(llm.oracle_sql()[name])
    names = [c[0] for c in expected.description]
    assert sorted(found.columns) == sorted(names)
    assert compare.rows_of(found.columns, map(tuple, found.collect())) == compare.rows_of(names, expected.fetchall())


def test_all_are_registered():
    names = __spark_entry__.queries()
    assert {int(n[2:].split("_")[0]) for n in names if re.match(r"op\d+_", n)} == set(range(1, 14)) and "pipeline" in names


@pytest.mark.parametrize("name, table, key", [("op8_url_filter", "pages", "page_id"), ("op10_html_text", "pages", "page_id"), ("op5_bpe", "documents", "doc_id"), ("op11_periodic_runs", "documents", "doc_id"), ("op12_quality_rules", "documents", "doc_id")])
def test_one_row_per_row(spark, name, table, key):
    found = sorted(r[key] for r in llm.queries()[name](spark, SMALL).select(key).collect())
    assert found == sorted(r[0] for r in duckdb.sql(f"SELECT {key} FROM '{SMALL}/{table}.parquet'").fetchall())


def test_nothing_else_imports_this_folder():
    for file in ROOT.glob("stallwise/**/*.py"):
        if "llm" not in file.relative_to(ROOT).parts:
            assert not re.search(r"stallwise\.llm|from \.*llm", file.read_text()), file


def test_pipeline_stages_on_odd_rows(spark, tmp_path):
    """Nulls, repeated rows and ids, ties, long and empty texts, extra columns of clashing names, empty tables."""
    rows = [(i, t, None if k % 3 else "en", None if k % 2 else "s", k) for k, (i, t) in enumerate(odd_rows())]
    docs = clashing(frame(spark, rows, DOCUMENTS))
    tables = {
        "labels": frame(spark, [(5, 1, 0), (9, 0, None), (11, None, 0), (None, 1, 1), (5, 0, 0)], "doc_id long, quality int, toxic int"),
        "benchmark": frame(spark, [("a", None), (None, "short"), ("b", "nothing of these words is in any document at all here")], "item_id string, text string"),
    }
    for name, table in tables.items():
        table.write.parquet(str(tmp_path / f"{name}.parquet"))
    now, kept = docs, []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        now = corpus_pipeline.common.stored(stage(spark, now, str(tmp_path)), f"odd-{name}")
        kept.append(sorted({r["doc_id"] for r in now.collect()}, key=repr))
        assert k == 4 or now.columns == docs.columns
    # Without a toxic label that is learned from, nothing goes; of equal texts the largest id stays, with all its rows; of
    # near copies the smallest; "short" is a benchmark item of one word.
    assert kept[0] == sorted({i for i, _ in odd_rows()}, key=repr)
    assert set(kept[1]) == {2, 3, 4, 7, 8, 9, 10, 11} and set(kept[2]) == {2, 3, 4, 7, 9, 10, 11}
    assert {2, 3, 4, 7, 10, 11} <= set(kept[3]) <= set(kept[2]) and kept[4] == kept[3]
    empty = docs.filter("1 = 0")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).collect() == []


def test_pipeline_against_brute_force(spark):
    """Each stage's result against the plain definition, on its own input."""
    docs = corpus_pipeline.common.documents(spark, SMALL)
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    rows = {r["doc_id"]: r for r in docs.collect()}

    def step(name, now):
        out = corpus_pipeline.common.stored(stages[name](spark, now, SMALL), f"test-{name}")
        return out, {r["doc_id"] for r in out.collect()}

    scores = {r["doc_id"]: r["predicted"] for r in toxicity.scored(docs, spark.read.parquet(f"{SMALL}/labels.parquet")).collect()}
    docs, left = step("toxicity", docs)
    assert docs.columns == columns and left == {i for i, p in scores.items() if not p}
    texts = {}
    for i in sorted(left):
        texts[re.sub("[A-Z]+", lambda m: m[0].lower(), rows[i]["text"] or "")] = i
    docs, left = step("exact_dedup", docs)
    assert docs.columns == columns and left == set(texts.values())
    from test_llm_ngram_join import brute as near

    groups = {r[0]: r[2] for r in near([(i, rows[i]["text"]) for i in sorted(left)], 5, 80)}
    docs, left = step("ngram_join", docs)
    assert docs.columns == columns and left == {i for i, c in groups.items() if i == c}
    from test_llm_decontamination import brute as leaks

    items = [(str(i), t.encode()) for i, t in duckdb.sql(f"SELECT item_id, text FROM '{SMALL}/benchmark.parquet'").fetchall()]
    order = sorted(left)
    hit = [h for _, h, _ in leaks([(rows[i]["text"] or "").encode() for i in order], items)]
    docs, left = step("decontamination", docs)
    assert docs.columns == columns and left == {i for i, h in zip(order, hit) if not h}
    last = stages["bpe"](spark, docs, SMALL).collect()
    assert {(r["doc_id"], bytes(r["decoded"]).decode()) for r in last} == {(i, rows[i]["text"] or "") for i in left}


def test_stages_cope_with_empty_documents(spark):
    docs = corpus_pipeline.common.documents(spark, SMALL).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.common.stored(stage(spark, docs, SMALL), "test-empty")
    assert rows_of(docs) == []


def test_operators_default_to_five_words_and_four_fifths():
    for operator in (ngram_join.linked, ngram_join.drop_near_copies):
        names = operator.__code__.co_varnames[: operator.__code__.co_argcount]
        defaults = dict(zip(names[-len(operator.__defaults__) :], operator.__defaults__))
        assert defaults["width"] == 5 and defaults["percent"] == 80
    assert decontamination.WINDOW == 10 and exact_dedup.HOT_GROUPS == 10_000
