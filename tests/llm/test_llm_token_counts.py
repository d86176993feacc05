import public_tokenizers
import pytest
from conftest import SMALL
from llm_cases import DOCUMENTS, clashing, frame

from stallwise.llm import bpe, token_counts as T
from stallwise.llm import queries as llm
from stallwise.sources import store

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
ROWS = [(1, "one two three", "en", "a", 0), (2, None, "en", None, 0), (3, "", None, "a", 0), (4, "vier " * 5000, "de", "a", 0), (4, "again", "de", "b", 0), (5, "one two three", "en", "a", 0)]


def expected(rows):
    codec, out = bpe.encoding(PATH, PATTERN), {}
    for _, text, lang, source, _ in rows:
        docs, tokens = out.get((source, lang), (0, 0))
        out[source, lang] = docs + 1, tokens + len(codec.encode_ordinary(text or ""))
    return out


def totals(rollup):
    return {(r["source"], r["lang"]): (r["docs"], r["tokens"]) for r in rollup.totals().collect()}


def test_batches_add_up_and_repeat_without_effect(spark):
    rollup = T.Rollup(spark, store.scratch_path(spark, "rollup"))
    count = lambda rows: T.counted(clashing(frame(spark, rows, DOCUMENTS)), PATH, PATTERN, "v1")
    assert rollup.totals().collect() == []
    assert rollup.apply("load", T.inserts(count(ROWS))) and not rollup.apply("load", T.inserts(count(ROWS)))
    assert totals(rollup) == expected(ROWS)
    assert rollup.apply("gone", T.deletes(count(ROWS[3:4])))
    changed = [(1, "one two three four five", "en", "a", 0)]
    assert rollup.apply("revised", T.revisions(count(ROWS[:1]), count(changed)))
    assert rollup.apply("nothing", T.inserts(count([])))
    assert totals(rollup) == expected(changed + ROWS[1:3] + ROWS[4:])


def test_a_batch_that_died_before_its_commit_is_written_anew(spark, monkeypatch):
    rollup = T.Rollup(spark, store.scratch_path(spark, "rollup"))
    counts = T.counted(frame(spark, ROWS, DOCUMENTS), PATH, PATTERN, "v1")

    def dies(number, record):
        rollup.log.files().create(rollup.log.path("commits", str(number)), False).close()
        raise RuntimeError("killed")

    with monkeypatch.context() as patched, pytest.raises(RuntimeError, match="killed"):
        patched.setattr(rollup.log, "commit", dies)
        rollup.apply("b1", T.inserts(counts))
    assert rollup.totals().collect() == [] and not rollup.committed("b1")
    assert rollup.apply("b1", T.inserts(counts)) and totals(rollup) == expected(ROWS)


def test_two_jobs_at_once(spark, monkeypatch):
    """The other job commits after this one has read the totals: nothing is lost, whoever is first."""
    folder = store.scratch_path(spark, "rollup")
    one, other = T.Rollup(spark, folder), T.Rollup(spark, folder)
    first = T.counted(frame(spark, ROWS[:3], DOCUMENTS), PATH, PATTERN, "v1")
    second = T.counted(frame(spark, ROWS[3:], DOCUMENTS), PATH, PATTERN, "v1")
    commit = one.log.commit

    def late(number, record):
        monkeypatch.undo()
        other.apply("second", T.inserts(second))
        commit(number, record)

    monkeypatch.setattr(one.log, "commit", late)
    assert one.apply("first", T.inserts(first))
    assert totals(one) == totals(other) == expected(ROWS) and not other.apply("first", T.inserts(first))


def test_reading_takes_the_same_jobs_after_many_batches(spark):
    rollup = T.Rollup(spark, store.scratch_path(spark, "rollup"))
    counts = T.counted(frame(spark, ROWS, DOCUMENTS), PATH, PATTERN, "v1")
    files = []
    for i in range(6):
        rollup.apply(f"b{i}", T.inserts(counts))
        files.append(len({f.rsplit("/", 1)[0] for f in rollup.totals().inputFiles()}))
    assert files == [1] * 6
    assert totals(rollup) == {k: (6 * d, 6 * n) for k, (d, n) in expected(ROWS).items()}


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    low = {r["doc_id"] for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect() if r["quality"] == 0}
    codecs = {name: bpe.encoding(public_tokenizers.path(f"{name}.tiktoken"), PATTERN) for name in ("byte_bpe_multi_50k", "byte_bpe_50k")}
    want = {}
    for r in docs:
        if r["doc_id"] not in low:
            name = "byte_bpe_50k" if r["lang"] == "en" else "byte_bpe_multi_50k"
            key = r["source"], r["lang"], name
            n, tokens = want.get(key, (0, 0))
            want[key] = n + 1, tokens + len(codecs[name].encode_ordinary(r["text"] or ""))
    found = llm.queries()["op9_token_counts"](spark, SMALL).collect()
    assert {(r["source"], r["lang"], r["tokenizer"]): (r["docs"], r["tokens"]) for r in found} == want and len(found) == len(want)


def test_versions_stay_apart(spark):
    rollup = T.Rollup(spark, store.scratch_path(spark, "rollup"))
    counts = T.counted(frame(spark, ROWS[:1], DOCUMENTS), PATH, PATTERN, "v1")
    newer = T.counted(frame(spark, ROWS[:1], DOCUMENTS), public_tokenizers.path("byte_bpe_50k.tiktoken"), PATTERN, "v2")
    rollup.apply("a", T.inserts(counts))
    rollup.apply("b", T.revisions(counts, newer))
    assert [(r["tokenizer"], r["docs"]) for r in rollup.totals().collect()] == [("v2", 1)]
