import pyarrow as pa
from llm_cases import frame, rows_of
from pyspark.sql import functions as F

from stallwise.llm import common


def test_components_of_chains_stars_and_rings(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(200 + i, 200 + (i + 1) % 7) for i in range(7)] + [(5, 5), (41, 3)]
    found = dict(rows_of(common.components(frame(spark, edges, "a long, b long").repartition(3))))
    assert found == {i: 0 for i in range(42)} | {100 + i: 100 for i in range(30)} | {200 + i: 200 for i in range(7)}
    assert common.components(frame(spark, [], "a long, b long")).collect() == []


def test_lookup_of_hot_cold_and_missing_keys(spark):
    rows = frame(spark, [(i, "hot" if i % 3 else f"k{i}") for i in range(3000)], "id long, key string")
    table = frame(spark, [("hot", 2000, "H"), ("k0", 1, "zero"), ("k3", 1, "three")], "key string, size long, value string")
    found = {r["id"]: r["value"] for r in common.lookup(rows, table, "key", "size", ["value"], F.xxhash64("id"), hot_keys=2).collect()}
    assert len(found) == 3000 and found[1] == "H" and found[0] == "zero" and found[3] == "three" and found[6] is None


def test_bounded_samples_are_the_same_rows_however_dealt(spark):
    rows = frame(spark, [(i,) for i in range(5000)], "id long")
    one, two = (rows_of(common.bounded_sample(rows.repartition(n), ["id"], 100)) for n in (1, 7))
    assert one == two and 50 < len(one) <= 100
    assert len(rows_of(common.bounded_sample(rows.limit(30), ["id"], 100))) == 30


def test_shards_hold_whole_rows_in_order():
    batches = [pa.RecordBatch.from_arrays([pa.array(["x" * n for n in sizes])], names=["text"]) for sizes in ([1, 2, 50, 1], [], [3, 3, 3], [100])]
    shards = [shard.column("text").to_pylist() for shard in common.shards(batches, 6)]
    assert [len(t) for s in shards for t in s] == [1, 2, 50, 1, 3, 3, 3, 100]
    assert all(len(s) == 1 or sum(map(len, s)) <= 6 for s in shards)
    assert list(common.shards([], 6)) == []


def test_filters_send_a_text_once_and_judge_nulls_as_empty(spark):
    def short(batches):
        for batch in batches:
            yield [len(t) < 2 for t in batch.column("text").to_pylist()]

    docs = frame(spark, [(1, "a"), (2, None), (3, "abc")], "id long, text string")
    kept = common.filter_texts(docs, short)
    assert rows_of(kept) == [(1, "a"), (2, None)] and kept.schema == docs.schema
    assert "_text" not in kept._jdf.queryExecution().optimizedPlan().toString()
    numbers = frame(spark, [(1, 7), (2, None), (3, 700)], "id long, text long")
    assert rows_of(common.filter_texts(numbers, short)) == [(1, 7), (2, None)]
