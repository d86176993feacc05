import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from stallwise import catalog, schema
from stallwise.operators import clean as C
from stallwise.operators import contract
from stallwise.sources import commits, loads, store
from stallwise.sources.binding import raw_listings
from conftest import SMALL


def rows_of(frame):
    return sorted((tuple(r) for r in frame.select(*schema.CLEAN.names).collect()), key=repr)


def batches(raw):
    a = [dict(restaurant_name=f"r{i}", rating_raw=None if i % 7 == 0 else "4.1", location=f"c{i % 5}") for i in range(60)]
    first, second, third = a[:30] + a[:3], a[20:45], a + a[:10]
    return [raw(*first), raw(*second), raw(*third)]


def test_batches_equal_one_load(spark, raw, tmp_path):
    parts = batches(raw)
    table = loads.LoadedListings(spark, str(tmp_path / "t"), buckets=4)
    assert table.version() == loads.Version() and table.rows().count() == 0 == table.rows_with_ids().count()
    for i, part in enumerate(parts):
        table.append(f"b{i}", part)
    one = C.clean_listings(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    assert rows_of(table.rows()) == rows_of(one)
    now = table.version()
    assert [load.rows for load in now.loads] == [30, 15, 15] and [load.first_id for load in now.loads] == [1, 31, 46]
    # A batch sent again changes nothing, an empty one commits an empty load.
    assert table.append("b1", parts[1]) == now and table.append("b3", parts[2]).last_id == 60
    # Another session finds the same table.
    spark.sql(f"DROP TABLE {table.table}")
    again = loads.LoadedListings(spark, str(tmp_path / "t"), buckets=4)
    assert rows_of(again.rows()) == rows_of(one) and again.append("b4", parts[0]).last_id == 60


def test_ids_go_on_across_loads(spark, raw, tmp_path):
    table = loads.LoadedListings(spark, str(tmp_path / "t"), buckets=4)
    for i, part in enumerate(batches(raw)):
        table.append(f"b{i}", part)
        table.append(f"b{i}", part)
    ids = {r["id"]: r["restaurant_name"] for r in table.rows_with_ids().collect()}
    assert sorted(ids) == list(range(1, 61))
    earlier = {r["id"]: r["restaurant_name"] for r in table.rows_with_ids(2).collect()}
    assert len(earlier) == 45 and earlier.items() <= ids.items()


def test_stored_rows_are_not_shuffled(spark, raw, tmp_path):
    parts = batches(raw)
    table = loads.LoadedListings(spark, str(tmp_path / "t"), buckets=4)
    table.append("a", parts[0])
    before = table.append("b", parts[1])
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = table.new_rows(table.unique_rows(parts[2]), before)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    lines = plan.splitlines()
    scan = next(i for i, line in enumerate(lines) if f"FileScan parquet spark_catalog.default.{table.table}" in line)
    join = next(i for i, line in enumerate(lines) if "Join" in line)
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    # From the scan up to the join: the lines above it that are less and less deep.
    way, now = [], depth(lines[scan])
    for line in reversed(lines[join:scan]):
        if depth(line) < now:
            way.append(line)
            now = depth(line)
    assert "Join" in way[-1] and not any("Exchange" in line for line in way)


def test_rows_are_compared_whole(spark, raw, tmp_path, monkeypatch):
    parts = batches(raw)
    monkeypatch.setattr(loads.F, "xxhash64", lambda *columns: F.lit(7).cast("long"))
    table = loads.LoadedListings(spark, str(tmp_path / "t"), buckets=2)
    for i, part in enumerate(parts):
        table.append(f"b{i}", part)
    assert [load.rows for load in table.version().loads] == [30, 15, 15]


def test_a_load_is_all_or_nothing(spark, raw, tmp_path):
    parts = batches(raw)
    table = loads.LoadedListings(spark, str(tmp_path / "t"), buckets=4)
    table.append("a", parts[0])
    pinned, want = table.rows(1), rows_of(table.rows())
    dies = F.when(F.col("`Restaurant Name`") == "r50", F.raise_error(F.lit("killed"))).otherwise(F.col("`Restaurant Name`"))
    with pytest.raises(Exception, match="killed"):
        table.replace("new", parts[2].withColumn("Restaurant Name", dies))
    with pytest.raises(contract.ContractError):
        table.append("bad", raw({"cost_for_two_raw": "no digits"}))
    assert table.versions() == [1] and rows_of(table.rows()) == want == rows_of(pinned)
    # A record that its writer did not finish commits nothing.
    (tmp_path / "t" / "commits" / "2").write_text('{"number": 2, "loa')
    assert table.version().number == 1 and rows_of(table.rows()) == want
    after = table.replace("new", parts[2])
    assert after.number == 3 and rows_of(table.rows()) == rows_of(C.clean_listings(parts[2]))
    assert sorted(r["id"] for r in table.rows_with_ids().collect()) == list(range(1, 61))
    assert rows_of(table.rows(1)) == want == rows_of(pinned)
    assert table.recover() and table.recover() == []
    assert rows_of(table.rows()) == rows_of(C.clean_listings(parts[2])) and rows_of(table.rows(1)) == want


def test_two_writers_cannot_make_one_version(spark, raw, tmp_path, monkeypatch):
    parts = batches(raw)
    table = loads.LoadedListings(spark, str(tmp_path / "t"), buckets=4)
    table.append("a", parts[0])
    late = table.version()
    table.append("b", parts[1])
    # A load that began before the other one ended must not go on top of a version that it never saw.
    monkeypatch.setattr(table, "version", lambda number=None: late)
    with pytest.raises(commits.CommitConflict):
        table.append("c", parts[2])
    monkeypatch.undo()
    assert [load.name for load in table.version().loads] == ["a", "b"]
    assert isinstance(store.task_starts(table.rows()).count(), int)


def test_a_first_load_is_not_staged_and_whole_rows_are_compared_without_grouping_them(spark, raw, tmp_path):
    parts = batches(raw)
    table = loads.LoadedListings(spark, str(tmp_path / "t"), buckets=4)
    table.append("a", parts[0])
    assert not (tmp_path / "t" / "staged").exists()
    staged = str(tmp_path / "unique")
    table.unique_rows(parts[2]).write.parquet(staged)
    plan = table.new_rows(spark.read.parquet(staged), table.version())._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan and "Aggregate" not in plan
    # Nulls, not-a-number and zeros with a sign equal themselves.
    odd = raw({"offer_count": None, "area": None}, {"offer_count": float("nan")}, {"offer_count": 0.0})
    again = raw({"offer_count": None, "area": None}, {"offer_count": float("nan")}, {"offer_count": -0.0}, {"offer_count": None})
    table.append("odd", odd)
    assert table.append("again", again).loads[-1].rows == 1


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_a_load_leaves_no_shuffles_on_disk(spark, raw, tmp_path):
    parts = batches(raw)
    table = loads.LoadedListings(spark, str(tmp_path / "t"), buckets=4)
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    earlier, kept = shuffle_files(spark), spark.conf.get(setting)
    table.append("a", parts[0])
    table.append("b", parts[1])
    table.replace("c", parts[2])
    assert spark.conf.get(setting) == kept
    until = time.time() + 20
    while (left := shuffle_files(spark) - earlier) and time.time() < until:
        time.sleep(0.5)
    assert not left


def test_parts_of_a_batch_equal_the_whole(spark, raw, tmp_path):
    parts = batches(raw)
    odd = raw({"offer_count": None, "area": None}, {"offer_count": float("nan")}, {"offer_count": 0.0}, {"offer_count": -0.0})
    whole = loads.LoadedListings(spark, str(tmp_path / "whole"), buckets=4)
    table = loads.LoadedListings(spark, str(tmp_path / "parts"), buckets=4)
    for name, batch in [("a", parts[0]), ("b", parts[1]), ("c", parts[2].unionByName(odd)), ("d", odd)]:
        whole.append(name, batch)
        table.append(name, batch, parts=3)
    assert rows_of(table.rows()) == rows_of(whole.rows())
    assert table.version().last_id == 63 and [load.rows for load in table.version().loads] == [30, 15, 18, 0]
    assert sorted(r["id"] for r in table.rows_with_ids().collect()) == list(range(1, 64))
    after = table.replace("e", parts[1], parts=2)
    assert rows_of(table.rows()) == rows_of(C.clean_listings(parts[1])) and after.last_id == 25
    assert sorted(r["id"] for r in table.rows_with_ids().collect()) == list(range(1, 26))
    assert not any((tmp_path / "parts" / "staged").iterdir())


def test_a_part_is_shuffled_without_the_others(spark, raw, tmp_path):
    table = loads.LoadedListings(spark, str(tmp_path / "t"), buckets=4)
    batch = batches(raw)[2]
    found = [table.unique_rows(batch, F.pmod("row_hash", F.lit(3)) == i) for i in range(3)]
    assert all(0 < part.count() < 60 for part in found) and sum(part.count() for part in found) == 60
    assert found[0].unionByName(found[1]).unionByName(found[2]).exceptAll(table.unique_rows(batch)).count() == 0


def test_listings_are_joined_once_for_all_batches_in_parts(spark, monkeypatch):
    asked = []

    def listings(session, folder, part, parts):
        asked.append((part, parts))
        return raw_listings(session, folder, part, parts)

    monkeypatch.setattr(catalog, "raw_listings", listings)
    monkeypatch.setattr(catalog, "_loaded", {})
    monkeypatch.setattr(catalog, "LINES_AT_ONCE", 2500)
    table = catalog._loaded_in_batches(spark, SMALL)
    assert asked == [(0, 3), (1, 3), (2, 3)]
    raw = raw_listings(spark, SMALL)
    pieces = [raw_listings(spark, SMALL, i, 3) for i in range(3)]
    assert all(1900 < piece.count() < 2200 for piece in pieces)
    union = pieces[0].unionByName(pieces[1]).unionByName(pieces[2])
    assert union.exceptAll(raw).count() == 0 == raw.exceptAll(union).count()
    clean = C.clean_listings(raw)
    assert rows_of(table.rows(3)) == rows_of(clean) and rows_of(table.rows(4)) == rows_of(clean.filter("NOT is_pure_veg"))
    # What was joined for the batches is gone when they are loaded.
    assert not (Path(table.root) / "raw").exists()
