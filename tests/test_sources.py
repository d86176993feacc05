import pytest
from pyspark.sql import functions as F

from stallwise import catalog, schema
from stallwise.operators import contract
from stallwise.operators.clean import clean_listings, to_warehouse
from stallwise.sources import listings_io as io
from stallwise.sources import store
from stallwise.sources.binding import raw_listings
from conftest import SMALL


def test_raw_csv_with_line_breaks_quotes_and_missing_tokens(spark, tmp_path):
    header = ",".join(schema.RAW.names)
    rows = [
        '"A ""B"" Cafe",Thai,4.2,100+ ratings,₹250 for two,2.0,"Flat 10%\r\n\nFree, delivery",North,Yes,Pune',
        "NA,N/A,--,null,₹100,NaN,,nan,None,Goa",
    ]
    (tmp_path / "raw.csv").write_text("\n".join([header, *rows]) + "\n", encoding="utf-8", newline="")
    raw = io.read_raw_csv(spark, str(tmp_path / "raw.csv"))
    assert raw.dtypes == [(f.name, f.dataType.simpleString()) for f in schema.RAW]
    first, second = sorted(clean_listings(raw).collect(), key=lambda r: r.location, reverse=True)
    assert (first.restaurant_name, first.offer_name, first.offer_count) == ('A "B" Cafe', "Flat 10% | Free, delivery", 2)
    assert second.asDict() == dict(
        restaurant_name=None, location="Goa", area="Goa", cuisine="Unknown", primary_cuisine="Unknown",
        cuisine_count=0, rating=None, rating_status="Unrated", rating_count=None, cost_for_two=100,
        is_pure_veg=False, offer_count=0, offer_name="No Offer",
    )


def test_clean_csv_round_trip(spark, clean, tmp_path):
    rows = clean(
        {"restaurant_name": 'He said "hi",\nand left', "rating": None, "rating_count": None},
        {"offer_name": "a | b", "rating": 4.25, "is_pure_veg": True},
    )
    io.write_clean_csv(rows, str(tmp_path / "out"))
    back = io.read_clean_csv(spark, str(tmp_path / "out"))
    assert back.dtypes == rows.dtypes
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(map(tuple, rows.collect()), key=repr)


def test_clean_parquet_round_trip_reads_only_used_columns(spark, clean, tmp_path):
    io.write_clean(clean({}, {"rating": None}), str(tmp_path / "out"))
    rows = io.read_clean(spark, str(tmp_path / "out"))
    assert rows.schema == schema.CLEAN
    counted = rows.filter("rating >= 4").groupBy("location").count()
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<location:string,rating:double>" in plan and "GreaterThanOrEqual(rating,4.0)" in plan
    assert io.preview(rows, 1).count() == 1


def test_load_replaces_a_table_only_with_valid_rows(spark, clean):
    io.load_table(to_warehouse(clean({}, {"rating": 4.25})), "listings_table")
    assert dict(spark.table("listings_table").dtypes)["rating"] == "decimal(3,1)"
    with pytest.raises(contract.ContractError) as error:
        io.load_table(to_warehouse(clean({"location": None}, {"area": "x" * 151})), "listings_table")
    assert error.value.counts == {"location_missing": 1, "area_too_long": 1}
    assert spark.table("listings_table").count() == 2
    io.load_table(to_warehouse(clean({})), "listings_table")
    assert spark.table("listings_table").count() == 1


def test_refresh_view(spark, clean):
    io.refresh_view(clean({}), "some_view")
    io.refresh_view(clean({}, {}), "some_view")
    assert spark.table("some_view").count() == 2


def test_split_rejects(clean):
    rows = clean({}, {"rating": 99.95}, {"cuisine": None, "primary_cuisine": None}, {"rating": None, "rating_count": None})
    accepted, rejected = contract.split_rejects(rows)
    assert accepted.count() == 2
    assert sorted(tuple(r.broken_rules) for r in rejected.collect()) == [
        ("cuisine_missing", "primary_cuisine_missing"), ("rating_out_of_range",),
    ]
    counted = {r.rule: r.violations for r in contract.violations(rows).collect() if r.violations}
    assert counted == {"rating_out_of_range": 1, "cuisine_missing": 1, "primary_cuisine_missing": 1}


def test_store_counts_broken_rows_and_the_warehouse_refuses_them(spark, clean, tmp_path, monkeypatch):
    stored = store.write_store(clean({"rating": 100.0}, {}), str(tmp_path / "store"))
    assert stored.broken_rows == 1 and store.open_store(spark, stored.path) == stored
    monkeypatch.setattr(store, "stored_listings", lambda *_: stored)
    assert store.clean_table(spark, SMALL).count() == 2
    with pytest.raises(contract.ContractError) as error:
        store.warehouse_table(spark, SMALL)
    assert error.value.counts == {"rating_out_of_range": 1}


def test_without_a_shared_folder_reports_still_run(spark, monkeypatch):
    monkeypatch.setattr(store, "shared_folder", lambda _: None)
    assert store.clean_table(spark, SMALL).count() == 6000
    assert dict(store.warehouse_table(spark, SMALL).dtypes)["rating"] == "decimal(3,1)"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        store.warehouse_with_ids(spark, SMALL)


def test_raw_csv_clean_does_not_go_without_its_files(spark, raw, monkeypatch):
    monkeypatch.setattr(catalog, "raw_listings", lambda *_: raw({"offer_name_raw": "10%\r\noff"}, {"area": None}))
    found = {r.area: r.offer_name for r in catalog.queries()["raw_csv_clean"](spark, SMALL).collect()}
    assert found == {"Centre": "10% | off", "Pune": "10% off"}
    monkeypatch.setattr(store, "shared_folder", lambda _: None)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        catalog.queries()["raw_csv_clean"](spark, SMALL)


def test_store_is_written_once_in_the_shared_folder(spark):
    first, again = store.stored_listings(spark, SMALL), store.stored_listings(spark, SMALL)
    assert first is again and first.path.startswith(spark.conf.get("spark.checkpoint.dir"))
    assert store.clean_table(spark, SMALL).schema.names == schema.CLEAN.names


def test_store_is_written_again_when_its_folder_was_emptied(spark, monkeypatch, tmp_path):
    gone = store.Stored(str(tmp_path / "gone"), 0)
    key = (spark.sparkContext.applicationId, SMALL)
    monkeypatch.setitem(store._stored, key, gone)
    assert store.clean_table(spark, SMALL).count() == 6000
    assert store.stored_listings(spark, SMALL) != gone


def test_sorted_store_skips_other_cities(spark, clean, tmp_path):
    rows = clean({"location": "B"}, {"location": "A"}).crossJoin(spark.range(100)).drop("id")
    stored = store.write_store(rows.coalesce(1), str(tmp_path / "store"), sort_by=["location"])
    cities = [r.location for r in store.read_store(spark, stored).orderBy("load_position").collect()]
    assert cities == ["A"] * 100 + ["B"] * 100


def test_ids_are_dense_however_rows_are_spread(spark, clean, tmp_path):
    rows = clean({}).crossJoin(spark.range(5000)).withColumn("area", F.col("id").cast("string")).drop("id")
    uneven = rows.repartition(6).unionAll(rows.limit(3)).unionAll(rows.filter("false"))
    stored = store.write_store(uneven, str(tmp_path / "store"))
    ids = [r.id for r in store.with_ids(store.read_store(spark, stored)).select("id").collect()]
    assert sorted(ids) == list(range(1, 5004))


def test_warehouse_with_ids(spark):
    listings = store.warehouse_with_ids(spark, SMALL)
    assert listings.columns == ["id", *schema.CLEAN.names]
    assert listings.select("id").distinct().count() == listings.count() == 6000


def test_binding_counts(spark):
    raw = raw_listings(spark, SMALL)
    assert raw.schema.names == schema.RAW.names
    assert (raw.count(), clean_listings(raw).count()) == (6115, 6000)


def test_lines_of_one_row_group_become_listings_in_many_tasks(spark):
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        raw = raw_listings(spark, SMALL)
        per_task = [r["count"] for r in raw.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert len(per_task) == 4 and max(per_task) < 2 * min(per_task)
