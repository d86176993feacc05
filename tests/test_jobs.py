from stallwise import jobs
from stallwise.session import sized_settings
from stallwise.sources.binding import raw_listings
from conftest import SMALL


def test_from_raw_file_to_views(spark, tmp_path):
    raw = raw_listings(spark, SMALL)
    raw.write.csv(str(tmp_path / "raw"), header=True, quote='"', escape='"')
    stored = jobs.clean_file(spark, str(tmp_path / "raw"), str(tmp_path / "clean"))
    clean, listings = jobs.open_clean(spark, stored), jobs.open_warehouse(spark, stored)
    assert clean.count() == listings.count() == 6000
    for name, frame in (jobs.cleaning_summary(clean) | jobs.load_summary(listings)).items():
        assert not frame.isEmpty(), name
    jobs.refresh_views(listings)
    jobs.refresh_views(listings)
    assert len(spark.table("listings_enriched").columns) == 21
    assert len(spark.table("city_summary").columns) == 10
    assert len(spark.table("cuisine_matrix").columns) == 9
    jobs.export_views(listings, str(tmp_path / "out"))
    exported = spark.read.parquet(str(tmp_path / "out" / "listings_enriched"))
    assert exported.select("restaurant_id").distinct().count() == 6000


def test_tasks_grow_in_number_and_then_in_size():
    def sizes(n):
        return tuple(int(v) for v in sized_settings(n).values())

    assert sizes(10**6) == (128 * 1024**2, 200)
    assert sizes(10**12) == (128 * 1024**2, 7451)
    assert sizes(100 * 10**12) == (10**9, 100_000)
