"""Every named query: (session, folder of test tables) -> DataFrame.

City names are arguments of the reports; the test tables have nations instead.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stallwise import fixed_values as V
from stallwise import schema
from stallwise.operators import clean as C
from stallwise.operators import contract
from stallwise.operators import wide_stats as W
from stallwise.operators.measures import MEASURES, measures
from stallwise.operators.quality import null_profile
from stallwise.operators.segments import lift
from stallwise.plans import business_reports as B
from stallwise.plans import dashboards as D
from stallwise.plans import exploration_reports as E
from stallwise.plans import quality_reports as Q
from stallwise.plans import views
from stallwise.sources import listings_io, loads, store, view_state
from stallwise.sources.binding import raw_listings

Query = Callable[[SparkSession, str], DataFrame]

TEST_MAJOR_CITIES = [f"NATION_{i}" for i in (0, 2, 3, 5, 7, 8, 11, 13, 17, 19)]
TEST_METRO_CITIES = [f"NATION_{i}" for i in (1, 4, 6, 9, 12)]
TEST_SLICERS = {
    "city": [f"NATION_{i}" for i in range(12)],
    "veg_category": V.VEG_LABEL,
    "price_tier": [V.VIEW_PRICE_TIERS[1][0], V.VIEW_PRICE_TIERS[2][0]],
}


def _doubles(frame: DataFrame) -> DataFrame:
    """Decimals as doubles, so that results compare across engines."""
    decimals = [name for name, kind in frame.dtypes if kind.startswith("decimal")]
    return frame.withColumns({name: F.col(name).cast("double") for name in decimals}) if decimals else frame


def _on_figures(stored_report, raw_report) -> Query:
    """The report on what the stored table notes, or on the raw rows where nothing is stored."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        stored = store.stored_listings(spark, sf_dir)
        if stored is None:
            return _doubles(raw_report(raw_listings(spark, sf_dir)))
        return _doubles(stored_report(store.read_figures(spark, stored)))

    return query


def _on_clean(report, *args) -> Query:
    return lambda spark, sf_dir: _doubles(report(store.clean_table(spark, sf_dir), *args))


def _on_warehouse(report, *args) -> Query:
    return lambda spark, sf_dir: _doubles(report(store.warehouse_table(spark, sf_dir), *args))


def _on_enriched(report, **kwargs) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        enriched = views.listings_enriched(store.warehouse_table(spark, sf_dir))
        return _doubles(report(enriched, **kwargs))

    return query


def _measures(names: list[str], **kwargs) -> Query:
    return _on_enriched(lambda enriched: measures(enriched, names, **kwargs))


def _csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean table written as CSV and read back."""
    clean = store.clean_table(spark, sf_dir)
    path = store.scratch_path(spark, "clean-csv")
    if path is None:
        return clean
    listings_io.write_clean_csv(clean, path)
    return listings_io.read_clean_csv(spark, path)


def _raw_csv_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw rows as CSV, whose offers hold line breaks, read in splits and cleaned."""
    raw = raw_listings(spark, sf_dir)
    path = store.scratch_path(spark, "raw-csv")
    if path is None:
        # The cleaned raw rows would look like the result, with nothing written or read.
        raise RuntimeError("CSV files need a folder that all executors share: set spark.checkpoint.dir")
    listings_io.write_raw_csv(raw, path)
    return C.clean_listings(listings_io.read_raw_csv(spark, path))


def _warehouse_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The key column is 1..N without gaps or repeats."""
    return _id_range(store.warehouse_with_ids(spark, sf_dir))


def _load_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """So it is after several loads."""
    return _id_range(_loaded_in_batches(spark, sf_dir).rows_with_ids(3))


def _id_range(rows: DataFrame) -> DataFrame:
    return rows.agg(
        F.count("*").alias("listings"),
        F.countDistinct("id").alias("distinct_ids"),
        F.min("id").alias("first_id"),
        F.max("id").alias("last_id"),
    )


# Order lines that are joined, or loaded, at once: what is on disk for a while grows with them, not with the table.
LINES_AT_ONCE = 40_000_000
# Raw listings take a few bytes each as Parquet and hundreds in a task, so tasks read little of them.
LISTINGS_PER_FILE = 500_000
SMALL_SCANS = {"spark.sql.files.maxPartitionBytes": str(16 * 1024 * 1024)}


def _raw_in_parts(spark: SparkSession, sf_dir: str, path: str) -> tuple[DataFrame, int]:
    """The raw listings stored below `path`, joined once for all batches, and how many parts they were joined in."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    parts = max(1, -(-lines // LINES_AT_ONCE))
    for part in range(parts):
        rows = raw_listings(spark, sf_dir, part, parts).write.option("maxRecordsPerFile", LISTINGS_PER_FILE)
        rows.mode("append").parquet(path)
    return spark.read.schema(schema.RAW).parquet(path), parts


_loaded: dict[tuple[str, str], loads.LoadedListings] = {}


def _loaded_in_batches(spark: SparkSession, sf_dir: str) -> loads.LoadedListings:
    """Three batches that have rows in common, one of them sent twice (versions 1 to 3), then a replacement (version 4)."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _loaded:
        path = store.scratch_path(spark, "loaded-listings")
        if path is None:
            raise RuntimeError("loads need a folder that all executors share: set spark.checkpoint.dir")
        table, offers = loads.LoadedListings(spark, path), F.col("Number of Offers")
        with store.settings(spark, store.SHUFFLES_FREED | SMALL_SCANS):
            try:
                raw, parts = _raw_in_parts(spark, sf_dir, f"{path}/raw")
                table.append("few offers", raw.filter(offers <= 1), parts)
                table.append("unknown or few offers", raw.filter(offers.isNull() | (offers <= 2)), parts)
                table.append("few offers", raw.filter(offers <= 1), parts)
                table.append("all", raw, parts)
                table.replace("not veg", raw.filter(F.col("Pure Veg") == "No"), parts)
            finally:
                table.log.delete("raw")
        _loaded[key] = table
    return _loaded[key]


def _loaded_rows(version: int) -> Query:
    return lambda spark, sf_dir: store.clean_of(_loaded_in_batches(spark, sf_dir).rows(version))


def _net_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """City, net price and quantity of each order line: prices nearly all differ."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_suppkey", "l_quantity", "l_extendedprice", "l_discount")
    suppliers = spark.read.parquet(f"{sf_dir}/supplier.parquet").select("s_suppkey", "s_nationkey")
    nations = spark.read.parquet(f"{sf_dir}/nation.parquet").select("n_nationkey", "n_name")
    joined = lines.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey")).join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
    price = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return joined.select(F.col("n_name").alias("city"), price.alias("net_price"), F.col("l_quantity").alias("quantity"))


def _price_quartiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = W.quantiles_by(_net_prices(spark, sf_dir), "city", "net_price", [0.25, 0.5, 0.75])
    return found.withColumn("quantile", F.round("quantile", 6))


def _price_rank_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = W.spearman(_net_prices(spark, sf_dir), "net_price", "quantity", range_values=20_000)
    return found.withColumn("spearman", F.round("spearman", 9))


_view_states: dict[tuple[str, str], view_state.ViewState] = {}


def _view_state(spark: SparkSession, sf_dir: str) -> view_state.ViewState:
    """Listings that come in batches, some with a wrong price that is revised, some that go and come back."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _view_states:
        path = store.scratch_path(spark, "view-state")
        if path is None:
            raise RuntimeError("kept views need a folder that all executors share: set spark.checkpoint.dir")
        listings, state = store.warehouse_table(spark, sf_dir), view_state.ViewState(spark, path, merge_at=3)
        cheap = F.col("cost_for_two") < 300
        wrong = listings.filter(~cheap).withColumn("cost_for_two", F.col("cost_for_two") + 7)
        veg = listings.filter("is_pure_veg")
        state.apply("cheap", listings.filter(cheap))
        state.apply("others", wrong)
        state.apply("prices", listings.filter(~cheap), wrong)
        state.apply("cheap", listings.filter(cheap))
        state.apply("veg closed", deleted=veg)
        state.apply("veg open", veg)
        _view_states[key] = state
    return _view_states[key]


def _kept_city_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _doubles(_view_state(spark, sf_dir).city_summary())


def _kept_cuisine_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _doubles(_view_state(spark, sf_dir).cuisine_matrix())


def _lift(report, segment: str, first: str, second: str, metric: str) -> Query:
    return _on_warehouse(lambda listings: lift(report(listings), segment, first, second, metric))


_BENCHMARKS = ["total_restaurants", "average_rating", "average_cost_for_two", "national_avg_rating",
               "national_avg_cost", "rating_vs_national", "rating_variance_indicator"]
_PROMOTIONS = ["restaurants_with_deals", "promo_penetration", "avg_reviews_aggressive_offers",
               "avg_reviews_no_offers", "discount_review_lift"]
_TITLES = ["city_title", "cuisine_title"]


def queries() -> dict[str, Query]:
    return {
        # Cleaning and checks
        "clean_listings": _on_clean(lambda clean: clean),
        "clean_csv_round_trip": _csv_round_trip,
        "raw_csv_clean": _raw_csv_clean,
        "raw_null_profile": _on_figures(Q.stored_null_profile, lambda raw: null_profile(raw, 2)),
        "clean_null_profile": _on_clean(null_profile, 1),
        "row_counts": _on_figures(Q.stored_row_counts, lambda raw: Q.row_counts(raw, C.clean_listings(raw))),
        "duplicate_count": _on_figures(Q.stored_duplicate_count, C.duplicate_count),
        "price_corrections": _on_figures(Q.stored_price_corrections, C.price_corrections),
        "imputed_counts": _on_figures(Q.stored_imputed_counts, C.imputed_counts),
        "contract_violations": _on_clean(contract.violations),
        "warehouse_ids": _warehouse_ids,
        "load_in_batches": _loaded_rows(3),
        "load_ids": _load_ids,
        "load_replaced": _loaded_rows(4),
        "warehouse_kpis": _on_warehouse(Q.warehouse_kpis),
        "executive_kpis": _on_warehouse(Q.executive_kpis),
        "describe_cost": _on_clean(Q.describe_cost),
        "describe_rating": _on_clean(Q.describe_rating),
        "status_distribution": _on_clean(Q.status_distribution),
        "veg_distribution": _on_clean(Q.veg_distribution),
        "veg_mean_cost": _on_clean(Q.veg_mean_cost),
        "top_locations": _on_clean(Q.top_locations),
        "top_cuisines": _on_clean(Q.top_cuisines),
        "top10_locations": _on_clean(Q.top_locations, 10),
        "top10_cuisines": _on_clean(Q.top_cuisines, 10),
        "warehouse_top_locations": _on_warehouse(Q.top_locations),
        "warehouse_top_cuisines": _on_warehouse(Q.top_cuisines),
        # Business reports
        "q01_city_share": _on_warehouse(B.q01_city_share),
        "q02_veg_penetration": _on_warehouse(B.q02_veg_penetration),
        "q03_city_top_cuisine": _on_warehouse(B.q03_city_top_cuisine, TEST_MAJOR_CITIES),
        "q04_cold_start": _on_warehouse(B.q04_cold_start),
        "q05_dominant_cuisines": _on_warehouse(B.q05_dominant_cuisines),
        "q06_cuisine_prices": _on_warehouse(B.q06_cuisine_prices),
        "q07_menu_models": _on_warehouse(B.q07_menu_models),
        "q08_rating_consistency": _on_warehouse(B.q08_rating_consistency),
        "q09_price_tiers": _on_warehouse(B.q09_price_tiers),
        "q10_metro_top": _on_warehouse(B.q10_metro_top, TEST_METRO_CITIES),
        "q11_city_ticket_size": _on_warehouse(B.q11_city_ticket_size),
        "q12_promotion_effect": _on_warehouse(B.q12_promotion_effect),
        "q13_discount_reliance": _on_warehouse(B.q13_discount_reliance),
        "q14_quadrants": _on_warehouse(B.q14_quadrants),
        "q15_national_chains": _on_warehouse(B.q15_national_chains),
        # Exploration reports
        "e01_top_locations_cumulative": _on_clean(E.e01_top_locations),
        "e01_unique_locations": _on_clean(E.e01_unique_locations),
        "e02a_primary_cuisines": _on_clean(E.e02_primary_cuisines),
        "e02b_all_cuisines": _on_clean(E.e02_all_cuisines),
        "e03a_rating_summary": _on_clean(E.e03_rating_summary),
        "e03b_rating_bins": _on_clean(E.e03_rating_bins),
        "e04a_price_summary": _on_clean(E.e04_price_summary),
        "e04b_price_bins": _on_clean(E.e04_price_bins),
        "e05a_price_rating_corr": _on_clean(E.e05_price_rating_correlation),
        "e05b_rating_by_price": _on_clean(E.e05_rating_by_price),
        "e06a_rating_reviews_corr": _on_clean(E.e06_rating_reviews_correlation),
        "e06b_rating_by_popularity": _on_clean(E.e06_rating_by_popularity),
        "e07_veg_comparison": _on_clean(E.e07_veg_comparison),
        "e08_offer_distribution": _on_clean(E.e08_offer_distribution),
        "e08_offer_share": _on_clean(E.e08_offer_share),
        "e09a_gold_share": _on_clean(E.e09_gold_share),
        "e09b_gold_top": _on_clean(E.e09_gold_top),
        "e10_city_score": _on_clean(E.e10_city_score),
        "e11_price_quartiles_by_city": _price_quartiles,
        "e12_price_rank_correlation": _price_rank_correlation,
        # Views (the id of the enriched view is checked by warehouse_ids)
        "vw1_listings_enriched": _on_enriched(lambda enriched: enriched),
        "vw2_city_summary": _on_warehouse(views.city_summary),
        "vw3_cuisine_matrix": _on_warehouse(views.cuisine_matrix),
        "vw2_kept_city_summary": _kept_city_summary,
        "vw3_kept_cuisine_matrix": _kept_cuisine_matrix,
        # Measures
        "m_all_measures": _measures(list(MEASURES)),
        "m_kpi_row": _on_enriched(D.kpi_row),
        "m_by_city_vs_national": _measures(_BENCHMARKS, by=["city"]),
        "m_promotions_by_city": _measures(_PROMOTIONS, by=["city"]),
        "m_cold_start_by_city": _measures(["unrated_restaurants", "cold_start_share"], by=["city"]),
        "m_sliced": _measures(_BENCHMARKS + _PROMOTIONS, by=["primary_cuisine"], slicers=TEST_SLICERS),
        "m_kpi_sliced": _on_enriched(D.kpi_row, slicers=TEST_SLICERS),
        "m_replaced_filter": _measures(
            ["total_restaurants", "pure_veg_restaurants", "pure_veg_share"],
            by=["city", "is_pure_veg"],
        ),
        "m_replaced_slicer": _measures(
            ["total_restaurants", *_PROMOTIONS], by=["city"], slicers={"offer_count": [1, 2]}
        ),
        "m_titles": _measures(_TITLES),
        "m_titles_one_city": _measures(
            _TITLES, by=["veg_category"], slicers={"city": "NATION_3", "primary_cuisine": "ECONOMY"}
        ),
        # Dashboard datasets
        "d03_top_cities": _on_enriched(D.top_cities),
        "d04_veg_split": _on_enriched(D.veg_split),
        "d05_city_scatter": _on_enriched(D.city_scatter),
        "d06_top_cuisines": _on_enriched(D.top_cuisines),
        "d07_kitchen_models": _on_enriched(D.kitchen_models),
        "d08_cuisine_table": _on_enriched(D.cuisine_table),
        "d09_promotion_tiers": _on_enriched(D.promotion_tiers),
        "d10_price_tiers": _on_enriched(D.price_tiers),
        "d11_chains": _on_enriched(D.chains),
        # Derived figures
        "lift_menu": _lift(
            B.q07_menu_models, "restaurant_model",
            V.REPORT_MENU_MODELS[0][0], V.REPORT_MENU_MODELS[2][0], "avg_review_count",
        ),
        "lift_promo": _lift(
            B.q12_promotion_effect, "promotional_activity",
            V.REPORT_PROMO_TIERS[2][0], V.REPORT_PROMO_TIERS[0][0], "avg_reviews_received",
        ),
        "lift_price": _lift(
            B.q09_price_tiers, "price_tier",
            V.REPORT_PRICE_TIERS[2][0], V.REPORT_PRICE_TIERS[0][0], "avg_review_volume",
        ),
    }
