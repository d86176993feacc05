"""The two jobs end to end: clean a raw file, publish the dashboard datasets."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from stallwise.operators import clean as C
from stallwise.operators.quality import null_profile
from stallwise.plans import quality_reports as Q
from stallwise.plans import views
from stallwise.sources import listings_io, store


def clean_file(spark: SparkSession, raw_csv: str, target: str, sort_by: Sequence[str] = ()) -> store.Stored:
    """Raw CSV files to a stored clean table at `target`."""
    clean = C.clean_with_figures(listings_io.read_raw_csv(spark, raw_csv))
    return store.write_store(clean, target, sort_by)


def open_clean(spark: SparkSession, stored: store.Stored) -> DataFrame:
    """The stored clean table, for the exploration and quality reports."""
    return store.clean_of(store.read_store(spark, stored))


def open_warehouse(spark: SparkSession, stored: store.Stored) -> DataFrame:
    """The stored table with ids and one-decimal ratings, for reports and views.

    Raises if rows break the contract.
    """
    store.require_contract(spark, stored)
    return store.warehouse_of(store.with_ids(store.read_store(spark, stored)))


def cleaning_summary(clean: DataFrame) -> dict[str, DataFrame]:
    """What to look at after cleaning."""
    return {
        "nulls": null_profile(clean, 1),
        "rating_status": Q.status_distribution(clean),
        "pure_veg": Q.veg_distribution(clean),
        "cost_for_two": Q.describe_cost(clean),
        "rating": Q.describe_rating(clean),
        "top_cuisines": Q.top_cuisines(clean),
        "top_locations": Q.top_locations(clean),
        "mean_cost_by_veg": Q.veg_mean_cost(clean),
    }


def cleaning_figures(spark: SparkSession, stored: store.Stored) -> dict[str, DataFrame]:
    """What the cleaning job did, from the stored table alone."""
    figures = store.read_figures(spark, stored)
    return {
        "row_counts": Q.stored_row_counts(figures),
        "duplicates": Q.stored_duplicate_count(figures),
        "raw_nulls": Q.stored_null_profile(figures),
        "price_corrections": Q.stored_price_corrections(figures),
        "imputed": Q.stored_imputed_counts(figures),
    }


def load_summary(listings: DataFrame) -> dict[str, DataFrame]:
    """What to look at after loading the warehouse table."""
    return {
        "kpis": Q.warehouse_kpis(listings),
        "top_locations": Q.top_locations(listings),
        "top_cuisines": Q.top_cuisines(listings),
    }


def dashboard_views(listings: DataFrame) -> dict[str, DataFrame]:
    return {
        "listings_enriched": views.listings_enriched(listings),
        "city_summary": views.city_summary(listings),
        "cuisine_matrix": views.cuisine_matrix(listings),
    }


def refresh_views(listings: DataFrame) -> None:
    """Create or replace the three views in the session."""
    for name, frame in dashboard_views(listings).items():
        listings_io.refresh_view(frame, name)


def export_views(listings: DataFrame, folder: str) -> None:
    """Write each view as Parquet below the folder, for a dashboard's import."""
    for name, frame in dashboard_views(listings).items():
        frame.write.mode("overwrite").parquet(f"{folder.rstrip('/')}/{name}")
