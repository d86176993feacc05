"""Result sets behind the dashboard visuals; each takes the enriched listings and slicers."""

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallwise import fixed_values as V
from stallwise.operators.measures import measures
from stallwise.operators.ranking import top_k

Slicers = Mapping[str, object] | None


def kpi_row(enriched: DataFrame, slicers: Slicers = None) -> DataFrame:
    names = ["total_restaurants", "average_cost_kpi", "average_rating_kpi",
             "pure_veg_share", "total_reviews_formatted"]
    return measures(enriched, names, slicers=slicers)


def _largest(enriched: DataFrame, key: str, top: int, slicers: Slicers) -> DataFrame:
    counts = measures(enriched, ["total_restaurants"], [key], slicers)
    return top_k(counts, top, F.desc("total_restaurants"), F.asc(key))


def top_cities(enriched: DataFrame, top: int = V.REPORT_TOP, slicers: Slicers = None) -> DataFrame:
    return _largest(enriched, "city", top, slicers)


def veg_split(enriched: DataFrame, slicers: Slicers = None) -> DataFrame:
    return measures(enriched, ["total_restaurants"], ["veg_category"], slicers)


def city_scatter(enriched: DataFrame, slicers: Slicers = None) -> DataFrame:
    names = ["average_cost_for_two", "average_rating", "total_review_volume"]
    return measures(enriched, names, ["city"], slicers)


def top_cuisines(enriched: DataFrame, top: int = V.REPORT_TOP, slicers: Slicers = None) -> DataFrame:
    return _largest(enriched, "primary_cuisine", top, slicers)


def kitchen_models(enriched: DataFrame, slicers: Slicers = None) -> DataFrame:
    return measures(enriched, ["average_rating", "total_review_volume"], ["kitchen_model"], slicers)


def cuisine_table(enriched: DataFrame, slicers: Slicers = None) -> DataFrame:
    names = ["total_restaurants", "average_cost_for_two", "average_rating", "promo_penetration"]
    return measures(enriched, names, ["primary_cuisine"], slicers)


def promotion_tiers(enriched: DataFrame, slicers: Slicers = None) -> DataFrame:
    return measures(enriched, ["average_reviews", "average_rating"], ["promotional_tier"], slicers)


def price_tiers(enriched: DataFrame, slicers: Slicers = None) -> DataFrame:
    """Tiers in the order of their sort key."""
    keys = ["price_tier", "price_tier_sort"]
    rows = measures(enriched, ["average_rating", "total_review_volume"], keys, slicers)
    return rows.orderBy(F.asc("price_tier_sort"))


def chains(enriched: DataFrame, top: int = V.REPORT_TOP, slicers: Slicers = None) -> DataFrame:
    names = ["cities_present", "average_rating", "average_cost_for_two", "total_review_volume"]
    rows = measures(enriched, names + ["total_restaurants"], ["restaurant_name"], slicers)
    order = (F.desc("cities_present"), F.desc("total_restaurants"), F.asc("restaurant_name"))
    return top_k(rows, top, *order).drop("total_restaurants")
