import pandas as pd
import pytest
from pyspark.sql import functions as F

from stallwise import fixed_values as V
from stallwise.operators.clean import to_warehouse
from stallwise.operators.measures import MEASURES, measures
from stallwise.plans import business_reports as B
from stallwise.plans import exploration_reports as E
from stallwise.plans import quality_reports as Q
from stallwise.plans import views
from stallwise.sources import store
from conftest import SMALL


def test_shares_add_up_and_order_does_not_matter(spark):
    listings = store.warehouse_table(spark, SMALL)
    everything = B.q05_dominant_cuisines(listings, top=1000)
    again = B.q05_dominant_cuisines(listings.repartition(9, "area"), top=1000)
    assert everything.collect() == again.collect()
    rows = everything.agg(F.sum("cuisine_share_pct"), F.sum("outlet_count")).first()
    assert rows[0] == pytest.approx(100, abs=0.5) and rows[1] == listings.count()


def test_bins_and_rest_make_the_whole(spark):
    clean = store.clean_table(spark, SMALL)
    binned = E.e04_price_bins(clean).agg(F.sum("count")).first()[0]
    outside = clean.filter((F.col("cost_for_two") <= 0) | (F.col("cost_for_two") > 10000)).count()
    assert binned + outside == clean.count()


def test_empty_bins_stay(clean):
    rows = E.e03_rating_bins(clean({"rating": 3.0}, {"rating": 3.5}, {"rating": 0.0}, {"rating": 5.1})).collect()
    assert [(r.band, r["count"], r.pct_share) for r in rows] == [
        ("< 3.0", 1, 50.0), ("3.0 - 3.4", 1, 50.0), ("3.5 - 3.9", 0, 0.0), ("4.0 - 4.4", 0, 0.0), ("4.5 - 5.0", 0, 0.0),
    ]
    by_price = E.e05_rating_by_price(clean({"rating": 4.0}, {"rating": 3.9})).collect()
    assert [tuple(r)[2:] for r in by_price] == [
        (0, None, None, None), (2, 3.95, 3.95, 50.0), (0, None, None, None), (0, None, None, None), (0, None, None, None),
    ]


def test_rating_summary_without_ratings(clean):
    assert set(E.e03_rating_summary(clean({"rating": None})).first()) == {None}


def test_city_score_against_pandas(spark, clean):
    rows = store.clean_table(spark, SMALL)
    pdf = rows.toPandas()
    cities = pdf.groupby("location").agg(
        n=("restaurant_name", "count"), r=("rating", "mean"), k=("rating_count", "mean"),
        m=("cost_for_two", "median"), o=("offer_count", "mean"),
    )
    cities = cities[cities.n >= 500]
    scaled = (cities - cities.min()) / (cities.max() - cities.min())
    cities["score"] = (scaled.r * 0.35 + scaled.k * 0.30 + scaled.n * 0.20 + scaled.o * 0.15) * 100
    expected = cities.sort_values("score", ascending=False).round(2)
    got = E.e10_city_score(rows).collect()
    assert [r.location for r in got] == expected.index.tolist()
    assert [r.composite_score for r in got] == pytest.approx(expected.score.tolist())


def test_city_score_with_equal_cities_is_null(clean):
    rows = clean({"location": "A"}, {"location": "B"}, {"location": None})
    got = E.e10_city_score(rows, min_listings=1).collect()
    assert [(r.location, r.composite_score) for r in got] == [("A", None), ("B", None)]


def test_high_share_counts_unrated_listings_in_the_base(clean):
    counted = clean({"rating": 5.0}, {"rating": None}).agg(
        F.count_if(F.col("rating") >= V.HIGH_RATED) / F.count("*")
    )
    assert counted.first()[0] == 0.5


def test_metro_top_missing_rating_ranks_first(clean):
    rows = to_warehouse(clean(
        {"restaurant_name": "none", "rating": None, "rating_count": 50.0},
        {"restaurant_name": "best", "rating": 5.0},
        {"restaurant_name": "tied", "rating": 5.0},
        {"restaurant_name": "few", "rating": 5.0, "rating_count": 49.0},
        {"restaurant_name": "third", "rating": 4.0},
        {"restaurant_name": "fourth", "rating": 3.0},
        {"restaurant_name": "elsewhere", "location": "Goa"},
    ))
    got = B.q10_metro_top(rows, cities=["Pune"]).collect()
    assert sorted((r.city_rank, r.restaurant_name) for r in got) == [
        (1, "none"), (2, "best"), (2, "tied"), (3, "third"),
    ]


def test_quadrant_borders(clean):
    rows = to_warehouse(clean(
        {"rating": 4.0, "cost_for_two": 200}, {"rating": 4.0, "cost_for_two": 300},
        {"rating": 4.0, "cost_for_two": 400}, {"rating": None, "cost_for_two": 1},
    ))
    got = {r.strategic_quadrant[0]: r.restaurant_count for r in B.q14_quadrants(rows).collect()}
    assert got == {"1": 1, "2": 2}


def test_default_cities_and_thresholds(clean):
    rows = to_warehouse(clean({"location": "Mumbai"}, {"location": "Elsewhere"}))
    assert [r.location for r in B.q03_city_top_cuisine(rows).collect()] == ["Mumbai"]
    assert B.q02_veg_penetration(rows).isEmpty()


def test_executive_figures(clean):
    rows = to_warehouse(clean({"cost_for_two": 100}, {"cost_for_two": 200, "is_pure_veg": True}, {"cost_for_two": 201}))
    row = Q.executive_kpis(rows).first()
    assert (row.outlets, row.mean_cost, row.median_cost, row.mean_rating, row.veg_pct) == (3, 167.0, 200.0, 4.2, 33.3)


# Measures


@pytest.fixture
def enriched(clean):
    def build(*changes):
        return views.listings_enriched(to_warehouse(clean(*changes)))

    return build


def test_all_measures_of_nothing(enriched):
    row = measures(enriched({}), list(MEASURES), slicers={"city": "nowhere"}).first().asDict()
    assert row["total_restaurants"] == 0 and row["average_rating"] is None
    assert row["average_rating_kpi"] == "N/A" and row["pure_veg_share"] == 0.0
    assert row["national_avg_rating"] == pytest.approx(4.2) and row["discount_review_lift"] == 0.0


def test_slicers_do_not_touch_benchmarks(enriched):
    frame = enriched({"location": "A", "rating": 5.0}, {"location": "B", "rating": 3.0})
    names = ["average_rating", "national_avg_rating", "rating_vs_national", "rating_variance_indicator"]
    assert tuple(measures(frame, names, slicers={"city": "A"}).first()) == (5.0, 4.0, 1.0, "▲ +1.00 vs National Avg")


def test_unrated_group_differs_from_the_benchmark_by_all_of_it(enriched):
    frame = enriched({"location": "A", "rating": None}, {"location": "B", "rating": 3.0})
    got = {r.city: r.rating_vs_national for r in measures(frame, ["rating_vs_national"], by=["city"]).collect()}
    assert got == {"A": -3.0, "B": 0.0}


def test_measure_filter_replaces_slicer_and_group_on_its_column(enriched):
    frame = enriched(
        {"location": "A", "is_pure_veg": True}, {"location": "A", "is_pure_veg": True},
        {"location": "A", "is_pure_veg": False}, {"location": "B", "is_pure_veg": False},
    )
    names = ["total_restaurants", "pure_veg_restaurants"]
    assert tuple(measures(frame, names, slicers={"is_pure_veg": False}).first()) == (2, 2)
    assert tuple(measures(frame, names, slicers={"veg_category": V.NON_VEG_LABEL}).first()) == (2, 0)
    by = measures(frame, names, by=["city", "is_pure_veg"]).collect()
    assert sorted(map(tuple, by)) == [("A", False, 1, 2), ("A", True, 2, 2), ("B", False, 1, 0)]


def test_group_with_missing_key_keeps_its_replaced_measure(enriched):
    frame = enriched({"location": None, "area": "x", "offer_count": 0}, {"location": None, "area": "x", "offer_count": 3})
    got = measures(frame, ["restaurants_with_deals"], by=["city", "offer_count"]).collect()
    assert sorted(r.restaurants_with_deals for r in got) == [1, 1]


def test_lift_with_a_missing_side(enriched):
    frame = enriched(
        {"location": "A", "offer_count": 0}, {"location": "B", "offer_count": 3},
        {"location": "C", "offer_count": 0}, {"location": "C", "offer_count": 4, "rating_count": 150.0},
    )
    got = {r.city: r.discount_review_lift for r in measures(frame, ["discount_review_lift"], by=["city"]).collect()}
    assert got == {"A": -1.0, "B": 0.0, "C": 0.5}


def test_titles(enriched):
    frame = enriched({"location": "A"}, {"location": "B", "primary_cuisine": "Thai"})
    assert tuple(measures(frame, ["city_title", "cuisine_title"]).first()) == (
        V.CITY_TITLE_ALL, "Deep Dive Analysis: Thai Category",
    )
    one = measures(frame, ["city_title"], slicers={"city": ["A"]}).first()
    assert one.city_title == "Market Intelligence Deep Dive — A"


def test_slicer_on_missing_values(enriched):
    frame = enriched({"rating": None}, {"rating": 4.0}, {"rating": 3.0})
    assert measures(frame, ["total_restaurants"], slicers={"rating": [None, 4.0]}).first()[0] == 2


def test_published_lift_formula(spark):
    rows = pd.DataFrame({"tier": ["3+", "none"], "reviews": [581.0, 399.0]})
    from stallwise.operators.segments import lift

    assert lift(spark.createDataFrame(rows), "tier", "3+", "none", "reviews").first().lift_pct == 45.6
