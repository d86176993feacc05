import random

import pytest
from pyspark.sql import functions as F

from stallwise.operators.clean import to_warehouse
from stallwise.plans import views
from stallwise.sources import view_state


def rows_of(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def changes(pick, n):
    return [
        {
            "location": pick.choice(["Pune", "Goa", None]), "primary_cuisine": pick.choice(["Thai", "Grill", "Cafe"]),
            "rating": pick.choice([None, 3.5, 4.25, 4.9]), "rating_count": pick.choice([None, 100.0, 1500.0]),
            "cost_for_two": pick.randrange(100, 900), "is_pure_veg": pick.random() < 0.4, "offer_count": pick.randrange(4),
        }
        for _ in range(n)
    ]


@pytest.mark.parametrize("merge_at", [1, 3, 100])
def test_state_equals_the_views_over_all_rows(spark, clean, tmp_path, merge_at):
    pick = random.Random(merge_at)
    state, there = view_state.ViewState(spark, str(tmp_path / "s"), merge_at), []
    for step in range(5):
        new = changes(pick, 25)
        gone = [there.pop(pick.randrange(len(there))) for _ in range(min(len(there), 12))]
        there += new
        frames = to_warehouse(clean(*new)), to_warehouse(clean(*gone)) if gone else None
        assert state.apply(f"b{step}", *frames) and not state.apply(f"b{step}", *frames)
    everything = to_warehouse(clean(*there))
    assert rows_of(state.city_summary()) == rows_of(views.city_summary(everything))
    assert state.city_summary().dtypes == views.city_summary(everything).dtypes
    assert rows_of(state.cuisine_matrix(3)) == rows_of(views.cuisine_matrix(everything, 3))
    assert state.cuisine_matrix(3).dtypes == views.cuisine_matrix(everything, 3).dtypes
    assert len(state._now()["parts"]) <= merge_at


def test_a_cuisine_goes_with_its_last_listing(spark, clean, tmp_path):
    state = view_state.ViewState(spark, str(tmp_path / "s"))
    thai, grill = to_warehouse(clean({})), to_warehouse(clean({"primary_cuisine": "Grill", "location": "Goa"}))
    state.apply("a", thai.unionByName(thai).unionByName(grill))
    state.apply("b", deleted=grill)
    assert [(r.city, r.total_restaurants, r.unique_cuisines_count) for r in state.city_summary().collect()] == [("Pune", 2, 1)]
    state.apply("c", deleted=thai.unionByName(thai))
    assert state.city_summary().count() == 0 == state.cuisine_matrix(0).count()


def test_reading_does_not_touch_listings_and_a_dead_batch_leaves_nothing(spark, clean, tmp_path):
    state = view_state.ViewState(spark, str(tmp_path / "s"))
    state.apply("a", to_warehouse(clean({}, {})))
    dies = to_warehouse(clean({}, {"area": "x"})).withColumn(
        "offer_count", F.when(F.col("area") == "x", F.raise_error(F.lit("killed")).cast("int")).otherwise(F.col("offer_count"))
    )
    with pytest.raises(Exception, match="killed"):
        state.apply("b", dies)
    assert state.city_summary().first().total_restaurants == 2
    assert state.apply("b", to_warehouse(clean({})))
    files = state.city_summary().inputFiles()
    assert files and all("/parts/" in file for file in files)


def test_an_empty_state(spark, tmp_path):
    state = view_state.ViewState(spark, str(tmp_path / "s"))
    assert state.city_summary().count() == 0 == state.cuisine_matrix().count()
