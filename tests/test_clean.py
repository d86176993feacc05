import random
import re

import pytest
from pyspark.sql import functions as F

from stallwise import fixed_values as V
from stallwise.functions import text as X

from stallwise import jobs
from stallwise.operators import clean as C
from stallwise.operators import contract
from stallwise.operators.quality import null_profile
from stallwise.plans import quality_reports as Q
from stallwise.sources import store
from stallwise.sources.binding import raw_listings
from conftest import SMALL


def cleaned(raw, column, values, **others):
    """Clean values of one raw column, in input order (the name carries the order)."""
    rows = [{column: value, "restaurant_name": f"{i:03d}"} | others for i, value in enumerate(values)]
    return C.clean_listings(raw(*rows)).orderBy("restaurant_name").collect()


@pytest.mark.parametrize(
    "text, count",
    [
        ("100+ ratings", 100.0),
        ("1K+ ratings", 1000.0),
        ("1.5k", 1500.0),
        ("1 rating", 1.0),
        ("Too Few Ratings", None),
        ("too few ratings", None),
        ("1,000 ratings", None),
        ("abc", None),
        ("1_000 ratings", 1000.0),
        ("_1", None),
        (" 2 K ", 2000.0),
        ("4.2f", None),
        ("", None),
        (None, None),
    ],
)
def test_rating_count(raw, text, count):
    assert cleaned(raw, "rating_count_raw", [text])[0].rating_count == count


def test_rating_and_status(raw):
    cases = [
        (None, "Unrated", None),
        ("--", "Unrated", None),
        (" -- ", "Rated", None),
        ("NEW", "New", None),
        (" new ", "New", None),
        ("abc", "Rated", None),
        ("4.2", "Rated", 4.2),
        (" 4.2 ", "Rated", 4.2),
        ("4.125", "Rated", 4.12),
        ("4.135", "Rated", 4.14),
        ("4.2d", "Rated", None),
        ("0x1p3", "Rated", None),
        ("1e1", "Rated", 10.0),
        (".5", "Rated", 0.5),
    ]
    rows = cleaned(raw, "rating_raw", [text for text, _, _ in cases])
    assert [(r.rating_status, r.rating) for r in rows] == [(s, v) for _, s, v in cases]


def test_price(raw):
    cases = {
        "₹250 for two": 250,
        "₹1,250 for two": 1,
        "₹199246 for two": 199,
        "₹50000": 50000,
        "₹50001": 500,
        "₹00250": 250,
        "free": None,
    }
    rows = cleaned(raw, "cost_for_two_raw", list(cases))
    assert [r.cost_for_two for r in rows] == list(cases.values())


def test_price_without_digits_breaks_the_contract(raw):
    with pytest.raises(contract.ContractError) as error:
        contract.require(C.clean_listings(raw({"cost_for_two_raw": "free"})))
    assert error.value.counts == {"cost_for_two_missing": 1}


def test_cuisine(raw):
    cases = {
        None: ("Unknown", "Unknown", 0),
        "": ("Unknown", "Unknown", 0),
        " , ": ("Unknown", "Unknown", 0),
        ",,": ("Unknown", "Unknown", 0),
        "nan": ("Unknown", "Unknown", 0),
        "Unknown": ("Unknown", "Unknown", 0),
        "A ,B,, C": ("A, B, C", "A", 3),
        " ,North  Indian ,\t ,Thai, ": ("North  Indian, Thai", "North  Indian", 2),
        "Unknown, Thai": ("Unknown, Thai", "Unknown", 2),
        "Thai": ("Thai", "Thai", 1),
    }
    rows = cleaned(raw, "cuisine", list(cases))
    assert [(r.cuisine, r.primary_cuisine, r.cuisine_count) for r in rows] == list(cases.values())


def test_area(raw):
    cases = {None: "Pune", "  ": "", "nan": "Pune", " nan ": "Pune", " North ": "North", " East ": "East"}
    assert [r.area for r in cleaned(raw, "area", list(cases))] == list(cases.values())


def test_missing_location_stays_missing(raw):
    row = cleaned(raw, "location", [" nan "], area=None)[0]
    assert (row.location, row.area) == (None, None)


def test_veg(raw):
    cases = {"Yes": True, " yes ": True, "YES": True, "No": False, "y": False, None: False}
    assert [r.is_pure_veg for r in cleaned(raw, "pure_veg_raw", list(cases))] == list(cases.values())


def test_offer_count(raw):
    cases = {None: 0, 2.7: 2, 0.0: 0, 3.0: 3}
    assert [r.offer_count for r in cleaned(raw, "offer_count", list(cases))] == list(cases.values())


def test_offer_name(raw):
    cases = {
        None: "No Offer",
        "  ": "No Offer",
        "\r\n": "No Offer",
        "a\r\n\n b ": "a | b",
        " a  b ": "a  b",
        "\na\r  \r b\n": "a | b",
    }
    rows = cleaned(raw, "offer_name_raw", list(cases), offer_count=0.0)
    assert [r.offer_name for r in rows] == list(cases.values())


def test_duplicates(raw):
    same = {"restaurant_name": "A", "cuisine": None, "offer_count": None}
    rows = raw(same, same, {"restaurant_name": "A "}, {"restaurant_name": "A"})
    assert C.duplicate_count(rows).first().duplicate_rows == 1
    assert C.clean_listings(rows).count() == 3


def test_corrections_and_imputations(raw):
    rows = raw({"cost_for_two_raw": "₹199246 for two"}, {"area": None, "cuisine": " nan "})
    assert [tuple(r) for r in C.price_corrections(rows).collect()] == [("Cafe", "Pune", 199246, 199)]
    assert tuple(C.imputed_counts(rows).first()) == (1, 1)


def test_warehouse_rating_rounds_half_away_and_overflow_stops(clean):
    rows = C.to_warehouse(clean({"rating": 4.25}, {"rating": 4.24}, {"rating": 99.94}))
    assert sorted(str(r.rating) for r in rows.collect()) == ["4.2", "4.3", "99.9"]
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        C.to_warehouse(clean({"rating": 99.96})).collect()


def test_copies_of_raw_rows_change_nothing(spark):
    rows = raw_listings(spark, SMALL)
    once, thrice = C.clean_listings(rows), C.clean_listings(rows.unionAll(rows).unionAll(rows))
    assert once.exceptAll(thrice).isEmpty() and thrice.exceptAll(once).isEmpty()


def test_a_third_of_all_rows_may_be_one_listing(spark, raw):
    hot = raw({}).crossJoin(spark.range(20000)).drop("id")
    others = raw({}).crossJoin(spark.range(40000)).withColumn("Area", F.col("id").cast("string")).drop("id")
    assert C.clean_listings(hot.unionAll(others)).count() == 40001


def random_texts(pieces, seed):
    pick = random.Random(seed)
    return ["".join(pick.choices(pieces, k=pick.randrange(14))) for _ in range(1500)]


def test_every_kind_of_blank_is_stripped(spark):
    texts = random_texts([*V.BLANKS, "a", "é", "ab"], 1)
    rows = spark.createDataFrame(list(enumerate(texts)), "i long, t string").select(X.strip(F.col("t")), "t")
    assert all(got == text.strip() for got, text in rows.collect())


def test_lists_against_plain_text_handling(spark):
    texts = random_texts([*V.BLANKS, ",", ",", ",", "a", "₹", "b c", "Unknown"], 2)
    frame = spark.createDataFrame(list(enumerate(texts)), "i long, t string")
    for got, text in frame.select(X.comma_list(F.col("t")), "t").collect():
        items = [*filter(None, map(str.strip, text.split(",")))]
        assert got == (", ".join(items) or None)


def test_lines_against_plain_text_handling(spark):
    texts = random_texts([*V.BLANKS, "\r\n", "\n", "\r", "a", "₹", "b c", "|"], 3)
    frame = spark.createDataFrame(list(enumerate(texts)), "i long, t string")
    for got, text in frame.select(X.lines_to_one(F.col("t")), "t").collect():
        lines = [*filter(None, map(str.strip, text.replace("\r", "\n").split("\n")))]
        assert got == (" | ".join(lines) or None)


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_cleaning_is_one_shuffle_after_merging_copies(spark, tmp_path):
    raw_listings(spark, SMALL).write.parquet(str(tmp_path / "raw"))
    stored = spark.read.parquet(str(tmp_path / "raw"))
    plan = plan_of(C.clean_listings(stored))
    assert plan.count("Exchange") == 1 and plan.count("HashAggregate") == 2
    assert not re.search("SortAggregate|Sort \\[|Python", plan)


def test_conditions_on_raw_columns_are_applied_before_the_shuffle(spark, tmp_path):
    raw_listings(spark, SMALL).write.parquet(str(tmp_path / "raw"))
    stored = spark.read.parquet(str(tmp_path / "raw"))
    for frame in (C.price_corrections(stored), C.imputed_counts(stored)):
        plan = plan_of(frame)
        assert plan.rindex("Filter") > plan.rindex("Exchange")


def test_figures_beside_the_rows(spark, raw, tmp_path):
    rows = raw(
        {}, {}, {}, {"area": None, "offer_name_raw": None}, {"area": "  ", "cuisine": None}, {"cost_for_two_raw": "₹199246"},
        {"cost_for_two_raw": "₹199246"}, {"rating_raw": None, "offer_count": None, "location": "Goa"},
    )
    stored = store.write_store(C.clean_with_figures(rows), str(tmp_path / "out"))
    got = {name: sorted(map(tuple, frame.collect()), key=repr) for name, frame in jobs.cleaning_figures(spark, stored).items()}
    clean = C.clean_listings(rows)
    want = {
        "row_counts": Q.row_counts(rows, clean), "duplicates": C.duplicate_count(rows), "raw_nulls": null_profile(rows, 2),
        "price_corrections": C.price_corrections(rows), "imputed": C.imputed_counts(rows),
    }
    assert got == {name: sorted(map(tuple, frame.collect()), key=repr) for name, frame in want.items()}
    assert {k: f.dtypes for k, f in jobs.cleaning_figures(spark, stored).items()} == {k: f.dtypes for k, f in want.items()}
    assert sorted(map(tuple, jobs.open_clean(spark, stored).collect()), key=repr) == sorted(map(tuple, clean.collect()), key=repr)
    plan = jobs.cleaning_figures(spark, stored)["price_corrections"]._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(price_before)" in plan and "Exchange" not in plan


def test_figures_of_an_empty_file(spark, raw, tmp_path):
    stored = store.write_store(C.clean_with_figures(raw({}).filter("1 = 0")), str(tmp_path / "out"))
    figures = jobs.cleaning_figures(spark, stored)
    assert figures["duplicates"].first()[0] == 0 and tuple(figures["imputed"].first()) == (0, 0)
    assert {r["null_count"] for r in figures["raw_nulls"].collect()} == {0}
