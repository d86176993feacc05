from decimal import ROUND_HALF_UP, Decimal

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stallwise import fixed_values as V
from stallwise.functions import bands, formats
from stallwise.functions.numeric import half_up, mean_rating, rating_total, round_even


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(-(10**15), 10**15), st.integers(1, 10**13)), min_size=1, max_size=40))
def test_half_up_is_exact(spark, pairs):
    pairs += [(1, 8), (5, 1000), (-1, 8), (12345, 1000), (10**12 * 5 + 1, 10**13)]
    frame = spark.createDataFrame(pairs, "a long, b long")
    for places in (0, 1, 2):
        got = [r[0] for r in frame.select(half_up(F.col("a"), F.col("b"), places)).collect()]
        step = Decimal(1).scaleb(-places)
        from fractions import Fraction

        for value, (a, b) in zip(got, pairs):
            scaled = abs(Fraction(a, b)) * 10**places
            steps = int(scaled + Fraction(1, 2))
            assert value == float(Decimal(steps if a >= 0 else -steps) * step)


def test_half_up_without_denominator(spark):
    assert spark.range(1).select(half_up(F.lit(1), F.lit(0), 2)).first()[0] is None


def test_exact_mean_of_tenths(spark):
    values = [Decimal(v) for v in ("3.7", "3.8", "3.7", "3.8", "3.7", "3.8", "3.7", "3.8")]
    frame = spark.createDataFrame([(v,) for v in values] + [(None,)], "rating decimal(3,1)")
    expected = (sum(values) / len(values)).quantize(Decimal("0.01"), ROUND_HALF_UP)
    assert frame.agg(mean_rating(F.col("rating"), 2)).first()[0] == float(expected)


def test_rating_totals_have_room_for_a_trillion_rows(spark):
    frame = spark.createDataFrame([(Decimal("4.9"),)], "rating decimal(3,1)")
    total = frame.agg(rating_total(F.col("rating")).alias("total"))
    assert total.dtypes == [("total", "decimal(18,1)")]
    # Kept as a whole number while summing.
    assert "UnscaledValue" in total._jdf.queryExecution().optimizedPlan().toString()


def test_round_even(spark):
    frame = spark.createDataFrame([(0.125,), (2.5,), (0.135,)], "x double")
    assert [r[0] for r in frame.select(round_even(F.col("x"), 2)).collect()] == [0.12, 2.5, 0.14]
    assert [r[0] for r in frame.select(round_even(F.col("x"), 0)).collect()] == [0.0, 2.0, 0.0]


def labels(spark, column, values, kind):
    frame = spark.createDataFrame([(v,) for v in values], f"v {kind}")
    return [r[0] for r in frame.select(column).collect()]


@pytest.mark.parametrize("tiers", [V.REPORT_PRICE_TIERS, V.VIEW_PRICE_TIERS])
def test_price_tiers(spark, tiers):
    names = [t[0] for t in tiers]
    got = labels(spark, bands.tier(F.col("v"), tiers), [0, 199, 200, 400, 401, 700, 701, None], "int")
    assert got == [names[i] for i in (0, 0, 1, 1, 2, 2, 3, 3)]
    assert labels(spark, bands.tier(F.col("v"), tiers, ranks=True), [199, 200, 401, 701], "int") == [1, 2, 3, 4]


@pytest.mark.parametrize("tiers", [V.REPORT_MENU_MODELS, V.VIEW_KITCHEN_MODELS])
def test_menu_models(spark, tiers):
    names = [t[0] for t in tiers]
    got = labels(spark, bands.tier(F.col("v"), tiers), [0, 1, 2, 4, 5], "int")
    assert got == [names[i] for i in (2, 0, 1, 1, 2)]


@pytest.mark.parametrize("tiers", [V.REPORT_PROMO_TIERS, V.VIEW_PROMO_TIERS])
def test_promo_tiers(spark, tiers):
    names = [t[0] for t in tiers]
    assert labels(spark, bands.tier(F.col("v"), tiers), [0, 1, 2, 3], "int") == [names[i] for i in (0, 1, 1, 2)]


def test_rating_tiers(spark):
    ratings = [Decimal(v) for v in ("4.5", "4.4", "4.0", "3.9", "3.5", "3.4")] + [None]
    names = [label for label, _ in V.VIEW_RATING_TIERS] + [V.VIEW_RATING_NONE]
    got = labels(spark, bands.rating_tier(F.col("v")), ratings, "decimal(3,1)")
    assert got == [names[i] for i in (0, 1, 1, 2, 2, 3, 4)]
    ranks = labels(spark, bands.rating_tier(F.col("v"), ranks=True), ratings, "decimal(3,1)")
    assert ranks == [1, 2, 2, 3, 3, 4, 5]


@pytest.mark.parametrize("bins", [V.RATING_BINS, V.PRICE_BINS, V.POPULARITY_BINS])
def test_bins_are_right_closed(spark, bins):
    edges = [low for _, low, _ in bins] + [bins[-1][2]]
    values = [float(v) for e in edges for v in (e - 0.01, e, e + 0.01)]
    got = labels(spark, bands.bin_order(F.col("v"), bins), values, "double")
    cut = pd.cut(pd.Series(values), bins=edges, labels=range(1, len(bins) + 1))
    assert got == [None if pd.isna(c) else int(c) for c in cut]


def test_display_texts(spark):
    volumes = labels(spark, formats.review_volume(F.col("v")), [58_010_000.0, 1500.0, 999.0, 0.0, None], "double")
    assert volumes == ["58.0M Reviews", "1.5K Reviews", "999 Reviews", "0 Reviews", " Reviews"]
    assert labels(spark, formats.rating_card(F.col("v")), [4.035, None], "double") == ["4.04 ⭐", "N/A"]
    assert labels(spark, formats.cost_card(F.col("v")), [268.5, 1234567.0, None], "double") == ["₹269", "₹1,234,567", "₹"]
    notes = labels(spark, formats.variance_note(F.col("v")), [0.126, -0.126, 0.0, None], "double")
    assert notes == [
        "▲ +0.13 vs National Avg", "▼ -0.13 vs National Avg", "▲ +0.00 vs National Avg", "▲ + vs National Avg",
    ]
