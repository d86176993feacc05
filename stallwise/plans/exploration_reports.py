"""The exploration reports over the clean table (two-decimal ratings, half-even rounding)."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallwise import fixed_values as V
from stallwise.functions import bands
from stallwise.functions.numeric import hundredths, percent, ratio, round_even
from stallwise.operators import ranking as R
from stallwise.operators import segments as G
from stallwise.operators import stats as S


def _rating() -> Column:
    return hundredths(F.col("rating")).alias("r100")


def _cost() -> Column:
    return F.col("cost_for_two").cast("long").alias("cost")


def _scaled(bins) -> list[tuple[str, int, int]]:
    """Rating bins in hundredths, so that edges compare as whole numbers."""
    return [(label, round(low * 100), round(high * 100)) for label, low, high in bins]


def _mean(total: Column, size: Column, places: int = 2) -> Column:
    return round_even(ratio(total, size), places)


def e01_top_locations(clean: DataFrame, top: int = V.LOCATION_TOP) -> DataFrame:
    """Largest locations with their share and the running share."""
    counts = G.value_counts(clean, "location", "restaurant_count")
    order = [F.desc("restaurant_count"), F.asc("location")]
    largest = R.top_k(G.with_row_total(counts, clean), top, *order)
    running = R.running_percent(largest, order, "restaurant_count", "total_rows", "cumulative_pct")
    share = percent(F.col("restaurant_count"), F.col("total_rows"), 2)
    shown = running.select("location", "restaurant_count", share.alias("pct_share"), "cumulative_pct")
    return shown.orderBy(*order)


def e01_unique_locations(clean: DataFrame) -> DataFrame:
    return clean.agg(F.countDistinct("location").alias("unique_locations"))


def e02_primary_cuisines(clean: DataFrame, top: int = V.REPORT_TOP) -> DataFrame:
    counts = G.value_counts(clean, "primary_cuisine", "outlet_count")
    shared = G.with_percent(counts, clean, "outlet_count", "pct_share")
    return R.top_k(shared, top, F.desc("outlet_count"), F.asc("primary_cuisine"))


def e02_all_cuisines(clean: DataFrame, top: int = V.REPORT_TOP) -> DataFrame:
    """Cuisines anywhere on the menu; the share is of listings, not of menu entries."""
    # Equal menus merge first, so only distinct menus are split into entries.
    menus = G.value_counts(clean, "cuisine", "menus")
    entries = menus.select(F.explode(F.split("cuisine", ", ")).alias("cuisine_item"), "menus")
    counts = entries.groupBy("cuisine_item").agg(F.sum("menus").alias("total_listings_offering"))
    shared = G.with_percent(counts, clean, "total_listings_offering", "pct_of_all_restaurants")
    return R.top_k(shared, top, F.desc("total_listings_offering"), F.asc("cuisine_item"))


def e03_rating_summary(clean: DataFrame) -> DataFrame:
    row = S.summary(clean, _rating(), 100, 2)
    return row.select("mean", "median", "mode", "std", "q1", "q3")


def _bin_distribution(clean: DataFrame, value: Column, bins) -> DataFrame:
    """Rows and share per bin, empty bins included; the share is of the binned rows."""
    binned = clean.select(bands.bin_order(value, bins).alias("bin_order"))
    per_bin = G.value_counts(binned, "bin_order", "count")
    filled = bands.fill_bins(clean.sparkSession, bins, per_bin, ["count"])
    total = per_bin.agg(F.sum("count").alias("binned"))
    share = percent(F.col("count"), F.col("binned"), 2)
    shown = filled.crossJoin(F.broadcast(total)).select("bin_order", "band", "count", share.alias("pct_share"))
    return shown.orderBy(F.asc("bin_order"))


def e03_rating_bins(clean: DataFrame) -> DataFrame:
    return _bin_distribution(clean, hundredths(F.col("rating")), _scaled(V.RATING_BINS))


def e04_price_summary(clean: DataFrame) -> DataFrame:
    row = S.summary(clean, _cost(), 1, 2)
    return row.select("mean", "median", "mode", "q1", "q3")


def e04_price_bins(clean: DataFrame) -> DataFrame:
    return _bin_distribution(clean, F.col("cost_for_two"), V.PRICE_BINS)


def e05_price_rating_correlation(clean: DataFrame) -> DataFrame:
    """Pearson and Spearman of cost and rating, listings that have both."""
    row = S.correlations(S.histogram(clean, _cost(), _rating()), "cost", "r100")
    return row.select(
        round_even(F.col("pearson"), 4).alias("pearson"), round_even(F.col("spearman"), 4).alias("spearman")
    )


def _rating_by_bin(rows: DataFrame, value: Column, bins) -> DataFrame:
    """Count, mean, median and share of well-rated listings per bin of another column."""
    order = bands.bin_order(value, bins).alias("bin_order")
    counts = S.histogram(rows, order, _rating())
    r100, n = F.col("r100"), F.col("n")
    size = F.sum("n")
    good = F.sum(F.when(r100 >= round(V.WELL_RATED * 100), n).otherwise(0))
    per_bin = counts.groupBy("bin_order").agg(
        size.alias("count"),
        round_even(ratio(F.sum(r100 * n), size * 100), 2).alias("mean"),
        round_even(S.quantile("r100", 0.5) / 100.0, 2).alias("median"),
        percent(good, size, 2).alias("pct_rated_4_plus"),
    )
    filled = bands.fill_bins(rows.sparkSession, bins, per_bin, ["count"])
    return filled.orderBy(F.asc("bin_order"))


def e05_rating_by_price(clean: DataFrame) -> DataFrame:
    rows = clean.na.drop(subset=["rating", "cost_for_two"])
    return _rating_by_bin(rows, F.col("cost_for_two"), V.PRICE_BINS)


def e06_rating_reviews_correlation(clean: DataFrame) -> DataFrame:
    both = clean.na.drop(subset=["rating", "rating_count"])
    return both.agg(round_even(F.corr("rating", "rating_count"), 4).alias("pearson"))


def e06_rating_by_popularity(clean: DataFrame) -> DataFrame:
    rows = clean.na.drop(subset=["rating", "rating_count"])
    return _rating_by_bin(rows, F.col("rating_count"), V.POPULARITY_BINS)


def e07_veg_comparison(clean: DataFrame) -> DataFrame:
    """Pure veg against the rest: one row per metric, one column per side."""
    # One pass: rows merge per (side, cost, rating), both medians come from there.
    cells = clean.groupBy("is_pure_veg", "cost_for_two", _rating()).agg(
        F.count("*").alias("n"),
        F.count("restaurant_name").alias("named"),
        F.sum("rating_count").alias("reviews"),
        F.count("rating_count").alias("reviewed"),
        F.sum("offer_count").alias("offers"),
    )
    cost, r100, n = F.col("cost_for_two"), F.col("r100"), F.col("n")
    rated = F.sum(F.when(r100.isNotNull(), n))
    priced = F.sum(F.when(cost.isNotNull(), n))
    sides = cells.groupBy("is_pure_veg").agg(
        F.sum("named").cast("double").alias("total_count"),
        F.sum("n").alias("rows"),
        _mean(F.sum(cost * n), priced).alias("avg_price"),
        round_even(S.quantile("cost_for_two", 0.5), 2).alias("median_price"),
        _mean(F.sum(r100 * n), rated * 100).alias("avg_rating"),
        round_even(S.quantile("r100", 0.5) / 100.0, 2).alias("median_rating"),
        _mean(F.sum("reviews"), F.sum("reviewed")).alias("avg_reviews"),
        _mean(F.sum("offers"), F.sum("n")).alias("avg_offers"),
    )
    shared = G.with_percent(sides, clean, "rows", "pct_share")
    metrics = ["total_count", "pct_share", "avg_price", "median_price",
               "avg_rating", "median_rating", "avg_reviews", "avg_offers"]
    long = shared.unpivot("is_pure_veg", metrics, "metric", "value")
    return long.groupBy("metric").agg(
        F.max(F.when(~F.col("is_pure_veg"), F.col("value"))).alias("non_veg"),
        F.max(F.when(F.col("is_pure_veg"), F.col("value"))).alias("pure_veg"),
    )


def e08_offer_distribution(clean: DataFrame) -> DataFrame:
    counts = G.value_counts(clean, "offer_count", "restaurants")
    return G.with_percent(counts, clean, "restaurants", "pct_share").orderBy("offer_count")


def e08_offer_share(clean: DataFrame) -> DataFrame:
    """Listings with at least one offer."""
    with_offer = F.count_if(F.col("offer_count") > 0)
    return clean.agg(
        with_offer.alias("restaurants_with_offer"), percent(with_offer, F.count("*"), 2).alias("pct_share")
    )


def _gold() -> Column:
    return (F.col("rating") >= V.GOLD_RATING) & (F.col("rating_count") >= V.GOLD_REVIEWS)


def e09_gold_share(clean: DataFrame) -> DataFrame:
    gold = F.count_if(_gold())
    return clean.agg(gold.alias("gold_count"), percent(gold, F.count("*"), 2).alias("pct_of_all"))


def e09_gold_top(clean: DataFrame, top: int = V.REPORT_TOP) -> DataFrame:
    """Best gold listings by rating, then reviews; ties by the remaining columns."""
    columns = ["restaurant_name", "location", "primary_cuisine", "rating", "rating_count", "cost_for_two"]
    rest = [F.asc(name) for name in ("restaurant_name", "location", "primary_cuisine", "cost_for_two")]
    gold = clean.filter(_gold()).select(*columns)
    return R.top_k(gold, top, F.desc("rating"), F.desc("rating_count"), *rest)


def e10_city_score(
    clean: DataFrame,
    min_listings: int = V.SCORE_CITY_MIN_LISTINGS,
    top: int = V.REPORT_TOP,
    weights: dict[str, float] | None = None,
) -> DataFrame:
    """Strongest cities by a weighted min-max score over four metrics."""
    # Rows merge per (city, cost) first: the median then needs only counts, and
    # a large city is spread over its cost values.
    cells = (
        clean.filter(F.col("location").isNotNull())
        .groupBy("location", "cost_for_two")
        .agg(
            F.count("*").alias("n"),
            F.count("restaurant_name").alias("named"),
            F.sum(_rating()).alias("ratings"),
            F.count("rating").alias("rated"),
            F.sum("rating_count").alias("reviews"),
            F.count("rating_count").alias("reviewed"),
            F.sum("offer_count").alias("offers"),
            F.count_if(F.col("rating") >= V.HIGH_RATED).alias("high"),
        )
    )
    cities = cells.groupBy("location").agg(
        F.sum("named").alias("total_restaurants"),
        ratio(F.sum("ratings"), F.sum("rated") * 100).alias("avg_rating"),
        (ratio(F.sum("high"), F.sum("n")) * 100.0).alias("pct_high_rated"),
        ratio(F.sum("reviews"), F.sum("reviewed")).alias("avg_reviews"),
        S.quantile("cost_for_two", 0.5).alias("median_cost"),
        ratio(F.sum("offers"), F.sum("n")).alias("avg_offers"),
    )
    large = cities.filter(F.col("total_restaurants") >= min_listings)
    scored = S.min_max_score(large, weights or V.CITY_SCORE_WEIGHTS, "composite_score")
    best = R.top_k(scored, top, F.desc("composite_score"), F.asc("location"))
    two = ["avg_rating", "avg_reviews", "median_cost", "composite_score"]
    return best.select("location", "total_restaurants", *[round_even(F.col(c), 2).alias(c) for c in two])
