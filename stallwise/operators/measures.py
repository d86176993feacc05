"""Measures with a filter context, over the enriched listings.

`measures(frame, names, by, slicers)` aggregates the visible rows: those the
slicers keep, grouped by `by`. A measure may carry a filter of its own on one
column. That filter takes the place of any slicer or grouping on the same
column and adds to the others. Benchmark measures look at the whole frame.
"""

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallwise import fixed_values as V
from stallwise.functions import formats
from stallwise.functions.numeric import rating_total, ratio


Restrict = Callable[[Column], Column]


@dataclass(frozen=True)
class Part:
    """One aggregate that measures are made of.

    `aggregate` gets a function that hides values outside the part's own
    filter. `column` is the column of that filter, `whole` marks a benchmark,
    `distinct` names a column whose distinct values are aggregated, not the rows.
    """

    aggregate: Callable[[Restrict], Column]
    column: str | None = None
    condition: Callable[[], Column] | None = None
    whole: bool = False
    distinct: str | None = None

    def expression(self) -> Column:
        if self.condition is None:
            return self.aggregate(lambda value: value)
        return self.aggregate(lambda value: F.when(self.condition(), value))


def _count(only: Restrict) -> Column:
    return F.count(only(F.lit(1)))


def _mean(name: str) -> Callable[[Restrict], Column]:
    return lambda only: ratio(F.sum(only(F.col(name))), F.count(only(F.col(name))))


def _mean_rating(only: Restrict) -> Column:
    rating = only(F.col("rating"))
    return ratio(rating_total(rating), F.count(rating))


def _only_value(name: str) -> Callable[[Restrict], Column]:
    """The single value among distinct values, else null."""
    return lambda only: F.when(F.count("*") == 1, F.min(name))


_VEG = {"column": "is_pure_veg", "condition": lambda: F.col("is_pure_veg")}
_UNRATED = {"column": "rating", "condition": lambda: F.col("rating").isNull()}
_DEALS = {"column": "offer_count", "condition": lambda: F.col("offer_count") > 0}
_AGGRESSIVE = {"column": "offer_count", "condition": lambda: F.col("offer_count") >= V.AGGRESSIVE_OFFERS}
_NO_DEALS = {"column": "offer_count", "condition": lambda: F.col("offer_count") == 0}

PARTS: dict[str, Part] = {
    "rows": Part(_count),
    "reviews": Part(lambda only: F.sum(only(F.col("review_count")))),
    "mean_reviews": Part(_mean("review_count")),
    "mean_rating": Part(_mean_rating),
    "mean_cost": Part(_mean("cost_for_two")),
    "cities": Part(lambda only: F.countDistinct(only(F.col("city")))),
    "only_city": Part(_only_value("city"), distinct="city"),
    "only_cuisine": Part(_only_value("primary_cuisine"), distinct="primary_cuisine"),
    "veg_rows": Part(_count, **_VEG),
    "unrated_rows": Part(_count, **_UNRATED),
    "deal_rows": Part(_count, **_DEALS),
    "aggressive_reviews": Part(_mean("review_count"), **_AGGRESSIVE),
    "no_deal_reviews": Part(_mean("review_count"), **_NO_DEALS),
    "national_rating": Part(_mean_rating, whole=True),
    "national_cost": Part(_mean("cost_for_two"), whole=True),
}


@dataclass(frozen=True)
class Measure:
    """A named value made of parts."""

    parts: tuple[str, ...]
    value: Callable[..., Column]


def _share(part: Column, rows: Column) -> Column:
    return F.coalesce(ratio(part, rows), F.lit(0.0))


def _lift(first: Column, second: Column) -> Column:
    """Relative difference; a missing first side counts as 0, without a second side there is no lift."""
    zero = F.lit(0.0)
    return F.coalesce(ratio(F.coalesce(first, zero) - second, second), zero)


def _difference(value: Column, benchmark: Column) -> Column:
    """A missing side counts as 0; null only when both are missing."""
    zero = F.lit(0.0)
    both_missing = value.isNull() & benchmark.isNull()
    return F.when(~both_missing, F.coalesce(value, zero) - F.coalesce(benchmark, zero))


def _same(value: Column) -> Column:
    return value


MEASURES: dict[str, Measure] = {
    "total_restaurants": Measure(("rows",), _same),
    "total_review_volume": Measure(("reviews",), _same),
    "total_reviews_formatted": Measure(("reviews",), formats.review_volume),
    "average_rating": Measure(("mean_rating",), _same),
    "average_rating_kpi": Measure(("mean_rating",), formats.rating_card),
    "average_cost_for_two": Measure(("mean_cost",), _same),
    "average_cost_kpi": Measure(("mean_cost",), formats.cost_card),
    "pure_veg_restaurants": Measure(("veg_rows",), _same),
    "pure_veg_share": Measure(("veg_rows", "rows"), _share),
    "unrated_restaurants": Measure(("unrated_rows",), _same),
    "cold_start_share": Measure(("unrated_rows", "rows"), _share),
    "restaurants_with_deals": Measure(("deal_rows",), _same),
    "promo_penetration": Measure(("deal_rows", "rows"), _share),
    "avg_reviews_aggressive_offers": Measure(("aggressive_reviews",), _same),
    "avg_reviews_no_offers": Measure(("no_deal_reviews",), _same),
    "discount_review_lift": Measure(("aggressive_reviews", "no_deal_reviews"), _lift),
    "national_avg_rating": Measure(("national_rating",), _same),
    "national_avg_cost": Measure(("national_cost",), _same),
    "rating_vs_national": Measure(("mean_rating", "national_rating"), _difference),
    "rating_variance_indicator": Measure(
        ("mean_rating", "national_rating"),
        lambda value, benchmark: formats.variance_note(_difference(value, benchmark)),
    ),
    "city_title": Measure(("only_city",), formats.city_title),
    "cuisine_title": Measure(("only_cuisine",), formats.cuisine_title),
    # Used by the dashboard pages, which do not define them elsewhere.
    "average_reviews": Measure(("mean_reviews",), _same),
    "cities_present": Measure(("cities",), _same),
}


def _slice(frame: DataFrame, slicers: Mapping[str, object]) -> DataFrame:
    """Keep the rows the slicers show; a slicer value is one value or a list, null included."""
    for name, chosen in slicers.items():
        single = isinstance(chosen, str) or not isinstance(chosen, Sequence)
        values = [chosen] if single else list(chosen)
        shown = F.col(name).isin(*[v for v in values if v is not None])
        frame = frame.filter(shown | F.col(name).isNull() if None in values else shown)
    return frame


def _attach(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Join aggregates on their keys; a right side without keys is one row."""
    if not keys:
        return left.crossJoin(F.broadcast(right))
    renamed = right.withColumnsRenamed({key: f"right_{key}" for key in keys})
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"right_{k}")) for k in keys])
    return left.join(renamed, same, "left").drop(*[f"right_{key}" for key in keys])


@dataclass(frozen=True)
class _Context:
    """Which rows a part looks at, beside the slicers and groups all parts share."""

    whole: bool = False
    replaced: str | None = None
    distinct: str | None = None


def _aggregate(
    frame: DataFrame, context: _Context, parts: list[str], by: Sequence[str], slicers: Mapping[str, object]
) -> tuple[DataFrame, list[str]]:
    """The parts of one context per group, and the group's keys."""
    kept = {} if context.whole else {k: v for k, v in slicers.items() if k != context.replaced}
    keys = [] if context.whole else [key for key in by if key != context.replaced]
    rows = _slice(frame, kept)
    if context.distinct:
        # Distinct values first: a text kept per group would sort all rows.
        rows = rows.select(*dict.fromkeys([*keys, context.distinct])).distinct()
    values = [PARTS[part].expression().alias(f"#{part}") for part in parts]
    # Without any part of its own the context still lists the groups.
    return rows.groupBy(*keys).agg(*(values or [F.count("*").alias("#visible")])), keys


def measures(
    frame: DataFrame,
    names: Sequence[str],
    by: Sequence[str] = (),
    slicers: Mapping[str, object] | None = None,
) -> DataFrame:
    """The named measures per visible group, or one row without `by`.

    Everything with the same context is one aggregate; usually that is one for
    the visible rows and, with benchmarks, one for the whole frame.
    """
    slicers = dict(slicers or {})
    needed = dict.fromkeys(part for name in names for part in MEASURES[name].parts)
    main = _Context()
    contexts: dict[_Context, list[str]] = {main: []}
    for part in needed:
        column = PARTS[part].column
        replaced = column if column in slicers or column in by else None
        context = _Context(PARTS[part].whole, replaced, PARTS[part].distinct)
        contexts.setdefault(context, []).append(part)

    result, _ = _aggregate(frame, main, contexts.pop(main), by, slicers)
    for context, parts in contexts.items():
        result = _attach(result, *_aggregate(frame, context, parts, by, slicers))
        counts = [f"#{part}" for part in parts if PARTS[part].aggregate is _count]
        result = result.fillna(0, counts) if counts else result
    shown = [
        MEASURES[name].value(*[F.col(f"#{part}") for part in MEASURES[name].parts]).alias(name)
        for name in names
    ]
    return result.select(*by, *shown)
