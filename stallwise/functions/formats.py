"""Display texts of the measures."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from stallwise import fixed_values as V


def fixed(value: Column, places: int) -> Column:
    """Plain digits with `places` decimals, rounded half away from zero."""
    return F.round(value, places).cast(f"decimal(38,{places})").cast("string")


def grouped(value: Column) -> Column:
    """Whole number with thousands separators; format_number alone rounds half to even."""
    return F.format_number(F.round(value, 0), 0)


def review_volume(total: Column) -> Column:
    """58.0M Reviews, 1.5K Reviews or 999 Reviews."""
    shown = (
        F.when(total >= 1_000_000, F.concat(fixed(total / 1_000_000, 1), F.lit("M")))
        .when(total >= 1_000, F.concat(fixed(total / 1_000, 1), F.lit("K")))
        .otherwise(F.coalesce(grouped(total), F.lit("")))
    )
    return F.concat(shown, F.lit(V.REVIEWS_SUFFIX))


def rating_card(mean: Column) -> Column:
    """4.04 with a star, N/A when there is no rating."""
    return F.coalesce(F.concat(fixed(mean, 2), F.lit(V.RATING_SUFFIX)), F.lit(V.RATING_MISSING))


def cost_card(mean: Column) -> Column:
    """₹269."""
    return F.concat(F.lit(V.CURRENCY_SIGN), F.coalesce(grouped(mean), F.lit("")))


def variance_note(difference: Column) -> Column:
    """Signed distance from the benchmark with two decimals; no value counts as 0."""
    arrow = F.when(difference < 0, F.lit(V.BELOW_BENCHMARK)).otherwise(F.lit(V.ABOVE_BENCHMARK))
    shown = F.coalesce(fixed(difference, 2), F.lit(""))
    return F.concat(arrow, shown, F.lit(V.BENCHMARK_SUFFIX))


def city_title(only_city: Column) -> Column:
    return F.coalesce(F.concat(F.lit(V.CITY_TITLE_ONE), only_city), F.lit(V.CITY_TITLE_ALL))


def cuisine_title(only_cuisine: Column) -> Column:
    before, after = V.CUISINE_TITLE_ONE
    return F.coalesce(F.concat(F.lit(before), only_cuisine, F.lit(after)), F.lit(V.CUISINE_TITLE_ALL))
