"""Numbers that come out the same on every run and every partitioning.

Two rounding rules are in use. Warehouse reports round half away from zero on
exact values, so ratios are formed and rounded on whole numbers. Exploration
reports round doubles half to even.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

_WHOLE = "decimal(38,0)"


def _whole(value: Column, unit: int) -> Column:
    """`value`, a multiple of 10**-unit, as a whole number of those units."""
    if unit == 0:
        return value.cast(_WHOLE)
    return (value.cast(f"decimal({38 - 2 * unit},{unit})") * 10**unit).cast(_WHOLE)


def half_up(num: Column, den: Column, places: int, unit: int = 0) -> Column:
    """num / den rounded half away from zero; null when den is 0.

    `num` is a multiple of 10**-unit and `den` is a whole number, so nothing is
    rounded before the one rounding asked for.
    """
    top = F.abs(_whole(num, unit)) * F.lit(2 * 10**places).cast(_WHOLE)
    bottom = F.nullif(den.cast(_WHOLE), F.lit(0).cast(_WHOLE)) * F.lit(10**unit).cast(_WHOLE)
    steps = F.call_function("div", top + bottom, bottom * F.lit(2).cast(_WHOLE))
    return F.signum(num.cast("double")) * steps.cast("double") / F.lit(10.0**places)


def exact_mean(value: Column | str, places: int, unit: int = 0) -> Column:
    """Mean of the non-null values, an aggregate. `unit` as in half_up."""
    return half_up(F.sum(value), F.count(value), places, unit)


def rating_total(rating: Column) -> Column:
    """Sum of one-decimal ratings, an aggregate.

    The ratings' own type would leave a sum twelve digits before the point, which
    a trillion listings overrun. Eight digits leave seventeen, and sums of this
    width are still kept as whole numbers.
    """
    return F.sum(rating.cast("decimal(8,1)"))


def mean_rating(rating: Column, places: int) -> Column:
    """Mean of the one-decimal ratings that are there, an aggregate."""
    return half_up(rating_total(rating), F.count(rating), places, unit=1)


def exact_share(condition: Column, places: int) -> Column:
    """Percentage of the group's rows that meet the condition, an aggregate."""
    return half_up(F.count_if(condition) * 100, F.count("*"), places)


def round_even(value: Column, places: int) -> Column:
    """Round a double half to even on its scaled value."""
    scale = 10.0**places
    return F.rint(value * scale) / scale


def ratio(num: Column, den: Column) -> Column:
    """num / den as a double; null when den is 0."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def percent(num: Column, den: Column, places: int) -> Column:
    """num / den * 100 as a double, rounded half to even."""
    return round_even(ratio(num, den) * 100.0, places)


def hundredths(value: Column) -> Column:
    """A two-decimal double as a whole number of hundredths."""
    return F.rint(value * 100.0).cast("long")
