"""The warehouse contract: required values, text lengths, rating range."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallwise import fixed_values as V
from stallwise import schema


class ContractError(ValueError):
    """Rows that break the warehouse contract; `counts` says how many per rule."""

    def __init__(self, counts: dict[str, int]):
        self.counts = counts
        super().__init__("contract broken: " + ", ".join(f"{k}={v}" for k, v in counts.items()))


def rules() -> dict[str, Column]:
    """Rule name -> condition that is true for a row that breaks it."""
    required = [name for name in schema.CLEAN.names if name not in schema.NULLABLE]
    broken = {f"{name}_missing": F.col(name).isNull() for name in required}
    for name, longest in V.TEXT_LIMITS.items():
        broken[f"{name}_too_long"] = F.coalesce(F.char_length(name) > longest, F.lit(False))
    too_large = F.abs("rating") >= V.RATING_OVERFLOW
    broken["rating_out_of_range"] = F.coalesce(too_large, F.lit(False))
    return broken


def counters() -> list[Column]:
    """One counting aggregate per rule."""
    return [F.count_if(broken).alias(name) for name, broken in rules().items()]


def broken_rows() -> Column:
    """How many rows break any rule, as one aggregate."""
    return F.count_if(reduce(Column.__or__, rules().values())).alias("broken_rows")


def violations(clean: DataFrame) -> DataFrame:
    """One row per rule with the number of rows that break it; a single pass."""
    names = list(rules())
    return clean.agg(*counters()).unpivot([], names, "rule", "violations")


def require(clean: DataFrame) -> None:
    """Raise if any row breaks a rule."""
    counts = clean.agg(*counters()).first().asDict()
    broken = {name: n for name, n in counts.items() if n}
    if broken:
        raise ContractError(broken)


def split_rejects(clean: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that keep the contract, rows that break it with the rules they break)."""
    broken = [F.when(condition, F.lit(name)) for name, condition in rules().items()]
    marked = clean.withColumn("broken_rules", F.array_compact(F.array(*broken)))
    accepted = marked.filter(F.size("broken_rules") == 0).drop("broken_rules")
    return accepted, marked.filter(F.size("broken_rules") > 0)
