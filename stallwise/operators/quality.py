"""Data-quality profiles of the raw and the clean table."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stallwise.functions.numeric import percent


def null_profile(frame: DataFrame, places: int) -> DataFrame:
    """One row per column: type, nulls, percentage of nulls. A single pass."""
    nulls = {name: F.count_if(F.col(f"`{name}`").isNull()) for name in frame.columns}
    return _profile(frame.agg(F.count("*").alias("#rows"), *_named(nulls)), dict(frame.dtypes), places)


def raw_null_profile(stored: DataFrame, raw: StructType, places: int) -> DataFrame:
    """The same for the raw file, from what the cleaning job noted beside its rows."""
    copies = F.col("copies")
    nulls = {
        name: F.coalesce(F.sum(F.when(F.col("raw_nulls").bitwiseAND(F.lit(1 << i)) != 0, copies)), F.lit(0))
        for i, name in enumerate(raw.names)
    }
    types = {field.name: field.dataType.simpleString() for field in raw}
    return _profile(stored.agg(F.coalesce(F.sum(copies), F.lit(0)).alias("#rows"), *_named(nulls)), types, places)


def _named(columns: dict[str, Column]) -> list[Column]:
    return [column.alias(name) for name, column in columns.items()]


def _profile(counts: DataFrame, types: dict[str, str], places: int) -> DataFrame:
    long = counts.unpivot("#rows", [f"`{n}`" for n in types], "column_name", "null_count")
    type_of = F.create_map(*[F.lit(text) for pair in types.items() for text in pair])
    return long.select(
        "column_name",
        F.element_at(type_of, F.col("column_name")).alias("data_type"),
        "null_count",
        percent(F.col("null_count"), F.col("#rows"), places).alias("null_pct"),
    )


def shape(frame: DataFrame, stage: str) -> DataFrame:
    """Number of rows and columns, labelled with the stage of the job."""
    return frame.agg(F.count("*").alias("row_count")).select(
        F.lit(stage).alias("stage"), "row_count", F.lit(len(frame.columns)).alias("column_count")
    )
