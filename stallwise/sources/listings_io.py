"""Readers and writers of listing tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stallwise import schema
from stallwise.functions.text import missing_to_null
from stallwise.operators import contract
from stallwise.sources import split_csv

# Quoted fields may hold line breaks and doubled quotes.
_CSV = {"header": True, "multiLine": True, "quote": '"', "escape": '"', "encoding": "UTF-8"}


def _read_csv(spark: SparkSession, path, layout: T.StructType, split: bool) -> DataFrame:
    # Every column is read as text so that a missing token never counts as a
    # malformed number.
    if split:
        rows = split_csv.read(spark, path, layout)
    else:
        text = T.StructType([T.StructField(name, T.StringType()) for name in layout.names])
        rows = spark.read.options(**_CSV).schema(text).csv(path)
    return rows.select(
        *[
            missing_to_null(F.col(f"`{field.name}`")).cast(field.dataType).alias(field.name)
            for field in layout
        ]
    )


def read_raw_csv(spark: SparkSession, path, split: bool = True) -> DataFrame:
    """The ten raw columns, as text but for the number of offers.

    Files are read by many tasks each (see split_csv), and twice. With `split`
    off, one task reads a file, once, and quotes may also stand inside values
    without quotes around them.
    """
    return _read_csv(spark, path, schema.RAW, split)


def read_clean_csv(spark: SparkSession, path, split: bool = False) -> DataFrame:
    """The 13 clean columns of files written by write_clean_csv, which are small enough for a task each."""
    return _read_csv(spark, path, schema.CLEAN, split)


def write_raw_csv(raw: DataFrame, path, mode: str = "errorifexists") -> None:
    """Raw rows as CSV with header, as the raw file has them."""
    raw.write.mode(mode).csv(
        path, header=True, quote='"', escape='"', nullValue="", encoding="UTF-8",
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )


def read_clean(spark: SparkSession, path) -> DataFrame:
    """The 13 clean columns from Parquet: splittable, and only the columns in use are read."""
    return spark.read.schema(schema.CLEAN).parquet(path)


def write_clean_csv(
    clean: DataFrame, path, mode: str = "errorifexists", rows_per_file: int = 1_000_000
) -> None:
    """CSV with header; a null is an empty field.

    Reading takes one task per file, so no file gets more than `rows_per_file` rows.
    """
    writer = clean.write.mode(mode).option("maxRecordsPerFile", rows_per_file)
    writer.csv(path, header=True, quote='"', escape='"', nullValue="", encoding="UTF-8")


def write_clean(clean: DataFrame, path, mode: str = "errorifexists") -> None:
    clean.write.mode(mode).parquet(path)


def load_table(warehouse: DataFrame, table: str) -> None:
    """Replace a table with rows that keep the contract; otherwise leave it as it is."""
    contract.require(warehouse)
    warehouse.write.mode("overwrite").saveAsTable(table)


def load_jdbc(warehouse: DataFrame, url: str, table: str, properties: dict | None = None) -> None:
    """Replace a table of an outside database; each partition is sent by its own task."""
    contract.require(warehouse)
    warehouse.write.jdbc(url, table, mode="overwrite", properties=properties or {})


def refresh_view(frame: DataFrame, name: str) -> None:
    """Create the named view, or replace the one that is there."""
    frame.createOrReplaceTempView(name)


def preview(frame: DataFrame, n: int = 5) -> DataFrame:
    return frame.limit(n)
