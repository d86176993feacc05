"""The listing store: clean once, write once, and let every report read its columns.

The reports need two to six of the thirteen columns, but removing duplicates
takes all ten raw columns through a shuffle. So the clean table is written once
per session as Parquet in the cluster's shared folder, and reports scan only
what they use.
"""

import tempfile
import threading
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stallwise import schema
from stallwise.operators import contract
from stallwise.operators.clean import clean_listings, clean_with_figures, to_warehouse
from stallwise.sources.binding import raw_listings

# load_position numbers rows within a write task: task number in the high bits.
TASK_BITS = 33


@dataclass(frozen=True)
class Stored:
    """Where the table is, and how many of its rows break the contract."""

    path: str
    broken_rows: int


_stored: dict[tuple[str, str], Stored] = {}
_local_folders: dict[str, str] = {}
_lock = threading.Lock()


def shared_folder(spark: SparkSession) -> str | None:
    """The folder every executor can reach, as named by the session.

    Local sessions without the setting get a fresh temporary folder. On a
    cluster without it there is no such folder and nothing is stored.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named or not spark.sparkContext.master.startswith("local"):
        return named
    app = spark.sparkContext.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="stallwise-")
    return _local_folders[app]


def scratch_path(spark: SparkSession, name: str) -> str | None:
    """A path of its own in the shared folder."""
    folder = shared_folder(spark)
    return folder and f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"


# What a query has shuffled is removed when it ends, not when the driver happens to collect its garbage.
SHUFFLES_FREED = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


@contextmanager
def settings(spark: SparkSession, chosen: dict[str, str]) -> Iterator[None]:
    """The session with these settings inside, and as it was after."""
    before = {name: spark.conf.get(name) for name in chosen}
    for name, value in chosen.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def with_ratings(clean: DataFrame) -> DataFrame:
    """Both rating precisions, so that neither is worked out again by a report."""
    one_decimal = F.col("rating").try_cast(schema.WAREHOUSE_RATING)
    return clean.withColumn("warehouse_rating", one_decimal)


def write_store(clean: DataFrame, path: str, sort_by: Sequence[str] = ()) -> Stored:
    """Write the clean table; broken rows are counted on the way, without a second pass.

    `sort_by` sorts the rows of each file (no shuffle), so that filters on those
    columns skip the parts of a file that cannot match.
    """
    counted = Observation("contract")
    ordered = clean.sortWithinPartitions(*sort_by) if sort_by else clean
    rows = with_ratings(ordered).withColumn("load_position", F.monotonically_increasing_id())
    rows.observe(counted, contract.broken_rows()).write.mode("overwrite").parquet(path)
    return Stored(path, counted.get["broken_rows"])


def read_store(spark: SparkSession, stored: Stored) -> DataFrame:
    """The stored rows. The layout is given, so opening the table runs no job."""
    return spark.read.schema(schema.STORE).parquet(stored.path)


def read_figures(spark: SparkSession, stored: Stored) -> DataFrame:
    """The stored rows with what the cleaning job noted beside them, if it was clean_with_figures that made them."""
    return spark.read.schema(T.StructType([*schema.STORE.fields, *schema.FIGURES.fields])).parquet(stored.path)


def open_store(spark: SparkSession, path: str) -> Stored:
    """A table that an earlier session wrote; its broken rows are counted again."""
    found = Stored(path, 0)
    return Stored(path, read_store(spark, found).agg(contract.broken_rows()).first()[0])


def require_contract(spark: SparkSession, stored: Stored) -> None:
    if stored.broken_rows:
        contract.require(read_store(spark, stored))


def _still_there(spark: SparkSession, stored: Stored) -> bool:
    """Whether the table can be opened; the shared folder may have been emptied."""
    try:
        read_store(spark, stored)
    except AnalysisException:
        return False
    return True


def stored_listings(spark: SparkSession, sf_dir: str) -> Stored | None:
    """The stored clean table of a test-table folder, written on first use."""
    path = scratch_path(spark, "listings")
    if path is None:
        return None
    key = (spark.sparkContext.applicationId, sf_dir)
    with _lock:
        if key not in _stored or not _still_there(spark, _stored[key]):
            _stored[key] = write_store(clean_with_figures(raw_listings(spark, sf_dir)), path)
        return _stored[key]


def clean_of(rows: DataFrame) -> DataFrame:
    """The 13 clean columns of a store's rows, two-decimal ratings."""
    return rows.select(*schema.CLEAN.names)


def warehouse_of(rows: DataFrame) -> DataFrame:
    """The clean columns of a store's rows (after the key, if there) with one-decimal ratings."""
    names = [name for name in ("id", *schema.CLEAN.names) if name in rows.columns]
    return rows.select(
        *[F.col("warehouse_rating" if name == "rating" else name).alias(name) for name in names]
    )


def clean_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean table of a test-table folder."""
    stored = stored_listings(spark, sf_dir)
    if stored is None:
        return clean_listings(raw_listings(spark, sf_dir))
    return clean_of(read_store(spark, stored))


def warehouse_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The warehouse table of a test-table folder.

    Raises if stored rows break the contract; rows that are not stored stop the
    job when a rating does not fit.
    """
    stored = stored_listings(spark, sf_dir)
    if stored is None:
        return to_warehouse(clean_listings(raw_listings(spark, sf_dir)))
    require_contract(spark, stored)
    return warehouse_of(read_store(spark, stored))


def task_starts(stored_rows: DataFrame) -> DataFrame:
    """(task, start): how many rows the write tasks before a task wrote.

    Only one count per write task passes through the ordered window.
    """
    task = F.shiftright("load_position", TASK_BITS)
    per_task = stored_rows.groupBy(task.alias("task")).agg(F.count("*").alias("n"))
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    return per_task.select("task", F.coalesce(F.sum("n").over(before), F.lit(0)).cast("long").alias("start"))


def numbered(stored_rows: DataFrame, first_ids: DataFrame, keys: Sequence[str] = ("task",)) -> DataFrame:
    """The rows with ids: the first id of their task and their position in it. One row per task is broadcast."""
    position = F.col("load_position").bitwiseAND(F.lit((1 << TASK_BITS) - 1))
    placed = stored_rows.withColumn("task", F.shiftright("load_position", TASK_BITS))
    joined = placed.join(F.broadcast(first_ids), list(keys))
    return joined.withColumn("id", F.col("first") + position).drop("task", "first", "load_position")


def with_ids(stored_rows: DataFrame) -> DataFrame:
    """Dense ids 1..N in load order, from the positions written with the rows.

    Each write task numbered its own rows, so an id is the row's position plus
    the number of rows of the tasks before it.
    """
    starts = task_starts(stored_rows)
    return numbered(stored_rows, starts.select("task", (F.col("start") + 1).alias("first")))


def warehouse_with_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The warehouse table with its key column."""
    stored = stored_listings(spark, sf_dir)
    if stored is None:
        raise RuntimeError("ids need a stored table: set spark.checkpoint.dir to a shared folder")
    require_contract(spark, stored)
    return warehouse_of(with_ids(read_store(spark, stored)))
