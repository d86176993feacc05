"""Helpers shared by the operators of this folder.

Conventions: an operator reads two columns of its input (an id and a text, both
arguments) and ignores all others, so extra columns may have any name. A null
text counts as empty. `doc_id` identifies a document; rows that repeat an id
get a decision each, and a null id is a value like any other.
"""

import tempfile
import zipfile
from collections import deque
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stallwise.sources import store

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: bytes.translate table that lower-cases A-Z only.
LOWER_BYTES = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def column(name: str) -> Column:
    """A column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make this package importable in the executors' Python, wherever they run.

    Spark serves the driver's archive to them; once per application.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix=f"{package.name}-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text): the two columns that matter, null texts as empty ones."""
    text = F.coalesce(column(text_col).cast("string"), F.lit(""))
    return docs.select(column(id_col).cast("long").alias("doc_id"), text.alias("text"))


def lower_az(text: Column) -> Column:
    """A-Z lower-cased, all other characters as they are.

    On ASCII texts the plain lower() does just that and is much faster.
    """
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def bounded_sample(rows: DataFrame, keys: list[str], n: int) -> DataFrame:
    """At most n rows, those with the smallest hashes of their keys.

    A first cut by the hash leaves about 2n rows in all, whatever the number of
    tasks, so that sorting them is a small job.
    """
    span = 1 << 40
    hashed = F.pmod(F.xxhash64(*[column(k) for k in keys], F.lit("sample")), F.lit(span))
    total = rows.count()
    few = rows if total <= 2 * n else rows.filter(hashed < span * 2 * n // total)
    return few.orderBy(hashed, *[column(k) for k in keys]).limit(n)


def stored(frame: DataFrame, name: str) -> DataFrame:
    """The rows, written to the shared folder and read back: later steps don't compute them again."""
    spark = frame.sparkSession
    path = store.scratch_path(spark, name)
    if path is None:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def drop_rows(docs: DataFrame, decisions: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """`docs` without the ids of which `decisions` (doc_id, kept) keeps no row; columns as before.

    The ids to drop are written first, so Spark knows their size and broadcasts
    them only if they are few.
    """
    by_id = decisions.groupBy("doc_id").agg(F.max("kept").alias("kept")).filter("NOT kept")
    name = fresh("dropped", docs)
    dropped = stored(by_id.select(F.col("doc_id").alias(name)), "dropped-ids")
    return docs.join(dropped, column(id_col).cast("long").eqNullSafe(column(name)), "left_anti")


def fresh(name: str, frame: DataFrame) -> str:
    """A column name that the frame does not have."""
    taken = {c.lower() for c in frame.columns}
    while name in taken:
        name += "_"
    return name


def filter_texts(docs: DataFrame, keep: Callable[[Iterable[pa.RecordBatch]], Iterator[list[bool]]], text_col: str = "text") -> DataFrame:
    """The rows that `keep` says yes to, with all columns as they are and without a shuffle.

    `keep` gets batches with a column `text` and yields a decision for each of
    their rows, in order, as many at a time as it likes.
    """
    names = docs.columns
    # A text column is sent once, not as itself and as a text.
    own = names.index(text_col) if (text_col, "string") in docs.dtypes else len(names)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: deque[pa.RecordBatch] = deque()
        decided: list[bool] = []

        def texts() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                waiting.append(batch)
                yield pa.RecordBatch.from_arrays([pc.fill_null(batch.column(own), "")], names=["text"])

        for decisions in keep(texts()):
            decided += decisions
            while waiting and len(decided) >= waiting[0].num_rows:
                batch = waiting.popleft()
                mask = pa.array(decided[: batch.num_rows], pa.bool_())
                decided = decided[batch.num_rows :]
                yield pa.RecordBatch.from_arrays(batch.columns[: len(names)], names=names).filter(mask)

    text = F.coalesce(column(text_col).cast("string"), F.lit(""))
    sent = docs if own < len(names) else docs.withColumn(fresh("_text", docs), text)
    return sent.mapInArrow(run, docs.schema)


def byte_texts(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """A column of texts as UTF-8 bytes."""
    return batch.column(batch.schema.get_field_index(name)).cast(pa.large_binary()).to_pylist()


def shards(batches: Iterable[pa.RecordBatch], most_bytes: int) -> Iterator[pa.RecordBatch]:
    """The rows of a task in runs of about `most_bytes`; a longer single row is a run of its own."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        start = 0
        at = batch.schema.get_field_index("text")
        for i, n in enumerate(pc.binary_length(batch.column(at).cast(pa.large_binary())).to_pylist()):
            if size and size + n > most_bytes:
                if i > start:
                    held.append(batch.slice(start, i - start))
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, size, start = [], 0, i
            size += n
        if start < batch.num_rows:
            held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit over all others (splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x += np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def lookup(rows: DataFrame, table: DataFrame, key: str, weight: str, values: list[str], spread: Column, hot_keys: int = 10_000) -> DataFrame:
    """`rows` with the `values` of the one row of `table` that has the same key (left join), safe for hot keys.

    `weight` is how many rows a key is for. Keys that hold over 1/`hot_keys` of
    all rows number at most `hot_keys`; they are broadcast, and their rows are
    spread by `spread` through the shuffle that joins the others.
    """
    total = table.agg(F.sum(weight)).first()[0] or 0
    hot = F.col(weight) > max(1_000, total // hot_keys)
    found = F.struct(*values)
    marked = rows.join(F.broadcast(table.filter(hot).select(key, found.alias("_hot"))), key, "left")
    marked = marked.withColumn("_cold_key", F.when(F.col("_hot").isNull(), F.col(key)))
    marked = marked.withColumn("_spread", F.when(F.col("_hot").isNotNull(), spread).otherwise(F.lit(0).cast("long")))
    cold = table.filter(~hot).select(F.col(key).alias("_cold_key"), F.lit(0).cast("long").alias("_spread"), found.alias("_cold"))
    chosen = F.coalesce("_hot", "_cold")
    joined = marked.join(cold, (marked["_cold_key"].eqNullSafe(cold["_cold_key"])) & (marked["_spread"] == cold["_spread"]), "left")
    return joined.select(*[column(c) for c in rows.columns], *[chosen[v].alias(v) for v in values])


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node that each node of the edges (a, b) is connected to.

    Alternating stars: each step points the neighbours of a node to the smallest
    of them, by aggregates and joins; every step is written to the shared folder.
    """
    now = stored(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct(), "edges")
    mark = None
    while True:
        for large in (True, False):
            both = now.select(F.col("b").alias("u"), F.col("a").alias("v"))
            if large:
                both = both.unionByName(now.select(F.col("a").alias("u"), F.col("b").alias("v")))
            least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
            pointed = both.join(least, "u")
            if large:
                step = pointed.filter("v > u").select(F.col("m").alias("a"), F.col("v").alias("b"))
            else:
                step = pointed.select(F.col("m").alias("a"), F.col("v").alias("b"))
                step = step.unionByName(least.select(F.col("m").alias("a"), F.col("u").alias("b")))
            now = stored(step.filter("a < b").distinct(), "edges")
        last, mark = mark, now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == last:
            break
    nodes = now.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("component"))
    return nodes.unionByName(now.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
