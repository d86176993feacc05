"""CSV files with line breaks inside quotes, read by many tasks a file.

Whether a line break ends a record depends on whether the quotes before it pair
up, which a task that starts in the middle of a file cannot see. So the files
are read as lines twice, by the same splits:

1. the quotes of each split are counted; running totals over the splits of a
   file (one row a split) tell whether a split starts inside quotes;
2. each split joins its lines to records from the right state on. Where a record
   crosses a split's end, its pieces are joined through a shuffle of at most two
   pieces a split.

Records are then parsed one by one by the engine's own CSV parser.

Quotes are expected as the format has them: a value that holds a quote is itself
in quotes, with the quote doubled. A file is encoded in UTF-8 and its first
record is its header. A last record without a line break counts; empty lines
between records do not; after a quote that never closes, the rest of the file is
one record. If a file's first line ends in a carriage return, line breaks in its
values are read without theirs, as by the engine's reader.
"""

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_OPTIONS = {"quote": '"', "escape": '"', "multiLine": "true", "mode": "PERMISSIVE"}
#: A whole record, or a piece of one that crosses splits: its end, its middle, its start.
_WHOLE, _TAIL, _MIDDLE, _HEAD = 0, 1, 2, 3
_PIECES = "file string, split_start long, crlf boolean, kind int, header boolean, record string"


def _lines(spark: SparkSession, path) -> DataFrame:
    """The lines of the files in order, with the split that they were read by. Carriage returns stay."""
    lines = spark.read.option("lineSep", "\n").text(path)
    place = (F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split_start"))
    return lines.select(*place, F.col("value"))


def _opening_states(lines: DataFrame) -> DataFrame:
    """(file, split_start, inside, crlf): whether a split starts inside quotes, and whether the file's first line ends in a carriage return."""
    quotes = F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"')))
    # A split is read by one task, in order, so its first line is the first one there.
    first = F.first(F.endswith("value", F.lit("\r"))).alias("crlf")
    per_split = lines.groupBy("file", "split_start").agg((F.sum(quotes.cast("long")) % 2).alias("odd"), first)
    before = Window.partitionBy("file").orderBy("split_start").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1
    crlf = F.max(F.when(F.col("split_start") == 0, F.col("crlf"))).over(Window.partitionBy("file"))
    return per_split.select("file", "split_start", inside.alias("inside"), F.coalesce(crlf, F.lit(False)).alias("crlf"))


def _joined(lines: pa.Array, ends: np.ndarray) -> pa.Array:
    """The lines up to each of the (inclusive) ends, joined by line breaks."""
    offsets = pa.array(np.concatenate([[0], ends + 1]), pa.int32())
    return pc.binary_join(pa.ListArray.from_arrays(offsets, lines), "\n")


class _Cutter:
    """Joins the lines of one split to records, batch by batch."""

    def __init__(self, file: str, start: int, inside: bool, crlf: bool) -> None:
        self.file, self.start, self.inside, self.crlf = file, start, inside, crlf
        self.at_end_of_earlier, self.header = inside, start == 0
        self.held: list[str] = []

    def _batch(self, kind: int, records: pa.Array, header: bool = False) -> pa.RecordBatch:
        n = len(records)
        columns = [
            pa.array([self.file] * n, pa.string()), pa.array([self.start] * n, pa.int64()), pa.array([self.crlf] * n, pa.bool_()),
            pa.array([kind] * n, pa.int32()), pa.array([header and i == 0 for i in range(n)], pa.bool_()), records,
        ]
        return pa.RecordBatch.from_arrays(columns, names=["file", "split_start", "crlf", "kind", "header", "record"])

    def add(self, lines: pa.Array) -> Iterator[pa.RecordBatch]:
        quotes = pc.count_substring(lines, '"').to_numpy(zero_copy_only=False)
        inside = (np.cumsum(quotes) + self.inside) % 2 == 1
        ends = np.flatnonzero(~inside)
        if len(inside):
            self.inside = bool(inside[-1])
        if not len(ends):
            self.held += lines.to_pylist()
            return
        rest = lines.slice(int(ends[-1]) + 1)
        records = _joined(lines.slice(0, int(ends[-1]) + 1), ends)
        if self.held:
            first = pa.array(["\n".join([*self.held, records[0].as_py()])], pa.string())
            records = pa.concat_arrays([first, records.slice(1)])
        self.held = rest.to_pylist()
        if self.at_end_of_earlier:
            self.at_end_of_earlier = False
            yield self._batch(_TAIL, records.slice(0, 1))
            records = records.slice(1)
        if len(records):
            yield self._batch(_WHOLE, records, self.header)
            self.header = False

    def close(self) -> Iterator[pa.RecordBatch]:
        if self.held:
            kind = _MIDDLE if self.at_end_of_earlier else _HEAD
            yield self._batch(kind, pa.array(["\n".join(self.held)], pa.string()), self.header)


def _cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cutter: _Cutter | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        files, starts = batch.column("file"), batch.column("split_start")
        numbers = pc.run_end_encode(pc.binary_join_element_wise(files, pc.cast(starts, pa.string()), ":"))
        begin = 0
        for end in numbers.run_ends.to_pylist():
            file, start = files[begin].as_py(), starts[begin].as_py()
            if cutter is None or (cutter.file, cutter.start) != (file, start):
                if cutter is not None:
                    yield from cutter.close()
                cutter = _Cutter(file, start, batch.column("inside")[begin].as_py(), batch.column("crlf")[begin].as_py())
            yield from cutter.add(batch.column("value").slice(begin, end - begin).cast(pa.string()))
            begin = end
    if cutter is not None:
        yield from cutter.close()


def records(spark: SparkSession, path) -> DataFrame:
    """(record): the text of every record but the headers."""
    lines = _lines(spark, path)
    states = _opening_states(lines)
    # One row a split: far fewer than lines, and needed by all of them.
    pieces = lines.join(F.broadcast(states), ["file", "split_start"]).mapInArrow(_cut, _PIECES)
    whole = pieces.filter((F.col("kind") == _WHOLE) & ~F.col("header")).select("crlf", "record")
    order = Window.partitionBy("file").orderBy("split_start", "kind")
    cut = pieces.filter(F.col("kind") != _WHOLE).withColumn("number", F.sum((F.col("kind") == _HEAD).cast("int")).over(order))
    parts = F.sort_array(F.collect_list(F.struct("split_start", "record")))
    crossing = cut.groupBy("file", "number").agg(parts.alias("parts"), F.max("header").alias("header"), F.max("crlf").alias("crlf"))
    joined = crossing.filter("NOT header").select("crlf", F.array_join(F.transform("parts", lambda p: p["record"]), "\n").alias("record"))
    bare = F.regexp_replace(F.replace("record", F.lit("\r\n"), F.lit("\n")), r"\r\z", "")
    text = F.when(F.col("crlf"), bare).otherwise(F.col("record"))
    return whole.unionByName(joined).select(text.alias("record")).filter("record <> ''")


def read(spark: SparkSession, path, layout: T.StructType) -> DataFrame:
    """The records of the files as rows of text columns in the order of `layout`."""
    text = ", ".join(f"`{name}` STRING" for name in layout.names)
    row = F.from_csv(F.col("record"), text, _OPTIONS)
    return records(spark, path).select(row.alias("row")).select("row.*")
