"""Token totals by source, language and tokenizer version, kept up to date by deltas.

A change is a signed count: an insert adds a document's tokens, a delete takes
them away, and a revised count does both. A batch of changes is summed per key
in its tasks and after one shuffle (a key with a third of all documents is one
row per task by then), added to the totals so far, and the new totals are
written and committed. So the totals are one small table that a reader opens
with its last commit record, however many batches there were.

The record names the batches that the totals hold; one of those is not applied
again. A job that dies before its record is written has changed nothing. Two
jobs cannot commit the same version: the later one adds its deltas to the totals
of the other.

Defined cases: null texts have no tokens but count as documents; null sources
and languages are keys of their own; rows that repeat an id, or have none, count
each; keys whose documents and tokens both come to zero have no row; an empty
batch is committed and adds nothing; extra columns are ignored.
"""

import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stallwise.llm import bpe, common
from stallwise.sources.commits import CommitConflict, CommitLog

KEYS = ["source", "lang", "tokenizer"]
_DELTAS = "source string, lang string, tokenizer string, docs long, tokens long"


def counted(docs: DataFrame, rank_file: str, pattern: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang") -> DataFrame:
    """One row per input row: doc_id, source, lang, tokenizer, tokens."""
    rows = docs.select(
        common.column(id_col).cast("long").alias("doc_id"), common.column(source_col).cast("string").alias("source"),
        common.column(lang_col).cast("string").alias("lang"), F.coalesce(common.column(text_col).cast("string"), F.lit("")).alias("text"),
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = bpe.encoding(rank_file, pattern)
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                tokens = [len(bpe.encode(text, codec, pattern)) for text in batch.column("text").to_pylist()]
                kept = [batch.column(c) for c in ("doc_id", "source", "lang")]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(tokens, pa.int64())], names=["doc_id", "source", "lang", "tokens"])

    found = rows.mapInArrow(run, "doc_id long, source string, lang string, tokens long")
    return found.select("doc_id", "source", "lang", F.lit(tokenizer).alias("tokenizer"), "tokens")


def inserts(counts: DataFrame) -> DataFrame:
    return counts.select(*KEYS, F.lit(1).cast("long").alias("sign"), "tokens")


def deletes(counts: DataFrame) -> DataFrame:
    return counts.select(*KEYS, F.lit(-1).cast("long").alias("sign"), "tokens")


def revisions(before: DataFrame, after: DataFrame) -> DataFrame:
    """Counts that take the place of earlier ones of the same documents."""
    return deletes(before).unionByName(inserts(after))


class Rollup:
    """Additive totals in a folder that all executors share."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.log = spark, CommitLog(spark, folder)

    def _now(self) -> dict:
        return self.log.last() or {"number": 0, "totals": None, "batches": []}

    def _read(self, folder: str | None) -> DataFrame:
        if folder is None:
            return self.spark.createDataFrame([], _DELTAS)
        return self.spark.read.schema(_DELTAS).parquet(f"{self.log.root}/{folder}")

    def committed(self, batch: str) -> bool:
        return batch in self._now()["batches"]

    def apply(self, batch: str, changes: DataFrame) -> bool:
        """Add a batch of changes (source, lang, tokenizer, sign, tokens); False if it was there already."""
        if self.committed(batch):
            return False
        deltas = f"deltas/{uuid.uuid4().hex}"
        summed = changes.groupBy(*KEYS).agg(F.sum("sign").alias("docs"), F.sum(F.col("sign") * F.col("tokens")).alias("tokens"))
        summed.write.parquet(f"{self.log.root}/{deltas}")
        while not self.committed(batch):
            now, number, totals = self._now(), self.log.next_number(), f"totals/{uuid.uuid4().hex}"
            both = self._read(now["totals"]).unionByName(self._read(deltas)).groupBy(*KEYS)
            both = both.agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).filter("docs <> 0 OR tokens <> 0")
            both.write.parquet(f"{self.log.root}/{totals}")
            if self._now()["number"] != now["number"]:
                continue
            try:
                self.log.commit(number, {"number": number, "totals": totals, "batches": [*now["batches"], batch]})
            except CommitConflict:
                continue
            return True
        return False

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, docs, tokens over all committed batches."""
        return self._read(self._now()["totals"])
