"""From raw documents to token ids: toxic documents, copies, near copies and leaked benchmark passages go first.

Each stage takes (spark, docs, sf_dir) and returns documents with the same
columns, the last one their token ids. Its result is written and read again.

Defined cases: null texts count as empty, and one document of all empty ones is
left; rows that repeat an id stay or go by their texts, all rows of an id that
wins among equal texts stay; a null id loses to any other; without labels of both
kinds no document is toxic; a benchmark item of fewer than ten words counts as a
whole, null ones as nothing; empty tables give empty results; extra columns of
any name are carried to the last stage, which returns its own.
"""

import sys
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

import public_tokenizers  # noqa: E402

from stallwise.llm import bpe, common, decontamination, exact_dedup, ngram_join, toxicity  # noqa: E402

#: Where the rank file lies on every machine.
RANK_FILE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go; the machine learns from the labelled ones among `docs`."""
    common.ship(spark)
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the one with the largest id stays."""
    common.ship(spark)
    return exact_dedup.drop_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a Jaccard similarity of 0.8 on five-word shingles, the smallest id stays."""
    common.ship(spark)
    return ngram_join.drop_near_copies(docs, width=5, percent=80)


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of a benchmark item go."""
    common.ship(spark)
    return decontamination.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def as_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, and the bytes that they decode to."""
    common.ship(spark)
    return bpe.encoded(docs, RANK_FILE, public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", without_toxic),
    ("exact_dedup", without_copies),
    ("ngram_join", without_near_copies),
    ("decontamination", without_leaks),
    ("bpe", as_tokens),
]

#: The toxicity model and the merges of the tokenizer have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = common.stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
