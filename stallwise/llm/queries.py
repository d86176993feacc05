"""The operators on the test tables, by query name, and their DuckDB twins."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from stallwise.llm import bpe, common, conversation_trie, decontamination, exact_dedup, html_text, ngram_join, periodic_runs, pii
from stallwise.llm import quality_rules, shared_passages, sql, suffix_dedup, token_counts, toxicity, url_filter
from stallwise.llm.common import documents, ship
from stallwise.sources import store

Query = Callable[[SparkSession, str], DataFrame]

RANK_FILE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
ENGLISH_RANK_FILE = public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(documents(spark, sf_dir))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.linked(documents(spark, sf_dir), width=4, percent=85)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.scored(documents(spark, sf_dir), labels)


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.digests(decontamination.contamination(documents(spark, sf_dir), benchmark))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoded_digests(documents(spark, sf_dir), RANK_FILE, public_tokenizers.PATTERN)


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of over 50 words can be shorter than 400 bytes; a column of their own tells which documents share one."""
    docs = documents(spark, sf_dir)
    return suffix_dedup.without_repeats(docs, digests=True, passages=shared_passages.sharing(docs))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digests(pii.found_spans(documents(spark, sf_dir)))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judged(spark.read.parquet(f"{sf_dir}/pages.parquet")).drop("score")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents come in, those of low quality go, English ones move to another tokenizer; every batch is sent twice."""
    docs, pattern = documents(spark, sf_dir), public_tokenizers.PATTERN
    rollup = token_counts.Rollup(spark, store.scratch_path(spark, "token-counts"))
    counts = common.stored(token_counts.counted(docs, RANK_FILE, pattern, "byte_bpe_multi_50k"), "token-counts-of-documents")
    gone = spark.read.parquet(f"{sf_dir}/labels.parquet").filter("quality = 0").select("doc_id").distinct()
    stayed = counts.join(gone, "doc_id", "left_anti")
    english = token_counts.counted(docs.filter("lang = 'en'"), ENGLISH_RANK_FILE, pattern, "byte_bpe_50k")
    batches = {
        "load": token_counts.inserts(counts),
        "quality": token_counts.deletes(counts.join(gone, "doc_id", "left_semi")),
        "english": token_counts.revisions(stayed.filter("lang = 'en'"), english.join(gone, "doc_id", "left_anti")),
    }
    for _ in range(2):
        for batch, changes in batches.items():
            rollup.apply(batch, changes)
    return rollup.totals()


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.visible_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The runs of all documents, a tenth of which is made periodic first."""
    return periodic_runs.digests(periodic_runs.found(periodic_runs.planted(documents(spark, sf_dir))))


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judged(documents(spark, sf_dir))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all conversations, rebuilt so that some share their first turns."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return conversation_trie.trie(conversation_trie.rebuilt(conversation_trie.sequences(turns)))


def _shipped(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Query]:
    named = {
        "op1_exact_dedup": op1_exact_dedup,
        "op2_ngram_join": op2_ngram_join,
        "op3_toxicity": op3_toxicity,
        "op4_decontamination": op4_decontamination,
        "op5_bpe": op5_bpe,
        "op6_suffix_dedup": op6_suffix_dedup,
        "op7_pii": op7_pii,
        "op8_url_filter": op8_url_filter,
        "op9_token_counts": op9_token_counts,
        "op10_html_text": op10_html_text,
        "op11_periodic_runs": op11_periodic_runs,
        "op12_quality_rules": op12_quality_rules,
        "op13_conversation_trie": op13_conversation_trie,
    }
    return {name: _shipped(query) for name, query in named.items()}


def oracle_sql() -> dict[str, str]:
    return sql.statements()
