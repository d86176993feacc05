"""Exact duplicates, native: texts that are identical after lower-casing A-Z.

Copies are combined in three steps, each of which compares whole contents, since
the content itself is part of every grouping key next to its digest:

1. locally: the partial aggregation of each input task leaves one row a text;
2. by salt: the rows of a digest are merged within `salts` salts, so a text that
   makes up a third of the corpus is merged by many tasks;
3. globally: at most `salts` winners of each text are combined.

The way back from groups to documents needs no text: it joins on the digest.
Groups so large that they would make a join task uneven number at most
`HOT_GROUPS` by construction and are broadcast, the others are joined by
shuffle. Only digests under which several contents were found (none, unless two
texts collide in SHA-256) are joined on the contents again.

Defined cases: null texts equal empty ones; an empty table gives no rows; rows
that repeat an id count as copies of each other, and all rows of the winning id
are kept; a null id wins only over nothing.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallwise.llm import common

#: At most so many groups are broadcast: a hot group holds over 1/HOT_GROUPS of all rows.
HOT_GROUPS = 10_000
LEAST_HOT = 1_000


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 16, digest: Callable[[Column], Column] = sha256
) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = common.text_rows(docs, id_col, text_col).select("doc_id", common.lower_az(F.col("text")).alias("text"))
    rows = rows.withColumn("digest", digest(F.col("text")))
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(salts)).alias("salt")
    by_salt = rows.groupBy("digest", "text", salt).agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    winners = by_salt.groupBy("digest", "text").agg(F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
    hashes = F.sha2(F.col("text"), 256).alias("text_sha256")
    groups = common.stored(winners.select("digest", "keep_id", "group_size", hashes), "exact-groups")
    clashes = groups.groupBy("digest").agg(F.count("*").alias("n")).filter("n > 1").select("digest")
    if clashes.isEmpty():
        return _result(_by_digest(rows.select("doc_id", "digest"), groups))
    clashes = common.stored(clashes, "exact-clashes")
    plain = _by_digest(
        rows.select("doc_id", "digest").join(clashes, "digest", "left_anti"), groups.join(clashes, "digest", "left_anti")
    )
    clashing = rows.join(clashes, "digest", "left_semi")
    merged = clashing.groupBy("digest", "text").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    merged = merged.withColumn("text_sha256", F.sha2(F.col("text"), 256))
    return _result(plain.unionByName(clashing.join(merged, ["digest", "text"]).drop("text")))


def _by_digest(rows: DataFrame, groups: DataFrame) -> DataFrame:
    total = groups.agg(F.sum("group_size")).first()[0] or 0
    hot = F.col("group_size") > max(LEAST_HOT, total // HOT_GROUPS)
    marked = rows.join(
        F.broadcast(groups.filter(hot).select("digest", F.struct("keep_id", "group_size", "text_sha256").alias("hot"))),
        "digest",
        "left",
    )
    # Rows of hot groups need no second partner: their key only spreads them.
    spread = F.encode(F.col("doc_id").cast("string"), "utf-8")
    marked = marked.withColumn("cold_key", F.when(F.col("hot").isNull(), F.col("digest")).otherwise(F.coalesce(spread, F.lit(b""))))
    cold = groups.filter(~hot).select(F.col("digest").alias("cold_key"), F.struct("keep_id", "group_size", "text_sha256").alias("cold"))
    found = F.coalesce("hot", "cold")
    return marked.join(cold, "cold_key", "left").select("digest", "doc_id", found.alias("g")).select(
        "digest", "doc_id", "g.keep_id", "g.group_size", "g.text_sha256"
    )


def _result(found: DataFrame) -> DataFrame:
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept")
    return found.select("doc_id", "keep_id", F.col("group_size").cast("long").alias("group_size"), kept, "text_sha256")


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without copies; the columns stay as they are."""
    return common.drop_rows(docs, exact_groups(docs, id_col, text_col).select("doc_id", "kept"), id_col)
