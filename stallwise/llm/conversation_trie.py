"""Prefix trie of conversations: adaptive radix trees over sequences of turn ids.

A turn's id has a fixed width: 16 bytes of the SHA-256 of its role and text and
its number of words, big-endian in 4 bytes. So a conversation is a byte string,
and texts are read once, by the first pass.

1. The ids of each conversation are put in order; equal sequences are combined
   with their sorted conversation ids, in groups of at most `BUCKET` ids.
2. Sequences are dealt by ranges into parts of about `PART_BYTES`, so neither a
   very common first turn nor a very common conversation makes a part large.
3. Each part builds its radix tree and walks it upwards. Only depths at whole
   turns give nodes; a compressed path gives one for each turn that it holds.
   Each part knows the last sequence before it and the first one behind it, so
   it tells nodes of its own from those shared with its neighbours, and counts
   what a shared node is made of exactly once.
4. The shared nodes, at most the depth of a conversation a part, are summed up
   natively, and nodes below them look up their parents.

Defined cases: null roles and texts count as empty; turns are ordered by number,
null first, and turns of one number by their ids; rows without a conversation id
belong to no conversation and are left out; repeated rows are turns like any
other; an empty table gives no nodes; extra columns are ignored. A task holds
the ids of a conversation (40 bytes a turn), never its texts.
"""

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stallwise.llm import common
from stallwise.llm.radix_tree import Tree

WIDTH, DIGEST = 20, 16
BUCKET = 1 << 12
PART_BYTES = 8 << 20

_ROWS = (
    "digest binary, parent_digest binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, ends_sha256 string"
)
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def turn_id(role: Column, text: Column) -> Column:
    """The id of a turn as hexadecimal digits."""
    content = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    words = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))
    return F.concat(F.substring(F.sha2(content, 256), 1, 2 * DIGEST), F.lpad(F.hex(words.cast("long")), 2 * (WIDTH - DIGEST), "0"))


def sequences(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, ids): the turn ids of each conversation in order, joined, as hexadecimal digits."""
    role, text = (F.coalesce(common.column(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    rows = turns.select(
        common.column(conv_col).cast("long").alias("conv_id"), common.column(turn_col).cast("long").alias("turn"), turn_id(role, text).alias("id")
    ).filter("conv_id IS NOT NULL")
    ordered = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "id"))).alias("turns"))
    return ordered.select("conv_id", F.array_join(F.transform("turns", lambda t: t["id"]), "").alias("ids"))


def rebuilt(conversations: DataFrame, step: int = 20, most: int = 3) -> DataFrame:
    """Conversations that begin with up to `most` turns of the one at the last multiple of `step`, their number by a hash of the id."""
    conversations = common.stored(conversations, "conversations")
    digits = 2 * WIDTH
    heads = conversations.filter(F.col("conv_id") % step == 0).select(
        F.col("conv_id").alias("base"), F.substring("ids", 1, most * digits).alias("head")
    )
    shared = (F.crc32(F.encode(F.col("conv_id").cast("string"), "utf-8")) % (most + 1)).cast("int")
    rows = conversations.withColumns({"base": F.col("conv_id") - F.col("conv_id") % step, "shared": shared})
    head = F.substr(F.coalesce("head", F.lit("")), F.lit(1), F.col("shared") * digits)
    own = F.substr(F.col("ids"), F.col("shared") * digits + 1)
    return rows.join(heads, "base", "left").select("conv_id", F.concat(head, own).alias("ids"))


def _combined(conversations: DataFrame) -> DataFrame:
    """(key, bucket, n, conv_id, ends): equal sequences, their ids sorted and joined, in groups of at most BUCKET."""
    rows = conversations.select(F.unhex("ids").alias("key"), F.floor(F.col("conv_id") / BUCKET).cast("long").alias("bucket"), "conv_id")
    ids = F.sort_array(F.collect_list("conv_id"))
    grouped = rows.groupBy("key", "bucket").agg(ids.alias("ids"))
    ends = F.array_join(F.transform("ids", lambda i: i.cast("string")), ",").alias("ends")
    return grouped.select("key", "bucket", F.size("ids").cast("long").alias("n"), F.col("ids")[0].alias("conv_id"), ends)


def _dealt(combined: DataFrame, part_bytes: int) -> DataFrame:
    """The rows with their part, and for each part the neighbours' nearest sequences as rows with n = 0."""
    spark = combined.sparkSession
    combined = common.stored(combined, "sequences")
    size = combined.agg(F.sum(F.octet_length("key") + F.octet_length("ends"))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // part_bytes))
    ranged = common.stored(combined.repartitionByRange(parts, "key").withColumn("part", F.spark_partition_id()), "sequence-parts")
    ends = ranged.groupBy("part").agg(F.min("key").alias("first"), F.max("key").alias("last"))
    order = Window.orderBy("part")
    beside = ends.select("part", F.lag("last").over(order).alias("before"), F.lead("first").over(order).alias("after"))
    marks = beside.select("part", F.explode(F.array("before", "after")).alias("key")).filter("key IS NOT NULL")
    rows = ranged.unionByName(marks.withColumn("n", F.lit(0).cast("long")), allowMissingColumns=True)
    return rows.repartition(parts, "part").sortWithinPartitions("part", "key", "bucket")


def _prefixes(key: bytes, end: int) -> dict[int, bytes]:
    """The SHA-256 of the key's first bytes, for every depth of whole turns up to `end`."""
    state = hashlib.sha256()
    out = {0: state.digest()}
    for depth in range(WIDTH, end + 1, WIDTH):
        state.update(key[depth - WIDTH : depth])
        out[depth] = state.digest()
    return out


class Part:
    """The sequences of one part, in order, and the nodes that they give."""

    def __init__(self) -> None:
        self.tree = Tree()
        self.before = self.after = None
        self.last: bytes | None = None
        self.end = None

    def add(self, key: bytes, n: int, conv_id: int | None, ends: str | None) -> None:
        if not n:
            if self.last is None:
                self.before = key
            else:
                self.after = key
            return
        if key != self.last:
            self.last, self.end = key, [0, conv_id, hashlib.sha256()]
            self.tree.place(key).value = self.end
        self.end[2].update((("," if self.end[0] else "") + ends).encode())
        self.end[0] += n
        self.end[1] = min(self.end[1], conv_id)

    def nodes(self) -> list[list]:
        """Rows as in _ROWS; those of nodes shared with other parts have a digest, and so has the root."""
        empty = hashlib.sha256().hexdigest()
        marks = [(key, self.tree.along(key)) for key in (self.before, self.after) if key is not None]
        digests = _prefixes(b"", 0)
        for key, way in marks:
            digests |= {(key, d): x for d, x in _prefixes(key, max(way.values()) // WIDTH * WIDTH).items()}
        rows: list[list] = []
        below: dict[int, tuple] = {}
        for node, above, end in self.tree.upward():
            n, least, kids, leaves, saved, open_rows = node.value[0] if node.value else 0, node.value[1] if node.value else None, 0, 0, 0, []
            for _, child in node.items():
                n2, least2, kids2, leaves2, saved2, open2 = below.pop(id(child))
                n, least = n + n2, least2 if least is None else min(least, least2)
                kids, leaves, saved = kids + kids2, leaves + leaves2, saved + saved2
                # The longer list takes up the shorter one.
                open_rows, open2 = (open_rows, open2) if len(open_rows) >= len(open2) else (open2, open_rows)
                open_rows.extend(open2)
            depths = list(range((above // WIDTH + 1) * WIDTH, end + 1, WIDTH))
            if node is self.tree.root:
                depths.insert(0, 0)
            for depth in reversed(depths):
                shared = [key for key, way in marks if way.get(id(node), -1) >= depth]
                old = self.before is not None and self.before in shared
                goes_on = self.after is not None and self.after in shared and len(self.after) > depth
                words = int.from_bytes(node.key[depth - WIDTH + DIGEST : depth], "big") if depth else 0
                saved += n * words - (0 if old else words)
                has_children = bool(open_rows) or goes_on
                leaves += 0 if has_children else 1
                digest = digests[shared[0], depth] if shared else digests[0] if depth == 0 else None
                ends = node.value[2].hexdigest() if node.value and depth == end else None if digest else empty
                row = [digest, None, least, depth // WIDTH, None, n, kids, leaves, saved, ends]
                for child in open_rows:
                    child[1], child[4] = (digest, None) if digest else (None, least)
                rows.append(row)
                open_rows, kids = [row], 0 if old else 1
            below[id(node)] = n, least, kids, leaves, saved, open_rows
        return rows


def _walk(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.binary()] * 2 + [pa.int64()] * 7 + [pa.string()]
    names = [c.split()[0] for c in _ROWS.split(", ")]

    def out(rows: list[list]) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(rows), 50_000):
            some = list(zip(*rows[at : at + 50_000]))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(some, kinds)], names=names)

    number, part = None, Part()
    for batch in batches:
        columns = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("part", "key", "n", "conv_id", "ends")]
        for own, key, n, conv_id, ends in zip(*columns):
            if own != number:
                if number is not None:
                    yield from out(part.nodes())
                number, part = own, Part()
            part.add(key, n, conv_id, ends)
    if number is not None:
        yield from out(part.nodes())


def trie(conversations: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """One row per node of the trie of `conversations` (conv_id, ids)."""
    found = common.stored(_dealt(_combined(conversations), part_bytes).mapInArrow(_walk, _ROWS), "trie-nodes")
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    ends = F.coalesce(F.max("ends_sha256"), F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256")
    merged = found.filter("digest IS NOT NULL").groupBy("digest").agg(
        F.max("parent_digest").alias("parent_digest"), F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), *sums, ends
    )
    merged = common.stored(merged, "trie-shared-nodes")
    pending = found.filter("digest IS NULL AND parent_digest IS NOT NULL").drop("parent_conv_id").unionByName(merged)
    parents = merged.select(F.col("digest").alias("parent_digest"), F.col("conv_id").alias("parent_conv_id"), "n_children")
    placed = common.lookup(
        pending.withColumnRenamed("n_children", "kids"), parents, "parent_digest", "n_children", ["parent_conv_id"], F.col("conv_id")
    )
    own = found.filter("digest IS NULL AND parent_digest IS NULL").select(COLUMNS)
    return own.unionByName(placed.withColumnRenamed("kids", "n_children").select(COLUMNS))
