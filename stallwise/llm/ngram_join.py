"""Exact Jaccard join on word n-grams that returns each document's group.

Set-relation skipping, in five steps:

1. A fixed-size count sketch over the shingles of all documents gives every
   shingle a rank; sets are ordered rare shingles first. The rank only orders:
   a poor one costs time, never a link.
2. Documents with the same set are one node. Two sets can only be linked if
   they share a shingle of their prefixes, so prefixes are dealt to index lists
   by shingle, as packed blocks.
3. Lists are cut into blocks by size and position. A pair of blocks whose sizes
   or positions rule out enough overlap is skipped as a whole; sets without a
   possible partner leave the list. What is left gets a leader, the smallest
   node of the list, and only (leader, member) rows go on: linear in the list.
   Members of a group whose shingle counts by part of the hash space bound every
   overlap below what a link needs leave it as well.
4. The sets of a leader's group meet. Their answers are derived from the
   leader's: with what each set lacks of the leader and what it has beyond it,
   an overlap follows from the differences alone, and shingles that a single
   set differs in are never looked at. Groups above a bound on sets or shingles
   are dealt in pairs of blocks. Only a tree of links per group comes out.
5. The links are merged into components.

Lists of very frequent shingles are not gathered at all: their leaders are
found by aggregation over (shingle, size band).

Defined cases: null and empty texts and texts without words have no shingles,
are linked with nothing and are their own group; rows that repeat an id are
documents of that id, so groups and ids stay well defined; a null id counts as
the id of its group's other documents if there are any.
"""

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallwise.llm import common
from stallwise.llm.shingles import shingle_sets

SKETCH_BITS = 20
#: Lists of shingles that so many documents have (above the sketch's usual count) are not gathered.
HOT_LIST = 20_000
ENTRIES_PER_PART = 2_000_000
#: A group that meets in one task has at most so many sets and shingles (or is one pair of blocks).
GROUP_SETS, GROUP_SHINGLES = 1_000, 2_000_000
#: Groups of more sets than this skip the bound by counts.
COUNTED_SETS = 2_000
PARTS = 256
BLOCK = 64

_U = np.uint64


def _raws(batch: pa.RecordBatch, step: int = 200) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    for at in range(0, batch.num_rows, step):
        part = batch.slice(at, step)
        yield part, common.byte_texts(part)


def _cell(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> _U(64 - SKETCH_BITS)).astype(np.int64)


def _sketch(rows: DataFrame, width: int) -> np.ndarray:
    """How many (document, shingle) pairs fall into each cell; a fixed 4 MB."""
    block = 1024

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << SKETCH_BITS, np.int64)
        for batch in batches:
            for _, raws in _raws(batch):
                total += np.bincount(_cell(np.concatenate(shingle_sets(raws, width))), minlength=len(total))
        yield _packed({k: total[k * block : (k + 1) * block] for k in range(len(total) // block)})

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, kind, raw in zip(*(batch.column(i).to_pylist() for i in range(3))):
                sums[k] = sums.get(k, 0) + np.frombuffer(raw, kind).astype(np.int64)
        yield _packed(sums)

    def _packed(parts: dict[int, np.ndarray]) -> pa.RecordBatch:
        small = [p.astype(np.min_scalar_type(int(p.max(initial=0)))) for p in parts.values()]
        arrays = [pa.array(list(parts), pa.int32()), pa.array([p.dtype.str for p in small], pa.string()), pa.array([p.tobytes() for p in small], pa.binary())]
        return pa.RecordBatch.from_arrays(arrays, names=["block", "kind", "counts"])

    kind = "block int, kind string, counts binary"
    parts = rows.select("text").mapInArrow(count, kind).repartition("block").mapInArrow(add, kind)
    out = np.zeros(1 << SKETCH_BITS, np.int64)
    for row in parts.collect():  # 1,024 rows of at most 8 KB
        out[row["block"] * block : (row["block"] + 1) * block] = np.frombuffer(row["counts"], row["kind"])
    return out


def prefix_length(n: int, percent: int) -> int:
    """Shingles of a set of n of which a linked set must share one, if both are ordered alike."""
    return n + (-percent * n // 100) + 1


def _needed(a, b, percent: int):
    """The overlap that links sets of these sizes."""
    return -(-percent * (a + b) // (100 + percent))


def _prefixes(rank, width: int, percent: int):
    """(doc_id, n, signature, counts, prefix): the prefix holds tokens, the rank in the top byte and 56 bits of the shingle."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = rank.value.astype(_U) << _U(56)
        for batch in batches:
            for part, raws in _raws(batch):
                sizes, signatures, counts, prefixes = [], [], [], []
                for own in shingle_sets(raws, width):
                    tokens = np.sort(top[_cell(own)] | (own >> _U(8)))
                    sizes.append(len(own))
                    counts.append(part_counts(own))
                    signatures.append(signature(own))
                    prefixes.append(tokens[: prefix_length(len(own), percent)].tobytes())
                arrays = [part.column("doc_id"), pa.array(sizes, pa.int64()), *(pa.array(x, pa.binary()) for x in (signatures, counts, prefixes))]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n", "signature", "counts", "prefix"])

    return run


def part_counts(own: np.ndarray) -> bytes:
    """How many shingles fall into each part of the hash space, in as few bytes as the largest needs."""
    counts = np.bincount((own & _U(PARTS - 1)).astype(np.int64), minlength=PARTS)
    return counts.astype(np.min_scalar_type(int(counts.max()))).tobytes()


def may_link(sizes: np.ndarray, counts: list[bytes], percent: int) -> np.ndarray:
    """Which sets have a partner for which the counts by part allow enough overlap."""
    kinds = {PARTS: np.uint8, 2 * PARTS: np.uint16, 4 * PARTS: np.uint32}
    matrix = np.stack([np.frombuffer(raw, kinds[len(raw)]).astype(np.int32) for raw in counts])
    found = np.zeros(len(sizes), bool)
    for i in range(len(sizes) - 1):
        other = slice(i + 1, None)
        most = np.minimum(matrix[i], matrix[other]).sum(axis=1)
        fits = most >= _needed(sizes[i], sizes[other], percent)
        found[other] |= fits
        found[i] |= fits.any()
    return found


def signature(own: np.ndarray) -> bytes:
    """128 bits of a set: two sums of bijections of its shingles."""
    first, second = common.mix(own), common.mix(own ^ _U(0x5851F42D4C957F2D))
    return np.array([first.sum(dtype=_U), second.sum(dtype=_U) + _U(len(own))], _U).tobytes()


def _entries(nodes: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """Token, node, n and position of every prefix entry."""
    prefixes = [np.frombuffer(raw, _U) for raw in nodes.column("prefix").to_pylist()]
    lengths = np.fromiter(map(len, prefixes), np.int64, len(prefixes))
    tokens = np.concatenate([*prefixes, np.zeros(0, _U)])
    at = np.arange(len(tokens)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    numbers = [np.repeat(nodes.column(c).to_numpy(zero_copy_only=False).astype(np.int64), lengths) for c in ("node", "n")]
    return tokens, *numbers, at


def _dealt(parts: int, hot_rank: int):
    """The entries of lists that are gathered, packed by part."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens, node, n, at = _entries(batch)
            cool = (tokens >> _U(56)) < _U(hot_rank)
            tokens, node, n, at = tokens[cool], node[cool], n[cool], at[cool]
            part = (common.mix(tokens) % _U(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            cuts = np.flatnonzero(np.diff(part[order], prepend=-1, append=parts))
            rows = [order[a:b] for a, b in zip(cuts, cuts[1:])]
            blobs = [[x[r].astype(kind).tobytes() for r in rows] for x, kind in ((tokens, "<u8"), (node, "<i8"), (n, "<i4"), (at, "<i4"))]
            arrays = [pa.array([int(part[r[0]]) for r in rows], pa.int64()), *(pa.array(b, pa.binary()) for b in blobs)]
            yield pa.RecordBatch.from_arrays(arrays, names=["part", "tokens", "nodes", "sizes", "places"])

    return run


def possible(n: np.ndarray, at: np.ndarray, m: np.ndarray, there: np.ndarray, percent: int) -> np.ndarray:
    """Which entries (n, at) and (m, there) of one list can belong to linked sets, as a matrix."""
    n, at, m, there = n[:, None], at[:, None], m[None, :], there[None, :]
    small, place = np.minimum(n, m), np.where(n <= m, at, there)
    sizes = 100 * small >= percent * np.maximum(n, m)
    indexed = place < small - _needed(small, small, percent) + 1
    indexed |= (n == m) & (np.minimum(at, there) < small - _needed(small, small, percent) + 1)
    overlap = np.minimum(at, there) + 1 + np.minimum(n - at - 1, m - there - 1)
    return sizes & indexed & (overlap >= _needed(n, m, percent))


def partners(n: np.ndarray, at: np.ndarray, percent: int) -> np.ndarray:
    """Which entries of a list have a possible partner; whole pairs of blocks are skipped by size and position."""
    found = np.zeros(len(n), bool)
    order = np.lexsort((at, n))
    blocks = [order[i : i + BLOCK] for i in range(0, len(order), BLOCK)]
    bounds = [(n[b].min(), n[b].max(), at[b].max(), (n[b] - at[b] - 1).max()) for b in blocks]
    for i, one in enumerate(blocks):
        for j in range(i, len(blocks)):
            low, high = bounds[i], bounds[j]
            if 100 * low[1] < percent * high[0]:
                break  # sizes only grow from here
            if min(low[2], high[2]) + 1 + min(low[3], high[3]) < _needed(low[0], high[0], percent):
                continue
            other = blocks[j]
            if found[one].all() and found[other].all():
                continue
            match = possible(n[one], at[one], n[other], at[other], percent)
            if i == j:
                np.fill_diagonal(match, False)
            found[one] |= match.any(axis=1)
            found[other] |= match.any(axis=0)
    return found


def _lists(percent: int):
    """(leader, member, n) of the lists of a task."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [[], [], [], []]
        for batch in batches:
            for own, (name, kind) in zip(held, (("tokens", "<u8"), ("nodes", "<i8"), ("sizes", "<i4"), ("places", "<i4"))):
                own += [np.frombuffer(raw, kind) for raw in batch.column(name).to_pylist()]
        if not held[0]:
            return
        tokens, node, n, at = (np.concatenate(own) for own in held)
        n, at = n.astype(np.int64), at.astype(np.int64)
        order = np.argsort(tokens, kind="stable")
        cuts = np.flatnonzero(np.diff(tokens[order], prepend=tokens[order[0]] ^ _U(1)))
        cuts = np.append(cuts, len(order))
        several = np.flatnonzero(np.diff(cuts) > 1)
        seen: set[tuple[int, int, int]] = set()
        for a, b in zip(cuts[several].tolist(), cuts[several + 1].tolist()):
            own = order[a:b]
            own = own[partners(n[own], at[own], percent)]
            own = own[np.argsort(n[own], kind="stable")]
            gaps = np.flatnonzero(100 * n[own][:-1] < percent * n[own][1:]) + 1
            for run_ in np.split(own, gaps):
                if len(run_) > 1:
                    leader = int(node[run_].min())
                    seen.update((leader, x, y) for x, y in zip(node[run_].tolist(), n[run_].tolist()))
            if len(seen) > 50_000:
                yield _rows_of(list(seen))
                seen = set()
        yield _rows_of(list(seen))

    return run


def _rows_of(rows: list[tuple[int, int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(3)], names=["leader", "member", "n"])


def _counted(percent: int):
    """The (leader, member, n) rows whose member may have a partner in its group; rows come sorted by leader."""

    def chosen(group: list[tuple[int, int, int, bytes]]) -> list[tuple[int, int, int]]:
        if len(group) < 2:
            return []
        found = may_link(np.array([g[2] for g in group]), [g[3] for g in group], percent)
        return [g[:3] for g, yes in zip(group, found) if yes]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple[int, int, int, bytes]] = []
        for batch in batches:
            out: list[tuple[int, int, int]] = []
            for row in zip(*(batch.column(c).to_pylist() for c in ("leader", "member", "n", "counts"))):
                if group and row[0] != group[0][0]:
                    out += chosen(group)
                    group = []
                group.append(row)
            yield _rows_of(out)
        yield _rows_of(chosen(group))

    return run


def _hot_rows(hot_rank: int, percent: int):
    """(token, band, node, n) of the lists that are not gathered; linked sets share a band."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens, node, n, _ = _entries(batch)
            hot = (tokens >> _U(56)) >= _U(hot_rank)
            tokens, node, n = tokens[hot].view(np.int64), node[hot], n[hot]
            band = np.floor(np.log(n) / np.log(100 / percent) + 1e-9).astype(np.int64)
            arrays = [np.concatenate([x, x]) for x in (tokens, node, n)]
            arrays = [arrays[0], np.concatenate([band, band + 1]), *arrays[1:]]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in arrays], names=["token", "band", "node", "n"])

    return run


def link_tree(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that connect the same sets as all links between these sets do: (first of the component, other).

    The overlaps of two sets follow from their differences from the first set.
    """
    sizes = np.array([len(x) for x in sets], np.int64)
    m = len(sets)
    if m == 2:
        both = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return [(0, 1)] if 100 * both >= percent * (sizes.sum() - both) else []
    hub = sets[0]
    rows, features, lacking = [], [], np.zeros(m, np.int64)
    for i, own in enumerate(sets):
        differs = np.setxor1d(own, hub, assume_unique=True)
        lacking[i] = (len(differs) - len(own) + len(hub)) // 2
        rows.append(np.full(len(differs), i))
        features.append(differs)
    row, (_, feature, counts) = np.concatenate(rows), np.unique(np.concatenate(features), return_inverse=True, return_counts=True)
    shared = np.zeros((m, m), np.float32)
    order = np.argsort(feature, kind="stable")
    row, starts = row[order], np.cumsum(counts) - counts
    for c in range(2, 17):  # differences that few sets share: pair by pair
        group = row[starts[counts == c][:, None] + np.arange(c)]
        for i in range(c):
            for j in range(i + 1, c):
                np.add.at(shared, (group[:, i], group[:, j]), 1)
    often = np.flatnonzero(counts > 16)
    shared += shared.T
    for at in range(0, len(often), 2048):  # those that many share: as a product
        chosen = often[at : at + 2048]
        matrix = np.zeros((m, len(chosen)), np.float32)
        for k, f in enumerate(chosen.tolist()):
            matrix[row[starts[f] : starts[f] + counts[f]], k] = 1
        shared += matrix @ matrix.T
    both = len(hub) - lacking[:, None] - lacking[None, :] + shared.astype(np.int64)
    linked = 100 * both >= percent * (sizes[:, None] + sizes[None, :] - both)
    np.fill_diagonal(linked, False)
    out, left = [], linked.any(axis=1)
    for i in range(m):
        if left[i]:
            left[i] = False
            edge = np.flatnonzero(linked[i] & left)
            while len(edge):
                left[edge] = False
                out += [(i, j) for j in edge.tolist()]
                edge = np.flatnonzero(linked[edge].any(axis=0) & left)
    return out


def _met(percent: int):
    """Links of the groups of a task; rows come sorted by group.

    Where a group is one of several parts of a list, its members that are not
    connected to the head, which all parts have, come too, with no partner: only
    those have to meet the other parts.
    """

    def links(group: dict[int, bytes], key: tuple, head: int, parts: int) -> list[tuple]:
        tree = _tree(group, percent)
        out = [(key[0], a, b) for a, b in tree]
        if parts > 1:
            near: dict[int, list[int]] = {}
            for a, b in tree:
                near.setdefault(a, []).append(b)
                near.setdefault(b, []).append(a)
            known, todo = {head}, [head]
            while todo:
                new = [x for x in near.get(todo.pop(), ()) if x not in known]
                known.update(new)
                todo += new
            out += [(key[0], node, None) for node in group if node not in known]
        return out

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, group, about, out = None, {}, (0, 0), []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("leader", "i", "j", "member", "head", "parts", "shingles")]
            for leader, i, j, node, head, parts, raw in zip(*columns):
                if (leader, i, j) != now:
                    if now is not None:
                        out += links(group, now, *about)
                    now, group, about = (leader, i, j), {}, (head, parts)
                group[node] = raw
            if len(out) > 50_000:
                yield _edges(out)
                out = []
        yield _edges(out + (links(group, now, *about) if now is not None else []))

    return run


def _tree(group: dict[int, bytes], percent: int) -> list[tuple[int, int]]:
    if len(group) < 2:
        return []
    nodes = sorted(group)
    return [(nodes[a], nodes[b]) for a, b in link_tree([np.frombuffer(group[k], _U) for k in nodes], percent)]


def _edges(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(3)], names=["leader", "a", "b"])


def _links(members: DataFrame, sets: DataFrame, percent: int, group_sets: int, group_shingles: int) -> DataFrame:
    """(a, b): links that connect what is connected within each list.

    A list that is too large for a task is met in parts, each with the list's
    head. What is connected to the head is in one component with all others that
    are, so only the rest meets the other parts: a list of near copies costs as
    many rows as it has members.
    """
    sized = members.groupBy("leader").agg(F.count("*").alias("sets"), F.sum("n").alias("shingles"), F.min("member").alias("head"))
    parts = F.ceil(F.greatest(F.col("sets") / group_sets, F.col("shingles") / group_shingles)).cast("long")
    sized = sized.filter("sets > 1").select("leader", "head", "sets", parts.alias("parts"))
    own = F.pmod(F.xxhash64("member"), F.col("parts"))
    placed = members.select("leader", "member").join(sized, "leader").withColumn("own", own)
    every = F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)
    where = F.explode(F.when(F.col("member") == F.col("head"), every).otherwise(F.array("own"))).alias("i")

    def met(dealt: DataFrame) -> DataFrame:
        meeting = dealt.join(sets, "member").repartition("leader", "i", "j").sortWithinPartitions("leader", "i", "j")
        return meeting.select("leader", "i", "j", "member", "head", "parts", "shingles").mapInArrow(_met(percent), "leader long, a long, b long")

    none = F.lit(0).cast("long")
    first = common.stored(met(placed.select("leader", "member", "head", "parts", where, none.alias("j"))), "ngram-links")
    rest = common.stored(first.filter("b IS NULL").select("leader", F.col("a").alias("member")).distinct(), "ngram-rest")
    edges = first.filter("b IS NOT NULL").select("a", "b")
    if rest.isEmpty():
        return edges
    share = F.ceil(F.count("*") * F.first("parts") / F.first("sets")).cast("long")
    counted = rest.join(sized, "leader").groupBy("leader").agg(share.alias("rests"), F.first("parts").alias("parts"))
    others = placed.drop("parts").join(counted, "leader").select(
        "leader", "member", F.col("own").alias("i"), F.explode(F.sequence(none, F.col("rests") - 1)).alias("j")
    )
    mine = rest.join(counted, "leader").select(
        "leader", "member", F.explode(every).alias("i"), F.pmod(F.xxhash64("member"), F.col("rests")).alias("j")
    )
    both = others.unionByName(mine).select("*", none.alias("head"), F.lit(1).cast("long").alias("parts"))
    return edges.unionByName(met(both).select("a", "b"))


def _sets_of(width: int):
    """(node, shingles) of rows (node, signature, text) whose text has that signature."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, raws in _raws(batch):
                nodes, kept = [], []
                for node, wanted, own in zip(part.column("node").to_pylist(), part.column("signature").to_pylist(), shingle_sets(raws, width)):
                    if signature(own) == wanted:
                        nodes.append(node)
                        kept.append(own.tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(kept, pa.binary())], names=["member", "shingles"])

    return run


def linked(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80,
    hot_list: int = HOT_LIST, group_sets: int = GROUP_SETS, group_shingles: int = GROUP_SHINGLES,
) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id (the smallest id reachable by links)."""
    spark = docs.sparkSession
    rows = common.text_rows(docs, id_col, text_col)
    counts = _sketch(rows, width)
    rank = np.minimum(255, 4 * np.log2(np.maximum(counts, 1))).astype(np.uint8)
    usual = float(np.median(counts))
    hot_rank = int(min(255, 4 * np.log2(max(1.0, usual + max(hot_list, 8 * usual**0.5)))))
    marked = common.stored(
        rows.mapInArrow(_prefixes(spark.sparkContext.broadcast(rank), width, percent), "doc_id long, n long, signature binary, counts binary, prefix binary"),
        "ngram-prefixes",
    )
    nodes = marked.filter("n > 0").groupBy("signature").agg(
        F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("counts").alias("counts"), F.first("prefix").alias("prefix"), F.count("*").alias("copies")
    )
    nodes = common.stored(nodes.withColumn("node", F.monotonically_increasing_id()), "ngram-nodes")
    entries = nodes.agg(F.sum(F.length("prefix"))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), entries // 8 // ENTRIES_PER_PART)
    indexed = nodes.select("node", "n", "prefix")
    blocks = indexed.mapInArrow(_dealt(4 * parts, hot_rank), "part long, tokens binary, nodes binary, sizes binary, places binary")
    grouped = blocks.repartition(parts, "part").mapInArrow(_lists(percent), "leader long, member long, n long")
    if (rank >= hot_rank).any():
        hot = common.stored(indexed.mapInArrow(_hot_rows(hot_rank, percent), "token long, band long, node long, n long"), "ngram-hot")
        leaders = hot.groupBy("token", "band").agg(F.min("node").alias("leader"), F.count("*").alias("lists")).filter("lists > 1")
        met = hot.join(leaders, ["token", "band"]).select("leader", F.col("node").alias("member"), "n")
        grouped = grouped.unionByName(met)
    listed = common.stored(grouped.distinct(), "ngram-listed")
    listed_sets = listed.groupBy("leader").agg(F.count("*").alias("sets")).filter("sets > 1")
    listed = listed.join(listed_sets, "leader")
    counted = listed.filter(F.col("sets") <= COUNTED_SETS).join(nodes.select(F.col("node").alias("member"), "counts"), "member")
    counted = counted.select("leader", "member", "n", "counts").repartition("leader").sortWithinPartitions("leader")
    passed = counted.mapInArrow(_counted(percent), "leader long, member long, n long")
    members = common.stored(passed.unionByName(listed.filter(F.col("sets") > COUNTED_SETS).drop("sets")), "ngram-members")
    # Text of the nodes that have possible partners, found by one of their documents.
    involved = members.select(F.col("member").alias("node")).distinct().join(nodes.select("node", "rep", "signature"), "node")
    texts = rows.join(involved, rows["doc_id"].eqNullSafe(involved["rep"])).select("node", "signature", "text")
    sets = common.stored(texts.mapInArrow(_sets_of(width), "member long, shingles binary"), "ngram-sets")
    edges = _links(members, sets, percent, group_sets, group_shingles)
    found = common.components(edges)
    labelled = nodes.select("node", "signature", "rep", "copies").join(found, "node", "left")
    labelled = labelled.withColumn("component", F.coalesce("component", "node"))
    smallest = labelled.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = common.stored(labelled.join(smallest, "component").select("signature", "copies", "component_id"), "ngram-components")
    out = common.lookup(marked.select("doc_id", "n", "signature"), named, "signature", "copies", ["component_id"], F.xxhash64("doc_id"))
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group, the one with the smallest id; the columns stay as they are."""
    found = linked(docs, id_col, text_col, width, percent)
    return common.drop_rows(docs, found.select("doc_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")), id_col)
