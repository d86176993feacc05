"""Suffix-array duplicate removal: bytes of strings of `length` bytes that start more than once.

Which windows of `length` bytes start anywhere else, is answered with a sparse
suffix array that is sorted by a distributed merge sort.

1. Anchors. In every window the gram (of `gram_length(length)` bytes) with the
   smallest hash is its anchor, so equal windows have their anchors at the same
   place. An anchor stands for the run of window starts that chose it; its
   context is the text of all these windows. Only suffixes at anchors are
   sorted: about one in 140 bytes for windows of 400.
2. Aggregation. A gram that occurs once ends here. Anchors whose whole context
   occurs again are repeated in full. Only contexts that are unique although
   their gram is not (the ends of repeated passages, edits in near copies) and
   one representative of each repeated context of such a gram go on.
3. Sort. Each task sorts the suffixes at its anchors, by the number of the gram
   and then by text, so that even ranges need no sampling. The runs are cut by
   range, front-coded (common prefix with the one before, and the rest), and
   exchanged. A loser tree merges the runs of a range. It carries for each
   candidate the length of the prefix that it is known to share with the last
   winner, so known prefixes are not compared again, and it hands out the common
   prefix of neighbours with the order.
4. Windows. Neighbours that share a gram form a group. A window that starts d
   bytes before the anchor is repeated if another suffix of the group shares
   length - d bytes with this one, which the common prefixes say, and the d bytes
   before both anchors agree.

Grams with over `group_most` different contexts are not gathered; their
windows are counted by hash.

Defined cases: null counts as empty; texts shorter than `length` lose nothing;
rows that repeat an id are documents of their own; equal texts of `length` bytes
or more lose everything.
"""

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallwise.llm import common

#: Window starts that are looked at together; longer documents are taken in such parts.
CHUNK = 1 << 18
#: Suffixes of a sorted run.
RUN = 40_000
GROUP_MOST = 10_000
SMALL_GROUP = 8

_U = np.uint64
_BASE = 0x9E6C63D0A6F6D7F5
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTES = common.mix(np.arange(1001, 1257, dtype=np.uint64))
_powers_held: list[np.ndarray] = []


def gram_length(length: int) -> int:
    return max(1, length * 8 // 25)


def _powers(size: int) -> list[np.ndarray]:
    if not _powers_held or len(_powers_held[0]) < size:
        factors = [np.full(size, base, _U) for base in (_BASE, _INVERSE)]
        for f in factors:
            f[0] = 1
        _powers_held[:] = [np.multiply.accumulate(f) for f in factors]
    return _powers_held


class Hashes:
    """Hashes of the substrings of some bytes, from their prefix sums."""

    def __init__(self, data: np.ndarray):
        powers, self.inverse = _powers(max(1 << 16, 1 << int(len(data) + 1).bit_length()))
        self.sums = np.zeros(len(data) + 1, _U)
        np.cumsum(_BYTES[data] * powers[: len(data)], out=self.sums[1:])

    def of(self, start, end) -> np.ndarray:
        return common.mix((self.sums[end] - self.sums[start]) * self.inverse[start])

    def of_length(self, n: int) -> np.ndarray:
        count = len(self.sums) - n
        return common.mix((self.sums[n:] - self.sums[:count]) * self.inverse[:count])


def sliding_least(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of every `width` neighbours, by running minima from both ends of blocks."""
    n = len(keys) - width + 1
    padded = np.full(-(-len(keys) // width) * width, np.iinfo(np.uint64).max, _U)
    padded[: len(keys)] = keys
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def anchors(raws: list[bytes], length: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each text: the gram, context and place of its anchors. A place packs the
    first window start (32 bits), the anchor's and the last start's distance from it (16 bits each)."""
    gram = gram_length(length)
    none = np.zeros(0, np.int64)
    out: list[list] = [[] for _ in raws]
    batch: list[tuple[int, int, bytes]] = []  # text, offset in it, bytes
    size = 0

    def flush() -> None:
        nonlocal batch, size
        for which, found in zip((b[0] for b in batch), _anchors_of([b[1:] for b in batch], length, gram)):
            out[which].append(found)
        batch, size = [], 0

    for i, raw in enumerate(raws):
        for at in range(0, max(0, len(raw) - length + 1), CHUNK):
            piece = raw[at : at + CHUNK + length - 1]
            if size and size + len(piece) > CHUNK:
                flush()
            batch.append((i, at, piece))
            size += len(piece)
    if batch:
        flush()
    return [tuple(np.concatenate(c) for c in zip(*found)) if found else (none, none, none) for found in out]


def _anchors_of(pieces: list[tuple[int, bytes]], length: int, gram: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    hashes = Hashes(np.frombuffer(b"".join(raw for _, raw in pieces), np.uint8))
    sizes = np.fromiter((len(raw) for _, raw in pieces), np.int64, len(pieces))
    return anchors_in(hashes, sizes, np.fromiter((at for at, _ in pieces), np.int64, len(pieces)), length, gram)


def anchors_in(hashes: Hashes, sizes: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The anchors of pieces that lie one behind the other, each at least `length` long."""
    grams = hashes.of_length(gram)
    keys = (grams >> _U(32) << _U(32)) | np.arange(len(grams), dtype=np.uint64)
    anchor = (sliding_least(keys, length - gram + 1) & _U(0xFFFFFFFF)).astype(np.int64)
    begins = np.cumsum(sizes) - sizes
    counts = sizes - length + 1  # window starts inside a piece
    first = np.cumsum(counts) - counts
    starts = np.repeat(begins - first, counts) + np.arange(counts.sum())
    chosen = anchor[starts]
    new = np.flatnonzero((np.diff(chosen, prepend=-1) != 0) | np.isin(np.arange(len(starts)), first, assume_unique=False))
    s, e, a = starts[new], starts[np.append(new[1:], len(starts)) - 1], chosen[new]
    context = hashes.of(s, e + length) ^ common.mix((a - s).astype(_U) * _U(65536) + (e - s).astype(_U))
    piece = np.searchsorted(begins, s, side="right") - 1
    place = ((s - begins[piece] + offsets[piece]) << 32) | ((a - s) << 16) | (e - s)
    cuts = np.searchsorted(piece, np.arange(1, len(sizes)))
    # Anchors have small hashes; spread again, their numbers fill the range evenly.
    columns = common.mix(grams[a]).view(np.int64), common.mix(context).view(np.int64), place
    return list(zip(*(np.split(c, cuts) for c in columns)))


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    offsets = np.cumsum([0, *map(len, parts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate([*parts, np.zeros(0, np.int64)]), pa.int64()))


def _anchor_rows(length: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                found = anchors(common.byte_texts(part), length)
                columns = [_lists([f[i] for f in found]) for i in range(3)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("k"), *columns], names=["doc_id", "k", "gram", "context", "place"])

    return run


def _common(a: bytes, b: bytes, n: int) -> int:
    """The length of the common prefix, of which n bytes are known."""
    most = min(len(a), len(b))
    while n + 64 <= most and a[n : n + 64] == b[n : n + 64]:
        n += 64
    while n < most and a[n] == b[n]:
        n += 1
    return n


def front_coded(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray, bytes]:
    """Of sorted strings: the prefix each shares with the one before, the length of the rest, all rests."""
    shared = [0, *(_common(a, b, 0) for a, b in zip(keys, keys[1:]))]
    rests = [key[n:] for key, n in zip(keys, shared)]
    return np.array(shared, np.int32), np.array([len(r) for r in rests], np.int32), b"".join(rests)


def decoded(shared: np.ndarray, lengths: np.ndarray, rests: bytes) -> Iterator[tuple[bytes, int]]:
    """The strings of a front-coded run and the prefix each shares with the one before."""
    key, at = b"", 0
    for n, size in zip(shared.tolist(), lengths.tolist()):
        key = key[:n] + rests[at : at + size]
        at += size
        yield key, n


def merge(runs: list[Iterator[tuple[bytes, int]]]) -> Iterator[tuple[int, bytes, int]]:
    """Sorted runs merged by a loser tree: (run, string, prefix shared with the string before).

    `known[r]` is the prefix that the candidate of run r shares with the string
    that last beat it, so a game compares bytes only if both know the same, and
    only from there on. An ended run has None as its candidate and loses.
    """
    count = len(runs)
    now: list[bytes | None] = [None] * count
    known = [0] * count

    def advance(r: int) -> None:
        now[r], known[r] = next(runs[r], (None, 0))

    def play(x: int, y: int) -> tuple[int, int]:
        """(winner, loser); both know their prefix with the same last winner."""
        a, b = now[x], now[y]
        if a is None or b is None:
            return (y, x) if a is None else (x, y)
        if known[x] != known[y]:
            return (x, y) if known[x] > known[y] else (y, x)
        n = _common(a, b, known[x])
        a_first = n == len(a) or (n < len(b) and a[n] < b[n])
        winner, loser = (x, y) if a_first else (y, x)
        known[loser] = n
        return winner, loser

    size = 1 << max(0, count - 1).bit_length()
    for r in range(count):
        advance(r)
        known[r] = 0
    losers = [-1] * size
    level = [r if r < count else -1 for r in range(size)]
    node = size
    while len(level) > 1:
        node //= 2
        above = []
        for i in range(0, len(level), 2):
            x, y = level[i], level[i + 1]
            winner, loser = (x, y) if y < 0 else (y, x) if x < 0 else play(x, y)
            losers[node + i // 2] = loser
            above.append(winner)
        level = above
    winner = level[0] if count else -1
    while winner >= 0 and now[winner] is not None:
        yield winner, now[winner], known[winner]
        leaf = (winner + size) // 2
        advance(winner)
        while leaf:
            other = losers[leaf]
            if other >= 0:
                winner, losers[leaf] = play(winner, other)
            leaf //= 2


def _context_runs(length: int, parts: int):
    """Front-coded sorted runs, cut by range of gram numbers."""

    def emit(rows: list[tuple]) -> pa.RecordBatch:
        rows.sort()
        cuts: dict[int, list[tuple]] = {}
        for row in rows:
            cuts.setdefault(int.from_bytes(row[0][:8], "big") * parts >> 64, []).append(row)
        blobs = []
        for own in cuts.values():
            shared, sizes, rests = front_coded([row[0] for row in own])
            before = np.array([len(row[1]) for row in own], np.int32)
            numbers = np.array([row[2:] for row in own], np.int64)
            blobs.append([shared.tobytes(), sizes.tobytes(), rests, before.tobytes(), b"".join(row[1] for row in own), numbers.tobytes()])
        arrays = [pa.array(list(cuts), pa.int64()), *(pa.array([b[i] for b in blobs], pa.binary()) for i in range(6))]
        return pa.RecordBatch.from_arrays(arrays, names=["part", "shared", "sizes", "rests", "before", "lefts", "numbers"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for batch in batches:
            ids, ks = batch.column("doc_id").to_pylist(), batch.column("k").to_pylist()
            for doc, k, raw, wanted in zip(ids, ks, common.byte_texts(batch), batch.column("wanted").to_pylist()):
                for w in wanted:
                    start, anchor, last = unpacked(w["place"])
                    key = (w["gram"] & 0xFFFFFFFFFFFFFFFF).to_bytes(8, "big") + raw[anchor : last + length]
                    rows.append((key, raw[start:anchor][::-1], doc or 0, doc is None, k, w["place"]))
                if len(rows) >= RUN:
                    yield emit(rows)
                    rows = []
        if rows:
            yield emit(rows)

    return run


def unpacked(place: int) -> tuple[int, int, int]:
    """First window start, anchor, last window start."""
    start = place >> 32
    return start, start + ((place >> 16) & 0xFFFF), start + (place & 0xFFFF)


def repeated_starts(group: list[tuple[bytes, int, int]], length: int) -> list[list[tuple[int, int]]]:
    """For the suffixes of a group, in order: the distances d (ranges, both ends included) whose windows are repeated.

    A suffix comes as (the bytes before its anchor, backwards; the prefix it
    shares with the one before; its own length).
    """
    if len(group) <= SMALL_GROUP:
        out: list[list[tuple[int, int]]] = [[] for _ in group]
        for i in range(len(group)):
            right = length
            for j in range(i + 1, len(group)):
                right = min(right, group[j][1])
                low, high = length - right, _common(group[i][0], group[j][0], 0)
                if low <= high:
                    out[i].append((low, high))
                    out[j].append((low, high))
        return out
    lefts = np.array([len(g[0]) for g in group])
    least = length - np.array([g[2] for g in group])
    shared = np.array([g[1] for g in group])
    width = int(lefts.max())
    matrix = np.zeros((len(group), width), np.uint8)
    row = np.repeat(np.arange(len(group)), lefts)
    matrix[row, np.arange(len(row)) - np.repeat(np.cumsum(lefts) - lefts, lefts)] = np.frombuffer(b"".join(g[0] for g in group), np.uint8)
    powers = _powers(1 << 16)[0]
    found = np.zeros((len(group), width + 2), bool)
    left = np.zeros(len(group), _U)
    for d in range(width + 1):
        if d:
            left = left + _BYTES[matrix[:, d - 1]] * powers[d]
        active = np.flatnonzero((lefts >= d) & (least <= d))
        if len(active) > 1:
            cluster = np.cumsum(shared < length - d)[active]
            _, inverse, counts = np.unique(common.mix(left[active] + cluster.astype(_U) * _U(_INVERSE)), return_inverse=True, return_counts=True)
            found[active, d + 1] = counts[inverse] > 1
    edges = np.diff(found.view(np.int8), axis=1, append=0)
    ranges: list[list[tuple[int, int]]] = []
    for own in edges:
        ranges.append(list(zip(np.flatnonzero(own == 1).tolist(), (np.flatnonzero(own == -1) - 1).tolist())))
    return ranges


_SPANS = "doc_id long, k long, start long, end long"


def _merged(length: int):
    """Spans of repeated windows from the runs of a task's ranges."""

    def ranges(runs: list[dict[str, bytes]]) -> Iterator[tuple]:
        columns = [[np.frombuffer(r["shared"], np.int32), np.frombuffer(r["sizes"], np.int32), r["rests"]] for r in runs]
        befores = [np.concatenate([[0], np.cumsum(np.frombuffer(r["before"], np.int32))]) for r in runs]
        numbers = [np.frombuffer(r["numbers"], np.int64).reshape(-1, 4) for r in runs]
        at = [0] * len(runs)
        least = 8 + gram_length(length)
        group: list[tuple[bytes, int, int]] = []
        refs: list[tuple] = []
        for r, key, shared in merge([decoded(*c) for c in columns]):
            if shared < least:
                yield from found(group, refs)
                group, refs = [], []
            i = at[r]
            at[r] += 1
            ref = tuple(numbers[r][i].tolist())
            left = runs[r]["lefts"][befores[r][i] : befores[r][i + 1]]
            group.append((left, shared - 8, len(key) - 8))
            refs.append(ref)
        yield from found(group, refs)

    def found(group: list[tuple[bytes, int, int]], refs: list[tuple]) -> Iterator[tuple]:
        if len(set(refs)) < len(refs):  # rows that repeat both id and text
            kept: dict[tuple, tuple] = {}
            shared = length
            for g, ref in zip(group, refs):
                shared = min(shared, g[1])
                if ref not in kept:
                    kept[ref] = (g[0], shared, g[2])
                    shared = length
            group, refs = list(kept.values()), list(kept)
        if len(group) < 2:
            return
        for ref, spans in zip(refs, repeated_starts(group, length)):
            _, anchor, _ = unpacked(ref[3])
            for low, high in spans:
                yield None if ref[1] else ref[0], ref[2], anchor - high, anchor - low + length

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[dict[str, bytes]]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                held.setdefault(row.pop("part"), []).append(row)
        for runs in held.values():
            out = list(ranges(runs))
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], pa.int64()) for i in range(4)], names=["doc_id", "k", "start", "end"])

    return run


def _window_rows(length: int):
    """(window, doc_id, k, start) of all windows of the wanted contexts."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, k, raw, wanted in zip(batch.column("doc_id").to_pylist(), batch.column("k").to_pylist(), common.byte_texts(batch), batch.column("wanted").to_pylist()):
                for w in wanted:
                    start, _, last = unpacked(w["place"])
                    windows = Hashes(np.frombuffer(raw[start : last + length], np.uint8)).of_length(length).view(np.int64)
                    n = len(windows)
                    arrays = [pa.array(windows), pa.array([doc] * n, pa.int64()), pa.array([k] * n, pa.int64()), pa.array(np.arange(start, start + n))]
                    yield pa.RecordBatch.from_arrays(arrays, names=["window", "doc_id", "k", "start"])

    return run


def _same(a: DataFrame, b: DataFrame):
    return a["doc_id"].eqNullSafe(b["doc_id"]) & (a["k"] == b["k"])


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, k, text): k tells texts of one id apart."""
    rows = common.text_rows(docs, id_col, text_col)
    return rows.select("doc_id", F.xxhash64("text").alias("k"), "text")


def repeated_spans(docs: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text", group_most: int = GROUP_MOST) -> DataFrame:
    """(doc_id, k, start, end): byte ranges that repeated strings cover; they may overlap."""
    rows = _keyed(docs, id_col, text_col)
    kinds = "doc_id long, k long, gram array<long>, context array<long>, place array<long>"
    by_document = common.stored(rows.mapInArrow(_anchor_rows(length), kinds), "suffix-anchors")
    every = by_document.select("doc_id", "k", F.inline(F.arrays_zip("gram", "context", "place")))
    grams = every.groupBy("gram").agg(F.count("*").alias("n"), F.min("context").alias("low"), F.max("context").alias("high"))
    # Joined as tables of their own, so that a gram that fills a partition can be split.
    grams = common.stored(grams.filter("n > 1").select("gram", (F.col("low") != F.col("high")).alias("mixed")), "suffix-grams")
    again = common.stored(every.join(grams, "gram"), "suffix-repeated")
    least = F.min(F.struct("doc_id", "k", "place")).alias("first")
    contexts = common.stored(again.filter("mixed").groupBy("gram", "context").agg(F.count("*").alias("n"), least), "suffix-contexts")
    single = F.sum((F.col("n") == 1).cast("long")).alias("single")
    open_grams = contexts.groupBy("gram").agg(F.count("*").alias("contexts"), single).filter("single > 0")
    open_grams = common.stored(open_grams, "suffix-open-grams")
    wanted = contexts.join(open_grams, "gram").select("gram", "first.*", (F.col("contexts") > group_most).alias("hot"))
    wanted = common.stored(wanted, "suffix-wanted")
    place = F.col("place")
    whole = F.shiftright(place, 32).alias("start"), (F.shiftright(place, 32) + place.bitwiseAND(F.lit(0xFFFF)) + length).alias("end")
    closed = again.filter("NOT mixed").unionByName(
        again.filter("mixed").join(contexts.filter("n > 1").select("gram", "context"), ["gram", "context"], "left_semi")
    ).select("doc_id", "k", *whole)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def with_text(chosen: DataFrame) -> DataFrame:
        lists = chosen.groupBy("doc_id", "k").agg(F.collect_list(F.struct("gram", "place")).alias("wanted"))
        return rows.join(lists, _same(rows, lists)).select(rows["doc_id"], rows["k"], "text", "wanted")

    runs = with_text(wanted.filter("NOT hot")).mapInArrow(
        _context_runs(length, 4 * parts), "part long, shared binary, sizes binary, rests binary, before binary, lefts binary, numbers binary"
    )
    spans = closed.unionByName(runs.repartition(parts, "part").mapInArrow(_merged(length), _SPANS))
    if wanted.filter("hot").isEmpty():
        return spans
    windows = common.stored(with_text(wanted.filter("hot")).mapInArrow(_window_rows(length), "window long, doc_id long, k long, start long").distinct(), "suffix-windows")
    repeated = windows.groupBy("window").agg(F.count("*").alias("n")).filter("n > 1").select("window")
    hot = windows.join(repeated, "window", "left_semi").select("doc_id", "k", "start", (F.col("start") + length).alias("end"))
    return spans.unionByName(hot)


def _cut(digests: bool):
    """Removes the spans from the texts."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for raw, spans in zip(common.byte_texts(batch), batch.column("spans").to_pylist()):
                kept, at, removed, count, end = [], 0, 0, 0, -1
                for span in sorted((s["start"], s["end"]) for s in spans or ()):
                    if span[0] > end:
                        count += 1
                        kept.append(raw[at : span[0]])
                        removed += span[1] - span[0]
                        end = at = span[1]
                    elif span[1] > end:
                        removed += span[1] - end
                        end = at = span[1]
                rest = b"".join([*kept, raw[at:]])
                out.append((len(raw), removed, count, hashlib.sha256(rest).hexdigest() if digests else rest))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string() if digests else pa.binary())
            arrays = [pa.array([o[i] for o in out], kind) for i, kind in enumerate(kinds)]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256" if digests else "kept", "shares_passage"]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays, batch.column("shares_passage")], names=names)

    return run


def without_repeats(
    docs: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text", digests: bool = False,
    group_most: int = GROUP_MOST, passages: DataFrame | None = None,
) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, and the bytes that are left, or their SHA-256.

    `passages` (doc_id, k) are documents that shares_passage is true for, as found
    by shared_passages.sharing; it has no part in what is removed.
    """
    spans = repeated_spans(docs, length, id_col, text_col, group_most).withColumn("shares", F.lit(False))
    if passages is not None:
        spans = spans.unionByName(passages.withColumn("shares", F.lit(True)), allowMissingColumns=True)
    own = F.collect_list(F.when(F.col("start").isNotNull(), F.struct("start", "end")))
    lists = spans.groupBy("doc_id", "k").agg(own.alias("spans"), F.max("shares").alias("shares"))
    rows = _keyed(docs, id_col, text_col)
    shares = F.coalesce("shares", F.lit(False)).alias("shares_passage")
    joined = rows.join(lists, _same(rows, lists), "left").select(rows["doc_id"], "text", "spans", shares)
    last = "kept_sha256 string" if digests else "kept binary"
    found = joined.mapInArrow(_cut(digests), f"doc_id long, n_bytes long, n_removed long, n_spans long, {last}, shares_passage boolean")
    return found if passages is not None else found.drop("shares_passage")
