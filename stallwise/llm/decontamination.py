"""Benchmark decontamination with an FM-index of each shard of the training text.

Words are runs of ASCII letters, digits and non-ASCII characters, A-Z
lower-cased. The windows of a benchmark item are its runs of ten words; an item
with fewer words, but some, is one window. A task cuts its documents into shards
of whole documents, builds an FM-index of each (suffix order, Burrows-Wheeler
transform in a wavelet matrix, sampled suffix positions), and searches all
windows backwards in it, all at once. Occurrences are located by walking to a
sampled position, and overlapping ones are merged into spans of word positions.

A window cannot contain a word that no window contains, so only runs of known
words that are long enough for the shortest window enter the index; a separator
ends each. Nothing is lost by that, and documents are never shuffled.

The benchmark is read in blocks of bounded size (`BLOCK_BYTES` of text), and
the documents pass through one search for each block.

Defined cases: null and empty texts have no words and no hits; an empty
benchmark hits nothing; items that repeat an id count once, items without an id
share the name ''.
"""

from collections.abc import Iterable, Iterator
from functools import cached_property
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallwise.llm import common

WINDOW = 10
#: Benchmark text that is searched for (and sent to the executors) at once.
BLOCK_BYTES = 2 * 1024 * 1024
SHARD_BYTES = 1024 * 1024

_WORD_BYTES = bytes(b if b in common.LOWER.encode() + b"0123456789" or b > 127 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def words(raw: bytes) -> list[bytes]:
    return raw.translate(_WORD_BYTES).split()


class Windows:
    """The windows of some benchmark items as rows of word numbers, from 1 on."""

    def __init__(self, items: Iterable[tuple[str, bytes]], length: int = WINDOW):
        self.numbers: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = {}
        for item, raw in items:
            known = [self.numbers.setdefault(w, len(self.numbers) + 1) for w in words(raw)]
            for i in range(max(1, len(known) - length + 1) if known else 0):
                owners.setdefault(tuple(known[i : i + length]), set()).add(item)
        self.by_length: dict[int, tuple[np.ndarray, list[set[str]]]] = {}
        for n in sorted({len(w) for w in owners}):
            of_length = [w for w in owners if len(w) == n]
            self.by_length[n] = np.array(of_length, dtype=np.int64), [owners[w] for w in of_length]

    @cached_property
    def shortest(self) -> int:
        return min(self.by_length, default=1)


class ShardIndex:
    """FM-index of a sequence of word numbers in which 0 separates parts and comes last."""

    def __init__(self, symbols: np.ndarray, largest: int, sample: int = 8):
        n = len(symbols)
        order = _suffix_order(symbols)
        before = symbols[order - 1]
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=largest + 1))])
        # Walks end at the latest where a part begins, so they never step over a separator.
        self.positions = np.where((order % sample == 0) | (before == 0), order, -1)
        self.levels: list[tuple[np.ndarray, int]] = []
        self.bits = max(1, int(largest).bit_length())
        for level in reversed(range(self.bits)):
            bit = (before >> level) & 1
            self.levels.append((np.concatenate([[0], np.cumsum(bit)]).astype(np.int32), n - int(bit.sum())))
            before = np.concatenate([before[bit == 0], before[bit == 1]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before its place in the transform."""
        start = np.zeros_like(at)
        for level, (ones, zeros) in zip(reversed(range(self.bits)), self.levels):
            bit = ((symbol >> level) & 1).astype(bool)
            at = np.where(bit, zeros + ones[at], at - ones[at])
            start = np.where(bit, zeros + ones[start], start - ones[start])
        return at - start

    def step(self, row: np.ndarray) -> np.ndarray:
        """The rows of the suffixes that begin one symbol earlier."""
        symbol, at, start = np.zeros_like(row), row, np.zeros_like(row)
        for ones, zeros in self.levels:
            bit = (ones[at + 1] - ones[at]).astype(bool)
            symbol = symbol * 2 + bit
            at = np.where(bit, zeros + ones[at], at - ones[at])
            start = np.where(bit, zeros + ones[start], start - ones[start])
        return self.starts[symbol] + at - start

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which patterns (rows) occur, and the range of rows of each in suffix order."""
        which = np.arange(len(patterns))
        low, high = self.starts[patterns[:, -1]], self.starts[patterns[:, -1] + 1]
        for k in range(patterns.shape[1] - 2, -1, -1):
            found = low < high
            which, low, high = which[found], low[found], high[found]
            symbol = patterns[which, k]
            low, high = self.starts[symbol] + self.rank(symbol, low), self.starts[symbol] + self.rank(symbol, high)
        found = low < high
        return which[found], low[found], high[found]

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The positions of the suffixes in these rows."""
        rows, steps = rows.copy(), np.zeros_like(rows)
        walking = np.flatnonzero(self.positions[rows] < 0)
        while len(walking):
            rows[walking] = self.step(rows[walking])
            steps[walking] += 1
            walking = walking[self.positions[rows[walking]] < 0]
        return self.positions[rows] + steps


def _suffix_order(symbols: np.ndarray) -> np.ndarray:
    """All suffixes in order, by doubling; separators differ from each other by position."""
    n = len(symbols)
    separators = symbols == 0
    rank = np.where(separators, np.cumsum(separators) - 1, separators.sum() + symbols).astype(np.int64)
    order, width = np.argsort(rank, kind="stable"), 1
    while True:
        ordered = rank[order]
        changes = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        rank = np.empty(n, np.int64)
        rank[order] = changes
        if changes[-1] == n - 1:
            return order
        key = rank * (n + 1)
        key[:-width] += rank[width:] + 1
        order, rank, width = np.argsort(key, kind="stable"), key, width * 2


def occurrences(numbers: list[np.ndarray], windows: Windows) -> Iterator[tuple[int, np.ndarray, np.ndarray, list[set[str]]]]:
    """For each window length: (length, window of each occurrence, its place in the joined documents, owners).

    Places count the words of all documents and one more after each document.
    """
    joined = np.concatenate([part for x in numbers for part in (x, [0])]) if numbers else np.zeros(1, np.int64)
    known = np.concatenate([[False], joined > 0, [False]])
    edges = np.flatnonzero(known[1:] != known[:-1])
    starts, ends = edges[::2], edges[1::2]
    long = ends - starts >= windows.shortest
    starts, ends = starts[long], ends[long]
    if not len(starts):
        return
    lengths = ends - starts + 1  # with the separator
    begins = np.cumsum(lengths) - lengths
    places = np.repeat(starts - begins, lengths) + np.arange(lengths.sum())
    symbols = joined[np.minimum(places, len(joined) - 1)].copy()
    symbols[begins + lengths - 1] = 0
    index = ShardIndex(symbols, len(windows.numbers))
    for n, (patterns, owners) in windows.by_length.items():
        which, low, high = index.search(patterns)
        counts = high - low
        if counts.sum():
            rows = np.repeat(low - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
            yield n, np.repeat(which, counts), places[index.locate(rows)], owners


def hits(raws: list[bytes], windows: Windows) -> tuple[list[int], list[list[tuple[int, int]]], list[set[str]]]:
    """Of each text: its number of words, its merged spans of hit words, the items with windows in it."""
    # The words of one text at a time.
    numbers = [np.fromiter(map(windows.numbers.get, x, repeat(0)), np.int64, len(x)) for x in map(words, raws)]
    lengths = np.array([len(x) + 1 for x in numbers], dtype=np.int64)
    begins = np.cumsum(lengths) - lengths
    change = np.zeros(int(lengths.sum()) + 1, np.int64)
    found: list[set[str]] = [set() for _ in raws]
    for n, which, at, owners in occurrences(numbers, windows):
        np.add.at(change, at, 1)
        np.add.at(change, at + n, -1)
        document = np.searchsorted(begins, at, side="right") - 1
        for pair in np.unique(document * len(owners) + which).tolist():
            found[pair // len(owners)] |= owners[pair % len(owners)]
    hit = np.concatenate([[False], np.cumsum(change)[:-1] > 0, [False]])
    edges = np.flatnonzero(hit[1:] != hit[:-1])
    spans: list[list[tuple[int, int]]] = [[] for _ in raws]
    for start, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
        document = int(np.searchsorted(begins, start, side="right")) - 1
        spans[document].append((start - int(begins[document]), end - int(begins[document])))
    return [len(x) for x in numbers], spans, found


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], end)
        else:
            out.append((start, end))
    return out


_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])
_FOUND = "n_words long, spans array<struct<start:long,end:long>>, items array<string>"


def _search(block: Broadcast, last: bool):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = Windows(block.value)
        for shard in common.shards(batches, SHARD_BYTES):
            counts, spans, items = hits(common.byte_texts(shard), windows)
            if "spans" in shard.schema.names:
                earlier = shard.column("spans").to_pylist()
                spans = [merged([(s["start"], s["end"]) for s in old] + new) for old, new in zip(earlier, spans)]
                items = [new | set(old) for old, new in zip(shard.column("items").to_pylist(), items)]
            arrays = [
                pa.array(counts, pa.int64()),
                pa.array([[{"start": a, "end": b} for a, b in s] for s in spans], pa.list_(_SPAN)),
                pa.array([sorted(x) for x in items], pa.list_(pa.string())),
            ]
            kept = ["doc_id"] if last else ["doc_id", "text"]
            names = [*kept, "n_words", "spans", "items"]
            yield pa.RecordBatch.from_arrays([*(shard.column(name) for name in kept), *arrays], names=names)

    return run


def _blocks(benchmark: DataFrame, item_col: str, item_text_col: str, block_bytes: int) -> Iterator[tuple[Broadcast, bool]]:
    """The items of the benchmark in blocks of about `block_bytes` of text; whether it is the last block."""
    items = benchmark.select(
        F.coalesce(common.column(item_col).cast("string"), F.lit("")).alias("item"),
        F.coalesce(common.column(item_text_col).cast("string"), F.lit("")).alias("text"),
    )
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    for k in range(blocks):
        chosen = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k)
        rows = [(r["item"], r["text"].encode()) for r in chosen.toLocalIterator()]
        yield benchmark.sparkSession.sparkContext.broadcast(rows), k == blocks - 1


def contamination(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """One row per input row: doc_id, n_words, spans of hit word positions (end exclusive), items (ids, sorted)."""
    rows = common.text_rows(docs, id_col, text_col)
    for block, last in _blocks(benchmark, item_col, item_text_col, block_bytes):
        rows = rows.mapInArrow(_search(block, last), f"doc_id long, {'' if last else 'text string, '}{_FOUND}")
    return rows


def digests(found: DataFrame) -> DataFrame:
    """The counts and digests of a `contamination` result."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """The documents in which no window of the benchmark occurs; the columns stay as they are."""
    for block, _ in _blocks(benchmark, item_col, item_text_col, block_bytes):
        docs = common.filter_texts(docs, _clean(block), text_col)
    return docs


def _clean(block: Broadcast):
    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[list[bool]]:
        windows = Windows(block.value)
        for shard in common.shards(batches, SHARD_BYTES):
            yield [not s for s in hits(common.byte_texts(shard), windows)[1]]

    return keep
