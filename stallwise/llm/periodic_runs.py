"""Periodic runs: stretches of words that repeat with a period, found by block convolution.

A run with period q and at least 2q words holds at least q places whose word
comes again q words later. So at the scale L, a power of two, every run with a
period of 2L-1 to 4L-2 (the first scale takes all from 1 to 6) holds a whole aligned block
of L words that occurs again at that distance. For all blocks of a scale at
once, the sums of squared differences between a block and each place of the
window that follows it come from one convolution, computed exactly by a
number-theoretic transform modulo a prime. A sum of 0 is a seed. Seeds are
compared word by word (a sum may be 0 modulo the prime only), joined to
chains of neighbouring blocks with one distance, and extended by less than a
block on either side, which gives a maximal stretch that keeps the period. The
shortest period of each stretch is the run's.

Seeds at a multiple of the period of a run that was already found, and inside
it, are left out: they can only give that run again. So text of one single word
costs about as much as any other.

Every word of a run lies in a window of five words that the document has twice,
so only stretches of such words (compared by hashes: a collision adds some) are
transformed; all stretches of a batch go through together.

Defined cases: a null text counts as empty; texts without words have no runs and
collapse to an empty text; every input row is looked at on its own, so repeated
ids and null ids get a row each; an empty table gives no rows; extra columns are
ignored. A document is held whole by its task, in memory linear in its length.
"""

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallwise.llm import common

#: A run has at least so many words.
LEAST = 12
#: Each word of a run lies in a window of so many words that occurs twice (true for runs of at least 12 words).
WINDOW = 5
#: 15 * 2**27 + 1, with 31 as a generator: transforms of up to 2**27 numbers, products below 2**63.
PRIME, GENERATOR = 2013265921, 31
_P = np.uint64(PRIME)
SHARD_BYTES = 4 << 20
#: Numbers that are transformed at a time, unless one block needs more.
BATCH = 1 << 18


@lru_cache(maxsize=64)
def _roots(half: int, inverse: bool) -> np.ndarray:
    """The first `half` powers of a root of unity of order 2 * half."""
    root = pow(GENERATOR, (PRIME - 1) // (2 * half), PRIME)
    root = pow(root, PRIME - 2, PRIME) if inverse else root
    out = np.ones(half, np.uint64)
    filled = 1
    while filled < half:
        factor = np.uint64(pow(root, filled, PRIME))
        out[filled : 2 * filled] = out[:filled] * factor % _P
        filled *= 2
    return out


def _reduced(x: np.ndarray) -> np.ndarray:
    """x modulo the prime, for x below twice the prime (a negative difference wraps around and is the larger one)."""
    return np.minimum(x, x - _P)


def transformed(rows: np.ndarray) -> np.ndarray:
    """The transform of each row, in bit-reversed order. Rows are as long as a power of two and reduced."""
    n = rows.shape[1]
    half = n // 2
    while half:
        pairs = rows.reshape(len(rows), -1, 2, half)
        out = np.empty_like(pairs)
        u, v = pairs[:, :, 0], pairs[:, :, 1]
        out[:, :, 0] = _reduced(u + v)
        out[:, :, 1] = (u + (_P - v)) * _roots(half, False) % _P
        rows = out.reshape(len(rows), n)
        half //= 2
    return rows


def restored(rows: np.ndarray) -> np.ndarray:
    """The inverse of `transformed`."""
    n = rows.shape[1]
    half = 1
    while half < n:
        pairs = rows.reshape(len(rows), -1, 2, half)
        out = np.empty_like(pairs)
        u, v = pairs[:, :, 0], pairs[:, :, 1] * _roots(half, True) % _P
        out[:, :, 0] = _reduced(u + v)
        out[:, :, 1] = _reduced(u + (_P - v))
        rows = out.reshape(len(rows), n)
        half *= 2
    return rows * np.uint64(pow(n, PRIME - 2, PRIME)) % _P


def squared_differences(blocks: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """For each row, the sum of squared differences of its block and each place of its window, modulo the prime."""
    length, places = blocks.shape[1], windows.shape[1] - blocks.shape[1] + 1
    size = 1 << (windows.shape[1] - 1).bit_length()
    a, b = np.zeros((len(blocks), size), np.uint64), np.zeros((len(blocks), size), np.uint64)
    a[:, :length], b[:, : windows.shape[1]] = blocks[:, ::-1], windows
    products = restored(transformed(a) * transformed(b) % _P)[:, length - 1 : length - 1 + places]
    squares = np.cumsum(np.pad(windows * windows % _P, ((0, 0), (1, 0))), axis=1, dtype=np.uint64)
    sums = squares[:, length:] - squares[:, :places] + (blocks * blocks % _P).sum(axis=1, dtype=np.uint64)[:, None]
    return (sums % _P + (_P - products) * np.uint64(2)) % _P


def _seeds(x: np.ndarray, lo: np.ndarray, hi: np.ndarray, scale: int, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
    """(block, distance) of all blocks of the stretches [lo, hi) that come again at a distance from first to last."""
    counts = np.maximum((hi - lo - scale - first) // scale + 1, 0)
    total = int(counts.sum())
    inside = np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)
    starts = np.repeat(lo, counts) + inside * scale
    room = np.repeat(hi, counts) - starts - scale
    reach = last + scale - first
    padded = np.concatenate([x, np.zeros(last + scale, np.uint64)])
    found: list[tuple[np.ndarray, np.ndarray]] = []
    step = max(1, BATCH // (4 * scale))
    for at in range(0, total, step):
        own = starts[at : at + step]
        sums = squared_differences(padded[own[:, None] + np.arange(scale)], padded[own[:, None] + np.arange(first, first + reach)])
        row, place = np.nonzero(sums == 0)
        fits = place + first <= room[at : at + step][row]
        found.append((own[row[fits]], place[fits] + first))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([b for b, _ in found]), np.concatenate([q for _, q in found])


def _equal_blocks(x: np.ndarray, block: np.ndarray, q: np.ndarray, scale: int) -> np.ndarray:
    out = np.empty(len(block), bool)
    step = max(1, BATCH // scale)
    for at in range(0, len(block), step):
        places = block[at : at + step, None] + np.arange(scale)
        out[at : at + step] = (x[places] == x[places + q[at : at + step, None]]).all(axis=1)
    return out


def _matching(x: np.ndarray, start: np.ndarray, q: np.ndarray, direction: int) -> np.ndarray:
    """How many words from `start` on, in this direction, equal those q words later."""
    out = np.zeros(len(start), np.int64)
    active, steps, done = np.arange(len(start)), np.arange(8), 0
    while len(active):
        places = np.clip(start[active, None] + direction * (done + steps), 0, len(x) - 1)
        equal = x[places] == x[np.minimum(places + q[active, None], len(x) - 1)]
        whole = equal.all(axis=1)
        out[active] += np.where(whole, len(steps), equal.argmin(axis=1))
        done += len(steps)
        active, steps = active[whole], np.arange(min(2 * len(steps), 1024))
    return out


def _without_explained(block: np.ndarray, q: np.ndarray, scale: int, first: int, runs: np.ndarray) -> np.ndarray:
    """Which seeds are not at a multiple of the period of a known run that holds both of their blocks."""
    left = np.ones(len(block), bool)
    for start, end, period in runs[runs[:, 1] - runs[:, 0] >= first + scale].tolist():
        lo, hi = np.searchsorted(block, start), np.searchsorted(block, end - first - scale, "right")
        if hi > lo:
            left[lo:hi] &= ~((q[lo:hi] % period == 0) & (block[lo:hi] + q[lo:hi] + scale <= end))
    return left


def runs_between(words: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """(start, end, period) of all runs within the stretches [lo, hi) of `words`, by start, then period.

    `words[hi]` and the first and last word must differ from all other words.
    """
    x = np.unique(words, return_inverse=True)[1].astype(np.uint64)
    found = np.zeros((0, 3), np.int64)
    longest = int((hi - lo).max(initial=0))
    scale, first, last = 2, 1, 6
    while 2 * first <= longest:
        long = hi - lo >= max(LEAST, 2 * first)
        block, q = _seeds(x, lo[long], hi[long], scale, first, last)
        left = _without_explained(block, q, scale, first, found)
        block, q = block[left], q[left]
        same = _equal_blocks(x, block, q, scale)
        block, q = block[same], q[same]
        order = np.lexsort((block, q))
        block, q = block[order], q[order]
        opens = np.ones(len(block), bool)
        opens[1:] = (q[1:] != q[:-1]) | (block[1:] != block[:-1] + scale)
        closes = np.append(opens[1:], True)[: len(block)]
        head, tail, q = block[opens], block[closes] + scale, q[opens]
        start = head - _matching(x, head - 1, q, -1)
        end = tail + _matching(x, tail, q, 1) + q
        real = (end - start >= 2 * q) & (end - start >= LEAST)
        found = _shortest(np.concatenate([found, np.column_stack([start, end, q])[real]]))
        scale, first = 2 * scale, last + 1
        last = 2 * first
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def _shortest(runs: np.ndarray) -> np.ndarray:
    """Of runs over the same words, the one with the shortest period."""
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    keep = np.ones(len(runs), bool)
    keep[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    return runs[keep]


def _live(ids: np.ndarray, document: np.ndarray) -> np.ndarray:
    """The words that lie in a window of WINDOW words that its document has at least twice."""
    live = np.zeros(len(ids), bool)
    if len(ids) < WINDOW:
        return live
    spread = common.mix(ids.astype(np.uint64))
    hashes = common.mix(document[: len(ids) - WINDOW + 1].astype(np.uint64))
    for k in range(WINDOW):
        hashes = common.mix(hashes ^ spread[k : len(ids) - WINDOW + 1 + k])
    inside = np.flatnonzero(document[: len(ids) - WINDOW + 1] == document[WINDOW - 1 :])
    hashes = hashes[inside]
    order = np.sort(hashes)
    twice = np.unique(order[1:][order[1:] == order[:-1]])
    if len(twice):
        at = np.minimum(np.searchsorted(twice, hashes), len(twice) - 1)
        places = inside[twice[at] == hashes]
        for k in range(WINDOW):
            live[places + k] = True
    return live


def runs_of(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """The runs (start, length, period) of each text, given as words; by start, then period."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    offsets = np.cumsum(lengths) - lengths
    document = np.repeat(np.arange(len(texts)), lengths)
    seen: dict[bytes, int] = {}
    flat = [word for words in texts for word in words]
    ids = np.fromiter(map(seen.setdefault, flat, range(len(flat))), np.int64, len(flat))
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    live = _live(ids, document)
    edges = np.flatnonzero(np.concatenate([[True], (live[1:] != live[:-1]) | (document[1:] != document[:-1]), [True]])) if len(ids) else []
    begin, stop = np.asarray(edges[:-1], np.int64), np.asarray(edges[1:], np.int64)
    kept = (stop - begin >= LEAST) & live[begin] if len(begin) else np.zeros(0, bool)
    begin, stop = begin[kept], stop[kept]
    if not len(begin):
        return out
    # One sequence: a word that occurs nowhere else, then each stretch with such a word behind it.
    size = stop - begin
    lo = 1 + np.cumsum(size + 1) - (size + 1)
    words = len(flat) + np.arange(1 + int((size + 1).sum()))
    inside = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    words[np.repeat(lo, size) + inside] = ids[np.repeat(begin, size) + inside]
    runs = runs_between(words, lo, lo + size)
    stretch = np.searchsorted(lo, runs[:, 0], "right") - 1
    start = runs[:, 0] - lo[stretch] + begin[stretch]
    owner = document[start]
    for d, s, n, p in zip(owner.tolist(), (start - offsets[owner]).tolist(), (runs[:, 1] - runs[:, 0]).tolist(), runs[:, 2].tolist()):
        out[d].append((s, n, p))
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words without what a run repeats: all of it after its first period."""
    if not runs:
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(change)[:-1] == 0)])


def found(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_words, runs (start, length, period; by start, then period), collapsed text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch in common.shards(batches, SHARD_BYTES):
            texts = [text.split() for text in common.byte_texts(batch)]
            runs = runs_of(texts)
            columns = {
                "doc_id": batch.column("doc_id"),
                "n_words": pa.array(map(len, texts), pa.int64()),
                "runs": pa.array([[dict(zip(("start", "length", "period"), r)) for r in own] for own in runs], kind),
                "collapsed": pa.array(map(collapsed, texts, runs), pa.binary()).cast(pa.string()),
            }
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    schema = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return common.text_rows(docs, id_col, text_col).mapInArrow(run, schema)


def digests(runs: DataFrame) -> DataFrame:
    """The longest run of each row, and digests of all runs and of the collapsed text."""
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    text = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise(F.lit(""))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("l"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    rows = runs.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("b"), text.alias("lines"), "collapsed")
    length, period = F.col("b.l"), -F.col("b.p")
    return rows.select(
        "doc_id",
        "n_runs",
        (-F.col("b.s")).alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.expr("(1000 * b.l) div (-b.p)").alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def planted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text): a tenth of the documents, by a hash of the id, is made periodic from some word on."""
    rows = common.text_rows(docs, id_col, text_col)
    number = F.crc32(F.encode(F.col("doc_id").cast("string"), "utf-8"))
    chosen = rows.withColumns({"_h": number, "_words": F.when(number % 10 == 0, F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)")))})
    n = F.size("_words")
    chosen = chosen.withColumn("_g", F.floor(F.col("_h") / 10)).withColumn("_a", F.when(n > 0, F.col("_g") % n).cast("int"))
    chosen = chosen.withColumn("_p", (1 + F.floor((n - F.col("_a")) / (3 + F.col("_g") % 8))).cast("int"))

    def moved(word: Column, i: Column) -> Column:
        a, p = F.col("_a"), F.col("_p")
        return F.when(i < a, word).otherwise(F.get(F.col("_words"), a + (i - a) % p))

    periodic = F.array_join(F.transform("_words", moved), " ")
    return chosen.select("doc_id", F.when(n > 0, periodic).otherwise(F.col("text")).alias("text"))
