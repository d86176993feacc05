"""Documents that share a passage of so many words with another document.

The same anchors as in suffix_dedup, counted in words: in every window of
`words` words the gram of `gram` words with the smallest hash is the anchor, and
an anchor's context is the text of all windows that chose it.

1. Grams that only one document has end here.
2. A context that two documents have is a shared passage: no windows needed.
3. Contexts of one document only, whose gram others have too (the ends of
   passages), are looked up window by window, with one representative of every
   other context of the gram. A passage that is just long enough has one window.

Texts are compared by 64-bit hashes of words and windows. Words are separated by
ASCII white space.

Defined cases: null counts as empty; shorter texts share nothing; rows that
repeat both id and text are one document, equal texts of different ids share;
an empty table gives no rows.
"""

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallwise.llm import common
from stallwise.llm import suffix_dedup as S

WORDS, GRAM = 51, 16
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


class WordHashes(S.Hashes):
    """Hashes of runs of words, from the hashes of the words."""

    def __init__(self, words: np.ndarray):
        powers, self.inverse = S._powers(max(1 << 16, 1 << int(len(words) + 1).bit_length()))
        self.sums = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(words * powers[: len(words)], out=self.sums[1:])


def word_hashes(raws: list[bytes]) -> list[np.ndarray]:
    """The hash of each word of each text."""
    # A space ends the last word of a text.
    data = np.frombuffer(b"".join(raw + b" " for raw in raws), np.uint8)
    blank = _BLANK[data]
    starts = np.flatnonzero(~blank & np.concatenate([[True], blank[:-1]]))
    ends = np.flatnonzero(blank & ~np.concatenate([[True], blank[:-1]]))
    out = common.mix(S.Hashes(data).of(starts, ends) + (ends - starts).astype(np.uint64))
    limits = np.cumsum([len(raw) + 1 for raw in raws])
    return np.split(out, np.searchsorted(starts, limits)[:-1]) if raws else []


def _shards(raws: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    """(index of the first, texts) of about a megabyte."""
    first, size = 0, 0
    for i, raw in enumerate(raws):
        if size and size + len(raw) > 1 << 20:
            yield first, raws[first:i]
            first, size = i, 0
        size += len(raw)
    if raws:
        yield first, raws[first:]


def anchors(raws: list[bytes], words: int = WORDS, gram: int = GRAM) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each text: the gram, context and place (in words) of its anchors."""
    none = np.zeros(0, np.int64)
    out = [(none, none, none)] * len(raws)
    for first, some in _shards(raws):
        texts = word_hashes(some)
        long = [i for i, own in enumerate(texts) if len(own) >= words]
        if long:
            sizes = np.array([len(texts[i]) for i in long], np.int64)
            found = S.anchors_in(WordHashes(np.concatenate([texts[i] for i in long])), sizes, np.zeros(len(long), np.int64), words, gram)
            for i, own in zip(long, found):
                out[first + i] = own
    return out


def _anchor_rows(words: int, gram: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = anchors(common.byte_texts(batch), words, gram)
            columns = [S._lists([f[i] for f in found]) for i in range(3)]
            yield pa.RecordBatch.from_arrays([batch.column("owner"), *columns], names=["owner", "gram", "context", "place"])

    return run


def _window_rows(words: int):
    """(window, owner) of all windows of the wanted contexts."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owners, wanted = batch.column("owner").to_pylist(), batch.column("places").to_pylist()
            for owner, raw, places in zip(owners, common.byte_texts(batch), wanted):
                (own,) = word_hashes([raw])
                windows = WordHashes(own).of_length(words).view(np.int64)
                chosen = [windows[start : last + 1] for start, _, last in map(S.unpacked, places)]
                for at in range(0, len(chosen), 10_000):
                    some = np.concatenate(chosen[at : at + 10_000])
                    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(np.full(len(some), owner))], names=["window", "owner"])

    return run


#: Bits of the filter that goes before the join with texts.
FILTER_BITS = 1 << 24


def _perhaps_in(rows: DataFrame, keyed: DataFrame) -> DataFrame:
    """The rows whose owner `keyed` has, and few others, without a shuffle: one bit an owner, at most FILTER_BITS / 64 rows broadcast."""
    word, mask = F.shiftright(F.pmod("owner", F.lit(FILTER_BITS)), 6), F.expr("shiftleft(1L, cast(pmod(owner, 64) AS int))")
    bits = keyed.groupBy(word.alias("_word")).agg(F.bit_or(mask).alias("_bits"))
    joined = rows.withColumn("_word", word).join(F.broadcast(bits), "_word")
    return joined.filter(F.col("_bits").bitwiseAND(mask) != 0).drop("_word", "_bits")


def sharing(docs: DataFrame, words: int = WORDS, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, k): documents that share a passage of `words` words with another one; k tells texts of one id apart."""
    rows = S._keyed(docs, id_col, text_col).withColumn("owner", F.xxhash64("doc_id", "k"))
    kinds = "owner long, gram array<long>, context array<long>, place array<long>"
    by_document = common.stored(rows.select("owner", "text").mapInArrow(_anchor_rows(words, gram), kinds), "passage-anchors")
    every = by_document.select("owner", F.inline(F.arrays_zip("gram", "context", "place")))
    ends = F.min("owner").alias("low"), F.max("owner").alias("high")
    counted = every.groupBy("gram").agg(F.count("*").alias("n"), *ends).filter("low <> high")
    counted = common.stored(counted.select("gram", "n", F.lit(True).alias("met")), "passage-grams")
    met = common.lookup(every, counted, "gram", "n", ["met"], F.col("owner")).filter("met").drop("met")
    met = common.stored(met, "passage-met")
    first = F.min(F.struct("owner", "place")).alias("first")
    contexts = met.groupBy("gram", "context").agg(F.count("*").alias("n"), *ends, first)
    contexts = common.stored(contexts.withColumn("shared", F.col("low") != F.col("high")), "passage-contexts")
    known = contexts.filter("shared").groupBy("context").agg(F.sum("n").alias("n"), F.lit(True).alias("shared"))
    whole = common.lookup(met.select("owner", "context"), common.stored(known, "passage-shared"), "context", "n", ["shared"], F.col("owner"))
    open_grams = contexts.groupBy("gram").agg(F.count("*").alias("contexts"), F.max(~F.col("shared")).alias("single"))
    wanted = contexts.join(open_grams.filter("single AND contexts > 1"), "gram").select("first.*")
    places = wanted.groupBy("owner").agg(F.collect_list("place").alias("places"))
    # Rows that repeat id and text give the same windows again, which are counted once.
    places = common.stored(places, "passage-places")
    texts = _perhaps_in(rows.select("owner", "text"), places).join(places, "owner")
    windows = common.stored(texts.mapInArrow(_window_rows(words), "window long, owner long").distinct(), "passage-windows")
    twice = windows.groupBy("window").agg(F.count("*").alias("n"), F.lit(True).alias("twice")).filter("n > 1")
    ends_of = common.lookup(windows, common.stored(twice, "passage-repeated"), "window", "n", ["twice"], F.col("owner")).filter("twice")
    owners = common.stored(whole.filter("shared").select("owner").unionByName(ends_of.select("owner")).distinct(), "passage-owners")
    return rows.select("doc_id", "k", "owner").join(owners, "owner", "left_semi").select("doc_id", "k").distinct()
