"""Toxicity: a support vector machine on a subsequence string kernel with Nyström landmarks.

The kernel compares two words by the three-character subsequences they share,
contiguous or not, within `SPAN` characters; each occurrence counts
`DECAY ** characters spanned`. A character that is inserted into an insult, or a
dot between its letters, therefore costs some weight but does not hide it, and
an ending that was never seen changes little. Words are marked at both ends;
runs of single characters (`b a d`), parted by any white space, count as one word
as well; words longer than `LONGEST` are compared in overlapping parts. Short
neighbours (`id iot`) are judged joined too, but count only if they come close to
a decision (`JOINED`). Nearly all of them are far from it, which a bound shows
without their lengths as vectors. The machine is trained on words alone.

Labels belong to documents, so the machine learns which words make a document
toxic: all words of clean documents are negative, and each toxic document has
at least one positive word, chosen anew by the machine of the round before; words
that more toxic documents share than chance allows, and no clean one has, are
positive throughout.
Landmarks are words of both kinds; a word's features are its kernel values with
them, whitened. The decision is linear in the kernel's own feature space, so it
is folded into one weight for each three characters (a fixed 1 MB), and scoring
a word costs the same however many landmarks there are.

The score of a document is a logistic regression on its words' highest
decisions and on how many words reach each level, so several words that are a
little suspicious count as well. It is fitted on documents that the machine did
not learn from. Training reads a bounded sample: at most `SAMPLE` labelled documents of each class and
`MOST_BYTES` of text in each of them, by the order of a hash of the id. Scoring
reads everything.

Defined cases: null texts count as empty; texts without words get the lowest
score; without labels of both classes every score is that of the only class (0
if there is none); rows that repeat an id, or have none, get a score each (one
without an id is never learned from); of several labels of an id the largest
counts; an empty table gives no rows; extra columns are ignored.
"""

import re
import zlib
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallwise.llm import common

SAMPLE = 2_000
MOST_BYTES = 65_536
SPAN, DECAY, LONGEST = 7, 0.7, 24
#: Two neighbouring words of up to so many characters, and three of up to half, are judged joined as well.
SHORT = 6
#: Joined neighbours below this decision count for nothing.
JOINED = 0.0
LANDMARKS, ROUNDS, MINED = 256, 4, 1_000
FLOOR, LEVELS = -3.0, (-1.5, -1.0, -0.5, 0.0, 0.5)
#: A document's score takes its highest decisions, and those above the least level. Words below this decision,
#: which a bound shows of most, are therefore measured only for documents with fewer than `HIGHEST` others.
HIGHEST, CLOSE = 5, -2.0

_CODES = 64
_EDGE = 27
_STRIP = ".,;:!?\"'()[]{}<>|*_-~«»"
_SPACED = re.compile(r"(?<!\S)\S(?:\s++\S(?!\S)){2,}+")
#: (offset of the second character, of the third)
_SHAPES = [(j, k) for k in range(2, SPAN) for j in range(1, k)]


def _code_table() -> np.ndarray:
    """A number for each character: 0 matches nothing, other letters share what is left."""
    table = np.zeros(0x110000, np.uint8)
    for i, letter in enumerate(common.LOWER):
        table[ord(letter)] = i + 1
    for digit in range(10):
        table[ord("0") + digit] = 28 + digit
    letters = np.arange(0xAA, 0x110000)
    table[letters] = 38 + letters % (_CODES - 38)
    return table


_TABLE = _code_table()


def _parts(word: str) -> list[str]:
    word = word.strip(_STRIP)
    if len(word) <= LONGEST:
        return [word]
    step = LONGEST // 2
    return [word[i : i + LONGEST] for i in range(0, max(1, len(word) - LONGEST + step), step)]


def codes(words: Sequence[str]) -> np.ndarray:
    """A row for each word (up to LONGEST characters): edge, characters, edge, then zeros."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    out = np.zeros((len(words), int(lengths.max(initial=0)) + 2 + SPAN), np.uint8)
    flat = _TABLE[np.frombuffer("".join(words).encode("utf-32-le", "replace"), np.uint32)]
    row = np.repeat(np.arange(len(words)), lengths)
    at = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[row, at + 1] = flat
    out[:, 0] = _EDGE
    out[np.arange(len(words)), lengths + 1] = _EDGE
    return out


def _grams(matrix: np.ndarray) -> Iterator[tuple[np.ndarray, float]]:
    """For each shape: the feature number of every place (0 where a character matches nothing) and its weight."""
    width = matrix.shape[1] - SPAN
    wide = matrix.astype(np.int32)
    first, there = wide[:, :width] * (_CODES * _CODES), matrix[:, :width] > 0
    for j, k in _SHAPES:
        second, third = wide[:, j : j + width], wide[:, k : k + width]
        yield np.where(there & (second > 0) & (third > 0), first + second * _CODES + third, 0), DECAY ** (k + 1)


def _lengths(shapes: list[tuple[np.ndarray, float]]) -> np.ndarray:
    """The lengths of the feature vectors of some words: equal numbers are one feature."""
    keys = np.concatenate([number * 32 + i for i, (number, _) in enumerate(shapes)], axis=1)
    keys.sort(axis=1)
    weights = np.array([weight for _, weight in shapes] + [0.0] * 32, np.float32)
    number = keys >> 5
    value = np.where(number > 0, weights[keys & 31], 0).cumsum(axis=1)
    last = np.ones(number.shape, bool)
    last[:, :-1] = number[:, 1:] != number[:, :-1]
    # Sums of runs of equal numbers, squared: differences of the running sum at the ends of runs.
    flat, ends = value.ravel(), np.flatnonzero(last.ravel())
    row = ends // number.shape[1]
    sums = flat[ends] - np.where(np.concatenate([[True], row[1:] != row[:-1]]), 0, np.concatenate([[0], flat[ends][:-1]]))
    return np.sqrt(np.bincount(row, sums**2, len(number)) + 1e-6).astype(np.float32)


def feature_rows(words: Sequence[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """The sparse subsequence features of each word, of length 1: numbers and values."""
    shapes = list(_grams(codes(words)))
    numbers = np.concatenate([n for n, _ in shapes], axis=1)
    values = np.repeat(np.array([w for _, w in shapes]), shapes[0][0].shape[1])
    out = []
    for row in numbers:
        distinct, inverse = np.unique(row[row > 0], return_inverse=True)
        sums = np.bincount(inverse, values[row > 0], len(distinct))
        out.append((distinct, sums / np.sqrt((sums**2).sum() + 1e-6)))
    return out


def kernel(words: Sequence[str], landmarks: Sequence[str]) -> np.ndarray:
    """The string kernel between words and landmarks."""
    marks = feature_rows(landmarks)
    used = np.unique(np.concatenate([numbers for numbers, _ in marks]))
    place = np.zeros(_CODES**3, np.int32)
    place[used] = np.arange(1, len(used) + 1)
    table = np.zeros((len(used) + 1, len(marks)), np.float32)
    for j, (numbers, values) in enumerate(marks):
        table[place[numbers], j] = values
    out = np.zeros((len(words), len(marks)), np.float32)
    order = np.argsort(np.fromiter(map(len, words), np.int64, len(words)), kind="stable")
    for at in range(0, len(words), 512):
        rows = order[at : at + 512]
        shapes = list(_grams(codes([words[i] for i in rows])))
        total = np.zeros((len(rows), len(marks)), np.float32)
        for number, weight in shapes:
            total += np.float32(weight) * table[place[number]].sum(axis=1)
        out[rows] = total / _lengths(shapes)[:, None]
    return out.astype(np.float64)


def folded_values(words: Sequence[str], weights: np.ndarray, least: float = -np.inf, totals: np.ndarray | None = None) -> np.ndarray:
    """The linear function of the words' features with these weights (weights[0] is 0); -inf where it is below `least`.

    If `least` is at least 0, most words are decided by a bound: features that
    coincide only make a vector longer than its occurrences taken one by one.
    `totals` are those of the words, NaN where they are not known yet, and are filled in.
    """
    out = np.full(len(words), -np.inf, np.float32)
    order = np.argsort(np.fromiter(map(len, words), np.int64, len(words)), kind="stable")
    for at in range(0, len(words), 4096):
        rows = order[at : at + 4096]
        matrix = codes([words[i] for i in rows])
        total = _totals(matrix, weights)
        if totals is not None:
            total = totals[rows] = np.where(np.isnan(totals[rows]), total, totals[rows])
        if least >= 0:
            near = np.flatnonzero(total >= least * _least_lengths(matrix))
            if not len(near):
                continue
            rows, total, matrix = rows[near], total[near], matrix[near]
        out[rows] = total / _lengths(list(_grams(matrix)))
    return np.where(out >= least, out, -np.inf)


def _totals(matrix: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The weights of all occurrences of features in some words, added up.

    Numbers with a character that matches nothing are no feature's and weigh 0.
    """
    width = matrix.shape[1] - SPAN
    wide = matrix.astype(np.intp)
    seconds = {j: wide[:, :width] * (_CODES * _CODES) + wide[:, j : j + width] * _CODES for j in range(1, SPAN - 1)}
    total = np.zeros((len(matrix), width), np.float32)
    for k in range(2, SPAN):
        third = wide[:, k : k + width]
        own = weights.take(seconds[1] + third)
        for j in range(2, k):
            own += weights.take(seconds[j] + third)
        total += np.float32(DECAY ** (k + 1)) * own
    return total.sum(axis=1)


def _least_lengths(matrix: np.ndarray) -> np.ndarray:
    """At most the lengths of the feature vectors of some words: 0 with characters inside that match nothing."""
    valid = (matrix > 0).sum(axis=1)
    ends = matrix.shape[1] - 1 - (matrix[:, ::-1] > 0).argmax(axis=1)
    occurrences = sum(np.maximum(np.arange(matrix.shape[1] + 1) - k, 0) * DECAY ** (2 * k + 2) for _, k in _SHAPES)
    return np.where(valid == ends + 1, np.sqrt(occurrences[valid]), 0).astype(np.float32)


@dataclass(frozen=True)
class Model:
    """Weights of character subsequences for words, and of what a document's words come to."""

    weights: np.ndarray
    bias: float
    document: np.ndarray

    def values(self, words: Sequence[str], least: float = FLOOR, totals: np.ndarray | None = None) -> np.ndarray:
        """The decision for each word, the largest over its parts: at least FLOOR, and -inf where it is below a higher `least`.

        `totals` as for folded_values; those of words in several parts stay unknown.
        """
        parts = [_parts(w) if len(w) > LONGEST else (w,) for w in (w.strip(_STRIP) for w in words)]
        if not parts:
            return np.zeros(0, np.float32)
        flat = [p for own in parts for p in own]
        many = np.fromiter(map(len, parts), np.int64, len(parts))
        starts = np.cumsum(many) - many
        own_totals = None if totals is None else np.repeat(totals, many)
        out = np.maximum.reduceat(folded_values(flat, self.weights, least - self.bias, own_totals) + self.bias, starts)
        if totals is not None:
            totals[:] = np.where(many == 1, own_totals[starts], np.nan)
        return out if least > FLOOR else np.maximum(out, FLOOR)

    def joined(self, units: Sequence[str]) -> dict[str, float]:
        """The decisions of those joined neighbours that come close to one."""
        if not units:
            return {}
        values = folded_values([unit.strip(_STRIP) for unit in units], self.weights, JOINED - self.bias) + self.bias
        return {units[i]: float(values[i]) for i in np.flatnonzero(values >= JOINED)}

    def scores(self, texts: Sequence[str], known: "Known") -> list[float]:
        """Scores of the texts; `known` keeps the decisions of words from call to call."""
        if not texts:
            return []
        lowered = [text.lower() for text in texts]
        split = [text.split() for text in lowered]
        words = list(map(words_of, lowered, split))
        new = list(set().union(*words).difference(known.words))
        totals = np.full(len(new), np.nan, np.float32)
        known.add(new, self.values(new, CLOSE, totals), totals)
        units, owners = neighbours(split)
        new = list(set(units).difference(known.judged))
        known.judged.update(new)
        known.joined.update(self.joined(new))
        joined: list[dict[str, float]] = [{} for _ in texts]
        for i in [i for i, unit in enumerate(units) if unit in known.joined]:
            if units[i] not in words[owners[i]]:
                joined[owners[i]][units[i]] = known.joined[units[i]]
        close = [known.close.keys() & own for own in words]
        few = [len(c) < len(own) and len(c) + len(j) < HIGHEST for own, c, j in zip(words, close, joined)]
        low = list(set().union(*[own - c for own, c, f in zip(words, close, few) if f]))
        totals = np.fromiter(map(known.words.__getitem__, low), np.float32, len(low))
        measured = dict(zip(low, self.values(low, FLOOR, totals).tolist()))
        found = []
        for own, c, j, f in zip(words, close, joined, few):
            values = [*[known.close[w] for w in c], *j.values(), *([measured[w] for w in own - c] if f else [])]
            found.append(evidence(values, len(own)))
        known.trim()
        return (1 / (1 + np.exp(-np.clip(np.array(found) @ self.document, -30, 30)))).tolist()


class Known:
    """What a task has judged: words and joined neighbours, and those of both that are close to a decision. Bounded: the oldest half goes."""

    def __init__(self, most: int = 250_000) -> None:
        self.most = most
        self.words: dict[str, float] = {}
        self.close: dict[str, float] = {}
        self.judged: set[str] = set()
        self.joined: dict[str, float] = {}

    def add(self, words: Sequence[str], values: np.ndarray, totals: np.ndarray) -> None:
        """Words with their totals, and the decisions of those not below CLOSE."""
        self.words.update(zip(words, totals.tolist()))
        self.close.update((words[i], float(values[i])) for i in np.flatnonzero(values >= CLOSE))

    def trim(self) -> None:
        if len(self.words) > self.most:
            self.words = dict(islice(self.words.items(), self.most // 2, None))
            self.close = {w: value for w, value in self.close.items() if w in self.words}
        if len(self.judged) > self.most:
            self.judged, self.joined = set(), {}


def evidence(values: Sequence[float], words: int) -> np.ndarray:
    """What the decisions on a document's words come to: the highest ones, and how many reach each level.

    Of decisions below the levels only the `HIGHEST` highest of all are needed. `words` counts all words.
    """
    values = np.array(values, float)
    top = np.full(HIGHEST, FLOOR)
    highest = np.sort(values)[::-1][:HIGHEST]
    top[: len(highest)] = highest
    reach = np.log1p((values[:, None] > LEVELS).sum(axis=0))
    return np.array([top[0], top[1], top[2], top[4], *reach, np.log1p(words) / 5, 1.0])


def words_of(lowered: str, split: Sequence[str]) -> set[str]:
    """The words that a lower-cased text is judged by; single characters in a row are a word as well."""
    words = set(split)
    words.update("".join(m[0].split()) for m in _SPACED.finditer(lowered))
    return words


def neighbours(split: Sequence[Sequence[str]]) -> tuple[list[str], np.ndarray]:
    """Two short neighbours, or three very short ones, joined: wherever the texts' words have them, and in which text."""
    flat = [word for words in split for word in (*words, "")]
    lengths = np.fromiter(map(len, flat), np.int64, len(flat))
    owner = np.repeat(np.arange(len(split)), [len(words) + 1 for words in split])
    units, places = [], []
    for many, most in ((2, SHORT), (3, SHORT // 2)):
        short = (lengths > 0) & (lengths <= most)
        at = np.flatnonzero(np.logical_and.reduce([short[k : len(short) - many + 1 + k] for k in range(many)]))
        units += map("".join, zip(*[[flat[i] for i in (at + k).tolist()] for k in range(many)]))
        places.append(at)
    return units, owner[np.concatenate(places)]


def joined_of(words: Sequence[str]) -> set[str]:
    """Two short neighbours of a text's words, or three very short ones, joined."""
    return set(neighbours([words])[0])


def _machine(features: np.ndarray, labels: np.ndarray, weight: np.ndarray, ridge: float = 1e-2) -> tuple[np.ndarray, float]:
    """Squared-hinge support vector machine in the primal, by Newton steps on the points inside the margin."""
    x = np.hstack([features, np.ones((len(features), 1))])
    penalty = ridge * np.eye(x.shape[1])
    penalty[-1, -1] = 1e-6
    w = np.zeros(x.shape[1])

    def loss(v: np.ndarray) -> float:
        return float((weight * np.maximum(0, 1 - labels * (x @ v)) ** 2).sum() + v @ penalty @ v)

    now = loss(w)
    for _ in range(40):
        inside = labels * (x @ w) < 1
        own = x[inside] * weight[inside, None]
        step, size = np.linalg.solve(own.T @ x[inside] + penalty, own.T @ labels[inside]) - w, 1.0
        while (new := loss(w + size * step)) > now and size > 1e-3:
            size /= 2
        w, last, now = w + size * step, now, min(now, new)
        if last - now < 1e-6 * last:
            break
    return w[:-1], float(w[-1])


def _spread(items: Sequence, n: int) -> list:
    return list(items) if len(items) <= n else [items[i] for i in np.linspace(0, len(items) - 1, n).astype(int)]


def train(sample: Sequence[tuple[str, int]]) -> Model:
    """The machine from (text, label) rows."""
    none, constant = np.zeros(_CODES**3, np.float32), np.zeros(len(LEVELS) + 6)
    texts = [[text.lower() for text, label in sample if label == y] for y in (0, 1)]
    constant[-1] = -30 if not texts[1] else 30
    if not all(texts):
        return Model(none, 0.0, constant)
    # A third of the documents teaches what the words of a document come to.
    many = min(map(len, texts)) >= 30
    judging = [side[::3] for side in texts] if many else texts
    lessons = [[t for i, t in enumerate(side) if i % 3] for side in texts] if many else judging
    same: dict[str, str] = {}
    learning = [[{same.setdefault(p, p) for u in words_of(text, text.split()) for p in _parts(u)} - {""} for text in side] for side in lessons]
    # Copies and near copies of a document mostly share the word with the least hash, and count once.
    kinds: dict[str, set[int]] = {}
    for bag in learning[1]:
        kind = min((zlib.crc32(word.encode("utf-8", "replace")) for word in bag), default=0)
        for word in bag:
            kinds.setdefault(word, set()).add(kind)
    often = {word: len(own) for word, own in kinds.items()}
    negative = sorted(set().union(*learning[0]))
    known = set(negative)
    # At first: any word that only toxic documents have, by their number.
    positive = sorted((w for w in often if w not in known), key=lambda w: (-often[w], w))
    if not positive:
        return Model(none, 0.0, -np.abs(constant))
    # So many toxic documents share a word that no clean one has only if there is a reason:
    # by chance, less than one word would reach this.
    sure = np.log(len(often) + len(negative)) / np.log(1 + len(learning[0]) / len(learning[1]))
    chosen, weight = positive[:5000], np.array([often[w] for w in positive[:5000]], dtype=float) ** 2
    hard = _spread(negative, 5000)
    model = Model(none, 0.0, constant)
    for _ in range(ROUNDS):
        marks = list(dict.fromkeys([*chosen[: LANDMARKS // 4], *_spread(chosen, LANDMARKS // 4), *_spread(hard, LANDMARKS // 2)]))
        among, basis = np.linalg.eigh(kernel(marks, marks))
        keep = among > 1e-4 * among.max()
        whiten = basis[:, keep] / np.sqrt(among[keep])
        words = [*chosen, *hard]
        labels = np.repeat([1.0, -1.0], [len(chosen), len(hard)])
        balance = np.concatenate([weight / weight.sum(), np.full(len(hard), 1 / len(hard))]) * len(words) / 2
        w, bias = _machine(kernel(words, marks) @ whiten, labels, balance)
        weights = none.copy()
        for (numbers, values), beta in zip(feature_rows(marks), whiten @ w):
            np.add.at(weights, numbers, (beta * values).astype(np.float32))
        model = Model(weights, bias, constant)
        # The worst word of each toxic document, and the clean words that the machine finds bad.
        found = dict(zip(positive, model.values(positive).tolist()))
        picked: dict[str, float] = {w: 1.0 for w in positive if often[w] >= sure}
        for bag in learning[1]:
            own = max(((found[w], w) for w in bag if w in found), default=None)
            if own:
                picked[own[1]] = picked.get(own[1], 0.0) + 1.0
        chosen = sorted(picked, key=lambda w: (-picked[w], w))
        weight = np.sqrt([picked[w] for w in chosen])
        worst = np.argsort(-model.values(negative), kind="stable")[:MINED]
        hard = list(dict.fromkeys([*(negative[i] for i in worst), *_spread(negative, 5000)]))
    known, rows = Known(), []
    for text in (text for side in judging for text in side):
        split = text.split()
        words, joined = words_of(text, split), joined_of(split)
        new = list(words.difference(known.words))
        known.words.update(zip(new, model.values(new).tolist()))
        close = model.joined(sorted(joined - words))
        rows.append(evidence([*map(known.words.__getitem__, words), *close.values()], len(words)))
    rows = np.array(rows)
    labels = np.repeat([0.0, 1.0], [len(side) for side in judging])
    return Model(model.weights, model.bias, _logistic(rows, labels))


def _logistic(rows: np.ndarray, labels: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    """Logistic regression by Newton steps; the rarer class counts more, by the root of the ratio."""
    ratio = np.sqrt((labels == 0).sum() / (labels == 1).sum())
    weight = np.where(labels == 1, max(1.0, ratio), max(1.0, 1 / ratio))
    penalty = ridge * np.eye(rows.shape[1])
    penalty[-1, -1] = 1e-4
    w = np.zeros(rows.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(rows @ w, -30, 30)))
        step = np.linalg.solve((rows * (weight * np.maximum(p * (1 - p), 1e-4))[:, None]).T @ rows + penalty, rows.T @ (weight * (labels - p)) - penalty @ w)
        w = w + step * min(1.0, 5 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    return w


def held_out(doc_id: Column) -> Column:
    """Documents whose labels are never learned from."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "utf-8")) % 5 == 0, F.lit(True))


def sample_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> list[tuple[str, int]]:
    """The bounded training sample: (text, label), at most `sample` documents of each class."""
    learned = labels.filter(F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = [common.bounded_sample(learned.filter(F.col("toxic") == y), ["doc_id"], sample) for y in (0, 1)]
    both = F.broadcast(chosen[0].unionByName(chosen[1]))
    rows = docs.filter(F.octet_length("text") <= MOST_BYTES).join(both, "doc_id").select("doc_id", "text", "toxic")
    return [(r["text"], r["toxic"]) for r in sorted(rows.collect(), key=lambda r: (r["doc_id"], r["text"]))]


def trained(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> Broadcast:
    """The machine, sent to the executors: 1 MB."""
    rows = sample_rows(common.text_rows(docs, id_col, text_col), labels, sample)
    return docs.sparkSession.sparkContext.broadcast(train(rows))


def _scores(model: Broadcast, batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[float]]]:
    known = Known()
    for whole in batches:
        for at in range(0, whole.num_rows, 200):
            batch = whole.slice(at, 200)
            yield batch, model.value.scores(batch.column("text").to_pylist(), known)


def scored(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted. `labels` has doc_id and toxic."""
    model = trained(docs, labels, id_col, text_col, sample)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, scores in _scores(model, batches):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    found = common.text_rows(docs, id_col, text_col).mapInArrow(run, "doc_id long, score double")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> DataFrame:
    """The documents that are not predicted toxic; the columns stay as they are."""
    model = trained(docs, labels, id_col, text_col, sample)

    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[list[bool]]:
        for _, scores in _scores(model, batches):
            yield [s < 0.5 for s in scores]

    return common.filter_texts(docs, keep, text_col)
