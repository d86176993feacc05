"""A character-level bidirectional LSTM with a CRF on top, in numpy.

Characters become one of a few classes (letters, digits, each ASCII mark, space,
other letters). Two LSTMs read the classes in both directions; their states give
a score for each tag, and the CRF adds scores for neighbouring tags. Tags are
outside, and begin and inside of each kind. Training maximises the likelihood of
labelled windows with Adam; everything is seeded, so a sample gives one model.
"""

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np

KINDS = ("email", "ip", "card", "phone")
TAGS = 1 + 2 * len(KINDS)


def _class_table() -> np.ndarray:
    """0 pads; a-z with case as a second row would double the table, so case is dropped."""
    table = np.full(0x250, 3, np.uint8)  # other
    table[[9, 10, 11, 12, 13, 32, 0xA0]] = 1
    table[48:58] = 2
    for code in range(33, 127):
        if not 48 <= code <= 57:
            table[code] = 4 + (code - 33 if not 97 <= code <= 122 else code - 32 - 33)
    return table


_CLASSES = _class_table()
VOCABULARY = int(_CLASSES.max()) + 1


def classes(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    return _CLASSES[np.minimum(codes, len(_CLASSES) - 1)]


def tags_of(length: int, spans: Sequence[tuple[int, int, int]]) -> np.ndarray:
    """Tags of a text from (kind, start, end) spans."""
    tags = np.zeros(length, np.int64)
    for kind, start, end in spans:
        tags[start:end] = 2 + 2 * kind
        tags[start] = 1 + 2 * kind
    return tags


def spans_of(tags: Sequence[int]) -> list[tuple[int, int, int]]:
    """(kind, start, end) from tags; an inside tag without its begin starts a span as well."""
    out, kind, start = [], -1, 0
    for i, tag in enumerate([*tags, 0]):
        now = (tag - 1) // 2 if tag else -1
        if now != kind or tag % 2:
            if kind >= 0:
                out.append((kind, start, i))
            kind, start = now, i
    return out


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


@dataclass
class Tagger:
    """Weights: w (class to gates), u (state to gates) for both directions; out and bias to tags; the CRF's moves, first."""

    weights: dict[str, np.ndarray]

    @staticmethod
    def new(hidden: int = 24, seed: int = 7) -> "Tagger":
        random = np.random.default_rng(seed)
        w: dict[str, np.ndarray] = {}
        for side in "fb":
            w["w" + side] = random.normal(0, 0.3, (VOCABULARY, 4 * hidden))
            w["w" + side][:, hidden : 2 * hidden] += 1.0  # remember at first
            w["u" + side] = random.normal(0, 0.6 / hidden**0.5, (hidden, 4 * hidden))
        w["out"] = random.normal(0, 0.2, (2 * hidden, TAGS))
        w["bias"], w["moves"], w["first"] = np.zeros(TAGS), np.zeros((TAGS, TAGS)), np.zeros(TAGS)
        return Tagger({k: v.astype(np.float32) for k, v in w.items()})

    def _lstm(self, side: str, ids: np.ndarray, mask: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
        """States by time; ids and mask are (time, batch) in reading order."""
        w, u = self.weights["w" + side], self.weights["u" + side]
        n = u.shape[0]
        h = c = np.zeros((ids.shape[1], n), np.float32)
        states, kept = np.zeros((*ids.shape, n), np.float32), []
        for t in range(len(ids)):
            z = w[ids[t]] + h @ u
            gates = 1 / (1 + np.exp(-np.clip(z[:, : 3 * n], -30, 30)))
            i, f, o = gates[:, :n], gates[:, n : 2 * n], gates[:, 2 * n :]
            g, m = np.tanh(z[:, 3 * n :]), mask[t][:, None]
            new = (f * c + i * g) * m
            squashed = np.tanh(new)
            if keep:
                kept.append((h, c, i, f, o, g, squashed))
            c, h = new, o * squashed * m
            states[t] = h
        return states, kept

    def _lstm_back(self, side: str, ids: np.ndarray, mask: np.ndarray, kept: list, grads: np.ndarray, into: dict[str, np.ndarray]) -> None:
        u = self.weights["u" + side]
        n = u.shape[0]
        dh = dc = np.zeros((ids.shape[1], n), np.float32)
        for t in range(len(ids) - 1, -1, -1):
            h, c, i, f, o, g, squashed = kept[t]
            m = mask[t][:, None]
            dh = (dh + grads[t]) * m
            dc = (dc + dh * o * (1 - squashed**2)) * m
            dz = np.concatenate([dc * g * i * (1 - i), dc * c * f * (1 - f), dh * squashed * o * (1 - o), dc * i * (1 - g**2)], axis=1)
            into["w" + side] += (np.arange(VOCABULARY)[:, None] == ids[t]).astype(np.float32) @ dz
            into["u" + side] += h.T @ dz
            dh, dc = dz @ u.T, dc * f

    def emissions(self, ids: np.ndarray, mask: np.ndarray, keep: bool = False):
        """Tag scores (time, batch, tag) of class windows (time, batch)."""
        forward, kept_f = self._lstm("f", ids, mask, keep)
        backward, kept_b = self._lstm("b", ids[::-1], mask[::-1], keep)
        states = np.concatenate([forward, backward[::-1]], axis=2)
        return states @ self.weights["out"] + self.weights["bias"], states, kept_f, kept_b

    def gradients(self, ids: np.ndarray, mask: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Negative log likelihood of the tags per window, and its gradients."""
        w = self.weights
        scores, states, kept_f, kept_b = self.emissions(ids, mask, keep=True)
        time, batch, _ = scores.shape
        alpha, beta = np.zeros_like(scores), np.zeros_like(scores)
        alpha[0] = w["first"] + scores[0]
        for t in range(1, time):
            new = _logsum(alpha[t - 1][:, :, None] + w["moves"][None], 1) + scores[t]
            alpha[t] = np.where(mask[t][:, None] > 0, new, alpha[t - 1])
        for t in range(time - 2, -1, -1):
            new = _logsum(w["moves"][None] + (scores[t + 1] + beta[t + 1])[:, None, :], 2)
            beta[t] = np.where(mask[t + 1][:, None] > 0, new, 0)
        total = _logsum(alpha[-1], 1)
        into = {k: np.zeros_like(v) for k, v in w.items()}
        grad = np.exp(alpha + beta - total[None, :, None]) * mask[:, :, None]
        rows = np.arange(batch)
        gold = w["first"][tags[0]] + scores[0, rows, tags[0]]
        into["first"] += grad[0].sum(axis=0)
        np.add.at(into["first"], tags[0], -1)
        for t in range(1, time):
            on = mask[t]
            pair = alpha[t - 1][:, :, None] + w["moves"][None] + (scores[t] + beta[t])[:, None, :] - total[:, None, None]
            into["moves"] += (np.exp(np.minimum(pair, 0)) * on[:, None, None]).sum(axis=0)
            np.add.at(into["moves"], (tags[t - 1], tags[t]), -on)
            gold = gold + (w["moves"][tags[t - 1], tags[t]] + scores[t, rows, tags[t]]) * on
        grad[np.arange(time)[:, None], rows[None, :], tags] -= mask
        into["out"] += np.einsum("tbs,tbk->sk", states, grad)
        into["bias"] += grad.sum(axis=(0, 1))
        down = grad @ w["out"].T
        n = down.shape[2] // 2
        self._lstm_back("f", ids, mask, kept_f, down[:, :, :n], into)
        self._lstm_back("b", ids[::-1], mask[::-1], kept_b, down[::-1, :, n:], into)
        return float((total - gold).mean()), {k: v / batch for k, v in into.items()}

    def decode(self, scores: np.ndarray) -> list[int]:
        """The best tags for one text's scores (time, tag)."""
        moves, best = self.weights["moves"], self.weights["first"] + scores[0]
        back = np.zeros(scores.shape, np.int64)
        for t in range(1, len(scores)):
            options = best[:, None] + moves
            back[t] = options.argmax(axis=0)
            best = options[back[t], np.arange(TAGS)] + scores[t]
        tags = [int(best.argmax())]
        for t in range(len(scores) - 1, 0, -1):
            tags.append(int(back[t][tags[-1]]))
        return tags[::-1]


def windows_of(texts: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Class rows of different lengths as (time, batch) with a mask."""
    time = max(map(len, texts))
    ids, mask = np.zeros((time, len(texts)), np.int64), np.zeros((time, len(texts)), np.float32)
    for k, own in enumerate(texts):
        ids[: len(own), k], mask[: len(own), k] = own, 1
    return ids, mask


def train(sample: Sequence[tuple[str, Sequence[tuple[int, int, int]]]], epochs: int = 9, batch: int = 32, rate: float = 0.01, seed: int = 11) -> Tagger:
    """A tagger from labelled windows: (text, spans as (kind, start, end))."""
    tagger, random = Tagger.new(), np.random.default_rng(seed)
    rows = [(classes(text), tags_of(len(text), spans)) for text, spans in sample if text]
    first = {k: np.zeros_like(v) for k, v in tagger.weights.items()}
    second = {k: np.zeros_like(v) for k, v in tagger.weights.items()}
    step, steps = 0, max(1, epochs * -(-len(rows) // batch))
    for _ in range(epochs):
        order = random.permutation(len(rows))
        for at in range(0, len(rows), batch):
            own = sorted((rows[i] for i in order[at : at + batch]), key=lambda r: len(r[0]))
            ids, mask = windows_of([r[0] for r in own])
            tags = np.zeros(ids.shape, np.int64)
            for k, (_, t) in enumerate(own):
                tags[: len(t), k] = t
            _, grads = tagger.gradients(ids, mask, tags)
            step += 1
            norm = np.sqrt(sum(float((g**2).sum()) for g in grads.values()))
            now, scale = rate * (1 - 0.95 * step / steps), min(1.0, 5.0 / max(norm, 1e-9))
            for k, g in grads.items():
                g = g * scale
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g**2
                tagger.weights[k] -= (now * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
    return tagger
