import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import clashing, frame, odd_rows, rows_of

from stallwise.llm import periodic_runs as R


def brute(words):
    """All maximal stretches by definition, shortest period of each."""
    best = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j - i >= q and j - i + q >= R.LEAST:
                best.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted(((s, e - s, q) for (s, e), q in best.items()), key=lambda r: (r[0], r[2]))


def test_transform_is_exact():
    rng = np.random.default_rng(1)
    for length, window in [(1, 3), (2, 7), (4, 11), (64, 191)]:
        blocks = rng.integers(0, R.PRIME, (5, length)).astype(np.uint64)
        windows = rng.integers(0, R.PRIME, (5, window)).astype(np.uint64)
        got = R.squared_differences(blocks, windows)
        for row in range(5):
            for place in range(window - length + 1):
                want = sum((int(b) - int(w)) ** 2 for b, w in zip(blocks[row], windows[row, place : place + length]))
                assert got[row, place] == want % R.PRIME
    rows = rng.integers(0, R.PRIME, (3, 128)).astype(np.uint64)
    assert (R.restored(R.transformed(rows)) == rows).all()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.tuples(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=9), st.integers(1, 9)), max_size=8), max_size=4))
def test_random_texts(parts):
    texts = [[w for own, times in text for w in own * times] for text in parts]
    assert R.runs_of(texts) == [brute(t) for t in texts]


@pytest.mark.parametrize("letters", [1, 2, 3, 40])
def test_longer_texts(letters):
    pick = random.Random(letters)
    texts = []
    for _ in range(12):
        words = [b"%d" % pick.randrange(letters) for _ in range(pick.randrange(400))]
        unit = words[: pick.randrange(1, 90)]
        texts.append(words + unit * pick.randrange(1, 5) + unit[: pick.randrange(len(unit) + 1)] + words[:50])
    assert R.runs_of(texts) == [brute(t) for t in texts]


def test_structured_words():
    fibonacci, thue = [b"a"], [b"a"]
    last = [b"b"]
    while len(fibonacci) < 600:
        fibonacci, last = fibonacci + last, fibonacci
    while len(thue) < 512:
        thue = thue + [b"b" if w == b"a" else b"a" for w in thue]
    combs = ([b"a"] * 50 + [b"b"]) * 12
    texts = [fibonacci, thue, combs, [b"x"] * 5000]
    got = R.runs_of(texts)
    assert got[:3] == [brute(t) for t in texts[:3]] and got[3] == [(0, 5000, 1)]


def test_sums_of_zero_modulo_the_prime_are_checked(monkeypatch):
    monkeypatch.setattr(R, "squared_differences", lambda blocks, windows: np.zeros((len(blocks), windows.shape[1] - blocks.shape[1] + 1), np.uint64))
    pick = random.Random(3)
    texts = [[b"%d" % pick.randrange(2) for _ in range(60)] for _ in range(20)]
    assert R.runs_of(texts) == [brute(t) for t in texts]


def test_defined_cases(spark):
    rows = odd_rows() + [(20, "a b " * 9), (21, "x\x1cy z " * 13)]
    docs = frame(spark, rows)
    out = R.found(clashing(docs)).collect()
    want = []
    for i, text in rows:
        words = (text or "").encode().split()
        runs = brute(words) if len(words) < 1000 else R.runs_of([words])[0]
        drop = {k for s, n, q in runs for k in range(s + q, s + n)}
        want.append((i, len(words), runs, b" ".join(w for k, w in enumerate(words) if k not in drop).decode()))
    assert sorted(((r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in out), key=repr) == sorted(want, key=repr)
    assert R.digests(R.found(frame(spark, []))).collect() == []
    assert len(rows_of(R.digests(R.found(R.planted(docs))))) == len(rows)
