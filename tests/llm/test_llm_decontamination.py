import random
import tracemalloc

import numpy as np
import pytest
from llm_cases import clashing, frame, odd_rows, rows_of

from stallwise.llm import decontamination as D


def brute(raws, items):
    windows = {}
    for item, text in items:
        w = D.words(text)
        for k in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[k : k + 10]), set()).add(item)
    out = []
    for raw in raws:
        w, hit, found = D.words(raw), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit.update(range(k, k + n))
                    found |= windows[tuple(w[k : k + n])]
        out.append((len(w), hit, found))
    return out


def case(seed):
    pick = random.Random(seed)
    text = lambda n: " ".join(pick.choice(["a", "b", "c", "dé", "E", "zz"]) for _ in range(n)).encode()
    items = [(str(i), text(pick.choice([0, 1, 3, 9, 10, 14, 30]) if seed % 2 else pick.choice([8, 10, 12, 25]))) for i in range(pick.randint(0, 6))]
    raws = []
    for _ in range(pick.randint(0, 8)):
        raw = text(pick.randint(0, 30))
        if items and pick.random() < 0.6:
            raw += b" " + pick.choice(items)[1] + b" " + text(5)
        raws += [raw] * pick.choice([1, 1, 2])
    return raws, items


@pytest.mark.parametrize("seed", range(60))
def test_hits_match_brute_force(seed):
    raws, items = case(seed)
    counts, spans, found = D.hits(raws, D.Windows(items))
    got = [(n, {k for a, e in own for k in range(a, e)}, f) for n, own, f in zip(counts, spans, found)]
    assert got == brute(raws, items)
    assert all(a[1] < b[0] for own in spans for a, b in zip(own, own[1:]))


def test_suffix_order_and_ranks():
    symbols = np.array([1, 2, 1, 2, 0, 1, 2, 0, 3, 0])
    order = D._suffix_order(symbols)
    keys = [tuple((s, i + k) if s == 0 else (s, -1) for k, s in enumerate(symbols[i:])) for i in range(len(symbols))]
    assert order.tolist() == sorted(range(len(symbols)), key=keys.__getitem__)
    index = D.ShardIndex(symbols, 3, sample=4)
    before = symbols[order - 1]
    for symbol in range(1, 4):
        for at in range(len(symbols) + 1):
            assert index.rank(np.array([symbol]), np.array([at]))[0] == (before[:at] == symbol).sum()
    which, low, high = index.search(np.array([[1, 2], [2, 1], [3, 3]]))
    assert which.tolist() == [0, 1] and sorted(index.locate(np.arange(low[0], high[0])).tolist()) == [0, 2, 5]


def test_blocks_of_the_benchmark_give_the_same(spark):
    pick = random.Random(2)
    words = [f"w{i}" for i in range(30)]
    items = [(i, " ".join(pick.choice(words) for _ in range(pick.choice([4, 15, 30])))) for i in range(20)] + [(3, "once more under this id"), (None, "nobody"), (30, None)]
    rows = odd_rows() + [(i, " ".join(pick.choice(words) for _ in range(20)) + " " + (items[i % 20][1])) for i in range(100, 130)] + [(200, "by nobody at all")]
    docs, benchmark = clashing(frame(spark, rows)), frame(spark, items, "item_id long, text string")
    one = rows_of(D.digests(D.contamination(docs, benchmark)))
    assert one == rows_of(D.digests(D.contamination(docs, benchmark, block_bytes=200)))
    bad = {r[0] for r in one if r[-1]}
    assert set(range(100, 130)) | {200} <= bad and not {1, 2, 3, 9} & bad
    kept = D.drop_contaminated(docs, benchmark, block_bytes=200)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {r[0] for r in one if not r[-1]}


def test_empty_tables(spark):
    none = frame(spark, [], "item_id long, text string")
    assert all(r["n_hit"] == 0 and not r["contaminated"] for r in D.digests(D.contamination(frame(spark, odd_rows()), none)).collect())
    assert D.contamination(frame(spark, []), none).collect() == []


def test_a_shard_is_searched_without_holding_the_words_of_all_its_texts():
    windows = D.Windows([("i", b" ".join(b"bench%d" % i for i in range(12)))])
    texts = [b" ".join(b"w%d" % (i * j % 977) for i in range(4000)) for j in range(1, 60)]
    tracemalloc.start()
    try:
        counts, spans, _ = D.hits(texts, windows)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert counts == [4000] * 59 and not any(spans)
    assert peak < 9 * sum(map(len, texts))
