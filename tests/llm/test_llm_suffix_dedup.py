import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from llm_cases import clashing, frame, odd_rows, rows_of

from stallwise.llm import suffix_dedup as S


def brute(rows, length):
    starts = Counter()
    for _, t in rows:
        raw = (t or "").encode()
        starts.update(raw[i : i + length] for i in range(len(raw) - length + 1))
    out = []
    for doc, t in rows:
        raw = (t or "").encode()
        covered = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            if starts[raw[i : i + length]] > 1:
                covered[i : i + length] = b"\1" * length
        kept = bytes(x for x, c in zip(raw, covered) if not c)
        spans = sum(1 for i, c in enumerate(covered) if c and (i == 0 or not covered[i - 1]))
        out.append((doc, len(raw), sum(covered), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def passages(seed, n=50):
    pick = random.Random(seed)
    text = lambda size: "".join(pick.choice("abcdefgé ") for _ in range(size))
    base, rows = [text(pick.randint(30, 200)) for _ in range(4)], []
    for _ in range(n):
        own = text(pick.randint(0, 60))
        for _ in range(pick.randint(0, 3)):
            b = list(pick.choice(base))
            if pick.random() < 0.6:
                b[pick.randrange(len(b))] = pick.choice("xyz")
            own += "".join(b[pick.choice([0, 0, 7]) :]) + text(pick.randint(0, 30))
        rows.append((pick.randint(0, 1000), own))
    return rows + [(1, None), (2, ""), (None, base[0]), (None, base[0]), (5, "a" * 300), (6, "ab" * 100), rows[3], rows[3]]


@pytest.mark.parametrize("seed, length, group_most", [(0, 20, 10_000), (1, 25, 10_000), (2, 50, 5), (3, 30, 2)])
def test_matches_brute_force(spark, seed, length, group_most):
    rows = passages(seed)
    docs = frame(spark, rows).repartition(4)
    assert rows_of(S.without_repeats(docs, length, digests=True, group_most=group_most)) == brute(rows, length)


def test_odd_rows(spark):
    rows = odd_rows()
    docs = clashing(frame(spark, rows))
    assert rows_of(S.without_repeats(docs, digests=True)) == brute(rows, 400)
    kept = {(r["doc_id"], bytes(r["kept"])) for r in S.without_repeats(docs).collect()}
    assert (8, b"") in kept and (9, b"short") in kept
    assert S.without_repeats(frame(spark, [])).collect() == []


def test_merge_gives_order_and_common_prefixes():
    for seed in range(150):
        pick = random.Random(seed)
        runs = [sorted(bytes(pick.choice(b"ab") for _ in range(pick.randint(0, 12))) for _ in range(pick.randint(0, 9))) for _ in range(pick.randint(0, 6))]
        out = list(S.merge([S.decoded(*S.front_coded(r)) if r else iter(()) for r in runs]))
        keys = [key for _, key, _ in out]
        assert keys == sorted(sum(runs, []))
        assert [n for _, _, n in out] == [S._common(a, b, 0) for a, b in zip([b"", *keys], keys)]


def test_merge_never_reads_a_known_prefix_again(monkeypatch):
    """The bytes compared stay within the bytes of the strings and a few per game, however long the common prefixes are."""
    read = []
    plain = S._common
    monkeypatch.setattr(S, "_common", lambda a, b, n: read.append(plain(a, b, n) - n + 1) or plain(a, b, n))
    runs = [sorted(b"p" * 1000 + str(i * 7 + r).encode() for i in range(50)) for r in range(4)]
    coded = [S.front_coded(r) for r in runs]
    read.clear()
    assert len(list(S.merge([S.decoded(*c) for c in coded]))) == 200
    assert sum(read) < 3 * 1010 + 200 * 2 * 6


def test_anchors_do_not_depend_on_what_stands_around(monkeypatch):
    pick = np.random.default_rng(5)
    shared = pick.integers(97, 123, 900).astype(np.uint8).tobytes()
    texts = [pick.integers(97, 123, n).astype(np.uint8).tobytes() + shared + pick.integers(97, 123, 50).astype(np.uint8).tobytes() for n in (0, 13, 700)]
    found = S.anchors(texts, 400)
    inner = [{(g, (p >> 32) + ((p >> 16) & 0xFFFF) - n) for g, p in zip(f[0].tolist(), f[2].tolist())} for f, n in zip(found, (0, 13, 700))]
    common_ = inner[0] & inner[1] & inner[2]
    assert len([x for x in common_ if 0 <= x[1] < 900]) >= 3
    whole = S.anchors([texts[2]], 400)[0]
    monkeypatch.setattr(S, "CHUNK", 128)
    cut = S.anchors([texts[2]], 400)[0]
    covered = lambda f: sorted({p for x in f[2].tolist() for p in range(x >> 32, (x >> 32) + (x & 0xFFFF) + 1)})
    assert covered(whole) == covered(cut) == list(range(len(texts[2]) - 399))


def test_small_and_large_groups_agree(monkeypatch):
    pick = random.Random(6)
    for _ in range(60):
        length = 24
        suffixes = sorted((bytes(pick.choice(b"ab") for _ in range(pick.choice([14, 20, 24]))), bytes(pick.choice(b"ab") for _ in range(pick.randint(0, 10)))) for _ in range(6))
        group, last = [], b""
        for key, left in suffixes:
            group.append((left, S._common(last, key, 0), len(key)))
            last = key
        spread = lambda r: [sorted({d for a, b in own for d in range(a, b + 1)}) for own in r]
        monkeypatch.setattr(S, "SMALL_GROUP", 8)
        small = spread(S.repeated_starts(group, length))
        monkeypatch.setattr(S, "SMALL_GROUP", 0)
        assert small == spread(S.repeated_starts(group, length))
