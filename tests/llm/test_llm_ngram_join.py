import random
import re

import numpy as np
import pytest
from llm_cases import clashing, frame, odd_rows, rows_of

from stallwise.llm import common, ngram_join
from stallwise.llm.shingles import shingle_sets


def sets_of(texts, width):
    out = []
    for text in texts:
        w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(common.LOWER_BYTES))
        out.append({tuple(w[k : k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set())
    return out


def brute(rows, width, percent):
    sets = sets_of([t for _, t in rows], width)
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                parent[find(a)] = find(b)
    groups = {}
    for k, (i, _) in enumerate(rows):
        groups.setdefault(find(k), []).append(i)
    least = {k: min((x for x in v if x is not None), default=None) for k, v in groups.items()}
    return sorted(((i, len(sets[k]), least[find(k)]) for k, (i, _) in enumerate(rows)), key=repr)


def near_copies(seed, n=120):
    pick = random.Random(seed)
    words, made = [f"w{i}" for i in range(40)], []
    for _ in range(n):
        if made and pick.random() < 0.75:
            w = list(pick.choice(made))
            for _ in range(pick.randint(0, 3)):
                w[pick.randrange(len(w))] = pick.choice(words)
            w = w[:-1] or w if pick.random() < 0.3 else w
        else:
            w = [pick.choice(words) for _ in range(pick.choice([1, 2, 3, 4, 5, 30, 60, 100]))]
        made.append(w)
    return [(pick.randint(0, 10_000), " ".join(w)) for w in made]


@pytest.mark.parametrize("options", [{}, {"hot_list": 3}, {"group_sets": 3}, {"group_shingles": 150, "hot_list": 5}])
def test_matches_brute_force(spark, options):
    rows = near_copies(len(options) + 1) + [(7, ""), (8, None), (9, " \t\n")]
    got = rows_of(ngram_join.linked(frame(spark, rows), width=4, percent=85, **options))
    assert got == brute(rows, 4, 85)


def test_odd_rows_and_columns(spark):
    rows = odd_rows()
    docs = clashing(frame(spark, rows))
    assert rows_of(ngram_join.linked(docs)) == brute(rows, 5, 80)
    kept = ngram_join.drop_near_copies(docs)
    assert kept.columns == docs.columns
    ids = {r["doc_id"] for r in kept.collect()}
    assert {1, 2, 3, 4, 5, 9, 10, 11} <= ids and not {6, 7, 8} & ids
    assert ngram_join.linked(frame(spark, [])).collect() == []


def test_shingles_match_sets():
    pick = random.Random(4)
    texts = ["".join(pick.choice("aB \t\x00é\x0b") for _ in range(pick.randint(0, 60))) for _ in range(300)]
    for width in (1, 4):
        got = shingle_sets([t.encode() for t in texts], width)
        want = sets_of(texts, width)
        assert [len(g) for g in got] == [len(w) for w in want]
        for i in range(0, 290, 7):
            assert len(np.intersect1d(got[i], got[i + 9])) == len(want[i] & want[i + 9])


def test_link_tree_connects_what_links_connect():
    random_ = np.random.default_rng(3)
    for m in (2, 5, 40):
        base = random_.choice(10_000, 60, replace=False)
        sets = []
        for _ in range(m):
            own = base.copy()
            own[random_.choice(60, random_.integers(0, 8), replace=False)] = random_.integers(10_000, 10_200, 1)
            sets.append(np.unique(own).astype(np.uint64))
        label = list(range(m))
        for a, b in ngram_join.link_tree(sets, 85):
            label = [label[a] if x == label[b] else x for x in label]
        want = list(range(m))
        for a in range(m):
            for b in range(a):
                both = len(np.intersect1d(sets[a], sets[b]))
                if 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
                    want = [want[a] if x == want[b] else x for x in want]
        assert len({*zip(label, want)}) == len(set(label)) == len(set(want))


def test_filters_lose_no_linked_pair():
    random_ = np.random.default_rng(8)
    for percent in (80, 85):
        for _ in range(300):
            n = int(random_.integers(3, 60))
            one = np.sort(random_.choice(200, n, replace=False))
            two = one.copy()
            two[random_.choice(n, random_.integers(0, n // 6 + 1), replace=False)] += 1000
            two = np.unique(two[: n - int(random_.integers(0, 3))])
            both = len(np.intersect1d(one, two))
            if 100 * both < percent * (len(one) + len(two) - both):
                continue
            prefixes = [x[: ngram_join.prefix_length(len(x), percent)] for x in (one, two)]
            shared = np.intersect1d(*prefixes)
            assert len(shared)
            fits = [ngram_join.possible(np.array([len(one)]), np.searchsorted(one, [t]), np.array([len(two)]), np.searchsorted(two, [t]), percent)[0, 0] for t in shared]
            assert any(fits)
            counts = [ngram_join.part_counts(common.mix(x.astype(np.uint64))) for x in (one, two)]
            assert ngram_join.may_link(np.array([len(one), len(two)]), counts, percent).all()


def test_blocks_are_skipped_without_loss():
    random_ = np.random.default_rng(1)
    n = random_.integers(5, 400, 500)
    at = (random_.random(500) * (n - -(-85 * n // 100) + 1)).astype(int)
    match = ngram_join.possible(n, at, n, at, 85)
    np.fill_diagonal(match, False)
    assert (ngram_join.partners(n, at, 85) == match.any(axis=1)).all()


def _connected(edges, n):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        parent[find(a)] = find(b)
    return [find(x) for x in range(n)]


@pytest.mark.parametrize("kinds", [1, 4])
def test_a_large_list_of_near_copies_meets_its_head_only(spark, monkeypatch, kinds):
    """Rows grow with the members, not with their square; other kinds in the list meet all."""
    pick, n = np.random.default_rng(kinds), 3000
    bases = [np.sort(pick.integers(0, 2**63, 100).astype(np.uint64)) for _ in range(kinds)]
    sets, kind = [], []
    for i in range(n):
        k = i % kinds if i < 5 * kinds else 0
        kind.append(k)
        sets.append(np.delete(bases[k], pick.integers(0, 100, 2)))
    members = frame(spark, [(0, i, len(s)) for i, s in enumerate(sets)], "leader long, member long, n long")
    held = frame(spark, [(i, s.tobytes()) for i, s in enumerate(sets)], "member long, shingles binary")
    counts, stored = {}, common.stored
    monkeypatch.setattr(common, "stored", lambda f, name: (counts.update({name: (s := stored(f, name)).count()}), s)[1])
    edges = [tuple(r) for r in ngram_join._links(members, held, 85, 100, 10**9).collect()]
    groups = _connected(edges, n)
    assert len({(g, k) for g, k in zip(groups, kind)}) == len(set(groups)) == kinds
    assert counts["ngram-rest"] == (0 if kinds == 1 else 5 * (kinds - 1))
    # A link for each member and, where a list has parts, one for the head in each.
    assert counts["ngram-links"] < 1.1 * n


def test_long_words_are_told_apart(spark):
    """A Thue-Morse word and its complement: polynomials modulo 2**64 do not tell them apart."""
    run = [0]
    while len(run) < 1024:
        run += [1 - x for x in run]
    rows = [(1, "".join("ab"[x] for x in run)), (2, "".join("ba"[x] for x in run)), (3, "".join("ab"[x] for x in run))]
    assert rows_of(ngram_join.linked(frame(spark, rows), width=4, percent=85)) == [(1, 1, 1), (2, 1, 2), (3, 1, 1)]
