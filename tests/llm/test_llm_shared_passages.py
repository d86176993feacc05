import random

import pytest
from llm_cases import clashing, frame, odd_rows, rows_of

from stallwise.llm import shared_passages as P


def brute(rows, words):
    seen = {}
    for i, text in set(rows):
        own = (text or "").encode().split()
        for k in range(len(own) - words + 1):
            seen.setdefault(tuple(own[k : k + words]), set()).add((i, text))
    return sorted({owner[0] for owners in seen.values() if len(owners) > 1 for owner in owners}, key=repr)


def found(frame_, **kwargs):
    return sorted({r["doc_id"] for r in P.sharing(frame_, **kwargs).collect()}, key=repr)


@pytest.mark.parametrize("words, gram", [(51, 16), (12, 4)])
def test_against_brute_force(spark, words, gram):
    pick = random.Random(words)
    bank = [[f"p{b}w{pick.randrange(10**6)}" for _ in range(words + extra)] for b, extra in enumerate([-1, 0, 1, 5, 40, 200])]
    rows = []
    for i in range(200):
        text = [f"x{pick.randrange(60)}" for _ in range(pick.randrange(90))]
        if i % 4 == 0:
            text += pick.choice(bank) * pick.choice([1, 2])
        text += [f"x{pick.randrange(60)}" for _ in range(pick.randrange(90))]
        rows.append((i, pick.choice([" ", "\n", "\t \r"]).join(text)))
    rows += [(500, "just one " * 300), (501, rows[7][1]), (502, rows[8][1] + " more")]
    assert found(frame(spark, rows), words=words, gram=gram) == brute(rows, words)


def test_defined_cases(spark):
    rows = odd_rows()
    assert found(clashing(frame(spark, rows)), words=12, gram=4) == brute(rows, 12)
    assert rows_of(P.sharing(frame(spark, []))) == []


def test_words_and_shards():
    (a, b, c) = P.word_hashes([b" the  cat\n", b"", b"cat the"])
    assert len(a) == 2 and len(b) == 0 and list(c) == [a[1], a[0]]
    raws = [b"a b " * 100_000, b"", b"c " * 300_000, b"d"]
    assert [x for _, some in P._shards(raws) for x in some] == raws


def test_column_beside_the_removal(spark):
    from stallwise.llm import suffix_dedup

    pick = random.Random(5)
    passage = " ".join(f"p{pick.randrange(10**3)}" for _ in range(55))
    rows = [(i, " ".join(f"x{pick.randrange(10**6)}" for _ in range(80)) + (f" {passage} y{i}" if i % 3 == 0 else "")) for i in range(30)]
    assert len(passage) < 400
    docs = frame(spark, [*rows, (99, None), (None, rows[1][1])])
    plain = suffix_dedup.without_repeats(docs, digests=True)
    beside = suffix_dedup.without_repeats(docs, digests=True, passages=P.sharing(docs))
    assert rows_of(beside.drop("shares_passage")) == rows_of(plain)
    shares = {r["doc_id"] for r in beside.collect() if r["shares_passage"]}
    assert shares == {i for i in range(30) if i % 3 == 0} | {1, None}
