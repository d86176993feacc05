import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from llm_cases import clashing, frame, odd_rows

from stallwise.llm import bpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.mark.parametrize("seed", range(8))
def test_pieces_encode_as_the_whole(seed):
    codec, pick = bpe.encoding(PATH, PATTERN), random.Random(seed)
    alphabet = ["a", "b", " ", "  ", "\n", "1", "'s", "'", "é", "ß", "!", "\t", " ", "́", "日本", "don't", "_"]
    for _ in range(150):
        text = "".join(pick.choice(alphabet) for _ in range(pick.randint(0, 120)))
        assert bpe.encode(text, codec, PATTERN, size=7) == codec.encode_ordinary(text)


def test_single_matches_longer_than_a_piece():
    codec = bpe.encoding(PATH, PATTERN)
    for text in ("a" * 500, " " * 500, " " * 500 + "b", "!" * 500, "ab" * 300 + " c"):
        assert bpe.encode(text, codec, PATTERN, size=50) == codec.encode_ordinary(text)


def test_round_trip_of_odd_rows(spark):
    rows = odd_rows() + [(50, "<|endoftext|> is plain text"), (51, "naïve 日本語 🙂")]
    docs, codec = clashing(frame(spark, rows)), bpe.encoding(PATH, PATTERN)
    got = sorted(bpe.encoded(docs, PATH, PATTERN).collect(), key=repr)
    want = sorted([(i, codec.encode_ordinary(t or ""), (t or "").encode()) for i, t in rows], key=repr)
    assert sorted([(r["doc_id"], list(r["ids"]), bytes(r["decoded"])) for r in got], key=repr) == want
    assert all(r["n_tokens"] == len(r["ids"]) for r in got)
    hashed = {(r["doc_id"], r["ids_sha256"], r["decoded_sha256"]) for r in bpe.encoded_digests(docs, PATH, PATTERN).collect()}
    assert hashed == {(i, hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(raw).hexdigest()) for i, ids, raw in want}
    assert bpe.encoded(frame(spark, []), PATH, PATTERN).collect() == []
