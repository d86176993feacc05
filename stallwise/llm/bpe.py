"""Byte-level BPE with the tiktoken library and a local rank file.

Texts are encoded as ordinary text (no special tokens) and decoded as raw bytes.
Long texts are cut first, at places where the splitting pattern always ends a
match, so the ids of the pieces are the ids of the whole:

* before white space that follows something else (no match goes on into it);
* before the last character of a run of white space that something follows
  (the pattern leaves that character to the next match);
* between a letter and a digit.

What is left is one match of the pattern. If even that is very long, it is
merged on its own, without the pattern.

Defined cases: null counts as empty, and empty texts have no ids; every input row
gives one, also those that repeat an id or have none; an empty table gives no
rows; extra columns are ignored.
"""

import base64
import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame

from stallwise.llm import common

#: Texts up to so many characters are encoded in one call; longer ones in pieces of about that length.
PIECE = 100_000
_SAFE = regex.compile(r"(?<=\S)(?=\s)|(?<=\s)(?=\s\S)|(?<=\p{L})(?=\p{N})|(?<=\p{N})(?=\p{L})")


@lru_cache(maxsize=4)
def encoding(rank_file: str, pattern: str) -> tiktoken.Encoding:
    """The encoding of a rank file: a line for each token, base64 bytes and rank."""
    with open(rank_file, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def pieces(text: str, size: int = PIECE) -> Iterator[str]:
    """The text in parts that end at safe places, each about `size` long unless there is no such place."""
    start = 0
    while len(text) - start > size:
        found = _SAFE.search(text, start + size)
        if found is None or found.start() >= len(text):
            break
        yield text[start : found.start()]
        start = found.start()
    yield text[start:]


def encode(text: str, codec: tiktoken.Encoding, pattern: str, size: int = PIECE) -> list[int]:
    if len(text) <= size:
        return codec.encode_ordinary(text)
    ids: list[int] = []
    for piece in pieces(text, size):
        if len(piece) <= 2 * size:
            ids += codec.encode_ordinary(piece)
        else:
            for match in regex.finditer(pattern, piece):
                ids += codec._encode_single_piece(match[0]) if len(match[0]) > size else codec.encode_ordinary(match[0])
    return ids


def encoded(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_tokens, ids (array of int), decoded (binary)."""
    return common.text_rows(docs, id_col, text_col).mapInArrow(
        _rows(rank_file, pattern, digests=False), "doc_id long, n_tokens long, ids array<int>, decoded binary"
    )


def encoded_digests(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As `encoded`, with digests in place of the ids and bytes: these stay in the task that made them."""
    return common.text_rows(docs, id_col, text_col).mapInArrow(
        _rows(rank_file, pattern, digests=True), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def _rows(rank_file: str, pattern: str, digests: bool):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = encoding(rank_file, pattern)
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                out = []
                for text in batch.column("text").to_pylist():
                    ids = encode(text, codec, pattern)
                    raw = codec.decode_bytes(ids)
                    if digests:
                        packed = np.array(ids, dtype="<u4").tobytes()
                        out.append((len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(raw).hexdigest()))
                    else:
                        out.append((len(ids), ids, raw))
                kinds = (pa.int64(), pa.string(), pa.string()) if digests else (pa.int64(), pa.list_(pa.int32()), pa.binary())
                names = ["doc_id", "n_tokens", *(("ids_sha256", "decoded_sha256") if digests else ("ids", "decoded"))]
                columns = [pa.array([row[i] for row in out], kind) for i, kind in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=names)

    return run
