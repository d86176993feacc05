"""Word shingles of whole texts as numbers, many documents at a time.

Words are runs of bytes other than space and 0x09-0x0D, A-Z lower-cased. A
shingle is `width` words in a row; a text with fewer words, but some, has all of
them as its one shingle. A word's number is a polynomial of its bytes, spread by
a bijection; a shingle's number is the same of its words. Both have 64 bits.
Long words could be made so that such polynomials are equal whatever the base,
so their numbers are the first bytes of their SHA-256.
"""

import hashlib
from functools import lru_cache

import numpy as np

from stallwise.llm.common import LOWER_BYTES, mix

#: Bytes beyond which a word's number is a digest.
LONG_WORD = 64

_U = np.uint64
_BASE = 0xD6E8FEB86659FD93
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTES = mix(np.arange(1, 257, dtype=np.uint64))


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2**64."""
    both = []
    for base in (_BASE, _INVERSE):
        factors = np.full(size, base, _U)
        factors[0] = 1
        both.append(np.multiply.accumulate(factors))
    return both[0], both[1]


def word_numbers(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all words, and how many words each text has."""
    joined = np.frombuffer(b" ".join([*raws, b""]).translate(LOWER_BYTES), np.uint8)
    if not len(joined):
        return np.zeros(0, _U), np.zeros(len(raws), np.int64)
    inside = (joined != 32) & ((joined < 9) | (joined > 13))
    edges = np.flatnonzero(np.diff(inside.view(np.int8), prepend=0, append=0))
    starts, ends = edges[::2], edges[1::2]
    size = 1 << max(16, int(len(joined) + 1).bit_length())
    powers, inverse = _powers(size)
    sums = np.zeros(len(joined) + 1, _U)
    np.cumsum(_BYTES[joined] * powers[: len(joined)], out=sums[1:])
    numbers = mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(_U))
    for i in np.flatnonzero(ends - starts > LONG_WORD).tolist():
        numbers[i] = int.from_bytes(hashlib.sha256(joined[starts[i] : ends[i]].tobytes()).digest()[:8], "big")
    lengths = np.fromiter(map(len, raws), np.int64, len(raws)) + 1
    begins = np.cumsum(lengths) - lengths
    counts = np.diff(np.searchsorted(starts, np.append(begins, len(joined) + 1)))
    return numbers, counts


def shingle_sets(raws: list[bytes], width: int) -> list[np.ndarray]:
    """The distinct shingles of each text, sorted."""
    numbers, counts = word_numbers(raws)
    factors = mix(np.arange(1, width + 1, dtype=np.uint64)) | _U(1)
    n = max(0, len(numbers) - width + 1)
    total = np.zeros(n, _U)
    for k in range(width):
        total += numbers[k : k + n] * factors[k]
    rows = mix(total)
    out, at = [], 0
    for count in counts.tolist():
        if count >= width:
            out.append(np.unique(rows[at : at + count - width + 1]))
        elif count:
            whole = (numbers[at : at + count] * factors[:count]).sum(dtype=_U)
            out.append(mix(np.array([whole + _U(count)], _U)))
        else:
            out.append(np.zeros(0, _U))
        at += count
    return out
