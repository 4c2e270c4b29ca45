"""Words of many texts and their 64-bit hashes as arrays.

A slice's words are put into a dictionary by their bytes, and each different one is hashed once (SipHash, keyed and not
linear in its input).  A hash depends on the word alone, so every task gives a word the same hash.  Two words in a
vocabulary of n share one with a probability of about n^2 / 2^65; ``lanes`` gives 128 bits where that counts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pandas.util import hash_array

#: Keys of the two lanes, 16 bytes each.
KEYS = ("word-lane-number", "word-lane-second")


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of unsigned 64-bit integers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def combine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of ordered pairs of hashes."""
    return mix(a * np.uint64(0xD6E8FEB86659FD93) + (b ^ np.uint64(0xA0761D6478BD642F)))


def byte_class(accepted) -> np.ndarray:
    """Which of the 256 bytes belong to words."""
    return np.array([accepted(b) for b in range(256)])


#: Bytes other than ASCII white space; digits, lower-case letters and bytes beyond ASCII.
SOLID = byte_class(lambda b: not (b == 0x20 or 0x09 <= b <= 0x0D))
PLAIN = byte_class(lambda b: 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80)


def spans(data: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the longest runs of bytes of a class."""
    marks = np.diff(inside[data].astype(np.int8), prepend=0, append=0)
    edges = np.flatnonzero(marks)
    return edges[0::2], edges[1::2]


def encoded(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each span's place among the different ones, and these as bytes, in the order of their first places."""
    if not len(starts):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=object)
    steps = np.zeros(len(data) + 1, dtype=np.int8)
    steps[starts] += 1
    steps[ends] -= 1
    body = data[np.cumsum(steps[:-1], dtype=np.int8).view(bool)]
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    told = pa.Array.from_buffers(pa.large_binary(), len(starts), [
        None, pa.py_buffer(offsets), pa.py_buffer(body)]).dictionary_encode()
    return told.indices.to_numpy(zero_copy_only=False), told.dictionary.to_numpy(zero_copy_only=False)


def lane(different: np.ndarray, which: int = 0) -> np.ndarray:
    """A 64-bit hash of each of an array of bytes."""
    return hash_array(different, hash_key=KEYS[which], categorize=False).astype(np.uint64)


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of spans that are given in order of their starts and do not overlap."""
    place, different = encoded(data, starts, ends)
    return lane(different)[place]


def lanes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of each span."""
    place, different = encoded(data, starts, ends)
    return lane(different, 0)[place], lane(different, 1)[place]


def beginnings(data: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    """A hash of the ``n`` bytes (16 at most) from each start; one to one for eight bytes or fewer."""
    halves = []
    for a, b in ((0, min(n, 8)), (8, max(n, 8))):
        part = np.zeros(len(starts), dtype=np.uint64)
        for i in range(a, b):
            part = (part << np.uint64(8)) | data[starts + i]
        halves.append(part)
    return combine(mix(halves[0]), halves[1] ^ np.uint64(n << 56))


def joined(texts: list[bytes | None], lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one array, a line end after each, and where each text's part ends."""
    data = b"\n".join([t or b"" for t in texts] + [b""])
    if lower:
        data = data.lower()
    ends = np.cumsum([len(t or b"") + 1 for t in texts])
    return np.frombuffer(data, dtype=np.uint8), ends


def words(texts: list[bytes | None], inside: np.ndarray = SOLID,
          lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """The row and the hash of every word, in order."""
    data, text_ends = joined(texts, lower)
    starts, ends = spans(data, inside)
    return np.searchsorted(text_ends, starts, side="right"), hashes(data, starts, ends)


def wide_words(texts: list[bytes | None], inside: np.ndarray = SOLID) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The row and both hashes of every word, in order."""
    data, text_ends = joined(texts, False)
    starts, ends = spans(data, inside)
    return np.searchsorted(text_ends, starts, side="right"), *lanes(data, starts, ends)
