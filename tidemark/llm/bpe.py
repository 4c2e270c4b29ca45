"""Byte-pair encoding and decoding by dynamic programming over prefixes.

The text is cut into pieces by the tokenizer's pattern.  Within a piece an Aho-Corasick automaton of the
vocabulary tells, for each prefix, all tokens that are a suffix of it.  Exactly one of them can be the last
token of the prefix's encoding: the one that is compatible with the last token of what stands before it.
Two neighbours are compatible if undoing their merges at the seam, latest first, meets no merge across the
seam that would have come earlier.  So one walk stores the last token of every prefix and the way
back gives the exact ids, in time that does not depend on how the merges nest.

The vocabulary file is a parameter; the driver reads it and broadcasts its bytes (a vocabulary has a fixed
size, checked against ``MAX_FILE``).  A null text reads as empty and has no ids.  Rows are mapped one by
one, so null or repeated ids and extra columns come through.  A text of any length is encoded whole.
"""

from __future__ import annotations

import hashlib
import json
import re

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.base import add_columns

MAX_FILE = 64 << 20
#: Pieces, and pairs of tokens, whose result a worker remembers before it starts afresh.
REMEMBERED, LONGEST_REMEMBERED = 1 << 18, 64

# The pattern of pieces; the same for texts of ASCII only; and the code points that became
# letters or numbers after the version of Unicode (16) that the encoding follows.
_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?{L}+| ?{N}+| ?[^\s\p{{L}}\p{{N}}{new}]+|\s+(?!\S)|\s+"
_ASCII = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\t-\r A-Za-z0-9]+"
                    r"|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+")
_NEWER = (
    "558 58b-58c 88f c5c cdc 208f 209d-209f a7ce-a7cf a7d2 a7d4 a7dd a7e2 a7f1 ab6c-ab6d 107bb-107bf "
    "10940-10959 10ec5-10ec7 10ed9-10eee 11b0a 11db0-11ddb 11de0-11de9 11df1 1246f 12475-1247f 12550-12686 "
    "16ea0-16eb8 16ebb-16ed3 16ff2-16ff3 16ff4-16ff6 187f8-187ff 18cd6-18cda 18d09-18d20 18d80-18df2 "
    "18e00-19191 191a0-191d2 1b123-1b128 1b168 1d6a6 1df1f-1df24 1df2b-1df81 1df90-1df96 1dfcd-1dfff "
    "1e6c0-1e6de 1e6e0-1e6e2 1e6e4-1e6e5 1e6e7-1e6ed 1e6f0-1e6f4 1e6fe-1e6ff 2b73a-2b73f 2b81e 2cea2-2cead "
    "323b0-33479 3d000-3fc3f")


def _class(ranges: str) -> str:
    return "".join("-".join(f"\\U{int(x, 16):08x}" for x in r.split("-")) for r in ranges.split())


_NEW_CLASS = regex.compile(f"[{_class(_NEWER)}]")
_PLAIN = regex.compile(_PIECES.format(L=r"\p{L}", N=r"\p{N}", new=""))
#: With newer letters and numbers in the class of other signs, as if they were not assigned yet.
_STRICT = regex.compile(
    "(?V1)" + r"'s|'t|'re|'ve|'m|'ll|'d| ?[\p{L}--[NEW]]+| ?[\p{N}--[NEW]]+| ?[[^\s\p{L}\p{N}]||[NEW]]+"
    r"|\s+(?!\S)|\s+".replace("NEW", _class(_NEWER)))


def pieces(text: str) -> list[str]:
    if text.isascii():
        return _ASCII.findall(text)
    return (_STRICT if _NEW_CLASS.search(text) else _PLAIN).findall(text)


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in vocabulary files."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Codec:
    """Encoder and decoder of one vocabulary file (byte-level, JSON)."""

    def __init__(self, content: bytes) -> None:
        told = json.loads(content)
        alphabet = byte_alphabet()
        ids = {bytes(alphabet[c] for c in token): i for token, i in told["model"]["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in told["added_tokens"]}
        size = 1 + max([*ids.values(), *self.special.values()])
        self.bytes_of: list[bytes] = [b""] * size
        for token, i in ids.items():
            self.bytes_of[i] = token
        for token, i in self.special.items():
            self.bytes_of[i] = token.encode()
        self.rank, self.parts, self.merge = [-1] * size, [(-1, -1)] * size, {}
        for r, pair in enumerate(told["model"]["merges"]):
            a, b = (bytes(alphabet[c] for c in x) for x in (pair.split(" ") if isinstance(pair, str) else pair))
            left, right, whole = ids[a], ids[b], ids[a + b]
            self.merge[left, right] = r
            if self.rank[whole] < 0:
                self.rank[whole], self.parts[whole] = r, (left, right)
        self.apart = regex.compile("(" + "|".join(map(regex.escape, sorted(
            self.special, key=len, reverse=True))) + ")") if self.special else None
        self.known: dict[tuple[int, int], bool] = {}
        self.cache: dict[str, bytes] = {}
        self.whole: dict[str, int] = {}
        self.automaton = ahocorasick.Automaton()
        for token, i in sorted(ids.items(), key=lambda x: self.rank[x[1]]):
            left, right = self.parts[i]
            # a token that merging its own bytes does not give can stand in no encoding
            if len(token) == 1 or (left >= 0 and self._stands(left) and self._stands(right)
                                   and self.seam(left, right, self.rank[i])):
                key = token.decode("latin-1")
                self.whole[key] = i
                self.automaton.add_word(key, (i, len(token)))
        self.automaton.make_automaton()

    def _stands(self, i: int) -> bool:
        return self.bytes_of[i].decode("latin-1") in self.whole

    def seam(self, left: int, right: int, limit: float = float("inf")) -> bool:
        """Whether no merge across the seam comes before ``limit`` and before those of its sides."""
        rank, merge = self.rank, self.merge
        while True:
            if merge.get((left, right), limit) < limit:
                return False
            a, b = rank[left], rank[right]
            if a > b:
                left, limit = self.parts[left][1], a
            elif b >= 0:
                # of equal merges the one further left comes first, hence the seam's before this one
                right, limit = self.parts[right][0], b + 1
            else:
                return True

    def compatible(self, left: int, right: int) -> bool:
        pair = (left, right)
        good = self.known.get(pair)
        if good is None:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            good = self.known[pair] = self.seam(left, right)
        return good

    def piece_ids(self, piece: str) -> list[int]:
        """Ids of one piece, given as one character a byte."""
        if piece in self.whole:
            return [self.whole[piece]]
        last = [-1] * (len(piece) + 1)
        for end, (token, length) in self.automaton.iter(piece):
            end += 1
            if last[end] < 0 and (end == length or self.compatible(last[end - length], token)):
                last[end] = token
        out, at = [], len(piece)
        while at:
            out.append(last[at])
            at -= len(self.bytes_of[last[at]])
        return out[::-1]

    def _packed(self, piece: str) -> bytes:
        got = self.cache.get(piece)
        if got is None:
            got = np.array(self.piece_ids(piece.encode().decode("latin-1")), dtype="<u4").tobytes()
            if len(piece) <= LONGEST_REMEMBERED:
                if len(self.cache) >= REMEMBERED:
                    self.cache.clear()
                self.cache[piece] = got
        return got

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if self.apart is not None and any(s in text for s in self.special):
            parts = self.apart.split(text)
            return b"".join(np.array([self.special[p]], dtype="<u4").tobytes() if i % 2
                            else b"".join(map(self._packed, pieces(p))) for i, p in enumerate(parts))
        return b"".join(map(self._packed, pieces(text)))

    def decode(self, ids) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


_CODECS: dict[str, Codec] = {}


def codec(content: bytes) -> Codec:
    """The codec of a file's content, built once a worker process."""
    key = hashlib.sha256(content).hexdigest()
    if key not in _CODECS:
        _CODECS[key] = Codec(content)
    return _CODECS[key]


def _shared(df: DataFrame, path: str):
    with open(path, "rb") as f:
        content = f.read(MAX_FILE + 1)
    if len(content) > MAX_FILE:
        raise ValueError(f"{path} has more than {MAX_FILE} bytes")
    return df.sparkSession.sparkContext.broadcast(content)


def _text(value: pa.Scalar) -> str:
    return (value.as_py() or b"").decode("utf-8", "replace")


def _lists(packed: list[bytes]) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(p) // 4 for p in packed])]).astype(np.int32)
    values = np.frombuffer(b"".join(packed), dtype="<u4").astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values))


def encode(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` with ``ids`` (array of int) and ``n_tokens``."""
    content = _shared(docs, path)

    def make():
        coder = codec(content.value)

        def work(texts: pa.Array) -> list[pa.Array]:
            packed = [coder.encode(_text(t)) for t in texts]
            return [_lists(packed), pa.array([len(p) // 4 for p in packed], pa.int64())]

        return work

    return add_columns(docs, text, "ids array<int>, n_tokens long", make)


def decode(encoded: DataFrame, path: str, ids: str = "ids", out: str = "text") -> DataFrame:
    """``encoded`` with the text of its ids; null ids give null.  Ids outside the vocabulary raise."""
    content = _shared(encoded, path)

    def run(batches):
        coder = codec(content.value)
        for batch in batches:
            last = batch.num_columns - 1
            texts = [None if v is None else coder.decode(v) for v in batch.column(last).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:last], pa.array(texts, pa.string())], [*batch.schema.names[:last], out])

    kept = [c for c in encoded.columns if c.lower() not in (ids.lower(), out.lower())]
    shaped = encoded.select(*(F.col(f"`{c}`") for c in kept), F.col(ids).alias(out))
    schema = shaped.withColumn(out, F.col(out).cast("string")).schema
    return shaped.mapInArrow(run, schema)


def report(docs: DataFrame, path: str) -> DataFrame:
    """Token count, digest of the ids and digest of the text decoded from them, a row per document."""
    content = _shared(docs, path)

    def make():
        coder = codec(content.value)

        def work(texts: pa.Array) -> list[pa.Array]:
            counts, ids, back = [], [], []
            for t in texts:
                packed = coder.encode(_text(t))
                text = coder.decode(np.frombuffer(packed, dtype="<u4").tolist())
                counts.append(len(packed) // 4)
                ids.append(hashlib.sha256(packed).hexdigest())
                back.append(hashlib.sha256(text.encode()).hexdigest())
            return [pa.array(counts, pa.int64()), pa.array(ids), pa.array(back)]

        return work

    return add_columns(docs.select("doc_id", "text"), "text",
                       "n_tokens long, ids_sha256 string, decoded_sha256 string", make, False)
