"""The language model against a plain one."""

import math
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import lm, words


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + ["<end>"]


class Plain:
    def __init__(self, texts):
        self.count, self.pair, self.ctx = Counter(), Counter(), Counter()
        for t in texts:
            seq = ["<start>", *tokens(t)]
            self.count.update(seq[1:])
            self.pair.update(zip(seq, seq[1:]))
            self.ctx.update(seq[:-1])
        self.n, self.v = sum(self.count.values()), len(self.count)
        self.before = Counter(b for _, b in self.pair)
        self.after = defaultdict(Counter)
        for (a, _), c in self.pair.items():
            self.after[a][min(c, 3)] += 1
        of = lambda values: lm.discounts(*(sum(x == i for x in values) for i in range(1, 5)))
        self.d, self.e = of(self.pair.values()), of(self.before.values())

    def base(self, text):
        return sum(math.log10((self.count[w] + 0.1) / (self.n + 0.1 * (self.v + 1))) for w in tokens(text))

    def p(self, a, b):
        low = 1.0 / (self.v + 1)
        if self.pair:
            rest = sum(self.e[min(x, 3)] for x in self.before.values()) / len(self.pair)
            low = rest * low + max(self.before[b] - self.e[min(self.before[b], 3)], 0) / len(self.pair)
        if not self.ctx[a]:
            return low
        c = self.pair[a, b]
        kept = sum(self.d[i] * self.after[a][i] for i in (1, 2, 3)) / self.ctx[a]
        return max(c - self.d[min(c, 3)], 0) / self.ctx[a] + kept * low

    def score(self, text):
        seq = ["<start>", *tokens(text)]
        return sum(math.log10(self.p(a, b)) for a, b in zip(seq, seq[1:]))


def rows():
    rng = random.Random(8)
    pool = ["The", "the", "of", "été", "x", "y", "z", "Über", "a\x1cb", "，"] + [f"w{i}" for i in range(60)]
    texts = [" ".join(pool[int(rng.paretovariate(0.6)) % len(pool)] for _ in range(rng.randint(0, 90))) for _ in range(150)]
    texts += [None, "", " \n\t", "new words only here", texts[0], "the " * 400, "x\r\ny\vz"]
    return [(i, t, "x") for i, t in enumerate(texts)] + [(None, "the null id", "x"), (3, texts[3], "x")]


@pytest.mark.parametrize("shard_text", [200, lm.SHARD_TEXT])
@pytest.mark.parametrize("frequent", [5, lm.FREQUENT])
def test_scores(spark, shard_text, frequent):
    data = rows()
    df = spark.createDataFrame(data, "doc_id long, text string, score string").repartition(5)
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i, _, _ in data if i is not None} | {None: False}
    plain = Plain([t for i, t, _ in data if not held[i]])
    learn = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 10 != 0, F.lit(True))
    model = lm.train(df, learn, shard_text=shard_text, frequent=frequent)
    assert (model.tokens, model.distinct, model.pairs) == (plain.n, plain.v, len(plain.pair))
    np.testing.assert_allclose(model.discounts, plain.d)
    np.testing.assert_allclose(model.word_discounts, plain.e)
    got = lm.score(df, model, frequent=frequent).select("doc_id", "text", "n_tokens", "n_known", "base_score", "score").collect()
    assert len(got) == len(data)
    for r in got:
        assert r.n_tokens == len(tokens(r.text))
        assert r.n_known == sum(plain.count[w] > 0 for w in tokens(r.text))
        assert math.isclose(r.base_score, plain.base(r.text), rel_tol=1e-9)
        assert math.isclose(r.score, plain.score(r.text), rel_tol=1e-9), r
    total = sum(plain.p("the", b) for b in plain.count) + plain.p("the", "<unknown>")
    assert math.isclose(total, 1.0)


def test_report(spark):
    data = rows()
    df = spark.createDataFrame(data, "doc_id long, text string, perplexity string")
    got = lm.report(df).collect()
    held = [r for r in got if r.held_out]
    assert held and all(zlib.crc32(str(r.doc_id).encode()) % 10 == 0 for r in held)
    assert lm.report(df.limit(0)).count() == 0
    alone = lm.report(df.filter("doc_id is not null and crc32(cast(doc_id as string)) % 10 = 0")).collect()
    assert alone and all(r.train_tokens == 0 and r.n_known == 0 and r.score == r.base_score == 0 for r in alone)


def thue(flip, n=1024):
    """Two such words have equal polynomial hashes modulo 2^64, whatever the base."""
    return "".join("ab"[(bin(i).count("1") + flip) % 2] for i in range(n))


def test_word_hashes():
    texts = [b"", None, "a bb été".encode(), b"x" * 5000 + b" y", b" bb  ", b"\x00 \xff\xfe a", f"{thue(0)} {thue(1)}".encode()]
    rows_, hashes = words.words(texts)
    flat = [(i, w) for i, t in enumerate(texts) for w in (t or b"").split()]
    assert rows_.tolist() == [i for i, _ in flat]
    rows2, first, second = words.wide_words(texts)
    assert rows2.tolist() == rows_.tolist()
    for found in (hashes, first, second):
        seen = {}
        assert all(seen.setdefault(w, h) == h for (_, w), h in zip(flat, found)) and len(set(found)) == len(seen)
    _, alone = words.words([b"x" * 5000])
    assert alone[0] == hashes[flat.index((3, b"x" * 5000))]


def test_words_of_equal_polynomials_are_two_words(spark):
    df = spark.createDataFrame([(1, thue(0)), (2, thue(1)), (4, thue(0))], "doc_id long, text string")
    model = lm.train(df.filter("doc_id < 4"), F.lit(True))
    assert (model.tokens, model.distinct) == (4, 3)
    got = {r.doc_id: r for r in lm.score(df, model).collect()}
    assert got[4].score == got[1].score and all(r.n_known == 2 for r in got.values())


def test_counts_beyond_32_bits():
    keys = np.array([3, 9, 2**63 + 5], dtype=np.uint64)
    sums = [np.array([1, 2**32 + 7, 2**50]), np.array([0, 1, 2])]
    for some in (sums, [np.array([1, 2, 3])], []):
        back, held = lm._unpack(lm._pack(keys, some), 3)
        assert back.tolist() == keys.tolist() and [h.tolist() for h in held] == [s.tolist() for s in some]


def test_frequent_word_beyond_32_bits_scores(spark, tmp_path):
    """Arrays on disk hold such counts too."""
    folder = str(tmp_path / "model")
    keys = np.sort(words.words([b"often rare"])[1])
    often = words.words([b"often"])[1][0]
    for name, value in (("word", keys), ("count", np.where(keys == often, 2**32 + 7, 3).astype("<u8")),
                        *((n, np.ones(2, dtype="<u4")) for n in ("once", "twice", "more", "before")),
                        ("pair", np.zeros(0, "<u8")), ("pairs", np.zeros(0, "<u8"))):
        lm._store(folder, f"{name}-0", value)
    model = lm.Model(folder, 1, np.array([0, 2]), 2**32 + 10, 2)
    got = lm.score(spark.createDataFrame([(1, "often")], "doc_id long, text string"), model).first()
    n, v = 2**32 + 10, 2
    assert math.isclose(got.base_score, math.log10((2**32 + 7.1) / (n + 0.1 * (v + 1))) + math.log10(0.1 / (n + 0.1 * (v + 1))))


def test_files_do_not_grow_with_the_shards(spark):
    """A look-up visits every file of an array, so only what is merged at a time follows the size of the texts."""
    rng = random.Random(4)
    texts = [" ".join(f"w{int(rng.paretovariate(0.4)) % 900}" for _ in range(40)) for _ in range(120)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    plain = Plain(texts)
    model = lm.train(df, F.lit(True), shard_text=40, frequent=20)
    words_ = [name for name in os.listdir(model.folder.removeprefix("file:")) if name.startswith("word-")]
    assert sum(map(len, texts)) / 40 > 4 * lm.FILES and len(words_) <= lm.FILES
    assert (model.tokens, model.distinct, model.pairs) == (plain.n, plain.v, len(plain.pair))
    for r in lm.score(df, model).collect():
        assert math.isclose(r.score, plain.score(r.text), rel_tol=1e-9), r
