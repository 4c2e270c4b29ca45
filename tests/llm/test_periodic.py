"""Runs against brute force over all starts and periods; the contract's digests."""

import hashlib
import re
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import periodic


def plain_runs(w):
    out = []
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            part = w[i:j + q]
            if len(part) >= max(6, 4 * q) and not any(
                    all(part[k] == part[k + r] for k in range(len(part) - r)) for r in range(1, q)):
                out.append((i, len(part), q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def worked(texts):
    n_words, runs, collapsed = periodic._worked(pa.array([None if t is None else t.encode() for t in texts], pa.binary()))
    return n_words.to_pylist(), [[tuple(r.values()) for r in x] for x in runs.to_pylist()], collapsed.to_pylist()


def expect(text):
    w = words_of(text)
    runs = plain_runs(w)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return len(w), runs, " ".join(x for i, x in enumerate(w) if i not in gone)


piece = st.lists(st.sampled_from("abc"), min_size=1, max_size=9)
text = st.lists(st.tuples(piece, st.integers(1, 7)), max_size=5).map(
    lambda parts: " ".join(x for p, times in parts for x in p * times))


@settings(max_examples=150, deadline=None)
@given(st.lists(text, min_size=1, max_size=4))
def test_all_runs(texts):
    assert list(zip(*worked(texts), strict=True)) == [expect(t) for t in texts]


@pytest.mark.parametrize("period", [1, 2, 3, 4, 5, 7, 10, 11, 20, 21, 22, 42, 43, 64, 85, 86])
@pytest.mark.parametrize("lead", [0, 1, 13])
def test_shortest_run_of_each_scale(period, lead):
    w = [f"x{i}" for i in range(lead)] + [f"p{i % period}" for i in range(max(6, 4 * period))] + ["end"]
    short = w[:-2]
    _, runs, _ = worked([" ".join(w), " ".join(short)])
    assert runs == [[(lead, max(6, 4 * period), period)], []]


def test_long_text_and_one_word_many_times():
    unit = " ".join(f"w{i}" for i in range(3000))
    n, runs, kept = worked([" ".join([unit] * 5), "a " * 50_000, "b" * 100_000 + " c"])
    assert (n, runs) == ([15000, 50000, 2], [[(0, 15000, 3000)], [(0, 50000, 1)], []])
    assert kept == [unit, "a", "b" * 100_000 + " c"]


def test_sums_are_exact_beyond_one_modulus():
    big = periodic.PRIMES[0][0]
    side = int(big ** 0.5)
    x = np.array([[side + 3, 5]])
    y = np.array([[3, 5, side + 3, 5, 0]])
    assert periodic.zero_shifts(x, y, 4).tolist() == [[False, False, True, False]]
    # 2013265921 = a sum of two squares, zero modulo the first prime only
    a = next(i for i in range(1, side) if round((big - i * i) ** 0.5) ** 2 == big - i * i)
    b = round((big - a * a) ** 0.5)
    assert periodic.zero_shifts(np.array([[a, b]]), np.array([[0, 0, a, b]]), 3).tolist() == [[False, False, True]]


def test_words_are_told_apart_by_their_bytes():
    def thue(flip):
        return "".join("ab"[(bin(i).count("1") + flip) % 2] for i in range(1024))
    assert worked([" ".join([thue(0), thue(1)] * 3)])[1] == [[]]
    assert worked([" ".join([thue(0), thue(1)] * 4)])[1] == [[(0, 8, 2)]]


def test_report(spark):
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 40, n)) for n in rng.integers(0, 300, 200)]
    texts += [None, "", " \t\n", "a a a a a a", "Ä ö " * 9, "x y " * 400 + "z", "t\x85u\t" * 8]
    rows = [(i, t, 1, "c") for i, t in enumerate(texts)] + [(None, "q " * 8, 1, "c"), (4, "r r r r r r s", 1, "c"), (4, "r r r r r r s", 1, "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, runs int, best string").repartition(4)

    def want(i, t):
        w = words_of(t)
        h = zlib.crc32(str(i).encode()) if i is not None else 1
        if h % 10 == 0 and w:
            n, g = len(w), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
        _, runs, kept = expect(" ".join(w))
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        return (i, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
                hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())

    got = periodic.report(df).collect()
    expected = [want(i, t) for i, t, *_ in rows]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, expected))
    assert sum(r[1] > 0 for r in expected) > 15
    assert periodic.report(df.limit(0)).count() == 0
    found = periodic.find(df)
    assert found.columns == ["doc_id", "text", "best", "n_words", "runs", "collapsed"]  # its own replace old ones
