"""Dropping copies: one document of each component of fingerprints stays, against brute force over all pairs."""

import random

import pytest

from tidemark.llm import simhash
from tests.llm.test_text import plain_groups, plain_print

POOL = [f"wort{i}" for i in range(900)]


def edited(rng, text, share):
    words = text.split()
    for i in rng.sample(range(len(words)), max(1, round(share * len(words)))):
        words[i] = rng.choice(POOL)
    return " ".join(words)


def plain(docs):
    """The (id, text) rows that stay: all pairs are compared, links make components, the smallest (id, digest) stays."""
    import hashlib

    prints = {t: plain_print(t, 3) for _, t in docs}
    nodes = sorted({prints[t] for i, t in docs if i is not None})
    near = [(a, b) for a in nodes for b in nodes if a < b and (a ^ b).bit_count() <= simhash.RADIUS]
    root = plain_groups(nodes, near)
    least, first = {}, {}
    for i, t in docs:
        if i is not None:
            r, digest = root[prints[t]], hashlib.sha256((t or "").encode()).digest()
            least[r] = min(i, least.get(r, i))
            at = (prints[t], i)
            first[at] = min(digest, first.get(at, digest))
    return [(i, t) for i, t in docs if i is None or (
        least[root[prints[t]]] == i and first[prints[t], i] == hashlib.sha256((t or "").encode()).digest())]


def words(rng, n):
    return " ".join(rng.choice(POOL) for _ in range(n))


@pytest.fixture(scope="module")
def docs():
    rng = random.Random(3)
    out = []
    for g in range(12):
        base = words(rng, 250)
        out += [(100 * g + i, edited(rng, base, 0.004)) for i in range(9)]
        out += [(100 * g + 50, base), (100 * g + 60, base), (100 * g + 61, out[-1][1])]
        chain = words(rng, 400)
        for i in range(70, 80):
            out.append((100 * g + i, chain))
            chain = edited(rng, chain, 0.004)
    return out + [(5000, words(rng, 40)), (5000, words(rng, 40)), (5000, out[0][1]), (None, out[0][1]), (5001, None), (5002, ""),
                  (5003, " \n"), (0, out[0][1]), (5004, "zwei worte"), (5005, "Zwei  Worte"), (5004, "Zwei worte"),
                  # one id in two components: neither drags the other along
                  (3000, out[12][1] + " x"), (3000, words(rng, 90)), (3001, "lone text of its own")]


def test_one_of_each_component_stays(spark, docs):
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = [tuple(r) for r in simhash.keep_first(frame).collect()]
    want = plain(docs)
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    assert len(want) < len(docs) / 2
    assert simhash.keep_first(frame.limit(0)).count() == 0


def test_columns_of_any_name_come_through(spark, docs):
    names = ["id", "digest", "_digest", "row", "fp", "component_id", "body", "_source", "first"]
    frame = spark.createDataFrame([(*d, *range(len(names))) for d in docs],
                                  "doc_id long, text string, " + ", ".join(f"`{n}` int" for n in names))
    got = simhash.keep_first(frame)
    assert got.columns == frame.columns
    rows = got.collect()
    assert len(rows) == len(plain(docs)) and all(tuple(r)[2:] == tuple(range(len(names))) for r in rows)
