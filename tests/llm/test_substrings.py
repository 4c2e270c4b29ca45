"""Repeated passages against brute force; anchors depend on windows alone."""

import hashlib
import random
import re

import numpy as np

from tidemark.llm import substrings
from tidemark.llm.words import mix

W = 50


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain(rows):
    first = {}
    for i, t in rows:
        w = words(t)
        for a in range(len(w) - W + 1):
            if i is not None:
                k = tuple(w[a:a + W])
                first[k] = min(first.get(k, i), i)
    for i, t in rows:
        w = words(t)
        gone = set()
        for a in range(len(w) - W + 1):
            if i is not None and first[tuple(w[a:a + W])] < i:
                gone.update(range(a, a + W))
        kept = " ".join(x for p, x in enumerate(w) if p not in gone)
        yield i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()


def rows():
    rng = random.Random(11)
    pool = [f"w{i}" for i in range(40)] + ["é", "A", "a", "x\x1cy"]
    text = lambda n: [rng.choice(pool) for _ in range(n)]
    passage, line = text(70), text(9)
    out = [text(n) for n in (0, 1, 49, 50, 51, 120, 300)]
    out += [text(30) + passage + text(20), passage, text(5) + passage[:49] + text(60), text(60) + passage[10:60],
            passage[5:] + passage[:60], ["same"] * 200, ["same"] * 70, text(3) + ["same"] * 49 + text(20), ["same"] * 50,
            ["ab", "cd"] * 60, ["cd", "ab"] * 40, text(4) + ["ab", "cd"] * 26 + text(4), line * 12, text(5) + line * 7 + text(8),
            line[3:] + line * 5, out[6], out[6], out[6][:200] + text(30), out[6][1:], list(out[5]), out[3]]
    for _ in range(12):
        near = list(out[6])
        near[rng.randrange(len(near))] = "changed"
        out.append(near)
    order = list(range(len(out)))
    rng.shuffle(order)
    data = [(100 - i, rng.choice([" ", "\n", " \t "]).join(out[i])) for i in order]
    return data + [(None, " ".join(out[6])), (None, None), (300, None), (301, " \n "), (302, " ".join(out[6])),
                   (302, " ".join(out[6])), (302, " ".join(passage)), (5, " ".join(text(60) + passage))]


def test_passages(spark):
    data = rows()
    df = spark.createDataFrame([(*r, "x") for r in data], "doc_id long, text string, kept string").repartition(6)
    got = [tuple(r) for r in substrings.report(df).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, plain(data)))


def test_parts_cover_each_window_once():
    rows_ = np.repeat([0, 1, 2], [700, 40, 300])
    rng = np.random.default_rng(1)
    hashes = mix(rng.integers(0, 9, len(rows_)).astype(np.uint64))
    starts, keys = substrings.anchors(rows_, hashes)
    names = substrings.window_names((hashes, mix(hashes + np.uint64(1))), starts)
    old, substrings.AT_ONCE = substrings.AT_ONCE, 100
    try:
        met = []
        for part in substrings._parts(rows_, W):
            a, k = substrings.anchors(rows_[part], hashes[part])
            met += list(zip((a + part.start).tolist(), k.tolist()))
    finally:
        substrings.AT_ONCE = old
    assert met == list(zip(starts.tolist(), keys.tolist()))
    by_window = {}
    for a, k, x, y in zip(starts, keys, *names):
        same = by_window.setdefault(tuple(hashes[a:a + W].tolist()), (k, x, y))
        assert same == (k, x, y)


def test_anchor_ignores_what_stands_around():
    rng = np.random.default_rng(2)
    for kind in (3, 8, 1000):
        window = mix(rng.integers(0, kind, W).astype(np.uint64))
        found = set()
        for _ in range(60):
            around = [mix(rng.integers(0, kind, rng.integers(0, 30)).astype(np.uint64)) for _ in range(2)]
            text = np.concatenate([around[0], window, around[1]])
            starts, keys = substrings.anchors(np.zeros(len(text), dtype=np.int64), text)
            found.add(int(keys[np.flatnonzero(starts == len(around[0]))[0]]))
        assert len(found) == 1


def test_no_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert substrings.report(empty).count() == 0


def test_words_of_equal_polynomials_are_different_words(spark):
    thue = ["".join("ab"[(bin(i).count("1") + flip) % 2] for i in range(1024)) for flip in (0, 1)]
    same = [f"w{i}" for i in range(49)]
    data = [(1, " ".join([*same, thue[0]])), (2, " ".join([*same, thue[1]])), (3, " ".join([*same, thue[0]]))]
    got = {r.doc_id: r.n_removed for r in substrings.report(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    assert got == {1: 0, 2: 0, 3: 50}
