"""Decontamination, archives and top-k against brute force on small rows with odd cases."""

import base64
import hashlib
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, topk, warc

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def contaminated(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        m = min(13, len(w))
        for i in range(len(w) - m + 1 if w else 0):
            windows.setdefault(tuple(w[i:i + m]), set()).add(item)
    for doc_id, text in docs:
        w = words(text)
        hit, ids = set(), set()
        for m in {len(x) for x in windows}:
            for i in range(len(w) - m + 1):
                for item in windows.get(tuple(w[i:i + m]), ()):
                    hit.update(range(i, i + m))
                    ids.add(item)
            for i in range(len(w) - m + 1):
                if tuple(w[i:i + m]) in windows:
                    hit.update(range(i, i + m))
        ids = sorted(str(x) for x in ids if x is not None)
        yield (doc_id, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(),
               bool(hit) and 20 * len(hit) >= len(w))


@pytest.mark.parametrize("shard_bytes", [decontaminate.SHARD_BYTES, 200])
def test_decontamination(spark, shard_bytes):
    rng = random.Random(5)
    letters = ["A", "b", "É", "é", "x9", "Z"]
    long = [" ".join(rng.choice(letters) for _ in range(n)) for n in (12, 13, 14, 30, 60)]
    items = [(i, t) for i, t in enumerate(long)] + [
        (20, None), (21, ""), (22, "..."), (23, "one Two"), (24, "solo"), (None, "nobody here"), (1, "again so")]
    docs = [(0, None), (1, ""), (None, long[3]), (2, "solo, solo! one-two"), (3, "ONE  two three"),
            (4, "x " * 500 + long[4].replace(" ", "-") + " y" * 500), (5, "nobody HERE again so"), (5, long[2]),
            (5, long[2]), (6, "x " * 3000), (7, "solo " + "q " * 19), (8, "solo " + "q " * 20)]
    docs += [(100 + i, " ".join(rng.choice(letters) for _ in range(80))) for i in range(20)]
    got = decontaminate.report(
        spark.createDataFrame([(*d, "extra", 7) for d in docs],
                              "doc_id long, text string, hits string, n_words int"),
        spark.createDataFrame(items, "item_id long, text string"), shard_bytes)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, contaminated(docs, items)))


@pytest.mark.parametrize("n, most", [(0, 9), (1, 9), (12, 1), (13, 1), (14, 1), (40, 1), (40, 30), (200, 64), (200, 10**6)])
def test_pieces_hold_each_window_once(n, most):
    found = [b"%d" % i for i in range(n)]
    cut = list(decontaminate.pieces(found, 13, most))
    size = min(13, n)
    windows = [tuple(piece[i:i + size]) for piece in cut for i in range(len(piece) - size + 1)]
    assert windows == [tuple(found[i:i + size]) for i in range(n - size + 1) if n]
    assert all(sum(map(len, piece)) + len(piece) < most + 13 * 4 for piece in cut)


def test_one_long_item_is_dealt_to_shards(spark, monkeypatch):
    """An item of many pieces, groups of two or three texts, more shards than pieces of the other items."""
    monkeypatch.setattr(decontaminate, "GROUP_BYTES", 3000)
    rng = random.Random(6)
    text = " ".join(str(rng.randrange(10**6)) for _ in range(20000))
    w = text.split(" ")
    items = [(1, text), (2, " ".join(w[50:70])), (2, text), (3, "nowhere")]
    docs = [(i, " ".join(["x"] * 30 + w[a:a + 13 + i] + ["y"] * i)) for i, a in enumerate(rng.sample(range(19000), 40))]
    docs += [(90, " ".join(w[4000:4012])), (91, " ".join(w[60:90])), (92, None), (93, "Nowhere")]
    got = decontaminate.report(spark.createDataFrame(docs, "doc_id long, text string").coalesce(2),
                               spark.createDataFrame(items, "item_id long, text string"), 40000)
    assert sorted(map(tuple, got.collect())) == sorted(contaminated(docs, items))


def test_decontamination_without_rows(spark):
    items = spark.createDataFrame([], "item_id long, text string")
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert decontaminate.report(docs, items).first().contaminated is False
    assert decontaminate.report(docs.limit(0), docs.withColumnRenamed("doc_id", "item_id")).count() == 0
    kept = decontaminate.clean(docs.withColumn("n_hit", F.lit("mine")), items)
    assert kept.columns == ["doc_id", "text", "n_hit"] and kept.first().n_hit == "mine"


def best(rows, k, divisor):
    ints = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    first = {}
    for i, v in ints:
        if i % divisor == 0:
            first[i] = min(first.get(i, v), v)
    for q, x in first.items():
        scored = sorted((-sum(a * b for a, b in zip(x, v)), i) for i, v in ints if i != q)
        for rank, (score, i) in enumerate(scored[:k], 1):
            yield q, rank, i, -score


@pytest.mark.parametrize("block", [3, 64, 4096])
def test_topk(spark, block):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(150)]
    rows += [(200 + i, [1.0, 0.0, 0.0, -1.0, 0.0, 0.0]) for i in range(40)]
    rows += [(300, None), (310, [None] * 6), (320, [float("nan")] * 6), (330, [float("inf")] * 6), (None, [1.0] * 6),
             (340, []), (350, [2.0]), (360, [0.0] * 6), (30, rows[31][1]), (31, rows[31][1]), (370, [1e12] * 6)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, score string")
    got = topk.search(df, F.col("vec_id") % 10 == 0, 5, block_rows=block, query_rows=7)
    assert sorted(map(tuple, got.collect())) == sorted(best(rows, 5, 10))


def test_topk_small_tables(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    assert list(map(tuple, topk.report(df).collect())) == [(0, 1, 1, 256 * 512)]
    assert topk.report(df.limit(0)).count() == 0
    assert topk.report(df.limit(1)).count() == 0


def test_archives(spark, tmp_path):
    rng = random.Random(1)
    long = "".join(rng.choice("aé\r\n \U0001F600") for _ in range(3000))
    rows = [(5, "u", "same"), (3, None, "same"), (9, "a b\r\nX: y", "same"), (1, "u", None), (2, "u", ""), (4, "u", long),
            (4, "u", long), (6, "u", long), (None, "u", "same"), (None, "u", "alone"), (7, "u", "\r\n\r\nWARC/1.1\r\n"),
            (8, "u", "WARC-Type: x\r\n\r\n" * 99), (-3, "u", "0\r\n\r\n")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, digest string")
    path = f"file://{tmp_path}/a"
    got = warc.report(df, path, segment_bytes=1000, file_records=4).collect()
    low = {}
    for i, _, h in rows:
        if i is not None:
            low[h or ""] = min(low.get(h or "", i), i)
    want = []
    for i, _, h in rows:
        first = low.get(h or "")
        again = first is not None and i != first
        data = (h or "").encode()
        want.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
                     "revisit" if again else "response", first if again else None))
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    records = warc.read_records(spark, path)
    assert records.filter("type = 'continuation'").count() > 5
    texts = {r.payload.decode() for r in warc.read_archives(spark, path).filter("complete and type='response'").collect()}
    assert texts == {h or "" for _, _, h in rows}
    least = warc.report(df, f"file://{tmp_path}/b", least_bytes=5).filter("refers_to is not null").collect()
    assert {r.refers_to for r in least} == {4}


def test_broken_archives(spark):
    good = dict(number=1, total=None, sound=True, block=warc._HTTP)
    last = dict(number=2, total=len(warc._HTTP) + 5, sound=True, block=b"0\r\n\r\n")
    assert warc.assembled([good, last]) == b""
    assert warc.assembled([good]) is None and warc.assembled([good, dict(last, number=3)]) is None
    assert warc.assembled([good, dict(last, total=1)]) is None
    assert warc.assembled([good, dict(last, sound=False)]) is None
    assert warc.assembled([dict(good, number=None)]) is None
    with pytest.raises(ValueError):
        list(warc.parse(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc"))
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.report(empty).count() == 0
