"""Places of rows against a plain permutation, whatever the partitions."""

import hashlib
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.llm import shards

ROWS = [(None, None, "x"), (None, "", "y"), (3, "twin", "a"), (3, "twin", "a"), (3, "other", "b"), (-5, "é" * 9, None)]


def table(spark, rows, parts=3):
    return spark.createDataFrame(rows, "doc_id long, text string, shard string").repartition(parts)


def numbered(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, hashlib.sha256((r[1] or "").encode()).hexdigest()))


@pytest.mark.parametrize("n", [0, 1, 2, 5, 23, 24, 25, 300])
def test_places(spark, n):
    rows = [(i // 2, f"text {i % 7}", "z") for i in range(n)] if n != 5 else ROWS[:5]
    got = shards.report(table(spark, rows)).collect()
    want = []
    for number, (i, text, _) in enumerate(numbered(rows)):
        raw = (text or "").encode()
        want.append((i, len(raw) + 8, zlib.crc32(raw), "rows", *shards.place(number, n), None, number))
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    counts = Counter(r.shard for r in got)
    assert not n or max(counts.values()) - min(counts.get(s, 0) for s in range(24)) <= 1
    for s in counts:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(counts[s]))


def test_permutation_is_one_to_one_and_not_in_order():
    for n in (1, 2, 3, 10, 257, 1000):
        for rounds in (1, 3, 8):
            at = sorted(slot * 7 + shard for shard, slot in (shards.place(i, n, 7, "k", rounds) for i in range(n)))
            assert at == list(range(n))
    images = [shards.place(i, 1000, 1)[1] for i in range(1000)]
    assert sum(abs(a - b) == 1 for a, b in zip(images, images[1:])) < 20
    assert images != [shards.place(i, 1000, 1, "another key")[1] for i in range(1000)]


def test_walks_are_enough_and_agree_with_the_plain_walk(spark):
    for n in (2, 17, 50, 101, 600):
        passes = shards.walks(spark, n, rounds=3)
        rows = spark.range(n).select("id", shards.permuted(F.col("id"), n, passes, rounds=3).alias("at")).collect()
        assert all(divmod(r["at"], 24)[::-1] == shards.place(r["id"], n, rounds=3) for r in rows)


def test_whole_rows_keep_their_columns_whatever_the_partitions(spark):
    rows = ROWS + [(i, f"t{i}", "kept") for i in range(40)]
    many = {}
    for parts in (1, 5):
        df = shards.assign(table(spark, rows, parts), shards=4)
        assert df.columns == ["doc_id", "text", "row_number", "shard", "slot"]
        many[parts] = sorted(map(repr, df.collect()))
    assert many[1] == many[5]
    assert shards.assign(table(spark, rows).limit(0)).count() == 0


def test_written_shards_are_in_order_of_slots(spark, tmp_path):
    df = shards.assign(table(spark, [(i, "a" * (i % 5), "") for i in range(100)]), shards=3)
    shards.write(df, str(tmp_path / "out"))
    for s in range(3):
        back = spark.read.parquet(str(tmp_path / "out" / f"shard={s}"))
        assert sorted(r.slot for r in back.collect()) == list(range(back.count()))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 100


def test_main_path_is_native(spark):
    plan = shards.report(table(spark, ROWS))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
