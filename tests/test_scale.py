"""What a task holds and how often rows travel, on hand-made rows."""

import hashlib
import math
import tracemalloc

import numpy as np
import pyarrow as pa

from tidemark.operators import annotate, blocks, clustering, embed
from tidemark.operators.kernels import BestMatch, LightestExit, Neighbours

MB = 1 << 20


def rows(x, first=0, **more):
    n = len(x)
    return pa.table({"id": np.arange(first, first + n), "vec": pa.array(list(x)),
                     "weight": np.ones(n, dtype=np.int64), **more}).combine_chunks().to_batches()[0]


def peak(run):
    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_close_group_that_comes_after_far_rows():
    """Every pair of the group is nearer than what the rows have found so far."""
    rng = np.random.default_rng(0)
    close, far = rng.normal(0, .01, (2048, 64)), rng.normal(0, 1, (30, 64))
    kernel = Neighbours(pa.Table.from_batches([rows(close[:1024])]), 15)
    kernel.update(rows(far, 5000))
    assert peak(lambda: kernel.update(rows(close[1024:], 1024))) < 200 * MB
    d = np.sqrt(((close[7] - close[1024:]) ** 2).sum(1))
    order = np.lexsort((np.arange(1024), d))[:15]
    assert kernel.nbr[7].tolist() == (order + 1024).tolist() and kernel.dist[7].tolist() == d[order].tolist()


def test_copies_of_rows_travel_a_bounded_number_of_times():
    """Ten times the blocks, the same number of groups, and every allowed pair of cells meets."""
    for many in (30, 300):
        lay = blocks.Layout(np.zeros((256, 64)), np.zeros(256), (many,) * 256, 256 * many * blocks.ROWS)
        met = blocks.meetings(lay, lay, np.ones((256, 256), dtype=bool))
        vectors = lay.rows / met.groups[0] * 64 * 8
        assert met.groups[1] <= blocks.RIGHT and (met.groups[0] <= blocks.LEFT or vectors > blocks.HELD / 2)
    own = blocks.meetings(lay, lay, np.eye(256, dtype=bool))
    assert own.groups[0] % 256 == 0 and own.groups[1] == 256  # a cell meets itself only


def test_best_match_scores_few_pairs_in_full():
    rng = np.random.default_rng(1)
    x, y = rng.normal(0, 1, (2048, 32)), rng.normal(0, 1, (2048, 32))
    x /= np.linalg.norm(x, axis=1)[:, None]
    y /= np.linalg.norm(y, axis=1)[:, None]
    y[5] = 0.0  # no direction

    def side(v, first):
        return rows(v, first, keywords=pa.array([[f"w{i % 7}", f"w{i % 5}"] for i in range(len(v))]),
                    sources=pa.array([["a", "b", "c"][:i % 4] for i in range(len(v))]),
                    at=np.arange(len(v)) * 3600.0)

    kernel = BestMatch(pa.Table.from_batches([side(x, 0)]), (.6, .2, .1, .1), 24.0, False, floor=.5)
    assert peak(lambda: kernel.update(side(y, 0))) < 200 * MB
    got = dict(zip(*kernel.result()[:2]))
    words = lambda i: {f"w{i % 7}", f"w{i % 5}"}
    feeds = lambda i: set(["a", "b", "c"][:i % 4])

    def jaccard(a, b):
        return 1.0 if not a and not b else len(a & b) / len(a | b)

    for i in range(0, 2048, 97):
        s = [.6 * (x[i] @ y[j]) + .2 * jaccard(words(i), words(j)) + .1 * max(0, 1 - abs(i - j) / 24)
             + .1 * jaccard(feeds(i), feeds(j)) if j != 5 else -1 for j in range(2048)]
        assert got.get(i) == (int(np.argmax(s)) if max(s) >= .5 else None)


def plan(df):
    return df._jdf.queryExecution().toString()


def test_sparse_vectors_split_texts_once(spark):
    """Equal ids are one text, a row without id counts in the frequencies only, words may be none."""
    texts = [("a", "x y x"), ("b", "Y"), ("a", "z"), (None, "x y"), ("c", "!!")]
    got = embed.sparse(spark.createDataFrame(texts, "content_id string, embed_text string"), dims=1 << 20)
    assert "split(" not in plan(got)
    at = lambda w: int(hashlib.md5(w.encode()).hexdigest()[:12], 16) % (1 << 20)
    held = {"x": 2, "y": 3, "z": 1}  # ids, none being one of them
    want = {}
    for name, words in (("a", {"x": 2, "y": 1, "z": 1}), ("b", {"y": 1})):
        w = {t: n * (math.log(6 / (held[t] + 1)) + 1) for t, n in words.items()}
        length = math.sqrt(sum(v * v for v in w.values()))
        want |= {(name, at(t)): round(v / length, 9) for t, v in w.items()}
    assert {(r[0], r[1]): round(r[2], 9) for r in got.collect()} == want


def test_frequent_pairs_are_few_before_all_places_meet_them(spark):
    """All pairs are too many to send round, the frequent ones are not: places must not be shuffled to meet them."""
    rng = np.random.default_rng(3)
    rows = [([f"w{i}" for i in rng.integers(0, 10**6, 12)] + ["big", "red", "bus"],) for _ in range(2000)]
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "50000")
    try:
        got = annotate.top_phrases(spark.createDataFrame(rows, "words array<string>").coalesce(2), 2)
        assert "BroadcastHashJoin" in plan(got) and "SortMergeJoin" not in plan(got)
        assert [tuple(r) for r in got.collect()] == [("big red bus", 2000), ("big red", 2000)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_rounds_of_the_selection_send_no_table_to_the_driver(spark, monkeypatch):
    plans, cut = [], clustering.cut
    monkeypatch.setattr(clustering, "cut", lambda df: plans.append(plan(df)) or cut(df))
    rows = [(i, i // 2 or None, float(i * 7 % 5)) for i in range(1, 40)]
    got = clustering.select(spark.createDataFrame(rows, "cluster long, parent long, stability double"))
    assert got.count() == 39 and plans and not any("BroadcastHashJoin" in p for p in plans)


def test_candidates_in_single_precision_give_exact_results():
    """Rows far from the origin and close to one another, where single precision tells little; and rows too long for it."""
    rng = np.random.default_rng(7)
    for shift, scale in ((0.0, 1.0), (50.0, 1e-3), (1e-15, 1e-16), (1e25, 1e24)):
        x = shift + scale * rng.normal(size=(90, 12))
        d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
        np.fill_diagonal(d, np.inf)
        near = Neighbours(rows(x), 6)
        comp, core = np.arange(90) % 3, np.full(90, 0.5 * scale)
        out = LightestExit(rows(x, comp=comp, core=core), None)
        for i in range(0, 90, 40):
            near.update(rows(x[i:i + 40], i))
            out.update(rows(x[i:i + 40], i, comp=comp[i:i + 40], core=core[i:i + 40]))
        order = np.argsort(d, axis=1, kind="stable")[:, :6]
        assert near.nbr.tolist() == order.tolist()
        assert near.dist.tolist() == np.take_along_axis(d, order, 1).tolist()
        w = np.where(comp[:, None] == comp[None], np.inf, np.maximum(d, 0.5 * scale))
        comps, lightest = out.result()[:2]
        assert dict(zip(comps.tolist(), lightest.tolist())) == {c: w[comp == c].min() for c in range(3)}


def test_every_meeting_of_a_sweep_has_a_task(spark):
    class Where:
        """Which task met which rows."""

        def __init__(self, table):
            self.ids = table.column("id").to_numpy()

        def update(self, batch):
            pass

        def result(self):
            from pyspark import TaskContext

            return self.ids, np.full(len(self.ids), TaskContext.get().partitionId())

    x = np.random.default_rng(1).normal(size=(600, 3))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, vec array<double>")
    placed, layout = blocks.lay_out(df, "id", "vec", 40)
    met = blocks.meetings(layout, layout, np.ones((layout.cells, layout.cells), dtype=bool))
    got = blocks.sweep(placed, placed, met, ["id", "vec"], Where, "id long, part long").cache()
    tasks = met.groups[0] * met.groups[1]
    assert tasks > 30 and got.select("part").distinct().count() == tasks
    assert got.count() == 600 * met.groups[1]


def test_texts_are_split_once_for_dense_vectors(spark):
    df = spark.createDataFrame([(1, "a b a"), (2, "b c"), (3, "")], "id long, embed_text string")
    got = embed.embed(df)
    assert "split(" not in plan(got)
    assert [round(math.dist(r.embedding, [0.0] * 256), 9) for r in got.orderBy("id").collect()] == [1.0, 1.0, 0.0]


def test_small_links_are_followed_in_one_step(spark, monkeypatch):
    """As rounds of joins do it, which larger tables still take."""
    n = 300
    tree = [("c0", "gone", 3.0)] + [(f"c{i}", f"c{(i - 1) // (1 + i % 2)}", float(i * 7 % 11) + 400 * (i == 3)) for i in range(1, n)]
    clusters = spark.createDataFrame(tree + [("alone", None, 1.0), ("unsure", "c5", None)], "cluster string, parent string, stability double")
    # components in a row, each of which picks the next; the last two pick one another
    chain = [(i, i, i + 1, i + 1) for i in range(n - 1)] + [(n - 1, n - 2, n - 1, n - 2)]
    picks = spark.createDataFrame(chain, "comp long, a long, b long, other long")
    cuts, cut = [], clustering.cut
    monkeypatch.setattr(clustering, "cut", lambda df: cuts.append(1) or cut(df))

    def both():
        cuts.clear()
        return (sorted(map(tuple, clustering.select(clusters).collect())),
                sorted(map(tuple, clustering._roots(picks, n).collect())), len(cuts))

    chosen, roots, steps = both()
    assert steps == 2 and roots == [(i, n - 2) for i in range(n)]
    monkeypatch.setattr(clustering, "ONE_TASK", 0)
    assert both()[:2] == (chosen, roots) and len(cuts) > 10
    repeated = clusters.union(clusters.limit(1))  # a name that comes twice is left to the joins
    monkeypatch.setattr(clustering, "ONE_TASK", 1 << 18)
    cuts.clear()
    clustering.select(repeated)
    assert len(cuts) > 2
