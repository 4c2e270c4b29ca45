"""Nearest examples against brute force, held-out accuracy, odd rows."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np

from tidemark.llm import toxicity


def rows(n=900):
    rng = random.Random(9)
    calm = [f"wort{i}" for i in range(80)] + ["été", "the"]
    bad = ["Fiend", "grobian", "vilain"]
    out, labels = [], []
    for i in range(n):
        words = [rng.choice(calm) for _ in range(rng.randint(3, 60))]
        toxic = rng.random() < 0.2
        if toxic:
            for _ in range(rng.randint(1, 3)):
                words.insert(rng.randrange(len(words)), rng.choice(bad) + rng.choice(["", "", "s", "!", "%%"]))
        out.append((i, " ".join(words), "x"))
        labels.append((i, 0, int(toxic)))
    out += [(n, None, "x"), (n + 1, "", "x"), (None, "Fiend fiend", "x"), (4, out[4][1], "x"), (n + 2, "!? ..." * 999, "x")]
    labels += [(4, 0, labels[4][2]), (n + 50, 0, 1), (None, 0, 1), (n, 0, None)]
    return out, labels


def frames(spark, n=900):
    docs, labels = rows(n)
    return (spark.createDataFrame(docs, "doc_id long, text string, score string").repartition(4),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_nearest_is_exact(spark):
    docs, labels = frames(spark)
    index = toxicity.fit(docs, labels)
    assert index.terms.count > 5 and len(index.ids) > 400
    texts = [(r.text or "").encode() for r in docs.collect()]
    dense = np.zeros((len(index.ids), index.terms.count))
    own = {r.doc_id: (r.text or "").encode() for r in docs.collect()}
    for i, (t, w) in enumerate(index.vectors([own[int(d)] for d in index.ids])):
        dense[i, t] = w
    for t, w in index.vectors(texts):
        query = np.zeros(index.terms.count)
        query[t] = w
        scores = np.round(dense @ query, 9)
        want = [n for n in np.lexsort((np.arange(len(scores)), -scores)) if scores[n] > 0]
        want = [n for n in want if scores[n] >= scores[want[:toxicity.NEAREST][-1]]]  # ties with the last one too
        numbers, similar = index.nearest(t, w, toxicity.NEAREST)
        assert numbers.tolist() == want
        np.testing.assert_allclose(similar, scores[want], atol=1e-8)
    assert (np.diff(index.values) >= 0).all() and (0 <= index.values).all() and (index.values <= 1).all()


def test_held_out_accuracy(spark):
    docs, labels = frames(spark)
    told = {r.doc_id: r.toxic for r in labels.collect()}
    got = toxicity.report(docs, labels).collect()
    assert len(got) == docs.count()
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    held = [r for r in got if r.held_out and told.get(r.doc_id) is not None]
    assert np.mean([r.predicted == told[r.doc_id] for r in held]) > 0.97
    assert next(r for r in got if r.doc_id is None).predicted == 1
    assert all(r.predicted == 0 for r in got if r.doc_id in (900, 901, 902))


def test_labels_of_the_fold_are_not_learned(spark):
    docs, labels = frames(spark, 300)
    turned = labels.selectExpr("doc_id", "quality", "if(crc32(cast(doc_id as string)) % 3 = 1, 1 - toxic, toxic) as toxic")
    key = lambda r: (str(r.doc_id), r.score)
    assert sorted(map(key, toxicity.report(docs, labels).collect())) == sorted(map(key, toxicity.report(docs, turned).collect()))


def test_without_examples(spark):
    docs, labels = frames(spark, 20)
    assert {r.score for r in toxicity.report(docs, labels.limit(0)).collect()} == {0.0}
    assert toxicity.report(docs.limit(0), labels).count() == 0
    one = toxicity.report(docs, labels.withColumn("toxic", labels.quality)).collect()
    assert {r.predicted for r in one} == {0}
    kept = toxicity.keep_clean(docs, labels.limit(0))
    assert kept.columns == docs.columns and kept.count() == docs.count()


def test_monotone_map():
    steps, values = toxicity.monotone(np.array([0.1, 0.2, 0.2, 0.5, 0.9]), np.array([0, 1, 0, 0, 1]))
    assert steps.tolist() == [0.1, 0.2, 0.5, 0.9] and values[1] == values[2] and (np.diff(values) >= 0).all()
    assert math.isclose(values[0], 0.4 / 2)


def test_every_feature_that_passes_is_kept(spark):
    rng = random.Random(12)
    bad = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(11)) for _ in range(120)]
    docs, labels = [], []
    for i in range(4000):
        toxic = i % 5 == 0
        text = [f"{rng.randrange(300)}" for _ in range(12)] + (rng.sample(bad, 4) if toxic else [])
        docs.append((i, " ".join(text)))
        labels.append((i, int(toxic)))
    index = toxicity.fit(spark.createDataFrame(docs, "doc_id long, text string"),
                         spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert index.terms.count > 600
    assert [w for w, (t, _) in zip(bad, index.vectors([w.encode() for w in bad])) if not len(t)] == []


def test_sample_places_are_documents(spark):
    docs, labels = frames(spark, 300)
    many = labels.select("doc_id", "toxic").union(spark.range(10_000, 30_000).selectExpr("id", "1"))
    index = toxicity.fit(docs.union(docs.filter("doc_id < 20")), many, 150)
    assert len(index.ids) == len(set(index.ids.tolist())) == 150


def test_blocks_are_left_out_and_nothing_is_missed():
    rng = np.random.default_rng(4)
    count, kinds = 6000, 300

    class Row:
        def __init__(self, i):
            topic = rng.integers(0, 30)
            self.doc_id, self.toxic = i, int(topic == 0)
            self.terms = sorted(set((10 * topic + rng.integers(0, 10, 4)).tolist()) | {int(rng.integers(0, kinds))})
            w = rng.random(len(self.terms)) + 0.2
            self.weights = (w / np.linalg.norm(w)).tolist()

    rows_ = [Row(i) for i in range(count)]
    index = toxicity._index(toxicity.terms_of([(i, 1) for i in range(kinds)]), np.ones(kinds), rows_)
    by_id = {r.doc_id: r for r in rows_}
    dense = np.zeros((count, kinds))
    for i, d in enumerate(index.ids.tolist()):
        dense[i, by_id[d].terms] = by_id[d].weights
    looked = of = 0
    for r in rows_[:200]:
        t, w = np.array(r.terms), np.array(r.weights)
        scored = []
        numbers, similar = index.nearest(t, w, 15, r.doc_id, scored)
        looked, of = looked + scored[0], of + scored[1]
        scores = np.round(dense[:, t] @ w, 9)
        scores[index.ids == r.doc_id] = 0
        kth = np.sort(scores)[-15]
        assert numbers.tolist() == [n for n in np.lexsort((np.arange(count), -scores)) if scores[n] >= max(kth, 1e-12)]
    assert looked < 0.6 * of


def test_whole_score_against_brute_force(spark):
    """Feature choice, weights, neighbours, votes and the monotone map, all worked out plainly from the texts."""
    docs, labels = frames(spark, 500)
    texts = {}
    for r in docs.collect():
        if r.doc_id is not None:
            texts[r.doc_id] = min(texts.get(r.doc_id, (r.text or "").encode()), (r.text or "").encode())
    told = {}
    for r in labels.collect():
        if r.doc_id in texts and r.toxic is not None and zlib.crc32(str(r.doc_id).encode()) % 3 != 1:
            told[r.doc_id] = max(told.get(r.doc_id, 0), r.toxic)

    def bag(text):
        found = Counter()
        for w in re.findall(rb"[0-9a-z\x80-\xff]+", (text or b"").lower()):
            found.update([("whole", w)] + [("start", w[:n]) for n in toxicity.BEGINNINGS if len(w) > n])
        return {(f, level): n if level == 1 else 1 for f, n in found.items() for level in (1, 2, 3, 5) if n >= level}

    bags = {i: bag(t) for i, t in texts.items()}
    total, positive = len(told), sum(told.values())
    n, toxic = Counter(), Counter()
    for i, y in told.items():
        n.update(bags[i].keys())
        toxic.update(bags[i].keys() if y else ())
    seen = [f for f in n if n[f] > 2]
    chance, kept = 2.0 * math.log(20.0 * max(2, len(seen))), []
    for f in seen:
        a, b = toxic[f], n[f] - toxic[f]
        c, d = positive - a, total - positive - b
        chi = total * (a * d - b * c) ** 2 / ((a + b) * (c + d) * positive * (total - positive)) if c + d else 0
        if chi > chance and a * d > b * c:
            kept.append(f)
    rows_ = [(r.doc_id, (r.text or "").encode()) for r in docs.collect()]
    everywhere = Counter(f for _, t in rows_ for f in bag(t) if f in set(kept))
    idf = {f: math.log((1 + len(rows_)) / (1 + everywhere[f])) + 1 for f in kept}

    def vector(b):
        v = {f: (1 + math.log(b[f])) * idf[f] for f in kept if f in b}
        size = math.sqrt(sum(x * x for x in v.values()))
        return {f: x / size for f, x in v.items()}

    examples = {i: vector(bags[i]) for i in told}

    def vote(v, but=None):
        near = sorted((round(sum(x * e.get(f, 0) for f, x in v.items()), 9), i) for i, e in examples.items() if i != but)[::-1]
        near = [(s, i) for s, i in near if s > 0]
        near = [(s, i) for s, i in near if s >= near[:toxicity.NEAREST][-1][0]]
        prior = toxicity.PRIOR_WEIGHT * positive / total
        return (sum(s * told[i] for s, i in near) + prior) / (sum(s for s, _ in near) + toxicity.PRIOR_WEIGHT)

    steps, values = toxicity.monotone(np.array([vote(examples[i], i) for i in told]), np.array([told[i] for i in told], dtype=float))
    got = sorted((str(r.doc_id), r.score) for r in toxicity.report(docs, labels).collect())
    want = sorted((str(i), float(np.interp(vote(vector(bag(t))), steps, values))) for i, t in rows_)
    assert [g[0] for g in got] == [w[0] for w in want]
    np.testing.assert_allclose([g[1] for g in got], [w[1] for w in want], atol=1e-6)
