"""Toxic texts by their nearest labelled examples.

Features of a text are its words and the beginnings of its words, and that one of them stands there at least
two, three or five times.  ``fit`` takes a bounded sample of the
labelled rows, keeps the features that tell the labels apart (chi-squared beyond what chance gives for that many
features), and weighs them by TF-IDF with document frequencies over all documents.  The examples' vectors stand
in a block-max inverted index: examples are put in the order of their heaviest features and cut into blocks, a feature's
postings are cut at the same places, and each piece knows its greatest weight.

``score`` finds the exact nearest examples by cosine.  A block's bound is the sum of its pieces' greatest weights times the text's
own; blocks are scored from the highest bound on, and the first bound below the k-th similarity ends the search.
All examples that tie with the k-th vote.  The votes, weighted by similarity, are turned into a probability by a monotone
map that was fitted to the examples' votes without themselves, and returned with the first k examples as evidence.

A null or empty text has no feature and gets the rate of such examples.  Labels that are null or name no
document teach nothing; several labels of one document count as toxic if any is.  Without any label scores
are 0.  Rows without an id are scored and teach nothing.  Repeated rows and extra columns come through.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.base import add_columns, cut, slices
from tidemark.llm.words import PLAIN, beginnings, encoded, joined, lane, spans

#: Bound of what is learned: labelled documents that are examples.  It bounds the features that pass, too.
SAMPLE_ROWS = 20_000
#: Lengths in bytes of the word beginnings that are features.
BEGINNINGS = (4, 5, 6, 7, 8, 9, 10)
#: How often a feature must occur to count as the feature of that level too.
LEVELS = np.array([1, 2, 3, 5])
NEAREST, PRIOR_WEIGHT = 15, 0.5
#: Examples of a block; what is added to bounds against rounding.
BLOCK, BOUND_SLACK = 64, 1e-8
THRESHOLD = 0.7


def features(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of every feature occurrence; A-Z are lowered."""
    data, text_ends = joined(texts, True)
    starts, ends = spans(data, PLAIN)
    rows = np.searchsorted(text_ends, starts, side="right")
    # each different word is hashed once, its beginnings where it stands first
    place, different = encoded(data, starts, ends)
    first = np.zeros(len(different), dtype=np.int64)
    first[place[::-1]] = np.arange(len(place))[::-1]
    at, length = starts[first], (ends - starts)[first]
    all_rows, all_keys = [rows], [lane(different)[place]]
    for n in BEGINNINGS:
        able = length > n
        keys = np.zeros(len(different), dtype=np.uint64)
        keys[able] = beginnings(data, at[able], n)
        mine = able[place]
        all_rows.append(rows[mine])
        all_keys.append(keys[place[mine]])
    return np.concatenate(all_rows), np.concatenate(all_keys)


class Terms(NamedTuple):
    """The features kept: sorted hashes, and for each the number of its term at each level, or -1."""

    bases: np.ndarray
    numbers: np.ndarray
    count: int

    def held(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, term number, occurrences) by row then term; terms beyond level one occur once."""
        rows, keys = features(texts)
        if not len(self.bases) or not len(keys):
            return (np.zeros(0, dtype=np.int64),) * 3
        at = np.searchsorted(self.bases, keys).clip(max=len(self.bases) - 1)
        known = self.bases[at] == keys
        pairs, seen = np.unique(rows[known] * len(self.bases) + at[known], return_counts=True)
        pick, level = np.nonzero(seen[:, None] >= LEVELS[None, :])
        rows, numbers = pairs[pick] // len(self.bases), self.numbers[pairs[pick] % len(self.bases), level]
        count = np.where(level == 0, seen[pick], 1)
        kept = numbers >= 0
        order = np.lexsort((numbers[kept], rows[kept]))
        return rows[kept][order], numbers[kept][order], count[kept][order]


def terms_of(picked: list[tuple[int, int]]) -> Terms:
    """Terms from (hash as signed long, level) pairs."""
    bases = np.unique(np.array([t for t, _ in picked], dtype=np.int64).view(np.uint64))
    numbers = np.full((len(bases), len(LEVELS)), -1, dtype=np.int64)
    for i, (t, level) in enumerate(sorted(picked)):
        at = np.searchsorted(bases, np.array([t], dtype=np.int64).view(np.uint64))[0]
        numbers[at, int(np.flatnonzero(LEVELS == level)[0])] = i
    return Terms(bases, numbers, len(picked))


class Index(NamedTuple):
    """Examples, and the postings of each feature."""

    terms: Terms
    idf: np.ndarray
    ids: np.ndarray        # document of each example
    toxic: np.ndarray      # its label
    pieces: np.ndarray     # of feature t: pieces[t] to pieces[t + 1]
    block: np.ndarray      # block of each piece
    most: np.ndarray       # its greatest weight
    begins: np.ndarray     # its first posting; the next piece's ends it
    members: np.ndarray    # example of each posting
    weights: np.ndarray
    prior: float
    steps: np.ndarray      # the monotone map: knots and their values
    values: np.ndarray

    def vectors(self, texts: list[bytes | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Feature numbers and unit weights of each text."""
        rows, terms, count = self.terms.held(texts)
        weights = (1.0 + np.log(count)) * self.idf[terms]
        ends = np.searchsorted(rows, np.arange(len(texts) + 1))
        out = []
        for a, b in zip(ends, ends[1:]):
            w = weights[a:b]
            out.append((terms[a:b], w / math.sqrt(float(w @ w)) if b > a else w))
        return out

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int, but: int | None = None,
                scored: list[int] | None = None):
        """Numbers and similarities of the ``k`` nearest examples and of all that tie with the last of them.

        By similarity, then number; ``scored`` gets how many blocks of how many were looked into.
        """
        count = self.pieces[terms + 1] - self.pieces[terms]
        if not count.sum():
            return np.zeros(0, dtype=np.int64), np.zeros(0)
        piece = np.repeat(self.pieces[terms] - np.cumsum(count) + count, count) + np.arange(count.sum())
        weight = np.repeat(weights, count)
        block = self.block[piece]
        bound = np.bincount(block, weight * self.most[piece])
        turn = np.argsort(-bound, kind="stable")[:np.count_nonzero(bound)]  # the highest bound first
        bound = bound[turn] + BOUND_SLACK
        place = np.full(int(block.max()) + 1, -1)
        found, near, kth, at, step = [], [], 0.0, 0, 4
        while at < len(turn) and bound[at] >= kth:
            to = min(at + step, int(np.searchsorted(-bound, -kth, side="right")))
            chosen = turn[at:to]
            place[chosen] = np.arange(len(chosen))
            mine = np.flatnonzero(place[block] >= 0)
            size = self.begins[piece[mine] + 1] - self.begins[piece[mine]]
            posting = np.repeat(self.begins[piece[mine]] - np.cumsum(size) + size, size) + np.arange(size.sum())
            local = np.repeat(place[block[mine]] * BLOCK, size) + self.members[posting] % BLOCK
            similar = np.bincount(local, np.repeat(weight[mine], size) * self.weights[posting], len(chosen) * BLOCK)
            hit = np.flatnonzero(similar)
            found.append(chosen[hit // BLOCK] * BLOCK + hit % BLOCK)
            near.append(np.round(similar[hit], 9))
            place[chosen] = -1
            if but is not None:
                near[-1][self.ids[found[-1]] == but] = 0
            together = np.concatenate(near)
            if np.count_nonzero(together) >= k:
                kth = float(np.partition(together, len(together) - k)[len(together) - k])
            at, step = to, 2 * step
        if scored is not None:
            scored[:] = [at, len(turn)]
        numbers, similar = np.concatenate(found), np.concatenate(near)
        kept = (similar > 0) & (similar >= kth)
        numbers, similar = numbers[kept], similar[kept]
        best = np.lexsort((numbers, -similar))
        return numbers[best], similar[best]

    def vote(self, numbers: np.ndarray, similarities: np.ndarray) -> float:
        held = float(similarities @ self.toxic[numbers]) if len(numbers) else 0.0
        return (held + PRIOR_WEIGHT * self.prior) / (float(similarities.sum()) + PRIOR_WEIGHT)

    def probability(self, vote: float) -> float:
        if not len(self.steps):
            return 0.0
        return float(np.interp(vote, self.steps, self.values))


def monotone(votes: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The non-decreasing map from votes to label rates that fits best (pooled neighbours), as knots.

    A pool has one rate, shrunk by one example of the overall rate, so none is exactly 0 or 1.  Between
    pools the map is linear.
    """
    overall = float(labels.mean()) if len(labels) else 0.0
    pools: list[list[float]] = []  # first vote, last vote, toxic examples, examples
    distinct, inverse = np.unique(np.round(votes, 6), return_inverse=True)
    toxic, total = np.bincount(inverse, labels), np.bincount(inverse)
    for v, t, n in zip(distinct, toxic, total):
        pools.append([v, v, t, n])
        while len(pools) > 1 and pools[-2][2] * pools[-1][3] >= pools[-1][2] * pools[-2][3]:
            _, last, t2, n2 = pools.pop()
            pools[-1][1:] = [last, pools[-1][2] + t2, pools[-1][3] + n2]
    knots, values = [], []
    for first, last, t, n in pools:
        for v in {first: 0, last: 0}:
            knots.append(v)
            values.append((t + overall) / (n + 1))
    return np.array(knots), np.maximum.accumulate(values) if values else np.zeros(0)


def _sums(df: DataFrame, text: str, label: str | None, terms: Terms | None) -> DataFrame:
    """Documents that hold each term (by label), summed a batch and then by Spark.

    Without ``terms`` every feature counts, a row a level; else ``term`` is the term's number.
    """

    def run(batches):
        for batch in (part for whole in batches for part in slices(whole, 0)):
            texts = batch.column(0).to_pylist()
            if terms is None:
                rows, keys = features(texts)
                order = np.lexsort((keys, rows))
                rows, keys = rows[order], keys[order]
                first = np.flatnonzero(np.concatenate([
                    np.ones(min(1, len(rows)), dtype=bool), (rows[1:] != rows[:-1]) | (keys[1:] != keys[:-1])]))
                seen = np.diff(np.append(first, len(rows)))
                pick, at = np.nonzero(seen[:, None] >= LEVELS[None, :])
                rows, keys, levels = rows[first][pick], keys[first][pick].view(np.int64), LEVELS[at]
            else:
                rows, keys, _ = terms.held(texts)
                levels = np.zeros(len(rows), dtype=np.int64)
            toxic = np.asarray(batch.column(1), dtype=np.int64)[rows]
            order = np.lexsort((levels, keys))
            keys, levels, toxic = keys[order], levels[order], toxic[order]
            first = np.flatnonzero(np.concatenate([
                np.ones(min(1, len(keys)), dtype=bool), (keys[1:] != keys[:-1]) | (levels[1:] != levels[:-1])]))
            n = np.diff(np.append(first, len(keys)))
            sums = np.add.reduceat(toxic, first) if len(first) else toxic
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[first], pa.int64()), pa.array(levels[first], pa.int32()),
                 pa.array(n, pa.int64()), pa.array(sums, pa.int64())], ["term", "level", "n", "toxic"])

    told = F.col(label) if label else F.lit(0)
    picked = df.select(F.col(text).cast("binary").alias("text"), told.cast("int").alias("toxic"))
    return (picked.mapInArrow(run, "term long, level int, n long, toxic long")
            .groupBy("term", "level").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic")))


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Index:
    """The index of a bounded sample of the labelled documents whose crc32(doc_id) mod 3 is not 1.

    Of rows that share an id the least text is the example.
    """
    spark = docs.sparkSession
    key = F.col("doc_id").cast("string")
    told = (labels.filter(F.col("toxic").isNotNull() & (F.crc32(key) % 3 != 1))
            .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("_toxic"))
            .join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows))
    # at most sample_rows pairs of numbers
    sample = cut(docs.select("doc_id", F.col("text").cast("binary").alias("_text"))
                 .join(F.broadcast(told), "doc_id")
                 .groupBy("doc_id").agg(F.min("_text").alias("_text"), F.first("_toxic").alias("_toxic")))
    total, positive = sample.agg(F.count("*"), F.sum("_toxic")).first()
    positive = int(positive or 0)
    terms = terms_of([])
    if 0 < positive < total:
        seen = cut(_sums(sample, "_text", "_toxic", None).filter("n > 2"))
        a, b = F.col("toxic").cast("double"), (F.col("n") - F.col("toxic")).cast("double")
        c, d = positive - a, (total - positive) - b
        chi = F.try_divide(total * F.pow(a * d - b * c, 2), (a + b) * (c + d) * positive * (total - positive))
        chance = 2.0 * math.log(20.0 * max(2, seen.count()))
        best = (seen.withColumn("chi", chi).filter((F.col("chi") > chance) & (a * d > b * c))
                .orderBy(F.desc("chi"), "term", "level").select("term", "level").collect())
        terms = terms_of([(r.term, r.level) for r in best])
    documents = docs.count() if terms.count else 0
    everywhere = np.zeros(terms.count)
    if terms.count:
        for r in _sums(docs, "text", None, terms).collect():  # a row a term
            everywhere[r.term] = r.n
    idf = np.log((1.0 + documents) / (1.0 + everywhere)) + 1.0
    bare = Index(terms, idf, *(np.zeros(0),) * 8, 0.0, np.zeros(0), np.zeros(0))
    shared = spark.sparkContext.broadcast(bare)

    def vectors(batches):
        for batch in (part for whole in batches for part in slices(whole, 0)):
            made = shared.value.vectors(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array([t.tolist() for t, _ in made], pa.list_(pa.int32())),
                 pa.array([w.tolist() for _, w in made], pa.list_(pa.float64()))],
                ["doc_id", "toxic", "terms", "weights"])

    rows = sample.select("_text", F.col("doc_id").cast("long").alias("doc_id"),
                         F.col("_toxic").alias("toxic")).mapInArrow(
        vectors, "doc_id long, toxic int, terms array<int>, weights array<double>").collect()
    index = _index(terms, idf, rows)
    steps, values = np.zeros(0), np.zeros(0)
    if len(rows):
        votes = _own_votes(sample, spark.sparkContext.broadcast(index))
        steps, values = monotone(np.array([votes[i] for i in index.ids.tolist()]), index.toxic)
    return index._replace(steps=steps, values=values)


def _own_votes(sample: DataFrame, shared) -> dict[int, float]:
    """The vote of each example without itself, a number an example."""
    def run(batches):
        for batch in batches:
            for part in slices(batch, 0):
                ids = part.column(1).to_pylist()
                votes = [shared.value.vote(*shared.value.nearest(t, w, NEAREST, i)) for i, (t, w) in zip(
                    ids, shared.value.vectors(part.column(0).to_pylist()))]
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(votes, pa.float64())], ["id", "vote"])

    asked = sample.select("_text", F.col("doc_id").cast("long").alias("doc_id"))
    return {r.id: r.vote for r in asked.mapInArrow(run, "id long, vote double").collect()}


def _index(terms: Terms, idf: np.ndarray, rows: list) -> Index:
    # examples with the same heaviest feature stand together, so that a block has few features with large weights
    rows = sorted(rows, key=lambda r: (min(((-w, t) for t, w in zip(r.terms, r.weights)), default=(0.0, -1))[::-1], r.doc_id))
    count = np.array([len(r.terms) for r in rows], dtype=np.int64)
    member = np.repeat(np.arange(len(rows)), count)
    term = np.array([t for r in rows for t in r.terms], dtype=np.int64)
    weight = np.array([w for r in rows for w in r.weights], dtype=np.float64)
    order = np.lexsort((member, term))
    member, term, weight = member[order], term[order], weight[order]
    block = member // BLOCK
    first = np.ones(len(term), dtype=bool)
    first[1:] = (term[1:] != term[:-1]) | (block[1:] != block[:-1])
    at = np.flatnonzero(first)
    toxic = np.array([r.toxic for r in rows], dtype=np.float64)
    return Index(terms, idf, np.array([r.doc_id for r in rows], dtype=np.int64), toxic,
                 np.searchsorted(term[at], np.arange(terms.count + 1)), block[at],
                 np.maximum.reduceat(weight, at) if len(at) else weight, np.append(at, len(term)), member, weight,
                 float(toxic.mean()) if len(rows) else 0.0, np.zeros(0), np.zeros(0))


def score(docs: DataFrame, index: Index, text: str = "text", keep_text: bool = True) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``evidence`` (the nearest examples)."""
    shared = docs.sparkSession.sparkContext.broadcast(index)
    near = pa.list_(pa.struct([("doc_id", pa.int64()), ("similarity", pa.float64()), ("toxic", pa.int32())]))

    def make():
        held = shared.value

        def work(texts: pa.Array) -> list[pa.Array]:
            scores, evidence = [], []
            for terms, weights in held.vectors(texts.to_pylist()):
                numbers, similar = held.nearest(terms, weights, NEAREST)
                scores.append(held.probability(held.vote(numbers, similar)))
                evidence.append([{"doc_id": int(held.ids[n]), "similarity": float(s), "toxic": int(held.toxic[n])}
                                 for n, s in zip(numbers[:NEAREST], similar)])
            return [pa.array(scores, pa.float64()), pa.array(evidence, near)]

        return work

    return add_columns(docs, text, "score double, "
                       "evidence array<struct<doc_id:long,similarity:double,toxic:int>>", make, keep_text)


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    found = score(docs.select("doc_id", "text"), fit(docs, labels), "text", False)
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    return found.select("doc_id", held.alias("held_out"), "score",
                        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` below the threshold, with their own columns."""
    index = fit(docs, labels)
    own = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_own"),
                      F.col("text").alias("_text"))
    return score(own, index, "_text", False).filter(F.col("score") < THRESHOLD).select("_own.*")
