"""Per-block numeric helpers used by :func:`tidemark.operators.blocks.sweep`."""

from __future__ import annotations

import numpy as np

from tidemark.operators.blocks import Chunk, apart, matrix, rough


# pairs whose vectors are gathered at a time
GATHERED = 1 << 14
# different sets of a chunk up to which all of them are compared with the left ones beforehand
FEW_SETS = 128


def _column(table, name: str) -> np.ndarray:
    return table.column(name).to_numpy(zero_copy_only=False)


def _longs(table, name: str) -> np.ndarray:
    return _column(table, name).astype(np.int64)


def _doubles(table, name: str) -> np.ndarray:
    return _column(table, name).astype(np.float64)


def first_of(groups: np.ndarray, *keys: np.ndarray) -> np.ndarray:
    """Positions of the smallest row (by ``keys`` in order) of each group."""
    order = np.lexsort((*reversed(keys), groups))
    sorted_groups = groups[order]
    head = np.ones(len(order), dtype=bool)
    head[1:] = sorted_groups[1:] != sorted_groups[:-1]
    return order[head]


class _Last:
    """The last chunk, which all left rows of a task meet one after the other."""

    batch, vectors = None, None

    @classmethod
    def read(cls, batch) -> Chunk:
        if cls.batch is not batch:
            cls.batch, cls.vectors = batch, Chunk(matrix(batch.column("vec")))
        return cls.vectors


class Neighbours:
    """The ``keep`` nearest distinct vectors of each left row among those met, by (distance, id)."""

    def __init__(self, table, keep: int):
        self.k = keep
        self.ids, self.own = _longs(table, "id"), Chunk(matrix(table.column("vec")))
        self.weight = _longs(table, "weight")
        n = len(self.ids)
        self.dist = np.full((n, keep), np.inf)
        self.nbr = np.full((n, keep), -1, dtype=np.int64)
        self.wgt = np.zeros((n, keep), dtype=np.int64)

    def update(self, batch) -> None:
        ids, other, wgt = _longs(batch, "id"), _Last.read(batch), _longs(batch, "weight")
        near, lifted = rough(self.own, other)
        _, mine, theirs = np.intersect1d(self.ids, ids, assume_unique=True, return_indices=True)
        near[mine, theirs] = np.inf  # a row is not its own neighbour
        k = self.k
        near_by = near <= lifted(self.dist[:, -1] ** 2)[:, None]
        # of rows with more candidates than neighbours, those up to the k-th; so a group of rows close to one another
        # does not make every pair a candidate
        crowded = np.flatnonzero(np.count_nonzero(near_by, axis=1) > k)
        if len(crowded):
            part = near[crowded]
            near_by[crowded] &= part <= lifted(np.partition(part, k - 1, axis=1)[:, k - 1])[:, None]
        row, col = np.divmod(np.flatnonzero(near_by), len(ids))
        finite = np.isfinite(near[row, col])
        row, col = row[finite], col[finite]
        if not len(row):
            return
        d = apart(self.own.x, other.x, row, col)
        touched = np.unique(row)
        held_row, held_col = np.nonzero(np.isfinite(self.dist[touched]))
        held_row = touched[held_row]
        rows = np.concatenate([row, held_row])
        dist = np.concatenate([d, self.dist[held_row, held_col]])
        nbrs = np.concatenate([ids[col], self.nbr[held_row, held_col]])
        wgts = np.concatenate([wgt[col], self.wgt[held_row, held_col]])
        order = np.lexsort((nbrs, dist, rows))
        rows, dist, nbrs, wgts = rows[order], dist[order], nbrs[order], wgts[order]
        starts = np.searchsorted(rows, np.arange(len(self.ids)))
        place = np.arange(len(rows)) - starts[rows]
        keep = place < k
        self.dist[touched], self.nbr[touched], self.wgt[touched] = np.inf, -1, 0
        self.dist[rows[keep], place[keep]] = dist[keep]
        self.nbr[rows[keep], place[keep]] = nbrs[keep]
        self.wgt[rows[keep], place[keep]] = wgts[keep]

    def result(self):
        """id, copies of the row itself, and its neighbours' ids, distances and copies."""
        have = np.isfinite(self.dist)
        lists = [[m[i, have[i]] for i in range(len(self.ids))] for m in (self.nbr, self.dist, self.wgt)]
        return self.ids, self.weight, *lists


class _Best:
    """Lightest edge per left row so far, by (weight, a, b)."""

    def __init__(self, n: int):
        self.w = np.full(n, np.inf)
        self.a, self.b, self.other = (np.zeros(n, dtype=np.int64) for _ in range(3))

    def offer(self, row, w, a, b, other) -> None:
        pick = first_of(row, w, a, b)
        r, w, a, b, o = row[pick], w[pick], a[pick], b[pick], other[pick]
        better = (w < self.w[r]) | ((w == self.w[r]) & (
            (a < self.a[r]) | ((a == self.a[r]) & (b < self.b[r]))))
        r = r[better]
        self.w[r], self.a[r], self.b[r], self.other[r] = w[better], a[better], b[better], o[better]


class LightestExit:
    """Lightest mutual-reachability edge that leaves the component of a left row.

    Rows of component ``big`` never come as left rows; its way out is the lightest edge by which
    another component's row reaches it, so that is kept as well.  ``big=None``: no such component.
    """

    def __init__(self, table, big: int | None):
        self.big = big
        self.ids, self.own = _longs(table, "id"), Chunk(matrix(table.column("vec")))
        self.core, self.comp = _doubles(table, "core"), _longs(table, "comp")
        self.out, self.into = _Best(len(self.ids)), _Best(len(self.ids))

    @staticmethod
    def _limit(reach: np.ndarray, best: _Best, lifted) -> np.ndarray:
        return lifted(np.minimum(reach.min(1), best.w ** 2))[:, None]

    def update(self, batch) -> None:
        ids, other = _longs(batch, "id"), _Last.read(batch)
        core, comp = _doubles(batch, "core"), _longs(batch, "comp")
        reach, lifted = rough(self.own, other)  # squared weights; the picks below are recomputed exactly
        np.maximum(reach, (self.core * self.core).astype(reach.dtype)[:, None], out=reach)
        np.maximum(reach, (core * core).astype(reach.dtype)[None, :], out=reach)
        np.putmask(reach, self.comp[:, None] == comp[None, :], np.inf)
        to_big = np.zeros(len(ids), bool) if self.big is None else comp == self.big
        near = reach <= self._limit(reach, self.out, lifted)
        if to_big.any():
            part = reach[:, to_big]
            near[:, to_big] |= part <= self._limit(part, self.into, lifted)
        row, col = np.divmod(np.flatnonzero(near), len(ids))
        finite = np.isfinite(reach[row, col])
        row, col = row[finite], col[finite]
        if not len(row):
            return
        d = apart(self.own.x, other.x, row, col)
        w = np.maximum(d, np.maximum(self.core[row], core[col]))
        a, b = np.minimum(self.ids[row], ids[col]), np.maximum(self.ids[row], ids[col])
        self.out.offer(row, w, a, b, comp[col])
        at = to_big[col]
        if at.any():
            self.into.offer(row[at], w[at], a[at], b[at], comp[col][at])

    def result(self):
        """comp, w, a, b, other: one row a component present in the block, and one for ``big``."""
        parts = []
        for best, flip in ((self.out, False), (self.into, True)):
            out = np.flatnonzero(np.isfinite(best.w))
            if not len(out):
                continue
            comp, other = self.comp[out], best.other[out]
            if flip:
                comp, other = other, comp
            pick = first_of(comp, best.w[out], best.a[out], best.b[out])
            at = out[pick]
            parts.append((comp[pick], best.w[at], best.a[at], best.b[at], other[pick]))
        if not parts:
            return None
        return tuple(np.concatenate(c) for c in zip(*parts))


class NearestCentroid:
    """Nearest right row by cosine distance; equal distances go to the smaller id."""

    def __init__(self, table, max_dist: float):
        self.ids, self.x = _longs(table, "id"), matrix(table.column("vec"))
        self.norm = np.sqrt((self.x * self.x).sum(1))
        self.dist = np.full(len(self.ids), np.inf)
        self.best = np.zeros(len(self.ids), dtype=np.int64)
        self.max_dist = max_dist

    def update(self, batch) -> None:
        ids, y = _longs(batch, "id"), matrix(batch.column("vec"))
        norm = self.norm[:, None] * np.sqrt((y * y).sum(1))[None, :]
        with np.errstate(invalid="ignore", divide="ignore"):
            dist = 1.0 - (self.x @ y.T) / norm
        dist = np.where(norm > 0, dist, np.inf)
        order = np.argsort(ids, kind="stable")
        col = order[dist[:, order].argmin(1)]
        d, c = dist[np.arange(len(self.ids)), col], ids[col]
        better = (d < self.dist) | ((d == self.dist) & (c < self.best))
        self.dist = np.where(better, d, self.dist)
        self.best = np.where(better, c, self.best)

    def result(self):
        near = self.dist <= self.max_dist
        return self.ids[near], self.best[near], self.dist[near]


def holders(sets: list) -> dict:
    """For each word the places of the sets that hold it."""
    found: dict = {}
    for i, entry in enumerate(sets):
        for word in entry:
            found.setdefault(word, []).append(i)
    return {word: np.array(places) for word, places in found.items()}


def set_overlap(left: list, held: dict, right: list) -> np.ndarray:
    """Jaccard of every left set (``held``: their holders) with every right set: both empty 1, one empty 0.

    Only words that both sides hold cost anything; no table has a column a word.
    """
    both = np.zeros((len(left), len(right)))
    for j, entry in enumerate(right):
        for word in entry:
            if word in held:
                both[held[word], j] += 1.0
    na = np.array([len(s) for s in left], dtype=np.float64)[:, None]
    nb = np.array([len(s) for s in right], dtype=np.float64)[None, :]
    union = na + nb - both
    overlap = np.divide(both, union, out=np.zeros_like(both), where=union > 0)
    return np.where((na == 0) & (nb == 0), 1.0, overlap)


def _distinct(sets: list) -> tuple[list, np.ndarray]:
    """The different sets, and for each entry the place of its own."""
    found: dict = {}
    places = np.array([found.setdefault(frozenset(entry), len(found)) for entry in sets], dtype=np.int64)
    return list(found), places


class _Overlaps:
    """The sets of the left rows; equal sets are compared once."""

    def __init__(self, sets: list):
        self.sets, self.place = _distinct(sets)
        self.held = holders(self.sets)

    def table(self, other: list) -> np.ndarray:
        return set_overlap(self.sets, self.held, other)


class BestMatch:
    """Right row with the greatest composite score of at least ``floor``; the earliest stored row wins ties.

    The factors besides the topic add at most their weights.  So pairs are first told apart by a cosine in single
    precision, and only those that can still reach the row's best score, or ``floor``, are scored in full.
    """

    def __init__(self, table, weights: tuple[float, float, float, float], window_hours: float,
                 constant_time: bool, floor: float = 0.0):
        self.weights, self.window, self.constant, self.floor = weights, window_hours, constant_time, floor
        self.ids, self.x = _longs(table, "id"), matrix(table.column("vec"))
        self.norm, self.rough = self._directions(self.x)
        self.at = _doubles(table, "at")
        self.words = _Overlaps(table.column("keywords").to_pylist())
        self.feeds = _Overlaps(table.column("sources").to_pylist())
        n = len(self.ids)
        self.score = np.zeros(n)
        self.best = np.full(n, -1, dtype=np.int64)
        # error of a cosine of unit vectors in single precision
        self.tol = 1e-6 * (self.x.shape[1] + 16)

    @staticmethod
    def _directions(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lengths, and unit vectors in single precision; a zero vector has no direction and matches nothing."""
        norm = np.sqrt((x * x).sum(1))
        with np.errstate(invalid="ignore", divide="ignore"):
            return norm, (x / norm[:, None]).astype(np.float32)

    def _time(self, row: np.ndarray, at: np.ndarray) -> np.ndarray:
        if self.constant:
            return np.full(len(row), 0.5)
        time = np.maximum(0.0, 1.0 - np.abs(self.at[row] - at) / 3600.0 / self.window)
        return np.where(np.isnan(time), 0.5, time)

    def _latest(self, at: np.ndarray) -> np.ndarray:
        """Bound of the time factor of each left row with a chunk."""
        known, rows = at[~np.isnan(at)], np.arange(len(self.at))
        if self.constant or not len(known):
            return np.full(len(rows), 0.5)
        inside = np.clip(self.at, known.min(), known.max())
        return np.maximum(self._time(rows, inside), 0.5 if len(known) < len(at) else 0.0)

    #: the last chunk, which all left rows of a task meet one after the other, and what is read from it once
    _chunk: tuple = (None, None)

    @classmethod
    def _read(cls, batch) -> dict:
        if cls._chunk[0] is not batch:
            y = matrix(batch.column("vec"))
            cls._chunk = batch, {
                "ids": _longs(batch, "id"), "y": y, "at": _doubles(batch, "at"), "directions": cls._directions(y),
                "feeds": _distinct(batch.column("sources").to_pylist()),
                "words": _distinct(batch.column("keywords").to_pylist())}
        return cls._chunk[1]

    def update(self, batch) -> None:
        chunk = self._read(batch)
        ids, y, at, (norm, direction) = (chunk[k] for k in ("ids", "y", "at", "directions"))
        wt, wk, wd, ws = self.weights
        least = np.maximum(self.score, self.floor) - wt * self.tol
        tables, most = {}, {}
        for name, own in (("feeds", self.feeds), ("words", self.words)):
            # the table of different sets, and so a bound for each left row, at once if it is small
            few = len(chunk[name][0]) <= FEW_SETS
            tables[name] = own.table(chunk[name][0]) if few else None
            most[name] = tables[name].max(1)[own.place] if few else 1.0
        open_feeds, open_words = ws * most["feeds"], wk * most["words"]
        need = (least - (open_words + open_feeds + wd * self._latest(at))) / wt
        rough = self.rough @ direction.T
        with np.errstate(invalid="ignore"):
            row, col = np.divmod(np.flatnonzero(rough >= need.astype(np.float32)[:, None]), len(ids))

        def overlap(name: str, own: _Overlaps) -> np.ndarray:
            sets, place = chunk[name]
            if tables[name] is not None:
                return tables[name][own.place[row], place[col]]
            used, at_used = np.unique(place[col], return_inverse=True)
            return own.table([sets[i] for i in used])[own.place[row], at_used]

        # one factor after the other, each for the pairs that can still be the best of their row
        topic, known = rough[row, col] * wt, np.zeros(len(row))
        factors = []
        for weight, left, factor in (
                (wd, open_words + open_feeds, lambda: self._time(row, at[col])),
                (ws, open_words, lambda: overlap("feeds", self.feeds)),
                (wk, 0.0, lambda: overlap("words", self.words))):
            if not len(row):
                return
            factors.append(factor())
            known = known + factors[-1] * weight
            keep = topic + known >= (least - left)[row]
            row, col, topic, known = row[keep], col[keep], topic[keep], known[keep]
            factors = [f[keep] for f in factors]
        if not len(row):
            return
        time, feeds, words = factors
        topic = np.concatenate([
            np.einsum("ij,ij->i", self.x[row[i:i + GATHERED]], y[col[i:i + GATHERED]])
            for i in range(0, len(row), GATHERED)]) / (self.norm[row] * norm[col])
        score = topic * wt + words * wk + time * wd + feeds * ws
        pick = first_of(row, -score, ids[col])
        r, s, c = row[pick], score[pick], ids[col[pick]]
        better = (s > self.score[r]) | ((s == self.score[r]) & (self.best[r] >= 0) & (c < self.best[r]))
        self.score[r[better]], self.best[r[better]] = s[better], c[better]

    def result(self):
        found = self.best >= 0
        return self.ids[found], self.best[found], self.score[found]
