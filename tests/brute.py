"""Naive single-machine versions to test against, on small inputs only."""

from __future__ import annotations

import numpy as np


def core_distances(x: np.ndarray, k: int) -> np.ndarray:
    d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(2))
    d.sort(axis=1)
    return d[:, min(k, len(x) - 1)]


def spanning_tree(x: np.ndarray, core: np.ndarray) -> list[tuple[float, int, int]]:
    n = len(x)
    d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(2))
    reach = np.maximum(d, np.maximum(core[:, None], core[None, :]))
    edges = sorted((reach[i, j], i, j) for i in range(n) for j in range(i + 1, n))
    parent = list(range(n))

    def find(v):
        while parent[v] != v:
            parent[v] = parent[parent[v]]
            v = parent[v]
        return v

    out = []
    for w, i, j in edges:
        ri, rj = find(i), find(j)
        if ri != rj:
            parent[ri] = rj
            out.append((w, i, j))
    return out


def density_labels(x: np.ndarray, k: int, size: int, least: float = 1e-12):
    """Sets of member positions per selected cluster."""
    n = len(x)
    core = core_distances(x, k)
    tree = spanning_tree(x, core)
    node = {i: i for i in range(n)}
    members = {i: [i] for i in range(n)}
    kids, weight = {}, {}
    parent = list(range(n))

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    nxt = n
    for w, i, j in tree:
        ri, rj = find(i), find(j)
        a, b = node[ri], node[rj]
        kids[nxt], weight[nxt] = (a, b), w
        members[nxt] = members[a] + members[b]
        parent[ri] = rj
        node[rj] = nxt
        nxt += 1
    root = nxt - 1
    clusters = {0: {"birth": 0.0, "stab": 0.0, "kids": [], "pts": list(members[root])}}
    todo = [(root, 0)]
    while todo:
        at, c = todo.pop()
        if at < n:
            continue
        lam = 1.0 / max(weight[at], least)
        a, b = kids[at]
        na, nb = len(members[a]), len(members[b])
        info = clusters[c]
        if na >= size and nb >= size:
            info["stab"] += (na + nb) * (lam - info["birth"])
            for side in (a, b):
                cid = len(clusters)
                clusters[cid] = {"birth": lam, "stab": 0.0, "kids": [], "pts": list(members[side])}
                info["kids"].append(cid)
                todo.append((side, cid))
        else:
            for side, m in ((a, na), (b, nb)):
                if m >= size:
                    todo.append((side, c))
                else:
                    info["stab"] += m * (lam - info["birth"])
    pick = {}
    value = {}
    for c in sorted(clusters, reverse=True):
        sub = sum(value[k2] for k2 in clusters[c]["kids"])
        if c == 0:
            continue
        pick[c] = clusters[c]["stab"] >= sub
        value[c] = max(clusters[c]["stab"], sub)
    out, todo = [], list(clusters[0]["kids"])
    while todo:
        c = todo.pop()
        if pick[c]:
            out.append(frozenset(clusters[c]["pts"]))
        else:
            todo += clusters[c]["kids"]
    return set(out)
