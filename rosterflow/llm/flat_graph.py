"""A flat neighbour graph of unit vectors: robust pruning, and range search from a medoid."""

from __future__ import annotations

import numpy as np


def build_graph(v: np.ndarray, degree: int = 20, near: int = 40, far: int = 12, alpha: float = 1.2) -> list[np.ndarray]:
    """Neighbours of each row of ``v``.

    Candidates of a row are its nearest rows and some spread over all, which keep the graph
    navigable. The nearest one is taken, then those go that it is closer to than the row is, by the factor ``alpha``,
    and so on up to ``degree``. Each edge also gets its reverse.
    """
    n = len(v)
    if n < 2:
        return [np.zeros(0, dtype=np.int64)] * n
    similar = v @ v.T
    random = np.random.default_rng(n)
    spread = random.integers(0, n, (n, far))
    near = min(near, n - 1)
    picked: list[list[int]] = [[] for _ in range(n)]
    order = similar.copy()
    np.fill_diagonal(order, -np.inf)
    closest = np.argpartition(-order, near - 1, axis=1)[:, :near]
    distance = np.sqrt(np.maximum(0.0, 2 - 2 * similar))
    for p in range(n):
        candidates = np.unique(np.concatenate([closest[p], spread[p]]))
        candidates = candidates[candidates != p]
        own = distance[p, candidates]
        turn = np.lexsort((candidates, own))
        candidates, own = candidates[turn], own[turn]
        while len(candidates) and len(picked[p]) < degree:
            best = candidates[0]
            picked[p].append(int(best))
            stay = alpha * distance[best, candidates] > own
            stay[0] = False
            candidates, own = candidates[stay], own[stay]
    both: list[set[int]] = [set(row) for row in picked]
    for p, row in enumerate(picked):
        for q in row:
            both[q].add(p)
    return [np.array(sorted(row), dtype=np.int64) for row in both]


def medoid(v: np.ndarray) -> int:
    """The row nearest to the mean of all."""
    return int(np.argmax(v @ v.mean(axis=0)))


def range_search(v: np.ndarray, graph: list[np.ndarray], start: int, query: np.ndarray, least: float, beam: int = 24) -> np.ndarray:
    """Rows found with a similarity of ``least`` or more.

    A greedy search from ``start`` keeps the ``beam`` most similar rows and opens them in turn; then the range is filled by
    opening every row in it, level by level, until no neighbour of theirs is new.
    """
    seen = np.zeros(len(v), dtype=bool)
    seen[start] = True
    rows, scores = np.array([start]), v[[start]] @ query
    opened = np.zeros(1, dtype=bool)
    while not opened.all():
        # The few best that are not open yet are opened together.
        todo = np.flatnonzero(~opened)[:4]
        opened[todo] = True
        new = np.unique(np.concatenate([graph[r] for r in rows[todo]]))
        new = new[~seen[new]]
        if not len(new):
            continue
        seen[new] = True
        rows, scores = np.concatenate([rows, new]), np.concatenate([scores, v[new] @ query])
        opened = np.concatenate([opened, np.zeros(len(new), dtype=bool)])
        keep = np.argsort(-scores, kind="stable")[:beam]
        rows, scores, opened = rows[keep], scores[keep], opened[keep]
    frontier = rows[scores >= least]
    inside = np.zeros(len(v), dtype=bool)
    inside[frontier] = True
    met = inside.copy()
    while len(frontier):
        new = np.unique(np.concatenate([graph[r] for r in frontier]))
        new = new[~met[new]]
        met[new] = True
        frontier = new[v[new] @ query >= least]
        inside[frontier] = True
    return np.flatnonzero(inside)
