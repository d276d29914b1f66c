"""Average-linkage clustering of a page's items."""

from __future__ import annotations

import numpy as np


def linkage(points: np.ndarray, y_only: bool = False) -> list[tuple[int, int, float]]:
    """Pairs of clusters joined, in order of their distance; new clusters count on from the number of points.

    Nearest neighbours are followed until two are each other's, which joins them: average linkage never brings clusters
    closer, so the pairs are those of always joining the closest, in square time and space.
    """
    n = len(points)
    if n < 2:
        return []
    p = points[:, 1:2] if y_only else points
    d = np.sqrt(((p[:, None, :] - p[None, :, :]) ** 2).sum(-1)).astype(float)
    np.fill_diagonal(d, np.inf)
    size, alive = np.ones(n), np.ones(n, dtype=bool)
    chain: list[int] = []
    joined: list[tuple[float, int, int]] = []
    while len(joined) < n - 1:
        if not chain:
            chain = [int(np.flatnonzero(alive)[0])]
        last = chain[-1]
        near = int(np.argmin(d[last]))
        if len(chain) > 1 and d[last, chain[-2]] <= d[last, near]:
            near = chain[-2]
        if len(chain) < 2 or near != chain[-2]:
            chain.append(near)
            continue
        chain = chain[:-2]
        i, j = min(last, near), max(last, near)
        joined.append((float(d[i, j]), i, j))
        d[i] = (d[i] * size[i] + d[j] * size[j]) / (size[i] + size[j])
        d[:, i] = d[i]
        d[i, i] = np.inf
        d[j] = d[:, j] = np.inf
        size[i] += size[j]
        alive[j] = False
    # in order of distance, each cluster has the name of the last join of its members
    name = list(range(n))
    out = []
    for k, (dist, i, j) in enumerate(sorted(joined)):
        a, b = _root(name, i), _root(name, j)
        out.append((min(a, b), max(a, b), dist))
        name.append(n + k)
        name[a] = name[b] = n + k
    return out


def _root(name: list[int], i: int) -> int:
    while name[i] != i:
        i = name[i]
    return i


class Tree:
    """The clusters of a linkage: node k has its leaves, its text and its children."""

    def __init__(self, texts: list[str], steps: list[tuple[int, int, float]]) -> None:
        self.leaves: list[list[int]] = [[k] for k in range(len(texts))]
        self.texts, self.children, self.distance = list(texts), [None] * len(texts), [0.0] * len(texts)
        for a, b, dist in steps:
            self.leaves.append(self.leaves[a] + self.leaves[b])
            self.texts.append(f"{self.texts[a]} {self.texts[b]}")
            self.children.append((a, b))
            self.distance.append(dist)

    def count(self, node: int) -> int:
        return len(self.leaves[node])
