"""Ranks along a line of cells: who stands above whom."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np


def chains(line: Sequence[tuple[int, float]]) -> list[tuple[int, ...]]:
    """For each cell (place, rank) of a line in order, the places of its ancestors, nearest first.

    A cell's parent is the nearest earlier one of a smaller rank; the ancestors are what a stack of rising ranks still holds.
    """
    out: list[tuple[int, ...]] = []
    open_cells: list[tuple[int, float]] = []
    for place, rank in line:
        while open_cells and open_cells[-1][1] >= rank:
            open_cells.pop()
        out.append(tuple(p for p, _ in reversed(open_cells)))
        open_cells.append((place, rank))
    return out


def chains_of_many(first: np.ndarray, rank: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """chains() of many lines that follow each other: for each step up the cells that have an ancestor there, and which it is.

    first: whether a cell is the first of its line. All between a cell and what may be its parent have no smaller rank than the
    cell, so a parent that has none itself gives way to what may be its own.
    """
    parent = np.where(first, -1, np.arange(len(rank)) - 1)
    live = np.flatnonzero(parent >= 0)
    while len(live):
        live = live[rank[parent[live]] >= rank[live]]
        parent[live] = parent[parent[live]]
        live = live[parent[live] >= 0]
    cell = np.flatnonzero(parent >= 0)
    above = parent[cell]
    while len(cell):
        yield cell, above
        above = parent[above]
        cell, above = cell[above >= 0], above[above >= 0]
