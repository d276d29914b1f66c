"""The hierarchy of a table's cells as a relation: every ancestor above a cell in its column and beside it in its row."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..layout.hierarchy import chains_of_many
from .groups import many_groups

UP, LEFT_OF = "up", "left"
ANCESTORS = "row int, col int, side string, step int, ancestor_row int, ancestor_col int"


def cell_ancestors(cells: DataFrame, keys: list[str]) -> DataFrame:
    """(*keys, row, col, side, step, ancestor_row, ancestor_col) of cells (*keys, row, col, up_rank, left_rank).

    A cell's parent upwards is the nearest cell above it in its column with a smaller up_rank, its parent to the left the
    nearest one in its row with a smaller left_rank; step counts the parents that lead to an ancestor, from 1. Cells of a null
    rank are none, of several at one place the lowest ranks count. An empty table gives none.
    """
    types = ", ".join(f"{k} {cells.schema[k].dataType.simpleString()}" for k in keys)
    own = cells.where("row is not null and col is not null").select(*keys, *[F.col(c).cast(t).alias(c) for c, t in (("row", "int"), ("col", "int"), ("up_rank", "double"), ("left_rank", "double"))])

    def found(held: pa.Table, starts: np.ndarray) -> Iterator[pa.Table]:
        row, col = (held.column(c).to_numpy() for c in ("row", "col"))
        group = np.zeros(len(row), dtype=np.int64)
        group[starts[1:]] = 1
        group = np.cumsum(group)
        at = np.flatnonzero(np.r_[True, (np.diff(group) > 0) | (np.diff(row) != 0) | (np.diff(col) != 0)])  # a cell of each place
        for side, rank, line, place in ((UP, "up_rank", col[at], row[at]), (LEFT_OF, "left_rank", row[at], col[at])):
            there = np.logical_or.reduceat(held.column(rank).is_valid().to_numpy(), at)
            least = np.fmin.reduceat(held.column(rank).to_numpy(), at)
            some = np.lexsort((place, line, group[at]))
            some = some[there[some]]
            first = np.r_[True, (np.diff(group[at][some]) > 0) | (np.diff(line[some]) != 0)][: len(some)]
            for step, (cell, above) in enumerate(chains_of_many(first, least[some])):
                own, other = at[some[cell]], at[some[above]]
                yield pa.table([
                    *(held.column(k).take(pa.array(own)) for k in keys), pa.array(row[own]), pa.array(col[own]), pa.array([side] * len(own), pa.string()),
                    pa.array(np.full(len(own), step + 1, dtype=np.int32)), pa.array(row[other]), pa.array(col[other]),
                ], names=[*keys, "row", "col", "side", "step", "ancestor_row", "ancestor_col"])

    return many_groups(own, keys, found, f"{types}, {ANCESTORS}", ("row", "col"))
