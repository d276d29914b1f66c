"""What a table says: which texts name a row, which year and unit a value has.

A reader turns a table into candidates, values with all texts that any rule may
want to see. Rules themselves are not looked at here: they are applied to the
candidates as column expressions.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

from . import shapes
from .grid import Grid
from .hierarchy import chains
from .items import FOOTER, HEADLINE, LEFT, MISC, OTHER, SPECIAL, TABLE, TABLE_HEADLINE, Item, Rect, around
from .page import Page

#: A step of indentation, how far up a fuller row of years may be, how alike sizes of type must be, years back.
INDENT, YEAR_ROWS_UP, SIZE_RATIO, YEARS_BACK = 3 / 609, 7, 1.75, 10
#: Where units and years are looked for.
_TEXTS = (HEADLINE, OTHER, TABLE, TABLE_HEADLINE, SPECIAL, MISC, FOOTER)


@dataclass
class Candidate:
    """A value with the texts that may name it. nodes: of its row, nearest first; above: of its column; values: of all years."""

    kind: str
    row: int
    col: int
    item: Item
    year: int | None
    nodes: list[str]
    above: list[str] = field(default_factory=list)
    headline: list[str] = field(default_factory=list)
    units: list[str] = field(default_factory=list)
    values: list[str] = field(default_factory=list)


class Reader:
    """The rows, hierarchy, years and units of one table."""

    def __init__(self, grid: Grid, page: Page, default_year: int) -> None:
        self.grid, self.page, self.default_year = grid, page, default_year
        self._units: dict[int, list[str]] = {}
        self.parents, self.left_parents = self._parents(), self._left_parents()
        self.year_rows = [(r, years) for r in range(grid.n_rows) if (years := self.years_of(r))]

    # ---- hierarchy

    def depth(self, r: int, c: int, left: bool = False) -> float:
        """A cell's rank: type first, then how far it is indented if it is aligned left; to the left, how far down it stands."""
        item = self.grid.at(r, c)
        indent = int((item.rect.y0 if left else item.rect.x0) / (INDENT * self.page.width)) if item.alignment == LEFT else 0
        return item.depth + 10_000 * indent

    def _parents(self) -> dict[tuple[int, int], tuple[int, int] | None]:
        """The nearest cell above in the column that ranks higher, of each cell."""
        out = {}
        for c in range(self.grid.n_cols):
            line = [(r, self.depth(r, c)) for r in range(self.grid.n_rows) if self.grid.at(r, c)]
            out |= {(r, c): (above[0], c) if above else None for (r, _), above in zip(line, chains(line))}
        return out

    def _left_parents(self) -> dict[tuple[int, int], tuple[int, int] | None]:
        """The nearest cell to the left in the row that ranks higher, of each cell."""
        out = {}
        for r in range(self.grid.n_rows):
            line = [(c, self.depth(r, c, left=True)) for c in range(self.grid.n_cols) if self.grid.at(r, c)]
            out |= {(r, c): (r, beside[0]) if beside else None for (c, _), beside in zip(line, chains(line))}
        return out

    def ancestors(self) -> Iterator[tuple[int, int, str, int, int, int]]:
        """(row, column, side, step, row, column) of each cell and each of its ancestors, upwards and to the left."""
        for side, parents in (("up", self.parents), ("left", self.left_parents)):
            for cell in parents:
                step, at = 1, parents[cell]
                while at:
                    yield (*cell, side, step, *at)
                    step, at = step + 1, parents[at]

    def cell_lines(self, r: int, c: int) -> list[Item]:
        """A cell and the cells over and under it that may be lines of it: of the same rank, in rows without numbers."""
        own = self.depth(r, c)

        def walk(step: int) -> list[Item]:
            out, k = [], r + step
            while 0 < k < self.grid.n_rows and self.grid.at(k, c) and self.depth(k, c) == own:
                if any(i is not self.grid.at(k, c) and shapes.weak_numeric(i.txt) for i in self.grid.row(k)):
                    break
                out.append(self.grid.at(k, c))
                k += step
            return out

        up, down = walk(-1), walk(1)
        out = [self.grid.at(r, c)]
        for k in range(max(len(up), len(down))):
            out += up[k : k + 1] + down[k : k + 1]
        return out

    def nodes(self, r: int, c: int) -> list[str]:
        """The texts that name a row: its cell in a column, that one's ancestors, and special texts beside them."""
        out, rect, at = [], around([]), (r, c) if self.grid.at(r, c) else None
        while at:
            for i in self.cell_lines(*at):
                out.append(i.txt)
                rect = rect.grown(i.rect)
            at = self.parents[at]
        return out + [i.txt for i in self.specials_in(rect)]

    def nodes_above(self, r: int, c: int) -> list[str]:
        """The texts over a value in its column, and special texts over it."""
        item = self.grid.at(r, c)
        over = Rect(item.rect.x0, 0.0, item.rect.x1, item.rect.y1)
        return [i.txt for i in self.grid.texts_above(r, c)] + [i.txt for i in self.specials_in(over)]

    def specials_in(self, rect: Rect, share: float = 0.1) -> list[Item]:
        return [i for i in self.grid.special if i.rect.shared(rect) > share * i.rect.area]

    # ---- years

    def years_of(self, r: int) -> dict[int, int]:
        """Year to first column, of a row that has years and no other number."""
        out: dict[int, int] = {}
        for c, i in enumerate(self.grid.cells[r]):
            if i and shapes.year(i.txt):
                out.setdefault(shapes.to_year(i.txt) or 0, c)
            elif i and shapes.numeric(i.txt):
                return {}
        return out

    def years_for(self, r: int) -> tuple[int, dict[int, int]] | None:
        """The last row of years at or above a row, or one that has more years a few rows higher."""
        last = next(((k, y) for k, y in reversed(self.year_rows) if k <= r), None)
        if last is None:
            return None
        best = last
        for k, years in reversed(self.year_rows):
            if last[0] - YEAR_ROWS_UP <= k < last[0] and len(years) > len(best[1]):
                best = (k, years)
        return best

    def _under(self, r: int) -> Iterator[int]:
        """A row and those below it that it may name: without a label, up to the next label that is not indented deeper."""
        yield r
        own = self.depth(r, 0) if self.grid.at(r, 0) else float("inf")
        for k in range(r + 1, self.grid.n_rows):
            if self.grid.at(k, 0) is None:
                yield k
            elif self.depth(k, 0) <= own:
                return

    def dated(self, r: int) -> tuple[int, dict[int, Item]] | None:
        """The row with a row's values, and its value of each year."""
        for k in self._under(r):
            years = self.years_for(k)
            if years and years[0] != k:
                found = {y: self.grid.at(k, c) for y, c in years[1].items() if self.grid.at(k, c)}
                if found:
                    return k, found
        return None

    def value_row(self, r: int) -> int | None:
        """The row with any number that a row names."""
        return next((k for k in self._under(r) if any(shapes.numeric(i.txt) for i in self.grid.row(k))), None)

    def year_near(self, item: Item, rect: Rect, dates: bool) -> int | None:
        """The year of the last few before the default that is nearest to an item within a rectangle; what is beside it
        counts as near, what is right of it less so. dates: also within dates."""
        x, y = item.rect.center
        best: tuple[float, int] | None = None
        for i in self.page.within(rect, categories=_TEXTS):
            cx, cy = i.rect.center
            dx, dy = abs(cx - x) * (3 if cx > x else 1), abs(cy - y)
            far = (min(dx, dy) ** 2 + (max(dx, dy) / 3) ** 2) ** 0.5
            if best is not None and far >= best[0]:
                continue
            for w in i.words:
                found = _year_in(w.txt, dates)
                if found is not None and self.default_year - YEARS_BACK <= found <= self.default_year:
                    best = (far, found)
        return best[1] if best else None

    def found_year(self, r: int, c: int) -> int | None:
        """The year of a value that no row of years is over: near it in the table, in dates too, and then anywhere above."""
        item = self.grid.at(r, c)
        below = self.grid.next_filled(r, c, 1)
        room = item.rect.height if below is None else min(item.rect.height, 0.8 * max(self.grid.at(below, c).rect.y0 - item.rect.y1, 0.0))
        table = self.grid.rect
        near = Rect(table.x0, table.y0, table.x1, item.rect.y0 + room)
        whole = Rect(0.0, 0.0, float(10**7), near.y1)
        for rect, dates in ((near, False), (near, True), (whole, True)):
            found = self.year_near(item, rect, dates)
            if found is not None:
                return found
        return None

    # ---- units

    def units(self, r: int) -> list[str]:
        """Texts that may say a row's unit: the last special one that begins above the row, then all over it, lowest first."""
        if r not in self._units:
            self._units[r] = self._units_of(r)
        return self._units[r]

    def _units_of(self, r: int) -> list[str]:
        rect = self.grid.row_rect(r)
        before = [i for i in self.grid.special if i.rect.y0 <= rect.y0]
        over = self.page.within(Rect(rect.x0, 0.0, rect.x1, rect.y1), categories=_TEXTS)
        out = [max(before, key=lambda i: i.rect.y0).txt] if before else []
        return out + [i.row_text() for i in sorted(over, key=lambda i: (-i.rect.y0, i.rect.x0))]

    # ---- candidates

    def headline(self) -> list[str]:
        return [i.txt for i in self.grid.headline]

    def direct(self) -> Iterator[Candidate]:
        """Values under years, by the label of their row; the last label without values above is one of its texts, too."""
        carried = ""
        for r in range(self.grid.n_rows):
            if self.grid.at(r, 0) is None and self.dated(r) is None:
                continue
            found = self.dated(r)
            if found is None:
                carried = self.grid.at(r, 0).txt
                continue
            nodes = self.nodes(r, 0)
            if carried and carried not in nodes:
                nodes = [*nodes, carried]
            k, values = found
            for year, item in values.items():
                yield Candidate("direct", r, self.grid.place(item)[1], item, year, nodes, [], self.headline(), self.units(k), [i.txt for i in values.values()])

    def indirect(self) -> Iterator[Candidate]:
        """Values beside labels, by the texts of their row and their column; the year is that of the nearest column."""
        for c0 in [0, *(c for c in range(1, self.grid.n_cols) if self.grid.text_col(c))]:
            for r in range(self.grid.n_rows):
                k = self.value_row(r)
                label = self.grid.at(r, c0)
                if k is None:
                    continue
                nodes, units, years = self.nodes(r, c0), self.units(k), self.years_for(r)
                for c in range(c0 + 1, self.grid.n_cols):
                    item = self.grid.at(k, c)
                    if item is None or (label and not item.size / SIZE_RATIO <= label.size <= item.size * SIZE_RATIO):
                        continue
                    if years and years[0] == r and c in years[1].values():
                        continue  # a year is no value
                    if years:
                        year = min(years[1].items(), key=lambda x: (abs(x[1] - c), x[1]))[0]
                    else:
                        year = self.found_year(k, c) or self.default_year
                    yield Candidate("indirect", r, c, item, year, nodes, self.nodes_above(k, c), self.headline(), units, [item.txt])


def _year_in(text: str, dates: bool) -> int | None:
    import re

    from ..functions.shape import DAY_FIRST, YEAR_FIRST

    if dates:
        for pattern in (DAY_FIRST, YEAR_FIRST):
            found = re.match(pattern.replace(r"\\/", r"\/"), text.replace(" ", ""))
            if found:
                return int(found[1])
    return shapes.to_year(text) if shapes.year(text) else None
