"""Rectangles and distances. A rectangle is four columns x0, y0, x1, y1; y grows downwards."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class Rect(NamedTuple):
    """The columns of a rectangle."""

    x0: Column
    y0: Column
    x1: Column
    y1: Column

    @classmethod
    def of(cls, prefix: str = "") -> Rect:
        return cls(*(F.col(f"{prefix}{c}") for c in ("x0", "y0", "x1", "y1")))


def width(r: Rect) -> Column:
    return r.x1 - r.x0


def height(r: Rect) -> Column:
    return r.y1 - r.y0


def area(r: Rect) -> Column:
    return width(r) * height(r)


def center(r: Rect) -> tuple[Column, Column]:
    return (r.x0 + r.x1) * 0.5, (r.y0 + r.y1) * 0.5


def union(r: Rect, s: Rect) -> Rect:
    """The smallest rectangle around both."""
    return Rect(F.least(r.x0, s.x0), F.least(r.y0, s.y0), F.greatest(r.x1, s.x1), F.greatest(r.y1, s.y1))


def intersection_area(r: Rect, s: Rect) -> Column:
    zero = F.lit(0.0)
    return F.greatest(F.least(r.x1, s.x1) - F.greatest(r.x0, s.x0), zero) * F.greatest(F.least(r.y1, s.y1) - F.greatest(r.y0, s.y0), zero)


def gap(r: Rect, s: Rect) -> Column:
    """The distance between the nearest points of two rectangles; 0 if they touch."""
    zero = F.lit(0.0)
    dx = F.greatest(s.x0 - r.x1, r.x0 - s.x1, zero)
    dy = F.greatest(s.y0 - r.y1, r.y0 - s.y1, zero)
    return F.sqrt(dx * dx + dy * dy)


def point_distance(ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    return F.sqrt((bx - ax) ** 2 + (by - ay) ** 2)


def weighted_distance(ax: Column, ay: Column, bx: Column, by: Column, threshold: Column, up_only: bool = False) -> Column:
    """From a base point a to a reference point b; points below or right of it cost more, the longer axis counts little.

    up_only: points below a are not reached at all (-1).
    """
    below = ay < (by if up_only else by - threshold)
    right = ax < bx - threshold
    penalty = F.when(right & below & F.lit(not up_only), 90).when(right, 50).when(below, 50).otherwise(1)
    dx, dy = F.abs(bx - ax), F.abs(by - ay)
    flat = F.when(dx > dy, F.struct((dx * 0.01).alias("x"), dy.alias("y"))).otherwise(F.struct(dx.alias("x"), (dy * 0.01).alias("y")))
    dist = penalty * F.sqrt(flat["x"] * flat["x"] + flat["y"] * flat["y"])
    return F.when(below, F.lit(-1.0)).otherwise(dist) if up_only else dist


def aligned_x(r: Rect, alignment: Column) -> Column:
    """The x that an item is aligned at: 0 left, 1 right, 2 centre."""
    return F.when(alignment == 0, r.x0).when(alignment == 1, r.x1).otherwise((r.x0 + r.x1) * 0.5)


def page_relative(x: Column, y: Column, page_width: Column, page_height: Column) -> tuple[Column, Column]:
    """Shares of the page; on a page stacked below another, of its own."""
    stacked = y > page_height
    return x / page_width, F.when(stacked, y - page_height).otherwise(y) / page_height


def depth(size: Column, bold: Column, brightness: Column) -> Column:
    """Rank in the visual hierarchy, smaller is higher: larger, then bold, then darker type stands above."""
    return -(size * 10) - F.when(bold, 5).otherwise(0) + brightness


def font_id(font: Column, size: Column, bold: Column, brightness: Column) -> Column:
    """The identity of a type: face, size, weight and shade."""
    return F.concat_ws("|", font, size.cast("string"), bold.cast("int").cast("string"), F.format_number(brightness, 2))
