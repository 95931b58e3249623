"""Boxes: size and shape predicates, overlap and padding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import BOX


def size_ok(width: Column, height: Column, min_w: int = 100, max_w: int = 3000, min_h: int = 50, max_h: int = 2000) -> Column:
    return width.between(min_w, max_w) & height.between(min_h, max_h)


def aspect_ok(width: Column, height: Column, low: float = 0.2, high: float = 8.0) -> Column:
    """Of embedded images; a height of 0 passes."""
    return F.when(height > 0, (width / height).between(low, high)).otherwise(True)


def region_aspect_ok(width: Column, height: Column, low: float = 0.3, high: float = 10.0) -> Column:
    """Of drawn regions, before padding; a height of 0 fails."""
    return F.when(height > 0, (width / height).between(low, high)).otherwise(False)


def area_ok(width: Column, height: Column, least: int = 10000) -> Column:
    return width * height >= least


def box(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    return F.struct(x0.alias("x0"), y0.alias("y0"), x1.alias("x1"), y1.alias("y1")).cast(BOX)


def area(b: Column) -> Column:
    return (b["x1"] - b["x0"]) * (b["y1"] - b["y0"])


def intersection_area(a: Column, b: Column) -> Column:
    w = F.least(a["x1"], b["x1"]) - F.greatest(a["x0"], b["x0"])
    h = F.least(a["y1"], b["y1"]) - F.greatest(a["y0"], b["y0"])
    return F.when((w > 0) & (h > 0), w * h).otherwise(0.0)


def overlaps(a: Column, b: Column, threshold: float = 0.5) -> Column:
    """Whether more than a share of the smaller box is covered; false where a box is missing or has no area."""
    smaller = F.least(area(a), area(b))
    there = a.isNotNull() & b.isNotNull()  # least() and greatest() pass over nulls
    return F.coalesce(F.when(there & (smaller > 0), intersection_area(a, b) / smaller > threshold), F.lit(False))


def padded(b: Column, by: float, width: Column, height: Column) -> Column:
    """Grown by a margin and clipped to the page."""
    return box(F.greatest(F.lit(0.0), b["x0"] - by), F.greatest(F.lit(0.0), b["y0"] - by), F.least(width, b["x1"] + by), F.least(height, b["y1"] + by))


def to_points(b: Column, dpi: int = 150) -> Column:
    """Pixels of a rendered page to points."""
    zoom = dpi / 72
    return box(b["x0"] / zoom, b["y0"] / zoom, b["x1"] / zoom, b["y1"] / zoom)


def caption_below(figure: Column, block: Column, reach: float = 150.0) -> Column:
    """Whether a text block (pixel boxes) stands right below a figure and about in line with it."""
    gap = block["y0"] - figure["y1"]
    off = F.abs((block["x0"] + block["x1"]) / 2 - (figure["x0"] + figure["x1"]) / 2)
    return (gap > 0) & (gap < reach) & (off < (figure["x1"] - figure["x0"]) * 0.8)
