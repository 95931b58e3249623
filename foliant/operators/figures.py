"""Figure regions: extraction results united, de-duplicated, suppressed, clustered and renumbered."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..schemas import BOX


def united(*sources: DataFrame) -> DataFrame:
    """UNION ALL of the extractors' results, in order of precedence (method_ord), with fig_ord counted on from source to source."""
    return reduce(DataFrame.unionByName, (s.withColumn("method_ord", F.lit(i)) for i, s in enumerate(sources)))


def distinct_images(figures: DataFrame, order: list[str]) -> DataFrame:
    """Of equal images of a paper (by MD5) the first."""
    w = Window.partitionBy("arxiv_id", F.md5("image")).orderBy(*order)
    return figures.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def _overlapping(a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
    """geometry.overlaps of pairs of boxes, rows of `_numbers`; as there, a NaN is larger than any number and a null is passed over."""
    smaller = np.where(a[5] > 0, b[4], np.where(b[5] > 0, a[4], np.fmin(a[4], b[4])))
    w, h = (np.fmin(a[k + 2], b[k + 2]) - np.maximum(a[k], b[k]) for k in (0, 1))
    covered = np.where(~(w <= 0) & ~(h <= 0), w * h, 0.0)
    there = (a[5] < 2) & (b[5] < 2) & (a[5] + b[5] < 2)
    return there & ~(smaller <= 0) & ~(covered / smaller <= threshold)


def _numbers(bbox: pa.StructArray) -> np.ndarray:
    """x0, y0, x1, y1 and area of boxes, nulls as what least and greatest pass over, and how much is missing: 1 for a coordinate, 2 for the box."""
    sides = [bbox.field(bbox.type.get_field_index(c)) for c in ("x0", "y0", "x1", "y1")]
    partly = np.logical_or.reduce([c.is_null().to_numpy(zero_copy_only=False) for c in sides])
    x0, y0, x1, y1 = (c.fill_null(value).to_numpy(zero_copy_only=False) for c, value in zip(sides, (-np.inf, -np.inf, np.inf, np.inf), strict=True))
    return np.stack([x0, y0, x1, y1, (x1 - x0) * (y1 - y0), np.where(bbox.is_null().to_numpy(zero_copy_only=False), 2.0, partly)])


def suppress(boxes: np.ndarray, page: np.ndarray, threshold: float = 0.5) -> np.ndarray:
    """Which boxes greedy suppression keeps, of any number of pages at a time, each page's together and in order.

    All pages go on side by side: the first of a page's boxes that are left is kept, and those that it overlaps go.
    """
    kept = np.zeros(len(page), bool)
    left, boxes = np.arange(len(page)), boxes.copy()
    while len(left):
        first = np.append(True, np.diff(page[left]) != 0)
        kept[left[first]] = True
        stay = ~first & ~_overlapping(boxes, boxes[:, first][:, np.cumsum(first) - 1], threshold)
        left, boxes = left[stay], boxes[:, stay]
    return kept


def _changes(batch: pa.RecordBatch, keys: int) -> np.ndarray:
    """Which rows, but the first, differ from the row before in one of the first columns, which have no nulls."""
    found = np.zeros(max(0, batch.num_rows - 1), bool)
    for c in batch.columns[:keys]:
        found |= pc.not_equal(c[1:], c[:-1]).to_numpy(zero_copy_only=False)
    return found


def suppressed(figures: DataFrame, keys: list[str], order: list[str], threshold: float = 0.5) -> DataFrame:
    """Greedy suppression per page: the larger box first (ties by `order`); a box that overlaps a kept one goes. Missing boxes stay; figures with a null key don't.

    Pages stream by in order, and one page's boxes are held at a time. Only keys, order and boxes go
    there; if there are other columns, they come back by a join on keys and order.
    """
    names = [*keys, *order, "bbox"]
    ranked = figures.dropna(subset=keys).select(*names, (-F.coalesce(G.area(F.col("bbox")), F.lit(0.0))).alias("__a"))
    rows = ranked.repartition(*keys).sortWithinPartitions(*keys, "__a", *order, "bbox").select(*names)
    n_keys = len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def kept(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
            whole = pa.concat_batches(parts)
            with np.errstate(all="ignore"):
                chosen = suppress(_numbers(whole.column("bbox")), np.cumsum(np.append(0, _changes(whole, n_keys))), threshold)
            return whole.filter(pa.array(chosen))

        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            if held and _changes(pa.concat_batches([held[-1].slice(held[-1].num_rows - 1), batch.slice(0, 1)]), n_keys)[0]:
                yield kept(held)
                held = []
            edges = np.flatnonzero(_changes(batch, n_keys))
            at = int(edges[-1]) + 1 if len(edges) else 0
            if at:
                yield kept([*held, batch.slice(0, at)])
                held = []
            held.append(batch.slice(at))
        if held:
            yield kept(held)

    found = rows.mapInArrow(run, rows.schema)
    if set(figures.columns) == set(names):
        return found.select(*figures.columns)
    return figures.join(found.select(*keys, *order), [*keys, *order], "left_semi")


def renumbered(figures: DataFrame, order: list[str]) -> DataFrame:
    """figure_index from 1 by page and top edge; ties by `order`."""
    w = Window.partitionBy("arxiv_id").orderBy("page_number", "bbox.y0", *order)
    return figures.withColumn("figure_index", F.row_number().over(w))


def comprehensive(sources: list[DataFrame]) -> DataFrame:
    """All extractors: union, distinct images, suppression per page, renumbering."""
    order = ["method_ord", "fig_ord"]
    return renumbered(suppressed(distinct_images(united(*sources), order), ["arxiv_id", "page_number"], order), order)


def drawing_boxes(drawings: DataFrame) -> DataFrame:
    """One row a box of drawings (rect, or else items, an array of boxes): the rect if there is one, else each item with an area."""
    solid = F.filter("items", lambda b: (b["x1"] > b["x0"]) & (b["y1"] > b["y0"]))
    found = F.when(F.col("rect").isNotNull(), F.array("rect")).otherwise(F.coalesce(solid, F.array().cast(f"array<{BOX}>")))
    others = [c for c in drawings.columns if c not in ("rect", "items")]
    return drawings.select(*others, F.posexplode(found).alias("item_ord", "rect"))


def busy_pages_dropped(drawings: DataFrame, most: int = 2000) -> DataFrame:
    """Drawings of pages with at most so many."""
    n = drawings.groupBy("arxiv_id", "page").count().where(F.col("count") > most)
    return drawings.join(n.select("arxiv_id", "page"), ["arxiv_id", "page"], "left_anti")


def _near(box: np.ndarray, boxes: np.ndarray, by: float) -> np.ndarray:
    """Which boxes meet a box grown by a margin in an area of more than nothing."""
    x0, y0, x1, y1 = box[0] - by, box[1] - by, box[2] + by, box[3] + by
    solid = (boxes[:, 2] > boxes[:, 0]) & (boxes[:, 3] > boxes[:, 1])
    return solid & (np.maximum(x0, boxes[:, 0]) < np.minimum(x1, boxes[:, 2])) & (np.maximum(y0, boxes[:, 1]) < np.minimum(y1, boxes[:, 3]))


def cluster(boxes: np.ndarray, eps: float = 80.0) -> np.ndarray:
    """Bounding boxes of the connected components of boxes within eps, in order of their first box."""
    left = np.ones(len(boxes), bool)
    out = []
    for seed in range(len(boxes)):
        if not left[seed]:
            continue
        left[seed] = False
        members, queue = [seed], [seed]
        while queue:
            near = np.flatnonzero(left & _near(boxes[queue.pop()], boxes, eps))
            left[near] = False
            members += near.tolist()
            queue += near.tolist()
        own = boxes[members]
        out.append([*own[:, :2].min(0), *own[:, 2:].max(0)])
    return np.array(out).reshape(-1, 4)


def merge(boxes: np.ndarray, reach: float = 100.0) -> np.ndarray:
    """Each box not yet taken grows by those within reach of it, until none is; boxes finished before stay as they are."""
    left = np.ones(len(boxes), bool)
    out = []
    for seed in range(len(boxes)):
        if not left[seed]:
            continue
        left[seed] = False
        own = boxes[seed].copy()
        at = taken = 0
        while True:
            # in order: what one takes in can bring the next within reach, and those before it on the next round
            near = np.flatnonzero(left[at:] & _near(own, boxes[at:], reach))
            if len(near):
                j = at + int(near[0])
                own = np.array([*np.minimum(own[:2], boxes[j, :2]), *np.maximum(own[2:], boxes[j, 2:])])
                left[j] = False
                at, taken = j + 1, taken + 1
            elif taken:
                at = taken = 0
            else:
                break
        out.append(own)
    return np.array(out).reshape(-1, 4)


def regions(drawings: DataFrame, eps: float = 80.0, reach: float = 100.0, margin: float = 10.0, most: int = 2000) -> DataFrame:
    """Figure regions of drawings: arxiv_id, page, region_ord, bbox, area; by top edge.

    Drawings are clustered and merged per page, filtered by shape, grown by a margin and clipped to the
    page. Pages stream by in order; of a page of more than `most` drawings no more are held, and
    it is left out, so one scan and one shuffle do. Missing boxes count for the bound only.
    """
    rows = drawings.select("arxiv_id", "page", "draw_ord", "rect.*", "page_w", "page_h").repartition("arxiv_id", "page").sortWithinPartitions("arxiv_id", "page", "draw_ord")
    names = ["x0", "y0", "x1", "y1", "arxiv_id", "page", "page_w", "page_h", "seed"]

    def page_regions(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(parts)
        boxes = np.stack([t.column(c).to_numpy() for c in names[:4]], 1).astype(float)
        found = merge(cluster(boxes[~np.isnan(boxes).any(1)], eps), reach)
        same = [pa.array([t.column(c)[0].as_py()] * len(found), t.schema.field(c).type) for c in names[4:8]]
        return pa.RecordBatch.from_arrays([*(pa.array(found[:, k]) for k in range(4)), *same, pa.array(np.arange(len(found)), pa.int32())], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, n = None, [], 0
        for batch in batches:
            keys = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
            edges = [i for i in range(len(keys)) if i == 0 or keys[i] != keys[i - 1]]
            for a, b in zip(edges, [*edges[1:], len(keys)], strict=True):
                if keys[a] != key:
                    if held and n <= most:
                        yield page_regions(held)
                    key, held, n = keys[a], [], 0
                n += b - a
                held = [*held, batch.slice(a, b - a)] if n <= most else []
        if held and n <= most:
            yield page_regions(held)

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = f"x0 double, y0 double, x1 double, y1 double, arxiv_id {kinds['arxiv_id']}, page {kinds['page']}, page_w {kinds['page_w']}, page_h {kinds['page_h']}, seed int"
    found = rows.mapInArrow(run, schema).withColumn("b", F.struct("x0", "y0", "x1", "y1"))
    b = F.col("b")
    shaped = found.where(G.region_aspect_ok(b["x1"] - b["x0"], b["y1"] - b["y0"])).withColumn("bbox", G.padded(b, margin, F.col("page_w"), F.col("page_h")))
    w = Window.partitionBy("arxiv_id", "page").orderBy("bbox.y0", "seed")
    return shaped.select("arxiv_id", "page", F.row_number().over(w).alias("region_ord"), "bbox", G.area(F.col("bbox")).alias("area"))


def layout_figures(layout: DataFrame, page_sizes: DataFrame, threshold: float = 0.5, padding: float = 5.0, dpi: int = 150) -> DataFrame:
    """Figures of layout blocks (pixels): label and score, padding clipped to the page, size bounds; bbox in points.

    figure_index counts the blocks that pass label and score, also those that the size bounds drop.
    """
    w = Window.partitionBy("arxiv_id", "page").orderBy("blk_ord")
    picked = layout.where((F.col("type") == "Figure") & (F.col("score") >= threshold)).withColumn("figure_index", F.row_number().over(w))
    pixels = G.padded(G.box(F.col("x_1"), F.col("y_1"), F.col("x_2"), F.col("y_2")), padding, F.col("page_w"), F.col("page_h"))
    out = picked.join(page_sizes, ["arxiv_id", "page"]).withColumn("pixels", pixels)
    out = out.withColumn("width", (F.col("pixels.x1") - F.col("pixels.x0")).cast("int")).withColumn("height", (F.col("pixels.y1") - F.col("pixels.y0")).cast("int"))
    out = out.where(G.size_ok(F.col("width"), F.col("height"))).withColumn("bbox", G.to_points(F.col("pixels"), dpi))
    return out.select("arxiv_id", F.col("page").alias("page_number"), "figure_index", "blk_ord", "bbox", "width", "height", F.lit("layout_analysis").alias("extraction_method"))


def caption_candidates(figure_blocks: DataFrame, text_blocks: DataFrame, by_page: DataFrame) -> DataFrame:
    """Caption texts of layout figures (pixel boxes `box`): text blocks right below that begin like captions, else all captions of the page."""
    texts = text_blocks.where(F.col("text").rlike(r"(?i)^(FIG|Fig|Figure)")).select("arxiv_id", "page", F.col("blk_ord").alias("t_ord"), F.col("box").alias("t_box"), "text")
    pairs = figure_blocks.join(texts, ["arxiv_id", "page"]).where(G.caption_below(F.col("box"), F.col("t_box")))
    below = pairs.groupBy("arxiv_id", "page", "blk_ord").agg(F.array_sort(F.collect_list(F.struct("t_ord", "text"))).alias("found"))
    out = figure_blocks.join(below, ["arxiv_id", "page", "blk_ord"], "left").join(by_page, ["arxiv_id", "page"], "left")
    return out.withColumn("caption_candidates", F.coalesce(F.transform("found", lambda t: t["text"]), "captions", F.array().cast("array<string>"))).drop("found", "captions")


def embedded_images(images: DataFrame, boxes: DataFrame) -> DataFrame:
    """Embedded images that pass size, shape and area, with the first box of their xref, else one of their pixel size."""
    first = boxes.groupBy("arxiv_id", "page", "xref").agg(F.min_by("bbox", "box_ord").alias("__b"))
    w, h = F.col("width"), F.col("height")
    kept = images.where(G.size_ok(w, h) & G.aspect_ok(w, h) & G.area_ok(w, h)).join(first, ["arxiv_id", "page", "xref"], "left")
    own = G.box(F.lit(0.0), F.lit(0.0), w.cast("double"), h.cast("double"))
    return kept.withColumn("bbox", F.coalesce("__b", own)).drop("__b").withColumn("extraction_method", F.lit("embedded_image"))


def filename(paper: str = "arxiv_id", page: str = "page_number", index: str = "figure_index", number: str | None = None):
    """`{paper}_{page}_{figure}.png`: the explicit number, else an index above 0, else blank."""
    figure = F.when(F.col(index) > 0, F.col(index).cast("string")).otherwise("")
    if number:
        figure = F.coalesce(F.col(number).cast("string"), figure)
    return F.concat(F.col(paper), F.lit("_"), F.col(page).cast("string"), F.lit("_"), F.coalesce(figure, F.lit("")), F.lit(".png"))


def mapped(df: DataFrame, fn: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str) -> DataFrame:
    """A pluggable stage: page rendering, parsing, layout detection, recognition or scoring, batch by batch.

    `fn` gets an iterator, so a model can be loaded once a worker.
    """
    return df.mapInPandas(fn, schema)
