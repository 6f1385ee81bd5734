"""Text boxes of scanned pages, grouped into bubbles and read in order."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators import graph as G
from tessera.sinks.shared import stored

LEAST_CONFIDENCE, LEAST_SIDE, MARGIN = 0.35, 5, 0.02


def boxes(results: DataFrame, quad: str = "quad") -> DataFrame:
    """results with x_min, x_max, y_min, y_max of a quad (array of structs x, y)."""
    side = lambda f, axis: f(F.transform(quad, lambda p: p[axis])).cast("double")
    return results.withColumns({"x_min": side(F.array_min, "x"), "x_max": side(F.array_max, "x"), "y_min": side(F.array_min, "y"), "y_max": side(F.array_max, "y")})


def kept_boxes(b: DataFrame, width: str | Column = "width", height: str | Column = "height") -> DataFrame:
    """Sure and large enough boxes that aren't a page's furniture at its margin."""
    w, h = (F.col(c) if isinstance(c, str) else c for c in (width, height))
    text = F.trim("text")
    margin = (F.col("x_min") < w * MARGIN) | (F.col("x_max") > w * (1 - MARGIN)) | (F.col("y_min") < h * MARGIN) | (F.col("y_max") > h * (1 - MARGIN))
    furniture = text.rlike("^[0-9]+$") | (F.length(text) < 4) | F.lower(text).startswith("page")
    large = (F.col("x_max") - F.col("x_min") >= LEAST_SIDE) & (F.col("y_max") - F.col("y_min") >= LEAST_SIDE)
    return b.filter((F.col("conf") >= LEAST_CONFIDENCE) & large & ~(margin & furniture))


def _gap(k: str) -> Column:
    return F.greatest(F.lit(0.0), F.greatest(f"a_{k}_min", f"b_{k}_min") - F.least(f"a_{k}_max", f"b_{k}_max"))


#: Gaps that near boxes may have, in line heights, by axis; cells are as large.
GAPS = {"x": 3, "y": 2}


def _cell(at: Column, axis: str) -> Column:
    """Number of the cell that a place on an axis is in. Pages whose boxes have no height (h = 0) have cells of one unit."""
    return F.floor(at / F.when(F.col("h") > 0, GAPS[axis] * F.col("h")).otherwise(1.0)).cast("long")


def _placed(b: DataFrame, image: str, reach: float) -> DataFrame:
    """b (with h, its page's line height) and cx, cy: a row for each cell that the box touches when `reach` of the allowed gap is added around it."""
    # A little more at the far end: rounding must not part boxes whose gap is just the allowed one.
    edge = lambda axis, end, by: _cell(F.col(f"{axis}_{end}") + by * GAPS[axis] * F.col("h"), axis)
    span = lambda axis: F.explode(F.sequence(edge(axis, "min", -reach), edge(axis, "max", reach + (1e-6 if reach else 0.0))))
    return b.withColumn("cx", span("x")).withColumn("cy", span("y"))


#: Boxes for each task in which boxes meet.
TASK_BOXES = 100_000


def _with_height(b: DataFrame, image: str) -> DataFrame:
    """Boxes with all bounds, and h; others are near nothing."""
    b = b.dropna(subset=[f"{k}_{e}" for k in GAPS for e in ("min", "max")])
    return b.join(b.groupBy(image).agg(F.avg(F.col("y_max") - F.col("y_min")).alias("h")), image)


def _met(b: DataFrame, image: str, box: str) -> DataFrame:
    """Near pairs with their bounds, each once. b has h."""
    side = lambda s: _placed(b, image, 0.5).select(image, "h", "cx", "cy", F.col(box).alias(s), *[F.col(f"{k}_{e}").alias(f"{s}_{k}_{e}") for k in GAPS for e in ("min", "max")])
    # Dealt by count: the tasks of a join may otherwise be as many for any number of boxes, and sort all the more.
    tasks = -(-b.count() // TASK_BOXES) or 1
    dealt = lambda s: side(s).repartition(tasks, image, "cx", "cy")
    p = dealt("a").join(dealt("b").drop("h"), [image, "cx", "cy"]).filter("a < b")
    first = lambda axis: _cell(F.greatest(f"a_{axis}_min", f"b_{axis}_min") - 0.5 * GAPS[axis] * F.col("h"), axis)
    return p.filter((first("x") == F.col("cx")) & (first("y") == F.col("cy")) & (_gap("y") <= GAPS["y"] * F.col("h")) & (_gap("x") <= GAPS["x"] * F.col("h")))


def near_pairs(b: DataFrame, image: str = "image_id", box: str = "box_id") -> DataFrame:
    """image, a, b (a < b): boxes whose gaps are at most two line heights down and three across.

    Boxes meet in the cells that they touch when half of the gap is added around them, and
    each pair counts in one cell, where its common ground begins: a page costs what its boxes
    have near them, not their square.
    """
    return _met(_with_height(b, image), image, box).select(image, "a", "b")


#: Links of a page that one task joins; a page with more is worked on by all.
PAGE_LINKS = 500_000


def components(nodes: DataFrame, edges: DataFrame, image: str = "image_id", box: str = "box_id") -> DataFrame:
    """image, box, component (its smallest box). Links of one page are joined in one task, unless they are more than PAGE_LINKS."""

    def run(page: pd.DataFrame) -> pd.DataFrame:
        parent: dict = {}

        def root(x):  # noqa: ANN001, ANN202
            while parent.setdefault(x, x) != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        for a, b in zip(page["a"], page["b"], strict=True):
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
        return pd.DataFrame({image: page[image].iloc[0], box: list(parent), "component": [root(x) for x in list(parent)]})

    kinds = dict(nodes.dtypes)
    edges = stored(edges, "page-links")
    large = [r[image] for r in edges.groupBy(image).count().filter(F.col("count") > PAGE_LINKS).limit(10_001).collect()]
    of_large = F.col(image).isin(large) if len(large) <= 10_000 else F.lit(True)  # with very many large pages, all of them
    linked = edges.filter(~of_large).groupBy(image).applyInPandas(run, f"{image} {kinds[image]}, {box} {kinds[box]}, component {kinds[box]}")
    if large:
        whole = G.components(edges.filter(of_large).select(F.col(image).alias("g"), "a", "b"))
        linked = linked.unionByName(whole.select(F.col("g").alias(image), F.col("node").alias(box), "component"))
    return nodes.select(image, box).join(linked, [image, box], "left").withColumn("component", F.coalesce("component", box))


def reading_order(b: DataFrame, parts: DataFrame, right_to_left: bool = False, image: str = "image_id", box: str = "box_id") -> DataFrame:
    """image, segment_no, bounds and text of every component, both levels in reading order."""
    x = lambda lo, hi: -F.col(hi) if right_to_left else F.col(lo)
    high = b.groupBy(image).agg(F.avg(F.col("y_max") - F.col("y_min")).alias("h"))
    rows = b.join(parts, [image, box]).join(high, image)
    band = F.bround(F.col("y_min") / (0.5 * F.col("h")))
    rows = rows.withColumn("item", F.struct(band.alias("r"), x("x_min", "x_max").alias("x"), F.col(box).alias("i"), F.col("text").alias("text")))
    g = rows.groupBy(image, "component").agg(
        *[f(c).alias(c) for c, f in (("x_min", F.min), ("x_max", F.max), ("y_min", F.min), ("y_max", F.max))],
        F.max("h").alias("h"),
        F.array_join(F.transform(F.array_sort(F.collect_list("item")), lambda i: i["text"]), " ").alias("text"),
    )
    order = Window.partitionBy(image).orderBy(F.bround(F.col("y_min") / (1.5 * F.col("h"))), x("x_min", "x_max"), "component")
    return g.withColumn("segment_no", F.row_number().over(order)).select(image, "segment_no", "x_min", "x_max", "y_min", "y_max", "text")


def group_boxes(results: DataFrame, right_to_left: bool = False) -> DataFrame:
    """The whole way from boxes (image_id, box_id, x/y bounds, text, conf, width, height) to segments."""
    b = kept_boxes(results)
    return reading_order(b, components(b, near_pairs(b)), right_to_left)
