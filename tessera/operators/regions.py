"""Connected regions of masks, and what is computed from them.

Labelling is local first: pixels are grouped into blocks, each block is labelled by union-find in one task, and only the
pairs of labels that touch across block edges go to the distributed components of the whole mask. So a slide of any
size is spread over tasks of BLOCK x BLOCK pixels.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType
from pyspark.sql.window import Window as W

from tessera.operators import graph
from tessera.operators.raster import KEYS, boundary_ring

BLOCK = 1024
#: Larger than any coordinate: a pixel's number within its slide is y * SPAN + x, and its slide stands above that.
SPAN = 1 << 22


def _union_find(rows: pd.DataFrame, eight: bool) -> pd.DataFrame:
    y, x = rows["y"].to_numpy(np.int64), rows["x"].to_numpy(np.int64)
    number = y * SPAN + x
    order = np.argsort(number)
    number, root = number[order], np.arange(len(number))
    i, j = [], []
    for d in (1, SPAN) + ((SPAN - 1, SPAN + 1) if eight else ()):
        to = np.searchsorted(number, number + d)
        to[to == len(number)] = 0
        hit = np.flatnonzero(number[to] == number + d)
        i.append(hit)
        j.append(to[hit])
    i, j = np.concatenate(i), np.concatenate(j)
    while len(i):  # hook the larger root of every pair to the smaller, then shorten all paths
        a, b = root[i], root[j]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(again := root[root], root):
            root = again
        apart = root[i] != root[j]
        i, j = i[apart], j[apart]
    return rows.iloc[order].assign(local=number[root])


def _slide(df: DataFrame) -> Column:
    """The slide as a bigint, or as it is if its name is no whole number."""
    return F.col("slide").cast("long") if isinstance(df.schema["slide"].dataType, IntegralType) else F.col("slide")


def _typed(df: DataFrame, schema: str) -> str:
    """schema, whose first column is the slide, with the slide's type."""
    return f"slide {df.schema['slide'].dataType.simpleString()}, {schema}"


def label(mask: DataFrame, eight: bool = True, block: int = BLOCK) -> DataFrame:
    """(slide, y, x, label): the label is the smallest y * SPAN + x of the region. Slides may be numbers or names."""
    m = mask.select(_slide(mask).alias("slide"), F.col("y").cast("long").alias("y"), F.col("x").cast("long").alias("x")).distinct()
    m = m.withColumns({"by": F.floor(F.col("y") / block), "bx": F.floor(F.col("x") / block)})
    local = m.groupBy("slide", "by", "bx").applyInPandas(lambda rows: _union_find(rows, eight), _typed(m, "y long, x long, by long, bx long, local long"))
    local = graph.materialise(local, "local").select("slide", "y", "x", "local")
    # Only pixels on a block's edge can touch another block.
    edge = local.filter(f"y % {block} IN (0, {block - 1}) OR x % {block} IN (0, {block - 1})")
    steps = [(0, 1), (1, 0)] + ([(1, 1), (1, -1)] if eight else [])
    moved = edge.select("slide", F.col("local").alias("a"), F.explode(F.array(*[F.struct((F.col("y") + dy).alias("y"), (F.col("x") + dx).alias("x")) for dy, dx in steps])).alias("p"))
    moved = moved.select("slide", "a", F.col("p.y").alias("y"), F.col("p.x").alias("x"))
    pairs = moved.join(edge.select("slide", "y", "x", F.col("local").alias("b")), KEYS).filter("a <> b").select("slide", "a", "b").distinct()
    pairs = graph.materialise(pairs, "pairs")
    if not pairs.take(1):
        return local.withColumnRenamed("local", "label")
    roots = graph.components(pairs.select(F.xxhash64("slide", "a").alias("a"), F.xxhash64("slide", "b").alias("b")))
    names = pairs.select("slide", F.explode(F.array("a", "b")).alias("local")).distinct()
    names = names.join(roots, F.xxhash64("slide", "local") == F.col("key")).select("slide", "local", "root")
    least = names.groupBy("slide", "root").agg(F.min("local").alias("label"))
    joined = local.join(names.join(least, ["slide", "root"]).select("slide", "local", "label"), ["slide", "local"], "left")
    return joined.select("slide", "y", "x", F.coalesce("label", "local").alias("label"))


def fill_holes(mask: DataFrame, h: int, w: int) -> DataFrame:
    """The mask with every 4-connected piece of background that does not reach the frame's edge."""
    mask = mask.select(_slide(mask).alias("slide"), F.col("y").cast("long").alias("y"), F.col("x").cast("long").alias("x"))
    slides = mask.select("slide").distinct()
    grid = slides.select("slide", F.explode(F.sequence(F.lit(0), F.lit(h - 1))).alias("y")).select("slide", "y", F.explode(F.sequence(F.lit(0), F.lit(w - 1))).alias("x"))
    back = label(grid.join(mask.select(*KEYS), KEYS, "left_anti"), eight=False)
    outer = back.filter(f"y IN (0, {h - 1}) OR x IN (0, {w - 1})").select("slide", "label").distinct()
    holes = back.join(outer, ["slide", "label"], "left_anti").select(*KEYS)
    return mask.unionByName(holes)


def areas(labels: DataFrame) -> DataFrame:
    return labels.groupBy("slide", "label").agg(F.count(F.lit(1)).alias("area"))


def remove_small(labels: DataFrame, least: int) -> DataFrame:
    return labels.join(areas(labels).filter(F.col("area") >= least), ["slide", "label"], "left_semi")


def keep_top_k(labels: DataFrame, k: int | None) -> DataFrame:
    """The k largest regions of each slide; ties keep the lower label; None or 0 keeps all."""
    if not k or k < 0:
        return labels
    rank = F.row_number().over(W.partitionBy("slide").orderBy(F.desc("area"), "label"))
    return labels.join(areas(labels).withColumn("r", rank).filter(F.col("r") <= k), ["slide", "label"], "left_semi")


def boxes(labels: DataFrame) -> DataFrame:
    """Area, half-open box and centroid of each region."""
    return labels.groupBy("slide", "label").agg(
        F.count(F.lit(1)).alias("area"),
        F.min("y").alias("y0"),
        F.min("x").alias("x0"),
        (F.max("y") + 1).alias("y1"),
        (F.max("x") + 1).alias("x1"),
        F.avg("y").alias("cy"),
        F.avg("x").alias("cx"),
    )


def ordered(regions: DataFrame) -> DataFrame:
    """tile_index from left to right (0-based, ties by label), area_rank (1-based, ties by tile_index), area_fraction."""
    out = regions.withColumn("tile_index", (F.row_number().over(W.partitionBy("slide").orderBy("cx", "label")) - 1).cast("int"))
    out = out.withColumn("area_rank", F.row_number().over(W.partitionBy("slide").orderBy(F.desc("area"), "tile_index")))
    return out.withColumn("area_fraction", F.col("area") / F.sum("area").over(W.partitionBy("slide")))


def boundary_contact(candidates: DataFrame, labels: DataFrame, radius: int = 2) -> DataFrame:
    """(slide, label, contact, fraction): how much of each region of candidates lies on the ring of the labels' mask."""
    ring = boundary_ring(labels, radius).withColumn("on", F.lit(1))
    hit = candidates.join(ring, KEYS, "left").groupBy("slide", "label").agg(F.count("on").alias("contact"), F.count(F.lit(1)).alias("area"))
    return hit.select("slide", "label", "contact", (F.col("contact") / F.col("area")).alias("fraction"))


def score(labels: DataFrame, pixels: DataFrame, h: int, w: int, min_od: float = 0.35) -> DataFrame:
    """The measures of each region and the artifact rules that they meet.

    pixels: slide, y, x, intensity, od. Thinness is short side over long side; extent is area over box area.
    """
    on_edge = (F.col("y") == 0) | (F.col("x") == 0) | (F.col("y") == h - 1) | (F.col("x") == w - 1)
    tone = labels.join(pixels.select(*KEYS, "intensity", "od"), KEYS, "left").groupBy("slide", "label").agg(
        F.avg(on_edge.cast("double")).alias("edge_contact_fraction"),
        F.avg("intensity").alias("mean_intensity"),
        F.avg("od").alias("mean_od"),
        F.avg((F.col("od") >= min_od).cast("double")).alias("stain_fraction"),
    )
    r = ordered(boxes(labels)).join(tone, ["slide", "label"])
    bh, bw = F.col("y1") - F.col("y0"), F.col("x1") - F.col("x0")
    r = r.withColumns({
        "bbox_height": bh,
        "bbox_width": bw,
        "aspect_ratio": F.greatest(bh, bw) / F.least(bh, bw),
        "thinness": F.least(bh, bw) / F.greatest(bh, bw),
        "extent": F.col("area") / (bh * bw),
    })
    return r.withColumn("artifact_reason", F.array_join(artifact_reasons(), ";")).withColumn("artifact_likely", F.col("artifact_reason") != "")


def artifact_reasons():
    """The names of the rules that a region meets."""
    c = F.col
    # The thresholds of the four rules.
    rules = [
        ("tiny_low_od_fragment", (c("area_fraction") < 0.035) & (c("stain_fraction") < 0.35) & (c("mean_od") < 0.55)),
        ("low_rank_low_stain_component", (c("area_rank") > 4) & (c("area_fraction") < 0.12) & (c("stain_fraction") < 0.45)),
        ("thin_low_stain_component", (c("aspect_ratio") >= 7) & (c("thinness") <= 0.14) & (c("stain_fraction") < 0.55)),
        ("edge_strip", (c("edge_contact_fraction") > 0.18) & (c("aspect_ratio") >= 5) & (c("extent") < 0.45)),
    ]
    return F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in rules]))


def appendages(labels: DataFrame, stained: DataFrame, signal: DataFrame | None = None, threshold: float = 0.0, radius: int = 2) -> DataFrame:
    """One row for each weakly stained part of a region: its measures, the rule that it meets, and whether it is to be trimmed.

    A part is a region of (label's pixels AND NOT stained). Rules: it touches the region's ring (what an erosion by a disk
    takes away), has at most 0.18 of the region's area, and is either a strip or a ragged piece. It is trimmed only if its
    mean signal (slide, y, x, signal; no table counts as 0) is weak as well.
    """
    loose = label(labels.join(stained.select(*KEYS), KEYS, "left_anti")).withColumnRenamed("label", "appendage")
    ring = boundary_ring(labels, radius).withColumn("on", F.lit(1))
    rows = loose.join(labels.select(*KEYS, "label"), KEYS).join(ring, KEYS, "left")
    rows = rows.withColumn("signal", F.lit(0.0)) if signal is None else rows.join(signal.select(*KEYS, "signal"), KEYS, "left")
    parts = rows.groupBy("slide", "label", "appendage").agg(
        F.count(F.lit(1)).alias("area_px"), F.min("y").alias("bbox_y0"), F.min("x").alias("bbox_x0"), (F.max("y") + 1).alias("bbox_y1"), (F.max("x") + 1).alias("bbox_x1"),
        F.count("on").alias("contact"), F.coalesce(F.avg("signal"), F.lit(0.0)).alias("mean_he_signal"),
    )
    h, w = F.col("bbox_y1") - F.col("bbox_y0"), F.col("bbox_x1") - F.col("bbox_x0")
    parts = parts.join(areas(labels), ["slide", "label"]).withColumns({
        "area_fraction": F.col("area_px") / F.col("area"), "aspect_ratio": F.greatest(h, w) / F.least(h, w),
        "extent": F.col("area_px") / (h * w), "boundary_contact_fraction": F.col("contact") / F.col("area_px"),
    })
    c = F.col
    # The names and thresholds of the two rules, and of a weak signal.
    small = (c("contact") > 0) & (c("area_fraction") <= 0.18)
    strip = small & (c("aspect_ratio") >= 4.0) & (c("boundary_contact_fraction") >= 0.03)
    ragged = small & (c("extent") <= 0.35) & (c("boundary_contact_fraction") >= 0.08)
    reason = F.when(strip, "peripheral_low_he_strip").when(ragged, "peripheral_low_he_appendage").otherwise("")
    weak = c("mean_he_signal") <= max(threshold * 1.25, 0.04)
    return parts.drop("area").withColumn("appendage_reason", reason).withColumn("trimmed", (c("appendage_reason") != "") & weak)


def trim_appendages(labels: DataFrame, stained: DataFrame, min_area: int, signal: DataFrame | None = None, threshold: float = 0.0) -> DataFrame:
    """Labels of the mask without the parts that `appendages` trims; objects under max(64, min_area / 2) go, if any was trimmed on the slide."""
    cut = graph.materialise(appendages(labels, stained, signal, threshold).filter("trimmed").select("slide", "appendage"), "cut")
    loose = label(labels.join(stained.select(*KEYS), KEYS, "left_anti")).withColumnRenamed("label", "appendage")
    gone = loose.join(cut, ["slide", "appendage"], "left_semi").select(*KEYS)
    rest = label(labels.join(gone, KEYS, "left_anti"), eight=False)
    small = areas(rest).filter(F.col("area") < max(64, min_area // 2)).join(cut.select("slide").distinct(), "slide", "left_semi")
    return label(rest.join(small, ["slide", "label"], "left_anti"))


# --- kernels without a relational form ------------------------------------------------------------------------------


def _distance(grid: np.ndarray) -> np.ndarray:
    """Squared distance of each cell to the nearest background cell: along each axis, minima over shifts up to the farthest that still matter."""
    h, w = grid.shape
    g = np.where(grid, float(h * h + w * w), 0.0)
    for _ in range(2):
        out, d = g.copy(), 1
        while d < len(g) and d * d < out.max():
            np.minimum(out[d:], g[:-d] + d * d, out=out[d:])
            np.minimum(out[:-d], g[d:] + d * d, out=out[:-d])
            d += 1
        g = np.ascontiguousarray(out.T)
    return g


def _grid(rows: pd.DataFrame) -> tuple[np.ndarray, int, int]:
    y0, x0 = int(rows["y"].min()) - 1, int(rows["x"].min()) - 1
    grid = np.zeros((int(rows["y"].max()) - y0 + 2, int(rows["x"].max()) - x0 + 2), bool)
    grid[rows["y"] - y0, rows["x"] - x0] = True
    return grid, y0, x0


def distance_transform(labels: DataFrame) -> DataFrame:
    """(slide, y, x, label, distance) to the nearest pixel outside the region; one region is one task."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        grid, y0, x0 = _grid(rows)
        d = np.sqrt(_distance(grid))
        return rows.assign(distance=d[rows["y"] - y0, rows["x"] - x0])

    return labels.select("slide", "y", "x", "label").groupBy("slide", "label").applyInPandas(run, _typed(labels, "y long, x long, label long, distance double"))


def _hull_area(points: np.ndarray) -> float:
    """Area of the convex hull of the pixels' corners."""
    corners = np.unique(np.concatenate([points + d for d in ((0, 0), (0, 1), (1, 0), (1, 1))]), axis=0)

    def half(ps):
        out: list = []
        for p in ps:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) - (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0]) <= 0:
                out.pop()
            out.append(p)
        return out[:-1]

    ring = np.array(half(corners.tolist()) + half(corners.tolist()[::-1]), dtype=float)
    a, b = ring, np.roll(ring, -1, axis=0)
    return abs(float((a[:, 0] * b[:, 1] - a[:, 1] * b[:, 0]).sum())) / 2


def solidity(labels: DataFrame) -> DataFrame:
    """(slide, label, solidity): area over the area of the convex hull. The hull needs only each row's first and last pixel."""
    ends = labels.groupBy("slide", "label", "y").agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.count(F.lit(1)).alias("n"))

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        points = np.concatenate([rows[["y", "x0"]].to_numpy(), rows[["y", "x1"]].to_numpy()])
        return pd.DataFrame({"slide": rows["slide"][:1], "label": rows["label"][:1], "solidity": [rows["n"].sum() / _hull_area(points)]})

    return ends.groupBy("slide", "label").applyInPandas(run, _typed(labels, "label long, solidity double"))


def split_touching(labels: DataFrame, radius: int = 3, min_area: int = 256) -> DataFrame:
    """Regions cut where they only touch: seeds are what an erosion leaves, and pixels go to the seed that floods them first.

    Flooding goes down the distance transform; pixels where two floods meet are left out. A region without a seed goes;
    only where a whole slide has none, the pixel farthest from the background is its one seed. Parts under
    max(64, min_area / 2) pixels go; without a radius nothing is cut, and parts under min_area go. One region is one task.
    """
    if radius <= 0:
        return remove_small(labels, min_area).select("slide", "y", "x", "label")

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        import heapq

        grid, y0, x0 = _grid(rows)
        d = _distance(grid)
        core = d > radius * radius
        seed = np.zeros(grid.shape, np.int64)
        n, whole, peak = 0, bool(core.any()), np.unravel_index(int(np.argmax(d)), d.shape)
        core[peak] = True
        at = int(peak[0] + y0) * SPAN + int(peak[1] + x0)
        for y, x in zip(*np.nonzero(core), strict=True):
            if not seed[y, x]:
                n += 1
                stack = [(y, x)]
                seed[y, x] = n
                while stack:
                    a, b = stack.pop()
                    for u in (a - 1, a, a + 1):
                        for v in (b - 1, b, b + 1):
                            if core[u, v] and not seed[u, v]:
                                seed[u, v] = n
                                stack.append((u, v))
        heap = [(-d[y, x], k, y, x) for k, (y, x) in enumerate(zip(*np.nonzero(seed), strict=True))]
        heapq.heapify(heap)
        tick, line = len(heap), np.zeros(grid.shape, bool)
        while heap:
            _, _, y, x = heapq.heappop(heap)
            if line[y, x]:
                continue
            for u in (y - 1, y, y + 1):
                for v in (x - 1, x, x + 1):
                    if not grid[u, v] or seed[u, v] or line[u, v]:
                        continue
                    near = seed[max(u - 1, 0) : u + 2, max(v - 1, 0) : v + 2]
                    if len(np.unique(near[near > 0])) > 1:
                        line[u, v] = True
                        continue
                    seed[u, v] = seed[y, x]
                    tick += 1
                    heapq.heappush(heap, (-d[u, v], tick, u, v))
        return rows.assign(part=seed[rows["y"] - y0, rows["x"] - x0], seeded=whole, peak=d.max(), peak_at=at)

    parts = labels.select("slide", "y", "x", "label").groupBy("slide", "label").applyInPandas(run, _typed(labels, "y long, x long, label long, part long, seeded boolean, peak double, peak_at long"))
    parts = graph.materialise(parts, "parts")
    best = parts.groupBy("slide").agg(F.bool_or("seeded").alias("any_seed"), F.max(F.struct("peak", (-F.col("peak_at")).alias("at"))).alias("best"))
    mine = (F.col("peak") == F.col("best.peak")) & (F.col("peak_at") == -F.col("best.at"))
    parts = parts.join(F.broadcast(best), "slide").filter(F.col("seeded") | (~F.col("any_seed") & mine))  # one row for each slide
    whole = W.partitionBy("slide", "label", "part")
    parts = parts.filter("part > 0").withColumn("area", F.count(F.lit(1)).over(whole)).filter(F.col("area") >= max(64, min_area // 2))
    return parts.withColumn("label", F.min(F.col("y") * SPAN + F.col("x")).over(whole)).select("slide", "y", "x", "label")
