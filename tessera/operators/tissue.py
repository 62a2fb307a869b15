"""Tissue masks of whole slides: a threshold, the stain gate, and the morphology that makes solid sections of it.

Every slide is a full raster of h x w pixels. Each stage is written, as the next ones read it several times.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.storage import materialise
from tessera.operators import raster, regions
from tessera.operators.raster import KEYS

BINS = 256
#: Values that differ only by the order of their sums are made equal.
DIGITS = 9


def blurred(df: DataFrame, h: int, w: int, value: str = "v", sigma: float = 1.0) -> DataFrame:
    """(slide, y, x, val): a Gaussian cut at four deviations; the frame's edge goes on outside with its own values."""
    radius = int(4 * sigma + 0.5)

    def reach(axis: str, end: int) -> Column:
        at, far = F.col(axis).cast("int"), F.sequence(F.lit(1), F.lit(radius))
        low = F.when(at == 0, F.transform(far, lambda k: -k)).otherwise(F.array().cast("array<int>"))
        high = F.when(at == end - 1, F.transform(far, lambda k: k + (end - 1))).otherwise(F.array().cast("array<int>"))
        return F.explode(F.concat(F.array(at), low, high))

    rows = df.select("slide", reach("y", h).alias("y"), "x", value).select("slide", "y", reach("x", w).alias("x"), value)
    soft = raster.inside(raster.gaussian(rows, value, sigma, radius), h, w)
    return soft.withColumn("val", F.round("val", DIGITS))


def otsu_of_range(df: DataFrame, value: str, bins: int = BINS) -> DataFrame:
    """(slide, threshold): Otsu's threshold of real values, the centre of one of `bins` equal bins; none for flat slides."""
    ends = df.groupBy("slide").agg(F.min(value).cast("double").alias("lo"), F.max(value).cast("double").alias("hi")).filter("lo < hi")
    at = F.least(F.floor((F.col(value) - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins), F.lit(bins - 1)).cast("int")
    binned = df.join(F.broadcast(ends), "slide").select("slide", at.alias("v"))
    centre = F.col("lo") + (F.col("threshold") + 0.5) * (F.col("hi") - F.col("lo")) / bins
    return raster.otsu(binned).join(ends, "slide").select("slide", centre.alias("threshold"))


def _erode(mask: DataFrame, radius: int, h: int, w: int) -> DataFrame:
    """Pixels all of whose offsets within the frame are foreground."""
    offsets = raster.disk(radius)
    y, x = F.col("y"), F.col("x")
    steps = F.array(*[F.struct(F.lit(dy).alias("dy"), F.lit(dx).alias("dx")) for dy, dx in offsets])
    within = F.size(F.filter(steps, lambda o: (y + o["dy"]).between(0, h - 1) & (x + o["dx"]).between(0, w - 1)))
    near = (y < radius) | (y >= h - radius) | (x < radius) | (x >= w - radius)
    hits = raster._shifted(mask.select(*KEYS).distinct(), offsets).groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n"))
    return raster.inside(hits, h, w).filter(F.col("n") == F.when(near, within).otherwise(F.lit(len(offsets)))).select(*KEYS)


def _large(mask: DataFrame, least: int) -> DataFrame:
    """The 4-connected objects of at least `least` pixels."""
    return regions.remove_small(regions.label(mask, eight=False), least).select(*KEYS)


def _frame(slides: DataFrame, h: int, w: int) -> DataFrame:
    rows = slides.select(F.col("slide").cast("long").alias("slide"), F.explode(F.sequence(F.lit(0), F.lit(h - 1))).alias("y"))
    return rows.select("slide", "y", F.explode(F.sequence(F.lit(0), F.lit(w - 1))).alias("x"))


def _fill_small(mask: DataFrame, slides: DataFrame, least: int, h: int, w: int) -> DataFrame:
    """The mask with the 4-connected pieces of background of fewer than `least` pixels, at the edge too."""
    frame = _frame(slides, h, w)
    background = _large(frame.join(mask, KEYS, "left_anti"), least)
    return frame.join(background, KEYS, "left_anti")


def _gated(mask: DataFrame, radius: int, h: int, w: int, stained: DataFrame | None, pre_open: int) -> DataFrame:
    """The stain gate, the opening and the closing."""
    if stained is not None:
        mask = mask.join(stained.select(*KEYS).distinct(), KEYS, "left_semi")
    if pre_open > 0:
        mask = raster.dilate(_erode(mask, pre_open, h, w), pre_open, h, w)
    return materialise(_erode(raster.dilate(mask, radius, h, w), radius, h, w), "closed")


def otsu_mask(df: DataFrame, radius: int, min_area: int, h: int, w: int, stained: DataFrame | None = None, pre_open: int = 0, value: str = "v") -> DataFrame:
    """Blur, the dark side of Otsu's threshold, stain gate, opening, closing; small holes filled, small objects dropped."""
    soft = materialise(blurred(df, h, w, value), "soft")
    dark = soft.join(F.broadcast(otsu_of_range(soft, "val")), "slide").filter("val < threshold").select(*KEYS)
    closed = _gated(dark, radius, h, w, stained, pre_open)
    return _large(_fill_small(closed, df.select("slide").distinct(), min_area, h, w), min_area)


def entropy_mask(df: DataFrame, radius: int, min_area: int, h: int, w: int, stained: DataFrame | None = None, pre_open: int = 0, value: str = "v") -> DataFrame:
    """Local entropy above Otsu's threshold, stain gate, opening, closing, all holes; small objects dropped, then small holes filled."""
    ends = df.groupBy("slide").agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    level = F.floor((F.col(value) - F.col("lo")) / (F.col("hi") - F.col("lo") + 1e-6) * 255.0 + 0.5).cast("int")
    levels = df.join(F.broadcast(ends), "slide").select(*KEYS, level.alias("v"))
    entropy = materialise(raster.local_entropy(levels, max(1, radius)).withColumn("entropy", F.round("entropy", DIGITS)), "entropy")
    rough = entropy.join(F.broadcast(otsu_of_range(entropy, "entropy")), "slide").filter("entropy > threshold").select(*KEYS)
    closed = _gated(rough, max(1, radius), h, w, stained, pre_open)
    solid = _large(regions.fill_holes(closed, h, w), min_area)
    return _fill_small(solid, df.select("slide").distinct(), min_area, h, w)
