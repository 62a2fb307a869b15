"""Operators on pixel tables: thresholds, stencils, pyramids, projection, masks.

A raster is rows (slide, y, x, value columns); a mask is the rows (slide, y, x) of its foreground. A stencil is an
explode over fixed offsets and a grouping, so its cost is pixels times offsets and no join is needed.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

KEYS = ["slide", "y", "x"]


def disk(radius: int) -> list[tuple[int, int]]:
    """Offsets (dy, dx) of a disk."""
    r = range(-radius, radius + 1)
    return [(dy, dx) for dy in r for dx in r if dy * dy + dx * dx <= radius * radius]


def _shifted(df: DataFrame, offsets: list[tuple[int, int]], *extra: Column) -> DataFrame:
    """Each row at each of its offset places, with column k, the number of the offset."""
    steps = F.array(*[F.struct(F.lit(dy).alias("dy"), F.lit(dx).alias("dx"), F.lit(k).alias("k")) for k, (dy, dx) in enumerate(offsets)])
    rows = df.select("slide", "y", "x", *extra, F.explode(steps).alias("o"))
    names = [c for c in rows.columns if c not in ("slide", "y", "x", "o")]
    return rows.select("slide", (F.col("y") + F.col("o.dy")).alias("y"), (F.col("x") + F.col("o.dx")).alias("x"), F.col("o.k").alias("k"), *names)


# --- thresholds ---------------------------------------------------------------------------------------------------


def histogram(df: DataFrame, value: str = "v") -> DataFrame:
    return df.groupBy("slide", F.col(value).alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def otsu(df: DataFrame, value: str = "v") -> DataFrame:
    """(slide, threshold): the integer t that separates value <= t from value > t with the largest variance between.

    The histogram is aggregated first, so the windows see one row per distinct value; ties go to the lowest t.
    """
    below = W.partitionBy("slide").orderBy("bin").rowsBetween(W.unboundedPreceding, 0)
    whole = W.partitionBy("slide")
    h = histogram(df, value).withColumn("s", F.col("n") * F.col("bin"))
    h = h.select("slide", "bin", F.sum("n").over(below).alias("w0"), F.sum("s").over(below).alias("s0"), F.sum("n").over(whole).alias("wt"), F.sum("s").over(whole).alias("st"))
    w0, w1 = F.col("w0").cast("double"), (F.col("wt") - F.col("w0")).cast("double")
    apart = F.pow(F.col("s0") / w0 - (F.col("st") - F.col("s0")) / w1, 2) * w0 * w1
    h = h.filter("w0 < wt").withColumn("between", apart)
    return h.groupBy("slide").agg(F.max_by("bin", F.struct("between", -F.col("bin"))).cast("int").alias("threshold"))


def threshold_mask(df: DataFrame, thresholds: DataFrame, value: str = "v", dark: bool = False) -> DataFrame:
    """Pixels above the slide's threshold, or at and below it."""
    over = F.col(value) <= F.col("threshold") if dark else F.col(value) > F.col("threshold")
    return df.join(F.broadcast(thresholds), "slide").filter(over).select(*KEYS)


def adaptive_threshold(df: DataFrame, signal: str, intensity: str, floor: float, percentile: float = 0.8, multiplier: float = 4.0) -> DataFrame:
    """(slide, threshold): max(floor, median + multiplier * 1.4826 * MAD) of the signal in the bright background."""
    cut = df.groupBy("slide").agg(F.percentile(intensity, percentile).alias("cut"))
    back = df.join(F.broadcast(cut), "slide").filter(F.col(intensity) >= F.col("cut"))
    mid = back.groupBy("slide").agg(F.median(signal).alias("m"))
    mad = back.join(F.broadcast(mid), "slide").groupBy("slide").agg(F.first("m").alias("m"), F.median(F.abs(F.col(signal) - F.col("m"))).alias("mad"))
    return mad.select("slide", F.greatest(F.lit(float(floor)), F.col("m") + multiplier * 1.4826 * F.col("mad")).alias("threshold"))


# --- stencils -----------------------------------------------------------------------------------------------------


def inside(df: DataFrame, h: int, w: int) -> DataFrame:
    return df.filter((F.col("y") >= 0) & (F.col("y") < h) & (F.col("x") >= 0) & (F.col("x") < w))


def dilate(mask: DataFrame, radius: int, h: int, w: int) -> DataFrame:
    return inside(_shifted(mask, disk(radius)).select(*KEYS), h, w).distinct()


def erode(mask: DataFrame, radius: int) -> DataFrame:
    """Pixels all of whose offsets are foreground; what lies outside counts as background."""
    offsets = disk(radius)
    hits = _shifted(mask.select(*KEYS).distinct(), offsets).groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n"))
    return hits.filter(F.col("n") == len(offsets)).select(*KEYS)


def closing(mask: DataFrame, radius: int, h: int, w: int) -> DataFrame:
    """Dilation, then erosion of what may reach over the edge, so that closing never loses a pixel."""
    grown = _shifted(mask, disk(radius)).select(*KEYS).distinct()
    return inside(erode(grown, radius), h, w)


def opening(mask: DataFrame, radius: int, h: int, w: int) -> DataFrame:
    return dilate(erode(mask, radius), radius, h, w)


def boundary_ring(mask: DataFrame, radius: int = 2) -> DataFrame:
    """Foreground within radius of background."""
    return mask.select(*KEYS).join(erode(mask, radius), KEYS, "left_anti")


def gaussian(df: DataFrame, value: str = "v", sigma: float = 1.0, radius: int = 2) -> DataFrame:
    """Separable blur over the pixels that exist: weights are normalised by those present."""
    taps = [math.exp(-(k * k) / (2 * sigma * sigma)) for k in range(-radius, radius + 1)]
    lines = df.select(*KEYS, F.col(value).cast("double").alias("val"))
    for axis in ("y", "x"):
        offsets = [(k, 0) if axis == "y" else (0, k) for k in range(-radius, radius + 1)]
        moved = _shifted(lines, offsets, F.col("val"))
        weight = F.element_at(F.array(*[F.lit(t) for t in taps]), F.col("k") + 1)
        sums = moved.groupBy(*KEYS).agg((F.sum(weight * F.col("val")) / F.sum(weight)).alias("val"))
        lines = sums.join(lines.select(*KEYS), KEYS, "left_semi")
    return lines


def local_entropy(df: DataFrame, radius: int, value: str = "v") -> DataFrame:
    """Shannon entropy, in bits, of the values in a disk around each pixel that exists."""
    counts = _shifted(df, disk(radius), F.col(value).alias("val")).groupBy(*KEYS, "val").agg(F.count(F.lit(1)).alias("n"))
    # log2(N) - sum(n log2 n) / N needs one grouping after the counts.
    out = counts.groupBy(*KEYS).agg(F.sum("n").alias("total"), F.sum(F.col("n") * F.log2("n")).alias("s"))
    out = out.select(*KEYS, (F.log2("total") - F.col("s") / F.col("total")).alias("entropy"))
    return out.join(df.select(*KEYS), KEYS, "left_semi")


# --- pyramids and projection --------------------------------------------------------------------------------------


def pool(df: DataFrame, how: str = "avg", value: str = "v", h: int | None = None, w: int | None = None) -> DataFrame:
    """2 x 2 pooling by avg, max or stride; with h and w odd trailing rows and columns are dropped."""
    if h is not None:
        df = df.filter((F.col("y") < h // 2 * 2) & (F.col("x") < w // 2 * 2))
    if how == "stride":
        return df.filter("y % 2 = 0 AND x % 2 = 0").select("slide", F.floor(F.col("y") / 2).alias("y"), F.floor(F.col("x") / 2).alias("x"), value)
    to = [F.floor(F.col(c) / 2).alias(c) for c in ("y", "x")]
    agg = {"avg": F.avg, "max": F.max, "min": F.min}[how]
    return df.groupBy("slide", *to).agg(agg(value).alias(value))


def mips(df: DataFrame, levels: int, value: str = "v") -> DataFrame:
    """All levels at once, straight from level 0: (level, slide, y, x, value) of block means."""
    at = df.select("slide", "y", "x", value, F.explode(F.sequence(F.lit(0), F.lit(levels))).alias("level"))
    size = F.pow(F.lit(2.0), F.col("level"))
    return at.groupBy("level", "slide", F.floor(F.col("y") / size).alias("y"), F.floor(F.col("x") / size).alias("x")).agg(F.avg(value).alias(value))


def project_mask(mask: DataFrame, scale: int) -> DataFrame:
    """Nearest projection to a grid that is an integer factor finer."""
    k = F.sequence(F.lit(0), F.lit(scale - 1))
    rows = mask.withColumn("dy", F.explode(k)).withColumn("dx", F.explode(k))
    keep = [c for c in mask.columns if c not in ("y", "x")]
    return rows.select((F.col("y") * scale + F.col("dy")).alias("y"), (F.col("x") * scale + F.col("dx")).alias("x"), *keep)


def masked(df: DataFrame, mask: DataFrame, values: list[str], fill: int = 0) -> DataFrame:
    """Values where the mask is set, fill elsewhere."""
    m = mask.select(*KEYS).withColumn("__in", F.lit(True))
    return df.join(m, KEYS, "left").select(*KEYS, *[F.when(F.col("__in"), F.col(v)).otherwise(F.lit(fill)).alias(v) for v in values])


def outside_zero(df: DataFrame, mask: DataFrame, value: str = "v") -> DataFrame:
    """(slide, bad, n): pixels outside the mask whose value is not 0, and all pixels."""
    out = df.join(mask.select(*KEYS).distinct().withColumn("inside_mask", F.lit(True)), KEYS, "left")
    return out.groupBy("slide").agg(F.count_if(F.col("inside_mask").isNull() & (F.col(value) != 0)).alias("bad"), F.count(F.lit(1)).alias("n"))


def iou(a: DataFrame, b: DataFrame) -> DataFrame:
    """(slide, iou) of two masks; 1 where both are empty is up to the caller, as such slides have no rows."""
    rows = a.select(*KEYS, F.lit(1).alias("a"), F.lit(0).alias("b")).unionByName(b.select(*KEYS, F.lit(0).alias("a"), F.lit(1).alias("b")))
    each = rows.groupBy(*KEYS).agg(F.max("a").alias("a"), F.max("b").alias("b"))
    return each.groupBy("slide").agg((F.sum(F.col("a") * F.col("b")) / F.count(F.lit(1))).alias("iou"))


def block_activity(mask: DataFrame, block: int, h: int, w: int) -> DataFrame:
    """(slide, positive, empty) blocks of a grid."""
    total = -(-h // block) * -(-w // block)
    hit = mask.select("slide", F.floor(F.col("y") / block).alias("by"), F.floor(F.col("x") / block).alias("bx")).distinct()
    return hit.groupBy("slide").agg(F.count(F.lit(1)).alias("positive")).select("slide", "positive", (F.lit(total) - F.col("positive")).cast("long").alias("empty"))


def channel_stats(df: DataFrame) -> DataFrame:
    """Means, population deviations and mean absolute differences of r, g, b for each slide."""
    aggs = [f(c).alias(f"{n}_{c}") for c in "rgb" for f, n in ((F.avg, "mean"), (F.stddev_pop, "std"))]
    diffs = [F.avg(F.abs(F.col(a) - F.col(b))).alias(f"diff_{a}{b}") for a, b in ("rg", "rb", "gb")]
    out = df.groupBy("slide").agg(*aggs, *diffs)
    return out.withColumn("near_gray", F.greatest("diff_rg", "diff_rb", "diff_gb") <= 2.0)
