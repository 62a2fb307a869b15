"""Frames around regions, pyramid levels, work blocks, covering tiles, and size estimates. All integer expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tessera.functions import geometry as G

POLICIES = ("notebook_square_source", "notebook_square_segmentation", "compact_square", "compact_rectangle")


def frame_specs(boxes: DataFrame, policy: str, multiple: int, margin: int = 0) -> DataFrame:
    """A canvas for each region. boxes: slide, label, y0, x0, y1, x1, and scale_y, scale_x, source_h, source_w.

    notebook_square_source: square on the mapped box, side rounded up from its longer side plus twice the margin.
    notebook_square_segmentation: the side is rounded at segmentation level and the largest of a slide holds for all.
    compact_square / compact_rectangle: each region's own frame with the margin, rounded up.
    """
    if policy not in POLICIES:
        raise ValueError(f"unknown policy {policy}")
    seg = G.bounds(F.col("y0"), F.col("x0"), F.col("y1"), F.col("x1"))
    df = boxes.select("*", seg.alias("seg")).withColumn("mapped", G.scale_outward(F.col("seg"), F.col("scale_y"), F.col("scale_x")))
    m = F.col("mapped")
    long_side = F.greatest(G.height(m), G.width(m))
    if policy == "notebook_square_source":
        df = df.withColumn("canvas", G.centred_square(m, G.round_up(long_side + 2 * margin, multiple)))
    elif policy == "notebook_square_segmentation":
        side = G.round_up(F.greatest(G.height(F.col("seg")), G.width(F.col("seg"))) + 2 * margin, multiple)
        df = df.withColumn("logical", G.centred_square(F.col("seg"), side))
        df = df.withColumn("wide", G.scale_outward(F.col("logical"), F.col("scale_y"), F.col("scale_x")))
        most = F.max(F.greatest(G.height(F.col("wide")), G.width(F.col("wide")))).over(W.partitionBy("slide"))
        df = df.withColumn("side", most).withColumn("canvas", G.centred_square(F.col("wide"), F.col("side"))).drop("logical", "wide", "side")
    elif policy == "compact_square":
        df = df.withColumn("side", G.round_up(long_side + 2 * margin, multiple)).withColumn("canvas", G.expand_to(m, F.col("side"), F.col("side"))).drop("side")
    else:
        df = df.withColumn("canvas", G.expand_to(m, G.round_up(G.height(m) + 2 * margin, multiple), G.round_up(G.width(m) + 2 * margin, multiple)))
    df = df.withColumn("clipped", G.clip(F.col("canvas"), F.col("source_h"), F.col("source_w")))
    return df.withColumn("padding", G.padding(F.col("canvas"), F.col("clipped")))


def level_shapes(images: DataFrame, levels: int) -> DataFrame:
    """images (id, h, w) to (id, level, h, w) of a scanner's levels."""
    at = images.select("id", "h", "w", F.explode(F.sequence(F.lit(0), F.lit(levels - 1))).alias("level"))
    return at.select("id", "level", G.level_size(F.col("h"), F.col("level")).alias("h"), G.level_size(F.col("w"), F.col("level")).alias("w"))


def pyramid_shapes(images: DataFrame, levels: int) -> DataFrame:
    """The same for generated mips, which halve downwards."""
    at = images.select("id", "h", "w", F.explode(F.sequence(F.lit(0), F.lit(levels - 1))).alias("level"))
    return at.select("id", "level", G.mip_size(F.col("h"), F.col("level")).alias("h"), G.mip_size(F.col("w"), F.col("level")).alias("w"))


def native_levels(source: Column, segmentation: Column, n_levels: Column, policy: str) -> Column:
    """The levels to write: up to the segmentation level, to the last level, or the source level alone."""
    stop = {"segmentation_level": F.least(segmentation, n_levels - 1), "all": n_levels - 1, "source_only": source}[policy]
    return F.when(stop >= source, F.sequence(source, stop)).otherwise(F.array().cast("array<int>"))


def blocks(frames: DataFrame, chunk: int) -> DataFrame:
    """The grid of chunk x chunk blocks of each canvas: out (canvas coordinates), source, and valid (inside the image).

    frames: slide, label, canvas, source_h, source_w; extra columns stay.
    """
    c = F.col("canvas")
    rows = frames.withColumn("oy", F.explode(F.sequence(F.lit(0).cast("long"), G.height(c) - 1, F.lit(chunk).cast("long"))))
    rows = rows.withColumn("ox", F.explode(F.sequence(F.lit(0).cast("long"), G.width(c) - 1, F.lit(chunk).cast("long"))))
    out = G.bounds(F.col("oy"), F.col("ox"), F.least(F.col("oy") + chunk, G.height(c)), F.least(F.col("ox") + chunk, G.width(c)))
    rows = rows.withColumn("out", out)
    o = F.col("out")
    rows = rows.withColumn("source", G.bounds(o["y0"] + c["y0"], o["x0"] + c["x0"], o["y1"] + c["y0"], o["x1"] + c["x0"]))
    rows = rows.withColumn("valid", G.clip(F.col("source"), F.col("source_h"), F.col("source_w")))
    v = F.col("valid")
    per_row = G.ceil_div(G.width(c), chunk)
    index = (F.col("oy") / chunk).cast("long") * per_row + (F.col("ox") / chunk).cast("long")
    return rows.withColumn("block_index", index).withColumn("requires_source", (G.height(v) > 0) & (G.width(v) > 0)).drop("oy", "ox")


def covering_tiles(b: Column, tile: int) -> Column:
    """Array of (row, col) of the tiles that meet bounds b: by arithmetic, not by a join."""
    rows = F.sequence(F.floor(b["y0"] / tile), F.floor((b["y1"] - 1) / tile))
    cols = F.sequence(F.floor(b["x0"] / tile), F.floor((b["x1"] - 1) / tile))
    both = F.flatten(F.transform(rows, lambda r: F.transform(cols, lambda c: F.struct(r.alias("row"), c.alias("col")))))
    none = F.array().cast("array<struct<row:bigint,col:bigint>>")
    return F.when((G.height(b) > 0) & (G.width(b) > 0), both).otherwise(none)


def tile_accounting(work: DataFrame, tile: int) -> DataFrame:
    """Per slide: decode calls, unique tiles, repeated-decode factor, mean tiles per block and its ratio to the ideal."""
    n = F.size(covering_tiles(F.col("valid"), tile))
    v = F.col("valid")
    ideal = G.ceil_div(G.height(v), tile) * G.ceil_div(G.width(v), tile)
    calls = work.filter("requires_source").groupBy("slide").agg(
        F.sum(n).cast("long").alias("decode_calls"), F.avg(n).alias("tiles_per_block"), (F.avg(n) / F.avg(ideal)).alias("alignment_win")
    )
    unique = work.filter("requires_source").select("slide", F.explode(covering_tiles(v, tile)).alias("t")).distinct().groupBy("slide").agg(F.count(F.lit(1)).alias("unique_tiles"))
    return calls.join(unique, "slide").withColumn("repeated_decode", F.col("decode_calls") / F.col("unique_tiles"))


def alignment(work: DataFrame, tile: int) -> DataFrame:
    """The share of blocks whose source origin lies on the tile grid."""
    on = ((F.pmod(F.col("source.y0"), F.lit(tile)) == 0) & (F.pmod(F.col("source.x0"), F.lit(tile)) == 0)).cast("double")
    return work.groupBy("slide").agg(F.count(F.lit(1)).alias("blocks"), F.avg(on).alias("aligned"))


def mask_fractions(work: DataFrame, mask: DataFrame, tile: int) -> DataFrame:
    """work with mask_fraction: foreground in the block's source bounds over the block's output area.

    mask is at source scale; it is counted on a grid of tiles aligned with the blocks, so the join is an equi-join.
    """
    b = work.select("slide", "label", "block_index", F.explode(covering_tiles(F.col("valid"), tile)).alias("t"), "valid")
    b = b.select("slide", "label", "block_index", "valid", F.col("t.row").alias("ty"), F.col("t.col").alias("tx"))
    m = mask.select("slide", "y", "x", F.floor(F.col("y") / tile).alias("ty"), F.floor(F.col("x") / tile).alias("tx"))
    hit = b.join(m, ["slide", "ty", "tx"]).filter("y >= valid.y0 AND y < valid.y1 AND x >= valid.x0 AND x < valid.x1")
    n = hit.groupBy("slide", "label", "block_index").agg(F.count(F.lit(1)).alias("n"))
    o = F.col("out")
    return work.join(n, ["slide", "label", "block_index"], "left").withColumn("mask_fraction", F.coalesce("n", F.lit(0)) / (G.height(o) * G.width(o))).drop("n")


def stratum(requires_source: Column, fraction: Column) -> Column:
    """padding, background, mixed_low (< 0.05), mixed_moderate (< 0.5) or tissue."""
    return F.when(~requires_source, "padding").when(fraction <= 0, "background").when(fraction < 0.05, "mixed_low").when(fraction < 0.5, "mixed_moderate").otherwise("tissue")


# --- estimates ------------------------------------------------------------------------------------------------------


def estimate_bytes(frames: DataFrame, levels: int, channels: int = 3, bytes_per_pixel: int = 1, chunk: int = 512) -> DataFrame:
    """Bytes of all mips and chunks of level 0 for each slide, and a warning."""
    k = F.explode(F.sequence(F.lit(0), F.lit(levels - 1))).alias("level")
    c = F.col("canvas")
    rows = frames.select("slide", G.height(c).alias("h"), G.width(c).alias("w"), k)
    h, w = G.mip_size(F.col("h"), F.col("level")), G.mip_size(F.col("w"), F.col("level"))
    chunks = F.when(F.col("level") == 0, G.ceil_div(F.col("h"), chunk) * G.ceil_div(F.col("w"), chunk)).otherwise(F.lit(0))
    out = rows.groupBy("slide").agg(F.sum(h * w * channels * bytes_per_pixel).alias("bytes_all_mips"), F.sum(chunks).alias("s0_chunks"))
    return out.withColumn("warning", estimate_warning(F.col("bytes_all_mips"), F.col("s0_chunks")))


def estimate_warning(n_bytes: Column, chunks: Column) -> Column:
    """The code of the first limit that is reached, or null."""
    gib = 1 << 30
    return F.when(n_bytes >= 250 * gib, "very_large_output_over_250_gib").when(n_bytes >= 100 * gib, "large_output_over_100_gib").when(chunks >= 100_000, "many_s0_chunks_over_100k")


def project_cost(estimate: DataFrame, base_chunks: int, base_bytes: int, base_seconds: float, base_files: int) -> DataFrame:
    """Seconds by the ratio of chunks, disk by the ratio of bytes, files rounded up."""
    by_chunks = F.col("s0_chunks") / float(base_chunks)
    return estimate.select(
        "slide",
        (F.lit(base_seconds) * by_chunks).alias("seconds"),
        (F.col("bytes_all_mips") / float(base_bytes)).alias("disk_ratio"),
        F.ceil(F.lit(float(base_files)) * by_chunks).cast("long").alias("files"),
    )


# --- sampling of work blocks ----------------------------------------------------------------------------------------


def sample_blocks(work: DataFrame, how: str, n: int, seed: int = 0) -> DataFrame:
    """n blocks of each slide: first, random (by a hash), tissue (largest mask_fraction above 0), mixed (the first ones of
    that coarse stratum), or stratified.

    Stratified gives each of the four coarse strata n / 4 blocks, the remainder to the first ones; what a stratum cannot
    fill is drawn from the rest by a hash.
    """
    by = W.partitionBy("slide")
    key = F.xxhash64("slide", "label", "block_index", F.lit(seed))
    coarse = F.when(F.col("stratum").startswith("mixed"), "mixed").otherwise(F.col("stratum")) if how in ("mixed", "stratified") else None
    if how == "mixed":
        return sample_blocks(work.filter(coarse == "mixed"), "first", n)
    if how == "tissue":
        work = work.filter("mask_fraction > 0")
    if how in ("first", "random", "tissue"):
        order = {"first": ["label", "block_index"], "random": [key], "tissue": [F.desc("mask_fraction"), "label", "block_index"]}[how]
        return work.withColumn("__r", F.row_number().over(by.orderBy(*order))).filter(F.col("__r") <= n).drop("__r")
    if how != "stratified":
        raise ValueError(f"unknown sampling {how}")
    names = ["padding", "background", "mixed", "tissue"]
    quota = F.lit(0)
    for k, name in enumerate(names):
        quota = F.when(coarse == name, F.lit(n // 4 + (k < n % 4))).otherwise(quota)
    rows = work.withColumn("__q", quota).withColumn("__r", F.row_number().over(W.partitionBy("slide", coarse).orderBy(key)))
    rows = rows.withColumn("__own", F.col("__r") <= F.col("__q"))
    rows = rows.withColumn("__r", F.row_number().over(by.orderBy(F.desc("__own"), key)))
    return rows.filter(F.col("__r") <= n).drop("__q", "__r", "__own")
