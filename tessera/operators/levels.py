"""Native pyramid levels of tissue canvases: level plans, projected masks, tile payloads, selection and projections of cost."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tessera.functions import geometry as G

# The policies that stop a native pyramid, and the reasons that a plan names.
STOP = {"segmentation": "segmentation_level", "segmentation_level": "segmentation_level", "min_side": "min_side_for_mips", "min_side_for_mips": "min_side_for_mips", "available": "available_source_levels", "available_source_levels": "available_source_levels", "all": "available_source_levels", "requested": "requested_mips", "requested_mips": "requested_mips", "explicit": "explicit_level", "explicit_level": "explicit_level", "native_mip_stop_level": "explicit_level"}
CROP = {"notebook": "notebook_square", "notebook_square": "notebook_square", "validation": "notebook_square", "source": "notebook_square", "square": "compact_square", "compact_square": "compact_square", "compact": "compact_rectangle", "compact_rectangle": "compact_rectangle", "rectangle": "compact_rectangle", "rect": "compact_rectangle", "production": "compact_rectangle"}
EXPLICIT = "native_mip_stop_level"
#: Of a validated export: what its configuration was.
BASELINE = {"segmentation_level": "7", "primary_rgb_mode": "masked_rgb", "masked_rgb_fill_value": "0", "extra_margin_px": "0", "pyramid_generation_policy": "native_source_pyramid_crop", "source_tile_aligned_canvas": "True", "native_mip_stop_policy": "segmentation_level", "store_tissue_mask": "True", "sparse_zero_chunks": "True", "compression_mode": "lossless"}


def alias(name: Column, table: dict[str, str], default: str) -> Column:
    """The canonical name of an alias, whatever its case and with - or _; a blank one is the default; any other is an error."""
    n = F.replace(F.lower(F.btrim(name)), F.lit("-"), F.lit("_"))
    known = F.element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), n)
    bad = F.raise_error(F.concat(F.lit("unknown name: "), name)).cast("string")
    return F.when(name.isNull() | (n == ""), default).otherwise(F.coalesce(known, bad))


def resolve_level(level: Column, default: Column, n_levels: Column) -> Column:
    """A level given as a number, counted from the end if negative, or as sN; null where it is out of range, default where it is not given."""
    text = F.btrim(level.cast("string"))
    n = F.regexp_extract(text, r"^s?(-?\d+)$", 1).try_cast("int")
    n = F.when(text.startswith("s-"), None).otherwise(F.when(n < 0, n + n_levels).otherwise(n))
    n = F.when(level.isNull(), default).otherwise(n)
    return F.when((n >= 0) & (n < n_levels), n)


def stop_level(policy: Column, source: Column, segmentation: Column, n_levels: Column, explicit: Column, count: Column, requested: Column) -> Column:
    """struct(stop, reason, unwritten): the last native level that is written, why, and whether it lies before the segmentation level.

    count: of mips whose smaller side suffices; requested: of mips that were asked for; explicit: a level, or null.
    """
    many = lambda n: source + F.greatest(n, F.lit(1)) - 1
    all_ = n_levels - source
    asked = F.coalesce(requested, all_)
    stop = (
        F.when(policy == "segmentation_level", segmentation).when(policy == "min_side_for_mips", many(F.coalesce(count, asked)))
        .when(policy == "requested_mips", many(asked)).when(policy == "explicit_level", explicit).otherwise(n_levels - 1)
    )
    limited = ~policy.isin("segmentation_level", "explicit_level") & explicit.isNotNull()
    cut = F.when(limited, F.least(stop, explicit)).otherwise(stop)
    reason = F.when((policy == "explicit_level") | (limited & (cut == explicit)), EXPLICIT).otherwise(policy)
    last = F.greatest(source, F.least(cut, n_levels - 1)).cast("int")
    return F.struct(last.alias("stop"), reason.alias("reason"), (last < segmentation).alias("unwritten"))


def to_level(b: Column, parent_h: Column, parent_w: Column, level_h: Column, level_w: Column) -> Column:
    """Bounds of the parent level on another one: lower edges down, upper edges up."""
    sy, sx = parent_h / F.greatest(level_h, F.lit(1)), parent_w / F.greatest(level_w, F.lit(1))
    return G.bounds(F.floor(b["y0"] / sy), F.floor(b["x0"] / sx), F.ceil(b["y1"] / sy), F.ceil(b["x1"] / sx))


def expansion(outer: Column, inner: Column) -> Column:
    """What outer adds to inner on each side."""
    return F.struct((inner["y0"] - outer["y0"]).alias("top"), (outer["y1"] - inner["y1"]).alias("bottom"), (inner["x0"] - outer["x0"]).alias("left"), (outer["x1"] - inner["x1"]).alias("right"))


def parent_bounds(scale: Column, translation: Column, h: Column, w: Column, um_y: Column, um_x: Column) -> Column:
    """The bounds, in source pixels, that a dataset's scale and translation (of 2 or 3 axes) and shape stand for."""
    k = F.size(scale) - 2
    t = lambda i: F.coalesce(F.get(translation, k + i), F.lit(0.0))
    y, x = t(0), t(1)
    parts = (y / um_y, x / um_x, (y + h * F.get(scale, k)) / um_y, (x + w * F.get(scale, k + 1)) / um_x)
    return F.struct(*[p.alias(n) for p, n in zip(parts, ("y0", "x0", "y1", "x1"), strict=True)])


def level_plan(canvases: DataFrame, levels: DataFrame, tile: int, um_y: float, um_x: float, aligned: bool = True) -> DataFrame:
    """One row for each output level of each canvas. canvases: slide, label, canvas, source, stop; levels: slide, level, h, w.

    The canvas is aligned to tiles once, at the source level, and mapped to the others; each level has its canvas, what of
    it lies in the level, the tiles that have to be read, the pixel's size and the corner's place. Levels of a slide are few.
    """
    canvas = G.align_outward(F.col("canvas"), tile) if aligned else F.col("canvas")
    rows = canvases.withColumn("canvas", canvas).withColumn("level", F.explode(F.sequence(F.col("source"), F.col("stop"))))
    rows = rows.join(levels, ["slide", "level"])
    parent = levels.select("slide", F.col("level").alias("source"), F.col("h").alias("source_h"), F.col("w").alias("source_w"))
    rows = rows.join(parent, ["slide", "source"])
    rows = rows.withColumn("level_canvas", to_level(F.col("canvas"), F.col("source_h"), F.col("source_w"), F.col("h"), F.col("w")))
    c = F.col("level_canvas")
    py, px = F.lit(um_y) * F.col("source_h") / F.greatest("h", F.lit(1)), F.lit(um_x) * F.col("source_w") / F.greatest("w", F.lit(1))
    envelope = G.align_outward(c, tile)
    return rows.select(
        "slide", "label", (F.col("level") - F.col("source")).alias("output_index"), "level", c.alias("canvas"), G.clip(c, F.col("h"), F.col("w")).alias("clipped"),
        G.clip(envelope, F.col("h"), F.col("w")).alias("read"), F.greatest(G.height(c), F.lit(1)).alias("out_h"), F.greatest(G.width(c), F.lit(1)).alias("out_w"),
        py.alias("phys_y"), px.alias("phys_x"), (c["y0"] * py).alias("trans_y"), (c["x0"] * px).alias("trans_x"),
    )


def project_labels(labels: DataFrame, scale_y: float, scale_x: float, region: tuple[int, int, int, int] | None = None) -> DataFrame:
    """labels (slide, y, x, ...) on a grid that is finer, or coarser, by any factors: a pixel takes the label that its centre falls in.

    region (y0, x0, y1, x1) of the target: only its pixels, numbered from its corner. Every pixel writes its own rectangle of
    the target, so nothing is joined.
    """
    def span(c: str, s: float) -> Column:
        a, b = F.ceil(F.col(c) * s - 0.5), F.ceil((F.col(c) + 1) * s - 0.5) - 1
        return F.when(a <= b, F.sequence(a, b)).otherwise(F.array().cast("array<bigint>"))

    keep = [c for c in labels.columns if c not in ("y", "x")]
    rows = labels.withColumn("ty", F.explode(span("y", scale_y))).withColumn("tx", F.explode(span("x", scale_x)))
    if region is not None:
        y0, x0, y1, x1 = region
        rows = rows.filter(F.col("ty").between(y0, y1 - 1) & F.col("tx").between(x0, x1 - 1)).withColumns({"ty": F.col("ty") - y0, "tx": F.col("tx") - x0})
    return rows.select(F.col("ty").alias("y"), F.col("tx").alias("x"), *keep)


def centre_crop(pixels: DataFrame, h: int, w: int, side: int) -> DataFrame:
    """Pixels of an h x w image on a square canvas of that side: the middle if the image is larger, set in the middle if smaller.

    Both halves are rounded down; what the image does not cover has no rows.
    """
    shift = lambda n: -((n - side) // 2) if n >= side else (side - n) // 2
    keep = [c for c in pixels.columns if c not in ("y", "x")]
    rows = pixels.select((F.col("y") + shift(h)).alias("y"), (F.col("x") + shift(w)).alias("x"), *keep)
    return rows.filter(F.col("y").between(0, side - 1) & F.col("x").between(0, side - 1))


def payload(plan: DataFrame, tile: int, by: list[str]) -> DataFrame:
    """Tiles of all levels, and the bytes of colour and mask files that store every one of them."""
    n = F.sum(G.ceil_div(F.col("out_h"), tile) * G.ceil_div(F.col("out_w"), tile)).cast("long")
    out = plan.groupBy(*by).agg(n.alias("tiles"))
    return out.withColumns({"rgb_bytes": F.col("tiles") * tile * tile * 3, "mask_bytes": F.col("tiles") * tile * tile, "all_bytes": F.col("tiles") * tile * tile * 4})


def activity(plan: DataFrame, marked: DataFrame, tile: int, by: list[str]) -> DataFrame:
    """(positive, empty, tiles) of output tiles. marked: by..., output_index, row, col of tiles whose mask has a pixel."""
    total = plan.groupBy(*by).agg(F.sum(G.ceil_div(F.col("out_h"), tile) * G.ceil_div(F.col("out_w"), tile)).cast("long").alias("tiles"))
    hit = marked.select(*by, "output_index", "row", "col").distinct().groupBy(*by).agg(F.count(F.lit(1)).alias("positive"))
    out = total.join(hit, by, "left").withColumn("positive", F.coalesce("positive", F.lit(0)))
    return out.select(*by, "positive", (F.col("tiles") - F.col("positive")).alias("empty"), "tiles")


def select_tissues(tissues: DataFrame, how: str, n: int | None) -> DataFrame:
    """The first n tissues (slide, label, tiles, area) of each slide: first, heaviest-tiles (then area), or largest-area; ties by label."""
    order = {"first": ["label"], "heaviest-tiles": [F.desc("tiles"), F.desc("area"), "label"], "largest-area": [F.desc("area"), "label"]}[how]
    rows = tissues.withColumn("place", F.row_number().over(W.partitionBy("slide").orderBy(*order)))
    return rows if n is None else rows.filter(F.col("place") <= n)


def ratio_projection(pilot: DataFrame, totals: DataFrame, key: str) -> DataFrame:
    """A pilot (key, tiles, seconds, physical, apparent) carried on to all tiles (key, all_tiles); ratio 0 without pilot tiles."""
    r = F.when(F.col("tiles") > 0, F.col("all_tiles") / F.col("tiles")).otherwise(F.lit(0.0))
    j = pilot.join(totals, key).withColumn("ratio", r)
    whole = lambda c: F.floor(F.col(c) * F.col("ratio")).cast("long")
    return j.select(key, "ratio", (F.col("seconds") * F.col("ratio")).alias("seconds"), (F.col("seconds") * F.col("ratio") / 60.0).alias("minutes"), whole("physical").alias("physical"), whole("apparent").alias("apparent"))


def is_big(h: Column, w: Column, bytes_per_pixel: int = 1) -> Column:
    """Whether a tile is written in pieces."""
    # A side and a number of bytes.
    return (F.greatest(h, w) >= 8192) | (h * w * bytes_per_pixel >= 1_500_000_000)


def baseline_warnings(config: DataFrame, source_level: Column) -> Column:
    """Array of what differs from the validated export's configuration (columns as text), and a note if the source level is its own."""
    found = [F.when(F.col(k) != F.lit(v), F.concat(F.lit(f"baseline_config_mismatch:{k}:actual="), F.col(k), F.lit(f":baseline={v}"))) for k, v in BASELINE.items() if k in config.columns]
    return F.array_compact(F.array(*found, F.when(source_level == 2, F.lit("estimate_source_level_matches_projection_baseline"))))


def downsample_factor(levels: DataFrame) -> DataFrame:
    """(id, factor) of levels (id, level, um): the upper median of the ratios of neighbours, to two decimals."""
    r = levels.withColumn("r", F.col("um") / F.lag("um").over(W.partitionBy("id").orderBy("level"))).filter("r IS NOT NULL")
    a = F.sort_array(F.collect_list("r"))  # as many as a pyramid has levels
    return r.groupBy("id").agg(a.alias("a")).select("id", F.bround(F.get("a", F.floor(F.size("a") / 2).cast("int")), 2).alias("factor"))


def voxel_sizes(x: Column, y: Column, z: Column, levels: int, factor: int = 2) -> Column:
    """Array of (x, y, z), whole numbers, x and y times factor at each level."""
    at = lambda c, k: (F.rint(c) * F.pow(F.lit(float(factor)), k)).cast("long")
    return F.transform(F.sequence(F.lit(0), F.lit(levels - 1)), lambda k: F.struct(at(x, k).alias("x"), at(y, k).alias("y"), F.rint(z).cast("long").alias("z")))


def choose_level(levels: DataFrame, preferred: int, full: bool = False, most_pixels: int | None = None) -> DataFrame:
    """(id, level) to show: level 0 if asked for and not too large, else the coarsest whose longer side suffices, else the last.

    levels: id, level (0 is the finest), h, w.
    """
    area, side = F.col("h") * F.col("w"), F.greatest("h", "w")
    first = F.max(F.when((F.col("level") == 0) & (F.lit(most_pixels is None) | (area <= F.lit(most_pixels))), F.lit(0)))
    fits, last = F.max(F.when(side >= preferred, F.col("level"))), F.max("level")
    return levels.groupBy("id").agg(F.coalesce(*([first] if full else []), fits, last).alias("level"))
