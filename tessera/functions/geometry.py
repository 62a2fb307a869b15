"""Column expressions for coordinates: one function for each rounding rule; everything else calls these.

Bounds are structs (y0, x0, y1, x1), half-open, in integers.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def bounds(y0, x0, y1, x1) -> Column:
    cols = [F.lit(c) if not isinstance(c, Column) else c for c in (y0, x0, y1, x1)]
    return F.struct(*[c.cast("long").alias(n) for c, n in zip(cols, ("y0", "x0", "y1", "x1"), strict=True)])


def ceil_div(a: Column, b) -> Column:
    """ceil(a / b) of integers, exactly."""
    b = F.lit(b) if not isinstance(b, Column) else b
    return (F.floor((a + b - 1) / b)).cast("long")


def level_size(n: Column, level: Column) -> Column:
    """ceil(n / 2^level): a scanner's own levels."""
    return F.ceil(n / F.pow(F.lit(2.0), level)).cast("long")


def mip_size(n: Column, level: Column) -> Column:
    """max(1, n >> level): a generated mip."""
    return F.greatest(F.floor(n / F.pow(F.lit(2.0), level)).cast("long"), F.lit(1))


def round_half_even(x: Column) -> Column:
    return F.rint(x)


def round_up(n: Column, multiple) -> Column:
    return ceil_div(n, multiple) * F.lit(multiple)


def clip(b: Column, h: Column, w: Column) -> Column:
    return bounds(*[F.least(F.greatest(b[c], F.lit(0)), m) for c, m in (("y0", h), ("x0", w), ("y1", h), ("x1", w))])


def halo(b: Column, pixels: int, h: Column, w: Column) -> Column:
    """Grown by pixels on each side and clipped."""
    return clip(bounds(b["y0"] - pixels, b["x0"] - pixels, b["y1"] + pixels, b["x1"] + pixels), h, w)


def scale_outward(b: Column, sy: Column, sx: Column) -> Column:
    """Mapped by factors: lower edges rounded down, upper edges up."""
    return bounds(F.floor(b["y0"] * sy), F.floor(b["x0"] * sx), F.ceil(b["y1"] * sy), F.ceil(b["x1"] * sx))


def align_outward(b: Column, tile: int) -> Column:
    return bounds(F.floor(b["y0"] / tile) * tile, F.floor(b["x0"] / tile) * tile, F.ceil(b["y1"] / tile) * tile, F.ceil(b["x1"] / tile) * tile)


def centred_square(b: Column, side: Column) -> Column:
    """A square of that side whose corner is floor(centre - side / 2) on both axes."""
    y = F.floor((b["y0"] + b["y1"]) / 2 - side / 2)
    x = F.floor((b["x0"] + b["x1"]) / 2 - side / 2)
    return bounds(y, x, y + side, x + side)


def expand_to(b: Column, h: Column, w: Column) -> Column:
    """Grown to at least that shape, half of the extra (rounded down) at the top and left."""
    dy, dx = F.greatest(h - (b["y1"] - b["y0"]), F.lit(0)), F.greatest(w - (b["x1"] - b["x0"]), F.lit(0))
    top, left = F.floor(dy / 2), F.floor(dx / 2)
    return bounds(b["y0"] - top, b["x0"] - left, b["y1"] + (dy - top), b["x1"] + (dx - left))


def height(b: Column) -> Column:
    return b["y1"] - b["y0"]


def width(b: Column) -> Column:
    return b["x1"] - b["x0"]


def padding(canvas: Column, clipped: Column) -> Column:
    return F.struct(
        (clipped["y0"] - canvas["y0"]).alias("top"),
        (canvas["y1"] - clipped["y1"]).alias("bottom"),
        (clipped["x0"] - canvas["x0"]).alias("left"),
        (canvas["x1"] - clipped["x1"]).alias("right"),
    )


def n_mips(w: Column, h: Column, least: int) -> Column:
    """Levels while the smaller side is at least twice `least`, halving downwards; 1 at least."""
    sides = F.transform(F.sequence(F.lit(0), F.lit(40)), lambda k: F.floor(F.least(w, h) / F.pow(F.lit(2.0), k)))
    return (F.size(F.filter(sides, lambda s: s >= 2 * least)) + 1).cast("long")
