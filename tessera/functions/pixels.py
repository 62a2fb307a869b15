"""Column expressions on pixels."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

# Luma weights, and the published stain vectors (haematoxylin, eosin, DAB).
LUMA = (0.2125, 0.7154, 0.0721)
STAINS = [[0.65, 0.70, 0.29], [0.07, 0.99, 0.11], [0.27, 0.57, 0.78]]
UNMIX = np.linalg.inv(np.array(STAINS))
LOG_FLOOR = float(np.log(1e-6))


def gray(r: Column, g: Column, b: Column) -> Column:
    return LUMA[0] * r + LUMA[1] * g + LUMA[2] * b


def unit(c: Column, top: float = 255.0) -> Column:
    """Scaled to [0, 1]."""
    return F.least(F.greatest(c / top, F.lit(0.0)), F.lit(1.0))


def saturation(r: Column, g: Column, b: Column) -> Column:
    """(max - min) / max; 0 for black."""
    most, least = F.greatest(r, g, b), F.least(r, g, b)
    return F.when(most > 0, (most - least) / most).otherwise(F.lit(0.0))


def optical_density(r: Column, g: Column, b: Column) -> Column:
    """Sum over channels of -ln(clip(c, 1/255, 1)); channels in [0, 1]."""
    out = F.lit(0.0)
    for c in (r, g, b):
        out = out - F.ln(F.least(F.greatest(c, F.lit(1.0 / 255.0)), F.lit(1.0)))
    return out


def stain(r: Column, g: Column, b: Column, k: int) -> Column:
    """The amount of stain k, 0 at least, by the inverse of the stain vectors on log intensities."""
    out = F.lit(0.0)
    for i, c in enumerate((r, g, b)):
        out = out + F.ln(F.greatest(c, F.lit(1e-6))) / F.lit(LOG_FLOOR) * F.lit(float(UNMIX[i, k]))
    return F.greatest(out, F.lit(0.0))


def to_uint8(v: Column, low: Column, high: Column) -> Column:
    """Min-max to 0..255, rounded half to even; a flat channel counts with range 1."""
    span = F.when(high > low, (high - low).cast("double")).otherwise(F.lit(1.0))
    return F.rint((v - low) / span * 255.0).cast("int")
