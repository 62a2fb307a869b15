"""Roll-ups of work blocks: by stratum and in total, in one pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def summary(work: DataFrame) -> DataFrame:
    """(slide, stratum, n, mean, p95) of mask fractions; stratum null is the slide's total."""
    sets = work.select("slide", "mask_fraction", F.explode(F.array("stratum", F.lit(None).cast("string"))).alias("stratum"))
    return sets.groupBy("slide", "stratum").agg(F.count(F.lit(1)).alias("n"), F.avg("mask_fraction").alias("mean"), F.percentile("mask_fraction", 0.95).alias("p95"))


def warnings(positive: Column, mixed: Column, tissue: Column) -> Column:
    """What a sample lacks: positive blocks, mixed or tissue ones, and highly positive ones (which is what tissue is)."""
    lacks = {"no_positive_any_blocks_selected": positive == 0, "no_mixed_or_tissue_blocks_selected": (mixed == 0) & (tissue == 0), "no_high_positive_blocks_selected": tissue == 0}
    return F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in lacks.items()]))


def sample_warnings(picked: DataFrame, by: list[str]) -> DataFrame:
    """(by..., warnings) of sampled blocks with mask_fraction and stratum, joined by ;."""
    n = picked.groupBy(*by).agg(F.count_if(F.col("mask_fraction") > 0).alias("p"), F.count_if(F.col("stratum").startswith("mixed")).alias("m"), F.count_if(F.col("stratum") == "tissue").alias("t"))
    return n.select(*by, F.array_join(warnings(F.col("p"), F.col("m"), F.col("t")), ";").alias("warnings"))
