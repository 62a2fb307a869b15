"""Operators on ordered stacks: gaps, z grids, fills, transforms and their statistics.

Columns: stack (the series), idx (integer place). Windows are partitioned by the series.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W


def gaps(present: DataFrame, step: int = 1, start: int = 1, symmetric: bool = False) -> DataFrame:
    """(stack, idx, status): expected places start, start + step, ... up to the largest one, present or missing.

    symmetric also gives a second, `missing`, row to places that are present but not expected.
    """
    have = present.select("stack", F.col("idx").cast("long").alias("idx")).distinct()
    last = have.groupBy("stack").agg(F.max("idx").alias("last"))
    expected = last.filter(F.col("last") >= start).select("stack", F.explode(F.sequence(F.lit(start).cast("long"), F.col("last"), F.lit(step).cast("long"))).alias("idx"))
    missing = expected.join(have, ["stack", "idx"], "left_anti")
    if symmetric:
        missing = missing.unionByName(have.join(expected, ["stack", "idx"], "left_anti"))
    return have.withColumn("status", F.lit("present")).unionByName(missing.withColumn("status", F.lit("missing")))


def z_grid(slices: DataFrame, default_step: float = 10.0) -> DataFrame:
    """slices (stack, idx, z, null where not present) with grid_index, present_rank and a z for every place.

    The step is the median of dz / didx between present neighbours, the origin first z - its grid_index * step.
    """
    by = W.partitionBy("stack")
    seen = slices.filter("z IS NOT NULL")
    w = by.orderBy("idx")
    ratio = (F.col("z") - F.lag("z").over(w)) / (F.col("idx") - F.lag("idx").over(w))
    steps = seen.select("stack", "idx", "z", ratio.alias("ratio")).groupBy("stack").agg(
        F.coalesce(F.median("ratio"), F.lit(default_step)).alias("step"), F.min_by("z", "idx").alias("z0"), F.min("idx").alias("i0")
    )
    ranks = seen.select("stack", "idx", (F.row_number().over(w) - 1).alias("present_rank"))
    out = slices.join(ranks, ["stack", "idx"], "left").join(steps, "stack", "left")
    first = F.min("idx").over(by)
    fallback = F.coalesce("step", F.lit(default_step))
    base = F.coalesce(F.col("z0") - (F.col("i0") - first) * fallback, F.lit(0.0))
    return out.select("stack", "idx", (F.col("idx") - first).cast("long").alias("grid_index"), F.col("present_rank").cast("long").alias("present_rank"), (base + (F.col("idx") - first) * fallback).alias("z"))


def fill(series: DataFrame, how: str = "linear", at: str = "idx") -> DataFrame:
    """series (stack, idx, value) with nulls between observed neighbours filled: linear in column `at`, or nearest (left if p <= 0.5).

    `at` rises with idx: the place itself, or a z position where steps are uneven. Both windows run forward, each over its
    own order, so that a stack costs its length.
    """
    before = W.partitionBy("stack").orderBy("idx").rowsBetween(W.unboundedPreceding, 0)
    after = W.partitionBy("stack").orderBy(F.desc("idx")).rowsBetween(W.unboundedPreceding, 0)
    seen = F.when(F.col("value").isNotNull(), F.struct(F.col(at).alias("i"), F.col("value").alias("v")))
    df = series.select("stack", "idx", F.col(at).alias("at"), "value", F.last(seen, ignorenulls=True).over(before).alias("a"), F.last(seen, ignorenulls=True).over(after).alias("b"))
    span = (F.col("b.i") - F.col("a.i")).cast("double")
    p = F.when(span == 0, F.lit(0.0)).otherwise((F.col("at") - F.col("a.i")) / F.when(span != 0, span))
    filled = F.when(p <= 0.5, F.col("a.v")).otherwise(F.col("b.v")) if how == "nearest" else F.col("a.v") + p * (F.col("b.v") - F.col("a.v"))
    return df.select("stack", "idx", F.coalesce("value", filled).alias("value"), F.col("value").isNull().alias("filled"))


def downsampling(requested: Column, spacing: Column, locked: Column | None = None) -> Column:
    """max(1, round half even(requested / spacing)); 1 where locked or without spacing."""
    k = F.when(spacing > 0, F.greatest(F.lit(1), F.rint(requested / spacing).cast("long"))).otherwise(F.lit(1))
    return k if locked is None else F.when(locked, F.lit(1)).otherwise(k)


def transform_metrics(transforms: DataFrame, um_y: float = 1.0, um_x: float = 1.0) -> DataFrame:
    """Of 2 x 3 affines a (arrays of 6, row by row): translation, rotation, deviation from identity, determinant."""
    a = [F.col("a")[k] for k in range(6)]
    dev = [a[0] - 1, a[1], a[2], a[3], a[4] - 1, a[5]]
    square, most = F.lit(0.0), F.lit(0.0)
    for d in dev:
        square, most = square + d * d, F.greatest(most, F.abs(d))
    return transforms.withColumns({
        "translation_um": F.sqrt(a[2] * a[2] + a[5] * a[5]),
        "translation_px": F.sqrt(F.pow(a[2] / um_y, 2) + F.pow(a[5] / um_x, 2)),
        "rotation_deg": F.degrees(F.atan2(a[3], a[0])),
        "frobenius": F.sqrt(square),
        "max_abs": most,
        "det": a[0] * a[4] - a[1] * a[3],
        "identity": most <= 1e-6,
    })


def top_moved(metrics: DataFrame, n: int, partition: str = "run") -> DataFrame:
    """The n largest translations of each run, ties by index."""
    r = F.row_number().over(W.partitionBy(partition).orderBy(F.desc("translation_um"), "idx"))
    return metrics.withColumn("rank", r).filter(F.col("rank") <= n)


def nan_stats(df: DataFrame, key: str, value: str) -> DataFrame:
    """count, median, p95, max, mean of the finite values; nulls where there are none."""
    v = F.when(~F.isnan(value) & (F.abs(F.col(value)) != float("inf")), F.col(value))
    return df.groupBy(key).agg(
        F.count(v).alias("n"), F.median(v).alias("median"), F.percentile(v, 0.95).alias("p95"), F.max(v).alias("max"), F.avg(v).alias("mean")
    )


def abs_diff_stats(df: DataFrame, key: str, a: str, b: str) -> DataFrame:
    d = F.abs(F.col(a) - F.col(b))
    return df.groupBy(key).agg(
        F.avg(d).alias("mean"), F.median(d).alias("median"), F.percentile(d, 0.95).alias("p95"), F.max(d).alias("max"),
        F.sqrt(F.avg(d * d)).alias("rms"), F.avg((d > 1e-6).cast("double")).alias("nonzero"),
    )


def axis_spacing(axes: DataFrame) -> DataFrame:
    """(axis, spacing): the median distance of neighbours; 0 for an axis of fewer than two points."""
    w = W.partitionBy("axis").orderBy("idx")
    d = axes.select("axis", F.abs(F.col("value") - F.lag("value").over(w)).alias("d"))
    return d.groupBy("axis").agg(F.coalesce(F.median("d"), F.lit(0.0)).alias("spacing"))


def bottleneck(rows: DataFrame) -> DataFrame:
    """Of benchmark rows (mode, seq, seconds): each mode's fastest run, first on ties."""
    return rows.groupBy("mode").agg(F.min_by(F.struct("seconds", "seq"), F.struct("seconds", "seq")).alias("m"), F.count(F.lit(1)).alias("runs")).select("mode", "m.seconds", "m.seq", "runs")


# The modes and codecs that the rules compare, the labels of bottlenecks, and the thresholds.
WHOLE, DIRECT, DIRECT_ONE_LEVEL, REPLAY = "materialized-source-crop-write", "direct-ets-rgb-plus-mask-mips", "direct-ets-rgb-plus-mask-no-mips", "replay-cached-rgb-blocks-write"
ZEROS, RANDOM, READ_ONLY = "synthetic-zero-write", "synthetic-random-write", "ets-read-only"
DEEP, QUICK = "zstd-5-bitshuffle", "lz4-byte-shuffle"
INCONCLUSIVE = "inconclusive"


def bottleneck_verdict(rows: DataFrame, by: list[str] = ()) -> DataFrame:
    """The eight rules on benchmark rows, for each group: booleans, the labels of those that hold in their order, the first as verdict.

    rows: seq, mode, codec, skipped, elapsed_s, blocks_per_sec, downsample_s, write_s, repeated_decode, alignment_win. Of a
    mode its fastest row counts, the one of least seq on ties; missing numbers count as 0; one pass over the rows.
    """
    used = ~F.coalesce("skipped", F.lit(False))
    fastest = lambda m: F.min_by(F.struct("elapsed_s", "blocks_per_sec", "downsample_s", "write_s"), F.when(used & (F.col("mode") == m), F.struct(F.coalesce("elapsed_s", F.lit(float("inf"))), "seq"))).alias(m)
    direct = used & F.col("mode").contains("direct-ets")
    least = lambda codec: F.min(F.when(direct & (F.col("codec") == codec), F.coalesce("elapsed_s", F.lit(0.0)))).alias(codec)
    most = lambda c: F.coalesce(F.max(F.when(used, F.col(c))), F.lit(0.0)).alias(c)
    modes = (WHOLE, DIRECT, DIRECT_ONE_LEVEL, REPLAY, ZEROS, RANDOM, READ_ONLY)
    g = rows.groupBy(*by).agg(*map(fastest, modes), least(DEEP), least(QUICK), most("repeated_decode"), most("alignment_win"))

    def of(mode: str, field: str) -> Column:
        """A number of the fastest row; 0 if it has none; null without such a row."""
        return F.when(F.col(f"`{mode}`").isNotNull(), F.coalesce(F.col(f"`{mode}`.{field}"), F.lit(0.0)))

    def ratio(a: Column, b: Column, least: float) -> Column:
        return F.coalesce(a / F.when(b > 0, b) >= least, F.lit(False))

    some = lambda test: F.coalesce(test, F.lit(False))
    levels = ratio(of(DIRECT, "elapsed_s"), of(DIRECT_ONE_LEVEL, "elapsed_s"), 1.25)
    writes = levels & (of(DIRECT, "write_s") >= of(DIRECT, "downsample_s"))
    rules = {
        "materialized_much_faster_than_direct": ratio(of(DIRECT, "elapsed_s"), of(WHOLE, "elapsed_s"), 1.5),
        "synthetic_replay_writes_slow": some((of(REPLAY, "blocks_per_sec") < 5.0) & (of(RANDOM, "blocks_per_sec") < 5.0) & (F.coalesce(of(ZEROS, "blocks_per_sec"), F.lit(0.0)) < 20.0)),
        "no_mips_much_faster_than_mips": levels,
        "pyramid_write_path_dominates_downsample": writes,
        "zstd5_much_slower_than_lz4": ratio(F.col(f"`{DEEP}`"), F.col(f"`{QUICK}`"), 1.25),
        "ets_read_fast_direct_slow": some(of(READ_ONLY, "blocks_per_sec") > of(DIRECT, "blocks_per_sec") * 1.5),
        "repeated_decode_factor_high": F.col("repeated_decode") >= 2.0,
        "potential_alignment_win_high": F.col("alignment_win") >= 1.75,
    }
    labels = [
        ("materialized_much_faster_than_direct", "ETS decode/access/redecode"), ("synthetic_replay_writes_slow", "writer/compression/filesystem"),
        ("pyramid_write_path_dominates_downsample", "pyramid write path"), (None, "pyramid downsampling"), ("zstd5_much_slower_than_lz4", "compression"),
        ("ets_read_fast_direct_slow", "block assembly/scheduling/writer interaction"), ("repeated_decode_factor_high", "missing ETS tile cache candidate"),
        ("potential_alignment_win_high", "source-tile-aligned canvas candidate"),
    ]
    g = g.select(*by, *[c.alias(n) for n, c in rules.items()])
    down = F.col("no_mips_much_faster_than_mips") & ~F.col("pyramid_write_path_dominates_downsample")
    found = F.array_compact(F.array(*[F.when(F.col(rule) if rule else down, F.lit(text)) for rule, text in labels]))
    return g.withColumn("candidates", F.array_join(found, ";")).withColumn("top", F.coalesce(F.get(found, F.lit(0)), F.lit(INCONCLUSIVE)))
