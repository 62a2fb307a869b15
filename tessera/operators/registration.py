"""Planning and summaries around the registration of stacks: entries, presence, resolutions, sweeps, orientation codes."""

from __future__ import annotations

from itertools import permutations, product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Statuses that mean that a slice is there, and the ladder of a sweep with its stress test.
PRESENT = ("present", "true", "1")
LADDER, STRESS = (5e3, 1e4, 2e4, 5e4, 1e5), (2e5,)
#: The three pairs of directions that a code takes one letter of each from, in any order.
PAIRS = (("R", "L"), ("A", "P"), ("S", "I"))
CODES = {"".join(c): None for p in permutations(PAIRS) for c in product(*p)}


def entry_present(present: Column, status: Column) -> Column:
    """The flag if there is one, else whether the status says so."""
    return F.coalesce(present, F.lower(F.btrim(F.coalesce(status, F.lit("")))).isin(*PRESENT))


def entry_name(place: Column, path: Column, *names: Column) -> Column:
    """The first name that is not empty, else the path's stem, else slice_%04d."""
    filled = [F.nullif(c.cast("string"), F.lit("")) for c in names]
    stem = F.regexp_replace(F.element_at(F.split(F.nullif(path, F.lit("")), "/"), -1), r"(?<=.)\.[^.]*$", "")
    return F.coalesce(*filled, stem, F.format_string("slice_%04d", place.cast("int")))


def with_entries(transforms: DataFrame, entries: DataFrame) -> DataFrame:
    """transforms (run, place) with present, sample_id and status of the run's entries, by place.

    Where a run has another number of entries than of transforms, all its slices count as present and get made-up names.
    entries: run, place, present, status, path, sample_id, section_id, source_id, name.
    """
    n = transforms.groupBy("run").agg(F.count(F.lit(1)).alias("n_t")).join(entries.groupBy("run").agg(F.count(F.lit(1)).alias("n_e")), "run", "left")
    fits = n.select("run", (F.coalesce("n_e", F.lit(0)) == F.col("n_t")).alias("fits"))
    there = entry_present(F.col("present"), F.col("status"))
    name = entry_name(F.col("place"), F.col("path"), F.col("sample_id"), F.col("section_id"), F.col("source_id"), F.col("name"))
    e = entries.select("run", "place", there.alias("e_there"), name.alias("e_name"), F.coalesce("status", F.when(there, "present").otherwise("missing")).alias("e_status"))
    t = transforms.join(fits, "run").join(e, ["run", "place"], "left")
    made = F.format_string("slice_%04d", F.col("place").cast("int"))
    pick = lambda c, other: F.when(F.col("fits"), F.col(c)).otherwise(other)
    return t.select(*transforms.columns, pick("e_there", F.lit(True)).alias("present"), pick("e_name", made).alias("sample_id"), pick("e_status", F.lit("unknown")).alias("status"))


def onto_grid(dense: DataFrame, entries: DataFrame) -> DataFrame:
    """(run, grid_index, present, value...) of every place of the grid: dense slices (run, rank, ...) at the places of their rank."""
    keep = [c for c in dense.columns if c not in ("run", "rank")]
    e = entries.select("run", "grid_index", F.col("present_rank").alias("rank"))
    out = e.join(dense, ["run", "rank"], "left")
    return out.select("run", "grid_index", F.col("rank").isNotNull().alias("present"), *keep)


def sweep_label(x: Column) -> Column:
    """eA2d_5e3 of 5000: up to six decimals without the zeros at their end, p for the point, m for minus."""
    text = F.format_string("%.6e", F.abs(x.cast("double")))
    mantissa = F.regexp_replace(F.regexp_replace(F.regexp_extract(text, r"^([0-9.]+)e", 1), r"0+$", ""), r"\.$", "")
    power = F.regexp_extract(text, r"e([+-]\d+)$", 1).cast("int").cast("string")
    body = F.concat(F.when(x < 0, "m").otherwise(""), F.replace(mantissa, F.lit("."), F.lit("p")), F.lit("e"), power)
    return F.concat(F.lit("eA2d_"), F.when(x == 0, "0").otherwise(body))


def sweep_summary(runs: DataFrame) -> DataFrame:
    """runs with nested diagnostics as flat rows. runs: label, status, eA2d, diagnostics (translation_um, translation_working_pixels, ...)."""
    d = "diagnostics"
    stat = lambda a, b: F.col(f"{d}.{a}.{b}")
    columns = {f"{k}_translation_{unit}": stat(name, k) for unit, name in (("um", "translation_um"), ("px", "translation_working_pixels")) for k in ("median", "p95", "max")}
    columns |= {"p95_rotation_abs_deg": stat("rotation_abs_deg", "p95"), "p95_linear_frobenius": F.col(f"{d}.linear_deviation.frobenius.p95")}
    return runs.select("label", F.coalesce("eA2d", f"{d}.eA2d").alias("eA2d"), "status", *[c.alias(n) for n, c in columns.items()])


def valid_orientation(code: Column) -> Column:
    """The code in capitals if it names one direction of each axis, else null."""
    c = F.upper(F.btrim(F.coalesce(code, F.lit(""))))
    return F.when(c.isin(*CODES), c)


def orientation_matrix(a: Column, b: Column) -> Column:
    """Nine numbers, row by row, of the signed permutation that takes axes in orientation a to orientation b; null for wrong codes."""
    index = lambda c: F.lit(0) + sum((F.when(c.isin(*p), k).otherwise(0) for k, p in enumerate(PAIRS)), F.lit(0))
    at = lambda code, i: F.substring(valid_orientation(code), i + 1, 1)
    cells = []
    for i in range(3):
        for j in range(3):
            same = index(at(b, i)) == index(at(a, j))
            cells.append(F.when(same, F.when(at(b, i) == at(a, j), 1.0).otherwise(-1.0)).otherwise(0.0))
    return F.when(valid_orientation(a).isNotNull() & valid_orientation(b).isNotNull(), F.array(*cells))


def target_resolution(axis: Column, spacing: Column, desired: float) -> Column:
    """Of a sectioned stack: axis 0 keeps its own spacing."""
    return F.when(axis == 0, spacing).otherwise(F.lit(float(desired)))


def pre_resampling(axes: DataFrame, policy: str) -> DataFrame:
    """(id, locked, unchanged): axes kept by the policy, and those where the atlas is already as coarse as the target, joined by commas.

    axes: id, axis, target_working, atlas_native, atlas_factor.
    """
    locked = F.lit(policy == "sectioned-stack") & (F.col("axis") == 0)
    same = ~locked & (F.col("atlas_native") >= F.col("target_working")) & (F.col("atlas_factor") == 1)
    names = lambda test: F.array_join(F.transform(F.sort_array(F.collect_list(F.when(test, F.col("axis")))), lambda x: x.cast("string")), ",")  # noqa: E731  three axes
    return axes.groupBy("id").agg(names(locked).alias("locked"), names(same).alias("unchanged"))


def joint_range(pairs: DataFrame, key: str, a: str, b: str) -> DataFrame:
    """(key, lo, hi): the 1st and 99th percentile of the finite values of both columns, or their ends if those are equal; null if flat."""
    v = pairs.select(key, F.explode(F.array(F.col(a).cast("double"), F.col(b).cast("double"))).alias("v")).filter(~F.isnan("v") & (F.abs("v") != float("inf")))
    s = v.groupBy(key).agg(F.percentile("v", F.array(F.lit(0.01), F.lit(0.99))).alias("p"), F.min("v").alias("low"), F.max("v").alias("high"))
    wide = F.get("p", F.lit(1)) > F.get("p", F.lit(0))
    lo = F.when(wide, F.get("p", F.lit(0))).when(F.col("high") > F.col("low"), F.col("low"))
    hi = F.when(wide, F.get("p", F.lit(1))).when(F.col("high") > F.col("low"), F.col("high"))
    return s.select(key, lo.alias("lo"), hi.alias("hi"))


def stretch(v: Column, lo: Column, hi: Column) -> Column:
    """To 0..1 between lo and hi, cut off outside; 0 where there is no range."""
    return F.coalesce(F.least(F.greatest((v - lo) / (hi - lo), F.lit(0.0)), F.lit(1.0)), F.lit(0.0))


def contrast_anchors(values: DataFrame, key: str, value: str) -> DataFrame:
    """(key, mu_b, mu_a): the least value and the 0.999 quantile."""
    return values.groupBy(key).agg(F.min(value).cast("double").alias("mu_b"), F.percentile(value, 0.999).alias("mu_a"))


def auto_threshold(values: DataFrame, key: str, value: str) -> DataFrame:
    """(key, level): the 5th percentile of the positive finite values, else the median of the finite ones."""
    v = F.when(~F.isnan(F.col(value).cast("double")) & (F.abs(F.col(value)) != float("inf")), F.col(value).cast("double"))
    return values.groupBy(key).agg(F.coalesce(F.percentile(F.when(v > 0, v), 0.05), F.percentile(v, 0.5)).alias("level"))
