"""Validation and planning of submission batches: issue tables, roll-ups, estimates, job plans.

A manifest is rows (row_number, specimen_id, slide_id, source_path, size_bytes and any others).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tessera.functions import naming

REQUIRED = ["slide_id", "source_path", "specimen_id"]

# Phases, severities, statuses, categories and codes of batches; and of each requirement that a profile can
# make: key, other names of it, phase by default, columns that meet it, field, code while deferred, code when missing.
NOW = "preflight_manifest"
AT_SOURCE = "source_file_preflight"
ROW_REQUIREMENTS = [
    ("physical_pixel_size", ["physical_pixel_size_x", "physical_pixel_size_y"], "source_metadata_validation", ["physical_pixel_size_x", "physical_pixel_size_y"], "physical_pixel_size", "DEFERRED_SOURCE_PIXEL_SIZE", "MISSING_SOURCE_PIXEL_SIZE"),
    ("physical_units", ["physical_pixel_size_unit", "units"], "source_metadata_validation", ["physical_pixel_size_unit"], "physical_pixel_size_unit", "DEFERRED_SOURCE_UNITS", "MISSING_SOURCE_UNITS"),
    ("channel_metadata", [], "source_metadata_validation", [], "channel_metadata", "DEFERRED_SOURCE_CHANNEL_METADATA", "MISSING_SOURCE_CHANNEL_METADATA"),
    ("parent_source_checksum", ["checksum", "source_checksum"], "source_metadata_validation", ["checksum"], "checksum", "DEFERRED_SOURCE_CHECKSUM", "MISSING_SOURCE_CHECKSUM"),
    ("crop_bounds_parent_pixels", ["parent_crop_bounds"], "derivative_export", [], "crop_bounds_parent_pixels", "DEFERRED_DERIVATIVE_PROVENANCE", "MISSING_DERIVATIVE_PROVENANCE"),
    ("child_array_to_physical_transform", ["array_to_physical_transform"], "derivative_export", [], "child_array_to_physical_transform", "DEFERRED_DERIVATIVE_PROVENANCE", "MISSING_DERIVATIVE_PROVENANCE"),
]
BATCH_REQUIREMENTS = [
    ("ome_metadata_validation", ["ome_xml", "ometiff_validation"], "upload_validation", [], "ome_metadata_validation", "DEFERRED_OME_METADATA_VALIDATION", "MISSING_OME_METADATA_VALIDATION"),
    ("sidecar_consistency", ["validate_sidecar_consistency"], "upload_validation", [], "sidecar_consistency", "DEFERRED_UPLOAD_VALIDATION", "MISSING_UPLOAD_VALIDATION"),
    ("output_checksums", ["validate_checksums", "emit_checksums"], "upload_validation", [], "output_checksums", "DEFERRED_UPLOAD_CHECKSUM_VALIDATION", "MISSING_UPLOAD_CHECKSUM_VALIDATION"),
    ("tissue_detection_qc", ["qc_overlay"], "derivative_export", [], "tissue_detection_qc", "DEFERRED_TISSUE_DETECTION_QC", "MISSING_TISSUE_DETECTION_QC"),
]
ERROR, WARNING, DEFERRED = "error", "warning", "deferred"
FAILED, PASSED, PASSED_WITH_DEFERRED, PASSED_WITH_WARNINGS = "PREFLIGHT_FAILED", "PREFLIGHT_PASSED", "PREFLIGHT_PASSED_WITH_DEFERRED_REQUIREMENTS", "PREFLIGHT_PASSED_WITH_WARNINGS"
BLOCKED, NO_PATH, NONLOCAL, WAITS, ELIGIBLE = "BLOCKED_BY_PREFLIGHT_ERROR", "SKIPPED_UNSUPPORTED_OR_UNKNOWN", "SKIPPED_NONLOCAL_SOURCE", "DEFERRED_SOURCE_METADATA", "ELIGIBLE_FOR_TISSUE_DETECTION"
PLAN_READY, PLAN_DEFERRED, PLAN_BLOCKED, PLAN_EMPTY = "TISSUE_PLAN_READY", "TISSUE_PLAN_READY_WITH_DEFERRED_REQUIREMENTS", "TISSUE_PLAN_BLOCKED", "TISSUE_PLAN_EMPTY"

_ISSUES = "field string, code string, severity string, phase string"


def blank(c: Column) -> Column:
    return c.isNull() | (F.btrim(c.cast("string")) == "")


def value(c: Column) -> Column:
    """A cell without the blanks around it; null if nothing is left."""
    return F.when(~blank(c), F.btrim(c.cast("string")))


def identifier(specimen: Column, slide: Column) -> Column:
    """specimen/slide; null unless both are there."""
    return F.when(~blank(specimen) & ~blank(slide), F.concat_ws("/", value(specimen), value(slide)))


def remote(path: Column) -> Column:
    """Whether a source has a scheme other than file: it is not looked for, and not planned for here."""
    scheme = F.lower(F.regexp_extract(path, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1))
    return F.coalesce((scheme != "") & (scheme != "file"), F.lit(False))


def first_rows(manifest: DataFrame) -> DataFrame:
    """manifest with first_row: the first row of the same specimen and slide; keys that are blank never match."""
    specimen, slide = value(F.col("specimen_id")), value(F.col("slide_id"))
    w = W.partitionBy(specimen, slide).orderBy("row_number")
    return manifest.withColumn("first_row", F.when(specimen.isNull() | slide.isNull(), F.col("row_number")).otherwise(F.first("row_number").over(w)))


def _issue(test: Column, field: Column, code: str, severity: str, phase: str) -> Column:
    parts = zip((field, F.lit(code), F.lit(severity), F.lit(phase)), _ISSUES.split(", "), strict=True)
    return F.when(test, F.struct(*[c.alias(n.split()[0]) for c, n in parts]))


def _requirement(spec: tuple, phases: dict[str, str], columns: list[str]) -> Column | None:
    """The issue of an enabled requirement: an error if it is due in this phase, else deferred; none where its columns are filled."""
    key, others, default, fields, field, deferred, missing = spec
    phase = next((phases[k] for k in (key, *others) if k in phases), default)
    lacking = [F.when(blank(F.col(c)), F.lit(c)) if c in columns else F.lit(c) for c in fields]
    names = F.concat_ws(", ", *lacking) if fields else F.lit(field)
    return _issue(names != "", names, missing if phase == NOW else deferred, ERROR if phase == NOW else DEFERRED, phase)


def issues(manifest: DataFrame, extensions: list[str], existing: DataFrame | None = None, required: list[str] = (), phases: dict[str, str] | None = None) -> DataFrame:
    """(row_number, field, code, severity, phase): one row for each issue of each manifest row.

    existing (source_path): local files that are there; none given, existence is not asked for. required: keys of the row
    requirements that the profile makes; phases: when they have to be met, by key or other name, else their own phase.
    """
    m = first_rows(manifest)
    path = value(F.col("source_path"))
    found = [_issue(blank(F.col(c)), F.lit(c), "MISSING_REQUIRED_FIELD", ERROR, NOW) for c in REQUIRED]
    found.append(_issue(F.col("first_row") < F.col("row_number"), F.lit("specimen_id,slide_id"), "DUPLICATE_SOURCE_SLIDE_IDENTIFIER", WARNING, NOW))
    found.append(_issue(path.isNotNull() & ~naming.accepted(path, extensions), F.lit("source_path"), "DISALLOWED_SOURCE_EXTENSION", ERROR, AT_SOURCE))
    if existing is not None:
        there = existing.select(F.col("source_path").alias("there_path")).distinct()
        m = m.join(there, path == F.col("there_path"), "left")
        found.append(_issue(path.isNotNull() & ~remote(path) & F.col("there_path").isNull(), F.lit("source_path"), "MISSING_LOCAL_SOURCE", ERROR, AT_SOURCE))
    found.append(_issue(path.isNotNull() & remote(path), F.lit("source_path"), "DEFERRED_NON_LOCAL_SOURCE_EXISTENCE", DEFERRED, AT_SOURCE))
    found += [_requirement(spec, phases or {}, manifest.columns) for spec in ROW_REQUIREMENTS if spec[0] in required]
    rows = m.select("row_number", F.explode(F.array_compact(F.array(*found))).alias("i"))
    return rows.select("row_number", "i.field", "i.code", "i.severity", "i.phase")


def batch_issues(spark: SparkSession, required: list[str], phases: dict[str, str] | None = None) -> DataFrame:
    """issues of the batch as a whole: row_number is null."""
    found = [_requirement(spec, phases or {}, []) for spec in BATCH_REQUIREMENTS if spec[0] in required]
    rows = spark.range(1).select(F.explode(F.array(*found) if found else F.array().cast(f"array<struct<{_ISSUES.replace(' ', ':').replace(',:', ',')}>>")).alias("i"))
    return rows.select(F.lit(None).cast("long").alias("row_number"), "i.field", "i.code", "i.severity", "i.phase")


def status(errors: Column, deferred: Column, warnings: Column) -> Column:
    return F.when(errors > 0, FAILED).when(deferred > 0, PASSED_WITH_DEFERRED).when(warnings > 0, PASSED_WITH_WARNINGS).otherwise(PASSED)


def row_status(manifest: DataFrame, found: DataFrame) -> DataFrame:
    """(row_number, valid, status) of every row."""
    n = found.groupBy("row_number").agg(*[F.count_if(F.col("severity") == s).alias(s) for s in (ERROR, DEFERRED, WARNING)])
    n = manifest.select("row_number").join(n, "row_number", "left").fillna(0, [ERROR, DEFERRED, WARNING])
    return n.select("row_number", (F.col(ERROR) == 0).alias("valid"), status(F.col(ERROR), F.col(DEFERRED), F.col(WARNING)).alias("status"))


def rollup(manifest: DataFrame, found: DataFrame) -> DataFrame:
    """One row: counts of rows and issues (of rows and of the batch) by severity, rows that have one of each, status."""
    n = manifest.agg(F.count(F.lit(1)).alias("n_rows"))
    counts = [F.count_if(F.col("severity") == s).alias(f"n_{s}") for s in (ERROR, DEFERRED, WARNING)]
    rows = [F.countDistinct(F.when(F.col("severity") == s, F.col("row_number"))).alias(f"rows_{s}") for s in (ERROR, DEFERRED, WARNING)]
    both = n.crossJoin(found.agg(*counts, *rows))  # one row by one row
    valid = (F.col("n_rows") - F.col("rows_error")).alias("valid_rows")
    return both.select("*", valid, status(F.col("n_error"), F.col("n_deferred"), F.col("n_warning")).alias("status"))


# Factors of output size and seconds for each GB of input, by mode.
OUTPUT = {"extract": (0.25, 1.5), "single": (0.75, 1.5), "existing": (1.0, 1.0)}
SECONDS = {"extract": (900.0, 3600.0), "single": (300.0, 1800.0), "existing": (0.0, 0.0)}


def setup_estimate(manifest: DataFrame, mode: str, by: list[str], mbps: float = 100.0, overhead: float = 1.25) -> DataFrame:
    """Ranges of output bytes, and of processing, upload and total seconds, of each batch; all null if any size is unknown."""
    known = F.count_if(F.col("size_bytes").isNull()) == 0
    total = F.when(known, F.sum("size_bytes").cast("double"))
    out = manifest.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("size_bytes").isNull()).alias("unknown"), total.alias("input"))
    columns = {}
    for end, k, whole in (("low", 0, F.floor), ("high", 1, F.ceil)):
        size = whole(F.col("input") * OUTPUT[mode][k])
        work, send = F.col("input") / 1e9 * SECONDS[mode][k], size * 8.0 / (mbps * 1e6) * overhead
        columns |= {f"output_{end}": size, f"seconds_{end}": work, f"upload_{end}": send, f"total_{end}": work + send}
    return out.select(*by, "n_rows", "unknown", *[c.alias(n) for n, c in columns.items()])


def plan(manifest: DataFrame, found: DataFrame, batch: str) -> DataFrame:
    """Every row's category, the first that applies: blocked, no path, not local, or a job, deferred or eligible."""
    sev = found.groupBy("row_number").agg(F.bool_or(F.col("severity") == ERROR).alias("has_error"), F.bool_or(F.col("severity") == DEFERRED).alias("has_deferred"))
    m = manifest.join(sev, "row_number", "left")
    path = value(F.col("source_path"))
    category = (
        F.when(F.coalesce("has_error", F.lit(False)), BLOCKED).when(path.isNull(), NO_PATH).when(remote(path), NONLOCAL)
        .when(F.coalesce("has_deferred", F.lit(False)), WAITS).otherwise(ELIGIBLE)
    )
    job = naming.job_id(F.lit(batch), F.col("row_number"), identifier(F.col("specimen_id"), F.col("slide_id")), path)
    return m.withColumn("category", category).select("row_number", "category", F.when(F.col("category").isin(WAITS, ELIGIBLE), job).alias("job_id"))


def plan_status(planned: DataFrame, by: list[str] = ()) -> DataFrame:
    """Counts by category and the status of each plan (of all rows together if by is empty).

    A plan with jobs is ready, with deferred requirements unless every row is an eligible job; one without is blocked if
    all its rows are, else empty.
    """
    n = lambda *c: F.count_if(F.col("category").isin(*c))
    counts = [F.count(F.lit(1)).alias("n_rows"), n(BLOCKED).alias("blocked"), n(NO_PATH, NONLOCAL).alias("skipped"), n(WAITS, NONLOCAL).alias("deferred"), n(WAITS, ELIGIBLE).alias("jobs")]
    out = planned.groupBy(*by).agg(*counts)
    ready = F.when((F.col("blocked") == 0) & (F.col("skipped") == 0) & (F.col("deferred") == 0), PLAN_READY).otherwise(PLAN_DEFERRED)
    rest = F.when((F.col("n_rows") > 0) & (F.col("blocked") == F.col("n_rows")), PLAN_BLOCKED).otherwise(PLAN_EMPTY)
    return out.withColumn("status", F.when(F.col("jobs") > 0, ready).otherwise(rest))


def batch_id(profile: Column, manifest_path: Column) -> Column:
    """preflight-, the profile's name in safe small letters, and 8 hex digits of the sha256 of profile|path."""
    slug = F.lower(F.regexp_replace(F.regexp_replace(profile, "[^a-zA-Z0-9_.-]+", "-"), "^-+|-+$", ""))
    return F.concat(F.lit("preflight-"), slug, F.lit("-"), F.substring(F.sha2(F.concat_ws("|", profile, manifest_path), 256), 1, 8))
