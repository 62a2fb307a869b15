"""Checks of batches by workflow mode: input types, files of existing images, statuses, next steps, exit codes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.submission import DEFERRED, ERROR, remote, value

# Suffixes, codes and texts.
OME = (".ome.tif", ".ome.tiff")
TIFF = (".tif", ".tiff")
MODES = ("existing-ometiff-upload", "convert-single-tissue", "extract-tissues")
ACTIONS = {
    "errors": "Fix blocking manifest/path/profile/mode errors before continuing.",
    "strict": "Resolve warnings or deferred requirements, or rerun setup without strict mode.",
    "not_ready": "Resolve setup findings before continuing.",
    "existing-ometiff-upload": "Ready for OME-TIFF validation/package/upload follow-up.",
    "convert-single-tissue": "Ready for future single-tissue conversion step; source metadata will be validated during conversion.",
    "extract-tissues": "Ready for future tissue detection stage; estimates are coarse until detection runs.",
}
STRUCTURE = [
    ("fix_structural_issues", "Fix blocking filesystem/manifest issues before continuing."),
    ("ome_tiff_metadata_validation", "Run future OME-TIFF metadata validation before packaging/upload."),
    ("resolve_warnings_or_deferred_checks", "Resolve warnings or deferred checks, or rerun without strict mode."),
    ("resolve_deferred_checks", "Resolve deferred checks before packaging/upload."),
    ("review_warnings", "Review warnings before future package planning."),
    ("package_planning", "Ready for future package planning after required metadata validation policy is satisfied."),
]


def target(source: Column) -> Column:
    """What a suffix is looked for in: the path of a URL, or the value itself, in small letters."""
    path = F.regexp_extract(source, r"^[A-Za-z][A-Za-z0-9+.-]*:(?://[^/?#]*)?([^?#]*)", 1)
    return F.lower(F.when(path != "", F.coalesce(F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), path)).otherwise(source))


def suffix(source: Column) -> Column:
    """The last suffix of the name, with its dot; empty without one."""
    name = F.element_at(F.split(F.rtrim(target(source), F.lit("/")), "/"), -1)
    return F.regexp_extract(name, r"[^.](\.[^.]+)$", 1)


def ends(source: Column, names) -> Column:
    out = F.lit(False)
    for n in names:
        out = out | target(source).endswith(n.lower())
    return out


def extensions_of(mode: str, by_mode: dict[str, list[str]], otherwise: list[str]) -> list[str]:
    """The inputs that a profile accepts in a mode."""
    return by_mode.get(mode, otherwise)


def mode_code(source: Column, mode: str, accepted: list[str]) -> Column:
    """The code of a row whose input does not fit the workflow mode; null where it does, or where there is no path."""
    path = value(source)
    ome = ends(path, OME)
    known = ends(path, accepted)
    if mode == "existing-ometiff-upload":
        generic = suffix(path).isin(*TIFF) & suffix(path).isin(*[e.lower() for e in accepted])
        bad = F.when(known | suffix(path).isin(".vsi", ".ets"), "WRONG_MODE_FOR_OMETIFF_UPLOAD").otherwise("MODE_INPUT_EXTENSION_MISMATCH")
        return F.when(path.isNotNull() & ~(ome | generic), bad)
    wrong = "WRONG_MODE_FOR_SOURCE_CONVERSION" if mode == "convert-single-tissue" else "WRONG_MODE_FOR_TISSUE_EXTRACTION"
    return F.when(path.isNull(), None).when(ome, wrong).when(~known, "MODE_INPUT_EXTENSION_MISMATCH")


def structure(manifest: DataFrame, listing: DataFrame, accepted: list[str]) -> DataFrame:
    """(row_number, known_bytes, size_status, codes): the checks of existing image files, in order, codes joined by ;.

    listing (source_path, length, is_file): what is there.
    """
    there = listing.select(F.col("source_path").alias("there_path"), "length", "is_file").dropDuplicates(["there_path"])
    path = value(F.col("source_path"))
    m = manifest.join(there, path == F.col("there_path"), "left")
    named = ends(path, accepted) & (ends(path, OME) | suffix(path).isin(*TIFF))
    far, lost = remote(path), F.col("there_path").isNull()
    checks = [
        F.when(~named, "OMETIFF_WRONG_MODE_EXTENSION"),
        F.when(far, "OMETIFF_NONLOCAL_DEFERRED").when(lost, "OMETIFF_MISSING_LOCAL_FILE").when(~F.col("is_file"), "OMETIFF_NOT_REGULAR_FILE").when(F.col("length") == 0, "OMETIFF_EMPTY_FILE"),
    ]
    codes = F.when(path.isNull(), "").otherwise(F.array_join(F.array_compact(F.array(*checks)), ";"))
    known = F.when(path.isNotNull() & ~far & F.coalesce("is_file", F.lit(False)), F.col("length"))
    status = (
        F.when(known.isNotNull(), "known").when(path.isNull(), "unknown_missing_source_path").when(far, "unknown_non_local_source")
        .when(lost, "unknown_missing_local_source").otherwise("unknown_not_regular_file")
    )
    return m.select("row_number", known.alias("known_bytes"), status.alias("size_status"), codes.alias("codes"))


def exit_code(errors: Column, warnings: Column, deferred: Column, strict: bool = False) -> Column:
    soft = (warnings > 0) | (deferred > 0)
    return F.when((errors > 0) | (soft & F.lit(strict)), 1).otherwise(0)


def next_action(errors: Column, warnings: Column, deferred: Column, ready: Column, mode: str, strict: bool = False) -> Column:
    soft = ((warnings > 0) | (deferred > 0)) & F.lit(strict)
    return F.when(errors > 0, ACTIONS["errors"]).when(soft, ACTIONS["strict"]).when(~ready, ACTIONS["not_ready"]).otherwise(ACTIONS[mode])


def structure_action(errors: Column, warnings: Column, deferred: Column, metadata_waits: Column, strict: bool = False) -> Column:
    """struct(action, text): the first rule that holds."""
    tests = [errors > 0, metadata_waits, ((warnings > 0) | (deferred > 0)) & F.lit(strict), deferred > 0, warnings > 0, F.lit(True)]
    out = None
    for test, (action, text) in reversed(list(zip(tests, STRUCTURE, strict=True))):
        s = F.struct(F.lit(action).alias("action"), F.lit(text).alias("text"))
        out = s if out is None else F.when(test, s).otherwise(out)
    return out


def reason(found: DataFrame) -> DataFrame:
    """(row_number, blocked_reason, deferred_reason) of rows with issues: the first error's code, and that of a source that is not local.

    found: row_number, place (the order of a row's issues), code, severity.
    """
    first = F.min(F.when(F.col("severity") == ERROR, F.struct("place", "code")))
    waits = F.max(F.when((F.col("severity") == DEFERRED) & (F.col("code") == "DEFERRED_NON_LOCAL_SOURCE_EXISTENCE"), F.col("code")))
    out = found.groupBy("row_number").agg(first.alias("f"), waits.alias("w"))
    return out.select("row_number", F.coalesce("f.code", F.lit("PREFLIGHT_ROW_INVALID")).alias("blocked_reason"), F.coalesce("w", F.lit("NON_LOCAL_SOURCE")).alias("deferred_reason"))
