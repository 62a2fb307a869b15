"""Column expressions on file names, labels and identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def overall_label(rank: Column, spacing: int = 9, pad: int = 4, start: int = 1) -> Column:
    """start + rank * (spacing + 1), padded with zeros but never cut."""
    return F.format_string(f"%0{pad}d", (F.lit(start) + rank * (spacing + 1)).cast("long"))


def with_suffix(stem: Column, label: Column, pad: int = 4) -> Column:
    """stem with its _dddd suffix, if it has one, replaced by label."""
    return F.concat(F.regexp_replace(stem, f"_\\d{{{pad}}}$", ""), F.lit("_"), label)


def normal_extension(ext: Column) -> Column:
    """jpg, tiff or png, whatever the case and with or without leading dots; any other is an error."""
    e = F.regexp_replace(F.lower(ext), r"^\.+", "")
    known = F.when(e.isin("jpg", "jpeg"), "jpg").when(e.isin("tif", "tiff"), "tiff").when(e == "png", "png")
    return F.when(e.isNull(), e).otherwise(F.coalesce(known, F.raise_error(F.concat(F.lit("unknown extension: "), ext)).cast("string")))


def parse_name(name: Column) -> Column:
    """struct(prefix, slide, slice, overall, ext) of prefix_SS_TT_OOOO.ext; nulls if the name has another form."""
    rx = r"^(.+?)_(\d+)_(\d+)_(\d+)\.([A-Za-z]+)$"
    part = lambda k: F.nullif(F.regexp_extract(name, rx, k), F.lit(""))
    return F.struct(part(1).alias("prefix"), part(2).cast("int").alias("slide"), part(3).cast("int").alias("slice"), part(4).cast("int").alias("overall"), F.lower(part(5)).alias("ext"))


def frame_number(stem: Column, sep: str = "_") -> Column:
    """The digits at the end of the last token."""
    return F.regexp_extract(F.element_at(F.split(stem, sep), -1), r"(\d+)$", 1).try_cast("long")


def safe_name(s: Column) -> Column:
    """Other characters than letters, digits, _ - . become _, the ends lose . and _, empty becomes untitled."""
    t = F.regexp_replace(F.regexp_replace(s, r"[^A-Za-z0-9_.-]", "_"), r"^[._]+|[._]+$", "")
    return F.when(t == "", F.lit("untitled")).otherwise(t)


def job_id(batch: Column, row_number: Column, identifier: Column, path: Column, stage: str = "tissue_detection") -> Column:
    """tissue-detection-row-%05d- and 12 hex digits of the sha256 of the fields joined by |; nulls count as empty."""
    text = F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in (batch, row_number, identifier, path, F.lit(stage))])
    return F.concat(F.format_string("tissue-detection-row-%05d-", row_number.cast("long")), F.substring(F.sha2(text, 256), 1, 12))


def human_bytes(n: Column) -> Column:
    """A whole number of bytes (up to 80 PiB) in the largest unit of 1024 steps up to TiB, with two decimals, half to even.

    Hundredths are counted in whole numbers, as halves that a double would hide matter.
    """
    n, out = n.cast("long"), None
    for k, unit in reversed(list(enumerate(("B", "KiB", "MiB", "GiB", "TiB")))):
        q, twice = F.shiftright(n * 100, 10 * k), 2 * F.pmod(n * 100, F.lit(1024**k))
        q = q + F.when((twice > 1024**k) | ((twice == 1024**k) & (q % 2 == 1)), 1).otherwise(0)
        cents = q % 100
        text = F.concat(((q - cents) / 100).cast("long").cast("string"), F.lit("."), F.lpad(cents.cast("string"), 2, "0"), F.lit(f" {unit}"))
        out = text if out is None else F.when(n < 1024 ** (k + 1), text).otherwise(out)
    return out


def accepted(source: Column, extensions: list[str]) -> Column:
    """Whether the path of a URL (its escapes undone), or the value itself, ends in one of the extensions, whatever the case."""
    path = F.regexp_extract(source, r"^[A-Za-z][A-Za-z0-9+.-]*:(?://[^/?#]*)?([^?#]*)", 1)
    target = F.lower(F.when(path != "", F.coalesce(F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), path)).otherwise(source))
    out = F.lit(False)
    for e in extensions:
        out = out | target.endswith(e.lower())
    return out


def xy_pattern(glob: str) -> str:
    """A pattern, whatever the case, of names that begin like the glob (up to its first *) and then hold _digits_digits."""
    head = glob.replace("\\", "/").rsplit("/", 1)[-1].split("*")[0]
    return "(?i)" + "".join(c if c.isalnum() or c == "_" else "\\" + c for c in head) + ".*?_([0-9]+)_([0-9]+)"


def xy_of(name: Column, pattern: str) -> Column:
    """struct(xx, yy) of the first match; 10^9 each without one, so that such names come last."""
    part = lambda k: F.coalesce(F.regexp_extract(name, pattern, k).try_cast("long"), F.lit(10**9).cast("long"))
    return F.struct(part(1).alias("xx"), part(2).alias("yy"))


def stem(path: Column) -> Column:
    """The name without folders and without its last suffix."""
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"(?<=.)\.[^.]*$", "")


def source_and_tile(path: Column, pad: int = 4) -> Column:
    """struct(source, tile) of source_tile, an overall label of pad digits left out; tile 0 for other names."""
    s = F.regexp_replace(stem(path), f"_\\d{{{pad}}}$", "")
    hit = s.rlike(r"^.+_\d+$")
    return F.struct(F.when(hit, F.regexp_extract(s, r"^(.+)_(\d+)$", 1)).otherwise(s).alias("source"), F.when(hit, F.regexp_extract(s, r"^(.+)_(\d+)$", 2).cast("int")).otherwise(F.lit(0)).alias("tile"))


def missing_like(reference: Column, number: Column, ext: str, sep: str = "_") -> Column:
    """The name of a missing slice: the reference's stem with the digits at its end replaced, in their width or 4."""
    s = stem(reference)
    digits = F.regexp_extract(s, f"[^{sep}]*?(\\d*)$", 1)
    width = F.when(F.length(digits) > 0, F.length(digits)).otherwise(F.lit(4))
    text = number.cast("string")
    return F.concat(F.substring(s, F.lit(1), F.length(s) - F.length(digits)), F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, F.lit("0"))), F.lit(ext))
