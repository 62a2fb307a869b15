"""Tabular inputs: manifests, slice tables with sidecars, listings, nested JSON records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

REQUIRED = ["specimen_id", "slide_id", "source_path"]
OPTIONAL = ["stain", "block_id", "section_number", "notes", "ets_path", "checksum", "width_px", "height_px", "physical_pixel_size_x", "physical_pixel_size_y", "physical_pixel_size_unit", "metadata_status"]


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """A submission CSV: required columns must be there, optional ones are added as nulls, blanks become null.

    row_number is the row's place in the file plus one for the header.
    """
    df = spark.read.csv(path, header=True)
    missing = [c for c in REQUIRED if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    clean = lambda c: F.when(F.btrim(c) != "", F.btrim(c)) if c in df.columns else F.lit(None).cast("string")
    rows = df.select(*[clean(c).alias(c) for c in REQUIRED + OPTIONAL], F.monotonically_increasing_id().alias("__at"))
    # Ids rise with the place in the file; within a partition they are dense, so a count per partition makes them global.
    part = F.shiftright("__at", 33)
    base = rows.groupBy(part.alias("__p")).agg(F.count(F.lit(1)).alias("n"))
    earlier = W.orderBy("__p").rowsBetween(W.unboundedPreceding, -1)  # one row for each input partition
    before = base.select("__p", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("__before"))
    out = rows.withColumn("__p", part).join(F.broadcast(before), "__p")  # one row for each input partition
    return out.select((F.col("__before") + F.col("__at").bitwiseAND((1 << 33) - 1) + 2).alias("row_number"), *REQUIRED, *OPTIONAL)


def listing(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, length, modified) of the files under a folder; contents are not read."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path)
    return f.select("path", "length", F.col("modificationTime").alias("modified"))


def checksums(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    f = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path)
    return f.select("path", F.sha2("content", 256).alias("sha256"))


def newest_companion(files: DataFrame) -> DataFrame:
    """Of files (stem, folder, path) the path in each stem's lexicographically greatest folder."""
    return files.groupBy("stem").agg(F.max_by("path", F.struct("folder", "path")).alias("path"))


def slices_with_sidecars(slices: DataFrame, sidecars: DataFrame) -> DataFrame:
    """slices (stem, ...) with shape_yx, origin and directions of their sidecars (stem, Sizes, SpaceOrigin, SpaceDirections)."""
    s = sidecars.select(
        "stem",
        F.array(F.get("Sizes", F.lit(2)), F.get("Sizes", F.lit(1))).alias("shape_yx"),
        F.slice("SpaceOrigin", 1, 3).alias("space_origin_um"),
        F.slice("SpaceDirections", 2, 3).alias("space_directions_um"),
    )
    return slices.join(s, "stem", "left")


def json_records(spark: SparkSession, path: str, schema: str, field: str | None = None) -> DataFrame:
    """Rows of JSON files that hold one object, a list, or an object with the list in `field`."""
    df = spark.read.schema(f"{field} array<struct<{schema}>>" if field else schema).option("multiLine", "true").json(path)
    return df.select(F.inline(field)) if field else df
