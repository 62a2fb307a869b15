"""Quality-control records: precedence of sources, grouping and order, statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tessera.functions import naming
from tessera.functions.storage import materialise


def first_source(records: DataFrame) -> DataFrame:
    """Rows of the source of smallest source_rank that has any, for each slide set."""
    best = records.groupBy("set_id").agg(F.min("source_rank").alias("source_rank"))
    return records.join(best, ["set_id", "source_rank"], "left_semi")


def from_names(files: DataFrame, name: str = "filename") -> DataFrame:
    """Records parsed from file names; names of another form have nulls."""
    return files.withColumn("p", naming.parse_name(F.col(name))).select("*", "p.*").drop("p")


def group_order(records: DataFrame) -> DataFrame:
    """group_index of each source image: by its smallest overall index, then by name.

    Images are sorted by range into partitions; the rank within a partition and the counts of those before it make the
    index, so that no task ranks them all.
    """
    low = records.groupBy("source_image").agg(F.min("overall_index").alias("low"), F.count(F.lit(1)).alias("n"))
    rows = materialise(low.repartitionByRange("low", "source_image").withColumn("part", F.spark_partition_id()), "order")
    rows = rows.withColumn("at", F.row_number().over(W.partitionBy("part").orderBy("low", "source_image")))
    sizes = rows.groupBy("part").agg(F.count(F.lit(1)).alias("size"))
    before = sizes.withColumn("before", F.sum("size").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)))  # one row for each partition
    out = rows.join(F.broadcast(before), "part")
    return out.select("source_image", "n", (F.col("at") + F.coalesce("before", F.lit(0))).cast("int").alias("group_index"))


def overall_index(files: DataFrame, spacing: int = 9, pad: int = 4) -> DataFrame:
    """files (series, xx, yy, filename) with rank (0-based, by xx, yy, name) and label."""
    r = F.row_number().over(W.partitionBy("series").orderBy("xx", "yy", "filename")) - 1
    return files.withColumn("rank", r).withColumn("label", naming.overall_label(F.col("rank"), spacing, pad))


def stats(pixels: DataFrame, key: str, value: str) -> DataFrame:
    return pixels.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"), F.min(value).alias("min"), F.max(value).alias("max"))


def windows(h: Column, w: Column, size: int, grid: int = 3) -> Column:
    """Distinct (y, x) corners of grid x grid sample windows, spread evenly and cut down to integers."""
    at = lambda n: F.transform(F.sequence(F.lit(0), F.lit(grid - 1)), lambda k: F.floor(F.greatest(n - size, F.lit(0)) * k / F.lit(float(grid - 1))))
    return F.array_distinct(F.flatten(F.transform(at(h), lambda y: F.transform(at(w), lambda x: F.struct(y.alias("y"), x.alias("x"))))))


def columns(count: Column) -> Column:
    """Columns of a square-ish grid."""
    return F.greatest(F.lit(1), F.floor(F.sqrt(count) + 0.5)).cast("long")


def flatten(df: DataFrame, separator: str = ".") -> DataFrame:
    """All leaves of nested structs as columns with dotted names."""
    from pyspark.sql.types import StructType

    def leaves(schema: StructType, path: tuple[str, ...] = ()):
        for f in schema.fields:
            if isinstance(f.dataType, StructType):
                yield from leaves(f.dataType, (*path, f.name))
            else:
                yield (*path, f.name)

    return df.select(*[F.col(".".join(f"`{x}`" for x in p)).alias(separator.join(p)) for p in leaves(df.schema)])


def by_slide(files: DataFrame, name: str = "filename") -> DataFrame:
    """(slide, place, filename): parsed names of each slide in order of slice, overall index and name; others are left out."""
    p = from_names(files, name).filter("slide IS NOT NULL")
    return p.select("slide", F.row_number().over(W.partitionBy("slide").orderBy("slice", "overall", name)).alias("place"), name)


def with_metadata(files: DataFrame, metadata: DataFrame, pad: int = 4) -> DataFrame:
    """files (filename) with source_image, tile, width, height of metadata (name, ...): by name, else by the name without its overall label.

    What neither has comes from the name itself, with size 0.
    """
    fields = ["source_image", "tile", "width", "height"]
    bare = F.regexp_replace("filename", f"_\\d{{{pad}}}(?=(\\.[^.]*)?$)", "")
    at = lambda p: metadata.select(F.col("name").alias(f"{p}_name"), *[F.col(c).alias(f"{p}_{c}") for c in fields]).dropDuplicates([f"{p}_name"])
    rows = files.join(at("own"), F.col("filename") == F.col("own_name"), "left").join(at("bare"), bare == F.col("bare_name"), "left")
    guess = naming.source_and_tile(F.col("filename"), pad)
    other = {"source_image": guess["source"], "tile": guess["tile"], "width": F.lit(0), "height": F.lit(0)}
    pick = lambda c: F.when(F.col("own_name").isNotNull(), F.coalesce(f"own_{c}", other[c])).when(F.col("bare_name").isNotNull(), F.coalesce(f"bare_{c}", other[c])).otherwise(other[c])
    return rows.select(*files.columns, *[pick(c).alias(c) for c in fields])


def with_component_qc(tiles: DataFrame, records: DataFrame) -> DataFrame:
    """tiles (slide, tile_index, ...) with the component record of their index, nulls where there is none."""
    return tiles.join(records, ["slide", "tile_index"], "left")


def mosaic(images: DataFrame) -> DataFrame:
    """images (set_id, place, h, w) with the corner (y, x) of each in a grid of ceil(sqrt(n)) columns of cells of the largest size."""
    w = W.partitionBy("set_id")
    k = F.row_number().over(w.orderBy("place")) - 1
    cols = F.ceil(F.sqrt(F.count(F.lit(1)).over(w).cast("double"))).cast("long")
    rows = images.withColumns({"k": k, "cols": cols, "ch": F.max("h").over(w), "cw": F.max("w").over(w)})
    return rows.select("set_id", "place", (F.floor(F.col("k") / F.col("cols")) * F.col("ch")).alias("y"), (F.col("k") % F.col("cols") * F.col("cw")).alias("x"))


def stage_seconds(timers: DataFrame, stages: list[str]) -> DataFrame:
    """(run, one column for each stage): summed seconds, 0 for a stage without any."""
    return timers.groupBy("run").pivot("stage", stages).sum("seconds").fillna(0.0, stages)


def most_common_extension(names: DataFrame, known: list[str]) -> DataFrame:
    """(set_id, ext): the known extension that most names have, whatever the case; ties go to the one that came first by place."""
    e = F.lower(F.regexp_extract("name", r"[^/.](\.[^./]+)$", 1))
    n = names.select("set_id", "place", e.alias("ext")).filter(F.col("ext").isin(known)).groupBy("set_id", "ext").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first"))
    return n.groupBy("set_id").agg(F.max_by("ext", F.struct("n", -F.col("first"))).alias("ext"))
