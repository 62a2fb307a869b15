"""Surface meshes in relational form: vertices (mesh, v, x, y, z), faces (mesh, f, v0, v1, v2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tessera.functions.storage import discard, materialise


def _corners(vertices: DataFrame, faces: DataFrame) -> DataFrame:
    out = faces
    for k in range(3):
        p = vertices.select("mesh", F.col("v").alias(f"v{k}"), F.struct("x", "y", "z").alias(f"p{k}"))
        out = out.join(p, ["mesh", f"v{k}"])
    return out


def area(vertices: DataFrame, faces: DataFrame) -> DataFrame:
    """Half the length of the cross product, summed over faces."""
    c = _corners(vertices, faces)
    u = [F.col(f"p1.{a}") - F.col(f"p0.{a}") for a in "xyz"]
    v = [F.col(f"p2.{a}") - F.col(f"p0.{a}") for a in "xyz"]
    cross = [u[1] * v[2] - u[2] * v[1], u[2] * v[0] - u[0] * v[2], u[0] * v[1] - u[1] * v[0]]
    return c.groupBy("mesh").agg(F.sum(0.5 * F.sqrt(cross[0] * cross[0] + cross[1] * cross[1] + cross[2] * cross[2])).alias("area"))


def edges(faces: DataFrame) -> DataFrame:
    """Distinct edges, the smaller vertex first."""
    pair = lambda a, b: F.struct(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
    e = faces.select("mesh", F.explode(F.array(pair("v0", "v1"), pair("v1", "v2"), pair("v0", "v2"))).alias("e"))
    return e.select("mesh", "e.a", "e.b").distinct()


def euler(vertices: DataFrame, faces: DataFrame) -> DataFrame:
    """V - E + F, and genus = 1 - chi / 2."""
    v = vertices.groupBy("mesh").agg(F.count(F.lit(1)).alias("n_v"))
    e = edges(faces).groupBy("mesh").agg(F.count(F.lit(1)).alias("n_e"))
    f = faces.groupBy("mesh").agg(F.count(F.lit(1)).alias("n_f"))
    out = v.join(e, "mesh").join(f, "mesh").withColumn("chi", F.col("n_v") - F.col("n_e") + F.col("n_f"))
    return out.withColumn("genus", 1 - F.col("chi") / 2)


def unique_faces(faces: DataFrame) -> DataFrame:
    """Distinct sorted triples, and vertex numbers made dense over those in use."""
    t = F.array_sort(F.array("v0", "v1", "v2"))
    d = faces.select("mesh", t.alias("t")).distinct()
    used = d.select("mesh", F.explode("t").alias("v")).distinct().withColumn("n", F.dense_rank().over(W.partitionBy("mesh").orderBy("v")) - 1)
    for k in range(3):
        dense = used.select("mesh", F.col("v").alias("old"), F.col("n").cast("long").alias(f"v{k}"))
        d = d.withColumn("old", F.col("t")[k]).join(dense, ["mesh", "old"]).drop("old")
    return d.drop("t")


def quantise(vertices: DataFrame, step: float) -> DataFrame:
    """One vertex, the first, of each cell of that size."""
    cell = [F.floor(F.col(a) / step).alias(f"c{a}") for a in "xyz"]
    return vertices.groupBy("mesh", *cell).agg(F.min("v").alias("v"), F.count(F.lit(1)).alias("n"))


def unit_box(vertices: DataFrame, flat: float = 1.0) -> DataFrame:
    """Min-max to [0, 1] on each axis; a flat axis counts with that range (NaN: its places are NaN, as 0 / 0 is)."""
    w = W.partitionBy("mesh")
    scaled = {}
    for a in "xyz":
        low, high = F.min(a).over(w), F.max(a).over(w)
        scaled[a] = (F.col(a) - low) / F.when(high > low, high - low).otherwise(F.lit(flat))
    return vertices.withColumns(scaled)


def radius_pairs(vertices: DataFrame, radius: float) -> DataFrame:
    """Pairs a < b of vertices at most radius apart: an equi-join on the 27 cells around each vertex, then the distance."""
    cell = {f"c{a}": F.floor(F.col(a) / radius) for a in "xyz"}
    left = vertices.withColumns(cell)
    around = F.explode(F.array(*[F.struct(*[F.lit(d).alias(n) for d, n in zip((i, j, k), ("dx", "dy", "dz"), strict=True)]) for i in (-1, 0, 1) for j in (-1, 0, 1) for k in (-1, 0, 1)]))
    right = left.select("mesh", F.col("v").alias("b"), *[F.col(a).alias(f"{a}b") for a in "xyz"], "cx", "cy", "cz", around.alias("o"))
    right = right.select("mesh", "b", "xb", "yb", "zb", *[(F.col(f"c{a}") + F.col(f"o.d{a}")).alias(f"c{a}") for a in "xyz"])
    d2 = sum((F.pow(F.col(a) - F.col(f"{a}b"), 2) for a in "xyz"), F.lit(0.0))
    return left.join(right, ["mesh", "cx", "cy", "cz"]).filter(F.col("v") < F.col("b")).filter(d2 <= radius * radius).select("mesh", F.col("v").alias("a"), "b", F.sqrt(d2).alias("distance"))


def face_faults(faces: DataFrame, vertices: DataFrame) -> DataFrame:
    """(mesh, f, fault) of faces that are no triangles of the mesh: a corner is missing, or not within its vertices."""
    n = vertices.groupBy("mesh").agg(F.count(F.lit(1)).alias("n_vertices"))
    f = faces.join(n, "mesh", "left")
    lacks = F.col("v0").isNull() | F.col("v1").isNull() | F.col("v2").isNull()
    out = (F.least("v0", "v1", "v2") < 0) | (F.greatest("v0", "v1", "v2") >= F.coalesce("n_vertices", F.lit(0)))
    return f.withColumn("fault", F.when(lacks, "missing_corner").when(out, "corner_out_of_range")).filter("fault IS NOT NULL").select("mesh", "f", "fault")


def quotas(groups: DataFrame, total: int, by: str = "mesh") -> DataFrame:
    """groups (by, cell, n) with quota: total shared in proportion to n, whole parts first, then one each by the largest remainder.

    No group gets more than it has; what then remains is not dealt. Ties go to the smaller cell.
    """
    w = W.partitionBy(by)
    raw = F.col("n") / F.sum("n").over(w) * total
    g = groups.withColumn("raw", raw).withColumn("whole", F.least(F.floor("raw"), F.col("n")).cast("long"))
    g = g.withColumn("rest", F.lit(total) - F.sum("whole").over(w)).withColumn("room", F.col("whole") < F.col("n"))
    place = F.row_number().over(w.orderBy(F.desc("room"), F.desc(F.col("raw") - F.col("whole")), "cell"))
    return g.withColumn("quota", F.col("whole") + F.when(F.col("room") & (place <= F.col("rest")), 1).otherwise(0)).select(*groups.columns, "quota")


def spacing_of_count(area: Column, count: Column) -> Column:
    """The distance at which that many points fill an area, packed in hexagons."""
    return F.sqrt(F.lit(2.0 / 3.0**0.5) * area / count)


def count_of_spacing(area: Column, distance: Column) -> Column:
    return F.rint(F.lit(2.0 / 3.0**0.5) * area / (distance * distance)).cast("long")


def crosses(values: DataFrame, level: float, eps: float = 1e-12) -> DataFrame:
    """(segment, crosses) of samples (segment, place, value): by the signs of both ends if there are two, else by least and largest."""
    s = values.groupBy("segment").agg(F.count(F.lit(1)).alias("n"), F.min_by("value", "place").alias("a"), F.max_by("value", "place").alias("b"), F.min("value").alias("lo"), F.max("value").alias("hi"))
    a, b = F.col("a") - level, F.col("b") - level
    two = ((a > eps) & (b < -eps)) | ((a < -eps) & (b > eps))
    return s.select("segment", F.when(F.col("n") == 2, two).otherwise((F.col("lo") <= level - eps) & (F.col("hi") >= level + eps)).alias("crosses"))


def thin_faces(vertices: DataFrame, faces: DataFrame, threshold: float) -> DataFrame:
    """Faces whose plane no vertex of the mesh is as far from as threshold, and faces without an area.

    The farthest vertex in a direction lies on the mesh's hull, so each face is compared with the extreme vertices of
    directions that a fixed set has found, and only where that does not decide with all of them.
    """
    c = _corners(vertices, faces)
    u = [F.col(f"p1.{a}") - F.col(f"p0.{a}") for a in "xyz"]
    v = [F.col(f"p2.{a}") - F.col(f"p0.{a}") for a in "xyz"]
    cross = [u[1] * v[2] - u[2] * v[1], u[2] * v[0] - u[0] * v[2], u[0] * v[1] - u[1] * v[0]]
    norm = F.sqrt(cross[0] * cross[0] + cross[1] * cross[1] + cross[2] * cross[2])
    planes = c.select("mesh", "f", norm.alias("norm"), *[(k / F.when(norm > 0, norm)).alias(f"n{a}") for k, a in zip(cross, "xyz", strict=True)], *[F.col(f"p0.{a}").alias(f"o{a}") for a in "xyz"])
    far = lambda p: F.abs(sum(((F.col(f"{p}.{a}") - F.col(f"o{a}")) * F.col(f"n{a}") for a in "xyz"), F.lit(0.0)))
    steps = [(i, j, k) for i in (-1, 0, 1) for j in (-1, 0, 1) for k in (-1, 0, 1) if (i, j, k) > (0, 0, 0)]
    along = lambda d: sum((F.col(a) * float(s) for a, s in zip("xyz", d, strict=True)), F.lit(0.0))
    ends = vertices.groupBy("mesh").agg(F.array(*[f(F.struct("x", "y", "z"), along(d)) for d in steps for f in (F.min_by, F.max_by)]).alias("ends"))
    first = planes.join(F.broadcast(ends), "mesh")  # one row for each mesh
    reach = F.aggregate("ends", F.lit(0.0), lambda acc, e: F.greatest(acc, F.abs(sum(((e[a] - F.col(f"o{a}")) * F.col(f"n{a}") for a in "xyz"), F.lit(0.0)))))
    open_ = first.withColumn("reach", reach).filter((F.col("norm") == 0) | (F.col("reach") < threshold)).drop("ends", "reach")
    flat = open_.filter("norm = 0").select("mesh", "f")
    rest = open_.filter("norm > 0").join(vertices.select("mesh", F.struct("x", "y", "z").alias("q")), "mesh")
    return flat.unionByName(rest.groupBy("mesh", "f").agg(F.max(far("q")).alias("d")).filter(F.col("d") < threshold).select("mesh", "f"))


def sample_apart(vertices: DataFrame, distance: float, seed: int = 0) -> DataFrame:
    """A maximal set of vertices that are pairwise at least `distance` apart, by rounds over pairs that are closer.

    Every vertex has a priority, by a hash; one that precedes all its close neighbours that are still open is taken and
    closes them. A round is two groupings; their number grows with the logarithm of the vertices.
    """
    near = radius_pairs(vertices, distance).filter(F.col("distance") < distance)
    key = lambda c: F.struct(F.xxhash64("mesh", c, F.lit(seed)).alias("h"), F.col(c).alias("v"))
    both = near.select("mesh", "a", "b").unionByName(near.select("mesh", F.col("b").alias("a"), F.col("a").alias("b")))
    both = materialise(both.select("mesh", F.col("a").alias("v"), key("a").alias("own"), F.col("b").alias("other"), key("b").alias("rank")), "near")
    taken = vertices.select("mesh", "v").join(both.select("mesh", "v").distinct(), ["mesh", "v"], "left_anti")
    while both.take(1):
        first = both.groupBy("mesh", "v").agg(F.min("rank").alias("least"), F.first("own").alias("own")).filter("own < least").select("mesh", "v")
        first = materialise(first, "first")
        taken = taken.unionByName(first)
        gone = both.join(first, ["mesh", "v"]).select("mesh", F.col("other").alias("v")).unionByName(first).distinct()
        gone = materialise(gone, "gone")
        left = both.join(gone, ["mesh", "v"], "left_anti").join(gone.select("mesh", F.col("v").alias("other")), ["mesh", "other"], "left_anti")
        alone = both.select("mesh", "v").distinct().join(gone, ["mesh", "v"], "left_anti").join(left.select("mesh", "v"), ["mesh", "v"], "left_anti")
        both, old = materialise(left, "near"), both
        taken = materialise(taken.unionByName(alone), "taken")
        discard(old)
    return taken
