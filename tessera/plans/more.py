"""Level plans, projections, validation by mode, registration planning, and further records and meshes."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import geometry as G
from tessera.functions import naming as N
from tessera.operators import frames, levels, lineage, mesh, qc, raster, registration, validation
from tessera.plans import tables as T
from tessera.plans.catalog import _FRAME, _LABEL, _frames, _labels, foreground, pixels, query, table

# --- levels and bounds ------------------------------------------------------------------------------------------------


@query("""SELECT o_orderkey AS id, CASE WHEN n >= 0 AND n < 6 THEN n END AS level FROM (SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN 2 WHEN 1 THEN CAST(o_custkey % 9 AS INTEGER) WHEN 2 THEN CAST(6 - (o_custkey % 8 + 1) AS INTEGER) WHEN 3 THEN CAST(o_custkey % 9 AS INTEGER) END AS n FROM orders)""")
def level_resolve(spark, sf):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    text = F.when(k % 6 == 0, None).when(k % 6 == 1, (c % 9).cast("string")).when(k % 6 == 2, F.concat(F.lit("-"), c % 8 + 1)).when(k % 6 == 3, F.concat(F.lit(" s"), c % 9)).when(k % 6 == 4, "s-1").otherwise("level 2")
    return table(spark, sf, "orders").select(k.alias("id"), levels.resolve_level(text, F.lit(2), F.lit(6)).alias("level"))


_POLICIES = ["segmentation_level", "min_side_for_mips", "requested_mips", "available_source_levels", "explicit_level"]


@query("""WITH a AS (SELECT p_partkey AS id, ['segmentation_level', 'min_side_for_mips', 'requested_mips', 'available_source_levels', 'explicit_level'][p_partkey % 5 + 1] AS p, p_size % 3 AS s, p_size % 3 + p_partkey % 4 AS g, p_size % 7 AS c, CASE WHEN p_partkey % 3 > 0 THEN p_partkey % 6 END AS r, CASE WHEN p_partkey % 5 = 4 OR p_partkey % 2 = 0 THEN p_partkey % 8 END AS e FROM part),
b AS (SELECT *, CASE p WHEN 'segmentation_level' THEN g WHEN 'min_side_for_mips' THEN s + greatest(c, 1) - 1 WHEN 'requested_mips' THEN s + greatest(coalesce(r, 7 - s), 1) - 1 WHEN 'explicit_level' THEN e ELSE 6 END AS t0, p NOT IN ('segmentation_level', 'explicit_level') AND e IS NOT NULL AS lim FROM a),
d AS (SELECT *, CASE WHEN lim THEN least(t0, e) ELSE t0 END AS t FROM b), f AS (SELECT *, greatest(s, least(t, 6)) AS last FROM d)
SELECT id, CAST(last AS INTEGER) AS stop, CASE WHEN p = 'explicit_level' OR (lim AND t = e) THEN 'native_mip_stop_level' ELSE p END AS reason, last < g AS unwritten FROM f""")
def level_stops(spark, sf):
    k, n = F.col("p_partkey"), F.col("p_size")
    policy = F.element_at(F.array(*map(F.lit, _POLICIES)), (k % 5 + 1).cast("int"))
    explicit = F.when((k % 5 == 4) | (k % 2 == 0), (k % 8).cast("int"))
    stop = levels.stop_level(policy, n % 3, n % 3 + (k % 4).cast("int"), F.lit(7), explicit, n % 7, F.when(k % 3 > 0, (k % 6).cast("int")))
    return table(spark, sf, "part").select(k.alias("id"), stop.alias("s")).select("id", "s.*")


@query("SELECT p_partkey AS id, CASE p_partkey % 4 WHEN 0 THEN 'notebook_square' WHEN 1 THEN 'compact_rectangle' WHEN 2 THEN 'compact_square' ELSE 'notebook_square' END AS crop, CASE p_partkey % 4 WHEN 1 THEN 'available_source_levels' WHEN 2 THEN 'min_side_for_mips' ELSE 'segmentation_level' END AS stop FROM part")
def policy_aliases(spark, sf):
    k = F.col("p_partkey") % 4
    crop = F.when(k == 0, F.lit(None)).when(k == 1, " Production").when(k == 2, "compact-square").otherwise("source")
    stop = F.when(k == 0, "").when(k == 1, "ALL").when(k == 2, "min-side").otherwise("segmentation")
    return table(spark, sf, "part").select(F.col("p_partkey").alias("id"), levels.alias(crop, levels.CROP, "notebook_square").alias("crop"), levels.alias(stop, levels.STOP, "segmentation_level").alias("stop"))


_CANVAS = _FRAME + """, cv AS (SELECT slide, label, CAST(floor((my0 + my1) / 2.0 - side / 2.0) AS BIGINT) AS y0, CAST(floor((mx0 + mx1) / 2.0 - side / 2.0) AS BIGINT) AS x0, side FROM (SELECT *, CAST(ceil((greatest(my1 - my0, mx1 - mx0) + 4) / 16.0) * 16 AS BIGINT) AS side FROM fr)),
al AS (SELECT slide, label, CAST(floor(y0 / 24.0) * 24 AS BIGINT) AS y0, CAST(floor(x0 / 24.0) * 24 AS BIGINT) AS x0, CAST(ceil((y0 + side) / 24.0) * 24 AS BIGINT) AS y1, CAST(ceil((x0 + side) / 24.0) * 24 AS BIGINT) AS x1 FROM cv),
lv AS (SELECT unnest([1, 2, 3]) AS level, unnest([256, 100, 43]) AS h, unnest([256, 128, 51]) AS w),
pl AS (SELECT slide, label, level - 1 AS output_index, level, h, w, CAST(floor(y0 / (256.0::DOUBLE / h)) AS BIGINT) AS y0, CAST(floor(x0 / (256.0::DOUBLE / w)) AS BIGINT) AS x0, CAST(ceil(y1 / (256.0::DOUBLE / h)) AS BIGINT) AS y1, CAST(ceil(x1 / (256.0::DOUBLE / w)) AS BIGINT) AS x1 FROM al, lv),
po AS (SELECT *, greatest(y1 - y0, 1) AS out_h, greatest(x1 - x0, 1) AS out_w, 0.5::DOUBLE * 256 / h AS phys_y, 0.25::DOUBLE * 256 / w AS phys_x FROM pl)"""


def _plan(spark, sf):
    c = _frames(spark, sf, "notebook_square_source").select("slide", "label", "canvas", F.lit(1).alias("source"), F.lit(3).alias("stop"))
    sizes = [(1, 256, 256), (2, 100, 128), (3, 43, 51)]
    at = c.select("slide").distinct().select("slide", F.explode(F.array(*[F.struct(F.lit(x).alias("level"), F.lit(h).cast("long").alias("h"), F.lit(w).cast("long").alias("w")) for x, h, w in sizes])).alias("l"))
    return levels.level_plan(c, at.select("slide", "l.*"), 24, 0.5, 0.25)


@query(_CANVAS + " SELECT slide, label, output_index, level, y0, x1, least(greatest(y0, 0), h) AS cy0, least(greatest(CAST(ceil(x1 / 24.0) * 24 AS BIGINT), 0), w) AS rx1, out_h, out_w, round(phys_y, 9) AS phys_y, round(phys_x, 9) AS phys_x, round(y0 * phys_y, 6) AS trans_y, round(x0 * phys_x, 6) AS trans_x FROM po", True)
def native_level_plan(spark, sf):
    p = _plan(spark, sf)
    return p.select("slide", "label", "output_index", "level", F.col("canvas.y0").alias("y0"), F.col("canvas.x1").alias("x1"), F.col("clipped.y0").alias("cy0"), F.col("read.x1").alias("rx1"), "out_h", "out_w", *[F.round(c, d).alias(c) for c, d in (("phys_y", 9), ("phys_x", 9), ("trans_y", 6), ("trans_x", 6))])


_PAY = ", pay AS (SELECT slide, label, CAST(sum(ceil(out_h / 16.0) * ceil(out_w / 16.0)) AS BIGINT) AS tiles FROM po GROUP BY ALL)"


@query(_CANVAS + _PAY + " SELECT *, tiles * 768 AS rgb_bytes, tiles * 256 AS mask_bytes, tiles * 1024 AS all_bytes FROM pay", True)
def tile_payload(spark, sf):
    return levels.payload(_plan(spark, sf), 16, ["slide", "label"])


@query(_CANVAS + _PAY + """, big AS (SELECT l.label, l.slide, l.y * 4 + dy AS y, l.x * 4 + dx AS x FROM lab l, unnest(range(0, 4)) AS a(dy), unnest(range(0, 4)) AS b(dx)),
hit AS (SELECT DISTINCT po.slide, po.label, (b.y - po.y0) // 16 AS r, (b.x - po.x0) // 16 AS c FROM po JOIN big b ON b.slide = po.slide AND b.label = po.label WHERE po.level = 1 AND b.y >= po.y0 AND b.y < po.y1 AND b.x >= po.x0 AND b.x < po.x1),
p AS (SELECT slide, label, count(*) AS n FROM hit GROUP BY ALL), t AS (SELECT slide, label, CAST(ceil(out_h / 16.0) * ceil(out_w / 16.0) AS BIGINT) AS tiles FROM po WHERE level = 1)
SELECT slide, label, coalesce(n, 0) AS positive, tiles - coalesce(n, 0) AS empty, tiles FROM t LEFT JOIN p USING (slide, label)""", True)
def tile_activity(spark, sf):
    first = _plan(spark, sf).filter("level = 1")
    big = levels.project_labels(_labels(spark, sf).select("slide", "y", "x", "label"), 4.0, 4.0)
    j = big.join(first.select("slide", "label", "output_index", "canvas"), ["slide", "label"]).filter("y >= canvas.y0 AND y < canvas.y1 AND x >= canvas.x0 AND x < canvas.x1")
    marked = j.select("slide", "label", "output_index", F.floor((F.col("y") - F.col("canvas.y0")) / 16).alias("row"), F.floor((F.col("x") - F.col("canvas.x0")) / 16).alias("col"))
    return levels.activity(first, marked, 16, ["slide", "label"])


@query(_CANVAS + _PAY + ", s AS (SELECT slide, label, tiles, area FROM pay JOIN fr USING (slide, label)) SELECT slide, label, place FROM (SELECT slide, label, row_number() OVER (PARTITION BY slide ORDER BY tiles DESC, area DESC, label) AS place FROM s) WHERE place <= 3", True)
def select_heaviest(spark, sf):
    t = levels.payload(_plan(spark, sf), 16, ["slide", "label"]).join(_frames(spark, sf, "notebook_square_source").select("slide", "label", "area"), ["slide", "label"])
    return levels.select_tissues(t, "heaviest-tiles", 3).select("slide", "label", "place")


_BIG = "big AS (SELECT slide, ty AS y, tx AS x, label FROM lab, unnest(range(0, 160)) AS a(ty), unnest(range(0, 90)) AS b(tx) WHERE floor((ty + 0.5) / 2.5) = lab.y AND floor((tx + 0.5) / 1.4) = lab.x)"


@query(_LABEL + ", " + _BIG + " SELECT slide, y - 7 AS y, x - 11 AS x, label FROM big WHERE y BETWEEN 7 AND 99 AND x BETWEEN 11 AND 59", True)
def project_any_scale(spark, sf):
    return levels.project_labels(_labels(spark, sf).select("slide", "y", "x", "label"), 2.5, 1.4, (7, 11, 100, 60)).select("slide", "y", "x", "label")


@query("SELECT slide, y - 12 AS y, x - 12 AS x, v FROM raster WHERE y BETWEEN 12 AND 51 AND x BETWEEN 12 AND 51", True)
def centre_crop(spark, sf):
    return levels.centre_crop(pixels(spark, sf).select("slide", "y", "x", "v"), 64, 64, 40).select("slide", "y", "x", "v")


@query("""SELECT p_partkey AS id, CAST(floor(p_size / (256::DOUBLE / 100)) AS BIGINT) AS y0, CAST(ceil((p_size * 5) / (256::DOUBLE / 60)) AS BIGINT) AS x1, CAST(p_size % 5 AS BIGINT) AS top, CAST(p_size % 3 AS BIGINT) AS right,
  round(p_size * 0.75 / 0.5, 9) AS by0, round((p_size * 0.5 + (p_size + 3) * 2.0) / 0.25, 9) AS bx1 FROM part""")
def bounds_between_levels(spark, sf):
    n = F.col("p_size")
    b = G.bounds(n, n * 2, n * 4, n * 5)
    m = levels.to_level(b, F.lit(256), F.lit(256), F.lit(100), F.lit(60))
    e = levels.expansion(G.bounds(n - n % 5, n, n + 9, n + 9), G.bounds(n, n, n + 9, n + 9 - n % 3))
    p = levels.parent_bounds(F.array(F.lit(1.0), F.lit(3.0), F.lit(2.0)), F.array(F.lit(0.0), n * 0.75, n * 0.5), n, n + 3, F.lit(0.5), F.lit(0.25))
    return table(spark, sf, "part").select(F.col("p_partkey").alias("id"), m["y0"].alias("y0"), m["x1"].alias("x1"), e["top"].alias("top"), e["right"].alias("right"), F.round(p["y0"], 9).alias("by0"), F.round(p["x1"], 9).alias("bx1"))


@query("SELECT p_partkey AS id, p_size * 400 >= 8192 OR (p_size * 400) * (p_size * 211) * 9 >= 1500000000 AS big, round_even(p_retailprice, 0)::BIGINT * 4 AS x2, CAST(p_size AS BIGINT) * 4 AS y2 FROM part")
def tile_sizes(spark, sf):
    n = F.col("p_size").cast("long")
    v = levels.voxel_sizes(F.col("p_retailprice"), n, F.lit(30), 3)
    return table(spark, sf, "part").select(F.col("p_partkey").alias("id"), levels.is_big(n * 400, n * 211, 9).alias("big"), F.get(v, F.lit(2))["x"].alias("x2"), F.get(v, F.lit(2))["y"].alias("y2"))


@query("SELECT p_partkey AS id, concat_ws(';', CASE WHEN p_size % 3 <> 0 THEN 'baseline_config_mismatch:extra_margin_px:actual=' || p_size % 3 || ':baseline=0' END, CASE WHEN p_partkey % 2 = 0 THEN 'baseline_config_mismatch:compression_mode:actual=lossy:baseline=lossless' END, CASE WHEN p_size % 4 = 2 THEN 'estimate_source_level_matches_projection_baseline' END) AS warnings FROM part")
def baseline_warnings(spark, sf):
    c = table(spark, sf, "part").select("p_partkey", "p_size", (F.col("p_size") % 3).cast("string").alias("extra_margin_px"), F.when(F.col("p_partkey") % 2 == 0, "lossy").otherwise("lossless").alias("compression_mode"))
    return c.select(F.col("p_partkey").alias("id"), F.array_join(levels.baseline_warnings(c, F.col("p_size") % 4), ";").alias("warnings"))


@query("""WITH l AS (SELECT o_custkey AS id, o_orderkey AS level, o_totalprice AS um, o_totalprice / lag(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS r FROM orders), g AS (SELECT id, list_sort(list(r)) AS a FROM l WHERE r IS NOT NULL GROUP BY id)
SELECT id, round_even(a[len(a) // 2 + 1], 2) AS factor FROM g""")
def downsample_schedule(spark, sf):
    return levels.downsample_factor(table(spark, sf, "orders").select(F.col("o_custkey").alias("id"), F.col("o_orderkey").alias("level"), F.col("o_totalprice").alias("um")))


@query("""WITH l AS (SELECT p_partkey AS id, k AS level, greatest(p_size * 97 >> k, 1) AS h, greatest(p_size * 61 >> k, 1) AS w FROM part, unnest(range(0, 5)) AS u(k))
SELECT id, coalesce(max(CASE WHEN level = 0 AND h * w <= 1000000 THEN 0 END), max(CASE WHEN greatest(h, w) >= 512 THEN level END), max(level)) AS full_or_coarse, coalesce(max(CASE WHEN greatest(h, w) >= 512 THEN level END), max(level)) AS coarse FROM l GROUP BY id""")
def choose_level(spark, sf):
    n = F.col("p_size").cast("long")
    p = table(spark, sf, "part").select(F.col("p_partkey").alias("id"), (n * 97).alias("h"), (n * 61).alias("w"))
    at = frames.pyramid_shapes(p, 5).withColumn("level", F.col("level").cast("long"))
    a = levels.choose_level(at, 512, True, 1_000_000).withColumnRenamed("level", "full_or_coarse")
    return a.join(levels.choose_level(at, 512).withColumnRenamed("level", "coarse"), "id")


@query("SELECT o_orderkey AS k, round(CASE WHEN t > 0 THEN a / CAST(t AS DOUBLE) ELSE 0 END, 9) AS ratio, round(o_totalprice * CASE WHEN t > 0 THEN a / CAST(t AS DOUBLE) ELSE 0 END, 4) AS seconds, CAST(floor(1000003 * CASE WHEN t > 0 THEN a / CAST(t AS DOUBLE) ELSE 0 END) AS BIGINT) AS physical FROM (SELECT *, o_orderkey % 16 AS t, o_custkey AS a FROM orders)")
def tile_ratio(spark, sf):
    o = table(spark, sf, "orders")
    pilot = o.select(F.col("o_orderkey").alias("k"), (F.col("o_orderkey") % 16).alias("tiles"), F.col("o_totalprice").alias("seconds"), F.lit(1000003).alias("physical"), F.lit(7).alias("apparent"))
    p = levels.ratio_projection(pilot, o.select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("all_tiles")), "k")
    return p.select("k", F.round("ratio", 9).alias("ratio"), F.round("seconds", 4).alias("seconds"), "physical")


# --- validation by mode --------------------------------------------------------------------------------------------------

_SRC = """WITH m AS (SELECT o_orderkey AS row_number, CASE o_orderkey % 9 WHEN 0 THEN NULL WHEN 1 THEN '/d/a.VSI' WHEN 2 THEN '/d/a.ome.tif' WHEN 3 THEN '/d/a.tiff' WHEN 4 THEN 's3://b/x.ome.tiff' WHEN 5 THEN '/d/a.jpg' WHEN 6 THEN 'file:///d/b.ome.tif' WHEN 7 THEN '/d/folder.tif' ELSE '/d/empty.tif' END AS p FROM orders)"""


def _sources(spark, sf):
    k = F.col("o_orderkey")
    names = [None, "/d/a.VSI", "/d/a.ome.tif", "/d/a.tiff", "s3://b/x.ome.tiff", "/d/a.jpg", "file:///d/b.ome.tif", "/d/folder.tif", "/d/empty.tif"]
    return table(spark, sf, "orders").select(k.alias("row_number"), F.element_at(F.array(*[F.lit(n).cast("string") for n in names]), (k % 9 + 1).cast("int")).alias("source_path"))


@query(_SRC + """ SELECT row_number, CASE WHEN p IS NULL OR lower(p) LIKE '%.ome.tif' OR lower(p) LIKE '%.ome.tiff' OR lower(p) LIKE '%.tif' THEN NULL WHEN lower(p) LIKE '%.vsi' THEN 'WRONG_MODE_FOR_OMETIFF_UPLOAD' ELSE 'MODE_INPUT_EXTENSION_MISMATCH' END AS upload,
  CASE WHEN p IS NULL THEN NULL WHEN lower(p) LIKE '%.ome.tif' OR lower(p) LIKE '%.ome.tiff' THEN 'WRONG_MODE_FOR_SOURCE_CONVERSION' WHEN lower(p) LIKE '%.vsi' OR lower(p) LIKE '%.tif' THEN NULL ELSE 'MODE_INPUT_EXTENSION_MISMATCH' END AS convert,
  CASE WHEN p IS NULL THEN NULL WHEN lower(p) LIKE '%.ome.tif' OR lower(p) LIKE '%.ome.tiff' THEN 'WRONG_MODE_FOR_TISSUE_EXTRACTION' WHEN lower(p) LIKE '%.vsi' OR lower(p) LIKE '%.tif' THEN NULL ELSE 'MODE_INPUT_EXTENSION_MISMATCH' END AS extract FROM m""")
def mode_issues(spark, sf):
    code = lambda m: validation.mode_code(F.col("source_path"), m, [".vsi", ".tif"])
    return _sources(spark, sf).select("row_number", *[code(m).alias(n) for m, n in zip(validation.MODES, ("upload", "convert", "extract"), strict=True)])


@query(_SRC + """ SELECT row_number, CASE WHEN p IN ('/d/a.ome.tif', 'file:///d/b.ome.tif') THEN 77 WHEN p = '/d/empty.tif' THEN 0 END AS known_bytes,
  CASE WHEN p IN ('/d/a.ome.tif', 'file:///d/b.ome.tif', '/d/empty.tif') THEN 'known' WHEN p IS NULL THEN 'unknown_missing_source_path' WHEN p LIKE 's3%' THEN 'unknown_non_local_source' WHEN p = '/d/folder.tif' THEN 'unknown_not_regular_file' ELSE 'unknown_missing_local_source' END AS size_status,
  CASE WHEN p IS NULL THEN '' WHEN p IN ('/d/a.VSI', '/d/a.jpg', '/d/a.tiff') THEN 'OMETIFF_WRONG_MODE_EXTENSION;OMETIFF_MISSING_LOCAL_FILE' WHEN p LIKE 's3%' THEN 'OMETIFF_WRONG_MODE_EXTENSION;OMETIFF_NONLOCAL_DEFERRED' WHEN p = '/d/folder.tif' THEN 'OMETIFF_NOT_REGULAR_FILE' WHEN p = '/d/empty.tif' THEN 'OMETIFF_EMPTY_FILE' ELSE '' END AS codes FROM m""")
def structural_checks(spark, sf):
    there = spark.createDataFrame([("/d/a.ome.tif", 77, True), ("file:///d/b.ome.tif", 77, True), ("/d/folder.tif", 0, False), ("/d/empty.tif", 0, True)], "source_path string, length long, is_file boolean")
    return validation.structure(_sources(spark, sf), there, [".tif"])


@query("""SELECT o_orderkey AS id, CASE WHEN e > 0 OR (s AND w + d > 0) THEN 1 ELSE 0 END AS code, CASE WHEN e > 0 THEN 'Fix blocking manifest/path/profile/mode errors before continuing.' WHEN w + d > 0 THEN 'Resolve warnings or deferred requirements, or rerun setup without strict mode.' WHEN o_orderkey % 2 = 0 THEN 'Resolve setup findings before continuing.' ELSE 'Ready for OME-TIFF validation/package/upload follow-up.' END AS action,
  CASE WHEN e > 0 THEN 'fix_structural_issues' WHEN o_orderkey % 11 = 0 THEN 'ome_tiff_metadata_validation' WHEN d > 0 THEN 'resolve_deferred_checks' WHEN w > 0 THEN 'review_warnings' ELSE 'package_planning' END AS structure
FROM (SELECT *, CASE WHEN o_orderkey % 5 = 0 THEN 1 ELSE 0 END AS e, CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END AS w, CASE WHEN o_orderkey % 7 = 0 THEN 1 ELSE 0 END AS d, true AS s FROM orders)""")
def next_actions(spark, sf):
    k = F.col("o_orderkey")
    e, w, d = (F.when(k % n == 0, 1).otherwise(0) for n in (5, 3, 7))
    return table(spark, sf, "orders").select(
        k.alias("id"), validation.exit_code(e, w, d, True).alias("code"), validation.next_action(e, w, d, k % 2 != 0, "existing-ometiff-upload", True).alias("action"),
        validation.structure_action(e, w, d, k % 11 == 0)["action"].alias("structure"),
    )


@query(T._MAN + """, o AS (SELECT row_number, code, severity, row_number() OVER (PARTITION BY row_number ORDER BY code, field) AS place FROM iss)
SELECT row_number, coalesce(arg_min(CASE WHEN severity = 'error' THEN code END, CASE WHEN severity = 'error' THEN place END), 'PREFLIGHT_ROW_INVALID') AS blocked_reason, coalesce(max(CASE WHEN code = 'DEFERRED_NON_LOCAL_SOURCE_EXISTENCE' THEN code END), 'NON_LOCAL_SOURCE') AS deferred_reason FROM o GROUP BY 1""")
def row_reasons(spark, sf):
    from pyspark.sql.window import Window as W

    found = T._issues(spark, sf).withColumn("place", F.row_number().over(W.partitionBy("row_number").orderBy("code", "field")))
    return validation.reason(found)


# --- registration ----------------------------------------------------------------------------------------------------------

_ENT = """e AS (SELECT o_custkey AS run, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS place, CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey % 2 = 0 END AS present, CASE o_orderkey % 4 WHEN 0 THEN ' Present' WHEN 1 THEN 'missing' WHEN 2 THEN NULL ELSE '1' END AS status,
  '/x/s.' || o_orderkey || '.tif' AS path, CASE WHEN o_orderkey % 5 = 0 THEN 'S' || o_orderkey WHEN o_orderkey % 5 = 1 THEN '' END AS sample_id, o_custkey % 3 = 0 AS cut FROM orders)"""


@query("WITH " + _ENT + """ SELECT run, place, CASE WHEN cut THEN true ELSE coalesce(present, lower(trim(coalesce(status, ''))) IN ('present', 'true', '1')) END AS present, CASE WHEN cut THEN printf('slice_%04d', place) WHEN coalesce(sample_id, '') <> '' THEN sample_id ELSE regexp_extract(path, '/([^/]*)\\.tif$', 1) END AS sample_id,
  CASE WHEN cut THEN 'unknown' ELSE coalesce(status, CASE WHEN coalesce(present, false) THEN 'present' ELSE 'missing' END) END AS status FROM e""")
def transform_entries(spark, sf):
    from pyspark.sql.window import Window as W

    k = F.col("o_orderkey")
    place = F.row_number().over(W.partitionBy("o_custkey").orderBy("o_orderkey")) - 1
    e = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("run"), place.cast("long").alias("place"), F.when(k % 3 == 0, k % 2 == 0).alias("present"), F.when(k % 4 == 0, " Present").when(k % 4 == 1, "missing").when(k % 4 == 3, "1").alias("status"),
        F.concat(F.lit("/x/s."), k, F.lit(".tif")).alias("path"), F.when(k % 5 == 0, F.concat(F.lit("S"), k)).when(k % 5 == 1, "").alias("sample_id"), *[F.lit(None).cast("string").alias(c) for c in ("section_id", "source_id", "name")],
    )
    return registration.with_entries(e.select("run", "place"), e.filter("run % 3 <> 0 OR place > 0"))


@query("WITH s AS (SELECT o_custkey AS run, o_orderkey AS grid_index, o_totalprice AS v, CASE WHEN o_orderkey % 4 > 0 THEN o_orderkey % 4 END AS ok FROM orders), d AS (SELECT run, grid_index, row_number() OVER (PARTITION BY run ORDER BY grid_index) - 1 AS rank, v FROM s WHERE ok IS NOT NULL) SELECT s.run, s.grid_index, d.rank IS NOT NULL AS present, d.v FROM s LEFT JOIN d ON d.run = s.run AND d.grid_index = s.grid_index")
def dense_onto_grid(spark, sf):
    from pyspark.sql.window import Window as W

    s = table(spark, sf, "orders").select(F.col("o_custkey").alias("run"), F.col("o_orderkey").alias("grid_index"), F.col("o_totalprice").alias("v"))
    ranked = s.filter("grid_index % 4 > 0").withColumn("present_rank", F.row_number().over(W.partitionBy("run").orderBy("grid_index")) - 1)
    entries = s.select("run", "grid_index").join(ranked.select("run", "grid_index", "present_rank"), ["run", "grid_index"], "left")
    return registration.onto_grid(ranked.select("run", F.col("present_rank").alias("rank"), "v"), entries)


@query("""SELECT p_partkey AS id, CASE p_partkey % 5 WHEN 0 THEN 'eA2d_0' WHEN 1 THEN 'eA2d_5e3' WHEN 2 THEN 'eA2d_m1p25e-2' WHEN 3 THEN 'eA2d_2e5' ELSE 'eA2d_1p234568e6' END AS label FROM part""")
def sweep_labels(spark, sf):
    k = F.col("p_partkey") % 5
    return table(spark, sf, "part").select(F.col("p_partkey").alias("id"), registration.sweep_label(F.when(k == 0, 0.0).when(k == 1, 5000.0).when(k == 2, -0.0125).when(k == 3, 2e5).otherwise(1234567.89)).alias("label"))


@query("""SELECT p_partkey AS id, CASE p_partkey % 4 WHEN 0 THEN 'RAS' WHEN 1 THEN 'PIR' WHEN 2 THEN NULL ELSE NULL END AS code, CASE p_partkey % 4 WHEN 0 THEN '-1,0,0,0,-1,0,0,0,1' WHEN 1 THEN '0,0,-1,1,0,0,0,-1,0' END AS matrix FROM part""")
def orientation(spark, sf):
    k = F.col("p_partkey") % 4
    code = F.when(k == 0, " ras").when(k == 1, "PIR").when(k == 2, "RAR").otherwise("RA")
    m = registration.orientation_matrix(code, F.lit("LPS"))
    return table(spark, sf, "part").select(F.col("p_partkey").alias("id"), registration.valid_orientation(code).alias("code"), F.array_join(F.transform(m, lambda x: x.cast("int").cast("string")), ",").alias("matrix"))


@query("SELECT o_custkey AS id, '0' AS locked, concat_ws(',', CASE WHEN bool_or(o_orderkey % 3 = 1 AND x) THEN '1' END, CASE WHEN bool_or(o_orderkey % 3 = 2 AND x) THEN '2' END) AS unchanged FROM (SELECT *, o_totalprice >= 1000.0 * (o_orderkey % 200) AND o_orderkey % 2 = 0 AS x FROM orders WHERE o_orderkey IN (SELECT min(o_orderkey) FROM orders GROUP BY o_custkey, o_orderkey % 3)) GROUP BY o_custkey HAVING bool_or(o_orderkey % 3 = 0)")
def pre_resampling(spark, sf):
    o = table(spark, sf, "orders").withColumn("axis", (F.col("o_orderkey") % 3).cast("int"))
    one = o.groupBy("o_custkey", "axis").agg(F.min("o_orderkey").alias("o_orderkey")).join(o.select("o_orderkey", "o_totalprice"), "o_orderkey")
    axes = one.select(F.col("o_custkey").alias("id"), "axis", (1000.0 * (F.col("o_orderkey") % 200)).alias("target_working"), F.col("o_totalprice").alias("atlas_native"), F.when(F.col("o_orderkey") % 2 == 0, 1).otherwise(2).alias("atlas_factor"))
    return registration.pre_resampling(axes, "sectioned-stack").filter("locked = '0'")


@query("""WITH v AS (SELECT o_custkey % 40 AS k, unnest([o_totalprice, CASE WHEN o_custkey % 40 = 7 THEN o_totalprice ELSE o_orderkey END]) AS v FROM orders), s AS (SELECT k, quantile_cont(v, 0.01) AS p, quantile_cont(v, 0.99) AS q, min(v) AS a, max(v) AS b FROM v GROUP BY k)
SELECT k, round(CASE WHEN q > p THEN p WHEN b > a THEN a END, 6) AS lo, round(CASE WHEN q > p THEN q WHEN b > a THEN b END, 6) AS hi FROM s""")
def joint_percentiles(spark, sf):
    o = table(spark, sf, "orders").select((F.col("o_custkey") % 40).alias("k"), "o_totalprice", F.when(F.col("o_custkey") % 40 == 7, F.col("o_totalprice")).otherwise(F.col("o_orderkey").cast("double")).alias("b"))
    return registration.joint_range(o, "k", "o_totalprice", "b").withColumns({"lo": F.round("lo", 6), "hi": F.round("hi", 6)})


@query("SELECT o_custkey % 40 AS k, min(v) AS mu_b, round(quantile_cont(v, 0.999), 6) AS mu_a, round(coalesce(quantile_cont(CASE WHEN v > 0 THEN v END, 0.05), quantile_cont(v, 0.5)), 6) AS level FROM (SELECT *, CASE WHEN o_custkey % 40 < 5 THEN -o_totalprice ELSE o_totalprice - 50000 END AS v FROM orders) GROUP BY 1")
def intensity_anchors(spark, sf):
    v = F.when(F.col("o_custkey") % 40 < 5, -F.col("o_totalprice")).otherwise(F.col("o_totalprice") - 50000)
    o = table(spark, sf, "orders").select((F.col("o_custkey") % 40).alias("k"), v.alias("v"))
    j = registration.contrast_anchors(o, "k", "v").join(registration.auto_threshold(o, "k", "v"), "k")
    return j.withColumns({"mu_a": F.round("mu_a", 6), "level": F.round("level", 6)})


# --- names and records --------------------------------------------------------------------------------------------------------


@query(r"""SELECT o_orderkey AS id, CASE o_orderkey % 4 WHEN 0 THEN o_custkey % 90 WHEN 1 THEN 7 ELSE 1000000000 END AS xx, CASE o_orderkey % 4 WHEN 0 THEN o_orderkey % 8 WHEN 1 THEN 12 ELSE 1000000000 END AS yy,
  CASE o_orderkey % 4 WHEN 0 THEN 'E.1_img_' || o_custkey % 90 WHEN 1 THEN 'e.1_IMG_x_7' WHEN 2 THEN 'Ex1_img' ELSE 'other' END AS source, CASE o_orderkey % 4 WHEN 0 THEN o_orderkey % 8 WHEN 1 THEN 12 WHEN 2 THEN 3 ELSE 0 END AS tile FROM orders""")
def tile_names(spark, sf):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    name = F.when(k % 4 == 0, F.concat(F.lit("E.1_img_"), c % 90, F.lit("_"), k % 8, F.lit("_0011.tif"))).when(k % 4 == 1, "e.1_IMG_x_7_12.png").when(k % 4 == 2, "Ex1_img_3.png").otherwise("other_0021.png")
    xy = N.xy_of(name, N.xy_pattern("in/E.1_img*.jpg"))
    st = N.source_and_tile(name)
    return table(spark, sf, "orders").select(k.alias("id"), xy["xx"].alias("xx"), xy["yy"].alias("yy"), st["source"].alias("source"), st["tile"].alias("tile"))


@query("SELECT p_partkey AS id, CASE p_partkey % 3 WHEN 0 THEN 'brain_s' || printf('%03d', p_size) WHEN 1 THEN 'brain_s' || printf('%04d', p_size) ELSE 'a_b_' || printf('%01d', p_size) END || '.png' AS missing FROM part")
def missing_names(spark, sf):
    k = F.col("p_partkey") % 3
    ref = F.when(k == 0, "/x/brain_s007.tif").when(k == 1, "brain_s.tif").otherwise("a_b_5.tif")
    return table(spark, sf, "part").select(F.col("p_partkey").alias("id"), N.missing_like(ref, F.col("p_size"), ".png").alias("missing"))


@query("""WITH f AS (SELECT o_orderkey AS k, 'im' || o_orderkey % 50 || '_' || o_orderkey % 7 AS base FROM orders), m AS (SELECT DISTINCT base || '.tif' AS name, 'S' || base AS s, CAST(3 AS INTEGER) AS t FROM f WHERE k % 3 = 0)
SELECT f.k, coalesce(a.s, b.s, regexp_extract(f.base, '^(.+)_\\d+$', 1)) AS source_image, coalesce(a.t, b.t, CAST(regexp_extract(f.base, '_(\\d+)$', 1) AS INTEGER)) AS tile, CASE WHEN a.s IS NOT NULL OR b.s IS NOT NULL THEN 10 ELSE 0 END AS width
FROM f LEFT JOIN m a ON a.name = f.base || CASE WHEN f.k % 2 = 0 THEN '_0031' ELSE '' END || '.tif' LEFT JOIN m b ON b.name = f.base || '.tif'""")
def file_metadata(spark, sf):
    k = F.col("o_orderkey")
    base = F.concat(F.lit("im"), k % 50, F.lit("_"), k % 7)
    o = table(spark, sf, "orders").select(k.alias("k"), base.alias("base"))
    files = o.select("k", F.concat("base", F.when(F.col("k") % 2 == 0, "_0031").otherwise(""), F.lit(".tif")).alias("filename"))
    meta = o.filter("k % 3 = 0").select(F.concat("base", F.lit(".tif")).alias("name"), F.concat(F.lit("S"), "base").alias("source_image"), F.lit(3).alias("tile"), F.lit(10).alias("width"), F.lit(20).alias("height")).distinct()
    return qc.with_metadata(files, meta).select("k", "source_image", "tile", "width")


@query("""SELECT set_id, place, CAST(floor((place - lo) / cols) * ch AS BIGINT) AS y, CAST(((place - lo) % cols) * cw AS BIGINT) AS x FROM (SELECT o_custkey AS set_id, row_number() OVER w - 1 AS place, 0 AS lo, CAST(ceil(sqrt(count(*) OVER (PARTITION BY o_custkey))) AS BIGINT) AS cols, max(o_orderkey % 97) OVER (PARTITION BY o_custkey) AS ch, max(o_orderkey % 89) OVER (PARTITION BY o_custkey) AS cw FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey))""")
def mosaic_places(spark, sf):
    from pyspark.sql.window import Window as W

    k = F.col("o_orderkey")
    place = (F.row_number().over(W.partitionBy("o_custkey").orderBy("o_orderkey")) - 1).alias("place")
    return qc.mosaic(table(spark, sf, "orders").select(F.col("o_custkey").alias("set_id"), place, (k % 97).alias("h"), (k % 89).alias("w")))


@query("SELECT user_id AS run, round(coalesce(sum(value) FILTER (event_type = 'click'), 0), 4) AS click, round(coalesce(sum(value) FILTER (event_type = 'none'), 0), 4) AS none FROM events GROUP BY 1")
def stage_timers(spark, sf):
    t = table(spark, sf, "events").select(F.col("user_id").alias("run"), F.col("event_type").alias("stage"), F.col("value").alias("seconds"))
    return qc.stage_seconds(t, ["click", "none"]).withColumns({"click": F.round("click", 4), "none": F.round("none", 4)})


@query("""WITH e AS (SELECT o_custkey AS set_id, o_orderkey AS place, ['.tif', '.png', '.jpg', '.TIF', '.txt'][o_orderkey % 5 + 1] AS x FROM orders), n AS (SELECT set_id, lower(x) AS ext, count(*) AS n, min(place) AS f FROM e WHERE x <> '.txt' GROUP BY ALL) SELECT set_id, arg_max(ext, (n, -f)) AS ext FROM n GROUP BY 1""")
def common_extension(spark, sf):
    k = F.col("o_orderkey")
    names = F.element_at(F.array(*map(F.lit, (".tif", ".png", ".jpg", ".TIF", ".txt"))), (k % 5 + 1).cast("int"))
    return qc.most_common_extension(table(spark, sf, "orders").select(F.col("o_custkey").alias("set_id"), k.alias("place"), F.concat(F.lit("d.x/a"), names).alias("name")), [".tif", ".tiff", ".png", ".jpg", ".jpeg"])


@query("SELECT event_id AS id, CASE WHEN event_id % 3 = 0 AND event_id % 2 = 0 THEN 'ns' ELSE 'local' END AS dataset_namespace, CASE WHEN event_id % 3 = 0 THEN 'd' || user_id ELSE 'f' || user_id || '.zarr' END AS dataset_name FROM events")
def lineage_datasets(spark, sf):
    k = F.col("event_id")
    rows = table(spark, sf, "events").select(k.alias("id"), F.when(k % 3 == 0, F.concat(F.lit("d"), "user_id")).alias("ds_name"), F.when(k % 2 == 0, "ns").alias("ds_namespace"), F.concat(F.lit("/a/b/f"), "user_id", F.lit(".zarr/")).alias("ds_path"))
    return lineage.datasets(rows, "local").select("id", "dataset_namespace", "dataset_name")


@query("SELECT 'run' || user_id AS run_id, arg_min('job' || user_id % 7, (ts, event_id)) AS job, count(*) AS n_events, string_agg(event_id::VARCHAR, ',' ORDER BY ts, event_id) AS ids FROM events GROUP BY user_id")
def run_details(spark, sf):
    d = lineage.run_details(T._lineage(spark, sf))
    return d.select("run_id", "job", "n_events", F.array_join(F.transform("events", lambda e: e["event_id"].cast("string")), ",").alias("ids"))


# --- meshes -------------------------------------------------------------------------------------------------------------------------


@query(T._MESH + ", n AS (SELECT mesh, count(*) AS n FROM ve GROUP BY 1), x AS (SELECT mesh, f, CASE WHEN f % 50 = 0 THEN NULL ELSE v0 END AS v0, v1, v2 FROM fa) SELECT x.mesh, f, CASE WHEN v0 IS NULL THEN 'missing_corner' ELSE 'corner_out_of_range' END AS fault FROM x JOIN n USING (mesh) WHERE v0 IS NULL OR greatest(v0, v1, v2) >= n")
def face_faults(spark, sf):
    ve, fa = T._mesh(spark, sf)
    return mesh.face_faults(fa.withColumn("v0", F.when(F.col("f") % 50 != 0, F.col("v0"))), ve)


@query(T._MESH + """, g AS (SELECT mesh, CAST(floor(x / 8) AS BIGINT) * 100 + CAST(floor(y / 8) AS BIGINT) AS cell, count(*) AS n FROM ve WHERE x < 40 GROUP BY ALL), r AS (SELECT *, n / CAST(sum(n) OVER (PARTITION BY mesh) AS DOUBLE) * 333 AS raw FROM g),
wh AS (SELECT *, least(CAST(floor(raw) AS BIGINT), n) AS w FROM r), s AS (SELECT *, 333 - sum(w) OVER (PARTITION BY mesh) AS rest, row_number() OVER (PARTITION BY mesh ORDER BY w < n DESC, raw - w DESC, cell) AS p FROM wh) SELECT mesh, cell, n, w + CASE WHEN w < n AND p <= rest THEN 1 ELSE 0 END AS quota FROM s""")
def point_quotas(spark, sf):
    ve, _ = T._mesh(spark, sf)
    g = ve.filter("x < 40").groupBy("mesh", (F.floor(F.col("x") / 8) * 100 + F.floor(F.col("y") / 8)).alias("cell")).agg(F.count(F.lit(1)).alias("n"))
    return mesh.quotas(g, 333)


@query("SELECT p_partkey AS id, round(sqrt(2.0 / sqrt(3.0) * p_retailprice / p_size), 9) AS spacing, CAST(round_even(2.0 / sqrt(3.0) * p_retailprice / (p_size * p_size), 0) AS BIGINT) AS n FROM part")
def hexagon_packing(spark, sf):
    return table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.round(mesh.spacing_of_count(F.col("p_retailprice"), F.col("p_size")), 9).alias("spacing"), mesh.count_of_spacing(F.col("p_retailprice"), F.col("p_size").cast("double")).alias("n"))


@query("""WITH s AS (SELECT l_orderkey AS segment, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS place, l_quantity AS value FROM lineitem), g AS (SELECT segment, count(*) AS n, arg_min(value, place) AS a, arg_max(value, place) AS b, min(value) AS lo, max(value) AS hi FROM s GROUP BY 1)
SELECT segment, CASE WHEN n = 2 THEN (a > 25.5 AND b < 25.5) OR (a < 25.5 AND b > 25.5) ELSE lo < 25.5 AND hi > 25.5 END AS crosses FROM g""")
def isovalue_crossings(spark, sf):
    from pyspark.sql.window import Window as W

    place = F.row_number().over(W.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"))
    return mesh.crosses(table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("segment"), place.alias("place"), F.col("l_quantity").alias("value")), 25.5)


@query(T._MESH + """, k AS (SELECT fa.mesh, fa.f, p0.x AS ox, p0.y AS oy, p0.z AS oz, (p1.y - p0.y) * (p2.z - p0.z) - (p1.z - p0.z) * (p2.y - p0.y) AS a, (p1.z - p0.z) * (p2.x - p0.x) - (p1.x - p0.x) * (p2.z - p0.z) AS b, (p1.x - p0.x) * (p2.y - p0.y) - (p1.y - p0.y) * (p2.x - p0.x) AS c
  FROM fa JOIN ve p0 ON p0.k = fa.mesh * 4096 + v0 JOIN ve p1 ON p1.k = fa.mesh * 4096 + v1 JOIN ve p2 ON p2.k = fa.mesh * 4096 + v2 WHERE fa.f % 16 = 0)
SELECT k.mesh, k.f FROM k JOIN ve ON ve.mesh = k.mesh GROUP BY k.mesh, k.f HAVING max(abs((ve.x - ox) * a + (ve.y - oy) * b + (ve.z - oz) * c) / sqrt(a * a + b * b + c * c)) < 48.5""")
def thin_faces(spark, sf):
    ve, fa = T._mesh(spark, sf)
    return mesh.thin_faces(ve, fa.filter("f % 16 = 0"), 48.5)


@query()
def vertices_apart(spark, sf):
    return mesh.sample_apart(T._mesh(spark, sf)[0].filter("z >= 40"), 4.0)


@query("SELECT slide, count(*) FILTER (v >= 47) AS kept, count(*) AS n FROM raster WHERE v >= 45 GROUP BY slide", True)
def masked_display(spark, sf):
    m = raster.masked(pixels(spark, sf).filter("v >= 45"), foreground(spark, sf).join(pixels(spark, sf).filter("v >= 47"), ["slide", "y", "x"], "left_semi"), ["v"], fill=255)
    return m.groupBy("slide").agg(F.count_if(F.col("v") != 255).alias("kept"), F.count(F.lit(1)).alias("n"))
