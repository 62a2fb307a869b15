"""The queries of this library's operators over the driver's tables, and the DuckDB SQL that gives the same rows.

The rasters are made from lineitem: four slides of 64 x 64 cells, v in 1..50, and a mask where v >= 45.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import geometry as G
from tessera.functions import pixels as P
from tessera.operators import frames, raster, regions, sampling_plan, tissue

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
SIDE = 64

_R = """WITH RECURSIVE raster AS (
  SELECT l_suppkey % 4 AS slide, l_orderkey % 64 AS y, l_partkey % 64 AS x, CAST(max(l_quantity) AS INTEGER) AS v,
         CAST(floor(max(l_extendedprice)) AS BIGINT) % 256 AS g
  FROM lineitem GROUP BY 1, 2, 3),
rgb AS (SELECT slide, y, x, v, CAST(v * 5 AS BIGINT) AS r, g, CAST((v * 7) % 256 AS BIGINT) AS b FROM raster),
mask AS (SELECT slide, y, x FROM raster WHERE v >= 45)"""


def query(sql: str | None = None, with_raster: bool = False):
    """Register a query under its function's name."""

    def put(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = (_R + (", " if with_raster and sql.lstrip()[:6].upper() != "SELECT" else " ") + sql) if with_raster else sql
        return f

    return put


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def pixels(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    keys = [(F.col("l_suppkey") % 4).alias("slide"), (F.col("l_orderkey") % 64).alias("y"), (F.col("l_partkey") % 64).alias("x")]
    r = li.groupBy(*keys).agg(F.max("l_quantity").cast("int").alias("v"), (F.floor(F.max("l_extendedprice")) % 256).alias("g"))
    return r.select("slide", "y", "x", "v", (F.col("v") * 5).cast("long").alias("r"), "g", (F.col("v") * 7 % 256).cast("long").alias("b"))


def foreground(spark: SparkSession, sf: str) -> DataFrame:
    return pixels(spark, sf).filter("v >= 45").select("slide", "y", "x")


def _unit() -> list:
    return [P.unit(F.col(c)) for c in "rgb"]


# --- pixels and thresholds --------------------------------------------------------------------------------------------


@query("SELECT slide, y, x, round(0.2125::DOUBLE * r + 0.7154::DOUBLE * g + 0.0721::DOUBLE * b, 6) AS gray FROM rgb", True)
def gray_project(spark, sf):
    return pixels(spark, sf).select("slide", "y", "x", F.round(P.gray(F.col("r"), F.col("g"), F.col("b")), 6).alias("gray"))


_HE = """f AS (SELECT slide, y, x, r / 255.0 AS r, g / 255.0 AS g, b / 255.0 AS b FROM rgb),
he AS (SELECT slide, y, x, CASE WHEN greatest(r, g, b) > 0 THEN (greatest(r, g, b) - least(r, g, b)) / greatest(r, g, b) ELSE 0 END AS sat,
  -ln(greatest(r, 1 / 255.0)) - ln(greatest(g, 1 / 255.0)) - ln(greatest(b, 1 / 255.0)) AS od, (r + g + b) / 3 AS intensity FROM f)"""


@query(_HE + " SELECT slide, y, x, round(sat, 6) AS saturation, round(od, 6) AS od FROM he", True)
def he_features(spark, sf):
    r, g, b = _unit()
    return pixels(spark, sf).select("slide", "y", "x", F.round(P.saturation(r, g, b), 6).alias("saturation"), F.round(P.optical_density(r, g, b), 6).alias("od"))


def _tones(spark, sf):
    r, g, b = _unit()
    return pixels(spark, sf).select("slide", "y", "x", P.saturation(r, g, b).alias("sat"), P.optical_density(r, g, b).alias("od"), ((r + g + b) / 3).alias("intensity"))


def _stain_sql(k: int) -> str:
    parts = [f"ln(greatest({c}, 1e-6::DOUBLE)) / ({P.LOG_FLOOR!r}::DOUBLE) * ({float(P.UNMIX[i, k])!r}::DOUBLE)" for i, c in enumerate("rgb")]
    return f"greatest({' + '.join(parts)}, 0)"


@query("f AS (SELECT slide, y, x, r / 255.0 AS r, g / 255.0 AS g, b / 255.0 AS b FROM rgb) SELECT slide, y, x, " + f"round({_stain_sql(0)}, 6) AS hematoxylin, round({_stain_sql(1)}, 6) AS eosin FROM f", True)
def stain_unmixing(spark, sf):
    r, g, b = _unit()
    return pixels(spark, sf).select("slide", "y", "x", F.round(P.stain(r, g, b, 0), 6).alias("hematoxylin"), F.round(P.stain(r, g, b, 1), 6).alias("eosin"))


@query(_HE + " SELECT slide, count(*) AS n FROM he WHERE sat >= 0.08 AND od >= 0.35 GROUP BY slide", True)
def stain_gate_fixed(spark, sf):
    return _tones(spark, sf).filter("sat >= 0.08 AND od >= 0.35").groupBy("slide").agg(F.count(F.lit(1)).alias("n"))


@query(_HE + """, c AS (SELECT slide, quantile_cont(intensity, 0.8) AS cut FROM he GROUP BY slide),
bg AS (SELECT he.* FROM he JOIN c USING (slide) WHERE intensity >= cut),
m AS (SELECT slide, median(od) AS m FROM bg GROUP BY slide)
SELECT bg.slide, round(greatest(0.35, any_value(m) + 4 * 1.4826 * median(abs(od - m))), 6) AS threshold FROM bg JOIN m ON bg.slide = m.slide GROUP BY bg.slide""", True)
def stain_gate_adaptive_od(spark, sf):
    return raster.adaptive_threshold(_tones(spark, sf), "od", "intensity", 0.35).select("slide", F.round("threshold", 6).alias("threshold"))


_OTSU = """h AS (SELECT slide, v AS bin, count(*) AS n, count(*) * v AS s FROM raster GROUP BY slide, v),
c AS (SELECT slide, bin, CAST(sum(n) OVER w AS DOUBLE) AS w0, CAST(sum(s) OVER w AS DOUBLE) AS s0, CAST(sum(n) OVER p AS DOUBLE) AS wt, CAST(sum(s) OVER p AS DOUBLE) AS st
  FROM h WINDOW w AS (PARTITION BY slide ORDER BY bin ROWS UNBOUNDED PRECEDING), p AS (PARTITION BY slide)),
o AS (SELECT slide, arg_min(bin, (-(pow(s0 / w0 - (st - s0) / (wt - w0), 2) * w0 * (wt - w0)), bin)) AS threshold FROM c WHERE w0 < wt GROUP BY slide)"""


@query(_OTSU + " SELECT slide, threshold FROM o", True)
def otsu_threshold(spark, sf):
    return raster.otsu(pixels(spark, sf))


@query(_OTSU + " SELECT slide, count(*) AS n FROM raster JOIN o USING (slide) WHERE v > threshold GROUP BY slide", True)
def otsu_mask(spark, sf):
    p = pixels(spark, sf)
    return raster.threshold_mask(p, raster.otsu(p)).groupBy("slide").agg(F.count(F.lit(1)).alias("n"))


def _scan(spark, sf):
    """Whole slides as (slide, y, x, gray, stained): cells without a row are white."""
    r, g, b = _unit()
    stained = (P.saturation(r, g, b) >= 0.08) & (P.optical_density(r, g, b) >= 0.35)
    p = pixels(spark, sf)
    seen = p.select("slide", "y", "x", P.gray(F.col("r"), F.col("g"), F.col("b")).alias("gray"), stained.alias("stained"))
    frame = tissue._frame(p.select("slide").distinct(), SIDE, SIDE).join(seen, ["slide", "y", "x"], "left")
    return frame.select("slide", "y", "x", F.coalesce("gray", F.lit(255.0)).alias("gray"), F.coalesce("stained", F.lit(False)).alias("stained"))


@query()
def otsu_tissue_mask(spark, sf):
    s = _scan(spark, sf)
    return tissue.otsu_mask(s, 1, 12, SIDE, SIDE, s.filter("stained"), 1, "gray")


@query()
def entropy_tissue_mask(spark, sf):
    s = _scan(spark, sf)
    return tissue.entropy_mask(s, 2, 12, SIDE, SIDE, s.filter("stained"), 1, "gray")


@query("m AS (SELECT slide, min(v) AS lo, max(v) AS hi FROM raster GROUP BY slide) SELECT slide, y, x, CAST(round_even((v - lo) / CAST(CASE WHEN hi > lo THEN hi - lo ELSE 1 END AS DOUBLE) * 255.0, 0) AS INTEGER) AS u8 FROM raster JOIN m USING (slide)", True)
def min_max_uint8(spark, sf):
    p = pixels(spark, sf)
    ends = p.groupBy("slide").agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    return p.join(F.broadcast(ends), "slide").select("slide", "y", "x", P.to_uint8(F.col("v"), F.col("lo"), F.col("hi")).alias("u8"))


# --- stencils -----------------------------------------------------------------------------------------------------------


@query("""t AS (SELECT k, exp(-(k * k) / 2.0) AS w FROM (SELECT unnest(range(-2, 3)) AS k)),
a AS (SELECT p.slide, p.y, p.x, sum(w * q.v) / sum(w) AS v FROM raster p, t, raster q WHERE q.slide = p.slide AND q.x = p.x AND q.y = p.y + k GROUP BY ALL)
SELECT p.slide, p.y, p.x, round(sum(w * q.v) / sum(w), 6) AS val FROM a p, t, a q WHERE q.slide = p.slide AND q.y = p.y AND q.x = p.x + k GROUP BY ALL""", True)
def gaussian_blur(spark, sf):
    return raster.gaussian(pixels(spark, sf)).select("slide", "y", "x", F.round("val", 6).alias("val"))


_DISK = "d AS (SELECT dy, dx FROM (SELECT unnest(range(-{r}, {r} + 1)) AS dy), (SELECT unnest(range(-{r}, {r} + 1)) AS dx) WHERE dy * dy + dx * dx <= {r} * {r})"


@query(_DISK.format(r=2) + """, c AS (SELECT p.slide, p.y, p.x, q.v, count(*) AS n FROM raster p, d, raster q WHERE q.slide = p.slide AND q.y = p.y + dy AND q.x = p.x + dx GROUP BY ALL),
s AS (SELECT slide, y, x, n / CAST(sum(n) OVER (PARTITION BY slide, y, x) AS DOUBLE) AS p FROM c)
SELECT slide, y, x, round(sum(-p * log2(p)), 6) AS entropy FROM s GROUP BY ALL""", True)
def local_entropy(spark, sf):
    # -0.0 and tiny negatives of a single value round to 0.
    return raster.local_entropy(pixels(spark, sf), 2).select("slide", "y", "x", (F.round("entropy", 6) + F.lit(0.0)).alias("entropy"))


_MORPH = _DISK.format(r=1) + """, big AS (SELECT DISTINCT slide, y + dy AS y, x + dx AS x FROM mask, d),
dil AS (SELECT * FROM big WHERE y BETWEEN 0 AND 63 AND x BETWEEN 0 AND 63),
ero AS (SELECT m.slide, m.y, m.x FROM mask m, d, mask q WHERE q.slide = m.slide AND q.y = m.y + dy AND q.x = m.x + dx GROUP BY ALL HAVING count(*) = 5),
clo AS (SELECT m.slide, m.y, m.x FROM big m, d, big q WHERE q.slide = m.slide AND q.y = m.y + dy AND q.x = m.x + dx GROUP BY ALL HAVING count(*) = 5),
ope AS (SELECT DISTINCT slide, y + dy AS y, x + dx AS x FROM ero, d WHERE y + dy BETWEEN 0 AND 63 AND x + dx BETWEEN 0 AND 63)"""


@query(_MORPH + " SELECT * FROM dil", True)
def binary_dilate(spark, sf):
    return raster.dilate(foreground(spark, sf), 1, SIDE, SIDE)


@query(_MORPH + " SELECT * FROM ero", True)
def binary_erode(spark, sf):
    return raster.erode(foreground(spark, sf), 1)


@query(_MORPH + " SELECT * FROM clo WHERE y BETWEEN 0 AND 63 AND x BETWEEN 0 AND 63", True)
def binary_close(spark, sf):
    return raster.closing(foreground(spark, sf), 1, SIDE, SIDE)


@query(_MORPH + " SELECT * FROM ope", True)
def binary_open(spark, sf):
    return raster.opening(foreground(spark, sf), 1, SIDE, SIDE)


# --- regions --------------------------------------------------------------------------------------------------------------

_SPAN = regions.SPAN
_LABEL = f"""reach AS (SELECT slide, y, x, y * {_SPAN} + x AS root FROM mask
  UNION SELECT m.slide, m.y, m.x, r.root FROM reach r JOIN mask m ON m.slide = r.slide AND abs(m.y - r.y) <= 1 AND abs(m.x - r.x) <= 1),
lab AS (SELECT slide, y, x, min(root) AS label FROM reach GROUP BY slide, y, x)"""
_BOX = _LABEL + """, box AS (SELECT slide, label, count(*) AS area, min(y) AS y0, min(x) AS x0, max(y) + 1 AS y1, max(x) + 1 AS x1, avg(y) AS cy, avg(x) AS cx FROM lab GROUP BY slide, label),
ord1 AS (SELECT *, CAST(row_number() OVER (PARTITION BY slide ORDER BY cx, label) - 1 AS INTEGER) AS tile_index FROM box),
ord AS (SELECT *, CAST(row_number() OVER (PARTITION BY slide ORDER BY area DESC, tile_index) AS INTEGER) AS area_rank, area / sum(area) OVER (PARTITION BY slide) AS area_fraction FROM ord1)"""


def _labels(spark, sf):
    return regions.label(foreground(spark, sf))


@query(_LABEL + " SELECT slide, y, x, label FROM lab", True)
def components(spark, sf):
    # Blocks of 16, so that the border pass is exercised on this small raster.
    return regions.label(foreground(spark, sf), block=16)


@query(f"""bgr AS (SELECT s.slide, gy.y, gx.x FROM (SELECT DISTINCT slide FROM mask) s, (SELECT unnest(range(0, 64)) AS y) gy, (SELECT unnest(range(0, 64)) AS x) gx
  WHERE NOT EXISTS (SELECT 1 FROM mask m WHERE m.slide = s.slide AND m.y = gy.y AND m.x = gx.x)),
outer_ AS (SELECT slide, y, x FROM bgr WHERE y IN (0, 63) OR x IN (0, 63)
  UNION SELECT b.slide, b.y, b.x FROM outer_ o JOIN bgr b ON b.slide = o.slide AND abs(b.y - o.y) + abs(b.x - o.x) = 1)
SELECT slide, y, x FROM mask UNION ALL (SELECT slide, y, x FROM bgr EXCEPT SELECT slide, y, x FROM outer_)""", True)
def fill_holes(spark, sf):
    return regions.fill_holes(foreground(spark, sf), SIDE, SIDE)


@query(_LABEL + " SELECT slide, y, x, label FROM lab QUALIFY count(*) OVER (PARTITION BY slide, label) >= 8", True)
def remove_small(spark, sf):
    return regions.remove_small(_labels(spark, sf), 8)


@query(_BOX + ", k AS (SELECT slide, label FROM box QUALIFY row_number() OVER (PARTITION BY slide ORDER BY area DESC, label) <= 3) SELECT slide, y, x, label FROM lab JOIN k USING (slide, label)", True)
def keep_top_k(spark, sf):
    return regions.keep_top_k(_labels(spark, sf), 3)


@query(_BOX + " SELECT slide, label, area, tile_index, area_rank, round(area_fraction, 9) AS area_fraction FROM ord", True)
def component_order(spark, sf):
    r = regions.ordered(regions.boxes(_labels(spark, sf)))
    return r.select("slide", "label", "area", "tile_index", "area_rank", F.round("area_fraction", 9).alias("area_fraction"))


@query(_BOX + ", " + _HE + """, tone AS (SELECT l.slide, l.label, avg(CASE WHEN l.y IN (0, 63) OR l.x IN (0, 63) THEN 1.0 ELSE 0.0 END) AS edge, avg(intensity) AS mi, avg(od) AS mo, avg(CASE WHEN od >= 0.35 THEN 1.0 ELSE 0.0 END) AS st
  FROM lab l LEFT JOIN he USING (slide, y, x) GROUP BY ALL),
q AS (SELECT ord.*, edge, mi, mo, st, greatest(y1 - y0, x1 - x0) / CAST(least(y1 - y0, x1 - x0) AS DOUBLE) AS ar, least(y1 - y0, x1 - x0) / CAST(greatest(y1 - y0, x1 - x0) AS DOUBLE) AS th, area / CAST((y1 - y0) * (x1 - x0) AS DOUBLE) AS ex FROM ord JOIN tone USING (slide, label))
SELECT slide, label, area_rank, round(edge, 6) AS edge_contact_fraction, round(mo, 6) AS mean_od, round(st, 6) AS stain_fraction, round(ar, 6) AS aspect_ratio, round(ex, 6) AS extent,
  concat_ws(';', CASE WHEN area_fraction < 0.035 AND st < 0.35 AND mo < 0.55 THEN 'tiny_low_od_fragment' END, CASE WHEN area_rank > 4 AND area_fraction < 0.12 AND st < 0.45 THEN 'low_rank_low_stain_component' END,
    CASE WHEN ar >= 7 AND th <= 0.14 AND st < 0.55 THEN 'thin_low_stain_component' END, CASE WHEN edge > 0.18 AND ar >= 5 AND ex < 0.45 THEN 'edge_strip' END) AS artifact_reason FROM q""", True)
def component_qc(spark, sf):
    r = regions.score(_labels(spark, sf), _tones(spark, sf), SIDE, SIDE)
    return r.select("slide", "label", "area_rank", *[F.round(c, 6).alias(c) for c in ("edge_contact_fraction", "mean_od", "stain_fraction", "aspect_ratio", "extent")], "artifact_reason")


@query(_LABEL + ", " + _DISK.format(r=1) + """, ero AS (SELECT m.slide, m.y, m.x FROM mask m, d, mask q WHERE q.slide = m.slide AND q.y = m.y + dy AND q.x = m.x + dx GROUP BY ALL HAVING count(*) = 5),
ring AS (SELECT slide, y, x FROM mask EXCEPT SELECT slide, y, x FROM ero)
SELECT l.slide, l.label, count(r.y) AS contact, round(count(r.y) / CAST(count(*) AS DOUBLE), 9) AS fraction FROM lab l LEFT JOIN ring r ON r.slide = l.slide AND r.y = l.y AND r.x = l.x GROUP BY ALL""", True)
def boundary_contact(spark, sf):
    lab = _labels(spark, sf)
    return regions.boundary_contact(lab, lab, 1).withColumn("fraction", F.round("fraction", 9))


@query()
def distance_transform(spark, sf):
    return regions.distance_transform(_labels(spark, sf))


@query()
def solidity(spark, sf):
    return regions.solidity(_labels(spark, sf))


@query()
def watershed_split(spark, sf):
    return regions.split_touching(_labels(spark, sf), radius=1, min_area=8)


@query()
def trim_appendages(spark, sf):
    stained = pixels(spark, sf).filter("v >= 46").select("slide", "y", "x")
    return regions.trim_appendages(_labels(spark, sf), stained, 16)


# --- frames, levels, blocks -----------------------------------------------------------------------------------------------

_FRAME = _BOX + """, fr AS (SELECT slide, label, area, y0 * 4 AS my0, x0 * 4 AS mx0, y1 * 4 AS my1, x1 * 4 AS mx1, y0, x0, y1, x1 FROM box WHERE area >= 6)"""


def _frames(spark, sf, policy):
    box = regions.boxes(_labels(spark, sf)).filter("area >= 6")
    box = box.withColumns({"scale_y": F.lit(4.0), "scale_x": F.lit(4.0), "source_h": F.lit(256).cast("long"), "source_w": F.lit(256).cast("long")})
    return frames.frame_specs(box, policy, 16, 2)


def _canvas(df):
    c, k = F.col("canvas"), F.col("clipped")
    return df.select("slide", "label", *[c[n].alias(n) for n in ("y0", "x0", "y1", "x1")], k["y0"].alias("cy0"), k["x1"].alias("cx1"), F.col("padding.top").alias("top"))


_OUT = "SELECT slide, label, {y} AS y0, {x} AS x0, {y} + {h} AS y1, {x} + {w} AS x1, least(greatest({y}, 0), 256) AS cy0, least(greatest({x} + {w}, 0), 256) AS cx1, least(greatest({y}, 0), 256) - {y} AS top FROM s"


def _frame_sql(side: str, y: str, x: str, h: str = "side", w: str = "side") -> str:
    cast = "CAST(floor({}) AS BIGINT)"
    return _FRAME + f", s AS (SELECT *, {side} FROM fr) " + _OUT.format(y=cast.format(y), x=cast.format(x), h=h, w=w)


@query(_frame_sql("CAST(ceil((greatest(my1 - my0, mx1 - mx0) + 4) / 16.0) * 16 AS BIGINT) AS side", "(my0 + my1) / 2.0 - side / 2.0", "(mx0 + mx1) / 2.0 - side / 2.0"), True)
def frame_specs_notebook_source(spark, sf):
    return _canvas(_frames(spark, sf, "notebook_square_source"))


@query(_frame_sql("CAST(ceil((greatest(my1 - my0, mx1 - mx0) + 4) / 16.0) * 16 AS BIGINT) AS side", "my0 - floor((side - (my1 - my0)) / 2.0)", "mx0 - floor((side - (mx1 - mx0)) / 2.0)"), True)
def frame_specs_compact_square(spark, sf):
    return _canvas(_frames(spark, sf, "compact_square"))


@query(_frame_sql("CAST(ceil((my1 - my0 + 4) / 16.0) * 16 AS BIGINT) AS hh, CAST(ceil((mx1 - mx0 + 4) / 16.0) * 16 AS BIGINT) AS ww", "my0 - floor((hh - (my1 - my0)) / 2.0)", "mx0 - floor((ww - (mx1 - mx0)) / 2.0)", "hh", "ww"), True)
def frame_specs_compact_rectangle(spark, sf):
    return _canvas(_frames(spark, sf, "compact_rectangle"))


@query(_FRAME + """, t AS (SELECT *, CAST(ceil((greatest(y1 - y0, x1 - x0) + 4) / 16.0) * 16 AS BIGINT) AS sg FROM fr),
u AS (SELECT *, CAST(floor((y0 + y1) / 2.0 - sg / 2.0) AS BIGINT) * 4 AS wy, CAST(floor((x0 + x1) / 2.0 - sg / 2.0) AS BIGINT) * 4 AS wx FROM t),
s AS (SELECT slide, label, wy, wx, sg, max(sg * 4) OVER (PARTITION BY slide) AS side FROM u) """ + _OUT.format(y="CAST(floor((wy + wy + sg * 4) / 2.0 - side / 2.0) AS BIGINT)", x="CAST(floor((wx + wx + sg * 4) / 2.0 - side / 2.0) AS BIGINT)", h="side", w="side"), True)
def frame_specs_notebook_segmentation(spark, sf):
    return _canvas(_frames(spark, sf, "notebook_square_segmentation"))


@query(_BOX + """ SELECT slide, label, greatest(y0 - 3, 0) AS hy0, least(x1 + 3, 64) AS hx1, CAST(floor(y0 * 1.5) AS BIGINT) AS sy0, CAST(ceil(x1 * 1.5) AS BIGINT) AS sx1,
  CAST(floor(y0 / 16.0) * 16 AS BIGINT) AS ay0, CAST(ceil(x1 / 16.0) * 16 AS BIGINT) AS ax1, CAST(y0 - floor(greatest(10 - (y1 - y0), 0) / 2.0) AS BIGINT) AS ey0 FROM box""", True)
def bounds_algebra(spark, sf):
    box = regions.boxes(_labels(spark, sf))
    b, side = G.bounds(F.col("y0"), F.col("x0"), F.col("y1"), F.col("x1")), F.lit(SIDE)
    h, s, a, e = G.halo(b, 3, side, side), G.scale_outward(b, F.lit(1.5), F.lit(1.5)), G.align_outward(b, 16), G.expand_to(b, F.lit(10), F.lit(10))
    return box.select("slide", "label", h["y0"].alias("hy0"), h["x1"].alias("hx1"), s["y0"].alias("sy0"), s["x1"].alias("sx1"), a["y0"].alias("ay0"), a["x1"].alias("ax1"), e["y0"].alias("ey0"))


_IMG = "im AS (SELECT p_partkey AS id, CAST(p_size * 997 + p_partkey AS BIGINT) AS h, CAST(p_size * 641 + 2 * p_partkey AS BIGINT) AS w FROM part)"


def _images(spark, sf):
    return table(spark, sf, "part").select(F.col("p_partkey").alias("id"), (F.col("p_size") * 997 + F.col("p_partkey")).alias("h"), (F.col("p_size") * 641 + 2 * F.col("p_partkey")).alias("w"))


@query("WITH " + _IMG + " SELECT id, CAST(k AS INTEGER) AS level, CAST(ceil(h / pow(2, k)) AS BIGINT) AS h, CAST(ceil(w / pow(2, k)) AS BIGINT) AS w FROM im, (SELECT unnest(range(0, 6)) AS k)")
def level_shapes(spark, sf):
    return frames.level_shapes(_images(spark, sf), 6)


@query("WITH " + _IMG + " SELECT id, CAST(k AS INTEGER) AS level, greatest(h >> k, 1) AS h, greatest(w >> k, 1) AS w FROM im, (SELECT unnest(range(0, 6)) AS k)")
def pyramid_shapes(spark, sf):
    return frames.pyramid_shapes(_images(spark, sf), 6)


@query("WITH RECURSIVE " + _IMG + ", m AS (SELECT id, least(h, w) AS s, 1 AS n FROM im UNION ALL SELECT id, s >> 1, n + 1 FROM m WHERE s >= 512) SELECT id, CAST(max(n) AS BIGINT) AS n_mips FROM m GROUP BY id")
def num_mips(spark, sf):
    return _images(spark, sf).select("id", G.n_mips(F.col("w"), F.col("h"), 256).alias("n_mips"))


@query("WITH " + _IMG + " SELECT id, array_to_string(range(id % 4, least(id % 9, 6) + 1), ',') AS levels FROM im")
def native_levels(spark, sf):
    k = frames.native_levels((F.col("id") % 4).cast("int"), (F.col("id") % 9).cast("int"), F.lit(7), "segmentation_level")
    return _images(spark, sf).select("id", F.array_join(k.cast("array<string>"), ",").alias("levels"))


_BLOCK = _FRAME + """, cv AS (SELECT *, CAST(floor((my0 + my1) / 2.0 - side / 2.0) AS BIGINT) AS cy, CAST(floor((mx0 + mx1) / 2.0 - side / 2.0) AS BIGINT) AS cx FROM (SELECT *, CAST(ceil((greatest(my1 - my0, mx1 - mx0) + 4) / 16.0) * 16 AS BIGINT) AS side FROM fr)),
bl AS (SELECT slide, label, side, oy, ox, (oy // 24) * CAST(ceil(side / 24.0) AS BIGINT) + ox // 24 AS block_index, cy + oy AS sy0, cx + ox AS sx0, cy + least(oy + 24, side) AS sy1, cx + least(ox + 24, side) AS sx1, (least(oy + 24, side) - oy) * (least(ox + 24, side) - ox) AS out_area
  FROM cv, unnest(range(0, side, 24)) AS a(oy), unnest(range(0, side, 24)) AS b(ox)),
bv AS (SELECT *, least(greatest(sy0, 0), 256) AS vy0, least(greatest(sx0, 0), 256) AS vx0, least(greatest(sy1, 0), 256) AS vy1, least(greatest(sx1, 0), 256) AS vx1 FROM bl),
bk AS (SELECT *, vy1 > vy0 AND vx1 > vx0 AS requires_source FROM bv)"""


def _blocks(spark, sf):
    return frames.blocks(_frames(spark, sf, "notebook_square_source"), 24)


@query(_BLOCK + " SELECT slide, label, block_index, sy0, sx1, vy0, vx1, requires_source FROM bk", True)
def block_grid(spark, sf):
    return _blocks(spark, sf).select("slide", "label", "block_index", F.col("source.y0").alias("sy0"), F.col("source.x1").alias("sx1"), F.col("valid.y0").alias("vy0"), F.col("valid.x1").alias("vx1"), "requires_source")


_TILES = _BLOCK + ", tl AS (SELECT slide, label, block_index, tr, tc FROM bk, unnest(range(vy0 // 16, (vy1 - 1) // 16 + 1)) AS a(tr), unnest(range(vx0 // 16, (vx1 - 1) // 16 + 1)) AS b(tc) WHERE requires_source)"


@query(_TILES + ' SELECT slide, label, block_index, tr AS "row", tc AS col FROM tl', True)
def covering_tiles(spark, sf):
    return _blocks(spark, sf).select("slide", "label", "block_index", F.explode(frames.covering_tiles(F.col("valid"), 16)).alias("t")).select("slide", "label", "block_index", "t.row", "t.col")


@query(_TILES + """, n AS (SELECT slide, label, block_index, count(*) AS n FROM tl GROUP BY ALL)
SELECT slide, CAST(sum(n) AS BIGINT) AS decode_calls, round(avg(n), 6) AS tiles_per_block, round(avg(n) / avg(ceil((vy1 - vy0) / 16.0) * ceil((vx1 - vx0) / 16.0)), 6) AS alignment_win, any_value(u) AS unique_tiles, round(CAST(sum(n) AS DOUBLE) / any_value(u), 6) AS repeated_decode
FROM n JOIN bk USING (slide, label, block_index) JOIN (SELECT slide, count(DISTINCT (tr, tc)) AS u FROM tl GROUP BY slide) USING (slide) GROUP BY slide""", True)
def tile_accounting(spark, sf):
    t = frames.tile_accounting(_blocks(spark, sf), 16)
    return t.select("slide", "decode_calls", F.round("tiles_per_block", 6).alias("tiles_per_block"), F.round("alignment_win", 6).alias("alignment_win"), "unique_tiles", F.round("repeated_decode", 6).alias("repeated_decode"))


@query(_BLOCK + " SELECT slide, count(*) AS blocks, round(avg(CASE WHEN sy0 % 16 = 0 AND sx0 % 16 = 0 THEN 1.0 ELSE 0.0 END), 6) AS aligned FROM bk GROUP BY slide", True)
def block_alignment(spark, sf):
    return frames.alignment(_blocks(spark, sf), 16).withColumn("aligned", F.round("aligned", 6))


_FRACTION = _BLOCK + """, big AS (SELECT slide, y * 4 + dy AS y, x * 4 + dx AS x FROM mask, unnest(range(0, 4)) AS a(dy), unnest(range(0, 4)) AS b(dx)),
fra AS (SELECT bk.slide, bk.label, bk.block_index, any_value(requires_source) AS rs, count(big.y) / CAST(any_value(out_area) AS DOUBLE) AS f FROM bk LEFT JOIN big ON big.slide = bk.slide AND big.y >= vy0 AND big.y < vy1 AND big.x >= vx0 AND big.x < vx1 GROUP BY ALL),
str AS (SELECT *, CASE WHEN NOT rs THEN 'padding' WHEN f <= 0 THEN 'background' WHEN f < 0.05 THEN 'mixed_low' WHEN f < 0.5 THEN 'mixed_moderate' ELSE 'tissue' END AS stratum FROM fra)"""


def _strata(spark, sf):
    big = raster.project_mask(foreground(spark, sf), 4)
    work = frames.mask_fractions(_blocks(spark, sf), big, 32)
    return work.withColumn("stratum", frames.stratum(F.col("requires_source"), F.col("mask_fraction")))


@query(_FRACTION + " SELECT slide, label, block_index, round(f, 9) AS mask_fraction, stratum FROM str", True)
def block_strata(spark, sf):
    return _strata(spark, sf).select("slide", "label", "block_index", F.round("mask_fraction", 9).alias("mask_fraction"), "stratum")


@query(_FRACTION + " SELECT slide, label, block_index FROM str WHERE f > 0 QUALIFY row_number() OVER (PARTITION BY slide ORDER BY f DESC, label, block_index) <= 5", True)
def sample_tissue(spark, sf):
    return frames.sample_blocks(_strata(spark, sf), "tissue", 5).select("slide", "label", "block_index")


@query(_FRACTION + " SELECT slide, least(count(*), 9) AS n FROM str GROUP BY slide", True)
def sample_stratified_counts(spark, sf):
    return frames.sample_blocks(_strata(spark, sf), "stratified", 9).groupBy("slide").agg(F.count(F.lit(1)).alias("n"))


@query(_FRACTION + " SELECT slide, stratum, count(*) AS n, round(avg(f), 9) AS mean, round(quantile_cont(f, 0.95), 9) AS p95 FROM str GROUP BY GROUPING SETS ((slide, stratum), (slide))", True)
def sampling_summary(spark, sf):
    return sampling_plan.summary(_strata(spark, sf)).withColumns({c: F.round(c, 9) for c in ("mean", "p95")})


@query("SELECT slide, count(DISTINCT (y // 8, x // 8)) AS positive, 64 - count(DISTINCT (y // 8, x // 8)) AS empty FROM mask GROUP BY slide", True)
def mask_block_activity(spark, sf):
    return raster.block_activity(foreground(spark, sf), 8, SIDE, SIDE)


_EST = _FRAME + """, cs AS (SELECT slide, CAST(ceil((greatest(my1 - my0, mx1 - mx0) + 4) / 16.0) * 16 AS BIGINT) AS side FROM fr),
est AS (SELECT slide, CAST(sum(greatest(side >> k, 1) * greatest(side >> k, 1) * 3) AS BIGINT) AS bytes_all_mips, CAST(sum(CASE WHEN k = 0 THEN CAST(ceil(side / 16.0) AS BIGINT) * CAST(ceil(side / 16.0) AS BIGINT) ELSE 0 END) AS BIGINT) AS s0_chunks FROM cs, unnest(range(0, 4)) AS a(k) GROUP BY slide)"""


@query(_EST + " SELECT *, CAST(NULL AS VARCHAR) AS warning FROM est", True)
def estimate_bytes(spark, sf):
    return frames.estimate_bytes(_frames(spark, sf, "notebook_square_source"), 4, chunk=16)


@query("SELECT o_orderkey AS id, CASE WHEN b >= 268435456000 THEN 'very_large_output_over_250_gib' WHEN b >= 107374182400 THEN 'large_output_over_100_gib' WHEN c >= 100000 THEN 'many_s0_chunks_over_100k' END AS warning FROM (SELECT o_orderkey, CAST(floor(o_totalprice) AS BIGINT) * 1000000 AS b, o_custkey * 997 AS c FROM orders)")
def estimate_warnings(spark, sf):
    o = table(spark, sf, "orders")
    return o.select(F.col("o_orderkey").alias("id"), frames.estimate_warning(F.floor("o_totalprice") * 1000000, F.col("o_custkey") * 997).alias("warning"))


@query("""SELECT o_custkey AS k, concat_ws(';', CASE WHEN p = 0 THEN 'no_positive_any_blocks_selected' END, CASE WHEN m + t = 0 THEN 'no_mixed_or_tissue_blocks_selected' END, CASE WHEN t = 0 THEN 'no_high_positive_blocks_selected' END) AS warnings
FROM (SELECT o_custkey, count(*) FILTER (o_orderkey % 5 > 0) AS p, count(*) FILTER (o_orderkey % 5 IN (2, 3)) AS m, count(*) FILTER (o_orderkey % 5 = 4) AS t FROM orders GROUP BY 1)""")
def sampling_warnings(spark, sf):
    kind = F.element_at(F.array(*map(F.lit, ("background", "background", "mixed_low", "mixed_moderate", "tissue"))), (F.col("o_orderkey") % 5 + 1).cast("int"))
    picked = table(spark, sf, "orders").select(F.col("o_custkey").alias("k"), kind.alias("stratum"), (F.col("o_orderkey") % 5).alias("mask_fraction"))
    return sampling_plan.sample_warnings(picked, ["k"])


@query(_EST + " SELECT slide, round(228.3 * s0_chunks / 5171.0, 6) AS seconds, round(bytes_all_mips / 737148928.0, 9) AS disk_ratio, CAST(ceil(5171.0::DOUBLE * (s0_chunks / 5171.0::DOUBLE)) AS BIGINT) AS files FROM est", True)
def projection_ratio(spark, sf):
    e = frames.estimate_bytes(_frames(spark, sf, "notebook_square_source"), 4, chunk=16)
    return frames.project_cost(e, 5171, 737148928, 228.3, 5171).select("slide", F.round("seconds", 6).alias("seconds"), F.round("disk_ratio", 9).alias("disk_ratio"), "files")


# --- pyramids, projection, masks --------------------------------------------------------------------------------------------


@query("SELECT slide, y // 2 AS y, x // 2 AS x, avg(v) AS v FROM raster GROUP BY ALL", True)
def mip_avg(spark, sf):
    return raster.pool(pixels(spark, sf), "avg")


@query("SELECT slide, y // 2 AS y, x // 2 AS x, max(v) AS v FROM raster GROUP BY ALL", True)
def mip_max(spark, sf):
    return raster.pool(pixels(spark, sf), "max", h=SIDE, w=SIDE)


@query("SELECT slide, y // 2 AS y, x // 2 AS x, v FROM raster WHERE y % 2 = 0 AND x % 2 = 0", True)
def mip_stride(spark, sf):
    return raster.pool(pixels(spark, sf), "stride")


@query("SELECT CAST(k AS INTEGER) AS level, slide, y >> k AS y, x >> k AS x, round(avg(v), 9) AS v FROM raster, unnest(range(0, 4)) AS a(k) GROUP BY ALL", True)
def mips_all_levels(spark, sf):
    return raster.mips(pixels(spark, sf), 3).withColumn("v", F.round("v", 9))


@query("SELECT y * 2 + dy AS y, x * 2 + dx AS x, slide FROM mask, unnest(range(0, 2)) AS a(dy), unnest(range(0, 2)) AS b(dx)", True)
def project_mask(spark, sf):
    return raster.project_mask(foreground(spark, sf), 2)


@query("SELECT slide, y, x, CASE WHEN v >= 45 THEN r ELSE 0 END AS r, CASE WHEN v >= 45 THEN g ELSE 0 END AS g, CASE WHEN v >= 45 THEN b ELSE 0 END AS b FROM rgb", True)
def masked_rgb(spark, sf):
    return raster.masked(pixels(spark, sf), foreground(spark, sf), ["r", "g", "b"])


@query("SELECT slide, round(count_if(v >= 45) / CAST(count(*) AS DOUBLE), 9) AS iou FROM raster WHERE v >= 40 GROUP BY slide", True)
def mask_iou(spark, sf):
    p = pixels(spark, sf)
    return raster.iou(p.filter("v >= 40"), p.filter("v >= 45")).withColumn("iou", F.round("iou", 9))


# Every 97th place outside the mask is left as it was.
@query("SELECT slide, count(*) FILTER (v < 45 AND (y + x) % 97 = 0 AND v <> 0) AS bad, count(*) AS n FROM raster GROUP BY slide", True)
def outside_zero_check(spark, sf):
    p = pixels(spark, sf)
    some = foreground(spark, sf).unionByName(p.filter("(y + x) % 97 = 0").select("slide", "y", "x")).distinct()
    return raster.outside_zero(raster.masked(p, some, ["v"]), foreground(spark, sf))


@query("SELECT slide, " + ", ".join(f"round(avg({c}), 6) AS mean_{c}, round(stddev_pop({c}), 6) AS std_{c}" for c in "rgb") + ", " + ", ".join(f"round(avg(abs({a} - {b})), 6) AS diff_{a}{b}" for a, b in ("rg", "rb", "gb")) + ", greatest(avg(abs(r - g)), avg(abs(r - b)), avg(abs(g - b))) <= 2.0 AS near_gray FROM rgb GROUP BY slide", True)
def channel_stats(spark, sf):
    s = raster.channel_stats(pixels(spark, sf))
    return s.select("slide", *[F.round(c, 6).alias(c) for c in s.columns if c not in ("slide", "near_gray")], "near_gray")
