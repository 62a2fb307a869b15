import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import frames, graph, mesh, raster, regions, stack, tissue
from tessera.streaming import events as streaming


def _mask(spark, art, slide=0):
    rows = [(slide, y, x) for y, line in enumerate(art) for x, c in enumerate(line) if c == "#"]
    return spark.createDataFrame(rows, "slide long, y long, x long")


def _set(df):
    return {(r.y, r.x) for r in df.collect()}


def test_labels_do_not_depend_on_blocks(spark):
    rng = np.random.default_rng(3)
    art = ["".join("#" if v else "." for v in row) for row in rng.random((23, 31)) < 0.4]
    whole = {(r.y, r.x): r.label for r in regions.label(_mask(spark, art)).collect()}
    for block in (1, 4, 7):
        assert {(r.y, r.x): r.label for r in regions.label(_mask(spark, art), block=block).collect()} == whole
    for (y, x), label in whole.items():
        assert all(whole.get((y + a, x + b), label) == label for a in (-1, 0, 1) for b in (-1, 0, 1))


def test_holes_fill_only_inside(spark):
    art = ["#####", "#...#", "#.#.#", "#####", "##.##"]
    assert _set(regions.fill_holes(_mask(spark, art), 5, 5)) == {(y, x) for y in range(5) for x in range(5)} - {(4, 2)}


def test_opening_and_closing_are_ordered_and_idempotent(spark):
    rng = np.random.default_rng(5)
    m = _mask(spark, ["".join("#" if v else "." for v in row) for row in rng.random((16, 16)) < 0.6])
    opened, closed = raster.opening(m, 1, 16, 16), raster.closing(m, 1, 16, 16)
    assert _set(opened) <= _set(m) <= _set(closed)
    assert _set(raster.opening(opened, 1, 16, 16)) == _set(opened)


def test_split_cuts_a_bar_bell(spark):
    art = [".............", ".####...####.", ".####...####.", ".##########..", ".####...####.", ".####...####.", "............."]
    big = ["".join(c * 5 for c in line) for line in art for _ in range(5)]
    lab = regions.label(_mask(spark, big))
    assert lab.select("label").distinct().count() == 1
    parts = regions.split_touching(lab, radius=6, min_area=64)
    assert parts.select("label").distinct().count() == 2


def test_distance_and_solidity_of_a_square(spark):
    lab = regions.label(_mask(spark, ["#" * 7] * 7))
    d = {(r.y, r.x): r.distance for r in regions.distance_transform(lab).collect()}
    assert d[(3, 3)] == 4 and d[(0, 0)] == 1
    assert regions.solidity(lab).first().solidity == pytest.approx(1.0)


def test_blocks_cover_each_canvas_once(spark):
    box = spark.createDataFrame([(0, 1, 5, 5, 40, 20), (0, 2, 0, 30, 9, 64)], "slide long, label long, y0 long, x0 long, y1 long, x1 long")
    box = box.withColumns({"scale_y": F.lit(2.0), "scale_x": F.lit(2.0), "source_h": F.lit(128), "source_w": F.lit(128)})
    for policy in frames.POLICIES:
        f = frames.frame_specs(box, policy, 16, 1)
        rows = frames.blocks(f, 24).collect()
        for r in f.collect():
            own = [b for b in rows if b.label == r.label]
            cells = {(y, x) for b in own for y in range(b.out.y0, b.out.y1) for x in range(b.out.x0, b.out.x1)}
            assert len(cells) == sum((b.out.y1 - b.out.y0) * (b.out.x1 - b.out.x0) for b in own) == (r.canvas.y1 - r.canvas.y0) * (r.canvas.x1 - r.canvas.x0)
            assert sorted(b.block_index for b in own) == list(range(len(own)))
    with pytest.raises(ValueError):
        frames.frame_specs(box, "round", 16)


def test_stratified_sample_meets_its_quotas(spark):
    names = ["padding"] * 3 + ["background"] * 10 + ["mixed_low"] * 10 + ["tissue"] * 1
    rows = [(0, 0, i, s, 0.1) for i, s in enumerate(names)]
    work = spark.createDataFrame(rows, "slide long, label long, block_index long, stratum string, mask_fraction double")
    got = [r.stratum for r in frames.sample_blocks(work, "stratified", 12).collect()]
    assert len(got) == 12 and got.count("padding") == 3 and got.count("tissue") == 1
    assert len(frames.sample_blocks(work, "random", 5, seed=1).collect()) == 5
    with pytest.raises(ValueError):
        frames.sample_blocks(work, "other", 5)


def test_gap_fill_of_a_long_gap(spark):
    rows = [(0, 0, 5.0)] + [(0, i, None) for i in range(1, 10)] + [(0, 10, 9.0), (0, 11, None)]
    df = spark.createDataFrame(rows, "stack long, idx long, value double")
    linear = {r.idx: r.value for r in stack.fill(df).collect()}
    nearest = {r.idx: r.value for r in stack.fill(df, "nearest").collect()}
    assert linear[5] == pytest.approx(7.0) and linear[11] is None
    assert nearest[5] == 5.0 and nearest[6] == 9.0


def test_components_of_a_long_path(spark):
    n = 400
    links = spark.createDataFrame([((i * 7919) % n, ((i + 1) * 7919) % n) for i in range(n - 1)], "a long, b long")
    assert {r.root for r in graph.components(links).collect()} == {0}
    assert graph.components(links.limit(0)).count() == 0


def test_streams(spark, tmp_path):
    e = spark.createDataFrame([(f"r{i % 3}", i, "end" if i == 29 else "step") for i in range(30)], "run_id string, at long, event_type string")
    e.repartition(3).write.parquet(str(tmp_path / "in"))
    q = streaming.run_states(streaming.read(spark, str(tmp_path / "in"), e.schema)).writeStream.format("memory").queryName("states").outputMode("update").option("checkpointLocation", str(tmp_path / "ck")).start()
    q.processAllAvailable()
    q.stop()
    last = {}
    for r in spark.table("states").collect():
        if r.n_events >= last.get(r.run_id, (0,))[0]:
            last[r.run_id] = (r.n_events, r.status)
    assert last == {"r0": (10, "step"), "r1": (10, "step"), "r2": (10, "end")}


def _pieces(m):
    """The 4-connected pieces of a boolean array, as lists of cells."""
    left, out = {(int(y), int(x)) for y, x in np.argwhere(m)}, []
    while left:
        todo, piece = [left.pop()], []
        while todo:
            y, x = todo.pop()
            piece.append((y, x))
            for c in ((y + 1, x), (y - 1, x), (y, x + 1), (y, x - 1)):
                if c in left:
                    left.remove(c)
                    todo.append(c)
        out.append(piece)
    return out


def _mask_of(image, kind, radius, least, stained, opened):
    """The mask of one image, restated with arrays."""
    h, w = image.shape

    def shrink(m, r):
        return np.array([[all(m[y + a, x + b] for a, b in raster.disk(r) if 0 <= y + a < h and 0 <= x + b < w) for x in range(w)] for y in range(h)])

    def grow(m, r):
        return ~shrink(~m, r)

    def only(m, keep):
        out = np.zeros_like(m)
        for piece in _pieces(m):
            if keep(piece):
                out[tuple(np.transpose(piece))] = True
        return out

    if kind == "otsu":
        taps = np.exp(-(np.arange(-4, 5) ** 2) / 2)
        v = image.astype(float)
        for _ in range(2):
            v = np.apply_along_axis(lambda c: np.convolve(np.pad(c, 4, mode="edge"), taps / taps.sum(), "valid"), 0, v).T
    else:
        u8 = ((image - image.min()) / (image.max() - image.min() + 1e-6) * 255 + 0.5).astype(int)
        v = np.zeros((h, w))
        for y in range(h):
            for x in range(w):
                p = np.unique([u8[y + a, x + b] for a, b in raster.disk(radius) if 0 <= y + a < h and 0 <= x + b < w], return_counts=True)[1]
                v[y, x] = -(p / p.sum() * np.log2(p / p.sum())).sum()
    n, edges = np.histogram(v, 256)
    c = (edges[1:] + edges[:-1]) / 2
    w0, s0 = np.cumsum(n)[:-1], np.cumsum(n * c)[:-1]
    cut = c[np.argmax((s0 / w0 - ((n * c).sum() - s0) / (n.sum() - w0)) ** 2 * w0 * (n.sum() - w0))]
    m = ((v < cut) if kind == "otsu" else (v > cut)) & stained
    if opened:
        m = grow(shrink(m, opened), opened)
    m = shrink(grow(m, radius), radius)
    if kind == "otsu":
        return only(only(~m, lambda p: len(p) >= least) ^ True, lambda p: len(p) >= least)
    m = ~only(~m, lambda p: any(y in (0, h - 1) or x in (0, w - 1) for y, x in p))
    return ~only(~only(m, lambda p: len(p) >= least), lambda p: len(p) >= least)


@pytest.mark.parametrize("kind, opened", [("otsu", 0), ("otsu", 1), ("entropy", 1)])
def test_tissue_masks_equal_their_steps_on_arrays(spark, kind, opened):
    rng = np.random.default_rng(8)
    h, w = 26, 30
    images = rng.integers(200, 206, (2, h, w)).astype(float)
    for image in images:
        for _ in range(7):
            y, x, a, b = rng.integers(0, h - 4), rng.integers(0, w - 4), *rng.integers(3, 10, 2)
            image[y : y + a, x : x + b] = rng.integers(20, 150, image[y : y + a, x : x + b].shape)
        image[8:20, 0:12], image[11:16, 3:6], image[10:12, 8:10] = rng.integers(20, 90, (12, 12)), 204, 204
    stained = rng.random(images.shape) < 0.97
    rows = [(s, y, x, float(images[s, y, x]), bool(stained[s, y, x])) for s in (0, 1) for y in range(h) for x in range(w)]
    df = spark.createDataFrame(rows + [(2, y, x, 7.0, True) for y in range(h) for x in range(w)], "slide long, y long, x long, v double, ok boolean")
    got = getattr(tissue, f"{kind}_mask")(df, 2, 9, h, w, df.filter("ok"), opened).collect()
    assert len(got) == len(set(got)) and not any(r.slide == 2 for r in got)
    for s in (0, 1):
        want = {(int(y), int(x)) for y, x in np.argwhere(_mask_of(images[s], kind, 2, 9, stained[s], opened))}
        assert 0 < len(want) < h * w and {(r.y, r.x) for r in got if r.slide == s} == want


def test_samples_of_tissue_and_mixed_blocks(spark):
    rows = [(0, 0, i, f, s) for i, (f, s) in enumerate([(0.0, "padding"), (0.2, "mixed_low"), (0.0, "background"), (1.0, "tissue"), (0.7, "mixed_high"), (0.5, "mixed_low")])]
    work = spark.createDataFrame(rows + [(1, 0, 0, 0.0, "background")], "slide long, label long, block_index long, mask_fraction double, stratum string")
    pick = lambda how, n: sorted((r.slide, r.block_index) for r in frames.sample_blocks(work, how, n).collect())
    assert pick("tissue", 5) == [(0, 1), (0, 3), (0, 4), (0, 5)] and pick("tissue", 2) == [(0, 3), (0, 4)]
    assert pick("mixed", 2) == [(0, 1), (0, 4)] and pick("mixed", 9) == [(0, 1), (0, 4), (0, 5)]


def test_components_by_one_task_and_by_rounds(spark, monkeypatch):
    import random

    from tessera.operators import graph

    rng = random.Random(4)
    links = [(rng.randrange(300) * 7 - 900, rng.randrange(300) * 7 - 900) for _ in range(220)] + [(5000 + i, 5001 + i) for i in range(90)] + [(6, 6)]
    root = {k: k for pair in links if pair[0] != pair[1] for k in pair}
    for _ in root:
        for a, b in links:
            if a != b:
                root[a] = root[b] = min(root[a], root[b])
    df = spark.createDataFrame(links, "a long, b long")
    for few in (1 << 14, 1):
        monkeypatch.setattr(graph, "FEW", few)
        assert {r.key: r.root for r in graph.components(df).collect()} == root
    assert graph.components(df.limit(0)).count() == 0


def test_regions_of_slides_with_names(spark):
    from tessera.operators import regions

    rows = [("a/x.vsi", y, x) for y in range(3) for x in range(2000, 2060)] + [("b", 1, 1), ("b", 1, 2), ("b", 5, 5)]
    out = regions.label(spark.createDataFrame(rows, "slide string, y int, x int"), block=16)
    n = {(r.slide, r.label): r["count"] for r in out.groupBy("slide", "label").count().collect()}
    assert n == {("a/x.vsi", 2000): 180, ("b", regions.SPAN + 1): 2, ("b", 5 * regions.SPAN + 5): 1}


def _disk(cy, cx, r, slide=1):
    return [(slide, y, x) for y in range(cy - r, cy + r + 1) for x in range(cx - r, cx + r + 1) if (y - cy) ** 2 + (x - cx) ** 2 <= r * r]


def test_splitting_drops_parts_without_a_seed_unless_the_slide_has_none(spark):
    from tessera.operators import regions

    mask = spark.createDataFrame(_disk(30, 30, 12) + [(1, 70, x) for x in range(100)] + _disk(30, 90, 12, 2)[:0] + [(2, y, x) for y in range(4) for x in range(40)], "slide long, y long, x long")
    out = regions.split_touching(regions.label(mask), radius=3, min_area=64)
    n = {r.slide: r["count"] for r in out.groupBy("slide").count().collect()}
    assert n == {1: len(_disk(30, 30, 12)), 2: 160}  # the line has no seed; slide 2 has none at all and keeps its one region


def test_distance_is_exact(spark):
    import numpy as np

    from tessera.operators import regions

    rng = np.random.default_rng(4)
    grid = rng.random((23, 31)) < 0.8
    got = np.sqrt(regions._distance(grid))
    back = np.argwhere(~grid)
    for y, x in np.argwhere(grid):
        assert abs(got[y, x] - np.sqrt(((back - [y, x]) ** 2).sum(1).min())) < 1e-9


def test_only_weak_strips_and_ragged_parts_are_trimmed(spark):
    from tessera.operators import regions

    body = [(1, y, x) for y in range(40) for x in range(40)]
    strip = [(1, y, 40 + k) for y in (20, 21) for k in range(20)]  # a weak arm
    patch = [(1, y, x) for y in range(0, 30) for x in range(0, 30)]  # weak, but most of the region
    labels = regions.label(spark.createDataFrame(body + strip, "slide long, y long, x long"))
    stained = spark.createDataFrame(body, "slide long, y long, x long")
    a = regions.appendages(labels, stained).collect()
    assert [(r.area_px, r.appendage_reason, r.trimmed) for r in a] == [(40, "peripheral_low_he_strip", True)]
    assert regions.trim_appendages(labels, stained, 128).count() == 1600
    strong = spark.createDataFrame([(*p, 0.5) for p in strip], "slide long, y long, x long, signal double")
    assert regions.trim_appendages(labels, stained, 128, strong).count() == 1640
    rest = spark.createDataFrame([p for p in body + strip if p not in set(patch)], "slide long, y long, x long")
    assert regions.trim_appendages(labels, rest, 128).count() == 1640


def test_sampled_vertices_are_apart_and_nothing_more_fits(spark):
    import numpy as np

    from tessera.operators import mesh

    rng = np.random.default_rng(1)
    points = rng.random((300, 3)) * 10
    ve = spark.createDataFrame([(1, i, *map(float, p)) for i, p in enumerate(points)], "mesh long, v long, x double, y double, z double")
    taken = sorted(r.v for r in mesh.sample_apart(ve, 2.0).collect())
    d = np.sqrt(((points[:, None] - points[None]) ** 2).sum(2))
    assert len(set(taken)) == len(taken)
    inner = d[np.ix_(taken, taken)] + 99 * np.eye(len(taken))
    assert inner.min() >= 2.0 and d[:, taken].min(1).max() < 2.0


def test_gap_filling_of_a_long_series_is_linear(spark):
    import time

    from tessera.operators import stack

    s = spark.range(200_000).selectExpr("1 AS stack", "id AS idx", "CASE WHEN id % 1000 = 0 THEN CAST(id AS double) END AS value").repartition(1)
    began = time.perf_counter()
    out = stack.fill(s).filter("value <> idx OR (value IS NULL AND idx <= 199000)").count()
    assert out == 0 and time.perf_counter() - began < 60


def test_unknown_extensions_and_policies_raise(spark):
    import pytest
    from pyspark.sql import functions as F

    from tessera.functions import naming
    from tessera.operators import levels

    one = spark.range(1)
    assert one.select(naming.normal_extension(F.lit(".TIF")).alias("e")).first().e == "tiff"
    with pytest.raises(Exception, match="unknown extension"):
        one.select(naming.normal_extension(F.lit("bmp"))).collect()
    with pytest.raises(Exception, match="unknown name"):
        one.select(levels.alias(F.lit("circle"), levels.CROP, "notebook_square")).collect()


@pytest.mark.parametrize("step", [1, -1])
def test_of_equally_fast_rows_the_first_counts(spark, step):
    def rows(run, replay):
        """Rows of a run: four replays, of which all but the first take 2 s at these blocks a second, and a slow random write."""
        speeds = [(stack.REPLAY, 9.0, 7.0), *[(stack.REPLAY, 2.0, b) for b in replay], (stack.RANDOM, 2.0, 1.0)]
        return [(run, seq, mode, stack.DEEP, False, s, b, 0.0, 0.0, 0.0, 0.0) for seq, (mode, s, b) in enumerate(speeds)]

    schema = "run long, seq long, mode string, codec string, skipped boolean, elapsed_s double, blocks_per_sec double, downsample_s double, write_s double, repeated_decode double, alignment_win double"
    data = (rows(1, [1.0, 50.0, 50.0]) + rows(2, [50.0, 1.0, 1.0]))[::step]
    for parts in (1, 5):
        df = spark.createDataFrame(spark.sparkContext.parallelize(data, parts), schema)
        assert {r.run: r.top for r in stack.bottleneck_verdict(df, ["run"]).collect()} == {1: "writer/compression/filesystem", 2: stack.INCONCLUSIVE}


def test_a_flat_axis_is_zero_in_the_operator_and_nan_in_sql(spark, tmp_path):
    import duckdb

    from tessera.plans import catalog, tables

    ve = spark.createDataFrame([(0, 0, 0.0, 3.0, 7.0), (0, 1, 4.0, 3.0, 7.0), (1, 0, 1.0, 0.0, 2.0), (1, 1, 2.0, 5.0, 4.0)], "mesh long, v long, x double, y double, z double")
    got = {(r.mesh, r.v): (r.x, r.y, r.z) for r in mesh.unit_box(ve).collect()}
    assert got == {(0, 0): (0.0, 0.0, 0.0), (0, 1): (1.0, 0.0, 0.0), (1, 0): (0.0, 0.0, 0.0), (1, 1): (1.0, 1.0, 1.0)}

    # Slide 0 has one height, slide 1 two, slide 2 a single vertex.
    rows = [(y, x, slide, q, 10.0) for slide, y, x, q in [(0, 1, 1, 50.0), (0, 2, 5, 50.0), (0, 9, 3, 50.0), (1, 1, 1, 50.0), (1, 4, 2, 20.0), (2, 6, 6, 50.0)]]
    path = str(tmp_path / "lineitem.parquet")
    spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double").write.parquet(path)
    c = duckdb.connect()
    c.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{path}/*.parquet'")
    want = c.sql(catalog.ORACLES["unit_box"]).select("mesh", "v", "x", "y", "z").fetchall()
    got = tables.unit_box(spark, str(tmp_path)).select("mesh", "v", "x", "y", "z").collect()
    assert len(got) == 6 and sorted(map(str, map(tuple, got))) == sorted(map(str, want))
