import json
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.sources import chunks, ets, tables


def _ets(path, h=5, w=7, tile=4, levels=2, magic=b"SIS\0"):
    """A small uncompressed file with two levels; returns each level's pixels."""
    rng = np.random.default_rng(1)
    images = [rng.integers(0, 255, (-(-h // (1 << k)), -(-w // (1 << k)), 3), dtype=np.uint8) for k in range(levels)]
    body, index, at = b"", [], 64 + 228
    for k, im in enumerate(images):
        for row in range(-(-im.shape[0] // tile)):
            for col in range(-(-im.shape[1] // tile)):
                t = np.zeros((tile, tile, 3), np.uint8)
                part = im[row * tile : (row + 1) * tile, col * tile : (col + 1) * tile]
                t[: part.shape[0], : part.shape[1]] = part
                index.append((0, col, row, 0, k, at + len(body), 0, t.nbytes, len(index)))
                body += t.tobytes()
    begin = at + len(body)
    sis = [int.from_bytes(magic, "little"), 0, 0, 0, 64, 0, 0, 0, begin, 0, len(index), 0, begin + 36 * len(index), 0, 0, 0]
    head = [0] * 57
    head[0], head[2], head[7], head[8], head[46], head[47], head[48] = int.from_bytes(b"ETS\0", "little"), 2, tile, tile, 2, w, h
    with open(path, "wb") as f:
        f.write(struct.pack("<16I", *sis) + struct.pack("<57I", *head) + body + b"".join(struct.pack("<9I", *x) for x in index))
    return images


def test_ets_tiles_and_pixels(spark, tmp_path):
    path = str(tmp_path / "a.ets")
    images = _ets(path)
    index = ets.tiles(spark, path, payload=False)
    assert index.filter("payload IS NOT NULL").count() == 0
    assert {(r.level, r.ncol, r.nrow) for r in ets.level_grid(index).collect()} == {(0, 2, 2), (1, 1, 1)}
    header, _ = ets.read_header(path)
    for k, im in enumerate(images):
        px = ets.decode_raw(ets.tiles(spark, path, level=k), header).collect()
        got = np.zeros_like(im)
        for r in px:
            got[r.y, r.x] = (r.r, r.g, r.b)
        assert len(px) == im.shape[0] * im.shape[1] and np.array_equal(got, im)


def test_bad_ets_is_refused(tmp_path):
    path = str(tmp_path / "b.ets")
    _ets(path, magic=b"XIS\0")
    with pytest.raises(ets.EtsError):
        ets.read_header(path)
    (tmp_path / "c.ets").write_bytes(b"SIS\0")
    with pytest.raises(ets.EtsError):
        ets.read_header(str(tmp_path / "c.ets"))


def test_zarr_round_trip(spark, tmp_path):
    path = str(tmp_path / "z")
    px = spark.range(300).select(F.floor(F.col("id") / 20).alias("y"), (F.col("id") % 20).alias("x"), (F.col("id") % 251).alias("r"), (F.col("id") * 7 % 251).alias("g"))
    px = px.filter("NOT (y < 8 AND x < 8)")
    chunks.write_zarr(px, path, 15, 20, 8, ["r", "g"], 2)
    assert not (tmp_path / "z/0/0.0.0").exists() and (tmp_path / "z/0/0.1.2").exists()
    got = {(r.c, r.y, r.x): r.v for r in chunks.read_zarr(spark, path).collect()}
    want = {(c, r.y, r.x): v for r in px.collect() for c, v in enumerate((r.r, r.g)) if v}
    assert got == want
    half = {(r.c, r.y, r.x): r.v for r in chunks.read_zarr(spark, path, 1).collect()}
    assert half == {(c, y // 2, x // 2): v for (c, y, x), v in want.items() if y % 2 == 0 and x % 2 == 0 and y < 14}
    assert json.loads((tmp_path / "z/1/.zarray").read_text())["shape"] == [2, 7, 10]


def test_precomputed_volume(spark, tmp_path):
    path = str(tmp_path / "p")
    vox = spark.createDataFrame([(0, 0, 0, 5), (4, 2, 1, 9)], "x long, y long, z long, v long")
    chunks.write_precomputed(vox, path, (5, 3, 2), (4, 4, 4), (0.5, 0.5, 16.0))
    a = np.frombuffer((tmp_path / "p/0/0-4_0-3_0-2").read_bytes(), np.uint8).reshape((4, 3, 2), order="F")
    b = np.frombuffer((tmp_path / "p/0/4-5_0-3_0-2").read_bytes(), np.uint8).reshape((1, 3, 2), order="F")
    assert a[0, 0, 0] == 5 and a.sum() == 5 and b[0, 2, 1] == 9
    assert json.loads((tmp_path / "p/info").read_text())["scales"][0]["resolution"] == [500, 500, 16000]


def test_manifest_and_listing(spark, tmp_path):
    (tmp_path / "m.csv").write_text("specimen_id,slide_id,source_path,stain,other\nS1,L1,/a.vsi,HE,x\nS1,L2, ,,y\n")
    rows = tables.manifest(spark, str(tmp_path / "m.csv")).orderBy("row_number").collect()
    assert [r.row_number for r in rows] == [2, 3] and rows[1].source_path is None and rows[0].stain == "HE" and rows[0].notes is None
    (tmp_path / "n.csv").write_text("specimen_id\nS1\n")
    with pytest.raises(ValueError, match="slide_id"):
        tables.manifest(spark, str(tmp_path / "n.csv"))
    assert tables.listing(spark, str(tmp_path), "*.csv").count() == 2
    assert all(len(r.sha256) == 64 for r in tables.checksums(spark, str(tmp_path), "*.csv").collect())
