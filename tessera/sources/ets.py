"""Scanner pyramids (SIS/ETS files) as a Spark data source: one row per tile, payload on demand.

The index is read once, on the driver, to deal the tiles to partitions; executors seek to their tiles only, so a file of
any size is read in parallel and never whole. Paths have to be readable on driver and executors (a shared mount).
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "slide string, level int, col int, row int, nbytes long, seqnum long, file_offset long, payload binary"
# Compression codes of the format.
COMPRESSIONS = {0: "RAW", 2: "JPEG", 3: "JPEG_2000", 5: "JPEG_LOSSLESS", 8: "PNG", 9: "BMP"}


class EtsError(ValueError):
    """The file is not one that this reader understands."""


@dataclass
class Header:
    n_tiles: int
    index_at: int
    compression: str
    tile_w: int
    tile_h: int
    bgr: bool
    w: int
    h: int


def read_header(path: str) -> tuple[Header, np.ndarray]:
    """The header and the tile index (level, col, row, nbytes, seqnum, file_offset); raises EtsError if they disagree."""
    with open(path, "rb") as f:
        sis = struct.unpack("<16I", _exactly(f, 64))
        if sis[0].to_bytes(4, "little") != b"SIS\0":
            raise EtsError("no SIS header")
        begin, n, end = sis[8] | sis[9] << 32, sis[10], sis[12] | sis[13] << 32
        if end - begin != n * 36:
            raise EtsError(f"{n} tiles, but an index of {(end - begin) / 36:g}")
        if sis[4] != 64:
            raise EtsError("the ETS header does not follow the SIS header")
        ets = struct.unpack("<57I", _exactly(f, 228))
        if ets[0].to_bytes(4, "little") != b"ETS\0":
            raise EtsError("no ETS header")
        if ets[2] != 2 or ets[46] != 2:
            raise EtsError(f"pixel type {ets[2]} in {ets[46]} dimensions; 2 and 2 are read")
        f.seek(begin)
        raw = np.frombuffer(_exactly(f, 36 * n), "<u4").reshape(-1, 9).astype(np.int64)
    index = np.stack([raw[:, 4], raw[:, 1], raw[:, 2], raw[:, 7], raw[:, 8], raw[:, 5] | raw[:, 6] << 32], 1)
    if not np.array_equal(np.sort(index[:, 4]), np.arange(n)):
        raise EtsError("sequence numbers have gaps")
    return Header(n, begin, COMPRESSIONS.get(ets[5], "unknown"), ets[7], ets[8], ets[37] == 1, ets[47], ets[48]), index


def _exactly(f, n: int) -> bytes:
    data = f.read(n)
    if len(data) != n:
        raise EtsError("the file ends early")
    return data


class EtsTiles(DataSource):
    """Options: path (comma-separated files), level, payload (false leaves it null), tilesPerPartition."""

    @classmethod
    def name(cls) -> str:
        return "ets_tiles"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(dict(self.options))


@dataclass
class _Part(InputPartition):
    path: str
    rows: list


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = {k.lower(): v for k, v in options.items()}

    def partitions(self) -> list[InputPartition]:
        size = int(self.options.get("tilesperpartition", 1024))
        out: list[InputPartition] = []
        for path in self.options["path"].split(","):
            _, index = read_header(path)
            if "level" in self.options:
                index = index[index[:, 0] == int(self.options["level"])]
            index = index[np.argsort(index[:, 5])]  # by place in the file
            out += [_Part(path, index[i : i + size].tolist()) for i in range(0, len(index), size)]
        return out

    def read(self, part: _Part) -> Iterator[tuple]:
        wanted = self.options.get("payload", "true").lower() != "false"
        with open(part.path, "rb", buffering=0) as f:
            for level, col, row, nbytes, seq, at in part.rows:
                data = None
                if wanted:
                    f.seek(at)
                    data = _exactly(f, nbytes)
                yield part.path, level, col, row, nbytes, seq, at, data


def tiles(spark: SparkSession, path: str, level: int | None = None, payload: bool = True) -> DataFrame:
    spark.dataSource.register(EtsTiles)
    r = spark.read.format("ets_tiles").option("path", path).option("payload", str(payload).lower())
    return (r if level is None else r.option("level", level)).load()


def level_grid(index: DataFrame) -> DataFrame:
    """(slide, level, ncol, nrow)."""
    return index.groupBy("slide", "level").agg((F.max("col") + 1).alias("ncol"), (F.max("row") + 1).alias("nrow"))


def decode_raw(rows: DataFrame, header: Header, channels: int = 3) -> DataFrame:
    """Pixels (slide, level, y, x, r, g, b) of uncompressed tiles, cut to the level's size. Other codecs are refused."""
    if header.compression != "RAW":
        raise EtsError(f"no decoder for {header.compression}")
    th, tw, order = header.tile_h, header.tile_w, [2, 1, 0] if header.bgr else [0, 1, 2]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yy, xx = (a.ravel() for a in np.mgrid[0:th, 0:tw])
        for batch in batches:
            for t in batch.itertuples():
                px = np.frombuffer(t.payload, np.uint8).reshape(th * tw, channels).astype(np.int32)
                y, x = yy + t.row * th, xx + t.col * tw
                h, w = -(-header.h // (1 << t.level)), -(-header.w // (1 << t.level))
                ok = (y < h) & (x < w)
                yield pd.DataFrame({"slide": t.slide, "level": t.level, "y": y[ok], "x": x[ok], **{c: px[ok, k] for c, k in zip("rgb", order, strict=True)}})

    return rows.mapInPandas(run, "slide string, level int, y long, x long, r int, g int, b int")
