"""Chunked array stores as DataFrames of (name, payload), one row per chunk file, and the sink that writes them.

A chunk is a file of its own, so tasks never share one; each is written beside its name and renamed, so a task that is
run again, or twice at once, leaves the same file. Zarr v2 and precomputed raw volumes are two ways of naming chunks.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

CHUNK = "name string, payload binary"


@dataclass
class _Done(WriterCommitMessage):
    names: list


class _Writer(DataSourceWriter):
    def __init__(self, path: str):
        self.path = path

    def write(self, rows) -> WriterCommitMessage:
        names = []
        for row in rows:
            to = os.path.join(self.path, row.name)
            os.makedirs(os.path.dirname(to), exist_ok=True)
            part = f"{to}.{uuid.uuid4().hex}.part"
            with open(part, "wb") as f:
                f.write(row.payload)
            os.replace(part, to)
            names.append(row.name)
        return _Done(names)

    def abort(self, messages) -> None:
        for m in messages:
            for name in m.names if m else []:
                if os.path.exists(to := os.path.join(self.path, name)):
                    os.remove(to)


class ChunkFiles(DataSource):
    """Writes (name, payload) rows as files under `path`; reads the files whose names are given in `names`."""

    @classmethod
    def name(cls) -> str:
        return "chunk_files"

    def schema(self) -> str:
        return CHUNK

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return _Writer(self.options["path"])

    def reader(self, schema) -> DataSourceReader:
        return _ChunkReader(self.options["path"], json.loads(self.options["names"]), int(self.options.get("perPartition", 256)))


@dataclass
class _Names(InputPartition):
    names: list


class _ChunkReader(DataSourceReader):
    def __init__(self, path: str, names: list[str], size: int):
        self.path, self.names, self.size = path, names, size

    def partitions(self) -> list[InputPartition]:
        return [_Names(self.names[i : i + self.size]) for i in range(0, len(self.names), self.size)]

    def read(self, part: _Names) -> Iterator[tuple]:
        for name in part.names:
            to = os.path.join(self.path, name)
            if os.path.exists(to):  # a chunk that is left out is all fill value
                with open(to, "rb") as f:
                    yield name, f.read()


def save(chunks: DataFrame, path: str) -> None:
    chunks.sparkSession.dataSource.register(ChunkFiles)
    chunks.select("name", "payload").write.format("chunk_files").mode("append").option("path", path).save()


def _write_json(path: str, value: dict) -> None:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        json.dump(value, f, indent=2)


def zarr_chunks(pixels: DataFrame, level: int, chunk: int, channels: list[str], sparse: bool = True) -> DataFrame:
    """Zarr v2 chunks `level/0.by.bx` of shape (C, chunk, chunk) from pixel rows (y, x, channels); empty ones are left out."""
    rows = pixels.withColumns({"by": F.floor(F.col("y") / chunk), "bx": F.floor(F.col("x") / chunk)})
    n = len(channels)

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        data = np.zeros((n, chunk, chunk), np.uint8)
        y, x = rows["y"].to_numpy() % chunk, rows["x"].to_numpy() % chunk
        for k, c in enumerate(channels):
            data[k, y, x] = rows[c]
        keep = int(not sparse or data.any())
        name = f"{level}/0.{int(rows['by'].iloc[0])}.{int(rows['bx'].iloc[0])}"
        return pd.DataFrame({"name": [name] * keep, "payload": [data.tobytes()] * keep})

    return rows.select("by", "bx", "y", "x", *channels).groupBy("by", "bx").applyInPandas(run, CHUNK)


def write_zarr(pixels: DataFrame, path: str, h: int, w: int, chunk: int, channels: list[str], levels: int, um: float = 1.0) -> None:
    """A multiscale group of uint8 arrays; level k keeps every 2^k-th pixel and its shape halves downwards."""
    datasets = []
    for k in range(levels):
        hk, wk = max(1, h >> k), max(1, w >> k)
        step = 1 << k
        at = pixels.filter((F.col("y") % step == 0) & (F.col("x") % step == 0)).select(F.floor(F.col("y") / step).alias("y"), F.floor(F.col("x") / step).alias("x"), *channels)
        save(zarr_chunks(at.filter((F.col("y") < hk) & (F.col("x") < wk)), k, chunk, channels), path)
        array = {"zarr_format": 2, "shape": [len(channels), hk, wk], "chunks": [len(channels), chunk, chunk], "dtype": "|u1", "compressor": None, "fill_value": 0, "order": "C", "filters": None, "dimension_separator": "."}
        _write_json(f"{path}/{k}/.zarray", array)
        datasets.append({"path": str(k), "coordinateTransformations": [{"type": "scale", "scale": [1.0, um * step, um * step]}]})
    axes = [{"name": "c", "type": "channel"}] + [{"name": a, "type": "space", "unit": "micrometer"} for a in "yx"]
    _write_json(f"{path}/.zgroup", {"zarr_format": 2})
    _write_json(f"{path}/.zattrs", {"multiscales": [{"version": "0.4", "axes": axes, "datasets": datasets}]})


def read_zarr(spark: SparkSession, path: str, level: int = 0) -> DataFrame:
    """(c, y, x, v) of the non-zero values of one uncompressed level."""
    with open(f"{path}/{level}/.zarray", encoding="utf-8") as f:
        meta = json.load(f)
    if meta["compressor"] is not None:
        raise ValueError("compressed chunks are not read")
    (n, h, w), (cn, ch, cw) = meta["shape"], meta["chunks"]
    names = [f"{level}/{c}.{y}.{x}" for c in range(-(-n // cn)) for y in range(-(-h // ch)) for x in range(-(-w // cw))]
    spark.dataSource.register(ChunkFiles)
    chunks = spark.read.format("chunk_files").option("path", path).option("names", json.dumps(names)).load()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, payload in zip(batch["name"], batch["payload"], strict=True):
                c0, y0, x0 = (int(v) * s for v, s in zip(name.split("/")[1].split("."), (cn, ch, cw), strict=True))
                data = np.frombuffer(payload, np.dtype(meta["dtype"])).reshape(cn, ch, cw)
                c, y, x = np.nonzero(data)
                ok = (y + y0 < h) & (x + x0 < w)
                yield pd.DataFrame({"c": c[ok] + c0, "y": y[ok] + y0, "x": x[ok] + x0, "v": data[c, y, x][ok].astype(np.int64)})

    return chunks.mapInPandas(run, "c long, y long, x long, v long")


def write_precomputed(voxels: DataFrame, path: str, size: tuple[int, int, int], chunk: tuple[int, int, int], um: tuple[float, float, float], layer: str = "image") -> None:
    """A one-scale raw volume of uint8 from rows (x, y, z, v): chunk files x0-x1_y0-y1_z0-z1, x fastest; zeros elsewhere."""
    spark = voxels.sparkSession
    axes = "xyz"
    grid = spark.range(1).select("id")
    for a, n, c in zip(axes, size, chunk, strict=True):
        grid = grid.withColumn(f"b{a}", F.explode(F.sequence(F.lit(0), F.lit(-(-n // c) - 1))))
    rows = voxels.select(*axes, "v", *[F.floor(F.col(a) / c).cast("int").alias(f"b{a}") for a, c in zip(axes, chunk, strict=True)])
    all_ = grid.drop("id").join(rows, ["bx", "by", "bz"], "left")  # chunks without voxels are written too

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        lo = [int(rows[f"b{a}"].iloc[0]) * c for a, c in zip(axes, chunk, strict=True)]
        hi = [min(x + c, n) for x, c, n in zip(lo, chunk, size, strict=True)]
        data = np.zeros([b - a for a, b in zip(lo, hi, strict=True)], np.uint8)
        own = rows.dropna(subset=["v"])
        data[tuple(own[a].to_numpy(np.int64) - x for a, x in zip(axes, lo, strict=True))] = own["v"].to_numpy(np.int64)
        name = "0/" + "_".join(f"{a}-{b}" for a, b in zip(lo, hi, strict=True))
        return pd.DataFrame({"name": [name], "payload": [data.tobytes(order="F")]})

    save(all_.groupBy("bx", "by", "bz").applyInPandas(run, CHUNK), path)
    scale = {"chunk_sizes": [list(chunk)], "encoding": "raw", "key": "0", "resolution": [int(round(u * 1000)) for u in um], "size": list(size), "voxel_offset": [0, 0, 0]}
    _write_json(f"{path}/info", {"@type": "neuroglancer_multiscale_volume", "data_type": "uint8", "num_channels": 1, "type": layer, "scales": [scale]})
