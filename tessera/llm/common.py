"""Shared helpers: flat byte views of Arrow text, bounded blocks, shared-folder tables, label samples."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.storage import materialise

__all__ = ["WS", "blocks", "bounded_sample", "crc_mod", "flat", "materialise", "mix64", "small_batches"]

#: The characters that separate words in every contract here: space and 0x09-0x0D.
WS = " \t\n\x0b\x0c\r"

def small_batches(spark: SparkSession, rows: int = 500) -> None:
    """Bound the rows of one Arrow batch, so that a Python worker holds a few MB of text at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column as one uint8 array, and len + 1 offsets; nulls are empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]] if len(offsets) else raw, offsets - offsets[0]


def blocks(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of documents whose bytes together stay within limit; a longer document stands alone."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64): every output bit depends on every input bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def crc_mod(column: Column, m: int) -> Column:
    """crc32 of the id as text, modulo m; a null id counts as the empty text."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit(""))) % m


def bounded_sample(df: DataFrame, strata: str, most: int, seed: int = 7) -> DataFrame:
    """About `most` rows of each stratum, chosen by a hash of all columns' id: one counting pass, no sort.

    Each stratum is thinned by its own rate most / count, so what reaches the driver stays bounded
    (in expectation `most` rows a stratum) however large the table is.
    """
    counts = {r[0]: r[1] for r in df.groupBy(strata).count().collect()}
    keep = F.lit(False)
    for value, n in counts.items():
        rate = min(1.0, most / max(1, n))
        same = F.col(strata).isNull() if value is None else F.col(strata) == F.lit(value)
        if rate >= 1:
            hit = F.lit(True)
        else:
            hit = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(seed)), F.lit(1_000_003)) < int(rate * 1_000_003)
        keep = keep | (same & hit)
    return df.filter(keep)
