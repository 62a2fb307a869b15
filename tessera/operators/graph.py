"""Connected components of links between 64-bit keys, by alternating star contractions, entirely in DataFrames."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.storage import discard, materialise

#: A graph of no more links than this is solved by one task: rounds of jobs would cost more than they do.
FEW = 1 << 14


def components(links: DataFrame) -> DataFrame:
    """(key, root) of every key in links (a, b); root is the smallest key that can be reached.

    Each round links every node's larger neighbours, then its smaller ones, to its smallest neighbour: the number of
    rounds grows with the logarithm of the number of keys. Each round is written, so that lineage stays short; the rounds
    end only when no link changed, so the result is whole for any graph. A node of very many neighbours only ever takes
    part in aggregations and equi-joins, which combine before the shuffle or are split by adaptive execution. No links
    give no rows; links of a key to itself, and links with a null, are ignored.
    """
    edges = links.select(F.least("a", "b").cast("long").alias("lo"), F.greatest("a", "b").cast("long").alias("hi")).filter("lo < hi").distinct()
    edges = materialise(edges, "links")
    if edges.limit(FEW + 1).count() <= FEW:
        found = materialise(edges.coalesce(1).mapInArrow(_few, "key long, root long"), "roots")
        discard(edges)
        return found
    before = None
    while True:
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("m").alias("lo"), F.col("v").alias("hi")).filter("lo < hi").distinct()
        low = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(low, "hi").select(F.col("m").alias("lo"), F.explode(F.array("lo", "hi")).alias("hi")).filter("lo < hi").distinct()
        edges, old = materialise(small, "links"), edges
        discard(old)
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("lo", "hi").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = edges.select(F.col("hi").alias("key"), F.col("lo").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("key"), "root").distinct())


def _few(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = x = root[root[x]]
        return x

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    keys = list(root)
    if keys:
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array([find(k) for k in keys], pa.int64())], ["key", "root"])
