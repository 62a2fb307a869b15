"""Streaming forms: windowed event statistics with late data, and the running state of lineage runs."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

STATUS = "run_id string, status string, n_events long"


def read(spark: SparkSession, folder: str, schema, files_per_trigger: int = 1) -> DataFrame:
    """A stream over the Parquet files that appear in a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def windowed(events: DataFrame, time: str, key: str, value: str, window: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Counts and sums for each window and key; events later than the watermark are left out."""
    e = events.withWatermark(time, late)
    return e.groupBy(F.window(time, window).alias("w"), key).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total")).select(F.col("w.start").alias("start"), key, "n", "total")


def _fold(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    at, status, n = state.get if state.exists else (-1, None, 0)
    for rows in batches:
        n += len(rows)
        last = rows.sort_values(["at", "event_type"]).iloc[-1]
        if int(last["at"]) >= at:
            at, status = int(last["at"]), last["event_type"]
    state.update((at, status, n))
    yield pd.DataFrame({"run_id": [key[0]], "status": [status], "n_events": [n]})


def run_states(events: DataFrame) -> DataFrame:
    """The latest status of each run (run_id, at, event_type), by time of the event and not of its arrival."""
    return events.groupBy("run_id").applyInPandasWithState(_fold, STATUS, "at long, status string, n long", "update", GroupStateTimeout.NoTimeout)
