"""Lineage events: rows (event_id, event_time, event_type, run_id, job, inputs, outputs), arrays of dataset names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def edges(events: DataFrame) -> DataFrame:
    """(run_id, dataset, direction), distinct."""
    one = lambda c, d: events.select("run_id", F.explode(c).alias("dataset"), F.lit(d).alias("direction"))
    return one("inputs", "input").unionByName(one("outputs", "output")).distinct()


def runs_by_dataset(events: DataFrame, part: str = "") -> DataFrame:
    """(dataset, n_runs, first_run) of the datasets whose name contains part; first by time, ties by run."""
    e = events.withColumn("dataset", F.explode(F.array_union("inputs", "outputs"))).filter(F.contains(F.col("dataset"), F.lit(part)))
    return e.groupBy("dataset").agg(F.countDistinct("run_id").alias("n_runs"), F.min_by("run_id", F.struct("event_time", "run_id")).alias("first_run"))


def last_status(events: DataFrame) -> DataFrame:
    """(run_id, status, n_events): the type of the run's last event, ties by event_id."""
    return events.groupBy("run_id").agg(F.max_by("event_type", F.struct("event_time", "event_id")).alias("status"), F.count(F.lit(1)).alias("n_events"))


def job_history(events: DataFrame, job: str) -> DataFrame:
    """The runs of a job with their first and last times."""
    e = events.filter(F.col("job") == job)
    return e.groupBy("run_id").agg(F.min("event_time").alias("started"), F.max("event_time").alias("ended"), F.count(F.lit(1)).alias("n_events"))


def datasets(rows: DataFrame, namespace: str) -> DataFrame:
    """rows with dataset_namespace and dataset_name: of an object as they are (the namespace may be null), of a path its last part.

    rows: ds_name, ds_namespace, ds_path.
    """
    name = F.coalesce("ds_name", F.element_at(F.split(F.rtrim("ds_path", F.lit("/")), "/"), -1))
    return rows.withColumns({"dataset_namespace": F.coalesce(F.when(F.col("ds_name").isNotNull(), F.col("ds_namespace")), F.lit(namespace)), "dataset_name": name})


def run_details(events: DataFrame) -> DataFrame:
    """(run_id, job, n_events, events): each run with its events in order; a run has as many as it reported."""
    one = F.struct("event_time", "event_id", "event_type")
    out = events.groupBy("run_id").agg(F.min_by("job", F.struct("event_time", "event_id")).alias("job"), F.sort_array(F.collect_list(one)).alias("events"))
    return out.select("run_id", "job", F.size("events").cast("long").alias("n_events"), "events")


def export(events: DataFrame, path: str) -> None:
    """All events as JSON lines, in files sorted by event_id."""
    events.repartitionByRange("event_id").sortWithinPartitions("event_id").write.mode("overwrite").json(path)
