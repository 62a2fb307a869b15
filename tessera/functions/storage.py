"""Tables written to the folder that all executors share: they cut lineage and survive lost executors."""

from __future__ import annotations

import atexit
import gc
import uuid

from pyspark.sql import DataFrame, SparkSession

_written: list[tuple[SparkSession, str]] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; one under the warehouse where that is unset, as in tests."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/.shared"
    return folder.rstrip("/")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/tessera-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    _written.append((spark, path))
    out = spark.read.schema(df.schema).parquet(path)
    out._tessera_path = path
    return out


def discard(*frames: DataFrame) -> None:
    """Delete the files of tables from materialise() that nothing will read any more."""
    for df in frames:
        path = getattr(df, "_tessera_path", None)
        if path:
            _delete(df.sparkSession, path)
            _written.remove((df.sparkSession, path))


def sweep(spark: SparkSession) -> None:
    """Have the driver collect what nothing refers to any more.

    Spark deletes the shuffle files of a finished step when its plan is collected, which a driver with a large heap may
    put off until long after the next steps have needed the disk. Spark's listeners and scheduler hold the plan that ran
    last until another one has run, so a small one does.
    """
    gc.collect()
    spark.range(1).write.format("noop").mode("overwrite").save()
    spark._jvm.System.gc()


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


@atexit.register
def _clean() -> None:
    for spark, path in _written:
        try:
            _delete(spark, path)
        except Exception:  # noqa: BLE001  the session may be gone already
            return
