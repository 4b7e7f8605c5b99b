"""Session settings, lineage cuts and jobs side by side."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot series id stays splittable even when the next stage wants the same key.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


#: Independent jobs that run at a time.
WORKERS = 4


def get_spark(app: str = "tidewheel", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the library expects; a cluster's own master is left alone."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder ``spark.checkpoint.dir``; where it is unset (tests), the session's warehouse, which is shared as well."""
    return spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")


_MADE: list[str] = []


def new_folder(spark: SparkSession) -> str:
    """Unused path inside the shared folder."""
    path = f"{shared_folder(spark).rstrip('/')}/tidewheel-{uuid.uuid4().hex}"
    _MADE.append(path)
    return path


def clear_scratch(spark: SparkSession) -> int:
    """Delete every folder that ``new_folder`` has named in this process; nothing may still read them.  Their number."""
    n = len(_MADE)
    while _MADE:
        place = spark._jvm.org.apache.hadoop.fs.Path(_MADE.pop())
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    return n


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: later stages survive lost executors, read only the columns they need and
    know the size of what they join."""
    path = new_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def side_by_side(spark: SparkSession, jobs: Sequence[Callable[[], object]], workers: int = WORKERS) -> list:
    """Results of independent ``jobs``, in order; at most ``workers`` run at a time, the first error is raised."""
    if workers <= 1 or len(jobs) <= 1:
        return [j() for j in jobs]
    with ThreadPoolExecutor(min(workers, len(jobs))) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(j)) for j in jobs]
        return [f.result() for f in running]
