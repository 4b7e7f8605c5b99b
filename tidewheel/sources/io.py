"""Readers and writers: Parquet and CSV tables, many files at once, saved forecast artifacts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.core import Step, parse_step


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: str, **options) -> DataFrame:
    """Delimited text with an explicit schema (no inference pass)."""
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.options(header=True, **options).schema(schema).csv(paths)


def read_csv_many(spark: SparkSession, groups: Sequence[tuple[str | Sequence[str], str]],
                  **options) -> DataFrame:
    """Row-bind files of different widths; columns a file lacks become NULL."""
    frames = [read_csv(spark, paths, schema, **options) for paths, schema in groups]
    return bind_rows(*frames)


def bind_rows(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def write_snapshot(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists",
                   partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.format(fmt).save(path)


def save_artifacts(folder: str, tables: dict[str, DataFrame] | None = None,
                   models: dict[str, PipelineModel] | None = None) -> None:
    """One folder with parameter/forecast tables and fitted pipelines."""
    for name, df in (tables or {}).items():
        df.write.mode("overwrite").parquet(f"{folder}/tables/{name}")
    for name, model in (models or {}).items():
        model.write().overwrite().save(f"{folder}/models/{name}")


def load_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/tables/{name}")


def load_model(folder: str, name: str) -> PipelineModel:
    return PipelineModel.load(f"{folder}/models/{name}")


def make_timeseries(spark: SparkSession, start: str, by: str | Step, length_out: int) -> DataFrame:
    """Regular index ``ts``; made by the executors from a range of positions."""
    s = parse_step(by)
    i = F.col("id")
    step = (F.make_interval(months=(i * s.months).cast("int")) if s.months
            else F.make_dt_interval(secs=(i * s.seconds).cast("decimal(18,6)")))
    origin = F.lit(start).cast("timestamp_ntz")
    return spark.range(length_out).select((origin + step).alias("ts"))


def inline_frame(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)
