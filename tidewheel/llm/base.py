"""What the corpus operators share: scratch tables in the shared folder, stable hashes, word patterns."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words of the contract: runs of anything but space, tab, LF, VT, FF and CR.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
#: Rows and bytes of one Arrow batch: a batch of very long texts must fit a worker.
BATCH_ROWS, BATCH_BYTES = 1000, 16 << 20


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where it is unset (tests), the session's warehouse, which is shared as well."""
    return spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")


_SCRATCH: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


@contextmanager
def scratch_tables(spark: SparkSession) -> Iterator[None]:
    """Tables ``written`` inside, but for those to ``keep``, are deleted at the end: nothing lazy may still read them then."""
    made: list[str] = []
    token = _SCRATCH.set(made)
    try:
        yield
    finally:
        _SCRATCH.reset(token)
        for path in made:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


#: Rows of one file of a table whose size is known beforehand.
FILE_ROWS = 1 << 13


def written(df: DataFrame, keep: bool = False, rows: int | None = None, per: int = FILE_ROWS) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: computed once, survives lost executors, pruned on reread.

    Where the caller knows that about ``rows`` rows come, the last stage takes as many tasks as they need at ``per`` rows each (and no
    more than it would), so that a small table is not hundreds of files.
    """
    if rows is not None:
        df = df.coalesce(max(2, -(-rows // per)))
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/tidewheel-llm-{uuid.uuid4().hex}"
    made = _SCRATCH.get()
    if made is not None and not keep:
        made.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches that Python workers get, by rows and by bytes."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


#: How to free what this worker process keeps between its tasks, by what keeps it.
_HELD: dict[str, Callable[[], None]] = {}


def hold(name: str, clear: Callable[[], None]) -> None:
    """Let other operators' tasks in this worker process free a cache."""
    _HELD[name] = clear


def release(keep: str = "") -> None:
    """Free what earlier operators left in this worker process, but for ``keep``: workers are used again by later stages."""
    for name in [n for n in _HELD if n != keep]:
        _HELD.pop(name)()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def boxed(docs: DataFrame, *needed: str) -> DataFrame:
    """``needed`` columns beside the whole row as ``_doc``, so that added columns cannot clash with the row's own."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), *needed)


def words(text: Column) -> Column:
    """Array of the words of a text; empty for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def unit_hash(*parts: Column, seed: int) -> Column:
    """Uniform double in [0, 1) from the parts' text; the same on every engine that has MD5."""
    key = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("~")) for p in parts])
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("bigint") / F.lit(float(1 << 52))
