"""Mixing sources to target weights: repetition rates from token totals, whole copies plus one seeded draw."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewheel.llm.base import boxed, n_words, unit_hash, written


def source_targets(totals: DataFrame, weights: Sequence[float] = (5, 2, 1), cap: float = 3.0) -> DataFrame:
    """``source, source_size`` -> also ``target``: a share by weight of all sizes, at most ``cap`` times the source.

    Sources take the weights in turn, by code point, null last.  What exceeds a cap is shared again by weight among the
    rest until nothing does; this is filling by one level: in order of cap per weight, the first j sources are at
    their cap and the others get level_j times their weight, for the smallest j whose level leaves the next below its
    cap.  Sources without words get 0.  One row per source goes through one task here, never documents.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights) + 1
    t = totals.withColumn("w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn))
    fill = Window.orderBy(F.col("source_size") / F.col("w"), F.col("source").asc_nulls_last())
    before, every = fill.rowsBetween(Window.unboundedPreceding, -1), fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    cap_size = F.col("source_size") * F.lit(float(cap))
    left = F.sum("source_size").over(every) - F.coalesce(F.sum(cap_size).over(before), F.lit(0.0))
    level = left / (F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
    t = t.withColumn("_cap", cap_size).withColumn("_level", level)
    # Levels rise to the first source that stays below its cap and fall after it, so its level, everyone's, is the highest.
    open_level = F.max(F.when(F.col("_level") * F.col("w") < F.col("_cap"), F.col("_level"))).over(every)
    return t.select("source", "source_size", F.least("_cap", F.coalesce(open_level * F.col("w"), F.col("_cap"))).alias("target"))


def mix_plan(docs: DataFrame, *, weights: Sequence[float] = (5, 2, 1), cap: float = 3.0, seed: int = 17, size: Column | None = None) -> DataFrame:
    """``docs`` with ``size, source_size, target, copies``.

    The rate of a source is target / source_size; a document is taken floor(rate) times and once more if the hash of
    its ``doc_id`` and the seed falls below the fraction, so reruns and repeated rows agree.  Null texts have size 0,
    a source without words has rate 0.  ``docs`` must hold ``doc_id, text, source``; columns named like the added ones
    are replaced.  The per-source table is written, so the planner knows its size: where it is small it is broadcast and no
    document moves, else the join is dealt by source and a hot one is split.
    """
    size = n_words(F.col("text")) if size is None else size
    d = docs.withColumn("size", size)
    totals = d.groupBy("source").agg(F.sum("size").alias("source_size"))
    t = written(source_targets(totals, weights, cap).withColumnRenamed("source", "_source"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    drawn = unit_hash(F.col("doc_id"), seed=seed) < rate - F.floor(rate)
    return (d.drop("source_size", "target", "copies").join(t, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")
            .withColumn("copies", (F.floor(rate) + drawn.cast("bigint")).cast("int")))


def mix(docs: DataFrame, **how) -> DataFrame:
    """The mixed corpus: every document as often as planned, with the columns of ``docs``."""
    plan = mix_plan(boxed(docs, "doc_id", "text", "source"), **how).where("copies > 0")
    return plan.select("_doc", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("_doc.*")


#: DuckDB form of ``mix_plan`` over ``documents``, with the default weights, cap and seed.
SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
t AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS w,
             3.0::DOUBLE * source_size AS cap FROM t),
o AS (SELECT *, row_number() OVER (ORDER BY source_size / w, source NULLS LAST) AS k,
             ((sum(source_size) OVER ())::DOUBLE - coalesce(sum(cap) OVER (ORDER BY source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
             / (sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level FROM w),
f AS (SELECT source, source_size, least(cap, coalesce((SELECT level FROM o p WHERE p.level * p.w < p.cap ORDER BY p.k LIMIT 1) * w, cap)) AS target FROM o),
r AS (SELECT d.doc_id, d.size, f.source_size, f.target, CASE WHEN f.source_size > 0 THEN f.target / f.source_size ELSE 0.0::DOUBLE END AS rate
      FROM d JOIN f ON d.source IS NOT DISTINCT FROM f.source)
SELECT doc_id, size, source_size, target,
       (size * (floor(rate)::BIGINT + (('0x' || substr(md5('17|' || coalesce(doc_id::VARCHAR, '~')), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE < rate - floor(rate))::BIGINT))::BIGINT AS taken
FROM r
"""
