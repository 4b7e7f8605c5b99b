"""Chat formatting: logged snapshots of a growing conversation collapse to the longest, then turns are rendered."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Turns of one rendered row; a longer conversation gives several rows.
PART = 256


def numbered(turns: DataFrame, chunk: int = PART) -> DataFrame:
    """Distinct turns with ``k`` (position from 1) and ``h1, h2, h3`` (rolling hashes of the prefix that ends there).

    Positions and hashes run inside chunks of ``turn`` numbers and are carried on from one row per chunk, so a conversation
    with very many turns is many tasks' work.  Order within a conversation: turn (null first), role, text.
    """
    d = turns.select("conv_id", "turn", "role", "text").distinct().withColumn("_c", F.coalesce(F.floor(F.col("turn") / chunk), F.lit(-(1 << 62))))
    inner = Window.partitionBy("conv_id", "_c").orderBy("turn", "role", "text")
    counts = d.groupBy("conv_id", "_c").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("conv_id").orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select(F.col("conv_id").alias("_id"), F.col("_c").alias("_cc"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_k0"))
    d = d.join(first, F.col("conv_id").eqNullSafe(F.col("_id")) & (F.col("_c") == F.col("_cc"))).drop("_id", "_cc")
    d = d.withColumn("k", F.row_number().over(inner) + F.col("_k0"))
    # A turn's hash holds its place, role and text, so that sums over a prefix tell prefixes apart; three
    # numbers of 48 bits keep the sums in range.
    said = F.sha2(F.concat_ws("|", F.col("k").cast("string"), F.length(F.coalesce("role", F.lit(""))).cast("string"), F.col("role").isNull().cast("string"), F.col("text").isNull().cast("string"), F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))), 256)
    piece = lambda at: F.conv(F.substring(said, at, 12), 16, 10).cast("bigint")
    names = ["h1", "h2", "h3"]
    d = d.withColumns({f"_p{i}": piece(1 + 12 * i) for i in range(3)})
    sums = d.groupBy("conv_id", "_c").agg(*[F.sum(f"_p{i}").alias(f"_s{i}") for i in range(3)])
    carried = sums.select(F.col("conv_id").alias("_id"), F.col("_c").alias("_cc"), *[F.coalesce(F.sum(f"_s{i}").over(before), F.lit(0)).alias(f"_b{i}") for i in range(3)])
    run = inner.rowsBetween(Window.unboundedPreceding, 0)
    d = d.join(carried, F.col("conv_id").eqNullSafe(F.col("_id")) & (F.col("_c") == F.col("_cc")))
    return d.withColumns({n: F.sum(f"_p{i}").over(run) + F.col(f"_b{i}") for i, n in enumerate(names)}).select("conv_id", "turn", "role", "text", "k", *names)


def maximal(prefixes: DataFrame) -> DataFrame:
    """``conv_id, n_turns`` of the conversations that no longer one begins with; of equal ones the smallest id stays.

    Prefix hashes are first reduced to the longest conversation that has them, map-side, so a first turn that a third of
    all conversations share is one row of the join.
    """
    key = ["k", "h1", "h2", "h3"]
    whole = prefixes.groupBy("conv_id").agg(F.max(F.struct(*key)).alias("e")).select("conv_id", "e.*")
    own = whole.groupBy(*key).agg(F.min("conv_id").alias("conv_id"), F.count("conv_id").alias("_n"))
    longer = prefixes.join(whole.select(F.col("conv_id").alias("_id"), F.col("k").alias("_all")), F.col("conv_id").eqNullSafe(F.col("_id")))
    longer = longer.groupBy(*key).agg(F.max("_all").alias("_longest")).where(F.col("_longest") > F.col("k"))
    return own.join(longer, key, "left_anti").select("conv_id", F.col("k").alias("n_turns"))


def collapse_and_render(turns: DataFrame, *, part: int = PART) -> DataFrame:
    """Rows ``conv_id, part, n_turns, text`` of the maximal conversations.

    A turn becomes ``<|role|>``, a line break, its text, ``<|end|>`` and a line break; null roles read ``unknown``, null texts
    are empty.  Part p holds turns p * ``part`` + 1 and on, so no row gathers an unbounded conversation.  Repeated rows
    count once; null ids are one conversation.
    """
    p = numbered(turns)
    m = maximal(p).withColumnRenamed("conv_id", "_id")
    line = F.concat(F.lit("<|"), F.coalesce("role", F.lit("unknown")), F.lit("|>\n"), F.coalesce("text", F.lit("")), F.lit("<|end|>\n"))
    d = p.join(m, F.col("conv_id").eqNullSafe(F.col("_id"))).select("conv_id", "n_turns", F.floor((F.col("k") - 1) / part).cast("int").alias("part"), "k", line.alias("line"))
    g = d.groupBy("conv_id", "n_turns", "part").agg(F.sort_array(F.collect_list(F.struct("k", "line"))).alias("t"))
    return g.select("conv_id", "part", F.col("n_turns").cast("bigint").alias("n_turns"), F.array_join(F.transform("t", lambda x: x["line"]), "").alias("text"))


SQL = """
WITH t AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
k AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS k,
             coalesce(role, 'null') || chr(1) || coalesce(role || text, 'null') || chr(2) || coalesce(text, chr(3)) AS one FROM t),
p AS (SELECT *, string_agg(one, chr(4)) OVER (PARTITION BY conv_id ORDER BY k) AS h, count(*) OVER (PARTITION BY conv_id) AS n FROM k),
w AS (SELECT conv_id, n, h FROM p WHERE k = n),
m AS (SELECT min(conv_id) AS conv_id FROM w WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.h = w.h AND p.k = w.n AND p.n > w.n) GROUP BY h, n)
SELECT conv_id, ((k - 1) // 256)::INT AS part, n::BIGINT AS n_turns,
       string_agg('<|' || coalesce(role, 'unknown') || '|>' || chr(10) || coalesce(text, '') || '<|end|>' || chr(10), '' ORDER BY k) AS text
FROM p WHERE conv_id IN (SELECT conv_id FROM m) GROUP BY ALL
"""
