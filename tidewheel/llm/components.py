"""Connected components in Spark, and links inside groups of any size without listing a group's pairs."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.base import written

#: Members of a group that one task compares with each other.
BLOCK = 512


def components(edges: DataFrame, rows: int | None = None) -> DataFrame:
    """``node, root`` (smallest node reachable) of the long pairs ``a, b``; nodes without an edge to another are left out.
    ``rows`` is the caller's bound on the number of pairs, if it has one.

    Large star and small star in turn: every node links its larger neighbours, then its smaller ones, to the least of
    its neighbourhood, until nothing changes.  A neighbourhood is only ever aggregated to its minimum, so a hub does
    not gather in one task; each round is a written table.
    """
    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    e = written(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), rows=rows)
    last = state(e)
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("_m")).select("u", F.least("u", "_m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("p"))
        e = written(small.select("p.u", "p.v").where("u <> v").distinct(), rows=2 * last[0])
        now = state(e)
        if now == last:
            break
        last = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(e.select("v", "v").distinct())


def _forest(label: np.ndarray, mine: np.ndarray, linked: Callable[[int, np.ndarray], np.ndarray]) -> list[tuple[int, int]]:
    """Tree edges (indices) that join what ``linked(i, others)`` says is linked.

    Rows of one ``label`` are joined already.  Only pairs with a row of ``mine`` are asked for.  Every reached row is
    compared with those not reached yet, so all links count although few pairs of a connected group are compared.
    """
    n, edges = len(label), []
    left = np.ones(n, bool)
    same: dict[int, list[int]] = {}
    for i, x in enumerate(label.tolist()):
        same.setdefault(x, []).append(i)
    for start in range(n):
        if not left[start]:
            continue
        queue = list(same[label[start]])
        left[queue] = False
        while queue:
            i = queue.pop()
            ask = np.flatnonzero(left if mine[i] else left & mine)
            for j in ask[linked(i, ask)].tolist() if len(ask) else []:
                if left[j]:
                    edges.append((i, j))
                    joined = same[label[j]]
                    left[joined] = False
                    queue += joined
    return edges


def link_groups(rows: DataFrame, linker: Callable[[pd.DataFrame], Callable[[int, np.ndarray], np.ndarray]], *, block: int = BLOCK, weight: str = "1", heavy: int = 1 << 22,
                total: int | None = None) -> DataFrame:
    """Edges ``a, b`` that connect, inside each ``group``, exactly what its links connect.

    ``rows``: ``group, node`` (longs, distinct) and whatever ``linker(frame)`` needs to say which rows of the frame are linked.
    A group of up to ``block`` rows (and ``heavy`` in total ``weight``) is one task's frame.  A larger one is dealt into
    blocks: each block alone, then each with the first; then only the rows outside the group's largest
    component meet the other blocks.  No pair is skipped unless its rows are joined already, and no
    task holds more than two blocks.  ``total`` is the caller's bound on the number of rows, if it has one.
    """
    per = 1 << 11

    def compared(d: DataFrame, *by: str) -> DataFrame:
        """``local`` over the groups of ``by``: few bytes but much work, so the number of tasks goes by rows."""
        d = d.repartition(*by) if total is None else d.repartition(max(2, -(-total // per)), *by)
        return written(d.groupBy(*by).applyInPandas(local, shape))
    extra = [f for f in rows.schema if f.name not in ("group", "node")]
    shape = "a bigint, b bigint"

    def local(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("node", kind="stable").drop_duplicates("node", ignore_index=True)
        node = pdf["node"].to_numpy()
        mine = pdf["_mine"].to_numpy() if "_mine" in pdf else np.ones(len(pdf), bool)
        label = pdf["_label"].to_numpy() if "_label" in pdf else node
        found = _forest(label, mine, linker(pdf)) if len(pdf) > 1 else []
        return pd.DataFrame([(node[i], node[j]) for i, j in found], columns=["a", "b"], dtype="int64")

    # Written, so that its size is known: a small one is broadcast, and the rows are moved once only.
    size = written(rows.groupBy("group").agg(F.ceil(F.greatest(F.count(F.lit(1)) / block, F.sum(F.expr(weight)) / heavy)).cast("int").alias("_n")), rows=total, per=1 << 15)
    d = rows.join(size, "group").withColumn("_blk", F.pmod(F.xxhash64("node"), F.col("_n")).cast("int"))
    # Dealt by both keys, so that the blocks of a large group do not follow its join into one task.
    first = compared(d, "group", "_blk")
    large = written(size.where("_n > 1"), rows=total, per=per * block)
    if large.isEmpty():
        return first
    d = written(d.where("_n > 1"), rows=total)
    names = ["group", "node", "_blk", "_n", *[f.name for f in extra]]

    def labelled(edges: DataFrame) -> DataFrame:
        c = components(edges.join(d.select(F.col("node").alias("a")).distinct(), "a", "left_semi"), total)
        return d.join(c, "node", "left").select(*names, F.coalesce("root", "node").alias("_label"))

    to_first = labelled(first).withColumn("_to", F.explode(F.when(F.col("_blk") == 0, F.sequence(F.lit(1), F.col("_n") - 1)).otherwise(F.array("_blk"))))
    second = compared(to_first.withColumn("_mine", F.col("_blk") == 0), "group", "_to")
    both = first.union(second)
    lab = written(labelled(both), rows=total)
    counts = lab.groupBy("group", "_label").count()
    most = counts.groupBy("group").agg(F.max(F.struct("count", F.col("_label").alias("l"))).alias("_most")).select("group", F.col("_most.l").alias("_main"))
    lab = lab.join(most, "group").withColumn("_rest", F.col("_label") != F.col("_main"))
    loose = lab.where("_rest").groupBy("group").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("_parts"))
    lab = lab.join(loose, "group").withColumn("_part", F.pmod(F.xxhash64("node", F.lit(1)), F.col("_parts")).cast("int"))
    # A loose row goes to every block with its part; a block's own rows meet every part.
    own = lab.withColumn("_p", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))).withColumn("_b", F.col("_blk")).withColumn("_mine", F.col("_rest") & (F.col("_p") == F.col("_part")))
    away = lab.where("_rest").withColumn("_p", F.col("_part")).withColumn("_b", F.explode(F.sequence(F.lit(0), F.col("_n") - 1))).where("_b <> _blk").withColumn("_mine", F.lit(True))
    keep = [*names, "_label", "_p", "_b", "_mine"]
    return both.union(compared(own.select(*keep).union(away.select(*keep)), "group", "_p", "_b"))
