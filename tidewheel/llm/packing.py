"""Packing of document pieces into sequences of fixed capacity.

Two ways of choosing the place: ``sum_of_squares`` keeps the counts of open bins per residual gap level,
``best_fit_decreasing`` searches a segment tree for the tightest gap.  Both see only lengths.  Pieces are dealt by
hash into shards of about ``SHARD`` pieces; a shard is one task's work, whatever the corpus holds, and leaves a few
part-filled sequences at most.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.tokens import cut_pieces

SHARD = 1 << 17


def sum_of_squares(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item, placed longest first.

    With N(g) open bins of gap g, an item of length s may go into any gap g >= s; it goes where the sum of N(g) squared
    becomes smallest: the change is 2 (N(g - s) - N(g)) + 2, or 1 - 2 N(g) where it fills the bin.  Ties go to the
    tightest gap.  A new bin is opened where no open one holds the item.
    """
    count = np.zeros(size + 1, np.int64)
    stacks: list[list[int]] = [[] for _ in range(size + 1)]
    bins, offsets, used = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), 0
    for i in np.argsort(-lengths, kind="stable"):
        s = int(lengths[i])
        gaps = np.flatnonzero(count[s:]) + s
        if len(gaps):
            rest = gaps - s
            change = np.where(rest > 0, 2 * count[rest] - 2 * count[gaps] + 2, 1 - 2 * count[gaps])
            g = int(gaps[np.argmin(change)])
            b = stacks[g].pop()
            count[g] -= 1
        else:
            b, g, used = used, size, used + 1
        bins[i], offsets[i] = b, size - g
        if g > s:
            stacks[g - s].append(b)
            count[g - s] += 1
    return bins, offsets


def best_fit_decreasing(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item, longest first, each into the tightest gap that holds it.

    A segment tree over the gaps 0 .. size holds how many open bins lie below each node; the tightest gap >= s is
    found by one climb and one descent.
    """
    leaves = 1 << size.bit_length()
    tree = [0] * (2 * leaves)
    stacks: list[list[int]] = [[] for _ in range(size + 1)]

    def add(g: int, by: int) -> None:
        g += leaves
        while g:
            tree[g] += by
            g >>= 1

    def tightest(s: int) -> int:
        n = s + leaves
        if not tree[n]:
            while n > 1 and (n & 1 or not tree[n + 1]):
                n >>= 1
            if n <= 1:
                return -1
            n += 1
            while n < leaves:
                n = 2 * n if tree[2 * n] else 2 * n + 1
        return n - leaves

    bins, offsets, used = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), 0
    for i in np.argsort(-lengths, kind="stable"):
        s = int(lengths[i])
        g = tightest(s)
        if g < 0:
            b, g, used = used, size, used + 1
        else:
            b = stacks[g].pop()
            add(g, -1)
        bins[i], offsets[i] = b, size - g
        if g > s:
            stacks[g - s].append(b)
            add(g - s, 1)
    return bins, offsets


def assign(pieces: DataFrame, size: int, place, shard: int = SHARD) -> DataFrame:
    """``row, piece, sequence_id, offset``; ``pieces`` comes from a written table, of which only lengths are read."""
    lengths = pieces.select("row", "piece", "length")
    shards = max(1, -(-lengths.count() // shard))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["row", "piece"], kind="stable")
        bins, offsets = place(pdf["length"].to_numpy(), size)
        return pd.DataFrame({"row": pdf["row"], "piece": pdf["piece"], "sequence_id": (pdf["shard"].to_numpy() << 36) + bins, "offset": offsets})

    return (lengths.withColumn("shard", F.pmod(F.xxhash64("row", "piece"), F.lit(shards)))
            .groupBy("shard").applyInPandas(run, "row bigint, piece int, sequence_id bigint, offset bigint"))


def pack_parts(docs: DataFrame, path: str, *, size: int = 2048, place=sum_of_squares, by_chunk: bool = True, shard: int = SHARD,
               columns: dict[str, Column] | None = None, narrow: bool = False) -> tuple[DataFrame, DataFrame]:
    """The pieces of ``pack_documents`` in two frames: those that fill a sequence alone, which no shuffle touches, and the others."""
    pieces = cut_pieces(docs, path, size, by_chunk=by_chunk, narrow=narrow)
    what = {"ids": F.col("ids")} if columns is None else columns
    asked = [c.alias(n) for n, c in what.items()]
    alone = pieces.where(F.col("length") == size).select(
        "doc_id", "piece", "start", "length", *asked, (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    rest = pieces.where(F.col("length") < size)
    shared = (rest.select("row", "doc_id", "piece", "start", "length", *asked).join(assign(rest, size, place, shard), ["row", "piece"])
              .select("doc_id", "piece", "start", "length", *what, "sequence_id", "offset"))
    return alone, shared


def pack_documents(docs: DataFrame, path: str, **how) -> DataFrame:
    """Pieces with their place: ``doc_id, piece, start, length, sequence_id, offset`` and ``ids``.

    ``columns`` replaces ``ids`` by expressions over it, computed before rows move; ``narrow`` gives ids of two bytes; the other
    arguments are those of ``pack_parts``.  Every document gives at least the closing id, so null and empty texts take one place; repeated
    rows are packed as often as they come; an empty table gives no rows.
    """
    alone, shared = pack_parts(docs, path, **how)
    return alone.unionByName(shared)


def id_matrix(shared: DataFrame, size: int = 2048, pad_id: int = 0, narrow: bool = False, alone: DataFrame | None = None) -> DataFrame:
    """One row per sequence, as a trainer reads it.

    ``input_ids`` (uint32 little-endian, padded to ``size``), ``n_tokens``, ``cu_seqlens`` (0, then the end of each
    segment), ``position_ids`` (restart at 0 in each segment; the padding is one more run), ``doc_ids`` and ``pieces``.
    A sequence holds ``size`` ids at most, so the lists are bounded.  ``narrow``: the given ``ids`` have two bytes each.  Rows of ``alone`` are a
    sequence each and need no grouping.  No pieces give no rows.
    """
    entry = F.struct("offset", "length", "doc_id", "piece", "ids")
    s = shared.groupBy("sequence_id").agg(F.sort_array(F.collect_list(entry)).alias("s"))
    if alone is not None:
        s = s.unionByName(alone.select("sequence_id", F.array(entry).alias("s")))
    parts = s.select("sequence_id", F.transform("s", lambda x: x["length"].cast("int")).alias("lengths"), F.transform("s", lambda x: x["doc_id"]).alias("doc_ids"),
                     F.transform("s", lambda x: x["piece"]).alias("pieces"), F.transform("s", lambda x: x["ids"]).alias("ids"))
    held = "<u2" if narrow else "<u4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell = np.arange(size, dtype=np.int32)
        for b in batches:
            for lo in range(0, len(b), 200):
                part = b.slice(lo, 200)
                n = len(part)
                lengths, raw = part.column(1).flatten().to_numpy().astype(np.int64), part.column(4).flatten().cast(pa.binary())
                count = part.column(1).value_lengths().to_numpy().astype(np.int64)
                row, ends = np.repeat(np.arange(n), count), np.cumsum(lengths)
                total = np.bincount(row, weights=lengths, minlength=n).astype(np.int64)
                start = ends - lengths - (np.cumsum(total) - total)[row]
                at = np.frombuffer(raw.buffers()[1], np.int32, len(raw) + 1, 4 * raw.offset)
                flat = np.frombuffer(raw.buffers()[2], np.uint8, at[-1] - at[0], at[0]).view(held) if len(raw) else np.empty(0, held)
                ids = np.full((n, size), pad_id, "<u4")
                ids[cell < total[:, None]] = flat
                # Each cell's segment begins at the last mark before it; the padding is one more run.
                mark = np.zeros((n, size), np.int32)
                mark[row, start] = start
                short = np.flatnonzero(total < size)
                mark[short, total[short]] = total[short]
                place = cell - np.maximum.accumulate(mark, axis=1)
                cuts = np.zeros(len(lengths) + n, np.int32)
                cuts[np.arange(len(lengths)) + row + 1] = start + lengths
                wide, edges = np.arange(n + 1, dtype=np.int32) * size, np.concatenate([[0], np.cumsum(count + 1)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(total.astype(np.int32)), pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(4 * wide), pa.py_buffer(ids)]),
                     pa.ListArray.from_arrays(pa.array(edges), pa.array(cuts)), pa.ListArray.from_arrays(pa.array(wide), pa.array(place.ravel())), part.column(2), part.column(3)],
                    ["sequence_id", "n_tokens", "input_ids", "cu_seqlens", "position_ids", "doc_ids", "pieces"])

    return parts.mapInArrow(run, "sequence_id bigint, n_tokens int, input_ids binary, cu_seqlens array<int>, position_ids array<int>, doc_ids array<bigint>, pieces array<int>")


def write_matrix(matrix: DataFrame, path: str) -> None:
    """Packed rows as Parquet: fixed-width id rows beside their cumulative lengths and positions."""
    matrix.write.parquet(path)
