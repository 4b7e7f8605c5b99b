"""Best-fit decreasing with freely cut ends: full windows first, the tails into the tightest gap, the last gaps topped up.

The tails are dealt by hash into shards of about ``SHARD`` rows, of which one task sees only numbers and lengths.
Token ids never go through a shuffle, but for the few tails that topping up cuts.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.base import small_batches, written
from tidewheel.llm.tokens import encoder

SHARD = 1 << 17


class Gaps:
    """Segment tree over the remaining capacities 0 .. size with 64 children a node.

    Bit b of a node says whether anything below its child b is open; the tightest capacity that holds a length is found
    by one climb and one descent over three levels at most for sizes up to 262,143.
    """

    def __init__(self, size: int):
        self.levels: list[list[int]] = []
        n = size + 1
        while not self.levels or n > 1:
            n = -(-n // 64)
            self.levels.append([0] * n)

    def open(self, gap: int) -> None:
        for level in self.levels:
            node = gap >> 6
            level[node] |= 1 << (gap & 63)
            gap = node

    def close(self, gap: int) -> None:
        for level in self.levels:
            node = gap >> 6
            level[node] &= ~(1 << (gap & 63))
            if level[node]:
                return
            gap = node

    def tightest(self, length: int) -> int:
        """Least open capacity of at least ``length``; -1 if there is none."""
        at = length
        for up, level in enumerate(self.levels):
            node = at >> 6
            right = level[node] >> (at & 63) if node < len(level) else 0
            if right:
                at += (right & -right).bit_length() - 1
                for below in reversed(self.levels[:up]):
                    bits = below[at]
                    at = (at << 6) + (bits & -bits).bit_length() - 1
                return at
            at = node + 1
        return -1


def best_fit(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Window and offset of each length (1 .. size), longest first, each into the tightest window that holds it."""
    gaps, held = Gaps(size), [[] for _ in range(size + 1)]
    window, offset, used = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[i])
        gap = gaps.tightest(need)
        if gap < 0:
            w, gap, used = used, size, used + 1
        else:
            w = held[gap].pop()
            if not held[gap]:
                gaps.close(gap)
        window[i], offset[i] = w, size - gap
        if gap > need:
            held[gap - need].append(w)
            gaps.open(gap - need)
    return window, offset


def top_up(lengths: np.ndarray, window: np.ndarray, offset: np.ndarray, size: int) -> list[tuple[int, int, int, int, int]]:
    """``item, from, length, window, offset`` of pieces that leave every window full or at a power of two.

    Windows that would need padding are ordered by load; the fullest of them are filled up with the rest's content, cut
    where a window ends, and what is left over is dealt by its binary digits into windows of powers of two.  All other windows stay.
    """
    load = np.bincount(window, weights=lengths).astype(np.int64) if len(window) else np.zeros(0, np.int64)
    short = np.flatnonzero((load < size) & (load & (load - 1) != 0))
    short = short[np.argsort(-load[short], kind="stable")]
    full, rest = divmod(int(load[short].sum()), size)
    room = [(int(w), int(load[w]), size - int(load[w])) for w in short[:full]]
    room += [(len(load) + k, 0, 1 << k) for k in reversed(range(rest.bit_length())) if rest >> k & 1]
    given = np.zeros(len(load) + 1, bool)
    given[short[full:]] = True
    move = np.flatnonzero(given[window]) if len(window) else np.zeros(0, np.int64)
    stay = np.flatnonzero(~given[window]) if len(window) else move
    out = list(zip(stay.tolist(), [0] * len(stay), lengths[stay].tolist(), window[stay].tolist(), offset[stay].tolist()))
    slots = iter(room)
    w, at, free = next(slots, (0, 0, 0))
    for i in move[np.lexsort((move, -lengths[move]))].tolist():
        start, left = 0, int(lengths[i])
        while left:
            if not free:
                w, at, free = next(slots)
            n = min(left, free)
            out.append((i, start, n, w, at))
            start, left, at, free = start + n, left - n, at + n, free - n
    return out


def windows(docs: DataFrame, path: str, size: int, *, end_id: int = 1, by_chunk: bool = True) -> DataFrame:
    """``row, doc_id, start, length, doc_tokens, ids``: full windows of each document, then its tail if there is one.

    ``ids`` are little-endian uint32: the document's, then ``end_id``; ``row`` numbers the input rows.  A written table.
    """
    small_batches(docs.sparkSession)
    kinds = [("row", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()), ("ids", pa.binary())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end = encoder(path, by_chunk), struct.pack("<I", end_id)
        for b in batches:
            rows, ids, texts = (c.to_pylist() for c in b.columns)
            for lo in range(0, len(rows), 200):
                out = []
                for r, d, raw in zip(rows[lo:lo + 200], ids[lo:lo + 200], enc.encode([t or "" for t in texts[lo:lo + 200]])):
                    raw += end
                    n = len(raw) // 4
                    out += [(r, d, k, min(size, n - k), n, raw[4 * k:4 * (k + size)]) for k in range(0, n, size)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*out), kinds)], [k for k, _ in kinds])

    d = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return written(d.mapInArrow(run, "row bigint, doc_id bigint, start bigint, length bigint, doc_tokens bigint, ids binary"))


def place_tails(tails: DataFrame, size: int, shard: int = SHARD) -> DataFrame:
    """``row, from, length, sequence_id, offset, cut`` of the pieces of each tail; a written table."""
    shards = max(1, -(-tails.count() // shard))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("row", kind="stable", ignore_index=True)
        lengths = pdf["length"].to_numpy()
        item, start, n, w, at = (np.array(c, np.int64) for c in zip(*top_up(lengths, *best_fit(lengths, size), size)))
        return pd.DataFrame({"row": pdf["row"].to_numpy()[item], "from": start, "length": n, "sequence_id": (pdf["shard"].to_numpy()[0] << 36) + w,
                             "offset": at, "cut": n < lengths[item]})

    dealt = tails.select("row", "length", F.pmod(F.xxhash64("row"), F.lit(shards)).alias("shard"))
    return written(dealt.groupBy("shard").applyInPandas(run, "row bigint, from bigint, length bigint, sequence_id bigint, offset bigint, cut boolean"))


def pack(docs: DataFrame, path: str, *, size: int = 2048, end_id: int = 1, by_chunk: bool = True, shard: int = SHARD,
         columns: dict[str, Column] | None = None) -> DataFrame:
    """Pieces with their place: ``doc_id, start, length, doc_tokens, sequence_id, offset`` and ``ids`` (uint32, little-endian).

    Every id of every document, its closing ``end_id`` included, lies in exactly one piece.  Each shard's sequences hold
    ``size`` ids or a power of two, so nothing is padded; full windows of long documents are sequences of their own
    (negative numbers) and take no part in any shuffle.  ``columns`` replaces ``ids`` by expressions over it, computed
    before rows move.

    Null and empty texts are the closing id alone; null ids stay null; repeated rows are packed as often as they come; ties in
    length go by row; an empty table gives no rows.  Only ``doc_id`` and ``text`` are read, so other columns cannot clash.
    """
    pieces = windows(docs, path, size, end_id=end_id, by_chunk=by_chunk)
    what = {"ids": F.col("ids")} if columns is None else columns
    asked = [c.alias(n) for n, c in what.items()]
    names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", *what]
    tails = pieces.where(F.col("length") < size)
    placed = place_tails(tails, size, shard)
    alone = (pieces.where(F.col("length") == size)
             .select("doc_id", "start", "length", "doc_tokens", (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"), *asked))
    whole = (tails.select("row", "doc_id", "start", "length", "doc_tokens", *asked)
             .join(placed.where("NOT cut").select("row", "sequence_id", "offset"), "row").select(*names))
    # A table of its own, so that the planner knows its size: mostly a few rows a shard.
    cuts = written(placed.where("cut").withColumnRenamed("length", "n"))
    parts = tails.join(cuts, "row").select(
        "doc_id", (F.col("start") + F.col("from")).alias("start"), F.col("n").alias("length"), "doc_tokens", "sequence_id", "offset",
        F.substring("ids", (4 * F.col("from") + 1).cast("int"), (4 * F.col("n")).cast("int")).alias("ids"))
    return alone.select(*names).unionByName(whole).unionByName(parts.select(*names[:6], *asked))
