"""Near-duplicate documents: MinHash bands propose, odd sketches sift, full shingle sets decide."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.base import boxed, release, scratch_tables, small_batches, written
from tidewheel.llm.components import BLOCK, components, link_groups

M64 = (1 << 64) - 1
ROWS, MISS = 4, 1e-6  # rows of a band; chance to miss a pair just at the threshold
SKETCH_BITS = 512


def _constants(n: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    return rng.integers(1, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(text: str | None, width: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; fewer words than ``width``: the whole sequence as one.

    Words are runs of anything but ASCII white space, A-Z lower-cased.
    """
    words = (text or "").encode().lower().split()
    n, h = len(words), xxhash.xxh3_64_intdigest
    if n < width:
        return np.array([h(b" ".join(words), n + 1)] if n else [], np.uint64)
    a, c = np.fromiter(map(h, words), np.uint64, n), _constants(width, 11)
    s = a[:n - width + 1] * c[0]
    for k in range(1, width):
        s += a[k:n - width + 1 + k] * c[k]
    s ^= s >> np.uint64(32)
    s *= np.uint64(0xD6E8FEB86659FD93)
    s ^= s >> np.uint64(32)
    return np.unique(s)


def min_hashes(s: np.ndarray, k: int) -> np.ndarray:
    """``k`` MinHash samples (uint32) of a non-empty set."""
    a, b = _constants(k, 1)[:, None], _constants(k, 2)[:, None]
    best = np.full(k, M64, np.uint64)
    for lo in range(0, len(s), 1024):
        best = np.minimum(best, (a * s[None, lo:lo + 1024] + b).min(1))
    return (best >> np.uint64(32)).astype(np.uint32)


def odd_sketch(samples: np.ndarray, bits: int = SKETCH_BITS) -> bytes:
    """Parity bitmap: each (position, sample) flips one bit."""
    z = samples.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.arange(len(samples), dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    z ^= z >> np.uint64(31)
    z *= np.uint64(0xD6E8FEB86659FD93)
    return np.packbits((np.bincount((z >> np.uint64(33)).astype(np.int64) % bits, minlength=bits) & 1).astype(np.uint8)).tobytes()


def odd_limit(threshold: float, k: int, bits: int = SKETCH_BITS, sigmas: float = 6.5) -> int:
    """Most differing bits that two sets of at least ``threshold`` similarity show.

    Of k samples k (1 - J) differ (binomial); each flips two bits, so a share (1 - exp(-2m / bits)) / 2 of the bits
    differs for m flips.  Both deviations count ``sigmas`` times: a chance far below that of the bands.
    """
    p = 1 - threshold
    flips = 2 * k * p
    mean = bits / 2 * (1 - math.exp(-2 * flips / bits))
    dev = math.sqrt((2 * math.exp(-2 * flips / bits)) ** 2 * k * p * threshold + bits / 4 * (1 - math.exp(-4 * flips / bits)))
    return math.ceil(mean + sigmas * dev)


def similarity(differing: int, k: int, bits: int = SKETCH_BITS) -> float:
    """Jaccard similarity that so many differing bits estimate."""
    x = 1 - 2 * differing / bits
    return 1 + bits / (4 * k) * math.log(x) if x > 0 else 0.0


def bands_for(percent: int, rows: int = ROWS, miss: float = MISS) -> int:
    return math.ceil(math.log(miss) / math.log(1 - (percent / 100) ** rows))


def _as_long(x: bytes) -> int:
    return int.from_bytes(x[:8], "little", signed=True)


def signatures(docs: DataFrame, percent: int, width: int, min_samples: int = 128, row: str | None = None) -> DataFrame:
    """Per row of ``docs``: ``row, doc_id, text_key, n_shingles, node`` (a hash of the whole set), ``bands`` and ``sketch``."""
    small_batches(docs.sparkSession)
    n_bands = bands_for(percent)
    k = max(min_samples, n_bands * ROWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for b in batches:
            out = []
            for row, doc, key, text in zip(*(c.to_pylist() for c in b.columns)):
                s = shingles(text, width)
                if not len(s):
                    out.append((row, doc, key, 0, None, None, None))
                    continue
                m = min_hashes(s, k)
                bands = [_as_long(xxhash.xxh3_64_digest(m[ROWS * i:ROWS * i + ROWS].tobytes(), i)) for i in range(n_bands)]
                out.append((row, doc, key, len(s), _as_long(xxhash.xxh3_128_digest(s.tobytes())), bands, odd_sketch(m)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary()))],
                                                 ["row", "doc_id", "text_key", "n_shingles", "node", "bands", "sketch"])

    d = docs.select((F.col(row) if row else F.monotonically_increasing_id()).alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"), _text_key(), F.col("text").cast("string").alias("text"))
    return d.mapInArrow(run, "row bigint, doc_id bigint, text_key bigint, n_shingles bigint, node bigint, bands array<bigint>, sketch binary")


def _text_key():
    return F.xxhash64(F.col("text").cast("string")).alias("text_key")


def may_match(rows: DataFrame, key: str, keys: DataFrame, n: int, most: int = 1 << 26) -> DataFrame:
    """``rows`` without most of those whose long ``key`` is not among the ``n`` longs of ``keys`` (one column, no nulls); none that matches is lost.

    The keys set bits of a bitmap, 32 a key and ``most`` at most (8 MB), so that the rows of a join's larger side that find nothing
    need not be shuffled.  With many more keys the bitmap fills up and lets more rows pass.
    """
    bits = min(most, 1 << max(15, (32 * n).bit_length()))
    slot = lambda c: F.pmod(c, F.lit(bits)) + 1
    marked = keys.select(slot(F.col(keys.columns[0])).alias("_slot")).withColumn("_page", F.bitmap_bucket_number("_slot")).repartition("_page")
    marks = written(marked.groupBy("_page").agg(F.bitmap_construct_agg(F.bitmap_bit_position("_slot")).alias("_bits")), rows=n, per=1 << 17)
    at = F.bitmap_bit_position(slot(F.col(key)))
    byte = F.conv(F.hex(F.substring("_bits", (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    joined = rows.withColumn("_page", F.bitmap_bucket_number(slot(F.col(key)))).join(marks, "_page")
    return joined.where(F.getbit(byte, (at % 8).cast("int")) == 1).select(*rows.columns)


def near_duplicates(docs: DataFrame, *, percent: int = 80, width: int = 5, block: int = BLOCK, row: str | None = None) -> DataFrame:
    """One row per document: ``row, doc_id, n_shingles, component_id, kept, first``.

    Documents are linked where 100 * shared >= percent * union over their distinct shingles; ``component_id`` is the least
    ``doc_id`` reachable, itself included, ``kept`` whether that is its own, and ``first`` is true for exactly one row of each
    component, also where ids repeat or are null.  ``row`` numbers the input rows, by the column ``row`` if one is named.

    1. Rows of one shingle set are one node, so copies cost nothing more.
    2. Nodes that agree in a band meet; inside each band bucket the odd sketches' XOR counts decide who may be linked.
       Only a spanning forest of that leaves the bucket; its components are the families.
    3. Families get their full sets, and exact similarity decides; again only a forest leaves.
    Null and empty texts have no shingles: each is its own component.  An empty table gives no rows.  The result is a written
    table; all intermediate ones are deleted.
    """
    with scratch_tables(docs.sparkSession):
        found, n = _near_duplicates(docs, percent, width, block, row)
        return written(found, keep=True, rows=n)


def _near_duplicates(docs: DataFrame, percent: int, width: int, block: int, row: str | None) -> tuple[DataFrame, int]:
    limit = odd_limit(percent / 100, max(128, bands_for(percent) * ROWS))
    sig = written(signatures(docs, percent, width, row=row))
    n = sig.count()
    nodes = sig.where("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("least"), F.min(F.struct("doc_id", "text_key")).alias("one"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))
    nodes = written(nodes, rows=n)
    banded = written(nodes.select("node", F.explode("bands").alias("group")), rows=n)
    # Close families meet in many bands: of the buckets with the same members one is sifted.
    buckets = banded.groupBy("group").agg(F.count(F.lit(1)).alias("c"), F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y"),
                                          F.min("node").alias("lo"), F.max("node").alias("hi")).where("c > 1")
    shared = written(buckets.groupBy("c", "x", "y", "lo", "hi").agg(F.min("group").alias("group")).select("group", "c"), rows=n)
    met = shared.agg(F.sum("c")).first()[0] or 0

    def sift(pdf: pd.DataFrame):
        bits = np.frombuffer(b"".join(pdf["sketch"]), np.uint64).reshape(len(pdf), -1)
        return lambda i, others: np.bitwise_count(bits[others] ^ bits[i]).sum(1) <= limit

    # Sketches join the members of the kept buckets only, they do not go through the band's shuffle.
    members = written(banded.join(shared.select("group"), "group"), rows=met, per=1 << 15).join(nodes.select("node", "sketch"), "node")
    family = written(components(link_groups(members, sift, block=block, total=met), met), rows=n)

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for group, node, text in zip(*(c.to_pylist() for c in b.columns)):
                s = shingles(text, width)
                if _as_long(xxhash.xxh3_128_digest(s.tobytes())) == node:
                    out.append((group, node, s.tobytes()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.binary()))], ["group", "node", "shingles"])

    # One document per node brings its set; id and text hash name it, so rows with equal or no ids do not all meet.
    wanted = written(family.join(nodes.select("node", "one"), "node").select(F.col("root").alias("group"), "node", F.col("one.doc_id").alias("_id"), F.col("one.text_key").alias("_key")), rows=n)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("_doc"), _text_key(), F.col("text").cast("string").alias("text"))
    texts = may_match(texts, "text_key", wanted.select("_key"), wanted.count())
    full = texts.join(wanted, (F.col("text_key") == F.col("_key")) & F.col("_doc").eqNullSafe(F.col("_id"))).select("group", "node", "text")
    full = written(full.mapInArrow(sets, "group bigint, node bigint, shingles binary").dropDuplicates(["node"]), rows=n, per=1 << 10)
    held = full.count()

    def decide(pdf: pd.DataFrame):
        raw = [np.frombuffer(x, np.uint64) for x in pdf["shingles"]]
        sizes = np.array([len(x) for x in raw])
        _, flat = np.unique(np.concatenate(raw), return_inverse=True)
        ends = np.concatenate([[0], np.cumsum(sizes)])
        mark = np.zeros(flat.max() + 1, np.int64)

        def linked(i: int, others: np.ndarray) -> np.ndarray:
            small, large = np.minimum(sizes[others], sizes[i]), np.maximum(sizes[others], sizes[i])
            near = np.flatnonzero(100 * small >= percent * large)
            out = np.zeros(len(others), bool)
            mine = flat[ends[i]:ends[i + 1]]
            mark[mine] = 1
            for j in near:
                o = others[j]
                both = int(mark[flat[ends[o]:ends[o + 1]]].sum())
                out[j] = 100 * both >= percent * (sizes[i] + sizes[o] - both)
            mark[mine] = 0
            return out

        return linked

    found = components(link_groups(full, decide, block=block, weight="octet_length(shingles) / 8", total=held), held)
    classes = written(nodes.select("node", "least").join(found, "node", "left").select("node", "least", F.coalesce("root", "node").alias("root")), rows=n)
    best = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    named = classes.join(best, "root").select("node", "component_id", "root")
    d = sig.select("row", "doc_id", "n_shingles", "node").join(named, "node", "left")
    firsts = d.where("root IS NOT NULL").groupBy("root").agg(F.min(F.struct(F.coalesce(F.col("doc_id") != F.col("component_id"), F.lit(True)).alias("o"), "row")).alias("_f")).select("root", F.col("_f.row").alias("_first"))
    own = F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    rows = d.join(firsts, "root", "left").select("row", "doc_id", "n_shingles", own.alias("component_id"), F.col("doc_id").eqNullSafe(own).alias("kept"),
                                                F.coalesce(F.col("row") == F.col("_first"), F.lit(True)).alias("first"))
    return rows, n


def drop_near_duplicates(docs: DataFrame, **how) -> DataFrame:
    """The documents of which ``near_duplicates`` says ``first``: one of each component, with all columns of ``docs``."""
    base = written(boxed(docs, "doc_id", "text").withColumn("row", F.monotonically_increasing_id()).drop("doc_id", "text"))
    found = near_duplicates(base.select("row", "_doc.doc_id", "_doc.text"), row="row", **how)
    # The rows that go are fewer than those that stay; written, their table's size tells whether documents must move.
    gone = written(found.where("NOT first").select("row"), rows=found.count(), per=1 << 17)
    return base.join(gone, "row", "left_anti").select("_doc.*")
