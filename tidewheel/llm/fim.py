"""Fill-in-the-middle: cuts are scanned, sentinels inserted, segments exchanged by rotating one buffer in place.

A rotation is three reversals; restoring runs the same rotation the other way, so the text comes back exactly.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructType

from tidewheel.llm.base import boxed, small_batches

# The sentinels of prefix, suffix and middle.
P, S, M = b"<P>", b"<S>", b"<M>"
#: Bytes looked at, or swapped, at a time.
BLOCK = 1 << 20


def _begins(raw: bytes, lo: int, hi: int) -> np.ndarray:
    """Offsets in ``raw[lo:hi]`` where a token begins: a run of ASCII letters, or any other code point by itself."""
    a = np.frombuffer(raw, np.uint8, hi - max(lo - 1, 0), max(lo - 1, 0))
    letter = ((a | np.uint8(32)) - np.uint8(97)) < 26
    begin = (a & np.uint8(0xC0)) != 0x80
    begin[1:] &= ~(letter[1:] & letter[:-1])
    return np.flatnonzero(begin[1:] if lo else begin) + lo


def scan(raw: bytes, block: int = BLOCK) -> list[int]:
    """Token counts of the blocks of ``raw``."""
    return [len(_begins(raw, lo, min(lo + block, len(raw)))) for lo in range(0, len(raw), block)]


def byte_of(raw: bytes, counts: list[int], tokens: int, block: int = BLOCK) -> int:
    """Where the token number ``tokens`` (from 0) begins; the end of ``raw`` beyond the last one."""
    for i, n in enumerate(counts):
        if tokens < n:
            return int(_begins(raw, i * block, min((i + 1) * block, len(raw)))[tokens])
        tokens -= n
    return len(raw)


def reverse(buf: bytearray, a: int, b: int) -> None:
    """Reverse ``buf[a:b]`` in place."""
    while b - a > 1:
        n = min(BLOCK, (b - a) // 2)
        head = buf[a:a + n]
        buf[a:a + n] = buf[b - n:b][::-1]
        buf[b - n:b] = head[::-1]
        a, b = a + n, b - n


def rotate(buf: bytearray, a: int, m: int, b: int) -> None:
    """Exchange the neighbours ``buf[a:m]`` and ``buf[m:b]`` in place."""
    reverse(buf, a, m)
    reverse(buf, m, b)
    reverse(buf, a, b)


def arrange(raw: bytes, first: int, second: int, form: str) -> bytearray:
    """``raw`` cut at two offsets, in the order of ``form`` (``psm`` or ``spm``)."""
    buf = bytearray(raw)
    buf[second:second] = S
    buf[first:first] = M
    buf[0:0] = P
    rotate(buf, len(P) + first if form == "psm" else 0, len(P) + second + len(M), len(buf))
    return buf


def undo(out: bytes, form: str | None) -> bytearray:
    """The text that ``arrange`` was given; ``plain`` and null forms are the text itself."""
    buf = bytearray(out)
    if form in ("psm", "spm"):
        a, m = (buf.index(S), buf.index(M)) if form == "psm" else (0, buf.index(P))
        rotate(buf, a, m, len(buf))
        for mark in (S, M, P):
            at = buf.index(mark)
            del buf[at:at + len(mark)]
    return buf


def _points(raw: bytes, a: int, b: int) -> int:
    return sum(int(np.count_nonzero((np.frombuffer(raw, np.uint8, min(lo + BLOCK, b) - lo, lo) & 0xC0) != 0x80)) for lo in range(a, b, BLOCK))


def transform(text: bytes, key: str, plain: int, spm: int, salt: str) -> tuple[int, str, int | None, int | None, bytes]:
    """``n, form, prefix_chars, middle_chars, output`` of one text."""
    counts = scan(text)
    n = sum(counts)
    digest = hashlib.sha256(f"{salt}:{key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i:8 * i + 8], 16) for i in range(4))
    if not text or h3 % 100 >= 100 - plain or any(mark in text for mark in (P, S, M)):
        return n, "plain", None, None, text
    first, second = (byte_of(text, counts, c) for c in sorted((h1 % (n + 1), h2 % (n + 1))))
    form = "spm" if h4 % 100 < spm else "psm"
    return n, form, _points(text, 0, first), _points(text, first, second), bytes(arrange(text, first, second, form))


def fill_in_middle(docs: DataFrame, *, plain: int = 10, spm: int = 20, salt: str = "1") -> DataFrame:
    """``doc`` (the input row) beside ``n, form, prefix_chars, middle_chars, output``.

    A text is cut at two token borders that the hash of ``salt`` and ``doc_id`` names; ``plain`` percent of the texts
    stay whole, ``spm`` percent of the others put the suffix first.  Texts that are null (as empty), empty or contain a
    sentinel are plain, with null segment lengths.  A null ``doc_id`` is hashed as no characters.  Repeated rows give equal results; an
    empty table gives no rows; the row is boxed, so its columns cannot clash with the added ones.  Rows never move between tasks.
    """
    small_batches(docs.sparkSession)
    d = boxed(docs).select("_doc", F.coalesce(F.col("_doc.doc_id").cast("string"), F.lit("")).alias("key"), F.coalesce(F.col("_doc.text").cast("binary"), F.lit(b"")).alias("text"))
    kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [transform(t, k, plain, spm, salt) for k, t in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
            if out:
                yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, t) for c, t in zip(zip(*out), kinds)]], ["doc", "n", "form", "prefix_chars", "middle_chars", "output"])

    shape = (StructType().add("doc", d.schema["_doc"].dataType).add("n", LongType()).add("form", StringType()).add("prefix_chars", LongType())
             .add("middle_chars", LongType()).add("output", BinaryType()))
    return d.mapInArrow(run, shape).withColumn("output", F.col("output").cast("string"))


def restore(made: DataFrame, out: str = "restored") -> DataFrame:
    """``made`` (with ``form`` and ``output``) and the exact text ``out`` that each output was made from; null outputs stay null."""
    small_batches(made.sparkSession)
    d = boxed(made, "form").withColumn("output", F.col("_doc.output").cast("binary"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [None if o is None else bytes(undo(o, f)) for f, o in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.binary())], ["_doc", "_text"])

    back = d.mapInArrow(run, StructType().add("_doc", d.schema["_doc"].dataType).add("_text", BinaryType()))
    return back.select(*[F.col(f"_doc.`{c}`") for c in made.columns if c != out], F.col("_text").cast("string").alias(out))


#: DuckDB form of the registered query over ``documents``.
SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS x FROM documents),
h AS (SELECT *, len(u) AS n, ('0x' || x[1:8])::BIGINT AS h1, ('0x' || x[9:16])::BIGINT AS h2, ('0x' || x[17:24])::BIGINT AS h3, ('0x' || x[25:32])::BIGINT AS h4 FROM d),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
        CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT *, array_to_string(u[1:a], '') AS pre, array_to_string(u[a + 1:b], '') AS mid, array_to_string(u[b + 1:], '') AS suf FROM c)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(pre)::BIGINT END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid)::BIGINT END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""
