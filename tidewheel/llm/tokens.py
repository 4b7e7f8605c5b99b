"""Token ids of whole documents, cut into pieces of bounded length."""

from __future__ import annotations

import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.base import hold, release, small_batches, written

PIECES = "row bigint, doc_id bigint, piece int, start bigint, length bigint, ids binary"
#: Words whose ids a worker remembers; beyond that it starts afresh.
CACHE_WORDS = 1_000_000


class Encoder:
    """Ids of texts as little-endian uint32 bytes.

    The vocabulary drops white space and never looks across it, so the ids of a text are those of its
    white-space separated chunks in order: chunks seen before come from a dictionary, new ones go through the
    tokenizer together.  ``by_chunk=False`` encodes whole texts, for vocabularies where white space counts.
    """

    def __init__(self, path: str, by_chunk: bool = True, limit: int = CACHE_WORDS):
        from tokenizers import Tokenizer

        self.tok, self.by_chunk, self.limit, self.known = Tokenizer.from_file(path), by_chunk, limit, {}
        size = self.tok.get_vocab_size(with_added_tokens=True)
        self.ends = np.array([(self.tok.id_to_token(i) or "").endswith("</w>") for i in range(size)])

    def _each(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, chunks: list[bytes]) -> None:
        """Chunks of letters alone are one pre-token each: they go as one text and part at the word ends."""
        plain, other = [], []
        for c in chunks:
            (plain if c.decode().isalpha() else other).append(c)
        for i in range(0, len(plain), 4096):
            part = plain[i:i + 4096]
            ids = np.array(self.tok.encode_batch_fast([b" ".join(part).decode()], add_special_tokens=False)[0].ids, "<u4")
            cuts = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
            if len(cuts) == len(part):
                raw = ids.tobytes()
                self.known.update(zip(part, map(raw.__getitem__, map(slice, [0, *cuts], cuts))))
            else:
                other += part
        self.known.update(zip(other, self._each([c.decode() for c in other])))

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.by_chunk:
            return self._each(texts)
        split, known = [], self.known
        for t in texts:
            raw = t.encode()
            # The special tokens' own spelling is matched before letters are lowered.
            split.append((raw if b"<|" in raw else raw.lower()).split())
        new = set().union(*split).difference(known)
        if new:
            tails = [c for c in new if len(c) > 1 and c[-1] in b".,;:!?" and c[-2:-1].isalnum()]
            stems = (new.difference(tails) | {c[:-1] for c in tails} | {c[-1:] for c in tails}).difference(known)
            self._learn(sorted(stems))
            known.update((c, known[c[:-1]] + known[c[-1:]]) for c in tails)
        out = [b"".join(map(known.__getitem__, s)) for s in split]
        if len(known) > self.limit:
            known.clear()
        return out


@lru_cache(maxsize=4)
def narrow_ids(path: str) -> bool:
    """Whether every id of the vocabulary fits in two bytes."""
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True) <= 1 << 16


@lru_cache(maxsize=2)
def _encoder(path: str, by_chunk: bool) -> Encoder:
    return Encoder(path, by_chunk)


def encoder(path: str, by_chunk: bool) -> Encoder:
    """One per worker process: later tasks of the worker find the words it has learnt, until another operator's task frees them."""
    release("tokens")
    hold("tokens", _encoder.cache_clear)
    return _encoder(path, by_chunk)


def cut_pieces(docs: DataFrame, path: str, size: int, *, by_chunk: bool = True, end_id: int = 0, narrow: bool = False) -> DataFrame:
    """One row per piece: ids of the document, then ``end_id``, cut every ``size`` ids.

    ``ids`` are little-endian, of four bytes each, or of two with ``narrow`` (only where ``narrow_ids``).

    The result is a written table: ``row`` numbers the input rows, so repeated documents stay apart.
    Null texts count as empty (only ``end_id``); columns other than ``doc_id`` and ``text`` are not used.
    """
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end = encoder(path, by_chunk), struct.pack("<I", end_id)
        for b in batches:
            rows, ids, texts = (c.to_pylist() for c in b.columns)
            for lo in range(0, len(rows), 200):
                out = []
                for r, d, raw in zip(rows[lo:lo + 200], ids[lo:lo + 200], enc.encode([t or "" for t in texts[lo:lo + 200]])):
                    raw += end
                    for k in range(0, len(raw), 4 * size):
                        part = raw[k:k + 4 * size]
                        moved = np.frombuffer(part, "<u4").astype("<u2").tobytes() if narrow else part
                        out.append((r, d, k // (4 * size), k // 4, len(part) // 4, moved))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()))],
                    ["row", "doc_id", "piece", "start", "length", "ids"])

    d = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return written(d.mapInArrow(run, PIECES))


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
