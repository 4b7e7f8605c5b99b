"""Toxicity by a factorization machine over hashed terms.

score = sigmoid(w0 + sum w_i + sum_{i<j} <v_i, v_j>) over the terms present: a weight per term and, through the
factors, one per pair of terms, so that two harmless terms may be toxic together.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.base import hold, release, small_batches, unit_hash, written

SPACE = 1 << 22
TOKEN = re.compile(rb"[a-z\x80-\xff]+")
#: Labelled documents the model is fitted on at most, the lowest by hash of their id.
SAMPLE = 20_000
#: Commonest terms whose pairs are tried as well, so that terms which matter only together are not sifted out.
PAIRED = 256


@lru_cache(maxsize=200_000)
def _slots(word: bytes) -> tuple[int, ...]:
    """Hash slots of a word: itself and, as stems, its first five and first four bytes."""
    h = xxhash.xxh3_64_intdigest
    return h(word) % SPACE, h(word[:5], 7) % SPACE, h(word[:4], 11) % SPACE


def terms(text: str | None) -> set[int]:
    """Distinct hashed terms of the whole text: runs of letters, lower-cased."""
    return {s for w in set(TOKEN.findall((text or "").lower().encode())) for s in _slots(w)}


class Machine:
    """A fitted model: ``slots`` (sorted) with their weights and factors."""

    def __init__(self, slots: np.ndarray, w: np.ndarray, v: np.ndarray, w0: float):
        self.slots, self.w, self.v, self.w0 = slots, w, v, w0
        self.place = dict(zip(slots.tolist(), range(len(slots))))

    def score(self, found: set[int]) -> float:
        i = sorted(self.place[s] for s in found if s in self.place)
        z = self.w0
        if i:
            v = self.v[i]
            z += self.w[i].sum() + 0.5 * float((v.sum(0) ** 2 - (v ** 2).sum(0)).sum())
        return float(1 / (1 + np.exp(-np.clip(z, -35, 35))))


def interacting(rows: np.ndarray, columns: np.ndarray, y: np.ndarray, k: int, least: float = 8.0, cell: int = 5) -> np.ndarray:
    """Which of ``k`` columns take part in a pair whose joint effect on the label is not the sum of the two.

    ``rows, columns`` are the ones of a 0/1 matrix.  With r the label's rate among documents that hold both, one or none of a pair,
    r11 - r10 - r01 + r00 must lie ``least`` standard errors from 0, each kind having ``cell`` documents at least.
    """
    n = len(y)
    both, hits = np.zeros((k, k)), np.zeros((k, k))
    order = np.argsort(rows, kind="stable")
    rows, columns = rows[order], columns[order]
    for lo in range(0, n, 2048):
        a, b = np.searchsorted(rows, [lo, lo + 2048])
        x = np.zeros((min(2048, n - lo), k), np.float32)
        x[rows[a:b] - lo, columns[a:b]] = 1
        both += x.T @ x
        hits += x.T @ (x * y[lo:lo + 2048, None].astype(np.float32))
    one, one_hits = np.diag(both).copy(), np.diag(hits).copy()
    counts = [both, one[:, None] - both, one[None] - both, n - one[:, None] - one[None] + both]
    labels = [hits, one_hits[:, None] - hits, one_hits[None] - hits, y.sum() - one_hits[:, None] - one_hits[None] + hits]
    rates = [(h + 0.5) / (c + 1) for h, c in zip(labels, counts)]
    error = sum(r * (1 - r) / (c + 1) for r, c in zip(rates, counts))
    z = np.abs(rates[0] - rates[1] - rates[2] + rates[3]) / np.sqrt(error + 1e-12)
    z[np.min(counts, axis=0) < cell] = 0
    np.fill_diagonal(z, 0)
    return (z >= least).any(1)


def fit(docs: list[np.ndarray], labels: np.ndarray, *, factors: int = 8, epochs: int = 30, rate: float = 0.1, l2: float = 1e-4, min_chi2: float = 15.0, seed: int = 5,
        paired: int = PAIRED) -> Machine:
    """Logistic loss, AdaGrad over mini-batches.  Terms enter whose presence depends on the label (chi squared), and of the ``paired``
    commonest ones those that do so in a pair."""
    y = labels.astype(np.float64)
    n, pos = len(y), y.sum()
    if not n or pos in (0, n) or not sum(map(len, docs)):
        p = (pos + 1) / (n + 2)
        return Machine(np.empty(0, np.int64), np.empty(0), np.empty((0, factors)), float(np.log(p / (1 - p))))
    all_slots, which = np.unique(np.concatenate(docs), return_inverse=True)
    sizes = np.array([len(d) for d in docs])
    total = np.bincount(which, minlength=len(all_slots))
    hits = np.bincount(which, np.repeat(y, sizes), len(all_slots))
    expected = total * pos / n
    var = expected * (1 - pos / n) * (1 - total / n) + 1e-9
    take = ((hits - expected) ** 2 / var >= min_chi2) & (total >= 3)
    common = np.sort(np.argsort(-total, kind="stable")[:paired])
    column = np.full(len(all_slots), -1)
    column[common] = np.arange(len(common))
    some = column[which] >= 0
    take[common[interacting(np.repeat(np.arange(n), sizes)[some], column[which][some], y, len(common))]] = True
    index = np.where(take, np.cumsum(take) - 1, -1)[which]
    keep = index >= 0
    row = np.repeat(np.arange(n), sizes)[keep]
    index, sizes = index[keep], np.bincount(row, minlength=n)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    slots, rng = all_slots[take], np.random.default_rng(seed)
    k = len(slots)
    w, v, w0 = np.zeros(k), rng.normal(0, 0.02, (k, factors)), float(np.log(pos / (n - pos)))
    gw, gv, g0 = np.full(k, 1e-3), np.full((k, factors), 1e-3), 1e-3
    for _ in range(epochs):
        order = rng.permutation(n)
        for lo in range(0, n, 256):
            part = order[lo:lo + 256]
            idx = np.concatenate([index[starts[r]:starts[r + 1]] for r in part]) if k else np.empty(0, np.int64)
            doc = np.repeat(np.arange(len(part)), sizes[part])
            vi = v[idx]
            sums = np.stack([np.bincount(doc, vi[:, f], len(part)) for f in range(factors)], 1)
            square = np.bincount(doc, (vi ** 2).sum(1), len(part))
            z = w0 + np.bincount(doc, w[idx], len(part)) + 0.5 * ((sums ** 2).sum(1) - square)
            err = 1 / (1 + np.exp(-np.clip(z, -35, 35))) - y[part]
            g = err.mean()
            g0 += g * g
            w0 -= rate * g / np.sqrt(g0)
            seen, at = np.unique(idx, return_inverse=True)
            if len(seen):
                e = err[doc] / len(part)
                dw = np.bincount(at, e, len(seen)) + l2 * w[seen]
                gw[seen] += dw ** 2
                w[seen] -= rate * dw / np.sqrt(gw[seen])
                dv = np.stack([np.bincount(at, e * (sums[doc, f] - vi[:, f]), len(seen)) for f in range(factors)], 1) + l2 * v[seen]
                gv[seen] += dv ** 2
                v[seen] -= rate * dv / np.sqrt(gv[seen])
    return Machine(slots, w, v, w0)


def held_out(doc_id: Column) -> Column:
    """Rows no model is fitted on: crc32 of the id as text, modulo 3, is 1 (false for null ids)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, *, sample: int = SAMPLE, min_chi2: float = 15.0, paired: int = PAIRED, **how) -> Machine:
    """A model from at most ``sample`` labelled documents outside the held-out third.

    Spark counts the terms of the sample; only those that depend on the label, and the ``paired`` commonest others, whose pairs may,
    reach the driver, where the fit runs.  Without labels, or with one kind only, the model has no terms.

    Repeated or contradicting labels of a document count as the larger one; null labels and ids are left out.
    """
    small_batches(docs.sparkSession)
    known = (labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
             .orderBy(unit_hash(F.col("doc_id"), seed=3), "doc_id").limit(sample))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release("toxicity")
        hold("toxicity", _slots.cache_clear)
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([sorted(terms(t)) for t in b.column(0).to_pylist()], pa.list_(pa.int64())), b.column(1), b.column(2)],
                                             ["terms", "toxic", "doc_id"])

    # Bounded by ``sample`` rows of two numbers.
    chosen = docs.select("text", "doc_id").join(F.broadcast(known), "doc_id").select("text", F.col("toxic").cast("int"), F.col("doc_id").cast("bigint"))
    found = written(chosen.mapInArrow(run, "terms array<bigint>, toxic int, doc_id bigint"))
    n, pos = found.agg(F.count("toxic"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    expected = F.col("n") * F.lit(pos / max(n, 1))
    var = expected * F.lit(1 - pos / max(n, 1)) * (1 - F.col("n") / F.lit(float(max(n, 1)))) + F.lit(1e-9)
    counts = written(found.select("toxic", F.explode("terms").alias("slot")).groupBy("slot").agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("hits")))
    alone = counts.where(((F.col("hits") - expected) ** 2 / var >= min_chi2) & (F.col("n") >= 3)).select("slot")
    common = counts.orderBy(F.desc("n"), "slot").limit(paired).select("slot")
    slots = set(alone.union(common).toArrow().column(0).to_pylist())

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.set_column(0, "terms", pa.array([[x for x in t if x in slots] for t in b.column(0).to_pylist()], pa.list_(pa.int64())))

    got = found.mapInArrow(sift, found.schema).toArrow().sort_by("doc_id")
    column = got.column("terms").combine_chunks()
    flat, ends = column.values.to_numpy(zero_copy_only=False).astype(np.int32), column.offsets.to_numpy()
    return fit([flat[a:b] for a, b in zip(ends[:-1], ends[1:])], got.column("toxic").to_numpy(), min_chi2=min_chi2, paired=paired, **how)


def score(docs: DataFrame, model: Machine, name: str = "score") -> DataFrame:
    """``docs`` with the score in [0, 1] of the whole text as column ``name``; null and empty texts get that of no terms.

    The model goes to the tasks with the code: it holds significant terms only, at most those of the training sample.
    """
    small_batches(docs.sparkSession)
    parts = (model.slots, model.w, model.v, model.w0)
    d = docs.drop(name)
    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in d.schema) + f", `{name}` double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release("toxicity")
        hold("toxicity", _slots.cache_clear)
        m = Machine(*parts)
        for b in batches:
            texts = b.column(b.schema.get_field_index("text")).to_pylist()
            got = pa.array([m.score(terms(t)) for t in texts], pa.float64())
            yield pa.RecordBatch.from_arrays([*b.columns, got], [*b.schema.names, name])

    return d.mapInArrow(run, out)
