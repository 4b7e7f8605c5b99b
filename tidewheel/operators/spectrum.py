"""Periodogram of series of any length: a Fourier transform in two shuffles of about square-root size pieces."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.core import join_params

#: Values that one group of a pass holds.
CELLS = 1 << 18


def spectral_entropy(df: DataFrame, y: str = "y", *, cells: int = CELLS) -> DataFrame:
    """``id, entropy, n_freq``: Shannon entropy of the normalised periodogram over its ``n_freq`` frequencies, scaled to 0 .. 1.

    With m = ceil(sqrt(n)), a series of n cells is centred, padded with zeros to m * m cells and laid out in m rows; the
    frequencies are j / m**2 for j = 1 .. m**2 // 2, at least the n // 2 Fourier frequencies' resolution.  Columns are transformed
    first, turned by their phase, then rows: a task holds ``cells`` values whatever the length.  NULLs count as the mean; a
    constant series has a NULL entropy.  Rows must be one per grid cell ``k``.
    """
    key = df.schema["id"].dataType.simpleString()
    facts = df.groupBy("id").agg(F.min("k").alias("_k0"), F.ceil(F.sqrt((F.max("k") - F.min("k") + 1).cast("double"))).cast("bigint").alias("_m"), F.avg(y).alias("_mean"))
    t = F.col("k") - F.col("_k0")
    wide = F.greatest(F.floor(F.lit(cells) / F.col("_m")), F.lit(1)).cast("bigint")
    d = join_params(df.select("id", "k", F.col(y).cast("double").alias("v")), facts, ["id"]).select(
        "id", "_m", F.floor(t / F.col("_m")).alias("row"), (t % F.col("_m")).alias("col"), F.coalesce(F.col("v") - F.col("_mean"), F.lit(0.0)).alias("v"))
    d = d.withColumn("_block", F.floor(F.col("col") / wide))

    def columns(pdf: pd.DataFrame) -> pd.DataFrame:
        m, id_ = int(pdf["_m"].iloc[0]), pdf["id"].iloc[0]
        step = max(1, cells // m)
        first = int(pdf["_block"].iloc[0]) * step
        cols = np.arange(first, min(first + step, m))
        x = np.zeros((m, len(cols)))
        x[pdf["row"].to_numpy(), pdf["col"].to_numpy() - first] = pdf["v"].to_numpy()
        a = np.fft.fft(x, axis=0) * np.exp(-2j * np.pi * (np.arange(m)[:, None] * cols % (m * m)) / (m * m))
        return pd.DataFrame([(id_, m, lo // step, first, part.real.ravel(), part.imag.ravel()) for lo in range(0, m, step) for part in [a[lo:lo + step]]],
                            columns=["id", "_m", "_rows", "first", "re", "im"])

    blocks = d.groupBy("id", "_block").applyInPandas(columns, f"id {key}, _m bigint, _rows bigint, first bigint, re array<double>, im array<double>")

    def rows(pdf: pd.DataFrame) -> pd.DataFrame:
        m, id_ = int(pdf["_m"].iloc[0]), pdf["id"].iloc[0]
        step = max(1, cells // m)
        low = int(pdf["_rows"].iloc[0]) * step
        height = min(step, m - low)
        a = np.zeros((height, m), complex)
        for first, re, im in zip(pdf["first"], pdf["re"], pdf["im"]):
            part = (np.asarray(re) + 1j * np.asarray(im)).reshape(height, -1)
            a[:, first:first + part.shape[1]] = part
        power = np.abs(np.fft.fft(a, axis=1)) ** 2
        freq = low + np.arange(height)[:, None] + m * np.arange(m)
        p = power[(freq > 0) & (freq <= m * m // 2)]
        some = p[p > 0]
        return pd.DataFrame([(id_, float(p.sum()), float(some @ np.log(some)), len(p))], columns=["id", "s", "plogp", "n"])

    sums = blocks.groupBy("id", "_rows").applyInPandas(rows, f"id {key}, s double, plogp double, n bigint")
    total = sums.groupBy("id").agg(F.sum("s").alias("_s"), F.sum("plogp").alias("_p"), F.sum("n").alias("n_freq"))
    entropy = F.when(F.col("_s") > 1e-20, (F.log("_s") - F.col("_p") / F.col("_s")) / F.log(F.col("n_freq").cast("double")))
    return total.select("id", F.when(F.col("n_freq") > 1, entropy).alias("entropy"), "n_freq")
