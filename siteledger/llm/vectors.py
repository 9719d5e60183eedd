"""Help for tables of vectors: validity, bounded samples, centroids."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite(column: str) -> Column:
    """Whether a vector is there and holds neither null nor non-finite components."""
    c = F.col(column)
    fine = F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return c.isNotNull() & F.coalesce(fine, F.lit(False))


def sample_matrix(df: DataFrame, column: str, width: int, most: int) -> np.ndarray:
    """At most ``most`` of the vectors, the same ones every time: those with the smallest hashes."""
    rows = df.select(column).orderBy(F.xxhash64(column), F.col(column)).limit(most).collect()
    out = np.zeros((len(rows), width))
    for i, (v,) in enumerate(rows):
        out[i, : len(v)] = v
    return out


def kmeans(x: np.ndarray, k: int, rounds: int = 8, seed: int = 5) -> np.ndarray:
    """Centroids of a sample: k-means from distinct random rows."""
    rng = np.random.default_rng(seed)
    distinct = np.unique(x, axis=0)
    centres = distinct[rng.permutation(len(distinct))[: max(1, k)]].astype(float)
    for _ in range(rounds):
        near = ((centres * centres).sum(axis=1) - 2 * x @ centres.T).argmin(axis=1)
        for c in np.unique(near):
            centres[c] = x[near == c].mean(axis=0)
    return centres
