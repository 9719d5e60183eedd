"""Exact top-k inner product search over a pivot-distance index."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siteledger.llm.common import saved
from siteledger.llm.vectors import finite, kmeans, sample_matrix

#: Pivots, vectors of the sample they are fitted on, vectors to a block of the index, queries scored together.
PIVOTS, SAMPLE, BLOCK, QUERIES = 64, 8_192, 2_048, 4_096
_INDEX = "vec_id bigint, ivec binary, pivot int, dist double"
_HITS = "query_id bigint, vec_id bigint, score bigint"


def quantized(vectors: DataFrame, scale: float = 256.0) -> DataFrame:
    """(vec_id, ivec): floor(scale * x) of every component x as double, as an array of longs.

    Rows with a null id, a null vector, or a null or non-finite component are left out; shorter
    vectors read as if zeros followed.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("e")).where("vec_id IS NOT NULL").where(finite("e"))
    return rows.select("vec_id", F.transform("e", lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long")).alias("ivec"))


def _matrix(column, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype="<i8").reshape(-1, width)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products; by the faster arithmetic of doubles where they hold every partial sum exactly."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), dtype=np.int64)
    if float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] < 2.0**52:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    return a @ b.T


def exact_top_k(items: DataFrame, queries: DataFrame, k: int = 5, pivots: int = PIVOTS, block: int = BLOCK) -> DataFrame:
    """The k highest inner products of each query: (query_id, rank, vec_id, score), ties to the smaller id.

    ``items`` and ``queries`` are (vec_id, ivec array<long>); a query's own id is no candidate.

    Adding one component, sqrt(M - |x|^2) with M the largest squared norm, to every item and a 0
    to every query turns the largest product into the smallest distance. Items are keyed by their
    nearest pivot and the distance to it, and sorted by that key and the id into blocks: annuli of
    about ``block`` vectors, however many are at one distance. A query first scores the annulus around its own distance at its nearest
    pivot. The k-th score found bounds how far an item may be, and by the triangle inequality only
    annuli within that reach are opened, and in them only the sorted run within reach. Every test
    leaves room for rounding, and ties are kept, so the result is exact whatever the sample that
    the pivots were fitted on.

    Of equal vectors the k + 1 smallest ids suffice, so a vector that a third of the rows share is
    k + 1 rows in the index. A block is opened once for each ``QUERIES`` of its visitors, so no
    task holds more than a block and that many queries. Fewer than k candidates give fewer rows;
    empty tables, none. Repeated (id, vector) rows count once.
    """
    copies = Window.partitionBy("ivec").orderBy("vec_id")
    slim = saved(items.distinct().withColumn("n", F.row_number().over(copies)).where(F.col("n") <= k + 1).drop("n"), "items")
    asked = saved(queries.distinct(), "queries")
    norm = F.aggregate("ivec", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    width, top, count = slim.agg(F.max(F.size("ivec")), F.max(norm), F.count("*")).first()
    wide = max(width or 0, asked.agg(F.max(F.size("ivec"))).first()[0] or 0, 1)
    if not count:
        return slim.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    centres = kmeans(_augment(sample_matrix(slim, "ivec", wide, SAMPLE), top), min(pivots, max(1, count // 256)))
    n_pivots = len(centres)

    def dense(batch: pa.RecordBatch) -> np.ndarray:
        out = np.zeros((batch.num_rows, wide), dtype=np.int64)
        for i, v in enumerate(batch.column("ivec").to_pylist()):
            out[i, : len(v)] = v
        return out

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = dense(batch)
            far = _distances(_augment(x, top), centres)
            near = far.argmin(axis=1)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array([v.tobytes() for v in x], pa.binary()), pa.array(near, pa.int32()), pa.array(far[np.arange(len(x)), near])], ["vec_id", "ivec", "pivot", "dist"])

    ordered = slim.mapInArrow(keyed, _INDEX).repartitionByRange(max(1, -(-count // block)), "pivot", "dist", "vec_id").sortWithinPartitions("pivot", "dist")
    index = saved(ordered.withColumn("block", F.spark_partition_id()), "index")
    annuli = saved(index.groupBy("block", "pivot").agg(F.min("dist").alias("low"), F.max("dist").alias("high")), "annuli")
    chunks = max(1, -(-asked.count() // QUERIES))

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each query and pivot, with the query's distance to it."""
        for batch in batches:
            x = dense(batch)
            far = _distances(np.hstack([x, np.zeros((len(x), 1))]), centres)
            ids, vectors = np.repeat(np.asarray(batch.column("vec_id")), n_pivots), [v.tobytes() for v in x for _ in range(n_pivots)]
            square = np.repeat((x.astype(float) ** 2).sum(axis=1), n_pivots)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(vectors, pa.binary()), pa.array(square), pa.array(np.tile(np.arange(n_pivots), len(x)), pa.int32()), pa.array(far.ravel()), pa.array((far == far.min(axis=1, keepdims=True)).ravel())], ["query_id", "qvec", "square", "pivot", "qdist", "nearest"])

    visits = saved(asked.mapInArrow(reach, "query_id bigint, qvec binary, square double, pivot int, qdist double, nearest boolean"), "reach")

    def opened(routed: DataFrame) -> DataFrame:
        """Scores of the routed (block, pivot, query) visits: each visit's best k."""
        if chunks == 1:
            left, right = index.withColumn("chunk", F.lit(0)), routed.withColumn("chunk", F.lit(0))
        else:
            left = index.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
            right = routed.withColumn("chunk", F.pmod(F.xxhash64("query_id"), F.lit(chunks)).cast("int"))

        def score(held: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
            empty = pd.DataFrame({"query_id": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"), "score": pd.Series(dtype="int64")})
            if not len(held) or not len(asking):
                return empty
            held, out = held.sort_values("dist", kind="stable"), []
            x, ids, dist = _matrix(held["ivec"], wide), held["vec_id"].to_numpy(), held["dist"].to_numpy()
            for at in range(0, len(asking), 256):
                part = asking.iloc[at : at + 256]
                least, most = part["qdist"].to_numpy() - part["radius"].to_numpy(), part["qdist"].to_numpy() + part["radius"].to_numpy()
                a, b = int(np.searchsorted(dist, least.min(), "left")), int(np.searchsorted(dist, most.max(), "right"))
                if a >= b:
                    continue
                found, asker = _products(_matrix(part["qvec"], wide), x[a:b]), part["query_id"].to_numpy()
                allowed = (dist[a:b] >= least[:, None]) & (dist[a:b] <= most[:, None]) & (ids[a:b] != asker[:, None]) & (found >= part["bound"].to_numpy()[:, None])
                lowest = np.where(allowed, found, np.iinfo(np.int64).min)
                if b - a > k:
                    allowed &= found >= np.partition(lowest, b - a - k, axis=1)[:, b - a - k][:, None]
                q, v = np.nonzero(allowed)
                hits = pd.DataFrame({"query_id": asker[q], "vec_id": ids[a:b][v], "score": found[q, v]}).sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True])
                out.append(hits.groupby("query_id").head(k))
            return pd.concat(out) if out else empty

        keys = ["block", "pivot", "chunk"]
        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(score, _HITS)

    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    everywhere, none = F.lit(float("inf")), F.lit(-(1 << 63)).cast("long")
    off = F.greatest(F.col("low") - F.col("qdist"), F.col("qdist") - F.col("high"), F.lit(0.0))
    home = Window.partitionBy("query_id").orderBy("off", "block")
    first = visits.where("nearest").join(annuli, "pivot").withColumn("off", off).withColumn("n", F.row_number().over(home)).where("n = 1")
    first = saved(first.select("block", "pivot", "query_id", "qvec", "square", "qdist"), "first")
    start = saved(opened(first.withColumns({"radius": everywhere, "bound": none})), "start")
    bounds = start.withColumn("n", F.row_number().over(best)).where(F.col("n") == k).select("query_id", F.col("score").alias("bound"))
    # a score of at least the bound means a distance of at most the radius; the slack is far above what rounding can do
    radius = F.sqrt(F.greatest(F.col("square") + top - 2 * F.col("bound").cast("double"), F.lit(0.0))) * (1 + 1e-9) + 1e-6 * (1 + F.sqrt(F.lit(top)))
    aimed = visits.join(bounds, "query_id", "left").withColumn("radius", F.coalesce(radius, everywhere)).withColumn("bound", F.coalesce("bound", none))
    rest = aimed.join(annuli, "pivot").where("low <= qdist + radius AND high >= qdist - radius")
    rest = rest.join(first.select("query_id", "block", "pivot"), ["query_id", "block", "pivot"], "left_anti")
    hits = start.unionByName(opened(rest.select("block", "pivot", "query_id", "qvec", "qdist", "radius", "bound")))
    ranked = hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _augment(x: np.ndarray, top: float) -> np.ndarray:
    x = np.asarray(x, dtype=float)
    return np.hstack([x, np.sqrt(np.maximum(top - (x * x).sum(axis=1, keepdims=True), 0.0))])


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    x = np.asarray(x, dtype=float)
    return np.sqrt(np.maximum((x * x).sum(axis=1)[:, None] + (centres * centres).sum(axis=1) - 2 * x @ centres.T, 0.0))
