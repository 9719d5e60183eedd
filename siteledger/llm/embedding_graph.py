"""Near duplicates among embeddings by search in robust-pruned flat graphs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siteledger.llm.common import components, saved
from siteledger.llm.vectors import finite, kmeans, sample_matrix

#: Vectors of the sample that centroids are fitted on, vectors to a shard on average, and the most centroids.
SAMPLE, SHARD, MOST_SHARDS = 16_384, 1_000, 4_096
#: Queries that a task searches for, and the vectors that the audit first draws and counts the links of by brute force.
QUERIES, AUDIT = 2_048, 256
#: Linked vectors that the audit must see, the most near ones that count as few, and the most vectors drawn at a time.
LINKED, FEW, MOST_DRAWN = 256, 64, 4_096
#: Bytes of vectors in a block of the exact comparison, and the fewest blocks.
BLOCK_BYTES, LEAST_BLOCKS = 32 << 20, 8
#: Graph degree, nearest and random candidates, and the slack of the pruning rule.
DEGREE, NEAR, RANDOM, ALPHA = 24, 48, 16, 1.2
#: How far below the threshold a node may be for the search to expand through it.
MARGIN = 0.05


def robust_prune(x: np.ndarray, rows: np.ndarray, candidates: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Neighbours of ``rows`` out of ``candidates`` (one line each): the nearest first, dropping those much nearer to one already taken.

    Returns a line of ``degree`` node numbers for each row, -1 where there are fewer.
    """
    vectors = x[candidates]
    own = 1.0 - np.einsum("rd,rcd->rc", x[rows], vectors)
    open_ = candidates != rows[:, None]
    out, lines = np.full((len(rows), degree), -1, dtype=np.int64), np.arange(len(rows))
    for slot in range(degree):
        if not open_.any():
            break
        pick = np.where(open_, own, np.inf).argmin(axis=1)
        live = open_[lines, pick]
        out[live, slot] = candidates[lines, pick][live]
        to_pick = 1.0 - np.einsum("rd,rcd->rc", vectors[lines, pick], vectors)
        open_ &= ~(alpha * to_pick < own) & (candidates != candidates[lines, pick][:, None])
    return out


def build_graph(x: np.ndarray, rows: np.ndarray, seed: int = 3) -> np.ndarray:
    """Robust-pruned neighbours of ``rows`` within ``x``, from near and random candidates."""
    rng, out, n = np.random.default_rng(seed), [], len(x)
    near = min(NEAR + 1, n)
    for at in range(0, len(rows), 256):
        part = rows[at : at + 256]
        close = np.argpartition(-(x[part] @ x.T), near - 1, axis=1)[:, :near]
        pool = np.hstack([close, rng.integers(0, n, (len(part), min(RANDOM, n)))])
        out.append(robust_prune(x, part, pool, DEGREE, ALPHA))
    return np.vstack(out) if out else np.empty((0, DEGREE), dtype=np.int64)


def range_search(x: np.ndarray, links: np.ndarray, starts: np.ndarray, queries: np.ndarray, threshold: float, margin: float = MARGIN) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (query, node) found with a cosine of at least ``threshold``, in batches of queries.

    Each query walks greedily from the best medoid in ``starts`` until no neighbour is nearer.
    From where it ends, and from its own node, the search expands through all nodes within
    ``margin`` of the threshold.
    """
    n, (ends, both) = len(x), _both_ways(links)
    for at in range(0, len(queries), 128):
        own = queries[at : at + 128]
        q, lines = x[own], np.arange(len(own))
        now = starts[(q @ x[starts].T).argmax(axis=1)]
        reached = np.einsum("qd,qd->q", q, x[now])
        while True:
            around = np.where(links[now] < 0, now[:, None], links[now])
            cosines = np.einsum("qd,qrd->qr", q, x[around])
            pick = cosines.argmax(axis=1)
            better = cosines[lines, pick] > reached + 1e-12
            if not better.any():
                break
            now, reached = np.where(better, around[lines, pick], now), np.where(better, cosines[lines, pick], reached)
        seen = np.zeros((len(own), n), dtype=bool)
        who, node = np.concatenate([lines, lines]), np.concatenate([now, own])
        found_q, found_n = [], []
        while len(who):
            code = np.unique(who * n + node)
            who, node = code // n, code % n
            fresh = ~seen[who, node]
            who, node = who[fresh], node[fresh]
            seen[who, node] = True
            cosine = np.concatenate([np.einsum("pd,pd->p", q[who[i : i + 65536]], x[node[i : i + 65536]]) for i in range(0, len(who), 65536)]) if len(who) else np.empty(0)
            hit = (cosine >= threshold) & (node != own[who])
            found_q.append(own[who[hit]])
            found_n.append(node[hit])
            wide = cosine >= threshold - margin
            who, node = who[wide], node[wide]
            lengths = ends[node + 1] - ends[node]
            spot = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            who, node = np.repeat(who, lengths), both[np.repeat(ends[node], lengths) + spot]
            new = ~seen[who, node]
            who, node = who[new], node[new]
        yield np.concatenate(found_q), np.concatenate(found_n)


def link_vectors(vectors: DataFrame, threshold: float = 0.95, overlap: int = 2, recall: float = 0.9) -> DataFrame:
    """Links by cosine: (vec_id, n_links, component_id, kept), a row for each row of ``vectors``.

    Equal vectors are one class, so a vector that a third of the rows share is one node. Centroids
    are fitted on a bounded sample; every class goes to the shards of its ``overlap`` nearest
    ones. Each shard builds a robust-pruned graph; a node's adjacency lists of all its shards are
    united. Every class is then searched for in each of its shards, and each pair found is verified in
    double precision and counted in the first shard that holds both. No pairs leave a task: a row
    per class and shard brings its number of links and the smallest class it is connected to there.

    A shard of more than ``QUERIES`` classes is searched by several tasks, each for its share of
    the queries. The audit draws classes and counts their links against all others until it has seen
    ``LINKED`` that have few near ones; while less than ``recall`` of the links of those, or of those
    with many, is found, all is done again with twice the overlap. Where that would compare as many
    pairs as there are, or a quarter of a large table does not hold enough linked classes to measure
    by, all classes are compared block by block instead, and every link is found.

    Null, zero and non-finite vectors link with nothing. Rows with a null id are vectors like any
    other, but name no component. Repeated rows are vectors of their own. Shorter vectors read as
    if zeros followed. An empty table gives no rows.
    """
    e = F.col("embedding")
    double = F.transform(e, lambda x: x.cast("double"))
    square = F.aggregate(double, F.lit(0.0), lambda s, x: s + x * x)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), e, F.when(finite("embedding"), double).alias("v"))
    rows = rows.withColumn("valid", F.coalesce(F.when(F.col("v").isNotNull(), square > 0), F.lit(False)))
    keyed = saved(rows.select("vec_id", "valid", F.xxhash64("v").alias("k1"), F.xxhash64(F.lit(1), "v").alias("k2"), F.when(F.col("valid"), F.col("v")).alias("v")), "vectors")
    classes = keyed.where("valid").groupBy("k1", "k2").agg(F.min("vec_id").alias("first"), F.count("*").alias("weight"), F.first("v").alias("v"))
    classes = saved(classes.withColumn("node", F.monotonically_increasing_id()), "vector-classes")
    count, width = classes.agg(F.count("*"), F.max(F.size("v"))).first()
    if count:
        truth = _truth(classes, count, width, threshold)
        while True:
            if truth is None:
                found = _compare(classes, count, width, threshold)
                break
            found = _search(classes, count, width, threshold, overlap)
            if _audit(truth, found) >= recall:
                break
            overlap *= 2
            if 2 * overlap * overlap >= _shards(count):
                truth = None
        groups = components(found.select(F.col("node").alias("src"), F.col("root").alias("dst")))
        linked = classes.select("k1", "k2", "node", "first", "weight").join(found.groupBy("node").agg(F.sum("links").alias("links")), "node", "left").join(groups, "node", "left")
        linked = linked.withColumn("component", F.coalesce("component", "node"))
        lowest = linked.groupBy("component").agg(F.min("first").alias("component_id"))
        linked = linked.join(lowest, "component").select("k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id")
        linked = saved(linked, "linked")
        known = keyed.where("valid").select("vec_id", "k1", "k2").join(linked, ["k1", "k2"]).select("vec_id", "n_links", "component_id")
    else:
        known = keyed.where("valid").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    alone = keyed.where("NOT valid").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return known.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.col("vec_id").isNull()))


def _unit(values, width: int) -> np.ndarray:
    out = np.zeros((len(values), width))
    for i, v in enumerate(values):
        out[i, : len(v)] = v
    out /= np.abs(out).max(axis=1, keepdims=True)
    return out / np.linalg.norm(out, axis=1, keepdims=True)


def _shards(count: int) -> int:
    return min(MOST_SHARDS, max(1, -(-count // SHARD)))


def _search(classes: DataFrame, count: int, width: int, threshold: float, overlap: int) -> DataFrame:
    shards = _shards(count)
    sample = sample_matrix(classes, "v", width, SAMPLE)
    centres = kmeans(_unit(sample, width), shards)
    centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-12)
    own = min(overlap, len(centres))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _unit(batch.column("v").to_pylist(), width)
            cells = np.sort(np.argpartition(-(x @ centres.T), own - 1, axis=1)[:, :own], axis=1)
            yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("weight"), pa.array([v.tobytes() for v in x], pa.binary()), pa.array(cells.tolist(), pa.list_(pa.int32()))], ["node", "weight", "x", "cells"])

    placed = saved(classes.select("node", "weight", "v").mapInArrow(assign, "node bigint, weight bigint, x binary, cells array<int>"), "placed")
    members = placed.select("node", "weight", "x", "cells", F.explode("cells").alias("shard"))
    parts = members.groupBy("shard").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("parts"))
    members = members.join(F.broadcast(parts), "shard")  # one row per shard, MOST_SHARDS at most
    members = members.withColumn("mine", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))

    def matrix(pdf: pd.DataFrame) -> np.ndarray:
        return np.frombuffer(b"".join(pdf["x"]), dtype=float).reshape(-1, width)

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("node", ignore_index=True)
        x, node = matrix(pdf), pdf["node"].to_numpy()
        rows = np.flatnonzero(pdf["mine"].to_numpy() == pdf["part"].to_numpy())
        links = build_graph(x, rows)
        return pd.DataFrame({"node": node[rows], "near": [node[line[line >= 0]].tolist() for line in links]})

    lists = members.select("shard", "part", "mine", "node", "x").groupBy("shard", "part").applyInPandas(build, "node bigint, near array<bigint>")
    united = saved(lists.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near")), "graph")  # a list for each of a node's shards

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("node", ignore_index=True)
        x, node, weight = matrix(pdf), pdf["node"].to_numpy(), pdf["weight"].to_numpy()
        shard, n = int(pdf["shard"].iloc[0]), len(pdf)
        links = _local_links(pdf["near"], node)
        queries = np.flatnonzero(pdf["mine"].to_numpy() == pdf["part"].to_numpy())
        centre = x.mean(axis=0)
        starts = np.unique(np.concatenate([[int((x @ centre).argmax())], np.arange(0, n, max(1, n // 8))]))  # the medoid and a few spread nodes
        lower = np.array([[c if c < shard else -1 - i for c in cells] for i, cells in enumerate(pdf["cells"])])
        total, root = np.zeros(n, dtype=np.int64), np.arange(n)

        def top(k: int) -> int:
            while root[k] != k:
                root[k] = root[root[k]]
                k = root[k]
            return k

        for a, b in range_search(x, links, starts, queries, threshold):
            first = ~(lower[a][:, :, None] == lower[b][:, None, :]).any(axis=(1, 2))  # in no earlier shard together
            np.add.at(total, a[first], weight[b[first]])
            flat = np.fromiter((top(k) for k in range(n)), dtype=np.int64, count=n)
            for code in np.unique(flat[a] * n + flat[b]).tolist():
                one, two = top(code // n), top(code % n)
                root[max(one, two)] = min(one, two)
        flat = np.fromiter((top(k) for k in range(n)), dtype=np.int64, count=n)
        out = pd.DataFrame({"node": node, "links": total, "root": node[flat]})
        mine = np.zeros(n, dtype=bool)
        mine[queries] = True
        return out[mine | (out["root"] != out["node"])]

    ready = members.join(united, "node").select("shard", "part", "mine", "node", "weight", "x", "cells", "near")
    return saved(ready.groupBy("shard", "part").applyInPandas(search, "node bigint, links bigint, root bigint"), "found")


def _compare(classes: DataFrame, count: int, width: int, threshold: float) -> DataFrame:
    """What ``_search`` returns, by comparing every class with every other: a task for each two blocks of classes.

    Blocks are dealt by hash and hold about ``BLOCK_BYTES``, so a task is bounded whatever the
    groups; each block goes to as many tasks as there are blocks.
    """
    blocks = max(LEAST_BLOCKS, -(-count * width * 8 // BLOCK_BYTES))

    def units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _unit(batch.column("v").to_pylist(), width)
                yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("weight"), pa.array([v.tobytes() for v in x], pa.binary())], ["node", "weight", "x"])

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        one, two = int(pdf["one"].iloc[0]), int(pdf["two"].iloc[0])
        pdf = pdf.sort_values(["block", "node"], ignore_index=True)
        x, node, weight = np.frombuffer(b"".join(pdf["x"]), dtype=float).reshape(-1, width), pdf["node"].to_numpy(), pdf["weight"].to_numpy()
        n, cut = len(pdf), int((pdf["block"] == one).sum())
        after = 0 if one == two else cut
        total, label, held = np.zeros(n, dtype=np.int64), np.arange(n), {k: [k] for k in range(n)}
        for at in range(0, cut, 64):
            near = x[at : min(at + 64, cut)] @ x[after:].T >= threshold
            for a, line in enumerate(near, at):
                if one == two:
                    line[a] = False
                b = np.flatnonzero(line) + after
                if not len(b):
                    continue
                total[a] += weight[b].sum()
                if one != two:
                    total[b] += weight[a]
                if (label[b] != label[a]).any():
                    groups = np.unique(np.append(label[b], label[a])).tolist()
                    into = max(groups, key=lambda g: len(held[g]))
                    for g in groups:
                        if g != into:
                            label[held[g]] = into
                            held[into] += held.pop(g)
        root = np.empty(n, dtype=np.int64)
        for members in held.values():
            root[members] = node[members].min()
        some = total > 0
        return pd.DataFrame({"node": node[some], "links": total[some], "root": root[some]})

    rows = classes.select("node", "weight", "v").mapInArrow(units, "node bigint, weight bigint, x binary")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("node", F.lit(7)), F.lit(blocks)).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    rows = rows.select(F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"), "block", "node", "weight", "x")
    return saved(rows.groupBy("one", "two").applyInPandas(compare, "node bigint, links bigint, root bigint"), "found")


def _local_links(near: pd.Series, node: np.ndarray) -> np.ndarray:
    """The united lists as numbers of the shard's own rows, a line each, filled up with -1."""
    lengths = near.map(len).to_numpy()
    src, dst = np.repeat(np.arange(len(node)), lengths), np.concatenate([np.asarray(v, dtype=np.int64) for v in near])
    at = np.minimum(np.searchsorted(node, dst), len(node) - 1)
    here = node[at] == dst
    src, at = src[here], at[here]
    slot = np.arange(len(src)) - np.searchsorted(src, src)
    out = np.full((len(node), int(slot.max()) + 1 if len(slot) else 1), -1, dtype=np.int64)
    out[src, slot] = at
    return out


def _both_ways(links: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All neighbours, whichever of the two lists the other: where each node's begin, and their numbers."""
    n = len(links)
    src, dst = np.repeat(np.arange(n), links.shape[1])[links.ravel() >= 0], links.ravel()[links.ravel() >= 0]
    code = np.unique(np.concatenate([src * n + dst, dst * n + src]))
    return np.searchsorted(code // n, np.arange(n + 1)), code % n


def _truth(classes: DataFrame, count: int, width: int, threshold: float) -> DataFrame | None:
    """(node, near, true): classes and links near each class drawn that has any, by comparing it with all others.

    Draws until ``LINKED`` classes of at most ``FEW`` near ones are seen, or all classes are drawn.
    None where a quarter of a large table does not hold so many: too little to measure a share by.
    """
    place, low, size, parts = F.pmod(F.xxhash64("node", F.lit(11)), F.lit(count)), 0, AUDIT, []
    seen = 0
    while low < count and seen < LINKED:
        if low >= max(MOST_DRAWN, count // 4):
            return None
        high = min(count, low + size)
        drawn = classes.where((place >= low) & (place < high)).select("node", "v").collect()
        low, size = high, min(2 * size, MOST_DRAWN)
        if drawn:
            part = saved(_near(classes, np.array([r.node for r in drawn]), _unit([r.v for r in drawn], width), width, threshold), "truth")
            parts.append(part)
            seen += part.where(F.col("near") <= FEW).count()
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _near(classes: DataFrame, nodes: np.ndarray, x: np.ndarray, width: int, threshold: float) -> DataFrame:
    """(node, near, true) of the given classes that have any other within the threshold."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near, true = np.zeros(len(nodes), dtype=np.int64), np.zeros(len(nodes), dtype=np.int64)
        for batch in batches:
            for part in (batch.slice(at, 1024) for at in range(0, batch.num_rows, 1024)):
                y, other, weight = _unit(part.column("v").to_pylist(), width), np.asarray(part.column("node")), np.asarray(part.column("weight"))
                hit, at = np.nonzero((x @ y.T >= threshold) & (nodes[:, None] != other))
                np.add.at(near, hit, 1)
                np.add.at(true, hit, weight[at])
        some = near > 0
        yield pa.RecordBatch.from_arrays([pa.array(nodes[some], pa.int64()), pa.array(near[some]), pa.array(true[some])], ["node", "near", "true"])

    counted = classes.select("node", "v", "weight").mapInArrow(count, "node bigint, near bigint, true bigint")
    return counted.groupBy("node").agg(F.sum("near").alias("near"), F.sum("true").alias("true"))


def _audit(truth: DataFrame, found: DataFrame) -> float:
    """Links found over links there are, of the classes drawn: the smaller share of those with few near ones and those with many."""
    got = found.groupBy("node").agg(F.sum("links").alias("links"))
    shares = truth.join(got, "node", "left").groupBy((F.col("near") <= FEW).alias("few")).agg(F.sum("true").alias("true"), F.sum(F.least(F.coalesce("links", F.lit(0)), "true")).alias("links"))
    return min((r.links / r.true for r in shares.collect()), default=1.0)  # no link at all only if every class was drawn
