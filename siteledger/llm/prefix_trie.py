"""Trie of all conversation prefixes: local sorted shards under a broadcast skeleton of splitter paths."""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siteledger.llm.common import saved, turn_digest

#: Bytes of a turn in a path: 16 of its digest, 8 of its text's code points.
RECORD = 24
#: Turns of a splitter's path at most; with the number of shards this bounds the skeleton.
SPLITTER_TURNS = 64
#: Keys drawn for each shard that splitters are chosen from. Results do not depend on the choice.
DRAWN = 20
#: Ids in one chunk of a skeleton node's list of ends.
CHUNK = 50_000
EMPTY_SHA256 = hashlib.sha256().hexdigest()

_WALKED = "skel int, up int, shard int, seq int, chunk binary, conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string"
_NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def own_paths(conversations: DataFrame) -> DataFrame:
    """(conv_id, path): the turns of each conversation in order, as records of digest and length; texts do not move."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    chars = F.unhex(F.lpad(F.hex(F.char_length(text).cast("long")), 16, "0"))
    turns = conversations.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.concat(turn_digest(role, text), chars).alias("record"))

    def stitch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, path = None, bytearray()
        for batch in batches:
            out: list[tuple] = []
            for conv, record in zip(batch.column("conv_id").to_pylist(), batch.column("record").to_pylist(), strict=True):
                if conv != now:
                    if now is not None:
                        out.append((now, bytes(path)))
                    now, path = conv, bytearray()
                path += record
            yield _batch(out, ("conv_id", "path"), (pa.int64(), pa.binary()))
        if now is not None:
            yield _batch([(now, bytes(path))], ("conv_id", "path"), (pa.int64(), pa.binary()))

    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "record")
    return ordered.select("conv_id", "record").mapInArrow(stitch, "conv_id bigint, path binary")


def rebuilt_paths(paths: DataFrame, family: int = 100, most: int = 6) -> DataFrame:
    """Each conversation behind the first turns of its family's head.

    h = crc32(decimal id) % ``most`` turns come from conversation c - c % ``family`` (all it has
    if fewer, none if there is no such conversation); the conversation's own turns follow after
    its first h.
    """
    heads = paths.where(F.col("conv_id") % family == 0).select(F.col("conv_id").alias("head_id"), F.expr(f"substring(path, 1, {RECORD * most})").alias("head"))
    rows = paths.withColumn("cut", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most * RECORD).cast("int"))
    joined = rows.join(heads, F.col("conv_id") - F.col("conv_id") % family == F.col("head_id"), "left")
    head = F.coalesce(F.expr("substring(head, 1, cut)"), F.lit(b""))
    return joined.select("conv_id", F.concat(head, F.expr("substring(path, cut + 1)")).alias("path"))


def _batch(rows: list[tuple], names: tuple[str, ...], kinds: tuple) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], list(names))


class Skeleton:
    """Trie of the splitters' paths. A node that is not in it has all its members between two neighbouring splitters."""

    def __init__(self, splitters: list[tuple[bytes, int]]):
        self.splitters = splitters
        self.children: list[dict[bytes, int]] = [{}]
        self.parent, self.depth, self.chars = [-1], [0], [0]
        for path, _ in splitters:
            node = 0
            for at in range(0, len(path), RECORD):
                record = path[at : at + RECORD]
                if record not in self.children[node]:
                    self.children[node][record] = len(self.children)
                    self.children.append({})
                    self.parent.append(node)
                    self.depth.append(self.depth[node] + 1)
                    self.chars.append(int.from_bytes(record[16:], "big"))
                node = self.children[node][record]

    def reduced(self, sums: dict[int, tuple[int, int, int, int, int]]) -> list[tuple]:
        """Nodes (id, conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens) from the sums of the shards' parts."""
        total = [[sums[k][2], sums[k][3], sums[k][4]] for k in range(len(self.parent))]  # children, leaves, saved
        out = []
        for k in range(len(self.parent) - 1, -1, -1):  # children have larger numbers than their parents
            (convs, least), (children, leaves, saving) = sums[k][:2], total[k]
            leaves = leaves if children else 1
            saving += (convs - 1) * self.chars[k]
            up = self.parent[k]
            if up >= 0:
                total[up][0] += 1
                total[up][1] += leaves
                total[up][2] += saving
            out.append((k, least, self.depth[k], sums[up][1] if up >= 0 else None, convs, children, leaves, saving))
        return out


class _Open:
    """A node whose members are still arriving."""

    __slots__ = ("chars", "children", "ended", "finished", "ids", "leaves", "least", "members", "saved", "seq", "sha", "skel")

    def __init__(self, chars: int, skel: int):
        self.chars, self.skel = chars, skel
        self.least, self.members, self.children, self.leaves, self.saved = None, 0, 0, 0, 0
        self.ended, self.sha, self.seq = 0, None, 0
        self.ids: list[bytes] = []
        self.finished: list[tuple] = []


class _Walk:
    """Depth-first walk over the sorted paths of one shard after another, holding one path of open nodes.

    A finished node waits for its parent's smallest member; where the parent is in the skeleton,
    that comes from the reduction and the row leaves at once.
    """

    def __init__(self, skeleton: Skeleton):
        self.skeleton, self.shard, self.path = skeleton, None, b""
        self.stack: list[_Open] = []
        self.out: list[tuple] = []

    def add(self, shard: int, conv: int, path: bytes) -> None:
        if shard != self.shard:
            self.finish()
            self.shard, self.path, self.stack = shard, b"", [_Open(0, 0)]
        same = 0
        if path == self.path:
            same = len(path)
        else:
            most = min(len(path), len(self.path))
            while same < most and path[same : same + RECORD] == self.path[same : same + RECORD]:
                same += RECORD
            while len(self.stack) - 1 > same // RECORD:
                self._close()
            for at in range(same, len(path), RECORD):
                record, above = path[at : at + RECORD], self.stack[-1].skel
                self.stack.append(_Open(int.from_bytes(record[16:], "big"), self.skeleton.children[above].get(record, -1) if above >= 0 else -1))
            self.path = path
        self._end(self.stack[-1], conv)

    def _end(self, node: _Open, conv: int) -> None:
        node.least = conv if node.least is None else min(node.least, conv)
        node.members += 1
        if node.skel >= 0:
            node.ids.append(b"%d" % conv)
            if len(node.ids) == CHUNK:
                self._chunk(node)
            return
        if node.sha is None:
            node.sha = hashlib.sha256()
        node.sha.update(b",%d" % conv if node.ended else b"%d" % conv)
        node.ended += 1

    def _chunk(self, node: _Open) -> None:
        self.out.append((node.skel, None, self.shard, node.seq, b",".join(node.ids)) + (None,) * 8)
        node.ids, node.seq = [], node.seq + 1

    def _close(self) -> None:
        node, depth = self.stack.pop(), len(self.stack)
        above = self.stack[-1] if self.stack else None
        if above is not None:
            above.members += node.members
            above.least = node.least if above.least is None else min(above.least, node.least)
        if node.skel >= 0:
            if node.ids:
                self._chunk(node)
            self.out.append((node.skel, None, self.shard, None, None, node.least, depth, None, node.members, node.children, node.leaves, node.saved, None))
            return
        leaves = node.leaves if node.children else 1
        saving = node.saved + (node.members - 1) * node.chars
        above.children += 1
        above.leaves += leaves
        above.saved += saving
        row = (node.least, depth, node.members, node.children, leaves, saving, node.sha.hexdigest() if node.sha else EMPTY_SHA256)
        if above.skel >= 0:
            self._emit(row, above.skel, None)
        else:
            above.finished.append(row)
        for below in node.finished:
            self._emit(below, None, node.least)

    def _emit(self, row: tuple, up: int | None, parent: int | None) -> None:
        least, depth, members, children, leaves, saving, ends = row
        self.out.append((None, up, None, None, None, least, depth, parent, members, children, leaves, saving, ends))

    def finish(self) -> None:
        while self.stack:
            self._close()


def prefix_trie(conversations: DataFrame, family: int = 100, most: int = 6, shards: int | None = None) -> DataFrame:
    """One row per node of the trie of rebuilt conversations (``rebuilt_paths``).

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256): a
    node is a distinct sequence of first turns, named by its smallest member and its depth.

    Paths are cut into ``shards`` ranges (twice the shuffle partitions) of (path, conv_id) by
    splitters out of a bounded draw; equal paths divide by id, so that copies of one conversation
    spread. The trie of the splitter paths, at most ``SPLITTER_TURNS`` a shard, is broadcast. All other
    nodes lie in one shard and are finished there in one pass over its sorted paths. Nodes of the
    skeleton leave a partial row per shard; these are summed, and only the sums, one row for each
    skeleton node, meet on the driver. Ids that end in a skeleton node arrive as sorted chunks and
    stream through one hash, as SHA-256 can only be taken in order.

    Memory: a conversation's path is one value of 24 bytes a turn. Texts are read once and never move.

    Null roles and texts read as empty, null turns come first; equal turns are ordered by the digest
    of role and text. Rows without a conv_id belong to no conversation and are left out. Repeated rows
    are turns of their own. Other columns are not read. An empty table has no nodes, not even a root.
    """
    spark = conversations.sparkSession
    paths = saved(rebuilt_paths(saved(own_paths(conversations), "own-paths"), family, most), "paths")
    shards = shards or 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = paths.select(F.expr(f"substring(path, 1, {SPLITTER_TURNS * RECORD})").alias("path"), "conv_id")
    drawn = sorted((bytes(r.path), r.conv_id) for r in keys.orderBy(F.xxhash64("conv_id"), "conv_id").limit(DRAWN * shards).collect())
    splitters = sorted({drawn[len(drawn) * k // shards] for k in range(1, shards)}) if drawn else []
    shared = spark.sparkContext.broadcast(Skeleton(splitters))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts = shared.value.splitters
        for batch in batches:
            rows = zip(batch.column("path").to_pylist(), batch.column("conv_id").to_pylist(), strict=True)
            shard = pa.array([bisect_right(cuts, key) for key in rows], pa.int32())
            yield pa.RecordBatch.from_arrays([shard, batch.column("path"), batch.column("conv_id")], ["shard", "path", "conv_id"])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = _Walk(shared.value)
        names = tuple(c.split()[0] for c in _WALKED.split(", "))
        kinds = (*(pa.int32(),) * 4, pa.binary(), *(pa.int64(),) * 7, pa.string())
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("shard", "conv_id", "path")), strict=True):
                state.add(*row)
            yield _batch(state.out, names, kinds)
            state.out = []
        state.finish()
        yield _batch(state.out, names, kinds)

    dealt = paths.mapInArrow(deal, "shard int, path binary, conv_id bigint")
    walked = saved(dealt.repartition("shard").sortWithinPartitions("shard", "path", "conv_id").mapInArrow(walk, _WALKED), "walked")

    parts = walked.where("skel IS NOT NULL AND chunk IS NULL").groupBy("skel")
    sums = parts.agg(F.sum("n_convs"), F.min("conv_id"), F.sum("n_children"), F.sum("n_leaves"), F.sum("saved_tokens")).collect()
    reduced = shared.value.reduced({r[0]: tuple(r)[1:] for r in sums}) if sums else []
    kinds = "skel int, conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint"
    skeleton = spark.createDataFrame(reduced, kinds)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sha = None, None
        for batch in batches:
            out = []
            for skel, chunk in zip(batch.column("skel").to_pylist(), batch.column("chunk"), strict=True):
                if skel != now:
                    if now is not None:
                        out.append((now, sha.hexdigest()))
                    now, sha = skel, hashlib.sha256()
                else:
                    sha.update(b",")
                sha.update(chunk.as_buffer())
            yield _batch(out, ("ended", "ends_sha256"), (pa.int32(), pa.string()))
        if now is not None:
            yield _batch([(now, sha.hexdigest())], ("ended", "ends_sha256"), (pa.int32(), pa.string()))

    chunks = walked.where("chunk IS NOT NULL").select("skel", "shard", "seq", "chunk")
    ends = chunks.repartition("skel").sortWithinPartitions("skel", "shard", "seq").mapInArrow(digest, "ended int, ends_sha256 string")
    # both sides have at most a row for each node of the skeleton
    upper = skeleton.join(ends, skeleton.skel == ends.ended, "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)))
    above = skeleton.select(F.col("skel").alias("up_skel"), F.col("conv_id").alias("up_conv"))
    local = walked.where("skel IS NULL").join(F.broadcast(above), F.col("up") == F.col("up_skel"), "left")
    local = local.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "up_conv"))
    return local.select(*_NODE).unionByName(upper.select(*_NODE))
