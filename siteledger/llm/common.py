"""What several operators share: text access, word codes, rows as structs, components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siteledger.session import materialize, scratch_path

#: Words are maximal runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def doc_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with null text as empty; other columns are left out, so none can clash."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )


def packed(docs: DataFrame, **extra: Column) -> DataFrame:
    """Each row as one struct ``row`` beside computed columns, whatever the row's own names are."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *[v.alias(k) for k, v in extra.items()])


def unpacked(df: DataFrame, **replaced: Column) -> DataFrame:
    """The struct of ``packed`` as columns again, some of them replaced."""
    names = df.schema["row"].dataType.names
    return df.select(*[(replaced[c] if c in replaced else F.col(f"row.`{c}`")).alias(c) for c in names])


def turn_digest(role: Column, text: Column) -> Column:
    """16 bytes of a SHA-256 over role and text, which tell turns apart without moving them."""
    return F.unhex(F.substring(F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 32))


def saved(df: DataFrame, name: str) -> DataFrame:
    """Written once to the shared folder and read back: ends lineage, survives lost executors."""
    return materialize(df, scratch_path(df.sparkSession, name))


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The rows in slices of about ``most`` bytes of text (or one row), so that Python holds little at once."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.asarray(pc.binary_length(batch.column(text)).fill_null(0), dtype=np.int64)
        ends, start = np.cumsum(sizes), 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + most, "right")))
            yield batch.slice(start, stop - start)
            start = stop


_memo: list[dict] = []


def only_memo(memo: dict | None = None) -> None:
    """To be called by a task before its first row: from now on its worker remembers words in ``memo`` alone, or in none.

    Spark hands a worker on from stage to stage, so the memos of all operators that it has run would add up.
    """
    for other in _memo:
        if other is not memo:
            other.clear()
    _memo[:] = [] if memo is None else [memo]


class WordCodes(dict):
    """Bytes of a word to its XXH64; kept only for recent words, as it must not grow with the corpus."""

    MOST = 300_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.MOST:
            self.clear()
        code = xxhash.xxh64_intdigest(word)
        if len(word) <= 64:
            self[word] = code
        return code

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def gram_hashes(codes: np.ndarray, n: int, by: int) -> np.ndarray:
    """Polynomial hashes (mod 2^64) of all runs of ``n`` codes, in about log n passes."""
    if len(codes) < n:
        return np.empty(0, dtype=np.uint64)
    total, done, power, run = None, 0, np.uint64(by), codes
    size, left = 1, n
    with np.errstate(over="ignore"):
        while left:
            if left & 1:
                part = run[done : done + len(codes) - n + 1]
                total = part.copy() if total is None else total * power + part
                done += size
            left >>= 1
            if left:
                run = run[: len(run) - size] * power + run[size:]
                power, size = power * power, size * 2
    return total


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of ``edges(src, dst)`` (long ids): (node, component), the smallest id reachable.

    Alternates the large-star and small-star steps until no edge changes. Each step is two
    aggregations over all edges; what it writes ends the lineage. Only a count and a checksum
    reach the driver. Ids without an edge to another id are not returned.
    """
    now = saved(edges.where("src <> dst").select("src", "dst").distinct(), f"{name}-0")

    def mark(df: DataFrame):
        return df.agg(F.count("*"), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))).first()

    def star(df: DataFrame, large: bool) -> DataFrame:
        # both: every u with its smallest neighbour m; large links m to the neighbours above u, small to those below
        both = df.unionByName(df.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        if not large:
            both = both.where("dst < src")
        low = both.groupBy("src").agg(F.least(F.min("dst"), F.col("src")).alias("m"))
        if large:
            return both.where("dst > src").join(low, "src").select(F.col("dst").alias("src"), F.col("m").alias("dst")).where("src <> dst").distinct()
        below = both.join(low, "src").select(F.col("dst").alias("src"), F.col("m").alias("dst"))
        return below.unionByName(low.select("src", F.col("m").alias("dst"))).where("src <> dst").distinct()

    seen, step = mark(now), 0
    while seen[0]:
        step += 1
        now = saved(star(star(now, True), False), f"{name}-{step}")
        new = mark(now)
        if new == seen:
            break
        seen = new
    nodes = now.groupBy(F.col("src").alias("node")).agg(F.min("dst").alias("component"))
    return nodes.unionByName(now.select(F.col("dst").alias("node"), F.col("dst").alias("component")).distinct())
