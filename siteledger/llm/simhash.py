"""Near duplicates by SimHash: fingerprints, and covering locality-sensitive hashing of them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siteledger.llm.common import components, doc_rows, only_memo, packed, saved, slices, unpacked

SEED = 42
#: Members of a bucket up to which they are compared pair by pair; larger buckets go through centres, with the same links.
PAIRWISE = 32
_ROWS = 1 << 14


def fingerprint(text: str, shingle: int = 3) -> int:
    """64-bit SimHash of a text's word shingles, repeats included.

    A-Z are lower-cased; words are runs without ASCII white space. Fewer words than a shingle
    make one shingle of them all; none give zero. A bit is 1 if it is set in over half the hashes.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII case and ASCII white space only
    n = len(words)
    if not n:
        return 0
    if n <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    starts = np.zeros(n, dtype=np.int64)
    np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=n)[:-1] + 1, out=starts[1:])
    ends = [*(starts[shingle:] - 1).tolist(), len(joined)]
    set_bits, count = np.zeros(64, dtype=np.int64), n - shingle + 1
    begins = starts[:count].tolist()
    for at in range(0, count, _ROWS):
        hashes = [digest(joined[a:b], SEED) for a, b in zip(begins[at : at + _ROWS], ends[at : at + _ROWS], strict=True)]
        bits = np.unpackbits(np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_bits += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(set_bits * 2 > count, bitorder="little").view("<u8")[0])


def covering_masks(radius: int = 2, bits: int = 64) -> list[int]:
    """2^(radius+1) - 1 masks such that any ``radius`` bits lie wholly outside at least one of them.

    Bit i gets a non-zero vector m(i) of radius + 1 binary digits. Mask v, for each non-zero v,
    holds the bits whose m(i) has an odd product with v. The vectors of ``radius`` bits do not
    span the space, so some v is orthogonal to all of them and its mask leaves those bits out.
    """
    count = (1 << radius + 1) - 1
    vectors = [1 + i % count for i in range(bits)]
    return [sum(1 << i for i, m in enumerate(vectors) if (m & v).bit_count() & 1) for v in range(1, count + 1)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _apart(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def fingerprint_links(prints: DataFrame, radius: int = 2, pairwise: int = PAIRWISE) -> DataFrame:
    """Links (src, dst) between distinct fingerprints ``fp`` whose components are those of all pairs within ``radius``.

    Every pair within the radius has the same bits under some covering mask, so it shares a
    bucket. In a bucket of up to ``pairwise`` members pairs are compared directly. A larger one is
    not paired off: two members within 2 bits differ outside the mask and have a common centre
    that is at most one bit from either, so each member names its centres, and every member of a
    centre is linked to the centre's smallest. For a larger radius all buckets are compared.
    """
    masks = [_signed(m) for m in covering_masks(radius)]
    tables = F.array(*[F.struct(F.lit(v).alias("v"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for v, m in enumerate(masks)])
    keyed = prints.select("fp", F.explode(tables).alias("t")).select("t.v", "t.key", "fp")
    sizes = keyed.groupBy("v", "key").agg(F.count("*").alias("members")).where("members > 1")
    found = saved(keyed.join(sizes, ["v", "key"]), "buckets")
    limit = pairwise if radius == 2 else (1 << 62)
    small = found.where(F.col("members") <= limit)
    near = small.select("v", "key", F.col("fp").alias("src")).join(small.select("v", "key", F.col("fp").alias("dst")), ["v", "key"]).where("src < dst")
    links = near.where(_apart(F.col("src"), F.col("dst")) <= radius).select("src", "dst")
    if radius == 2:
        outside = F.element_at(F.array(*[F.array(F.lit(0).cast("long"), *[F.lit(_signed(1 << i)) for i in range(64) if not m >> i & 1]) for m in masks]), F.col("v") + 1)
        centred = found.where(F.col("members") > limit).select("v", "fp", F.explode(outside).alias("flip"))
        centred = centred.select(F.col("fp").bitwiseXOR(F.col("flip")).alias("centre"), "fp", "v")
        lowest = centred.groupBy("v", "centre").agg(F.min("fp").alias("src"), F.count("*").alias("n")).where("n > 1")
        links = links.unionByName(centred.join(lowest, ["v", "centre"]).where("src <> fp").select("src", F.col("fp").alias("dst")))
    return links.distinct()


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """(doc_id, fp, component_id): each document's fingerprint and the smallest doc_id its links reach.

    Only fingerprints move: equal ones are one node, however many documents share it, and only
    distinct ones are linked. Null texts are empty, which gives fingerprint zero, linked like any
    other. Rows with a null id have a fingerprint and take part as members, but never name a
    component; one without any id has component null. Repeated rows come back one for one. An
    empty table gives no rows.
    """

    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only_memo()
        for batch in slices(batches):
            values = [_signed(fingerprint(t.as_py(), shingle)) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(values, pa.int64())], ["doc_id", "fp"])

    marked = saved(doc_rows(docs).mapInArrow(prints, "doc_id bigint, fp bigint"), "fingerprints")
    classes = saved(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "classes")
    groups = components(fingerprint_links(classes.select("fp"), radius))
    named = classes.join(groups.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    lowest = named.groupBy("component").agg(F.min("first").alias("component_id"))
    decided = saved(named.join(lowest, "component").select("fp", "component_id"), "decided")
    return marked.join(decided, "fp").select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """``docs`` with one document of each group of near duplicates: the one with the smallest id.

    Rows with a null id stay: nothing tells which of them is another's copy. Of several rows with
    the id that stays, all stay.
    """
    keep = near_duplicates(docs, shingle, radius).where("doc_id = component_id").select(F.col("doc_id").alias("kept_id")).distinct()
    rows = packed(docs, key=F.col("doc_id").cast("long"))
    return unpacked(rows.where("key IS NOT NULL").join(keep, rows.key == keep.kept_id, "left_semi").unionByName(rows.where("key IS NULL")))
