"""Token counts through a digest cache."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siteledger.llm.common import doc_rows, saved, slices
from siteledger.llm.tokens import BYTE_BPE, counter, tokenizer_digest
from siteledger.session import scratch_path

CACHE_SCHEMA = "content binary, tokenizer string, n_tokens bigint"


def count_tokens(docs: DataFrame, tokenizer: str = BYTE_BPE, cache: str | None = None, limit: int = 1024) -> DataFrame:
    """Tokens of every whole text: (doc_id, n_bytes, n_tokens, over_limit).

    ``cache`` is a Parquet folder of (content digest, tokenizer digest, count); a new one in the
    shared folder if none is given. Content is normalised only as far as counts allow: null reads
    as the empty text, then UTF-8. Each text whose digests are not stored is encoded once, however
    often it occurs, and its count is appended. A text that many rows share is cut down to one row
    per task before it moves; the join that follows holds digests only, which adaptive execution
    splits where one is hot. Appending twice (a repeated run) does no harm: counts are read once
    per digest.

    Rows come back one for one: repeated rows and null ids too. An empty table gives no rows.
    Texts are encoded whole, without added special tokens; special strings in them count as the
    library counts them by default.
    """
    spark, version = docs.sparkSession, tokenizer_digest(tokenizer)
    cache = cache or scratch_path(spark, "token-cache")
    spark.createDataFrame([], CACHE_SCHEMA).write.mode("ignore").parquet(cache)

    def stored() -> DataFrame:
        found = spark.read.schema(CACHE_SCHEMA).parquet(cache).where(F.col("tokenizer") == version)
        return found.groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))

    rows = doc_rows(docs).withColumn("content", F.unhex(F.sha2("text", 256)))
    keyed = saved(rows.select("doc_id", "content", F.octet_length("text").cast("long").alias("n_bytes")), "digests")
    misses = rows.select("content", "text").groupBy("content").agg(F.first("text").alias("text")).join(stored(), "content", "left_anti")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(tokenizer).count
        for batch in slices(batches):
            counts = [count(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("content"), pa.array([version] * len(counts), pa.string()), pa.array(counts, pa.int64())], ["content", "tokenizer", "n_tokens"])

    misses.select("content", "text").mapInArrow(encode, CACHE_SCHEMA).write.mode("append").parquet(cache)
    return keyed.join(stored(), "content").select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
