"""Scan-record files and the consolidated table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from siteledger import schemas
from siteledger.operators.records import to_files
from siteledger.sources.files import prefix_path
from siteledger.sources.versions import read_version, write_version


def read_record_files(
    spark: SparkSession,
    paths: str | Sequence[str],
    suffix: str = ".json",
    one_per_file: bool = True,
    prefixes: Sequence[str] | None = None,
    modified_after: str | None = None,
) -> DataFrame:
    """Stored records below one or several folders, as text columns.

    Files are listed recursively and matched by the end of their name; each is read by a
    task, and none is collected. ``one_per_file`` reads a file as one JSON document,
    otherwise as one record per line. ``written_at`` is the time of the file. ``prefixes``
    names the starts of the keys to read; those that no file has are left out. Files not written
    after ``modified_after`` (``yyyy-MM-ddTHH:mm:ss``) are left out when files are listed, and never opened.
    """
    fields = T.StructType([*schemas.SCAN_FILE, T.StructField(schemas.CORRUPT, T.StringType())])
    roots = [paths] if isinstance(paths, str) else list(paths)
    if prefixes is not None:
        found = []
        for path in (prefix_path(root, p) for root in roots for p in prefixes):
            try:
                found.append(read_record_files(spark, path, suffix, one_per_file, modified_after=modified_after))
            except AnalysisException as e:
                if e.getCondition() != "PATH_NOT_FOUND":
                    raise
        none = spark.createDataFrame([], T.StructType([*fields, T.StructField("written_at", T.TimestampType())]))
        return reduce(DataFrame.unionAll, found) if found else none
    return (
        spark.read.schema(fields)
        .json(
            roots,
            multiLine=one_per_file,
            mode="PERMISSIVE",
            columnNameOfCorruptRecord=schemas.CORRUPT,
            pathGlobFilter=f"*{suffix}",
            recursiveFileLookup=True,
            **({"modifiedAfter": modified_after} if modified_after else {}),
        )
        .select("*", F.col("_metadata.file_modification_time").alias("written_at"))
    )


def write_records(records: DataFrame, path: str, format: str = "parquet") -> int:
    """All typed records as a new version of a table, partitioned by scan date for retention.

    Readers see the version before until this one is whole; the number of the new one is returned.
    The rebalance lets adaptive execution give a large date several writers and put small
    ones together, so that neither huge nor tiny files arise.
    """
    return write_version(records.hint("rebalance", "scan_date"), path, ["scan_date"], format)


def read_records(spark: SparkSession, path: str, version: int | None = None, format: str = "parquet") -> DataFrame:
    """A version of the consolidated table, by default the newest; filters on its partition columns prune folders."""
    return read_version(spark, path, schemas.SCAN_RECORD, version, format)


def write_record_files(records: DataFrame, path: str) -> None:
    """The stored form, one JSON record per line, in folders by owner.

    The folders are the first two parts of each record's ``key``; the rebalance keeps an
    owner's records together and still gives a large owner several files. A run adds its files
    beside those of earlier ones; under each key the record written last counts, which
    ``latest_records`` takes by scan date and ``written_at``.
    """
    files = to_files(records).withColumns(
        {"owner_agency": F.col("agency"), "owner_organization": F.col("organization")}
    )
    files.hint("rebalance", "owner_agency", "owner_organization").write.mode(
        "append"
    ).partitionBy("owner_agency", "owner_organization").json(path, ignoreNullFields=False)
