"""Listing of stored objects."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

_GLOB = re.compile(r"[\[\]{}*?\\]")  # a prefix is taken as it stands
_SCHEMA = "path string, modificationTime timestamp, length bigint"


def prefix_path(root: str, prefix: str) -> str:
    """The path pattern of everything below ``root`` whose key starts with ``prefix``."""
    return f"{root}/{_GLOB.sub(r'\\\g<0>', prefix)}*"


def list_files(
    spark: SparkSession, root: str, prefixes: str | Sequence[str] = "", suffix: str = ""
) -> DataFrame:
    """``(path, modificationTime, length)`` of the files below ``root`` whose key starts with
    one of the prefixes and ends with the suffix. Contents are not read."""
    found = None
    for prefix in [prefixes] if isinstance(prefixes, str) else prefixes:
        try:
            files = (
                spark.read.format("binaryFile")
                .option("recursiveFileLookup", True)
                .load(prefix_path(root, prefix))
                .select("path", "modificationTime", "length")
            )
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        found = files if found is None else found.unionAll(files)
    if found is None:
        return spark.createDataFrame([], _SCHEMA)
    return found.filter(F.col("path").endswith(suffix)) if suffix else found


def first_file(spark: SparkSession, root: str, prefix: str) -> str | None:
    """Path of the first file, in key order, that starts with ``prefix``; None without one."""
    return list_files(spark, root, prefix).agg(F.min("path")).first()[0]
