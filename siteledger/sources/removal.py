"""Removal of expired folders by a plan that is written before anything goes."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession

_PLAN = "position int, path string"


def _files(spark: SparkSession, path: str):
    """The path and its file system, as the cluster's readers and writers see it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def planned_removal(
    spark: SparkSession, plan_path: str, patterns: Sequence[tuple[str, Callable[[str], bool]]]
) -> DataFrame:
    """Write the folders that match a pattern and whose name passes its test, in this order, as a plan."""
    found = []
    for pattern, test in patterns:
        at, files = _files(spark, pattern)
        statuses = files.globStatus(at) or []
        found += sorted(str(s.getPath()) for s in statuses if s.isDirectory() and test(s.getPath().getName()))
    plan = spark.createDataFrame(list(enumerate(found)), _PLAN)
    plan.coalesce(1).write.mode("errorifexists").parquet(plan_path)
    return spark.read.schema(_PLAN).parquet(plan_path)


def expired_folders(
    spark: SparkSession, root: str, column: str, as_of: date, days: int, plan_path: str, above: str = ""
) -> DataFrame:
    """Plan the removal of the folders ``<column>=<date>`` more than ``days`` days older than ``as_of``.

    ``above`` is a pattern of the folders between ``root`` and these, such as ``batch=*``. Folders whose name
    holds no date stay. These are the rows that ``retain`` with the same numbers never shows.
    """
    limit = as_of - timedelta(days=days)

    def expired(name: str) -> bool:
        try:
            return date.fromisoformat(name.split("=", 1)[1]) < limit
        except ValueError:
            return False

    pattern = "/".join(part for part in (root, above, f"{column}=*") if part)
    return planned_removal(spark, plan_path, [(pattern, expired)])


def remove_planned(spark: SparkSession, plan_path: str) -> int:
    """Remove the folders of a written plan; returns how many were still there.

    A run that was cut off is repeated with the same plan, which names nothing that came later.
    """
    removed = 0
    for row in spark.read.schema(_PLAN).parquet(plan_path).orderBy("position").collect():
        at, files = _files(spark, row.path)
        removed += bool(files.delete(at, True))
    return removed
