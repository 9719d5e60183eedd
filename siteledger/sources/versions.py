"""Tables of immutable folders, named by a manifest that is written last.

``data/`` holds folders that are written once and never changed. A version is one file below
``manifest/version=<n>``, a row per folder that belongs to it, and exists when that file does: a
writer that fails leaves folders that no version names, and readers of the version before see nothing of
it. One writer at a time; any number of readers.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from siteledger.sources.removal import planned_removal

_ENTRY = "name string, folder string"


def _manifests(spark: SparkSession, root: str) -> DataFrame | None:
    try:
        return (
            spark.read.schema(f"{_ENTRY}, version bigint")
            .option("basePath", f"{root}/manifest")
            .parquet(f"{root}/manifest/version=*")
        )
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the complete versions, oldest first."""
    found = _manifests(spark, root)
    return [] if found is None else sorted(r[0] for r in found.select("version").distinct().collect())


def pinned(spark: SparkSession, root: str, version: int | None = None) -> tuple[int | None, dict[str, str]]:
    """A version, by default the newest, and its folders by name; a reader that keeps these is not
    touched by later versions. (None, {}) where there is none."""
    known = versions(spark, root)
    if version is None and not known:
        return None, {}
    chosen = known[-1] if version is None else version
    if chosen not in known:
        raise ValueError(f"{root} has no version {chosen}")
    rows = _manifests(spark, root).filter(F.col("version") == chosen).collect()
    return chosen, {r.name: f"{root}/{r.folder}" for r in rows}


def commit(spark: SparkSession, root: str, version: int, folders: dict[str, str]) -> None:
    """Name the folders of a version; from here on it exists."""
    if version in versions(spark, root):
        raise ValueError(f"{root} already has a version {version}")
    entries = [(name, folder.removeprefix(f"{root}/")) for name, folder in folders.items()]
    spark.createDataFrame(entries, _ENTRY).coalesce(1).write.mode("overwrite").parquet(
        f"{root}/manifest/version={version}"
    )


def write_version(
    df: DataFrame, root: str, partition_by: Sequence[str] = (), format: str = "parquet"
) -> int:
    """The rows as a new version, which holds nothing else; returns its number."""
    spark = df.sparkSession
    folder = f"{root}/data/{uuid.uuid4().hex}"
    df.write.format(format).partitionBy(*partition_by).save(folder)
    version = (pinned(spark, root)[0] or 0) + 1
    commit(spark, root, version, {"all": folder})
    return version


def append_version(df: DataFrame, root: str, partition_by: Sequence[str] = ()) -> int:
    """The rows beside those of the newest version, as a new one; nothing is rewritten."""
    spark = df.sparkSession
    name = uuid.uuid4().hex
    df.write.partitionBy(*partition_by).parquet(f"{root}/data/{name}")
    before, folders = pinned(spark, root)
    version = (before or 0) + 1
    commit(spark, root, version, {**folders, name: f"{root}/data/{name}"})
    return version


def read_version(
    spark: SparkSession,
    root: str,
    schema: T.StructType,
    version: int | None = None,
    format: str = "parquet",
) -> DataFrame:
    """A version, by default the newest; no rows where there is none."""
    _, folders = pinned(spark, root, version)
    found = spark.createDataFrame([], schema)
    for k, folder in enumerate(sorted(folders.values())):
        # each folder has its own partition columns below it
        part = spark.read.schema(schema).format(format).load(folder).select(*schema.names)
        found = part if k == 0 else found.unionAll(part)
    return found


def forget_versions(spark: SparkSession, root: str, plan_path: str, keep: int = 2) -> DataFrame:
    """Plan the removal of all but the newest ``keep`` versions and of folders that none of these names.

    Manifests go first, so that no version is left without its folders. Call it when no writer is at
    work: a folder that a version does not name yet looks like one left behind. ``remove_planned``
    carries the written plan out.
    """
    kept = set(versions(spark, root)[-keep:])
    used = {folder for v in kept for folder in pinned(spark, root, v)[1].values()}
    tops = {folder.split("/data/", 1)[1].split("/", 1)[0] for folder in used}
    return planned_removal(
        spark,
        plan_path,
        [
            (f"{root}/manifest/version=*", lambda name: int(name.split("=", 1)[1]) not in kept),
            (f"{root}/data/*", lambda name: name not in tops),
        ],
    )
