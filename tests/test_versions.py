"""Immutable versions, state in folders by key, files by age, removal by plan: S5, S8, S9, S12, T3."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from siteledger.operators.dedupe import latest_per_key
from siteledger.sources import records as record_io, removal, versions
from siteledger.streaming.folders import read_folders, upsert_folders
from tests.conftest import rows

FIELDS = "agency string, domain string, seq int, scan_date date"
KEYS = ["agency", "domain"]
DAY = dt.date(2024, 1, 5)


def frame(spark, *found):
    return spark.createDataFrame(list(found), FIELDS)


def batch(spark, k, n=30):
    return frame(spark, *[("A", f"d{(i * 7 + k) % 40}", 100 * k + i, DAY + dt.timedelta(days=k)) for i in range(n)])


def test_versions_stand_side_by_side(spark, tmp_path):
    root = str(tmp_path / "t")
    assert versions.versions(spark, root) == [] and versions.pinned(spark, root) == (None, {})
    first, second = frame(spark, ("A", "a", 1, DAY)), frame(spark, ("A", "b", 2, DAY), ("A", "c", 3, None))
    schema = first.schema
    assert versions.read_version(spark, root, schema).count() == 0
    assert [versions.write_version(df, root, ["scan_date"]) for df in (first, second)] == [1, 2]
    pinned = versions.read_version(spark, root, schema, 1)
    assert versions.append_version(first, root, ["scan_date"]) == 3
    assert rows(pinned) == rows(first)
    assert rows(versions.read_version(spark, root, schema, 2)) == rows(second)
    assert rows(versions.read_version(spark, root, schema)) == rows(first.union(second))
    with pytest.raises(ValueError):
        versions.read_version(spark, root, schema, 9)
    with pytest.raises(ValueError):
        versions.commit(spark, root, 3, {})


def test_a_failed_writer_leaves_the_version_before(spark, tmp_path):
    root = str(tmp_path / "t")
    good = frame(spark, ("A", "a", 1, DAY))
    versions.write_version(good, root)
    torn = good.withColumn("seq", F.when(F.col("domain") == "a", F.raise_error(F.lit("lost")).cast("int")))
    with pytest.raises(Exception, match="lost"):
        versions.write_version(torn, root)
    assert versions.versions(spark, root) == [1]
    assert rows(versions.read_version(spark, root, good.schema)) == rows(good)
    os.makedirs(f"{root}/manifest/version=2/_temporary/0")  # a manifest whose writer was cut off
    assert versions.versions(spark, root) == [1] and versions.write_version(good, root) == 2


def test_old_versions_go_by_plan(spark, tmp_path):
    root, plan = str(tmp_path / "t"), str(tmp_path / "plan")
    for k in range(4):
        versions.write_version(batch(spark, k), root)
    versions.append_version(batch(spark, 9), root)
    kept = [rows(versions.read_version(spark, root, batch(spark, 0).schema, v)) for v in (4, 5)]
    planned = versions.forget_versions(spark, root, plan, keep=2)
    assert planned.count() == 6 and versions.versions(spark, root) == [1, 2, 3, 4, 5]
    assert removal.remove_planned(spark, plan) == 6 and removal.remove_planned(spark, plan) == 0
    assert versions.versions(spark, root) == [4, 5]
    assert [rows(versions.read_version(spark, root, batch(spark, 0).schema, v)) for v in (4, 5)] == kept
    assert len(os.listdir(f"{root}/data")) == 2


def test_state_in_folders(spark, tmp_path):
    root, schema = str(tmp_path / "t"), batch(spark, 0).schema
    batches = [batch(spark, k, 30 if k % 2 else 2) for k in range(6)]
    everything = None
    for k, found in enumerate(batches):
        upsert_folders(found, root, k, schema, KEYS, "seq", folders=8)
        everything = found if everything is None else everything.union(found)
        state = read_folders(spark, root, schema)
        assert rows(state) == rows(latest_per_key(everything, KEYS, "seq"))
        _, current = versions.pinned(spark, root)
        assert len(current) <= 8  # one folder for each part of the keys, whatever the number of batches
    before = rows(read_folders(spark, root, schema))
    files = sorted(str(p) for p in tmp_path.rglob("*.parquet"))
    upsert_folders(batches[3], root, 3, schema, KEYS, "seq", folders=8)  # runs again
    assert rows(read_folders(spark, root, schema)) == before and sorted(str(p) for p in tmp_path.rglob("*.parquet")) == files
    assert rows(read_folders(spark, root, schema, version=1)) == rows(latest_per_key(batches[0].union(batches[1]), KEYS, "seq"))
    as_of = F.lit(DAY + dt.timedelta(days=12))
    assert {r.scan_date for r in read_folders(spark, root, schema, as_of=as_of).collect()} <= {DAY + dt.timedelta(days=k) for k in range(2, 6)}


def test_a_batch_leaves_other_folders_alone(spark, tmp_path):
    root, schema = str(tmp_path / "t"), batch(spark, 0).schema
    upsert_folders(batch(spark, 1, 40), root, 0, schema, KEYS, "seq", folders=16)
    _, before = versions.pinned(spark, root)
    upsert_folders(frame(spark, ("A", "d1", 999, DAY)), root, 1, schema, KEYS, "seq", folders=16)
    _, after = versions.pinned(spark, root)
    assert sum(before[k] != after[k] for k in before) == 1 and len(os.listdir(f"{root}/data/batch=1")) == 3  # with _SUCCESS and its checksum
    upsert_folders(frame(spark), root, 2, schema, KEYS, "seq", folders=16)
    assert versions.pinned(spark, root)[1] == after


def test_old_files_are_never_opened(spark, tmp_path):
    (tmp_path / "r").mkdir()
    for name, text, age in (("old", '{"torn', 90), ("new", '{"agency": "A"}', 0)):
        path = tmp_path / "r" / f"{name}.json"
        path.write_text(text)
        stamp = dt.datetime(2024, 6, 1).timestamp() - 86400 * age
        os.utime(path, (stamp, stamp))
    read = record_io.read_record_files(spark, str(tmp_path / "r"), modified_after="2024-05-01T00:00:00")
    assert [os.path.basename(f) for f in read.inputFiles()] == ["new.json"] and read.first().agency == "A"
    assert record_io.read_record_files(spark, str(tmp_path / "r")).count() == 2


def test_expired_dates_are_gone(spark, tmp_path):
    root, plan = str(tmp_path / "dead"), str(tmp_path / "plan")
    for k in (0, 1):
        batch(spark, k).unionByName(batch(spark, k + 5)).write.partitionBy("scan_date").parquet(f"{root}/batch={k}")
    as_of = DAY + dt.timedelta(days=8)
    shown = spark.read.parquet(root).filter(F.col("scan_date") >= as_of - dt.timedelta(days=3))
    expected = rows(shown)
    planned = removal.expired_folders(spark, root, "scan_date", as_of, 3, plan, above="batch=*")
    assert planned.count() == 2 and spark.read.parquet(root).count() == 120  # nothing goes before the plan is carried out
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        removal.expired_folders(spark, root, "scan_date", as_of, 3, plan, above="batch=*")
    assert removal.remove_planned(spark, plan) == 2
    assert rows(spark.read.parquet(root)) == expected
    assert removal.expired_folders(spark, str(tmp_path / "none"), "scan_date", as_of, 3, str(tmp_path / "p2")).count() == 0
