"""The scratch folder and written intermediate tables."""

from types import SimpleNamespace

import pytest

from siteledger import session


def fake(master, named=None):
    conf = SimpleNamespace(get=lambda key, *_: named if "checkpoint" in key else "/warehouse")
    return SimpleNamespace(
        conf=conf, sparkContext=SimpleNamespace(master=master, applicationId=f"app-{master}")
    )


def test_scratch_root():
    assert session.scratch_root(fake("yarn", "hdfs:///shared/")) == "hdfs:///shared"
    with pytest.raises(ValueError):
        session.scratch_root(fake("yarn"))
    local = fake("local[2]")
    assert session.scratch_root(local) == "/warehouse/_scratch"


def test_materialize(spark):
    df = spark.range(5).selectExpr("id", "array(id) AS a")
    path = session.scratch_path(spark, "t")
    assert path.startswith(spark.conf.get("spark.checkpoint.dir"))
    written = session.materialize(df, path)
    assert written.schema.simpleString() == df.schema.simpleString()
    assert sorted(written.collect()) == sorted(df.collect())
