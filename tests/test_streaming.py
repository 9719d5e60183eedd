"""T1-T4."""

import json

from pyspark.sql import functions as F, types as T

from siteledger.operators.records import accessible_share
from siteledger.sources.history import read_history
from siteledger.streaming import events, state
from tests.conftest import rows

MESSAGE = T.StructType([
    T.StructField("agency", T.StringType()),
    T.StructField("domain", T.StringType()),
    T.StructField("number_of_errors", T.IntegerType()),
    T.StructField("scan_ts", T.StringType()),
    T.StructField("scan_date", T.DateType()),
])
KEYS = ["agency", "domain"]


def event(*messages, received=1):
    return json.dumps({"Records": [
        {"messageId": m.get("domain", "?") if isinstance(m, dict) else "bad",
         "body": json.dumps(m) if isinstance(m, dict) else m,
         "attributes": {"ApproximateReceiveCount": str(received)}}
        for m in messages
    ]}, indent=2)


def message(domain, errors, day):
    return {"agency": "A", "domain": domain, "number_of_errors": errors,
            "scan_ts": f"2024-01-{day:02}T00:00:00", "scan_date": f"2024-01-{day:02}"}


def run(spark, tmp_path, max_files=None):
    stream = events.stream_events(spark, str(tmp_path / "in"), MESSAGE, max_files=max_files)
    state.consume(stream, str(tmp_path / "state"), str(tmp_path / "dead"), str(tmp_path / "cp"), KEYS)


def current(spark, tmp_path, **kw):
    return state.read_latest(spark, str(tmp_path / "state"), MESSAGE, KEYS, **kw)


def put(tmp_path, name, text):
    (tmp_path / "in").mkdir(exist_ok=True)
    (tmp_path / "in" / name).write_text(text)


def test_intake(spark, tmp_path):
    put(tmp_path, "1.json", event(message("a", 1, 3), message("b", 0, 3)))
    put(tmp_path, "2.json", event(message("a", 1, 3)))          # delivered twice
    put(tmp_path, "3.json", event("{torn", message("c", 0, 4)))  # one bad body of two
    put(tmp_path, "4.json", "no event")
    put(tmp_path, "5.json", event(message("d", 0, 4), received=3))
    run(spark, tmp_path, max_files=1)
    assert rows(current(spark, tmp_path), "domain", "number_of_errors") == [("a", 1), ("b", 0), ("c", 0)]

    put(tmp_path, "6.json", event(message("a", 0, 5)))           # newer
    put(tmp_path, "7.json", event(message("b", 9, 1)))           # late and older
    run(spark, tmp_path)
    assert rows(current(spark, tmp_path), "domain", "number_of_errors") == [("a", 0), ("b", 0), ("c", 0)]

    dead = spark.read.option("basePath", str(tmp_path / "dead")).parquet(str(tmp_path / "dead" / "batch=*"))
    assert rows(dead, "message_id", "receive_count") == [("bad", 1), ("d", 3), (None, None)]
    kept = events.read_dead_letters(spark, str(tmp_path / "dead"), F.current_date())
    assert kept.count() == 3 and "ingest_date" in kept.columns
    late = events.read_dead_letters(spark, str(tmp_path / "dead"), F.date_add(F.current_date(), 7))
    assert late.count() == 0

    run(spark, tmp_path)  # nothing new
    assert current(spark, tmp_path).count() == 3


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "state")
    batch = spark.createDataFrame([("A", "a", 1, "2024-01-01", None)], MESSAGE).withColumn("scan_date", F.lit("2024-01-01").cast("date"))
    for _ in range(2):
        state.upsert_latest(batch, path, 0, KEYS)
    assert spark.read.parquet(path).count() == 1


def test_stream_equals_batch(spark, tmp_path):
    messages = [message(f"d{i % 7}", i % 3, 1 + i % 20) for i in range(60)]
    for i in range(0, 60, 6):
        put(tmp_path, f"{i}.json", event(*messages[i:i + 6]))
    run(spark, tmp_path, max_files=3)
    latest = {}
    for m in messages:
        old = latest.get(m["domain"])
        if old is None or m["scan_ts"] > old["scan_ts"]:
            latest[m["domain"]] = m
    got = {r.domain: r.scan_ts for r in current(spark, tmp_path).collect()}
    assert got == {d: m["scan_ts"] for d, m in latest.items()}


def test_snapshot_retention_and_compaction(spark, tmp_path):
    put(tmp_path, "1.json", event(message("a", 0, 1), message("b", 0, 12), message("c", 2, 20)))
    run(spark, tmp_path)
    as_of = F.lit("2024-01-22")
    share = state.snapshot(spark, str(tmp_path / "state"), MESSAGE, str(tmp_path / "hist"), as_of, keys=KEYS).first()
    assert (share.n_records, share.accessible_share) == (2, 0.5)  # a is too old
    assert [(str(d), s) for d, s in rows(read_history(spark, str(tmp_path / "hist")))] == [("2024-01-22", 0.5)]
    state.compact(spark, str(tmp_path / "state"), str(tmp_path / "new"), MESSAGE, KEYS, as_of=as_of)
    after = state.read_latest(spark, str(tmp_path / "new"), MESSAGE, KEYS)
    assert rows(after, "domain") == [("b",), ("c",)]
    assert accessible_share(after).first().n_records == 2


def test_compaction_while_messages_arrive(spark, tmp_path):
    path = str(tmp_path / "state")

    def compact(**kw):
        return state.compact_in_place(spark, path, MESSAGE, KEYS, **kw)

    for i in range(3):
        put(tmp_path, f"{i}.json", event(message("a", i, 1 + i), message(f"d{i}", 0, 2)))
        run(spark, tmp_path)
    before = rows(current(spark, tmp_path), "domain", "number_of_errors")
    assert before == [("a", 2), ("d0", 0), ("d1", 0), ("d2", 0)]
    assert compact() == 1  # the newest batch is left
    assert rows(current(spark, tmp_path), "domain", "number_of_errors") == before
    assert compact() == 1  # nothing new
    # a compaction that did not come to its version is not read
    spark.createDataFrame([("A", "z", 1, "2024-01-09", None)], MESSAGE).write.parquet(f"{path}/compacted/upto=2")
    assert rows(current(spark, tmp_path), "domain", "number_of_errors") == before
    put(tmp_path, "3.json", event(message("a", 7, 9), message("d0", 5, 1)))
    run(spark, tmp_path)
    assert compact() == 2
    after = [("a", 7), ("d0", 0), ("d1", 0), ("d2", 0)]
    assert rows(current(spark, tmp_path), "domain", "number_of_errors") == after
    assert compact(upto=3, as_of=F.lit("2024-01-12"), days=5) == 3
    assert rows(current(spark, tmp_path), "domain", "number_of_errors") == [("a", 7)]
