"""Receives counted by the stream: T2, T3."""

import json

import pytest

from siteledger.streaming import events, receives, state
from tests.conftest import rows
from tests.test_streaming import KEYS, MESSAGE, message, put

HOUR = 3_600_000
SENT = 1_704_067_200_000  # 2024-01-01


def delivery(*messages):
    """(id, body, sent or None) as an event; the message's own count always says 1."""
    return json.dumps({"Records": [
        {"messageId": name, "body": body if isinstance(body, str) else json.dumps(body),
         "attributes": {"ApproximateReceiveCount": "1", **({"SentTimestamp": str(sent)} if sent is not None else {})}}
        for name, body, sent in messages
    ]})


def run(spark, tmp_path, max_files):
    stream = events.stream_events(spark, str(tmp_path / "in"), MESSAGE, max_files=max_files, sent_at=True)
    return receives.consume_counted(stream, str(tmp_path / "state"), str(tmp_path / "dead"), str(tmp_path / "cp"), KEYS)


@pytest.mark.parametrize("max_files", [1, 2, 100])
def test_any_cut_into_batches(spark, tmp_path, max_files):
    a, b = ("1", message("a", 1, 3), SENT), ("2", message("b", 0, 3), SENT + HOUR)
    torn, undated = ("3", "{torn", SENT), ("4", message("d", 2, 4), None)
    for k, found in enumerate([(a, b), (a,), (torn, undated), (undated,), (a, undated), (b,)]):
        put(tmp_path, f"{k}.json", delivery(*found))
    run(spark, tmp_path, max_files)
    current = state.read_latest(spark, str(tmp_path / "state"), MESSAGE, KEYS)
    assert rows(current, "domain", "number_of_errors") == [("a", 1), ("b", 0), ("d", 2)]
    dead = receives.read_counted(spark, str(tmp_path / "dead"))
    assert rows(dead, "message_id", "receive_count") == [("1", 3), ("3", 1), ("4", 3)]

    put(tmp_path, "x.json", delivery(b))  # the third receive comes in a later run
    run(spark, tmp_path, max_files)
    assert rows(receives.read_counted(spark, str(tmp_path / "dead")), "message_id", "receive_count")[1] == ("2", 3)
    assert state.read_latest(spark, str(tmp_path / "state"), MESSAGE, KEYS).count() == 3


def test_counts_expire_behind_the_watermark(spark, tmp_path):
    early, late = ("1", message("a", 1, 3), SENT), ("2", message("b", 0, 3), SENT + 30 * 24 * HOUR)
    states = []
    for k, found in enumerate([(early,), (late,), (late,), (early,)]):
        put(tmp_path, f"{k}.json", delivery(*found))
        states += [p["stateOperators"][0] for p in run(spark, tmp_path, 1).recentProgress if p["stateOperators"]]
    assert states[-1]["numRowsTotal"] == 1  # only the late message is still counted
    assert sum(s["numRowsDroppedByWatermark"] for s in states) > 0
    assert state.read_latest(spark, str(tmp_path / "state"), MESSAGE, KEYS).count() == 2
