import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from siteledger.operators.records import accessible_share, daily_shares, latest_records, retain
from siteledger.plans.results import backfill_history
from siteledger.sources.history import read_history
from tests.conftest import rows

DAY = dt.date(2024, 3, 1)
SCHEMA = "agency string, organization string, domain string, subdomain string, number_of_errors int, scan_date date, seq int, state string"


def drawn(n=400, seed=5):
    draw = random.Random(seed)
    out = []
    for seq in range(n):
        hot = draw.random() < 0.3
        day = None if draw.random() < 0.03 else DAY + dt.timedelta(days=draw.randrange(40))
        errors = draw.choice([0, 0, 1, 3, None])
        out.append((draw.choice(["a", "b", None]), "o", "hot" if hot else f"d{draw.randrange(15)}", draw.choice(["", "s", None]), errors, day, seq, draw.choice(["x", "y"])))
    return out


def plain(records, group, days, first, last):
    """A snapshot for each day by looking at every record."""
    out = []
    for k in range((last - first).days + 1):
        day = first + dt.timedelta(days=k)
        latest = {}
        for r in sorted((r for r in records if r[5] and day - dt.timedelta(days=days) <= r[5] <= day), key=lambda r: (r[5], r[6])):
            latest[r[:4]] = r
        counts = defaultdict(lambda: [0, 0])
        for r in latest.values():
            if r[4] is not None:
                counts[group(r)][0] += 1
                counts[group(r)][1] += r[4] == 0
        out += [(*g, day, n, good, good / n) for g, (n, good) in counts.items()]
    return sorted(out, key=repr)


@pytest.mark.parametrize("days", [0, 3, 10, 100])
def test_every_day_is_its_snapshot(spark, days):
    records = drawn()
    frame = spark.createDataFrame(records, SCHEMA).repartition(5)
    last = max(r[5] for r in records if r[5]) + dt.timedelta(days=days)
    got = rows(daily_shares(frame, ["agency", "state"], days, ts="seq"))
    assert got == plain(records, lambda r: (r[0], r[7]), days, DAY, last)
    assert rows(daily_shares(frame, (), days, ts="seq")) == plain(records, lambda r: (), days, DAY, last)


def test_first_and_last_day(spark):
    records = drawn()
    frame = spark.createDataFrame(records, SCHEMA)
    first, last = DAY + dt.timedelta(days=7), DAY + dt.timedelta(days=21)
    got = rows(daily_shares(frame, ["agency"], 5, F.lit(first), F.lit(last), ts=["seq"]))
    assert got == plain(records, lambda r: (r[0],), 5, first, last)


def test_equals_the_snapshot_operators(spark):
    frame = spark.createDataFrame(drawn(), SCHEMA)
    day = F.lit(DAY + dt.timedelta(days=15))
    kept = retain(frame, "scan_date", day, 10).filter(F.col("scan_date") <= day)
    once = accessible_share(latest_records(kept, ["scan_date", "seq"]))
    daily = daily_shares(frame, ts="seq", first=day, last=day).drop("snapshot_date")
    assert rows(daily) == rows(once)


def test_no_join_of_days_with_records(spark):
    plan = daily_shares(spark.createDataFrame(drawn(), SCHEMA), ["agency"], ts="seq")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Cartesian" not in plan


def test_no_records(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert daily_shares(empty, ["agency"]).count() == daily_shares(empty).count() == 0


def test_backfill_replaces_days_and_keeps_others(spark, tmp_path):
    frame, path = spark.createDataFrame(drawn(), SCHEMA), str(tmp_path / "history")
    backfill_history(frame, path, last=F.lit(DAY + dt.timedelta(days=3)), ts="seq")
    before = rows(read_history(spark, path))
    backfill_history(frame, path, first=F.lit(DAY + dt.timedelta(days=2)), ts="seq")
    after = rows(read_history(spark, path))
    assert len(before) == 4 and set(before) <= set(after) and len({r[0] for r in after}) == len(after) == 50
