"""B1, B2, P11, P12, S3, S11, F18."""

import json

import pytest
from pyspark.sql import functions as F

from siteledger import schemas
from siteledger.functions.messages import message_body
from siteledger.operators import batching, events
from siteledger.plans.dispatch import dispatch
from siteledger.sources import lists, messages
from tests.conftest import rows


def bodies(df):
    return [
        [(e.Id, e.MessageBody) for e in r.entries] for r in df.orderBy("batch_id").collect()
    ]


def test_pairs(spark):
    got = batching.batch_rows(spark.range(10).repartition(3), 2, ["id"], F.col("id"))
    assert [[int(b) for _, b in batch] for batch in bodies(got)] == [
        [0, 1], [2, 3], [4, 5], [6, 7], [8, 9],
    ]


def test_short_tail_and_filter_after_the_cut(spark):
    df = spark.range(25)
    got = batching.batch_rows(df, 10, ["id"], F.col("id"), F.col("id") % 10 >= F.when(F.col("id") < 10, 10).otherwise(3))
    # The first batch is empty and vanishes; ids count the entries that are kept.
    assert bodies(got) == [
        [(str(i), str(v)) for i, v in enumerate(range(13, 20))],
        [("0", "23"), ("1", "24")],
    ]


@pytest.mark.parametrize("parts", [1, 7])
def test_row_index_partitions_the_input(spark, parts):
    # A hot value with ties, and identical rows.
    df = spark.range(3000).selectExpr("IF(id % 3 = 0, 0, id) AS k", "id % 5 AS v").repartition(parts)
    got = batching.with_row_index(df, ["k"]).collect()
    assert sorted(r.row_index for r in got) == list(range(3000))
    ordered = sorted(got, key=lambda r: r.row_index)
    assert [(r.k, r.v) for r in ordered] == sorted((r.k, r.v) for r in got)


def test_empty_bodies_are_dropped(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, ""), (4, "b")], "i int, v string")
    assert bodies(batching.batch_rows(df, 10, ["i"], F.col("v"))) == [[("0", "a"), ("1", "b")]]


def test_message_body_keeps_nulls(spark):
    df = spark.createDataFrame([("x", None, 'é"')], "`Domain Type` string, b string, c string")
    text = df.select(message_body(df.columns).alias("m")).first().m
    assert json.loads(text) == {"Domain Type": "x", "b": None, "c": 'é"'}


EVENT = json.dumps({
    "Records": [{
        "messageId": "m1", "receiptHandle": "h",
        "body": json.dumps({
            "Domain Type": "T", "Agency": "Test Agency", "Organization": "Test Org",
            "routeable_url": "https://www.example.com/", "subdomain": "", "domain": "example",
            "tld": "com",
        }),
        "attributes": {"ApproximateReceiveCount": "1", "SentTimestamp": "1545082649183"},
    }]
}, indent=2)


def test_from_events(spark):
    two = json.dumps({"Records": [{"messageId": "a", "body": '{"domain": "x"}'}, {"messageId": "b", "body": "{bad"}]})
    df = spark.createDataFrame(
        [(EVENT,), (two,), ("no json",), ('{"Records": []}',), ('{"Records": [{"messageId": "c"}]}',),
         ('{"Records": [{"messageId": "d", "body": "[1]"}]}',)],
        "value string",
    )
    got = events.from_events(df)
    assert rows(got, "message_id", "domain", "bad") == [
        ("a", "x", False), ("b", None, True), ("c", None, True), ("d", None, True),
        ("m1", "example", False), (None, None, True), (None, None, True),
    ]
    first = got.filter("message_id = 'm1'").first()
    assert (first.Agency, first.receive_count, first.tld) == ("Test Agency", 1, "com")


def test_link_form_of_an_event(spark):
    body = json.dumps({"Agency": "A", "db_id": "1", "domain": "example", "tld": "com"})
    df = spark.createDataFrame([(json.dumps({"Records": [{"body": body}]}),)], "value string")
    got = events.from_events(df, schemas.LINK_MESSAGE).first()
    assert (got.Agency, got.db_id, got.subdomain, got.bad) == ("A", "1", None, False)


def test_dispatch_from_a_file(spark, tmp_path):
    path = str(tmp_path / "sites.csv")
    header = "Domain Type,Agency,Organization,routeable_url,subdomain,domain,tld\n"
    with open(path, "w") as f:
        f.write(header)
        for i in range(23):
            kind = "Federal Agency - Executive" if i % 2 else "Federal Agency - Judicial"
            f.write(f'{kind} ,"A, ""q""",O,https://s{i}.gov/,,s{i},gov\n\n')
    inventory = lists.read_inventory(spark, path)
    assert inventory.count() == 23
    got = bodies(dispatch(inventory))
    sites = [[json.loads(b)["domain"] for _, b in batch] for batch in got]
    assert sites == [
        ["s1", "s3", "s5", "s7", "s9"], ["s11", "s13", "s15", "s17", "s19"], ["s21"],
    ]
    assert json.loads(got[0][0][1])["Agency"] == 'A, "q"'
    assert len(bodies(dispatch(inventory, domain_type=None))[0]) == 10


def test_to_messages_and_back(spark, tmp_path):
    df = spark.createDataFrame([("a", None), ("b", "x")], "domain string, Agency string")
    sent = events.to_messages(df)
    assert {r.Id for r in sent.collect()} == {"1"}
    batches = batching.batch_rows(df, 10, ["domain"], message_body(df.columns))
    path = str(tmp_path / "batches")
    messages.write_batches(batches, path)
    text = json.loads(spark.read.text(path).first().value)
    assert [json.loads(e["MessageBody"]) for e in text["Entries"]] == [
        {"domain": "a", "Agency": None}, {"domain": "b", "Agency": "x"},
    ]
    back = events.from_events(messages.batches_to_events(batches))
    assert rows(back, "domain", "Agency") == [("a", None), ("b", "x")]
