"""J4, G1-G7."""

import random

import pytest
from pyspark.sql import functions as F

from siteledger import schemas
from siteledger.operators import dedupe, hosts
from siteledger.sources.lists import read_suffixes
from tests.conftest import rows

SUFFIXES = [
    ("gov", "plain"), ("us", "plain"), ("fed.us", "plain"), ("com", "plain"), ("uk", "plain"),
    ("ck", "wildcard"), ("www.ck", "exception"), ("kobe.jp", "wildcard"), ("jp", "plain"),
    ("city.kobe.jp", "exception"),
]
# host -> (subdomain, domain, tld)
CASES = {
    "foo.gov": ("", "foo", "gov"),
    "https://www.a.foo.gov/path?q": ("www.a", "foo", "gov"),
    "FOO.gov": ("", "foo", "gov"),
    "x.fed.us": ("", "x", "fed.us"),
    "fed.us": ("", "", "fed.us"),
    "gov": ("", "", "gov"),
    "a.b.unknown": ("a.b", "unknown", ""),
    "localhost": ("", "localhost", ""),
    "10.1.2.3": ("", "10.1.2.3", ""),
    "http://10.1.2.3:80/x": ("", "10.1.2.3", ""),
    "10.1.2.300": ("10.1.2", "300", ""),
    "a.b.ck": ("", "a", "b.ck"),
    "b.ck": ("", "", "b.ck"),
    "x.a.b.ck": ("x", "a", "b.ck"),
    "www.ck": ("", "www", "ck"),
    "a.www.ck": ("a", "www", "ck"),
    "a.b.kobe.jp": ("", "a", "b.kobe.jp"),
    "city.kobe.jp": ("", "city", "kobe.jp"),
    "x.city.kobe.jp": ("x", "city", "kobe.jp"),
    "kobe.jp": ("", "kobe", "jp"),
    "user:pw@foo.gov:8080": ("", "foo", "gov"),
    "foo.gov.": ("", "foo", "gov"),
    "": ("", "", ""),
    "#name?": ("", "", ""),
}


def test_split_host(spark):
    df = spark.createDataFrame([(h,) for h in CASES], "host string")
    suffixes = spark.createDataFrame(SUFFIXES, schemas.SUFFIX)
    got = hosts.split_host(df, "host", suffixes)
    assert {r.host: (r.subdomain, r.domain, r.tld) for r in got.collect()} == CASES


def test_split_host_rejects_unknown_kinds(spark):
    df = spark.createDataFrame([("a.gov",)], "host string")
    suffixes = spark.createDataFrame([("gov", "other")], schemas.SUFFIX)
    with pytest.raises(Exception, match="unknown kind of suffix: other"):
        hosts.split_host(df, "host", suffixes).collect()


def test_split_host_null(spark):
    df = spark.createDataFrame([(None,), ("a.gov",)], "host string")
    got = hosts.split_host(df, "host", hosts.default_suffixes(spark))
    assert rows(got) == [("a.gov", "", "a", "gov"), (None, None, None, None)]


def test_split_is_computed_once_and_replaces_columns(spark):
    df = spark.createDataFrame([("a.gov", "old")], "host string, domain string")
    got = hosts.split_host(df, "host", hosts.default_suffixes(spark)).filter("domain = 'a'")
    assert rows(got, "domain") == [("a",)] and got.columns.count("domain") == 1
    plan = got._jdf.queryExecution().executedPlan().toString()
    # The filter stays above the generator; below it the split would be computed again.
    assert plan.count("Generate inline") == 1


def test_large_suffix_table_is_a_hash_set(spark):
    many = [(f"s{i}", "plain") for i in range(12_000)]
    df = spark.createDataFrame([("a.s7",), ("a.s11999",), ("a.s12000",)], "host string")
    got = hosts.split_host(df, "host", spark.createDataFrame(many, schemas.SUFFIX))
    assert rows(got, "host", "tld") == [("a.s11999", "s11999"), ("a.s12000", ""), ("a.s7", "s7")]


def test_read_suffixes(spark, tmp_path):
    path = tmp_path / "list.dat"
    path.write_text(
        "// comment\n\n// ===BEGIN ICANN DOMAINS===\ngov\nfed.us trailing words\n*.ck\n!www.ck\n"
        "// ===END ICANN DOMAINS===\n// ===BEGIN PRIVATE DOMAINS===\ngithub.io\n"
    )
    public = [("ck", "wildcard"), ("fed.us", "plain"), ("gov", "plain"), ("www.ck", "exception")]
    assert rows(read_suffixes(spark, str(path))) == public
    assert ("github.io", "plain") in rows(read_suffixes(spark, str(path), private=True))


def test_keep_first_is_the_same_for_any_partitioning(spark):
    rng = random.Random(1)
    # One key holds a third of the rows; ties on the order column and NULL keys occur.
    data = [
        (None if i % 10 == 0 else 0 if i % 3 == 0 else rng.randint(1, 50), rng.randint(0, 5), i % 997)
        for i in range(6000)
    ]
    df = spark.createDataFrame(data, "k int, o int, v int")
    expected = sorted(
        {k: min((o, v) for k2, o, v in data if k2 == k) for k in {d[0] for d in data}}.items(), key=repr
    )
    for parts in (1, 4, 50):
        got = dedupe.keep_first(df.repartition(parts), ["k"], ["o"])
        assert sorted(((r.k, (r.o, r.v)) for r in got.collect()), key=repr) == expected
        # Kept rows are rows of the input, and keys are unique.
        assert got.exceptAll(df).count() == 0


def test_keep_first_limits_groups_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "id")
    plan = dedupe.keep_first(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    before = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in before and "Partial" in before


def test_keep_first_except(spark):
    df = spark.createDataFrame(
        [("a", None, "u2", 2), ("a", None, "u1", 1), ("a", "x", "u3", 3)], "p string, q string, url string, n int"
    )
    got = dedupe.keep_first_except(df, "url", ["n"])
    assert rows(got) == [("a", "x", "u3", 3), ("a", None, "u1", 1)]


def test_latest_per_key(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 3, "y"), ("a", None, "z"), ("b", None, "w"), (None, 1, "v")], "k string, ts int, v string"
    )
    assert rows(dedupe.latest_per_key(df, ["k"], "ts"), "k", "v") == [("a", "y"), ("b", "w"), (None, "v")]


def test_map_columns_are_carried(spark):
    df = spark.sql("SELECT 1 AS k, 2 AS o, map('a', 1) AS m UNION ALL SELECT 1, 1, map('b', 2)")
    assert dedupe.keep_first(df, ["k"], ["o"]).first().m == {"b": 2}
