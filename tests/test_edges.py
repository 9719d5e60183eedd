"""Ordinary input that the supplied tables do not hold."""

from pyspark.sql import functions as F

from siteledger import schemas
from siteledger.functions.html import decode_entities
from siteledger.functions.urls import resolve_url
from siteledger.operators.routes import resolve_routes
from siteledger.sources.files import list_files
from siteledger.sources.lists import read_inventory, write_inventory


def test_references_of_any_length(spark):
    texts = {
        "a&#000000038;b": "a&b",
        "a&#x00000026;b": "a&b",
        "&#0;": "�",
        "&#99999999999999999999;": "�",
        "&#xFFFFFFFFFF;": "�",
        "&#x1F600;": "\U0001f600",
        "&#128512;": "\U0001f600",
        "&#38": "&#38",
    }
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", decode_entities(F.col("t")).alias("d"))
    assert {r.t: r.d for r in got.collect()} == texts


def test_scheme_of_the_page_is_folded(spark):
    df = spark.createDataFrame([("https://a.gov/x", "HTTPS://a.gov/y"), ("https://a.gov/x", "https://a.gov/y")], "base string, href string")
    got = df.select(resolve_url(F.col("base"), F.col("href")).alias("u")).distinct().collect()
    assert [r.u for r in got] == ["https://a.gov/y"]


def test_prefix_with_glob_characters(spark, tmp_path):
    for name in ("a[1].json", "a1.json", "b{x}*.json"):
        (tmp_path / name).write_text("{}")
    assert list_files(spark, str(tmp_path), "a[1]").count() == 1
    assert list_files(spark, str(tmp_path), "b{x}*").count() == 1


def test_repeated_probes_without_a_time(spark):
    candidates = spark.createDataFrame([("a.gov", 0, "https://a.gov")], "site string, rank int, candidate_url string")
    log = spark.createDataFrame(
        [("https://a.gov", "response", 200, "https://a.gov/"), ("https://a.gov", "error", None, None), ("https://a.gov", "response", 500, "https://z")],
        "candidate_url string, outcome string, status int, final_url string",
    )
    assert [r.routeable_url for r in resolve_routes(candidates, log, "site").collect()] == ["https://a.gov/"]


def test_quoted_line_breaks(spark, tmp_path):
    names = schemas.INVENTORY.names
    row = tuple("two\nlines" if n == "Organization" else "x" for n in names)
    frame = spark.createDataFrame([row], ", ".join(f"`{n}` string" for n in names))
    write_inventory(frame, str(tmp_path / "inventory"))
    got = read_inventory(spark, str(tmp_path / "inventory")).select(*[f"`{n}`" for n in names]).collect()
    assert [tuple(r) for r in got] == [row]
