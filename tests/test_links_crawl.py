"""I1, I2, J3, J6, F10-F16."""

import pytest
from pyspark.sql import functions as F

from siteledger.operators import crawl as crawl_op, links
from siteledger.plans.site_map import map_links
from siteledger.session import bucketed
from tests.conftest import rows

H = "https://www.foo.gov"


def page(*hrefs):
    return "<html>" + "".join(f'<a href="{h}">x</a>' for h in hrefs)


def pages_df(spark, pages):
    return spark.createDataFrame(list(pages.items()), "url string, html string")


def test_extract_links(spark):
    html = page(
        "/a", "/a?x=1", "/a#top", "#top", "", "b c", "/doc.PDF", "/doc.pdf?x", "/ships", "/tar.gz",
        "mailto:x@www.foo.gov", "tel:1", "javascript:void(0)", "https://twitter.com/www.foo.gov",
        "//www.foo.gov/p", "../up", "?q=1", "https://other.gov/", "http://www.foo.gov/é",
        "https://archive.gov/www.foo.gov/x", "https://other.gov/?u=www.foo.gov", "/a.tar.gz",
        "https://sub.www.foo.gov/",
    )
    got = links.extract_links(pages_df(spark, {f"{H}/d/e?z=1": html}))
    assert [u for _, u in rows(got)] == sorted([
        f"{H}/a", f"{H}/d/b c", f"{H}/doc.pdf", f"{H}/ships", f"{H}/tar.gz", f"{H}/p", f"{H}/up",
        f"{H}/d/e", "http://www.foo.gov/é", "https://archive.gov/www.foo.gov/x",
        "https://sub.www.foo.gov/",
    ])


def test_extension_rule(spark):
    df = spark.createDataFrame(
        [("https://h/a.pdf",), ("https://h/A.JPG",), ("https://h/ships",), ("https://h/a.tar.gz",),
         ("https://h/a.gz",), ("https://h/pdf",), ("https://h/a.pdf/",)], "u string"
    )
    dotted = df.filter(links.has_ignored_extension(F.col("u")))
    assert rows(dotted) == [("https://h/A.JPG",), ("https://h/a.pdf",), ("https://h/a.tar.gz",)]
    bare = df.filter(links.has_ignored_extension(F.col("u"), compat=True))
    assert ("https://h/ships",) in rows(bare) and ("https://h/pdf",) in rows(bare)


def test_links_need_no_shuffle_and_read_the_source_once(spark, tmp_path):
    path = str(tmp_path / "pages")
    pages_df(spark, {H: page("/a")}).withColumn("unused", F.lit(1)).write.parquet(path)
    got = links.extract_links(spark.read.parquet(path))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
    assert "ReadSchema: struct<url:string,html:string>" in plan
    assert plan.count("<script(?=") + plan.count("|script(?=") == 1


def test_link_messages(spark):
    df = spark.createDataFrame([("https://www.a.foo.gov/x/y",), ("https://foo.gov",)], "url string")
    got = links.link_messages(df, F.lit("Ag"), F.lit(None).cast("string"))
    assert rows(got, "domain", "subdomain", "tld", "routeable_url", "db_id") == [
        ("foo", "", "gov", "https://foo.gov", "Ag++foo++"),
        ("foo", "a", "gov", "https://www.a.foo.gov/x/y", "Ag++foo+a+x/y"),
    ]


def test_unseen_links(spark):
    df = spark.createDataFrame([("a",), ("b",)], "url string")
    assert rows(links.unseen_links(df, spark.createDataFrame([("b",), ("b",)], "url string"))) == [("a",)]


GRAPH = {
    f"{H}/": page("/1", "/", "https://www.foo.gov/1#x", "https://sub.www.foo.gov/", "/f.pdf", "#x"),
    f"{H}/1": page("2", "/", "https://off.gov/www.foo.gov/", "mailto:a@www.foo.gov"),
    f"{H}/2": page("/3?page=2", "/a/b/c/d", "/1"),
    f"{H}/3": page("/4", "//www.foo.gov/5"),
    f"{H}/4": page("/1"),
    f"{H}/5": page("/never"),
    f"{H}/a/b/c/d": page("/toodeep"),
    "https://sub.www.foo.gov/": page("https://www.foo.gov/from-sub"),
    "https://off.gov/www.foo.gov/": page("https://www.foo.gov/from-off"),
    f"{H}/f.pdf": page("/from-pdf"),
    "https://other.gov/": page("/x", "https://www.foo.gov/1"),
}
REACHED = {
    f"{H}/1": 1, f"{H}/": 1, "https://sub.www.foo.gov/": 1,
    f"{H}/2": 2, "https://off.gov/www.foo.gov/": 2, "https://www.foo.gov/from-sub": 2,
    f"{H}/3": 3, f"{H}/a/b/c/d": 3,
    f"{H}/4": 4, f"{H}/5": 4,
    f"{H}/never": 5,
}


@pytest.mark.parametrize("broadcast", ["10485760", "-1"])
def test_crawl(spark, broadcast):
    """Cycles, a page off the site, six slashes, and both join strategies."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        seeds = spark.createDataFrame([(f"{H}",), ("https://other.gov/",)], "seed_url string")
        got = crawl_op.crawl(pages_df(spark, GRAPH), seeds)
        found = {(r.seed_url, r.url): r.depth for r in got.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert {u: d for (s, u), d in found.items() if s == H} == REACHED
    assert {u: d for (s, u), d in found.items() if s != H} == {"https://other.gov/x": 1}
    assert len(found) == len(set(found))


def test_crawl_depth_and_seed(spark):
    seeds = spark.createDataFrame([(f"{H}/",)], "seed_url string")
    pages = pages_df(spark, GRAPH)
    two = crawl_op.crawl(pages, seeds, max_depth=2)
    assert {r.url: r.depth for r in two.collect()} == {u: d for u, d in REACHED.items() if d <= 2}
    with_seed = crawl_op.crawl(pages, seeds, max_depth=1, emit_seed=True)
    assert (f"{H}/", 0) in {(r.url, r.depth) for r in with_seed.collect()}
    none = crawl_op.crawl(pages, seeds, max_depth=0)
    assert none.columns == ["seed_url", "url", "depth"] and none.count() == 0


def test_crawl_again_adds_nothing(spark):
    seeds = spark.createDataFrame([(f"{H}/",)], "seed_url string")
    pages = pages_df(spark, GRAPH)
    once = crawl_op.crawl(pages, seeds)
    again = crawl_op.crawl(pages.unionAll(pages), seeds)
    assert rows(once) == rows(again)


def test_slash_limit(spark):
    df = spark.createDataFrame(
        [("https://h/a/b/c",), ("https://h/a/b/c/d",), ("https://h/a?x=/b/c/d",)], "u string"
    )
    kept = df.filter(crawl_op.may_follow(F.col("u")))
    assert rows(kept) == [("https://h/a/b/c",)]


def test_map_links(spark):
    sites = spark.createDataFrame(
        [("Ag", None, f"{H}/", "www", "foo", "gov")],
        "Agency string, Organization string, routeable_url string, subdomain string, domain string, tld string",
    )
    got = map_links(sites, pages_df(spark, GRAPH))
    assert {r.routeable_url for r in got.collect()} == set(REACHED)
    one = got.filter("routeable_url = 'https://www.foo.gov/a/b/c/d'").first()
    assert one.asDict() == {
        "Agency": "Ag", "Organization": "", "domain": "foo", "subdomain": "", "tld": "gov",
        "routeable_url": f"{H}/a/b/c/d", "db_id": "Ag++foo++a/b/c/d",
    }


def test_bucketed_links_are_not_shuffled(spark, tmp_path):
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    tables = len(spark.catalog.listTables())
    links_by_page = spark.range(500).selectExpr("concat('p', id) AS page", "id")
    wanted = spark.range(3000).selectExpr("concat('p', id % 400) AS page")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with bucketed(links_by_page, str(tmp_path / "graph"), "page") as linked:
            found = linked.join(wanted.distinct(), "page", "left_semi")
            plan = found._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Exchange hashpartitioning") == 1  # of the pages asked for
            assert found.count() == 400
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    assert len(spark.catalog.listTables()) == tables
