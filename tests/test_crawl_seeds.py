"""Crawls from many seeds of one site, and links that are followed but not returned."""

import random

from pyspark.sql import functions as F

from siteledger.operators import crawl as crawl_module
from siteledger.operators.crawl import crawl
from siteledger.operators.links import page_links
from tests.conftest import rows

SITE = "https://a.gov"


def plain(graph, seeds, max_depth=None, emit_seed=False):
    """Breadth first from each seed alone."""
    out = []
    for seed in set(seeds):
        depth, seen, frontier = 0, {}, [seed]
        read = {seed}
        while frontier and (max_depth is None or depth < max_depth):
            depth += 1
            links = {link for page in frontier for link in graph.get(page, ())}
            for link in links:
                seen.setdefault(link, depth)
            frontier = sorted(links - read)
            read |= links
        if emit_seed:
            seen[seed] = 0
        out += [(seed, url, d) for url, d in seen.items()]
    return sorted(out, key=repr)


def drawn(n=40, seed=2):
    draw = random.Random(seed)
    pages = [f"{SITE}/p{k}" for k in range(n)]
    return {p: draw.sample(pages, draw.choice([0, 1, 2, 2, 3])) for p in pages}


def frames(spark, graph, seeds):
    html = [(url, "".join(f'<a href="{link}">x</a>' for link in links)) for url, links in graph.items()]
    return spark.createDataFrame(html, "url string, html string").repartition(4), spark.createDataFrame([(s,) for s in seeds], "seed_url string")


def test_every_page_a_seed(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(crawl_module, "scratch_path", lambda *_: str(tmp_path / "crawl"))
    graph = drawn(200)
    pages, seeds = frames(spark, graph, [*graph, *graph, f"{SITE}/absent"])
    assert rows(crawl(pages, seeds)) == plain(graph, [*graph, f"{SITE}/absent"])
    written = spark.read.parquet(str(tmp_path / "crawl" / "rounds"))
    a_round = written.groupBy("depth").agg(F.count("*").alias("n"), F.countDistinct("url").alias("pages"))
    words = written.select("word").distinct().count()
    assert words <= 5 and a_round.filter(F.col("n") > F.col("pages") * words).isEmpty()
    assert sum(bin(r.reach & (1 << 64) - 1).count("1") for r in written.filter("depth > 0").collect()) > 3 * written.count()


def test_depth_and_seed_itself(spark):
    graph = drawn()
    pages, seeds = frames(spark, graph, list(graph)[:7])
    for depth, emit in ((1, False), (2, True), (None, True)):
        assert rows(crawl(pages, seeds, depth, emit_seed=emit)) == plain(graph, list(graph)[:7], depth, emit)


def test_no_seeds_and_no_pages(spark):
    pages, seeds = frames(spark, drawn(5), [f"{SITE}/p0"])
    assert crawl(pages, seeds.limit(0)).count() == crawl(pages.limit(0), seeds).count() == 0
    assert crawl(pages, spark.createDataFrame([(None,)], "seed_url string")).count() == 0


def test_areas_and_base_are_followed_and_not_returned(spark):
    pages = [
        (f"{SITE}/", '<map><AREA href="/map" shape=rect></map><a href="/plain">x</a>'),
        (f"{SITE}/map", '<a href="from-map">x</a>'),
        (f"{SITE}/plain", '<base href="/dir/"><a href="sub">x</a><a href="//b.gov/a.gov">x</a>'),
        (f"{SITE}/dir/sub", '<a href="/from-base">x</a>'),
        (f"{SITE}/sub", '<a href="/never">x</a>'),
        (f"{SITE}/from-base", '<base target=x><area href="mailto:x@a.gov"><area href="/file.pdf"><area>'),
    ]
    seeds = spark.createDataFrame([(f"{SITE}/",)], "seed_url string")
    found = crawl(spark.createDataFrame(pages, "url string, html string"), seeds)
    expected = [("/from-base", 3), ("/from-map", 2), ("/plain", 1), ("/sub", 2)]
    assert rows(found.filter(F.col("url").startswith(SITE)), "url", "depth") == [(SITE + p, d) for p, d in expected]


def test_followed_links_of_a_page(spark):
    page = '<base><base href=" https://c.gov/x/y "><base href="/z"><a href=q></a><area href="r?s#t"><a href="#u">'
    frame = spark.createDataFrame([("https://a.gov/b", page), ("https://a.gov/b", "<a href=q>"), (None, page), ("x", None)], "url string, html string")
    found = page_links(frame, followed=True).collect()
    assert [link.url for link in found[0].links] == ["https://a.gov/q"]
    assert [link.raw for link in found[0].followed] == ["https://c.gov/x/q", "https://c.gov/x/r?s#t"]
    assert found[1].followed == found[1].links and found[3].followed is None
