"""URL expressions: P3-P5, P13-P18."""

import random
from urllib.parse import urljoin, urlsplit

import pytest
from pyspark.sql import functions as F

from siteledger.functions import urls


def evaluate(spark, fn, values):
    """``fn`` applied to columns a, b, ... of one row per value, in order."""
    width = len(values[0])
    names = [chr(ord("a") + i) for i in range(width)]
    schema = "i int, " + ", ".join(f"{n} string" for n in names)
    df = spark.createDataFrame([(i, *v) for i, v in enumerate(values)], schema)
    out = df.select("i", fn(*[F.col(n) for n in names]).alias("x")).collect()
    return [r.x for r in sorted(out, key=lambda r: r.i)]


# The nine published split cases.
@pytest.mark.parametrize(
    "url, expected",
    [
        ("https://www.foo.gov", ("foo", "", "")),
        ("https://www.bar.foo.gov", ("foo", "bar", "")),
        ("https://www.fiz.bar.foo.gov", ("foo", "fiz.bar", "")),
        ("https://www.foo.gov/baz", ("foo", "", "baz")),
        ("https://www.foo.gov/baz/biz", ("foo", "", "baz/biz")),
        ("https://www.bar.foo.gov/baz/biz", ("foo", "bar", "baz/biz")),
        ("https://www.fiz.foo.gov/bar", ("foo", "fiz", "bar")),
        ("https://foo.gov", ("foo", "", "")),
        ("https://bar.foo.gov", ("foo", "bar", "")),
    ],
)
def test_site_parts(spark, url, expected):
    assert tuple(evaluate(spark, urls.site_parts, [(url,)])[0]) == expected


def test_site_parts_edges(spark):
    got = evaluate(
        spark,
        urls.site_parts,
        [
            ("https://www.a.www.foo.gov/",),
            ("https://foo.gov:8080/x;v=1?q#f",),
            ("https://foo.com/x",),
            ("/relative",),
        ],
    )
    assert [tuple(g) for g in got] == [
        ("foo", "a.www", ""),  # only the first www goes
        ("foo", "", "x"),
        ("com", "foo", "x"),  # without the suffix the last label is taken
        ("", "", "relative"),
    ]


BASES = [
    "https://h.gov",
    "https://h.gov/",
    "https://h.gov/a/b/c",
    "https://h.gov/a/b/?q=1#f",
    "http://u@h.gov:8080/a//b/index.html?x=/y",
    "https://h.gov/a b/é/page",
]
REFERENCES = [
    "x", "x/y", "./x", "../x", "../../x", "../../../x", "x/../y", "x/./y", "x/..", "x/.", ".",
    "..", "./", "../", "/", "/x", "/x/../y", "/./x", "/../x", "/x//y", "//o.gov", "//o.gov/p/../q",
    "?q=2", "#top", "x?y=/../z", "x#y/../z", "/x?a=./b", "x y", "é/ü", "https://o.gov/a/../b",
    "http://o.gov", "mailto:a@b.gov", "tel:123", "javascript:void(0)", "a:b", "a/b:c", "x//y",
    "/a/b/../../../c", "https:x", "https:/x", "http:y", "...", "x.../y", ".hidden", "/.well/x",
]


def as_reference(base, href):
    # The library drops an empty query or fragment; both are cut from links anyway.
    return urljoin(base, href).rstrip("?#")


def test_resolve_url_against_the_standard_library(spark):
    pairs = [(b, r) for b in BASES for r in REFERENCES]
    got = evaluate(spark, urls.resolve_url, pairs)
    wrong = [
        (p, g, as_reference(*p))
        for p, g in zip(pairs, got)
        if g.rstrip("?#") != as_reference(*p)
    ]
    assert wrong == []


def test_empty_query_is_the_same_page(spark):
    # An empty query replaces the query of the page; cut as a link, both are one address.
    got = evaluate(spark, lambda b, r: urls.clean_url(urls.resolve_url(b, r)), [(BASES[3], "?")])
    assert got == [urljoin(BASES[3], "?").split("?")[0]]


def test_resolve_url_random_paths(spark):
    rng = random.Random(7)
    parts = ["", ".", "..", "a", "b.c", "..d", "e f"]
    pairs = [
        (rng.choice(BASES), "/".join(rng.choices(parts, k=rng.randint(1, 6))))
        for _ in range(1500)
    ]
    pairs = [(b, r.strip()) for b, r in pairs if r.strip() and not r.startswith("//")]
    got = evaluate(spark, urls.resolve_url, pairs)
    assert [g for g in zip(pairs, got) if g[1] != urljoin(*g[0])] == []


def test_clean_url_and_netloc(spark):
    values = [("https://h.gov/a?b#c",), ("https://h.gov/a#c?b",), ("/x?y",), ("https://u@h.gov:1/é",)]
    assert evaluate(spark, urls.clean_url, values) == [
        "https://h.gov/a", "https://h.gov/a", "/x", "https://u@h.gov:1/é",
    ]
    assert evaluate(spark, urls.netloc, values) == [urlsplit(v[0]).netloc for v in values]
    assert evaluate(spark, urls.host_of, values + [("H.gov.",), ("[::1]:80",)]) == [
        "h.gov", "h.gov", "", "h.gov", "H.gov", "[::1]",
    ]


def test_join_host_and_scheme(spark):
    values = [("www", "foo", "gov"), ("", "foo", "gov"), (None, "foo", "gov"), ("foo", "foo", "gov")]
    assert evaluate(spark, urls.join_host, values) == [
        "www.foo.gov", "foo.gov", "foo.gov", "foo.gov",
    ]
    assert evaluate(spark, urls.full_host, values) == [
        "www.foo.gov", "foo.gov", "foo.gov", "foo.foo.gov",
    ]
    assert evaluate(
        spark, urls.with_scheme, [("a.gov",), ("http://a.gov",), ("https://a.gov",), ("ftp://a",)]
    ) == ["https://a.gov", "http://a.gov", "https://a.gov", "https://ftp://a"]


def test_keys(spark):
    assert evaluate(spark, urls.composite_id, [("a", None, "d", "", "p/q")]) == ["a++d++p/q"]
    assert evaluate(spark, urls.record_key, [("a", "o", "d", ""), ("a", "o", "d", None), ("a", "o", "d", "s")]) == [
        "a/o/d", "a/o/d", "a/o/d/s",
    ]
