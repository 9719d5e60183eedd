"""Text and HTML expressions: P1, P7, P8, P10, P11, P19-P21, P25."""

import html as html_lib
import json
import random
from html.parser import HTMLParser

from pyspark.sql import functions as F

from siteledger.functions import html, messages, text
from tests.test_urls import evaluate


def test_strip_like_python(spark):
    values = [" a ", "\t\na\r\n", "  a\x1f", "　a b ", "", "  "]
    assert evaluate(spark, text.strip, [(v,) for v in values]) == [v.strip() for v in values]
    assert evaluate(spark, text.clean_host_text, [(" FOO.Gov\t",)]) == ["foo.gov"]


def test_title_case_like_python(spark):
    values = [
        "R&D-TEAM O'NEIL", "ECONOMIC DEVELOPMENT ADMINISTRATION", "a1b2c", "x.y_z", "éCOLE d'été",
        "STEERING COMMITTEE (IT)", "",
    ]
    assert evaluate(spark, text.title_case, [(v,) for v in values]) == [v.title() for v in values]


def test_www(spark):
    values = [("www",), ("www.foo",), ("www2.foo",), ("foo.www.bar",), ("",)]
    assert evaluate(spark, text.blank_bare_www, values) == ["", "www.foo", "www2.foo", "foo.www.bar", ""]
    assert evaluate(spark, text.drop_www_prefix, values) == ["www", "foo", "www2.foo", "foo.www.bar", ""]
    assert evaluate(spark, lambda c: text.drop_www_prefix(c, compat=True), values) == [
        "www", "foo", ".foo", "foo.bar", "",
    ]


def tags(spark, page, name="a", attr="href"):
    found = F.transform(
        html.start_tags(html.visible_markup(F.col("a")), name),
        lambda a: html.decode_entities(html.attribute(a, attr)),
    )
    return evaluate(spark, lambda a: F.to_json(F.struct(found.alias("x")), {"ignoreNullFields": "false"}), [(page,)])[0]


def test_hrefs(spark):
    page = """<a href="/1">x</a><A HREF='/2' class=x>y</A><a class="a > b" href=/3>z</a>
    <a title="href='/no'" href="/4?a=1&amp;b=2">q</a><abbr href="/no">n</abbr><a name="x">no</a>
    <!-- <a href="/no"> --><script>var s = '<a href="/no">';</script><style><a href="/no"></style>
    <a data-href="/no" href = "/5"/><a href="">e</a><a
    href="/6">multi</a><a href>none</a><a href="/open"""
    assert tags(spark, page) == (
        '{"x":["/1","/2","/3","/4?a=1&b=2",null,"/5","",'.replace('null,', 'null,')
        + '"/6",null]}'
    )


def test_long_and_broken_markup_does_not_overflow(spark):
    long_tag = "<a " + 'x="1" ' * 50_000 + 'href="/end">'
    quotes = "<a href='" + "'\"" * 50_000
    assert tags(spark, long_tag) == '{"x":["/end"]}'
    assert tags(spark, quotes) == '{"x":[]}'
    assert tags(spark, "<!-- never closed " + "<a href='/x'>" * 10_000) == '{"x":[]}'


def test_entities(spark):
    values = [
        "a&amp;b", "&#38;&#x26;&#X26;", "&lt;&gt;&quot;&apos;", "&eacute;&copy;", "&unknown; & &;",
        "&#233;&#x1F600;", "no reference", "x&ampy", "&", "&&amp;&", "a;b&amp;c;d",
    ]
    expected = [
        html_lib.unescape(v) if v not in ("x&ampy",) else v for v in values
    ]
    assert evaluate(spark, html.decode_entities, [(v,) for v in values]) == expected
    # Code points that do not exist become the replacement character and fail no task.
    assert evaluate(spark, html.decode_entities, [("&#0;&#xD800;&#x110000;&#9999999;",)]) == ["�" * 4]


def test_attribute_presence(spark):
    values = [
        ("alt",), ('alt=""',), ('src="a" alt',), ('src="alt"',), ("data-alt=1",), ('title="x alt y"',),
    ]
    values = [(" " + v[0] + ">",) for v in values] + [(' "stray" alt>',), (" x=1'y' alt>",)]
    assert evaluate(spark, lambda a: html.has_attribute(a, "alt"), values) == [
        True, True, True, False, False, False, True, True,
    ]
    values = [(' lang="en"',), (" lang=' '",), (" lang=''",), (" lang=de",), (" lang",), (" xlang=x",)]
    assert evaluate(spark, lambda a: html.has_text(a, "lang"), values) == [
        True, False, False, True, False, False,
    ]


def test_issue_count(spark):
    values = [
        ('{"issues":[{"code":"a"},{"code":"b"}]}',), ('{"issues":[]}',), ('{"documentTitle":"x"}',),
        ("not json",), (None,), ("[1]",),
    ]
    assert evaluate(spark, messages.issue_count, values) == [2, 0, 0, None, None, None]


class Anchors(HTMLParser):
    """The hrefs of a page by the standard library's parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.found = []

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            values = [v for k, v in attrs if k == "href"]
            self.found.append((values[0] or "") if values else None)


def random_page(rng):
    def attr():
        name = rng.choice(["href", "HREF", "class", "data-href", "title", "hreflang", "disabled", "x:href"])
        value = rng.choice(["/a", "/b?x=1&amp;y=2", "a b", "x > y", "&#233;", "href=/no", "", "é", "/p;q", "//h/p", "a=b"])
        space = rng.choice(["", " ", "\n"])
        form = rng.choice(['"', "'", "bare", "none"])
        if form == "none":
            return name
        if form == "bare":
            return f"{name}{space}={space}{value.replace(' ', '_').replace('>', '') or 'v'}"
        return f"{name}{space}={space}{form}{value}{form}"

    def tag():
        name = rng.choice(["a", "A", "abbr", "p", "area"])
        attrs = "".join(rng.choice([" ", "\n", "\t "]) + attr() for _ in range(rng.randint(0, 4)))
        return f"<{name}{attrs}{rng.choice(['', ' ', ' /'])}>"

    pieces = [
        tag, tag, tag, lambda: "text & <3 ", lambda: "</a>", lambda: f"<!-- {tag()} -->",
        lambda: f"<script>{tag()}</script>", lambda: f"<style>{tag()}</style >", lambda: "<br/>",
    ]
    return "".join(rng.choice(pieces)() for _ in range(rng.randint(1, 12)))


def test_hrefs_of_random_pages_like_the_standard_parser(spark):
    rng = random.Random(11)
    pages = [random_page(rng) for _ in range(3000)]

    def hrefs(c):
        return F.to_json(
            F.transform(
                html.start_tags(html.visible_markup(c), "a"),
                lambda a: html.decode_entities(html.attribute(a, "href")),
            ),
            {"ignoreNullFields": "false"},
        )

    wrong = []
    for page, got in zip(pages, evaluate(spark, hrefs, [(p,) for p in pages])):
        parser = Anchors()
        parser.feed(page)
        parser.close()
        # A href without a value is as good as none: neither gives a link.
        if [v or "" for v in json.loads(got)] != [v or "" for v in parser.found]:
            wrong.append((page, got, parser.found))
    assert wrong == [], wrong[:3]
