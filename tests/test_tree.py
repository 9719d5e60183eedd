import random
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from siteledger.functions import tree
from siteledger.functions.html import visible_markup
from siteledger.operators.scan import RULES, explode_issues, scan_pages
from siteledger.operators.tree_scan import scan_trees
from tests.conftest import rows


def nodes(spark, *pages):
    frame = spark.createDataFrame(list(enumerate(pages)), "k int, html string")
    found = frame.select("k", tree.element_tree(visible_markup(F.col("html"))).alias("n")).orderBy("k").collect()
    return [r.n for r in found]


class Plain(HTMLParser):
    """The same closing rules over the standard library's tags, with a list as stack."""

    def __init__(self):
        super().__init__()
        self.nodes, self.stack, self.top = [], [], 0

    def handle_starttag(self, tag, attrs):
        ends = next((ends for starts, ends in tree.IMPLIED_ENDS if tag in starts), ())
        while self.stack and self.nodes[self.stack[-1]]["name"] in ends:
            self.stack.pop()
        parent = self.stack[-1] if self.stack else -1
        if parent >= 0:
            self.nodes[parent]["children"] += 1
            nth = self.nodes[parent]["children"]
        else:
            self.top += 1
            nth = self.top
        self.nodes.append({"name": tag, "parent": parent, "depth": len(self.stack), "nth": nth, "children": 0, "text": False})
        if tag in tree.VOID:
            if tag == "img" and (dict(attrs).get("alt") or "").strip():
                self.mark()
                self.nodes[-1]["text"] = True
        else:
            self.stack.append(len(self.nodes) - 1)

    handle_startendtag = handle_starttag

    def handle_endtag(self, tag):
        names = [self.nodes[k]["name"] for k in self.stack]
        if tag not in names:
            return
        at = len(names) - 1 - names[::-1].index(tag)
        cells = [k for k, n in enumerate(names) if n in ("td", "th", "table")]
        if tag in tree.TABLE_PARTS or not cells or at >= cells[-1]:
            del self.stack[at:]

    def mark(self):
        for k in self.stack:
            self.nodes[k]["text"] = True

    def handle_data(self, data):
        if data.strip():
            self.mark()


def plain(page):
    parser = Plain()
    parser.feed(page)
    parser.close()
    return [tuple(n.values()) for n in parser.nodes]


def drawn(draw):
    tags = ["div", "p", "ul", "li", "table", "tr", "td", "th", "form", "h1", "b", "a", "section", "select", "option", "dl", "dt", "dd", "tbody"]
    out = []
    for _ in range(draw.randint(0, 40)):
        kind = draw.random()
        tag = draw.choice(tags)
        out.append(f"<{tag} class='c'>" if kind < 0.45 else f"</{tag}>" if kind < 0.75 else draw.choice(["text", " ", "\n", "<br>", '<img alt="x">', "<img alt=''>", "<hr/>", "&nbsp;"]))
    return "".join(out)


@pytest.mark.parametrize("chunk", [3, 128])
def test_drawn_markup(spark, monkeypatch, chunk):
    monkeypatch.setattr(tree, "CHUNK", chunk)
    draw = random.Random(8)
    pages = [drawn(draw) for _ in range(120)]
    for page, found in zip(pages, nodes(spark, *pages), strict=True):
        assert [(n.name, n.parent, n.depth, n.nth, n.children, n.text) for n in found] == plain(page), page
        assert [n.pos for n in found] == list(range(len(found)))


def test_selectors_and_places(spark):
    (found,) = nodes(spark, '<html><head><title>t</title><body><div id="m"><ul><li>a<li><a href=x>b</a></ul><label>n <input></label></div><table><tr><td><b>c</b></table>')
    path = {n.name: n.selector for n in found}
    assert path["a"] == "#m > ul:nth-child(1) > li:nth-child(2) > a:nth-child(1)"
    assert path["b"] == "html > body > table:nth-child(2) > tr:nth-child(1) > td:nth-child(1) > b:nth-child(1)"
    by = {n.name: n for n in found}
    assert by["input"].label and not by["a"].label and by["b"].table == by["table"].pos and by["a"].table == -1


def test_pages_without_elements(spark):
    assert nodes(spark, None, "", "only text", "</p></div>", "<", "<!doctype html>", "<p") == [None, [], [], [], [], [], []]


def test_long_page(spark):
    page = "<ul>" + "<li>x" * 5_000 + "</ul>" + "<div>" * 60 + "</div>" * 60
    (found,) = nodes(spark, page)
    assert len(found) == 1 + 5_000 + 60 and found[5_000].selector == "ul:nth-child(1) > li:nth-child(5000)" and found[-1].depth == 59


# (page, rule's technique, selectors) of what needs the tree
CASES = [
    ("<fieldset><legend>l</legend><input title=t></fieldset><fieldset><div><legend>l</legend></div></fieldset>", "H71.NoLegend", ["fieldset:nth-child(2)"]),
    ("<fieldset><legend> </legend></fieldset>", "H71.NoLegend", ["fieldset:nth-child(1)"]),
    ("<table><tr><th id=a>1<th id=b>2<tr><td headers='a b'>3<td headers=c>4</table><table><tr><td headers=a>5</table>", "H43.IncorrectAttr",
     ["table:nth-child(1) > tr:nth-child(2) > td:nth-child(2)", "table:nth-child(2) > tr:nth-child(1) > td:nth-child(1)"]),
    ("<h1>t</h1><h2><span> </span></h2><h3><img alt=i></h3><div><h4>&nbsp;</div>", "H42.2", ["h2:nth-child(2)", "div:nth-child(4) > h4:nth-child(1)"]),
    ("<label>n<div><input></div></label><input><label for=q>l</label><input id=q>", "H44", ["input:nth-child(2)"]),
    ("<form><div><button>go</button></div></form><form><input type=text title=t></form>", "H32.2", ["form:nth-child(2)"]),
    ("<p id=x>a<p id=y>b<div><i id=x>c</i></div>", "F77", ["#x"]),
    ("<div><a href=x><img alt=''></a><a href=x><b>y</b></a></div>", "H91.A.NoContent", ["div:nth-child(1) > a:nth-child(1)"]),
    ("<div><img src=x></div>", "H37", ["div:nth-child(1) > img:nth-child(1)"]),
]


def test_rules_that_need_the_tree(spark):
    frame = spark.createDataFrame([(k, page) for k, (page, _, _) in enumerate(CASES)], "k int, html string")
    issues = explode_issues(scan_trees(frame)).collect()
    for k, (page, technique, selectors) in enumerate(CASES):
        assert [i.selector for i in issues if i.k == k and i.code.endswith(technique)] == selectors, page


def test_both_scans_agree_where_the_tree_does_not_matter(spark):
    pages = [
        "<html><title> </title><p><img><iframe></iframe><meta http-equiv=refresh content='5'>",
        "<html lang=en><title>t</title><b>x</b><i>y</i><font>z</font><a href=x></a><form><input type=submit></form>",
        "<p id=a><p id=a><p id=a>", "<select></select><textarea title=x></textarea>", "", None,
    ]
    frame = spark.createDataFrame(list(enumerate(pages)), "selector int, html string")  # a name that clashes
    both = [
        rows(f(frame, include_warnings=True).select(F.col("selector").alias("k"), "document_title", F.expr("transform(issues, i -> struct(i.code, i.type, i.message))").alias("i")))
        for f in (scan_pages, scan_trees)
    ]
    codes = [{(k, title, tuple(sorted((c for c, _, _ in i or ()) ))) for k, title, i in found} for found in both]
    assert codes[0] == codes[1]
    assert {c for _, _, found in codes[0] for c in found} >= {r.code for r in RULES if "H49" in r.code}


def test_no_pages(spark):
    assert scan_trees(spark.createDataFrame([], "k int, html string")).count() == 0
