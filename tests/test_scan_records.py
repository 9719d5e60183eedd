"""A1, A2, F17, G7, G8, S4-S9, S12, P18-P20."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from siteledger import schemas
from siteledger.functions.messages import issue_count
from siteledger.operators import links, records, scan
from siteledger.plans import case_queries, results
from siteledger.sources import files, history, records as record_io
from tests.conftest import rows

OK = '<html lang="en"><title>t</title>'

# rule -> (markup that breaks it, number of hits), markup that does not
RULES = {
    "H57.2": [("<title>t</title>", 1), ("<html lang=''><title>t</title>", 1), ("<!-- <html lang=en> --><title>t</title>", 1),
              ('<HTML class="a" xml:lang="de"><title>t</title>', 0)],
    "NoTitleEl": [('<html lang="en">', 1), ('<html lang="en"><script><title>x</title></script>', 1), (OK, 0)],
    "EmptyTitle": [('<html lang="en"><title> \n</title>', 1), ('<html lang="en"><title></title>', 1),
                   ('<html lang="en"><TITLE class=x>é</TITLE>', 0)],
    "1_1_1.H37": [('<img src="a"><IMG src="alt">', 2), ('<img alt=""><img ALT=x><!--<img>--><imgx>', 0), ('<img src="a > b">', 1)],
    "H91.A.NoContent": [('<a href="/x"></a><a href=y> <i></i></a>', 2), ('<a href="/x" title="t"></a>', 0),
                        ('<a href="/x"><img src="a" alt="t"></a>', 0), ('<a href="/x"><img src="a" alt=" "></a>', 1),
                        ('<a name="x"></a><a href="/x" aria-label="y"></a><a href="/x">t</a>', 0)],
    "H64.1": [("<iframe src='x'></iframe><iframe title=''>", 2), ('<iframe title="x">', 0)],
    "1_3_1.H44": [('<input><input type="text" id="a">', 2), ('<label for="a">l</label><input id="a">', 0),
                  ('<label>l <input name="q"></label><select></select><textarea></textarea>', 2),
                  ('<input type="HIDDEN"><input type=submit><input type=image><input title="x"><input aria-label=y>', 0)],
    "F77": [('<p id="a"><p id=a><p id=\'b\'><p id="a">', 2), ('<p id="a"><p id="b"><p data-id="a"><!-- <p id="a"> -->', 0)],
    "F41.2": [('<meta http-equiv="Refresh" content="5; url=/x">', 1), ('<meta http-equiv="refresh" content="0;url=/x"><meta name="refresh" content="5">', 0)],
    "H32.2": [('<form><input type="text" title="x"></form>', 1), ('<form><button>go</button></form><form><input type=IMAGE></form>', 0),
              ('<form><button type="button">x</button></form>', 1)],
    "H49.B": [("<b>x</b><B class='y'>z</B><br><body>", 2), ("<strong>x</strong>", 0)],
    "H49.I": [("<i>x</i><img alt=''><iframe title='x'>", 1)],
    "H49.Font": [("<font color=red>x</font>", 1)],
}


def test_rules(spark):
    whole = ("H57.2", "NoTitleEl", "EmptyTitle")
    cases = [(r, i, m if r in whole else OK + m, n) for r, c in RULES.items() for i, (m, n) in enumerate(c)]
    df = spark.createDataFrame(cases, "rule string, i int, html string, n int")
    found = scan.explode_issues(scan.scan_pages(df, include_warnings=True))
    hits = {(r.rule, r.i): r["count"] for r in found.filter(F.expr("endswith(code, rule)")).groupBy("rule", "i").count().collect()}
    assert {(r, i): hits.get((r, i), 0) for r, i, _, _ in cases} == {(r, i): n for r, i, _, n in cases}


def test_every_rule_is_tested():
    assert len(RULES) == len(scan.RULES)
    assert all(any(rule.code.endswith(k) for k in RULES) for rule in scan.RULES)


def test_warnings_are_left_out_by_default(spark):
    df = spark.createDataFrame([(1, OK + "<b>x</b>"), (2, None)], "i int, html string")
    got = {r.i: (r.document_title, r.issues) for r in scan.scan_pages(df).collect()}
    assert got == {1: ("t", []), 2: (None, None)}


def test_issue_fields(spark):
    df = spark.createDataFrame([(OK + '<img src="a">',)], "html string")
    issue = scan.scan_pages(df).first().issues[0]
    assert (issue.type, issue.typeCode, issue.context, issue.selector) == ("error", 1, '<img src="a">', "img")


@pytest.mark.parametrize("piece", [
    "<img <a <form <input '\"", "<a href=x ", "<a href=x>", "<form>", "<label>", "<title>", "<title ",
    "<html ", "<!--", "<script>", "<", "<p id='a' ", "<input \"", "&amp;", "<a href='", "</a ",
])
def test_broken_pages_take_linear_time(spark, piece):
    """A long page of unclosed markup is read once, not once per tag."""
    page = OK + "<p id='x" + piece * (400_000 // len(piece))
    df = spark.createDataFrame([(page,), (OK + piece * 30_000,)], "html string")
    start = time.perf_counter()
    scanned = scan.scan_pages(df, include_warnings=True)
    assert scanned.filter("issues IS NOT NULL").count() == 2
    linked = links.page_links(df.withColumn("url", F.lit("https://a.gov/")))
    assert linked.filter("links IS NOT NULL").count() == 2
    assert time.perf_counter() - start < 60


SITES = [
    ("T", "Ag", "Org", "https://a.gov/", "", "a", "gov"),
    ("T", "Ag", "Org", "https://s.a.gov/", "s", "a", "gov"),
    ("T", "Ag", "Org", "https://lost.gov/", None, "lost", "gov"),
    ("T", "Ag", "Org", "https://empty.gov/", "", "empty", "gov"),
]
PAGES = [
    ("https://a.gov/", OK), ("https://s.a.gov/", OK + "<img><img>"), ("https://empty.gov/", None),
    ("https://unlisted.gov/", OK),
]


def test_scan_sites(spark):
    sites = spark.createDataFrame(SITES, schemas.INVENTORY)
    pages = spark.createDataFrame(PAGES, "url string, html string")
    got = results.scan_sites(sites, pages, F.lit("2024-01-05"))
    assert got.schema.simpleString() == schemas.SCAN_RECORD.simpleString()
    assert rows(got, "domain", "subdomain", "number_of_errors", F.col("scan_date").cast("string")) == [
        ("a", "", 0, "2024-01-05"), ("a", "s", 2, "2024-01-05"),
    ]
    twice = spark.createDataFrame(
        [("https://a.gov", OK + "<img>", 2), ("https://a.gov/", OK, 1), ("https://a.gov/?x", OK, None)],
        "url string, html string, at int",
    )
    newest = results.scan_sites(sites, twice, F.lit("2024-01-05"), fetched_at="at")
    assert rows(newest, "domain", "number_of_errors") == [("a", 1)]
    assert results.scan_sites(sites, twice, F.lit("2024-01-05")).count() == 1
    left = results.scan_sites(sites, twice, F.lit("2024-01-05"), failures=True)
    assert left.count() == sites.count() - 1
    failed = scan.scan_records(sites, scan.scan_pages(pages), F.lit("2024-01-05"), failures=True)
    assert sorted(r.domain for r in failed.collect()) == ["empty", "lost"]


def record_files(folder, stored):
    for key, record in stored.items():
        path = folder / f"{key}.json"
        os.makedirs(path.parent, exist_ok=True)
        path.write_text(json.dumps(record, indent=1))


def stored(n, date, domain="d", subdomain="", issues=True):
    result = {"documentTitle": "t", "pageUrl": "u"}
    if issues:
        result["issues"] = [{"code": "c", "type": "error", "typeCode": 1, "message": "m", "context": "x", "selector": "s"}] * n
    return {
        "agency": "Ag", "organization": "Org", "domain": domain, "subdomain": subdomain,
        "numberOfErrors": str(n), "routeableUrl": "u", "issues": json.dumps(result), "scanDate": date,
    }


def test_join_results(spark, tmp_path):
    folder = tmp_path / "results"
    broken = stored(0, "2024-01-10", "broken")
    del broken["issues"]
    record_files(folder, {
        "Ag/Org/a": stored(0, "2024-01-10", "a"),
        "Ag/Org/a/s": stored(2, "2024-01-09", "a", "s"),
        "Ag/Org/nolist": stored(0, "2024-01-10", "nolist", issues=False),
        "Ag/Org/edge": stored(1, "2024-01-05", "edge"),
        "Ag/Org/old": stored(1, "2024-01-04", "old"),
        "Ag/Org/broken": broken,
    })
    (folder / "notes.txt").write_text("not a record")
    (folder / "Ag" / "torn.json").write_text('{"agency": "Ag", ')
    as_of = F.lit("2024-01-15")
    paths = [str(tmp_path / "data"), str(tmp_path / "hist")]
    share = results.join_results(spark, str(folder), *paths, as_of).first()
    assert (share.n_records, share.n_accessible, share.accessible_share) == (4, 2, 0.5)
    data = record_io.read_records(spark, paths[0])
    assert sorted(r.domain for r in data.collect()) == ["a", "a", "edge", "nolist"]
    assert data.filter("subdomain = 's'").first().issues[0].code == "c"
    results.join_results(spark, str(folder), *paths, as_of)
    assert history.read_history(spark, paths[1]).count() == 2  # appended twice
    results.join_results(spark, str(folder), *paths, as_of, upsert=True)
    assert [(str(r[0]), r[1]) for r in history.read_history(spark, paths[1]).collect()] == [("2024-01-15", 0.5)]


def test_record_written_last_wins(spark, tmp_path):
    folder = tmp_path / "results"
    record_files(folder, {"old/a": stored(0, "2024-01-10", "a"), "new/a": stored(3, "2024-01-10", "a")})
    os.utime(folder / "old" / "a.json", (1_700_000_000, 1_700_000_000))
    share = results.join_results(spark, str(folder), str(tmp_path / "d"), str(tmp_path / "h"), F.lit("2024-01-11"))
    assert share.first().n_accessible == 0
    assert record_io.read_records(spark, str(tmp_path / "d")).first().number_of_errors == 3


def test_unreadable_records_are_split_off(spark):
    files = spark.createDataFrame([("a", '{"issues":[]}'), ("b", None), ("c", "oops"), ("d", "{}")], "k string, issues string")
    good, bad = records.split_unreadable(files)
    assert (sorted(r.k for r in good.collect()), sorted(r.k for r in bad.collect())) == (["a", "d"], ["b", "c"])


def test_record_round_trip(spark, tmp_path):
    sites = spark.createDataFrame(SITES, schemas.INVENTORY)
    pages = spark.createDataFrame(PAGES, "url string, html string")
    got = results.scan_sites(sites, pages, F.lit("2024-01-05"))
    path = str(tmp_path / "files")
    record_io.write_record_files(got, path)
    assert os.path.isdir(f"{path}/owner_agency=Ag/owner_organization=Org")
    back = record_io.read_record_files(spark, path, one_per_file=False)
    keys = {(r.key, r.numberOfErrors, r.scanDate) for r in back.withColumn("key", F.concat_ws("/", "agency", "organization", "domain", "subdomain")).collect()}
    assert keys == {("Ag/Org/a/", "0", "2024-01-05"), ("Ag/Org/a/s", "2", "2024-01-05")}
    assert rows(records.from_files(back)) == rows(got)
    assert {r.key for r in records.to_files(got).collect()} == {"Ag/Org/a", "Ag/Org/a/s"}


def test_several_folders(spark, tmp_path):
    for name in ("x", "y"):
        record_files(tmp_path / name, {"Ag/Org/d": stored(0, "2024-01-01", name)})
    got = record_io.read_record_files(spark, [str(tmp_path / "x"), str(tmp_path / "y")])
    assert sorted(r.domain for r in got.collect()) == ["x", "y"]
    assert got.filter("written_at IS NOT NULL").count() == 2


def test_shares(spark):
    df = spark.createDataFrame([("a", 0), ("a", 1), ("b", 0), ("c", None)], "agency string, number_of_errors int")
    assert rows(records.accessible_share(df, ["agency"])) == [("a", 2, 1, 0.5), ("b", 1, 1, 1.0)]
    empty = records.accessible_share(df.filter("false")).first()
    assert (empty.n_records, empty.accessible_share) == (0, None)


def test_empty_share_adds_no_history(spark, tmp_path):
    df = spark.createDataFrame([], "number_of_errors int")
    path = str(tmp_path / "hist")
    assert rows(history.read_history(spark, path)) == []
    history.append_history(records.accessible_share(df), F.lit("2024-01-01"), path)
    assert rows(history.read_history(spark, path)) == []


def test_history_file(spark, tmp_path):
    path = tmp_path / "hist.json"
    path.write_text('[{"2020-01-08": 0.25}, {"2020-01-23": 0.5},\n {"2020-01-23": 0.75}]')
    got = history.read_history_file(spark, str(path))
    assert sorted((str(d), s) for d, s in rows(got)) == [("2020-01-08", 0.25), ("2020-01-23", 0.5), ("2020-01-23", 0.75)]
    out = str(tmp_path / "out")
    history.write_history_file(got, out)
    assert json.loads(spark.read.text(out).first().value) == json.loads(path.read_text())


def test_retention_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.sql("SELECT id AS number_of_errors, date_add(DATE'2024-01-01', CAST(id AS INT)) AS scan_date FROM range(20)").write.partitionBy("scan_date").parquet(path)
    kept = records.retain(spark.read.parquet(path), "scan_date", F.lit("2024-01-20"))
    assert sorted(r[0] for r in kept.collect()) == list(range(9, 20))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(scan_date" in plan


def test_list_files(spark, tmp_path):
    for name in ("hist.json", "hist-old.json", "a/b/x.json", "a/b/y.txt", "ab/z.json", "c/w.json"):
        path = tmp_path / "bucket" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("{}")
    root = str(tmp_path / "bucket")

    def names(df):
        return sorted(r.path.split("/bucket/")[1] for r in df.collect())

    assert len(names(files.list_files(spark, root))) == 6
    assert names(files.list_files(spark, root, "a", ".json")) == ["a/b/x.json", "ab/z.json"]
    assert names(files.list_files(spark, root, ["a/", "c", "none"], ".json")) == ["a/b/x.json", "c/w.json"]
    assert files.first_file(spark, root, "hist").endswith("/hist-old.json")
    assert files.first_file(spark, root, "nothing") is None


def test_results_that_are_no_object_have_no_count(spark):
    texts = ['{"issues":[1,[2],{"a":"]"}]}', '{"issues":"[1,2]"}', "{}", '{"issues":{}}', '{"issues":[1]} x', '{"issues":[', "[]", '"{}"', "null", "", None]
    frame = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string").orderBy("k")
    assert [r[0] for r in frame.select(issue_count(F.col("t"))).collect()] == [3, 2, 0, 0, 1] + [None] * 6


def test_stored_documents_are_written_by_several_tasks(spark, tmp_path, monkeypatch):
    keys = range(1, 251)
    spark.createDataFrame([(k, k % 25) for k in keys], "s_suppkey bigint, s_nationkey int").coalesce(1).write.parquet(
        str(tmp_path / "supplier.parquet")
    )
    monkeypatch.setattr(case_queries, "scratch_path", lambda spark, name: str(tmp_path / name))
    got = rows(case_queries.stored_documents(spark, str(tmp_path)))
    assert got == [
        (owner, 50, sum(k for k in keys if k % 5 == owner), "owner=r0") for owner in (1, 3)
    ]
    names = [p.name for p in (tmp_path / "documents").rglob("*.json")]
    assert len(names) == 250 and len({n.split("-")[1] for n in names}) > 1
