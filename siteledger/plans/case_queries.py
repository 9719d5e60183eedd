"""Registered queries whose inputs make every filter keep some rows and reject others.

The supplied tables hold no fragment, entity, off-site link, torn record or repeated fetch. These
queries build such rows from every row of a table, each form next to the result it must have.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from siteledger import schemas
from siteledger.functions import urls as url_fn
from siteledger.operators import crawl as crawl_op, hosts, links, records, rename, routes, scan
from siteledger.operators.rename import AgencyRule
from siteledger.plans import results
from siteledger.plans.owner_rules import OWNER_RULES
from siteledger.plans.queries import (
    _BEST,
    _HOSTS_SQL,
    _LADDER,
    _STREAM_SCHEMA,
    ORACLES,  # noqa: F401  both dictionaries hold the queries of either module
    QUERIES,  # noqa: F401
    _hosts,
    _probe_log,
    query,
    table,
)
from siteledger.session import scratch_path
from siteledger.sources import files, lists, records as record_io
from siteledger.streaming import events as stream_events, state


def _filled(template: str) -> Column:
    """``template`` with the columns ``host`` and ``n`` at ``{h}`` and ``{n}``."""
    return F.replace(F.replace(F.lit(template), F.lit("{h}"), F.col("host")), F.lit("{n}"), F.col("n"))


def _values(rows: list[tuple]) -> str:
    """Rows of text as SQL VALUES; None is NULL."""
    def text(v):
        return "NULL" if v is None else "'" + v.replace("'", "''") + "'"

    return ", ".join("(" + ", ".join(text(v) for v in row) + ")" for row in rows)


def _sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(n, host) of every page."""
    return table(spark, sf_dir, "pages").select(
        F.col("page_id").cast("string").alias("n"), url_fn.netloc(F.col("url")).alias("host")
    )


# --- links --------------------------------------------------------------------------------

# (href in the source of https://{h}/d{n}/p, link, link with compat); None where it is dropped
_HREFS = [
    ("/a{n}", "https://{h}/a{n}", "https://{h}/a{n}"),
    ("/a{n}?again", "https://{h}/a{n}", "https://{h}/a{n}"),
    (" b{n}.html ", "https://{h}/d{n}/b{n}.html", "https://{h}/d{n}/b{n}.html"),
    ("../j{n}", "https://{h}/j{n}", "https://{h}/j{n}"),
    ("./k{n}/../l{n}", "https://{h}/d{n}/l{n}", "https://{h}/d{n}/l{n}"),
    ("//{h}/i{n}", "https://{h}/i{n}", "https://{h}/i{n}"),
    ("HTTPS://{h}/e{n}", "https://{h}/e{n}", "https://{h}/e{n}"),
    ("&#x2F;f{n}", "https://{h}/f{n}", "https://{h}/f{n}"),
    ("&#000000047;o{n}", "https://{h}/o{n}", "https://{h}/o{n}"),
    ("/g{n}?x=1&amp;y=2", "https://{h}/g{n}", "https://{h}/g{n}"),
    ("/c{n}#part", "https://{h}/c{n}", "https://{h}/c{n}"),
    ("/one/two/three/four/five/six", *["https://{h}/one/two/three/four/five/six"] * 2),
    ("/x{n}.pdf?v=1", "https://{h}/x{n}.pdf", "https://{h}/x{n}.pdf"),
    ("/ships", "https://{h}/ships", None),
    ("https://other.example/{h}/{n}", *["https://other.example/{h}/{n}"] * 2),
    ("/x{n}.PDF", None, None),
    ("/x{n}?file=y.zip", None, None),
    ("/x{n}.tar.gz", None, None),
    ("mailto:a{n}@{h}", None, None),
    ("javascript:go('{h}')", None, None),
    ("tel:+{n}", None, None),
    ("https://www.youtube.com/{h}", None, None),
    ("https://other.example/{n}", None, None),
    ("https://other.example/?from={h}", None, None),
    ("#top", None, None),
    ("", None, None),
]


@query(
    "link_filters",
    f"""WITH f(link, kept) AS (
  SELECT DISTINCT link, 'strict' FROM (VALUES {_values([r[1:2] for r in _HREFS if r[1]])}) a(link)
  UNION SELECT DISTINCT link, 'compat' FROM (VALUES {_values([r[2:] for r in _HREFS if r[2]])}) b(link))
SELECT page_id, kept AS rules, replace(replace(link, '{{h}}',
    regexp_extract(url, '^https?://([^/?#]*)', 1)), '{{n}}', CAST(page_id AS VARCHAR)) AS url
FROM pages, f""",
)
def link_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hrefs of every kind on one made-up page per page."""
    anchors = F.concat(*[
        F.concat(F.lit('<a class="x" href="'), _filled(href), F.lit('">x</a>'))
        for href, _, _ in _HREFS
    ])
    pages = _sites(spark, sf_dir).select(
        F.col("n").cast("bigint").alias("page_id"),
        _filled("https://{h}/d{n}/p").alias("address"), anchors.alias("html"),
    )

    def found(rules: str, compat: bool) -> DataFrame:
        rows = links.extract_links(pages, "address", keep=["page_id"], compat=compat)
        return rows.select("page_id", F.lit(rules).alias("rules"), "url")

    return found("strict", False).unionAll(found("compat", True))


# (href on the first page of a host, link, whether the link is followed)
_STEPS = [
    ("/plain", "https://{h}/plain", True),
    ("/a/b/c", "https://{h}/a/b/c", True),  # five slashes
    ("/a/b/c/d", "https://{h}/a/b/c/d", False),  # six
    ("/file.pdf?view", "https://{h}/file.pdf", False),
    ("/m?to=twitter.com", "https://{h}/m", False),
    ("https://below.{h}/s", "https://below.{h}/s", True),
    ("https://other.example/{h}", "https://other.example/{h}", False),
    ("/", "https://{h}/", False),  # the seed itself is not read again
]


@query(
    "crawl_filters",
    f"""WITH s AS (SELECT DISTINCT regexp_extract(url, '^https?://([^/?#]*)', 1) AS host FROM pages),
f(link, depth) AS (VALUES {", ".join(
    [f"('{link}', 1)" for _, link, _ in _STEPS]
    + [f"('https://{{h}}/from{i}', 2)" for i, (_, _, follow) in enumerate(_STEPS) if follow]
)})
SELECT 'https://' || host || '/' AS seed_url, replace(link, '{{h}}', host) AS url, depth FROM s, f""",
)
def crawl_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which links a crawl follows: every target has a page with one more link."""
    sites = _sites(spark, sf_dir).select("host", F.lit("").alias("n")).distinct()

    def anchor(href: str) -> Column:
        return F.concat(F.lit('<a href="'), _filled(href), F.lit('">x</a>'))

    first = sites.select(
        _filled("https://{h}/").alias("url"),
        F.concat(*[anchor(href) for href, _, _ in _STEPS]).alias("html"),
    )
    targets = sites.select(F.inline(F.array(*[
        F.struct(_filled(link).alias("url"), anchor(f"https://{{h}}/from{i}").alias("html"))
        for i, (_, link, _) in enumerate(_STEPS[:-1])
    ])))
    return crawl_op.crawl(first.unionAll(targets), first.select(F.col("url").alias("seed_url")))


# (path, source of the page, links a crawl from / returns from it: (path, depth))
_FOLLOWED = [
    ("/", "<map><area href='/map?x'></map><a href='/plain'>x</a><area href='/deny.pdf'>", [("/plain", 1)]),
    ("/map", "<A HREF='from-map{n}'>x</A>", [("/from-map{n}", 2)]),
    ("/plain", "<!-- <base href='/no/'> --><base href='/dir/'><a href='sub'>x</a>", [("/sub", 2)]),
    ("/dir/sub", "<base target=t><area href='../area'><a href='../from-base'>x</a>", [("/from-base", 3)]),
    ("/sub", "<a href='/never'>x</a>", []),
    ("/area", "<a href='/last'>x</a>", [("/last", 4)]),
]


@query(
    "crawl_areas",
    f"""WITH s AS (SELECT DISTINCT regexp_extract(url, '^https?://([^/?#]*)', 1) AS host FROM pages),
f(path, depth) AS (VALUES {", ".join(f"('{path}', {depth})" for _, _, links in _FOLLOWED for path, depth in links)})
SELECT 'https://' || host || '/' AS seed_url, 'https://' || host || replace(path, '{{n}}', '') AS url, depth FROM s, f""",
)
def crawl_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crawl through image maps and documents with a base address, on every host."""
    sites = _sites(spark, sf_dir).select("host", F.lit("").alias("n")).distinct()
    pages = sites.select(F.inline(F.array(*[
        F.struct(_filled(f"https://{{h}}{path}").alias("url"), _filled(markup).alias("html"))
        for path, markup, _ in _FOLLOWED
    ])))
    return crawl_op.crawl(pages, sites.select(_filled("https://{h}/").alias("seed_url")))


@query(
    "routeable_undated",
    f"""WITH {_HOSTS_SQL},
probes AS (
  SELECT regexp_extract(url, '^https?://[^/?#]*') AS candidate_url,
    CASE WHEN page_id % 11 = 0 THEN 'timeout' WHEN page_id % 13 = 0 THEN 'error'
         ELSE 'response' END AS outcome,
    CASE WHEN page_id % 11 = 0 OR page_id % 13 = 0 THEN NULL WHEN page_id % 5 = 0 THEN 404
         WHEN page_id % 7 = 0 THEN 204 ELSE 200 END AS status,
    'https://' || regexp_extract(url, '^https?://([^/?#]*)', 1) || '/' AS final_url
  FROM pages),
decisive AS (SELECT candidate_url, max(final_url) AS final_url,
    CASE WHEN bool_or(status IS NOT DISTINCT FROM 200) THEN 'response'
      WHEN bool_or(outcome = 'timeout') THEN 'timeout' ELSE 'response' END AS outcome,
    CASE WHEN bool_or(status IS NOT DISTINCT FROM 200) THEN 200
      WHEN bool_or(outcome = 'timeout') THEN NULL ELSE 204 END AS status
  FROM probes WHERE outcome = 'timeout' OR status < 400 GROUP BY 1)
SELECT host, nullif({_BEST}, 'timeout') IS NOT NULL
    AND {_BEST} <> '-' AS answers
FROM hosts, range(4) t(r) JOIN decisive ON candidate_url = {_LADDER} || host GROUP BY host""",
)
def routeable_undated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated probes without a time: an answer beats errors, whatever their order."""
    sites = _hosts(spark, sf_dir)
    log = _probe_log(spark, sf_dir).drop("probed_at").withColumn(
        "final_url", F.replace("final_url", F.lit("https://www."), F.lit("https://"))
    )
    resolved = routes.resolve_routes(routes.url_candidates(sites, "host"), log, "host")
    answers = F.col("routeable_url").isNotNull() & (F.col("routeable_url") != routes.TIMEOUT)
    return resolved.select("host", F.coalesce(answers, F.lit(False)).alias("answers"))


# --- scans and records --------------------------------------------------------------------


@query(
    "presentational_rules",
    """WITH c AS (SELECT doc_id, unnest(CASE doc_id % 3 WHEN 0 THEN ['I'] WHEN 1 THEN ['Font', 'Font']
    ELSE ['B', 'I'] END) AS rule FROM documents)
SELECT 'WCAG2A.Principle1.Guideline1_3.1_3_1.H49.' || rule AS code, count(*) AS n FROM c GROUP BY 1""",
)
def presentational_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The warnings about b, i and font elements, around each whole document (A1)."""
    n = F.col("doc_id")
    text = F.coalesce("text", F.lit(""))
    body = F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    html = F.concat(
        F.lit("<html lang='en'><title>t</title>"),
        F.when(n % 3 == 0, F.concat(F.lit("<i class='x'>"), body, F.lit("</i><img alt='' src='i'>")))
        .when(n % 3 == 1, F.concat(F.lit("<FONT>x</FONT><font size=2>"), body, F.lit("</font>")))
        .otherwise(F.concat(F.lit("<b>"), body, F.lit("</b><br><i>x</i>"))),
        F.lit("</html>"),
    )
    pages = table(spark, sf_dir, "documents").select("doc_id", html.alias("html"))
    issues = scan.explode_issues(scan.scan_pages(pages, include_warnings=True))
    return issues.groupBy("code").agg(F.count("*").alias("n"))


@query(
    "scan_lookup",
    """SELECT 'https://s' || page_id || '.gov' || CASE WHEN page_id % 2 = 0 THEN '/' ELSE '' END AS url,
  CASE page_id % 5 WHEN 0 THEN 3 WHEN 1 THEN 1 WHEN 4 THEN 2 END AS n_errors,
  CASE page_id % 5 WHEN 0 THEN 'only' WHEN 1 THEN 'new' WHEN 4 THEN 'old' END AS title
FROM pages""",
)
def scan_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sites with and without a closing slash against pages fetched once, twice, without source
    or not at all; sites without a result are the failures (A2, F17)."""
    n = F.col("page_id")
    numbers = table(spark, sf_dir, "pages").select("page_id")
    site = F.concat(F.lit("https://s"), n, F.lit(".gov"))
    inventory = numbers.select(
        F.lit("a").alias("Agency"), F.lit("o").alias("Organization"),
        F.concat(F.lit("s"), n).alias("domain"), F.lit(None).cast("string").alias("subdomain"),
        F.concat(site, F.when(n % 2 == 0, "/").otherwise("")).alias("routeable_url"),
    )

    def page(title: str, images: int) -> Column:
        return F.lit(f"<html lang='en'><title>{title}</title>" + '<img src="a.png">' * images)

    def fetched(which: Column, at: int, html: Column) -> DataFrame:
        return numbers.filter(which).select(
            F.concat(site, F.when(n % 3 == 0, "/").otherwise("")).alias("url"),
            F.lit(at).alias("at"), html.cast("string").alias("html"),
        )

    pages = (
        fetched(n % 5 == 0, 1, page("only", 3))
        .unionAll(fetched(n % 5 == 1, 2, page("new", 1)))
        .unionAll(fetched(n % 5 == 1, 1, page("zz", 2)))
        .unionAll(fetched(n % 5 == 2, 1, F.lit(None)))
        .unionAll(fetched(n % 5 == 4, 1, page("old", 2)))
        .unionAll(fetched(n % 5 == 4, 2, F.lit(None)))
    )
    as_of = F.lit("2024-02-01")
    scanned = results.scan_sites(inventory, pages, as_of, fetched_at="at")
    failed = results.scan_sites(inventory, pages, as_of, fetched_at="at", failures=True)
    return scanned.select(
        F.col("routeable_url").alias("url"), F.col("number_of_errors").alias("n_errors"),
        F.col("document_title").alias("title"),
    ).unionAll(failed.select("routeable_url", F.lit(None).cast("int"), F.lit(None).cast("string")))


_DAYS_SQL = """
days AS (SELECT user_id, CAST(ts AS DATE) AS scan_date, count(*) % 3 AS n,
    (user_id + datediff('day', DATE '2020-01-01', CAST(ts AS DATE))) % 7 AS kind
  FROM events GROUP BY ALL),
as_of AS (SELECT max(scan_date) AS day FROM days)"""


@query(
    "joined_cases",
    f"""WITH {_DAYS_SQL},
good AS (SELECT * FROM days, as_of WHERE kind NOT IN (1, 3, 5) AND scan_date >= day - 10),
last AS (SELECT * FROM good QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY scan_date DESC) = 1)
SELECT count(*) AS n_records, count(*) FILTER (n = 0) AS n_accessible,
  count(*) FILTER (n = 0) / count(*) AS accessible_share,
  (SELECT count(*) FROM days WHERE kind = 1) AS n_unreadable FROM last""",
)
def joined_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The results joiner over a record per user and day, some torn, some without a date that can
    be read, some dated after the snapshot (S12, P20, G7, G8). A record without a date is as old
    as its file, which is written now, after the snapshot."""
    days = table(spark, sf_dir, "events").groupBy(
        "user_id", F.to_date("ts").alias("scan_date")
    ).agg((F.count("*") % 3).cast("int").alias("n"))
    kind = (F.col("user_id") + F.date_diff("scan_date", F.lit("2020-01-01").cast("date"))) % 7
    issue = '{"code": "c", "type": "error", "typeCode": 1}'
    found = F.concat(
        F.lit('{"documentTitle": "t", "issues": ['),
        F.array_join(F.array_repeat(F.lit(issue), F.col("n")), ", "), F.lit("]}"),
    )
    as_of = F.lit(days.agg(F.max("scan_date")).first()[0])
    exported, torn = scratch_path(spark, "records"), scratch_path(spark, "torn")
    days.select(
        F.lit("a").alias("agency"), F.lit("o").alias("organization"),
        F.concat(F.lit("user"), "user_id").alias("domain"), F.lit("").alias("subdomain"),
        F.col("n").cast("string").alias("numberOfErrors"), F.lit("u").alias("routeableUrl"),
        F.when(kind == 1, F.substring(found, 1, 25)).otherwise(found).alias("issues"),
        F.when(kind == 3, "soon")
        .otherwise(F.when(kind == 5, F.date_add(as_of, 1)).otherwise(F.col("scan_date")).cast("string"))
        .alias("scanDate"),
    ).write.json(exported)
    share = results.join_results(
        spark, exported, scratch_path(spark, "data"), scratch_path(spark, "history"), as_of,
        one_per_file=False, unreadable_path=torn,
    )
    unreadable = spark.read.parquet(torn).agg(F.count("*").alias("n_unreadable"))
    return share.crossJoin(F.broadcast(unreadable))  # one row each


@query(
    "store_runs",
    """WITH r AS (SELECT user_id, CAST(ts AS DATE) AS scan_date, event_id, event_id % 2 AS run,
    CAST(user_id % 4 AS INTEGER) AS n FROM events),
cur AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY run, user_id
    ORDER BY scan_date DESC, event_id DESC) = 1),
last AS (SELECT * FROM cur QUALIFY row_number() OVER (PARTITION BY user_id
    ORDER BY scan_date DESC, run DESC) = 1)
SELECT 'user' || user_id AS domain, scan_date, 'run' || run AS title, n AS number_of_errors,
  repeat('x<"&é', n) AS codes FROM last""",
)
def store_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs written to one store, the latest record per key read back with its issues (S7,
    S5, S8, G7)."""
    store, data = scratch_path(spark, "store"), scratch_path(spark, "data")
    n = (F.col("user_id") % 4).cast("int")
    issue = F.struct(*[
        F.lit(1).alias(f.name) if f.name == "typeCode" else F.lit('x<"&é').alias(f.name)
        for f in schemas.ISSUE
    ])
    rows = table(spark, sf_dir, "events").select(
        F.lit("a").alias("agency"), F.lit("o").alias("organization"),
        F.concat(F.lit("user"), "user_id").alias("domain"), F.lit("").alias("subdomain"),
        n.alias("number_of_errors"), F.lit("https://a.gov/").alias("routeable_url"),
        F.concat(F.lit("run"), F.col("event_id") % 2).alias("document_title"),
        F.array_repeat(issue, n).alias("issues"), F.to_date("ts").alias("scan_date"), "event_id",
    )
    for run in range(2):
        current = records.latest_records(
            rows.filter(F.col("event_id") % 2 == run), ["scan_date", "event_id"]
        )
        record_io.write_record_files(current.drop("event_id"), store)
    stored = records.from_files(
        record_io.read_record_files(spark, store, one_per_file=False), ["written_at"]
    )
    latest = records.latest_records(stored, ["scan_date", "written_at"]).drop("written_at")
    record_io.write_records(latest, data)
    return record_io.read_records(spark, data).select(
        "domain", "scan_date", F.col("document_title").alias("title"), "number_of_errors",
        F.array_join(F.transform("issues", lambda i: i["code"]), "").alias("codes"),
    )


# --- owner names --------------------------------------------------------------------------


def _owner_pairs() -> list[tuple[str, str]]:
    """Owner names that meet every condition of every rule, and some that meet none."""
    pairs = [("Unlisted agency", "Unlisted office")]
    for rule in OWNER_RULES:
        agencies = [rule.agency, f"The {rule.agency} (old)"]
        orgs = ["Unlisted office", rule.agency, rule.agency.upper()]
        for org in rule.orgs:
            orgs += [f"x {t} y" for t in org.has] + list(org.equal)
            orgs += [f"{t} {org.lacks}" for t in org.has if org.lacks]
        pairs += [(a, o) for a in agencies for o in orgs]
    return pairs


def _rule_sql(rule: AgencyRule) -> tuple[str, str, str]:
    """SQL for whether the rule applies, and the two names it gives."""
    def text(v):
        return "'" + v.replace("'", "''") + "'"

    def cases(found: list[tuple[str, str]], other: str) -> str:
        whens = " ".join(f"WHEN {test} THEN {value}" for test, value in found)
        return f"CASE {whens} ELSE {other} END" if found else other

    agency = text(rule.agency_to) if rule.agency_to else "a"
    agencies, orgs = [], []
    for org in rule.orgs:
        tests = [f"contains(o, {text(t)})" for t in org.has] + [f"o = {text(t)}" for t in org.equal]
        test = f"({' OR '.join(tests) or 'true'})"
        test += f" AND NOT contains(o, {text(org.lacks)})" if org.lacks else ""
        name = text(org.to) if org.to else "o"
        if org.title:
            name = (
                f"array_to_string(list_transform(regexp_extract_all(lower({name}), "
                "'[a-z]+|[^a-z]+'), lambda p: upper(p[1]) || p[2:]), '')"
            )
        agencies.append((test, text(org.agency_to) if org.agency_to else agency))
        orgs.append((test, name))
    applies = f"contains(a, {text(rule.agency)})" if rule.contains else f"a = {text(rule.agency)}"
    return applies, cases(agencies, agency), cases(orgs, "o")


def _owners_sql() -> str:
    rules = [_rule_sql(r) for r in OWNER_RULES]
    pairs = _owner_pairs()
    agencies = " ".join(f"WHEN {test} THEN {name}" for test, name, _ in rules)
    orgs = " ".join(f"WHEN {test} THEN {name}" for test, _, name in rules)
    return f"""WITH p(i, a, o) AS (SELECT CAST(i AS INTEGER), a, o FROM (VALUES {_values(
        [(str(i), *pair) for i, pair in enumerate(pairs)])}) v(i, a, o)),
r AS (SELECT a, o, count(*) AS n FROM orders JOIN p ON i = o_orderkey % {len(pairs)} GROUP BY 1, 2)
SELECT a AS was_agency, o AS was_organization, n,
  CASE {agencies} ELSE a END AS agency, CASE {orgs} ELSE o END AS organization FROM r"""


@query("owner_rules", _owners_sql())
def owner_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole table of owner names, a pair of names per order that meets or misses each of its
    conditions (P9, P10, P22)."""
    pairs = F.array(*[
        F.struct(F.lit(a).alias("was_agency"), F.lit(o).alias("was_organization"))
        for a, o in _owner_pairs()
    ])
    i = (F.col("o_orderkey") % len(_owner_pairs())).cast("int")
    owners = table(spark, sf_dir, "orders").select(F.get(pairs, i).alias("pair")).groupBy(
        "pair.was_agency", "pair.was_organization"
    ).agg(F.count("*").alias("n"))
    padded = owners.withColumns({
        "agency": F.concat(F.lit(" "), "was_agency", F.lit(" ")),
        "organization": F.concat(F.lit("  "), "was_organization"),
    })
    return rename.rename_by_rules(padded, "agency", "organization", OWNER_RULES)


# --- files --------------------------------------------------------------------------------

#: Files of one document that a task writes; each costs milliseconds, whatever is in it.
_DOCUMENTS_A_TASK = 100


@query(
    "stored_documents",
    """SELECT s_nationkey % 5 AS owner, count(*) AS n_records, CAST(sum(s_suppkey) AS BIGINT) AS keys, 'owner=r0' AS first_owner
FROM supplier WHERE s_nationkey % 5 IN (1, 3) GROUP BY 1""",
)
def stored_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document per file for every supplier, read below prefixes with pattern characters, one of them without
    a file, and the first file of a prefix (S4, S5, U3)."""
    path, group = scratch_path(spark, "documents"), F.col("s_nationkey") % 5
    rows = table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("r"), group).alias("owner"),
        group.cast("string").alias("agency"), F.col("s_suppkey").cast("string").alias("domain"),
    )
    # a table in one file is read by one task, which would then write every document alone
    tasks = max(1, -(-rows.count() // _DOCUMENTS_A_TASK))
    rows.repartition(tasks).write.partitionBy("owner").option("maxRecordsPerFile", 1).json(f"{path}/a[1]")
    stored = record_io.read_record_files(
        spark, path, prefixes=["a[1]/owner=r1", "a[1]/owner=r3", "a[9]"]
    )
    first = F.lit(files.first_file(spark, path, "a[1]/").split("/")[-2])
    return stored.groupBy(F.col("agency").cast("int").alias("owner")).agg(
        F.count("*").alias("n_records"), F.sum(F.col("domain").cast("bigint")).alias("keys"),
        F.first(first).alias("first_owner"),
    )


@query(
    "rejected_rows",
    """SELECT CASE c_custkey % 4 WHEN 1 THEN 'rejected' ELSE 'read' END AS kind, c_custkey % 2 = 0 AS in_lines,
  CASE c_custkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'c' || c_custkey || ',a,b,o,more,x,y' ELSE 'o,"' || c_custkey END AS detail
FROM customer""",
)
def rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry rows with too many fields, with too few, and with quotes and commas, in a file with line breaks inside
    fields and in one without (S1, S3, X8)."""
    n, both = F.col("c_custkey"), None
    for breaks in (False, True):
        path = scratch_path(spark, "registry")
        owner = F.concat(F.lit('a\nb' if breaks else "a"))
        fields = [F.lit("b"), F.concat(F.lit('"o,""'), n, F.lit('"""'))]
        line = F.concat_ws(
            ",", F.concat(F.lit("c"), n),
            F.when(n % 4 == 0, "t").when(n % 4 == 1, "a,b,o,more").otherwise(F.concat_ws(",", F.concat(F.lit('"'), owner, F.lit('"')), *fields)),
            F.when(n % 4 == 1, "x,y"),
        )
        lines = table(spark, sf_dir, "customer").filter((n % 2 == 0) != breaks).select(line.alias("value"))
        header = spark.createDataFrame([("Domain Name,Domain Type,Agency,Organization",)], "value string")
        header.unionAll(lines).coalesce(1).write.text(path)
        found = lists.read_registry(spark, path, hosts.default_suffixes(spark)).select(
            F.lit("read").alias("kind"), F.lit(not breaks).alias("in_lines"), F.rtrim(F.col("Organization"), F.lit('"')).alias("detail")
        )
        torn = lists.rejected_rows(spark, path).select(F.lit("rejected"), F.lit(not breaks), F.concat("record", F.lit(",x,y")))
        found = found.unionAll(torn)
        both = found if both is None else both.unionAll(found)
    return both


@query(
    "line_breaks",
    """SELECT 'registry' AS file, 's' || s_suppkey AS name, s_name || chr(10) || 'office "' || s_nationkey || '"' AS owner
FROM supplier UNION ALL
SELECT 'inventory', 'c' || c_custkey, c_name || chr(10) || c_mktsegment || ', Inc.' FROM customer""",
)
def line_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry and inventory files with line breaks, quotes and commas inside fields."""
    registry, inventory = scratch_path(spark, "registry"), scratch_path(spark, "inventory")
    table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("S"), "s_suppkey", F.lit(".gov")).alias("Domain Name"),
        F.lit("t").alias("Domain Type"),
        F.concat("s_name", F.lit('\noffice "'), "s_nationkey", F.lit('"')).alias("Agency"),
        F.lit("o").alias("Organization"),
    ).write.csv(registry, header=True, escape=lists.QUOTE)
    lists.write_inventory(
        table(spark, sf_dir, "customer").select(
            F.lit("t").alias("Domain Type"), F.lit("a").alias("Agency"),
            F.concat("c_name", F.lit("\n"), "c_mktsegment", F.lit(", Inc.")).alias("Organization"),
            F.concat(F.lit("c"), "c_custkey").alias("domain"),
        ),
        inventory,
    )
    sites = lists.read_registry(spark, registry, hosts.default_suffixes(spark))
    listed = lists.read_inventory(spark, inventory)
    return sites.select(
        F.lit("registry").alias("file"), F.col("domain").alias("name"), F.col("Agency").alias("owner")
    ).unionAll(listed.select(F.lit("inventory"), "domain", "Organization"))


@query(
    "seed_lists_compat",
    """SELECT 'c' || c_custkey || CASE c_custkey % 3 WHEN 0 THEN '.domain.gov' ELSE '.a.gov' END AS site
FROM customer WHERE c_custkey % 3 = 1""",
)
def seed_lists_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seed lists read with the original header rule, which also drops real sites (F1)."""
    n, path = F.col("c_custkey"), scratch_path(spark, "seeds")
    table(spark, sf_dir, "customer").select(
        F.concat(
            F.lit("C"), n,
            F.when(n % 3 == 0, ".domain.gov").when(n % 3 == 1, ".a.gov").otherwise(".example"),
        ).alias("Domain name")
    ).write.csv(path, header=True)
    rows = lists.read_seed_sites(spark, [path], hosts.default_suffixes(spark), compat=True)
    return rows.select("site")


# --- hosts in other scripts ---------------------------------------------------------------

# (suffix, kind), as a published list writes them and as hosts do
_WRITTEN_SUFFIXES = [
    ("公司.cn", "plain"), ("cn", "plain"), ("みんな", "plain"), ("xn--p1ai", "plain"), ("онлайн", "wildcard"), ("город.онлайн", "exception"), ("gov", "plain"),
]
# (host, subdomain, domain, tld); each part in the form the host has it in
_WRITTEN_HOSTS = [
    ("a{n}.xn--55qx5d.cn", "", "a{n}", "xn--55qx5d.cn"),
    ("www.a{n}.公司.cn", "www", "a{n}", "公司.cn"),
    ("xn--55qx5d.cn", "", "", "xn--55qx5d.cn"),
    ("XN--BCHER-KVA{n}.gov", "", "xn--bcher-kva{n}", "gov"),
    ("s.bücher.XN--Q9JYB4C", "s", "bücher", "xn--q9jyb4c"),
    ("a{n}.рф", "", "a{n}", "рф"),
    ("b.a{n}.xn--p1ai", "b", "a{n}", "xn--p1ai"),
    ("c.a{n}.xn--80asehdb", "", "c", "a{n}.xn--80asehdb"),
    ("d.xn--c1avg{n}.онлайн", "", "d", "xn--c1avg{n}.онлайн"),
    ("d.xn--c1ac3aaj.xn--80asehdb", "d", "xn--c1ac3aaj", "xn--80asehdb"),
    ("a{n}.xn--.gov", "a{n}", "xn--", "gov"),
]


@query(
    "written_hosts",
    f"""WITH f(host, subdomain, domain, tld) AS (VALUES {_values(_WRITTEN_HOSTS)})
SELECT page_id, lower(replace(host, '{{n}}', CAST(page_id AS VARCHAR))) AS host,
  replace(subdomain, '{{n}}', CAST(page_id AS VARCHAR)) AS subdomain,
  replace(domain, '{{n}}', CAST(page_id AS VARCHAR)) AS domain,
  replace(tld, '{{n}}', CAST(page_id AS VARCHAR)) AS tld FROM pages, f""",
)
def written_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain, ``xn--`` and written hosts of every page number against suffixes in other scripts."""
    rows = _sites(spark, sf_dir).withColumn("host", F.lit("")).select(
        F.col("n").cast("bigint").alias("page_id"),
        F.explode(F.array(*[_filled(host) for host, *_ in _WRITTEN_HOSTS])).alias("host"),
    )
    suffixes = spark.createDataFrame(_WRITTEN_SUFFIXES, schemas.SUFFIX)
    return hosts.split_host(rows, "host", suffixes).withColumn("host", F.lower("host"))


# --- streams ------------------------------------------------------------------------------


@query(
    "stream_compacted",
    """SELECT event_type AS agency, 'user' || user_id AS domain, max(event_id) AS seq,
  arg_max(CAST(ts AS DATE), event_id) AS scan_date
FROM events GROUP BY 1, 2""",
)
def stream_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last message per key over three micro-batches, their state compacted after the first and
    the third (T1, T3)."""
    n = F.col("event_id")
    body = F.to_json(F.struct(
        F.col("event_type").alias("agency"), F.concat(F.lit("user"), "user_id").alias("domain"),
        n.alias("seq"), F.to_date("ts").alias("scan_date"),
    ))
    record = F.struct(n.cast("string").alias("messageId"), body.alias("body"))
    arrivals, target = scratch_path(spark, "arrivals"), scratch_path(spark, "state")
    dead, checkpoint = scratch_path(spark, "dead"), scratch_path(spark, "checkpoint")
    keys = ["agency", "domain"]
    for part in (1, 2, 0):
        table(spark, sf_dir, "events").filter(n % 3 == part).select(
            F.to_json(F.struct(F.array(record).alias("Records")))
        ).write.mode("append").text(arrivals)
        stream = stream_events.stream_events(spark, arrivals, _STREAM_SCHEMA, one_per_file=False)
        state.consume(stream, target, dead, checkpoint, keys, "seq")
        if part != 2:
            state.compact_in_place(
                spark, target, _STREAM_SCHEMA, keys, "seq", upto=0 if part == 1 else None
            )
    return state.read_latest(spark, target, _STREAM_SCHEMA, keys, "seq").select(
        *_STREAM_SCHEMA.names
    )
