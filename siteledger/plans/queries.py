"""Registered queries over the supplied tables, each next to its SQL.

A query reads the tables of a folder and runs library operators over all of their rows. The
tables hold no registry, probe log or scan records, so these are derived from columns that do
exist: hosts of pages, events of users, customers by segment.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from siteledger import schemas
from siteledger.functions import text as text_fn
from siteledger.functions import urls as url_fn
from siteledger.functions.messages import issue_count, message_body
from siteledger.operators import batching, crawl as crawl_op, dedupe, events as events_op
from siteledger.operators import filters, hosts, links, records, rename, routes, scan
from siteledger.plans import inventory as inventory_plan, results
from siteledger.plans.dispatch import dispatch
from siteledger.plans.site_map import map_links
from siteledger.session import materialize, scratch_path
from siteledger.sources import history as history_io, lists, messages as message_io, pages as page_io
from siteledger.sources import records as record_io
from siteledger.streaming import events as stream_events, state

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- SQL pieces shared by several oracles -------------------------------------------------

_EXT = "|".join(e.replace(".", r"\.") for e in links.IGNORED_EXTENSIONS)
_UNWANTED = "|".join(u.replace(".", r"\.") for u in links.UNWANTED)
_MARKUP = (
    r"regexp_replace(html, '(?is)<!--.*?-->|<script.*?</script\s*>|<style.*?</style\s*>', '', 'g')"
)
_LINKS_SQL = rf"""
anchors AS (
  SELECT page_id, url AS page_url, regexp_extract(url, '^https?://[^/?#]*') AS origin,
         regexp_extract(url, '^https?://([^/?#]*)', 1) AS site,
         unnest(regexp_extract_all({_MARKUP}, '(?i)<a\s[^>]*href="([^"]*)"', 1)) AS href
  FROM pages),
resolved AS (
  SELECT page_id, page_url, site,
         CASE WHEN href LIKE '/%' THEN origin || href ELSE href END AS raw
  FROM anchors WHERE href <> '' AND href NOT LIKE '#%'),
links AS (
  SELECT DISTINCT page_id, page_url, site, regexp_replace(raw, '[?#].*$', '') AS url
  FROM resolved
  WHERE NOT regexp_matches(lower(raw), '\.({_EXT})$') AND regexp_matches(raw, '^[A-Za-z]+:')
    AND NOT regexp_matches(regexp_replace(raw, '[?#].*$', ''), '{_UNWANTED}')
    AND contains(regexp_replace(raw, '[?#].*$', ''), site))"""

# Hosts are <labels>.example.<tld>; example.<tld> is read as the public suffix.
SITE_SUFFIXES = [("example.com", "plain"), ("example.net", "plain"), ("example.org", "plain")]
_HOSTS_SQL = """
hosts AS (
  SELECT regexp_extract(url, '^https?://([^/?#]*)', 1) AS host, min(page_id) AS pos
  FROM pages GROUP BY 1),
parts AS (
  SELECT host, pos, array_to_string(string_split(host, '.')[-2:], '.') AS tld,
         string_split(host, '.')[-3] AS domain,
         array_to_string(string_split(host, '.')[:-4], '.') AS subdomain
  FROM hosts)"""


def _suffixes(spark: SparkSession, rows=SITE_SUFFIXES) -> DataFrame:
    return spark.createDataFrame(rows, schemas.SUFFIX)


def _hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct hosts of the pages, with the first page of each as position."""
    return (
        table(spark, sf_dir, "pages")
        .select(url_fn.host_of(F.col("url")).alias("host"), "page_id")
        .groupBy("host")
        .agg(F.min("page_id").alias("pos"))
    )


def _long(c) -> F.Column:
    return c.cast("bigint")


# --- links --------------------------------------------------------------------------------


@query(
    "site_links",
    f"""WITH {_LINKS_SQL}
SELECT site, count(DISTINCT page_url) AS n_pages, count(*) AS n_links,
       count(DISTINCT url) AS n_urls
FROM links GROUP BY site""",
)
def site_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: in-site links per host.

    One pass over the page source. Distinct counts are taken per (host, value) first, so no
    task ever sees all links of a hot host.
    """
    found = links.extract_links(table(spark, sf_dir, "pages"))
    return found.groupBy(url_fn.netloc(F.col("page_url")).alias("site")).agg(
        F.count_distinct("page_url").alias("n_pages"),
        F.count("*").alias("n_links"),
        F.count_distinct("url").alias("n_urls"),
    )


@query("links", f"WITH {_LINKS_SQL} SELECT page_id, page_url, url FROM links")
def page_link_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links.extract_links(table(spark, sf_dir, "pages"), keep=["page_id"])


@query(
    "unseen_links",
    f"""WITH {_LINKS_SQL},
paths AS (SELECT DISTINCT page_id % 2 AS odd, regexp_replace(url, '^https?://', '') AS url
          FROM links)
SELECT url FROM paths p WHERE odd = 1
  AND NOT EXISTS (SELECT 1 FROM paths s WHERE s.odd = 0 AND s.url = p.url)""",
)
def unseen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of odd pages that no even page has."""
    found = links.extract_links(table(spark, sf_dir, "pages"), keep=["page_id"]).select(
        (F.col("page_id") % 2).alias("odd"), url_fn.strip_scheme(F.col("url")).alias("url")
    )
    new = found.filter("odd = 1").select("url").distinct()
    return links.unseen_links(new, found.filter("odd = 0"))


@query(
    "link_messages",
    f"""WITH {_LINKS_SQL},
u AS (SELECT DISTINCT site, url,
        string_split(regexp_replace(site, '\\.example\\.(com|net|org).*$', ''), '.') AS labels,
        regexp_replace(regexp_extract(url, '^https?://[^/?#]*([^?#;]*)', 1), '^/', '') AS path
      FROM links),
v AS (SELECT site, url, path, labels[-1] AS domain,
        array_to_string([x for x in labels[:-2] if x <> 'www'], '.') AS subdomain FROM u)
SELECT site AS "Agency", 'pages' AS "Organization", domain, subdomain, 'example' AS tld,
       url AS routeable_url,
       site || '+pages+' || domain || '+' || subdomain || '+' || path AS db_id
FROM v""",
)
def link_message_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Link messages with composite ids."""
    found = links.extract_links(table(spark, sf_dir, "pages")).select(
        url_fn.netloc(F.col("page_url")).alias("site"), "url"
    ).distinct()
    return links.link_messages(
        found, F.col("site"), F.lit("pages"),
        suffixes=["example.com", "example.net", "example.org"], tld=F.lit("example"),
    )


@query(
    "resolve_urls",
    """WITH p AS (SELECT page_id, url, regexp_extract(url, '^https?://[^/?#]*') AS origin,
    regexp_extract(url, '^[a-z]+') AS scheme,
    regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1) AS path FROM pages)
SELECT page_id, CASE page_id % 7
  WHEN 0 THEN origin || '/n/' || page_id
  WHEN 1 THEN origin || path || '?q=' || page_id
  WHEN 2 THEN regexp_replace(url, '#.*$', '') || '#f' || page_id
  WHEN 3 THEN scheme || '://other.example.org/' || page_id || '/../x'
  WHEN 4 THEN origin || regexp_extract(path, '^(.*/)', 1) || 'a/b' || page_id
  WHEN 5 THEN origin || '/root/' || page_id || '/'
  ELSE 'mailto:' || page_id || '@example.org' END AS resolved
FROM p""",
)
def resolve_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every kind of reference resolved against the page addresses."""
    n = F.col("page_id").cast("string")
    kinds = [
        F.concat(F.lit("/n/"), n),
        F.concat(F.lit("?q="), n),
        F.concat(F.lit("#f"), n),
        F.concat(F.lit("//other.example.org/"), n, F.lit("/../x")),
        F.concat(F.lit(" ./a/c/../b"), n),
        F.concat(F.lit("/./root/x/../"), n, F.lit("/.")),
    ]
    href = F.concat(F.lit("mailto:"), n, F.lit("@example.org"))
    for i, kind in enumerate(kinds):
        href = F.when(F.col("page_id") % 7 == i, kind).otherwise(href)
    return table(spark, sf_dir, "pages").select(
        "page_id", url_fn.resolve_url(F.col("url"), href).alias("resolved")
    )


_CRAWL_SEEDS = """seeds AS (SELECT min(url) AS seed_url, host FROM (
    SELECT regexp_replace(url, '[?#].*$', '') AS url,
           regexp_extract(url, '^https?://([^/?#]*)', 1) AS host FROM pages) GROUP BY host)"""


@query(
    "crawl",
    f"""WITH RECURSIVE {_LINKS_SQL}, {_CRAWL_SEEDS},
edges AS (SELECT DISTINCT regexp_replace(page_url, '[?#].*$', '') AS page, url FROM links),
walk AS (
  SELECT s.seed_url, e.url, 1 AS depth FROM seeds s JOIN edges e ON e.page = s.seed_url
  UNION
  SELECT w.seed_url, e.url, w.depth + 1 FROM walk w JOIN edges e ON e.page = w.url
  WHERE w.depth < (SELECT count(*) FROM pages))
SELECT seed_url, url, CAST(min(depth) AS INTEGER) AS depth FROM walk GROUP BY 1, 2""",
)
def crawl_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crawl from the first page of every host, to the end."""
    pages = table(spark, sf_dir, "pages")
    seeds = (
        pages.groupBy(url_fn.netloc(F.col("url")).alias("host"))
        .agg(F.min(url_fn.clean_url(F.col("url"))).alias("seed_url"))
        .select("seed_url")
    )
    return crawl_op.crawl(pages, seeds)


@query(
    "site_map",
    f"""WITH {_LINKS_SQL}, {_CRAWL_SEEDS},
hit AS (SELECT DISTINCT l.site, l.url FROM seeds s
  JOIN links l ON regexp_replace(l.page_url, '[?#].*$', '') = s.seed_url),
u AS (SELECT site, url,
        string_split(regexp_replace(site, '\\.example\\..*$', ''), '.') AS labels,
        regexp_replace(regexp_extract(url, '^https?://[^/?#]*([^?#;]*)', 1), '^/', '') AS path
      FROM hit),
v AS (SELECT site, url, path, labels[-1] AS domain,
        array_to_string([x for x in labels[:-2] if x <> 'www'], '.') AS subdomain FROM u)
SELECT 'host ' || site AS "Agency", '' AS "Organization", domain, subdomain,
  'example.com' AS tld, url AS routeable_url,
  'host ' || site || '++' || domain || '+' || subdomain || '+' || path AS db_id FROM v""",
)
def site_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Link messages of every host, crawled from its first page (entry 4)."""
    pages = table(spark, sf_dir, "pages")
    first = pages.groupBy(url_fn.host_of(F.col("url")).alias("host")).agg(
        F.min(url_fn.clean_url(F.col("url"))).alias("routeable_url")
    )
    sites = hosts.split_host(first, "host", _suffixes(spark)).withColumns({
        "Agency": F.concat(F.lit("host "), "host"),
        "Organization": F.lit(None).cast("string"),
    })
    return map_links(
        sites, pages, suffixes=["example.com", "example.net", "example.org"]
    )


@query(
    "crawl_tree",
    """WITH RECURSIVE p AS (
  SELECT page_id, 'https://' || regexp_extract(url, '^https?://([^/?#]*)', 1) || '.site.gov/p'
    || page_id AS url, regexp_extract(url, 'example\\.([a-z]+)', 1) AS tld FROM pages),
seeds AS (SELECT min(page_id) AS root FROM p GROUP BY tld),
walk AS (
  SELECT root, root AS page_id, 0 AS depth FROM seeds
  UNION ALL
  SELECT w.root, c.page_id, w.depth + 1
  FROM walk w JOIN p c ON c.page_id IN (2 * w.page_id + 1, 2 * w.page_id + 2)),
found AS (
  SELECT root, page_id, depth FROM walk WHERE depth > 0
  UNION ALL
  SELECT s.root, w.page_id, w.depth + 1 FROM seeds s JOIN walk w ON w.root = 0)
SELECT s.url AS seed_url, p.url, CAST(min(depth) AS INTEGER) AS depth
FROM found JOIN p USING (page_id) JOIN p s ON s.page_id = found.root GROUP BY 1, 2""",
)
def crawl_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crawl to the end of one large site with cycles: page n links to the pages 2n+1 and
    2n+2 and back to page 0, so that every seed reaches every page (I1)."""
    marked, pages = _tree_pages(spark, sf_dir)
    seeds = pages.groupBy("tld").agg(F.min_by("address", "page_id").alias("seed_url"))
    return crawl_op.crawl(
        marked, seeds, url="address",
        netloc=F.lit(".site.gov"), allowed_host=F.lit("site.gov"),
    )


def _tree_pages(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(address, html) of one large site, and its pages by number."""
    n = F.col("page_id")
    pages = table(spark, sf_dir, "pages").select(
        n,
        F.concat(
            F.lit("https://"), url_fn.host_of(F.col("url")), F.lit(".site.gov/p"), n
        ).alias("address"),
        F.regexp_extract("url", r"example\.([a-z]+)", 1).alias("tld"),
    )
    # Each page says which page links to it; two at most share a parent.
    links_down = pages.filter("page_id > 0").groupBy(
        F.floor((n - 1) / 2).cast("bigint").alias("page_id")
    ).agg(F.array_sort(F.collect_list("address")).alias("down"))
    root = F.lit(pages.filter("page_id = 0").select("address").first()[0])
    anchors = F.transform(
        F.array_append(F.coalesce("down", F.array().cast("array<string>")), root),
        lambda h: F.concat(F.lit('<p><a class="n" href="'), h, F.lit('#x">x</a>')),
    )
    marked = pages.join(links_down, "page_id", "left").select(
        "address", F.array_join(anchors, "").alias("html")
    )
    return marked, pages


@query(
    "crawl_seeds",
    """WITH RECURSIVE p AS (
  SELECT page_id, 'https://' || regexp_extract(url, '^https?://([^/?#]*)', 1) || '.site.gov/p'
    || page_id AS url FROM pages),
l AS (SELECT a.page_id AS page, b.page_id AS link FROM p a JOIN p b
  ON b.page_id IN (0, 2 * a.page_id + 1, 2 * a.page_id + 2)),
walk AS (
  SELECT page AS seed, link, 1 AS depth FROM l
  UNION
  SELECT w.seed, l.link, w.depth + 1 FROM walk w JOIN l ON l.page = w.link WHERE w.depth < 5)
SELECT s.url AS seed_url, t.url, CAST(min(depth) AS INTEGER) AS depth
FROM walk JOIN p s ON s.page_id = seed JOIN p t ON t.page_id = link GROUP BY 1, 2""",
)
def crawl_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same site crawled five links deep from every one of its pages."""
    marked, pages = _tree_pages(spark, sf_dir)
    return crawl_op.crawl(
        marked, pages.select(F.col("address").alias("seed_url")), 5, url="address",
        netloc=F.lit(".site.gov"), allowed_host=F.lit("site.gov"),
    )


# --- hosts and URLs -----------------------------------------------------------------------


@query(
    "url_parts",
    """WITH u AS (SELECT page_id, url,
    string_split(regexp_replace(regexp_extract(url, '^https?://([^/?#]*)', 1),
                                '\\.example\\..*$', ''), '.') AS labels,
    regexp_replace(regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1), '^/', '') AS path
  FROM pages),
v AS (SELECT page_id, url, path, labels[-1] AS domain,
      array_to_string([x for x in labels[:-2] if x <> 'www'], '.') AS subdomain FROM u)
SELECT page_id, regexp_replace(url, '[?#].*$', '') AS clean, domain, subdomain, path,
       'a+b+' || domain || '+' || subdomain || '+' || path AS db_id
FROM v""",
)
def url_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned URL, its parts and the composite id."""
    parts = table(spark, sf_dir, "pages").select(
        "page_id",
        url_fn.clean_url(F.col("url")).alias("clean"),
        url_fn.site_parts(
            text_fn.strip(F.col("url")), ["example.com", "example.net", "example.org"]
        ).alias("p"),
    )
    return parts.select(
        "page_id", "clean", "p.domain", "p.subdomain", "p.path",
        url_fn.composite_id(
            F.lit("a"), F.lit("b"), F.col("p.domain"), F.col("p.subdomain"), F.col("p.path")
        ).alias("db_id"),
    )


SPLIT_SUFFIXES = [
    ("com", "plain"), ("example.com", "plain"), ("org", "plain"), ("net", "plain"),
    ("example.net", "wildcard"), ("tionsh.example.net", "exception"),
]
_SPLIT_SQL = f"""
WITH hosts AS (SELECT DISTINCT regexp_extract(url, '^https?://([^/?#]*)', 1) AS host FROM pages),
s(suffix, kind) AS (VALUES {", ".join(str(r) for r in SPLIT_SUFFIXES)}),
t AS (SELECT host, len(string_split(host, '.')) AS n,
      unnest(range(1, len(string_split(host, '.')) + 1)) AS k FROM hosts),
m AS (SELECT t.host, t.n,
        CASE WHEN s.kind = 'wildcard' THEN k + 1 ELSE k END AS place,
        CASE WHEN s.kind = 'exception' THEN 1 ELSE 0 END AS exc
      FROM t JOIN s ON s.suffix = array_to_string(string_split(host, '.')[-k:], '.')
      WHERE k < t.n OR s.kind <> 'wildcard'),
b AS (SELECT host, max(n) AS n, arg_max(place - exc, place * 2 + exc) AS len FROM m GROUP BY host)
SELECT h.host,
  CASE WHEN len IS NULL THEN '' ELSE array_to_string(string_split(h.host, '.')[-len:], '.') END
    AS tld,
  CASE WHEN len IS NULL THEN string_split(h.host, '.')[-1]
       WHEN len = n THEN '' ELSE string_split(h.host, '.')[-len - 1] END AS domain,
  CASE WHEN len IS NULL THEN array_to_string(string_split(h.host, '.')[:-2], '.')
       WHEN len >= n - 1 THEN ''
       ELSE array_to_string(string_split(h.host, '.')[:n - len - 1], '.') END AS subdomain
FROM hosts h LEFT JOIN b USING (host)"""


@query("suffix_split", _SPLIT_SQL)
def suffix_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hosts split by the longest public suffix (P2, J4), as one column expression."""
    rows = hosts.split_host(
        _hosts(spark, sf_dir), "host", _suffixes(spark, SPLIT_SUFFIXES)
    )
    return rows.select("host", "tld", "domain", "subdomain")


@query("suffix_join", _SPLIT_SQL)
def suffix_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the join used for suffix tables too large to inline."""
    rows = hosts.split_host(
        _hosts(spark, sf_dir), "host", _suffixes(spark, SPLIT_SUFFIXES)
    )
    return rows.select("host", "tld", "domain", "subdomain")


@query(
    "candidates",
    f"""WITH {_HOSTS_SQL},
f AS (SELECT CASE WHEN subdomain = '' OR subdomain = domain THEN domain || '.' || tld
             ELSE subdomain || '.' || domain || '.' || tld END AS host FROM parts)
SELECT host, 'https://' || host AS schematized_url, CAST(r AS INTEGER) AS rank,
  CASE r WHEN 0 THEN 'https://' WHEN 1 THEN 'https://www.' WHEN 2 THEN 'http://www.'
         ELSE 'http://' END || host AS candidate_url
FROM f, range(4) t(r)""",
)
def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranked addresses to try per host."""
    split = hosts.split_host(_hosts(spark, sf_dir), "host", _suffixes(spark)).select(
        url_fn.join_host(F.col("subdomain"), F.col("domain"), F.col("tld")).alias("host")
    ).withColumn("schematized_url", url_fn.with_scheme(F.col("host")))
    return routes.url_candidates(split, "schematized_url")


_FILTER_TERMS = ("blog", "spam", "free")


@query(
    "filters",
    f"""WITH {_HOSTS_SQL}
SELECT host, tld, domain, subdomain, 'https://' || host || '/' AS url FROM parts
WHERE tld IN ('example.com', 'example.net') AND domain <> ''
  AND NOT regexp_matches(host, '{"|".join(_FILTER_TERMS)}')
  AND host NOT LIKE '%sh.example.net' AND host <> 'www.ththhe.example.com'""",
)
def site_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tld, empty domain, term, ending and exact-URL filters."""
    rows = hosts.split_host(_hosts(spark, sf_dir), "host", _suffixes(spark)).drop("pos")
    rows = filters.keep_tlds(filters.has_domain(rows), ["example.com", "example.net"])
    rows = filters.exclude_terms(rows, "host", _FILTER_TERMS).withColumn(
        "url", F.concat(url_fn.with_scheme(F.col("host")), F.lit("/"))
    )
    return filters.exclude_urls(
        rows, "url", exact=["https://www.ththhe.example.com/"], suffixes=["sh.example.net/"]
    )


@query(
    "host_text",
    """WITH p AS (SELECT p_partkey, p_name, p_type FROM part)
SELECT p_partkey, lower(p_name) AS cleaned,
  array_to_string([upper(x[1]) || x[2:] for x in
      regexp_extract_all(lower(p_type || '-o''' || p_name), '[a-z]+|[^a-z]+')], '') AS titled,
  CASE WHEN p_partkey % 3 = 0 THEN '' WHEN p_partkey % 3 = 1 THEN 'a' || p_partkey
       ELSE 'wwwx.b' || p_partkey END AS subdomain
FROM p""",
)
def host_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host text, title case and www rules."""
    n = F.col("p_partkey").cast("string")
    raw = (
        F.when(F.col("p_partkey") % 3 == 0, "www")
        .when(F.col("p_partkey") % 3 == 1, F.concat(F.lit("www.a"), n))
        .otherwise(F.concat(F.lit("wwwx.b"), n))
    )
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        text_fn.clean_host_text(F.concat(F.lit("\t "), "p_name", F.lit(" \n"))).alias("cleaned"),
        text_fn.title_case(F.concat("p_type", F.lit("-o'"), "p_name")).alias("titled"),
        text_fn.drop_www_prefix(text_fn.blank_bare_www(raw)).alias("subdomain"),
    )


# --- dedupe and joins ---------------------------------------------------------------------


@query(
    "keep_first",
    """WITH u AS (SELECT page_id, url,
  string_split(regexp_extract(url, '^https?://([^/?#]*)', 1), '.') AS l FROM pages)
SELECT page_id, url, array_to_string(l[:-4], '.') AS subdomain, l[-3] AS domain,
       array_to_string(l[-2:], '.') AS tld
FROM u
QUALIFY row_number() OVER (PARTITION BY array_to_string(l, '.') ORDER BY page_id) = 1""",
)
def keep_first_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First page per (subdomain, domain, tld)."""
    rows = hosts.split_host(
        table(spark, sf_dir, "pages").select("page_id", "url"), "url", _suffixes(spark)
    )
    return dedupe.keep_first(rows, ["subdomain", "domain", "tld"], ["page_id"])


@query(
    "keep_first_except",
    """SELECT user_id, event_type, CAST(ts AS DATE) AS day, min(event_id) AS event_id,
  arg_min(value, event_id) AS value FROM events GROUP BY 1, 2, 3""",
)
def keep_first_except_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First row over all columns but one."""
    rows = table(spark, sf_dir, "events").select(
        "user_id", "event_type", F.to_date("ts").alias("day"), "event_id", "value"
    )
    return dedupe.keep_first_except(rows, "value", ["event_id"])


@query(
    "registry_join",
    f"""WITH {_HOSTS_SQL},
reg AS (SELECT domain, tld AS tld_fed, min(pos) AS rpos FROM parts GROUP BY 1, 2),
s AS (SELECT * FROM parts WHERE subdomain <> ''),
j AS (SELECT r.domain, r.tld_fed, r.rpos, s.subdomain AS subdomain_sites, s.tld AS tld_sites,
        s.pos AS spos, coalesce(s.host, r.domain || '.' || r.tld_fed) AS site
      FROM reg r LEFT JOIN s USING (domain))
SELECT domain, tld_fed, subdomain_sites, tld_sites, site FROM j
QUALIFY row_number() OVER (PARTITION BY site ORDER BY rpos, spos NULLS FIRST) = 1""",
)
def registry_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registrable domains with their sites; those without get their own name."""
    registry, sites, _ = _derived_inputs(spark, sf_dir)
    merged = inventory_plan.merge_registry_sites(
        registry, sites.filter("subdomain <> ''"), domain_type=None
    )
    order = inventory_plan._REGISTRY_ORDER + inventory_plan._SITE_ORDER
    return dedupe.keep_first(merged, ["site"], order).select(
        "domain", "tld_fed", "subdomain_sites", "tld_sites", "site"
    )


@query(
    "host_counts",
    """SELECT count(*) AS n_pages, count(DISTINCT regexp_extract(url, '^https?://([^/?#]*)', 1))
  AS n_hosts, count(DISTINCT regexp_replace(url, '[?#].*$', '')) AS n_urls FROM pages""",
)
def host_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct counts (G6, G9): distinct rows first, so no task holds all values."""
    pages = table(spark, sf_dir, "pages").select(
        url_fn.host_of(F.col("url")).alias("host"), url_fn.clean_url(F.col("url")).alias("clean")
    )
    return pages.agg(
        F.count("*").alias("n_pages"),
        F.count_distinct("host").alias("n_hosts"),
        F.count_distinct("clean").alias("n_urls"),
    )


@query(
    "latest",
    """SELECT user_id, event_type, event_id, ts, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type
                           ORDER BY ts DESC, event_id DESC) = 1""",
)
def latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last event per user and type."""
    rows = table(spark, sf_dir, "events").select(
        "user_id", "event_type", "event_id", "ts", "value"
    )
    return dedupe.latest_per_key(rows, ["user_id", "event_type"], ["ts", "event_id"])


# --- routes and inventory -----------------------------------------------------------------

_PROBES_SQL = """
probes AS (
  SELECT regexp_extract(url, '^https?://[^/?#]*') AS candidate_url, page_id AS probed_at,
    CASE WHEN page_id % 11 = 0 THEN 'timeout' WHEN page_id % 13 = 0 THEN 'error'
         ELSE 'response' END AS outcome,
    CASE WHEN page_id % 11 = 0 OR page_id % 13 = 0 THEN NULL WHEN page_id % 5 = 0 THEN 404
         WHEN page_id % 7 = 0 THEN 204 ELSE 200 END AS status,
    CASE WHEN page_id % 3 = 0 THEN 'https://www.' ELSE 'https://' END
      || regexp_extract(url, '^https?://([^/?#]*)', 1) || '/' AS final_url
  FROM pages),
decisive AS (
  SELECT * FROM (SELECT * FROM probes
    QUALIFY row_number() OVER (PARTITION BY candidate_url ORDER BY probed_at DESC) = 1)
  WHERE outcome = 'timeout' OR status < 400)"""
_LADDER = """CASE r WHEN 0 THEN 'https://' WHEN 1 THEN 'https://www.' WHEN 2 THEN 'http://www.'
  ELSE 'http://' END"""
_BEST = """arg_min(CASE WHEN outcome = 'timeout' THEN 'timeout' WHEN status = 200 THEN final_url
  ELSE '-' END, r)"""


def _probe_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A probe log from the observed page addresses, outcomes by page number."""
    n = F.col("page_id")
    failed = (n % 11 == 0) | (n % 13 == 0)
    return table(spark, sf_dir, "pages").select(
        F.regexp_extract("url", "^https?://[^/?#]*", 0).alias("candidate_url"),
        F.when(n % 11 == 0, "timeout").when(n % 13 == 0, "error").otherwise("response")
        .alias("outcome"),
        F.when(failed, None).when(n % 5 == 0, 404).when(n % 7 == 0, 204).otherwise(200)
        .alias("status"),
        F.concat(
            F.when(n % 3 == 0, "https://www.").otherwise("https://"),
            url_fn.host_of(F.col("url")), F.lit("/"),
        ).alias("final_url"),
        n.alias("probed_at"),
    )


@query(
    "routeable",
    f"""WITH {_HOSTS_SQL}, {_PROBES_SQL},
best AS (SELECT host, nullif({_BEST}, '-') AS routeable_url
  FROM hosts, range(4) t(r) JOIN decisive ON candidate_url = {_LADDER} || host GROUP BY host)
SELECT h.host, b.routeable_url FROM hosts h JOIN best b USING (host)
WHERE b.routeable_url IS NOT NULL AND b.routeable_url <> 'timeout'
QUALIFY row_number() OVER (PARTITION BY b.routeable_url ORDER BY h.pos) = 1""",
)
def routeable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reachable address per host from the probe log."""
    sites = _hosts(spark, sf_dir)
    resolved = routes.resolve_routes(
        routes.url_candidates(sites, "host"), _probe_log(spark, sf_dir), "host", "probed_at"
    )
    routed = routes.reachable(routes.attach_routes(sites, resolved, "host"))
    return dedupe.keep_first(routed, ["routeable_url"], ["pos"]).drop("pos")


_OWNERS_SQL = """
  CASE WHEN len(domain) % 5 = 0 THEN 'State' ELSE 'Federal Agency - Executive' END AS type,
  CASE len(domain) % 3 WHEN 0 THEN ' U.S. Department of Agriculture'
    WHEN 1 THEN 'Department of Justice' ELSE 'Department of Labor ' END AS agency,
  CASE WHEN domain LIKE 't%' THEN 'USDA' WHEN domain LIKE '%e%' THEN 'OCIO FBI Bureu'
    ELSE 'Else ' || domain END AS org"""


def _derived_inputs(
    spark: SparkSession, sf_dir: str
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Registry, seed sites and suffixes from the hosts of the pages."""
    suffixes = _suffixes(spark)
    split = hosts.split_host(_hosts(spark, sf_dir), "host", suffixes)

    def order(pos: str) -> list:
        return [
            F.lit(0).alias("source_idx"), F.lit("").alias("file_path"),
            F.lit(0).cast("bigint").alias("file_block"), F.col(pos).alias("file_row"),
        ]

    size = F.length("domain")
    registry = (
        split.groupBy("domain", "tld")
        .agg(F.min("pos").alias("pos"))
        .select(
            F.concat_ws(".", "domain", "tld").alias("Domain Name"),
            F.when(size % 5 == 0, "State").otherwise(filters.EXECUTIVE).alias("Domain Type"),
            F.when(size % 3 == 0, " U.S. Department of Agriculture")
            .when(size % 3 == 1, "Department of Justice")
            .otherwise("Department of Labor ").alias("Agency"),
            F.when(F.col("domain").startswith("t"), "USDA")
            .when(F.col("domain").contains("e"), "OCIO FBI Bureu")
            .otherwise(F.concat(F.lit("Else "), "domain")).alias("Organization"),
            "tld", "domain", F.lit("").alias("subdomain"), *order("pos"),
        )
    )
    sites = split.select(
        F.col("host").alias("site"), "tld", "domain", "subdomain", *order("pos")
    )
    return registry, sites, suffixes


_RENAMED_SQL = """
  CASE trim(agency) WHEN 'U.S. Department of Agriculture' THEN 'Department of Agriculture'
    ELSE trim(agency) END AS "Agency",
  CASE trim(agency)
    WHEN 'U.S. Department of Agriculture' THEN
      CASE WHEN org = 'USDA' THEN 'Department of Agriculture'
           WHEN contains(org, 'OCIO') THEN 'Office of the Chief Information Officer' ELSE org END
    WHEN 'Department of Justice' THEN
      CASE WHEN contains(org, 'Bureu') THEN 'Federal Bureau of Investigation' ELSE org END
    ELSE CASE WHEN contains(org, 'OCIO') THEN 'Office of the Chief Information Officer'
           ELSE org END END AS "Organization" """

_FINAL_SQL = f"""
routed AS (
  SELECT n.*, b.routeable_url FROM named n JOIN best b USING (schematized_url)
  WHERE b.routeable_url NOT IN ('-', 'timeout')
  QUALIFY row_number() OVER (PARTITION BY b.routeable_url ORDER BY rpos, spos NULLS FIRST) = 1),
split AS (
  SELECT r.type, r.agency, r.org, r.rpos, r.spos, r.routeable_url,
    string_split(regexp_extract(routeable_url, '^https?://([^/?#]*)', 1), '.') AS l FROM routed r),
split2 AS (
  SELECT type, agency, org, rpos, spos, routeable_url, array_to_string(l[-2:], '.') AS tld,
    l[-3] AS domain, CASE WHEN array_to_string(l[:-4], '.') = 'www' THEN ''
      ELSE array_to_string(l[:-4], '.') END AS subdomain FROM split),
g4 AS (
  SELECT * FROM split2 QUALIFY row_number() OVER (
    PARTITION BY type, agency, org, subdomain, domain, tld ORDER BY rpos, spos NULLS FIRST) = 1),
g5 AS (
  SELECT type, agency, org, rpos, spos, routeable_url, tld, domain,
    regexp_replace(subdomain, '^www\\.', '') AS subdomain FROM g4
  QUALIFY row_number() OVER (PARTITION BY regexp_replace(subdomain, '^www\\.', ''), domain, tld
                             ORDER BY rpos, spos NULLS FIRST) = 1)
SELECT type AS "Domain Type", {_RENAMED_SQL}, routeable_url, subdomain, domain, tld FROM g5"""


@query(
    "inventory",
    f"""WITH {_HOSTS_SQL}, {_PROBES_SQL},
reg AS (SELECT domain, tld AS tld_fed, min(pos) AS rpos, {_OWNERS_SQL}
        FROM parts GROUP BY domain, tld),
j AS (SELECT r.*, s.subdomain AS sub, s.pos AS spos,
        coalesce(s.host, r.domain || '.' || r.tld_fed) AS site
      FROM reg r LEFT JOIN parts s USING (domain) WHERE r.type = 'Federal Agency - Executive'),
g1 AS (SELECT * FROM j
       QUALIFY row_number() OVER (PARTITION BY site ORDER BY rpos, spos NULLS FIRST) = 1),
named AS (
  SELECT type, agency, org, rpos, spos, 'https://' || CASE WHEN coalesce(sub, '') = ''
      OR sub = domain THEN domain || '.' || tld_fed
      ELSE sub || '.' || domain || '.' || tld_fed END AS schematized_url FROM g1
  WHERE NOT regexp_matches(site, '{"|".join(filters.NON_PUBLIC_TERMS)}')
  QUALIFY row_number() OVER (PARTITION BY schematized_url ORDER BY rpos, spos NULLS FIRST) = 1),
best AS (SELECT schematized_url, {_BEST} AS routeable_url
  FROM named, range(4) t(r) JOIN decisive ON candidate_url = {_LADDER} || schematized_url[9:]
  GROUP BY schematized_url), {_FINAL_SQL}""",
)
def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole inventory build from registry, seed sites and probe log (2.9-f)."""
    registry, sites, suffixes = _derived_inputs(spark, sf_dir)
    built = inventory_plan.build_inventory(
        registry, suffixes, _probe_log(spark, sf_dir), sites, probed_at="probed_at"
    )
    return built.select(*schemas.INVENTORY.names)


@query(
    "inventory_single_source",
    f"""WITH {_HOSTS_SQL}, {_PROBES_SQL},
reg AS (SELECT domain, tld, subdomain, pos AS rpos, NULL AS spos, {_OWNERS_SQL} FROM parts),
named AS (
  SELECT type, agency, org, rpos, spos, 'https://' || CASE WHEN subdomain = ''
      OR subdomain = domain THEN domain || '.' || tld
      ELSE subdomain || '.' || domain || '.' || tld END AS schematized_url FROM reg
  WHERE type = 'Federal Agency - Executive'
  QUALIFY row_number() OVER (PARTITION BY schematized_url ORDER BY rpos) = 1),
best AS (SELECT schematized_url, {_BEST} AS routeable_url
  FROM named, range(4) t(r) JOIN decisive ON candidate_url = {_LADDER} || schematized_url[9:]
  GROUP BY schematized_url), {_FINAL_SQL}""",
)
def inventory_single_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The build with the registry as only source: a registry of hosts."""
    registry, sites, suffixes = _derived_inputs(spark, sf_dir)
    owners = registry.select("domain", "tld", "Domain Type", "Agency", "Organization")
    of_hosts = sites.join(owners, ["domain", "tld"])
    built = inventory_plan.build_inventory(
        of_hosts, suffixes, _probe_log(spark, sf_dir), probed_at="probed_at"
    )
    return built.select(*schemas.INVENTORY.names)


_RENAME_SEGMENTS = (
    rename.AgencyRule(
        "BUILDING",
        (rename.OrgRule("Fives", has=("5",), lacks="55"), rename.OrgRule("Ones", has=("11", "91"))),
        agency_to="Construction",
    ),
    rename.AgencyRule("HOUSE", (rename.OrgRule(title=True),), contains=True),
    rename.AgencyRule(
        "MACHINERY",
        (rename.OrgRule("First", equal=("Customer#000000001",), agency_to="Tools"),
         rename.OrgRule("Sevens", has=("7",), agency_to="Tools")),
    ),
    rename.AgencyRule("AUTOMOBILE", (rename.OrgRule("Cars"),)),
)


@query(
    "rename",
    """SELECT c_custkey,
  CASE WHEN c_mktsegment = 'BUILDING' THEN 'Construction'
       WHEN c_mktsegment = 'MACHINERY' AND (c_name = 'Customer#000000001' OR contains(c_name, '7'))
         THEN 'Tools' ELSE c_mktsegment END AS agency,
  CASE WHEN c_mktsegment = 'BUILDING' THEN
         CASE WHEN contains(c_name, '5') AND NOT contains(c_name, '55') THEN 'Fives'
              WHEN contains(c_name, '11') OR contains(c_name, '91') THEN 'Ones' ELSE c_name END
       WHEN contains(c_mktsegment, 'HOUSE') THEN c_name
       WHEN c_mktsegment = 'MACHINERY' THEN
         CASE WHEN c_name = 'Customer#000000001' THEN 'First'
              WHEN contains(c_name, '7') THEN 'Sevens' ELSE c_name END
       WHEN c_mktsegment = 'AUTOMOBILE' THEN 'Cars' ELSE c_name END AS organization
FROM customer""",
)
def rename_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordered rename rules over padded names."""
    padded = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.concat(F.lit(" "), "c_mktsegment", F.lit("\t")).alias("agency"),
        F.concat("c_name", F.lit("\n")).alias("organization"),
    )
    return rename.rename_by_rules(padded, "agency", "organization", _RENAME_SEGMENTS)


# --- dispatch -----------------------------------------------------------------------------


@query(
    "batches",
    """WITH i AS (SELECT c_custkey, c_mktsegment, c_name,
  (row_number() OVER (ORDER BY c_custkey) - 1) // 10 AS batch_id FROM customer)
SELECT batch_id, count(*) AS n, min(c_custkey) AS min_key, max(c_custkey) AS max_key,
       string_agg(c_name, ',' ORDER BY c_custkey) AS names
FROM i WHERE c_mktsegment = 'BUILDING' GROUP BY batch_id""",
)
def batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches of ten consecutive customers, filtered after the cut."""
    made = batching.batch_rows(
        table(spark, sf_dir, "customer"), 10, ["c_custkey"],
        message_body(["c_custkey", "c_name"]), text_fn.strip(F.col("c_mktsegment")) == "BUILDING",
    )
    keys = F.transform(
        "entries",
        lambda e: F.get_json_object(e["MessageBody"], "$.c_custkey").cast("bigint"),
    )
    names = F.transform("entries", lambda e: F.get_json_object(e["MessageBody"], "$.c_name"))
    return made.select(
        "batch_id",
        _long(F.size("entries")).alias("n"),
        F.array_min(keys).alias("min_key"),
        F.array_max(keys).alias("max_key"),
        F.array_join(names, ",").alias("names"),
    )


@query(
    "messages",
    """SELECT CAST(n_nationkey AS VARCHAR) AS "domain", n_name AS "Agency",
  CASE WHEN n_regionkey = 0 THEN NULL ELSE CAST(n_regionkey AS VARCHAR) END AS "Organization"
FROM nation""",
)
def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows to messages, through batches and queue events, and back."""
    rows = table(spark, sf_dir, "nation").select(
        "n_nationkey",
        F.col("n_nationkey").cast("string").alias("domain"),
        F.col("n_name").alias("Agency"),
        F.when(F.col("n_regionkey") != 0, F.col("n_regionkey").cast("string"))
        .alias("Organization"),
    )
    made = batching.batch_rows(
        rows, 10, ["n_nationkey"], message_body(["domain", "Agency", "Organization"])
    )
    path = scratch_path(spark, "events")
    message_io.batches_to_events(made).write.text(path)
    return events_op.from_events(message_io.read_events(spark, path)).filter("NOT bad").select(
        "domain", "Agency", "Organization"
    )


@query(
    "customer_messages",
    """SELECT '1' AS "Id", count(*) AS n, count(DISTINCT c_custkey) AS n_keys FROM customer""",
)
def customer_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One message per row, for every customer."""
    sent = events_op.to_messages(table(spark, sf_dir, "customer"))
    key = F.get_json_object("MessageBody", "$.c_custkey").cast("bigint")
    return sent.groupBy("Id").agg(
        F.count("*").alias("n"), F.count_distinct(key).alias("n_keys")
    )


# --- scan records and history -------------------------------------------------------------


@query(
    "retention",
    """SELECT event_id, CAST(ts AS DATE) AS day FROM events
WHERE CAST(ts AS DATE) >= (SELECT max(CAST(ts AS DATE)) FROM events) - 10""",
)
def retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events not older than ten days at the last one."""
    rows = table(spark, sf_dir, "events").select("event_id", F.to_date("ts").alias("day"))
    return records.retain(rows, "day", F.lit(rows.agg(F.max("day")).first()[0]))


@query(
    "issue_count",
    """SELECT event_id, CASE event_id % 4 WHEN 0 THEN 0 WHEN 3 THEN NULL
  ELSE CAST(json_extract_string(props, '$.k') AS INTEGER) % 5 END AS n_issues FROM events""",
)
def issue_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Issues of double-encoded results; without a list 0, unreadable text NULL."""
    n = F.col("event_id") % 4
    found = F.array_repeat(F.struct(F.col("props").alias("context")), _n_issues())
    result = F.when(n == 0, F.to_json(F.struct("event_type"))).when(n == 3, F.lit("oops")).otherwise(
        F.to_json(F.struct(F.col("event_type").alias("documentTitle"), found.alias("issues")))
    )
    return table(spark, sf_dir, "events").select(
        "event_id", issue_count(result).alias("n_issues")
    )


def _n_issues():
    return F.get_json_object("props", "$.k").cast("int") % 5


_RECORDS_SQL = """
recs AS (SELECT event_type AS agency, 'org' || (user_id % 3) AS organization,
    'user' || user_id AS domain, CASE WHEN user_id % 2 = 0 THEN '' ELSE 's' || user_id % 4 END
      AS subdomain, CAST(json_extract_string(props, '$.k') AS INTEGER) % 5 AS n,
    CAST(ts AS DATE) AS scan_date, event_id FROM events),
cur AS (SELECT * FROM recs QUALIFY row_number() OVER (
    PARTITION BY agency, organization, domain, subdomain ORDER BY event_id DESC) = 1)"""


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed scan records from events: one scan per event, its issues by number."""
    user = F.col("user_id")
    issue = F.struct(*[
        F.lit(1).alias(f.name) if f.name == "typeCode" else F.lit(f.name).alias(f.name)
        for f in schemas.ISSUE
    ])
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("agency"),
        F.concat(F.lit("org"), user % 3).alias("organization"),
        F.concat(F.lit("user"), user).alias("domain"),
        F.when(user % 2 == 0, "").otherwise(F.concat(F.lit("s"), user % 4)).alias("subdomain"),
        _n_issues().alias("number_of_errors"),
        F.concat(F.lit("https://user"), user, F.lit(".gov/")).alias("routeable_url"),
        F.lit("t").alias("document_title"),
        F.array_repeat(issue, _n_issues()).alias("issues"),
        F.to_date("ts").alias("scan_date"),
        "event_id",
    )


@query(
    "share_by_owner",
    f"""WITH {_RECORDS_SQL}
SELECT agency, organization, count(*) AS n_records, count(*) FILTER (n = 0) AS n_accessible,
  count(*) FILTER (n = 0) / count(*) AS accessible_share FROM cur GROUP BY 1, 2""",
)
def share_by_owner(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accessible share of the current records per owner."""
    current = records.latest_records(_records(spark, sf_dir), "event_id")
    return records.accessible_share(current, ["agency", "organization"])


@query(
    "history",
    """WITH u AS (SELECT CAST(ts AS DATE) AS snapshot_date, user_id,
    count(*) FILTER (event_type = 'error') AS n FROM events GROUP BY 1, 2)
SELECT snapshot_date, count(*) AS n_records, count(*) FILTER (n = 0) AS n_accessible,
  count(*) FILTER (n = 0) / count(*) AS accessible_share FROM u GROUP BY 1""",
)
def daily_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of users without an error event, per day."""
    daily = table(spark, sf_dir, "events").groupBy(
        F.to_date("ts").alias("snapshot_date"), "user_id"
    ).agg(F.count_if(F.col("event_type") == "error").alias("n"))
    return records.accessible_share(daily, ["snapshot_date"], F.col("n"))


@query(
    "record_keys",
    f"""WITH {_RECORDS_SQL}
SELECT event_id, agency || '/' || organization || '/' || domain ||
    CASE WHEN subdomain = '' THEN '' ELSE '/' || subdomain END AS "key",
  CAST(n AS VARCHAR) AS "numberOfErrors", strftime(scan_date, '%Y-%m-%d') AS "scanDate",
  CASE WHEN subdomain = '' THEN domain ELSE subdomain || '.' || domain END || '.gov' AS host
FROM recs""",
)
def record_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Storage keys, hosts and stored text fields."""
    rows = _records(spark, sf_dir)
    return rows.select(
        "event_id",
        url_fn.record_key(*[F.col(k) for k in records.RECORD_KEYS]).alias("key"),
        F.size("issues").cast("string").alias("numberOfErrors"),
        F.date_format("scan_date", "yyyy-MM-dd").alias("scanDate"),
        url_fn.full_host(F.col("subdomain"), F.col("domain")).alias("host"),
    )


@query(
    "record_files",
    f"""WITH {_RECORDS_SQL}
SELECT agency, organization, domain, subdomain, n AS number_of_errors,
  'https://' || domain || '.gov/' AS routeable_url, scan_date FROM cur""",
)
def record_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records exported as files, read back and consolidated."""
    current = records.latest_records(_records(spark, sf_dir), "event_id").drop("event_id")
    exported, data = scratch_path(spark, "records"), scratch_path(spark, "data")
    record_io.write_record_files(current, exported)
    stored = record_io.read_record_files(spark, exported, one_per_file=False)
    readable, _ = records.split_unreadable(stored)
    record_io.write_records(records.from_files(readable), data)
    return record_io.read_records(spark, data).drop("document_title", "issues")


@query(
    "history_file",
    f"""WITH {_RECORDS_SQL}
SELECT scan_date AS snapshot_date, count(*) FILTER (n = 0) / count(*) AS accessible_share
FROM recs GROUP BY 1""",
)
def history_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily shares appended to the history table, exported as one document and read back
    (S6, S9, U2)."""
    shares = records.accessible_share(_records(spark, sf_dir), ["scan_date"])
    table_path, file_path = scratch_path(spark, "history"), scratch_path(spark, "hist")
    history_io.append_history(shares, F.col("scan_date"), table_path)
    history_io.write_history_file(history_io.read_history(spark, table_path), file_path)
    return history_io.read_history_file(spark, file_path)


@query(
    "joined_results",
    f"""WITH {_RECORDS_SQL},
kept AS (SELECT * FROM recs WHERE scan_date >= (SELECT max(scan_date) FROM recs) - 10),
last AS (SELECT * FROM kept QUALIFY row_number() OVER (
  PARTITION BY agency, organization, domain, subdomain ORDER BY event_id DESC) = 1)
SELECT count(*) AS n_records, count(*) FILTER (n = 0) AS n_accessible,
  count(*) FILTER (n = 0) / count(*) AS accessible_share FROM last""",
)
def joined_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The results joiner: stored records to table and share, within retention (entry 3)."""
    rows = _records(spark, sf_dir)
    exported = scratch_path(spark, "records")
    record_io.write_record_files(
        records.latest_records(rows, "event_id").drop("event_id"), exported
    )
    as_of = F.lit(rows.agg(F.max("scan_date")).first()[0])
    return results.join_results(
        spark, exported, scratch_path(spark, "data"), scratch_path(spark, "history"), as_of,
        one_per_file=False,
    )


# --- page scan ----------------------------------------------------------------------------


@query(
    "page_issues",
    rf"""WITH d AS (SELECT {_MARKUP} AS doc FROM pages),
c AS (
  SELECT 'WCAG2A.Principle1.Guideline1_3.1_3_1.H49.B' AS code, 'warning' AS type,
         len(regexp_extract_all(doc, '(?i)<b[\s/>]')) AS n FROM d
  UNION ALL SELECT 'WCAG2A.Principle1.Guideline1_3.1_3_1.H49.I', 'warning',
         len(regexp_extract_all(doc, '(?i)<i[\s/>]')) FROM d
  UNION ALL SELECT 'WCAG2A.Principle1.Guideline1_1.1_1_1.H37', 'error',
         len([x for x in regexp_extract_all(doc, '(?i)<img[\s/>][^>]*')
              if NOT contains(lower(x), 'alt')]) FROM d
  UNION ALL SELECT 'WCAG2A.Principle3.Guideline3_1.3_1_1.H57.2', 'error',
         CASE WHEN regexp_matches(doc, '(?i)<html\s[^>]*lang="[^"]') THEN 0 ELSE 1 END FROM d
  UNION ALL SELECT 'WCAG2A.Principle2.Guideline2_4.2_4_2.H25.1.NoTitleEl', 'error',
         CASE WHEN regexp_matches(doc, '(?i)<title>') THEN 0 ELSE 1 END FROM d
  UNION ALL SELECT 'WCAG2A.Principle4.Guideline4_1.4_1_2.H91.A.NoContent', 'error',
         len(regexp_extract_all(doc, '(?i)<a href="[^"]*">\s*</a>')) FROM d)
SELECT code, type, CAST(sum(n) AS BIGINT) AS n_issues, count(*) FILTER (n > 0) AS n_pages FROM c
GROUP BY 1, 2 HAVING sum(n) > 0""",
)
def page_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Issues of all pages by rule, warnings included (A1)."""
    scanned = scan.scan_pages(
        table(spark, sf_dir, "pages"), include_warnings=True, keep=["page_id"]
    )
    return (
        scan.explode_issues(scanned)
        .groupBy("code", "type", "page_id")
        .agg(F.count("*").alias("n"))
        .groupBy("code", "type")
        .agg(F.sum("n").alias("n_issues"), F.count("*").alias("n_pages"))
    )


# (number of the document modulo 10, markup, rule that the markup breaks or "")
_RULE_PIECES = [
    ('<img src="a.png">', "WCAG2A.Principle1.Guideline1_1.1_1_1.H37"),
    ('<img src="a.png" alt="">', ""),
    ('<iframe src="x"></iframe>', "WCAG2A.Principle2.Guideline2_4.2_4_1.H64.1"),
    ('<input type="text" name="q">', "WCAG2A.Principle1.Guideline1_3.1_3_1.H44"),
    ('<label for="q">q</label><input id="q"><!-- <img src="b"> -->', ""),
    ('<i id="k">k</i><i id="k">k</i>', "WCAG2A.Principle4.Guideline4_1.4_1_1.F77"),
    ('<meta http-equiv="refresh" content="5; url=/x">',
     "WCAG2A.Principle2.Guideline2_2.2_2_1.F41.2"),
    ('<form action="/s"><p>no</p></form>', "WCAG2A.Principle3.Guideline3_2.3_2_2.H32.2"),
    ('<a href="/x"><span> </span></a>', "WCAG2A.Principle4.Guideline4_1.4_1_2.H91.A.NoContent"),
    ('<form><button>go</button></form><a href="/y"><img src="a" alt="y"></a>', ""),
]


@query(
    "rule_hits",
    """WITH c AS (
  SELECT doc_id, CASE doc_id % 10 """
    + " ".join(f"WHEN {i} THEN '{code}'" for i, (_, code) in enumerate(_RULE_PIECES))
    + """ END AS code FROM documents
  UNION ALL SELECT doc_id, 'WCAG2A.Principle3.Guideline3_1.3_1_1.H57.2' FROM documents
    WHERE doc_id % 3 = 0
  UNION ALL SELECT doc_id, 'WCAG2A.Principle2.Guideline2_4.2_4_2.H25.1.EmptyTitle' FROM documents
    WHERE doc_id % 4 = 0
  UNION ALL SELECT doc_id, 'WCAG2A.Principle2.Guideline2_4.2_4_2.H25.1.NoTitleEl' FROM documents
    WHERE doc_id % 4 = 1)
SELECT code, count(*) AS n FROM c WHERE code <> '' GROUP BY code""",
)
def rule_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every rule over one made-up page per document, the whole text inside it (A1)."""
    n = F.col("doc_id")
    piece = F.lit(_RULE_PIECES[-1][0])
    for i, (markup, _) in enumerate(_RULE_PIECES[:-1]):
        piece = F.when(n % 10 == i, markup).otherwise(piece)
    escaped = F.replace(F.replace("text", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    html = F.concat(
        F.when(n % 3 == 0, '<html class="x">').otherwise("<html lang='en'>"),
        F.when(n % 4 == 0, "<title> </title>").when(n % 4 == 1, "").otherwise("<title>t</title>"),
        piece, F.lit("<p>"), escaped, F.lit("</p></html>"),
    )
    pages = table(spark, sf_dir, "documents").select("doc_id", html.alias("html"))
    return scan.explode_issues(scan.scan_pages(pages)).groupBy("code").agg(
        F.count("*").alias("n")
    )


@query(
    "scan_records",
    """WITH p AS (SELECT page_id, url, regexp_extract(url, '^https?://([^/?#]*)', 1) AS host,
    trim(replace(replace(replace(replace(replace(
      regexp_extract(html, '<title>([^<]*)</title>', 1), '&lt;', '<'), '&gt;', '>'),
      '&quot;', '"'), '&#x27;', ''''), '&amp;', '&')) AS title FROM pages)
SELECT host AS agency, 'pages' AS organization, string_split(host, '.')[-3] AS domain,
  array_to_string(string_split(host, '.')[:-4], '.') AS subdomain, 0 AS number_of_errors,
  url AS routeable_url, title AS document_title, DATE '2024-02-01' AS scan_date
FROM p""",
)
def scan_record_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scan records of all pages, each page a site of the inventory."""
    pages = table(spark, sf_dir, "pages")
    sites = hosts.split_host(
        pages.select(F.col("url").alias("routeable_url")), "routeable_url", _suffixes(spark)
    ).select(
        url_fn.host_of(F.col("routeable_url")).alias("Agency"),
        F.lit("pages").alias("Organization"), "domain", "subdomain", "routeable_url",
    )
    return results.scan_sites(sites, pages, F.lit("2024-02-01")).drop("issues")


# --- files and streams --------------------------------------------------------------------


@query(
    "stored_files",
    """SELECT c_nationkey AS nation, count(*) AS n_records, count(DISTINCT c_name) AS n_sites FROM customer
WHERE c_nationkey // 10 = 1 OR c_nationkey IN (3, 7) GROUP BY 1""",
)
def stored_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Record files by several prefixes and a name ending, then read in bulk."""
    path = scratch_path(spark, "stored")
    owner = F.format_string("r%02d", F.col("c_nationkey"))
    table(spark, sf_dir, "customer").select(
        owner.alias("owner"),
        F.col("c_nationkey").cast("string").alias("agency"),
        F.col("c_name").alias("domain"),
    ).write.partitionBy("owner").json(path)
    stored = record_io.read_record_files(
        spark, path, one_per_file=False, prefixes=["owner=r1", "owner=r03", "owner=r07", "owner=r9"]
    )
    return stored.groupBy(F.col("agency").cast("int").alias("nation")).agg(
        F.count("*").alias("n_records"), F.countDistinct("domain").alias("n_sites")
    )


@query(
    "registry_csv",
    """SELECT lower('S' || s_suppkey || '.fed.us') AS "Domain Name", 'Type, ' || s_nationkey
  AS "Domain Type", s_name AS "Agency", 'Org "' || s_suppkey || '"' AS "Organization",
  'fed.us' AS tld, 's' || s_suppkey AS domain, '' AS subdomain FROM supplier""",
)
def registry_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A registry file of suppliers, written and read."""
    path = scratch_path(spark, "registry")
    table(spark, sf_dir, "supplier").select(
        F.concat(F.lit(" S"), "s_suppkey", F.lit(".FED.us ")).alias("Domain Name"),
        F.concat(F.lit("Type, "), "s_nationkey").alias("Domain Type"),
        F.lit("unread").alias("City"),
        F.col("s_name").alias("Agency"),
        F.concat(F.lit('Org "'), "s_suppkey", F.lit('"')).alias("Organization"),
    ).write.csv(path, header=True, escape='"', quoteAll=True, ignoreLeadingWhiteSpace=False)
    rows = lists.read_registry(spark, path, hosts.default_suffixes(spark))
    return rows.drop(*lists.ORDER)


@query(
    "seed_lists",
    """SELECT 'c' || c_custkey || '.a.gov' AS site, 'gov' AS tld, 'a' AS domain,
  'c' || c_custkey AS subdomain FROM customer WHERE c_custkey % 3 <> 2
UNION ALL SELECT 'nation' || n_nationkey || '.mil', 'mil', 'nation' || n_nationkey, ''
FROM nation""",
)
def seed_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seed lists of different widths with headers and junk, one of them missing."""
    n = F.col("c_custkey")
    wide, narrow = scratch_path(spark, "wide"), scratch_path(spark, "narrow")
    table(spark, sf_dir, "customer").select(
        F.when(n % 3 == 2, F.concat(F.lit("X"), n, F.lit(".com")))
        .otherwise(F.concat(F.lit("C"), n, F.lit(".A.gov"))).alias("Domain"),
        "c_name", "c_acctbal",
    ).write.csv(wide, header=True)
    table(spark, sf_dir, "nation").select(
        F.concat(F.lit("nation"), "n_nationkey", F.lit(".MIL")).alias("domain name")
    ).write.csv(narrow, header=True)
    sites = lists.read_seed_sites(
        spark, [wide, scratch_path(spark, "missing"), narrow], hosts.default_suffixes(spark)
    )
    return sites.drop(*lists.ORDER)


@query(
    "dispatch",
    """WITH i AS (SELECT *, (row_number() OVER (ORDER BY c_custkey) - 1) // 10 AS batch_id
  FROM customer)
SELECT batch_id, count(*) AS n, CAST(sum(CAST(substr(c_name, 10) AS BIGINT)) AS BIGINT) AS key_sum
FROM i WHERE c_mktsegment = 'BUILDING' GROUP BY 1""",
)
def dispatch_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An inventory file written, read in file order, and batched."""
    path = scratch_path(spark, "inventory")
    lists.write_inventory(
        table(spark, sf_dir, "customer").orderBy("c_custkey").select(
            F.when(F.col("c_mktsegment") == "BUILDING", f" {filters.EXECUTIVE} ")
            .otherwise("Other").alias("Domain Type"),
            F.col("c_mktsegment").alias("Agency"),
            F.col("c_name").alias("Organization"),
            F.lit("").alias("subdomain"),
        ),
        path,
    )
    made = dispatch(lists.read_inventory(spark, path))
    names = F.transform(
        "entries",
        lambda e: F.substring(
            F.get_json_object(e["MessageBody"], "$.Organization"), 10, 20
        ).cast("bigint"),
    )
    return made.select(
        "batch_id", _long(F.size("entries")).alias("n"),
        F.aggregate(names, _long(F.lit(0)), lambda a, b: a + b).alias("key_sum"),
    )


_STREAM_SCHEMA = T.StructType([
    T.StructField("agency", T.StringType()),
    T.StructField("domain", T.StringType()),
    T.StructField("seq", T.LongType()),
    T.StructField("scan_date", T.DateType()),
])


def _run_intake(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Events as queue-event files through the stream: state table and dead letters."""
    n = F.col("event_id")
    body = F.when(n % 7 == 0, F.concat(F.lit('{"agency": '), n)).otherwise(
        F.to_json(F.struct(
            F.col("event_type").alias("agency"),
            F.concat(F.lit("user"), "user_id").alias("domain"),
            n.alias("seq"), F.to_date("ts").alias("scan_date"),
        ))
    )
    received = F.when(n % 11 == 0, "3").otherwise("1")
    record = F.struct(
        n.cast("string").alias("messageId"), body.alias("body"),
        F.create_map(F.lit("ApproximateReceiveCount"), received).alias("attributes"),
    )
    source, dead = scratch_path(spark, "arrivals"), scratch_path(spark, "dead")
    target = scratch_path(spark, "state")
    table(spark, sf_dir, "events").select(
        F.to_json(F.struct(F.array(record).alias("Records")))
    ).write.text(source)
    stream = stream_events.stream_events(
        spark, source, _STREAM_SCHEMA, one_per_file=False
    )
    state.consume(
        stream, target, dead, scratch_path(spark, "checkpoint"), ["agency", "domain"], "seq"
    )
    return target, dead


@query(
    "stream_state",
    """SELECT event_type AS agency, 'user' || user_id AS domain, max(event_id) AS seq,
  arg_max(CAST(ts AS DATE), event_id) AS scan_date
FROM events WHERE event_id % 7 <> 0 AND event_id % 11 <> 0 GROUP BY 1, 2""",
)
def stream_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages streamed in; the last per key."""
    target, _ = _run_intake(spark, sf_dir)
    return state.read_latest(spark, target, _STREAM_SCHEMA, ["agency", "domain"], "seq").select(
        *_STREAM_SCHEMA.names
    )


@query(
    "stream_dead_letters",
    """SELECT CAST(event_id AS VARCHAR) AS message_id,
  CASE WHEN event_id % 11 = 0 THEN 3 ELSE 1 END AS receive_count
FROM events WHERE event_id % 7 = 0 OR event_id % 11 = 0""",
)
def stream_dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages put aside: unreadable, or received too often."""
    _, dead = _run_intake(spark, sf_dir)
    return spark.read.option("basePath", dead).parquet(f"{dead}/batch=*").select(
        "message_id", "receive_count"
    )


@query(
    "stream_snapshot",
    """WITH cur AS (SELECT max(event_id) AS seq FROM events
  WHERE event_id % 7 <> 0 AND event_id % 11 <> 0
    AND CAST(ts AS DATE) >= (SELECT max(CAST(ts AS DATE)) FROM events) - 10
  GROUP BY event_type, user_id)
SELECT (SELECT max(CAST(ts AS DATE)) FROM events) AS snapshot_date,
  count(*) FILTER (seq % 2 = 0) / count(*) AS accessible_share FROM cur""",
)
def stream_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of the state within retention, added to the history."""
    target, _ = _run_intake(spark, sf_dir)
    last = table(spark, sf_dir, "events").agg(F.max(F.to_date("ts"))).first()[0]
    path = scratch_path(spark, "history")
    state.snapshot(
        spark, target, _STREAM_SCHEMA, path, F.lit(last), keys=["agency", "domain"], ts="seq",
        count=F.col("seq") % 2,
    )
    return history_io.read_history(spark, path)


@query(
    "stream_scan",
    """WITH p AS (SELECT page_id, url, regexp_extract(url, '^https?://([^/?#]*)', 1) AS host
  FROM pages),
last AS (SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY host ORDER BY url DESC) = 1)
SELECT host AS domain, url AS routeable_url, 0 AS number_of_errors,
  DATE '2024-02-01' AS scan_date FROM last""",
)
def stream_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One message per page streamed in, its page looked up in the folders of its key and scanned,
    the last record per site kept (entry 2 as a stream: T1, T2, A1, A2, T3)."""
    pages = table(spark, sf_dir, "pages")
    host = url_fn.host_of(F.col("url"))
    body = F.to_json(F.struct(
        F.lit("a").alias("Agency"), F.lit("o").alias("Organization"), host.alias("domain"),
        F.lit("").alias("subdomain"), F.col("url").alias("routeable_url"),
    ))
    source, target = scratch_path(spark, "arrivals"), scratch_path(spark, "state")
    record = F.struct(F.col("page_id").cast("string").alias("messageId"), body.alias("body"))
    pages.select(F.to_json(F.struct(F.array(record).alias("Records")))).write.text(source)
    laid_out = scratch_path(spark, "pages")
    page_io.write_pages(pages, laid_out, buckets=32)
    fetched = page_io.read_pages(spark, laid_out)
    state.consume(
        stream_events.stream_events(spark, source, one_per_file=False),
        target, scratch_path(spark, "dead"), scratch_path(spark, "checkpoint"),
        ts="routeable_url",
        to_records=lambda sites: results.scan_sites(sites, fetched, F.lit("2024-02-01")),
    )
    return state.read_latest(spark, target, schemas.SCAN_RECORD, ts="routeable_url").select(
        "domain", "routeable_url", "number_of_errors", "scan_date"
    )
