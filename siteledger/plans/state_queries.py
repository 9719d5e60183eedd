"""Registered queries of records over time, element trees, keyed state and versions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from siteledger.operators import records, scan
from siteledger.operators.tree_scan import TREE_RULES, scan_trees
from siteledger.plans import results
from siteledger.plans.case_queries import _filled, _sites, _values
from siteledger.plans.queries import _RECORDS_SQL, _STREAM_SCHEMA, ORACLES, _records, query, table
from siteledger.session import scratch_path
from siteledger.sources import history as history_io, records as record_io, removal
from siteledger.streaming import events as stream_events, folders, receives, state

# --- records over time --------------------------------------------------------------------

# A snapshot for each day, by a join of days with records.
_SNAPSHOTS_SQL = f"""{_RECORDS_SQL},
days AS (SELECT unnest(generate_series((SELECT min(scan_date) FROM recs), (SELECT max(scan_date) FROM recs),
    INTERVAL 1 DAY))::DATE AS snapshot_date),
snap AS (SELECT snapshot_date, r.* FROM days JOIN recs r
    ON r.scan_date BETWEEN snapshot_date - 10 AND snapshot_date
  QUALIFY row_number() OVER (PARTITION BY snapshot_date, agency, organization, domain, subdomain
    ORDER BY scan_date DESC, event_id DESC) = 1)"""


def _last_scan(rows: DataFrame):
    return F.lit(rows.agg(F.max("scan_date")).first()[0])


@query(
    "daily_shares",
    f"""WITH {_SNAPSHOTS_SQL}
SELECT agency, organization, snapshot_date, count(*) AS n_records,
  count(*) FILTER (n = 0) AS n_accessible, count(*) FILTER (n = 0) / count(*) AS accessible_share
FROM snap GROUP BY ALL""",
)
def daily_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a snapshot on each day would give, per owner, in one pass."""
    rows = _records(spark, sf_dir)
    return records.daily_shares(rows, ["agency", "organization"], last=_last_scan(rows), ts="event_id")


@query(
    "backfilled_history",
    f"""WITH {_SNAPSHOTS_SQL}
SELECT snapshot_date, count(*) FILTER (n = 0) / count(*) AS accessible_share FROM snap GROUP BY 1""",
)
def backfilled_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history of all days written at once, over one that had some of them already."""
    rows = _records(spark, sf_dir)
    path, last = scratch_path(spark, "history"), _last_scan(rows)
    results.backfill_history(rows.filter("event_id % 3 = 0"), path, last=last, ts="event_id")
    results.backfill_history(rows, path, last=last, ts="event_id")
    return history_io.read_history(spark, path)


# --- element trees ------------------------------------------------------------------------

# (markup of a page, [(technique, selector of the element that breaks the rule, its start tag)])
_TREES = [
    ("<ul><li>one<li><a href='{n}'><img alt=''></a></ul>",
     [("H91.A.NoContent", "ul:nth-child(1) > li:nth-child(2) > a:nth-child(1)", "<a href='{n}'>")]),
    ("<div id=d{n}><p>open<p><a href=x></a><div><a href=y>y</a></div></div><img>",
     [("H91.A.NoContent", "#d{n} > p:nth-child(2) > a:nth-child(1)", "<a href=x>"), ("H37", "img:nth-child(2)", "<img>")]),
    ("<fieldset><legend>l</legend><label>n <input></label></fieldset><fieldset><div><legend>l</legend><input name=q></div>",
     [("H71.NoLegend", "fieldset:nth-child(2)", "<fieldset>"),
      ("H44", "fieldset:nth-child(2) > div:nth-child(1) > input:nth-child(2)", "<input name=q>")]),
    ("<table><tr><th id=a{n}>1<td headers=a{n}>2<tr><td headers='a{n} b'>3</div></table><table><td headers=a{n}>4</table>",
     [("H43.IncorrectAttr", "table:nth-child(1) > tr:nth-child(2) > td:nth-child(1)", "<td headers='a{n} b'>"),
      ("H43.IncorrectAttr", "table:nth-child(2) > td:nth-child(1)", "<td headers=a{n}>")]),
    ("<h1>{h}</h1><div><h2><span>&nbsp;</span></h2></div><h3><img alt='{h}'></h3>",
     [("H42.2", "div:nth-child(2) > h2:nth-child(1)", "<h2>")]),
    ("<form><div><form id=f{n}></form><button type=button>x</button></div>",
     [("H32.2", "form:nth-child(1)", "<form>"), ("H32.2", "#f{n}", "<form id=f{n}>")]),
    ("<p id=x>{h}<div><b id=x>again</b></div></p></section>", [("F77", "#x", "<b id=x>")]),
    ("plain text of {h} & no element", []),
]
_ALWAYS = ("H57.2", "H25.1.NoTitleEl")  # none of the pages has a language or a title
_CODES = {technique: next(r.code for r in TREE_RULES if r.code.endswith(technique)) for _, found in _TREES for technique, _, _ in found}


@query(
    "tree_issues",
    f"""WITH f(part, code, selector, context) AS (VALUES {_values([
        (str(k), _CODES[t], selector, context) for k, (_, found) in enumerate(_TREES) for t, selector, context in found
    ])})
SELECT page_id, CAST(part AS INTEGER) AS part, code, replace(selector, '{{n}}', CAST(page_id AS VARCHAR)) AS selector,
  replace(context, '{{n}}', CAST(page_id AS VARCHAR)) AS context FROM pages, f""",
)
def tree_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules that need ancestry, over made-up pages with nested, unclosed and stray tags for every page (A1, M8)."""
    parts = F.array(*[F.struct(F.lit(k).alias("part"), _filled(markup).alias("html")) for k, (markup, _) in enumerate(_TREES)])
    pages = _sites(spark, sf_dir).select(F.col("n").cast("bigint").alias("page_id"), F.inline(parts))
    issues = scan.explode_issues(scan_trees(pages)).filter(~F.col("code").rlike("|".join(f"{t}$" for t in _ALWAYS)))
    return issues.select("page_id", "part", "code", "selector", "context")


@query("tree_page_issues", ORACLES["page_issues"])
def tree_page_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Issues of all pages by rule, read from their trees (A1)."""
    scanned = scan_trees(table(spark, sf_dir, "pages"), include_warnings=True, keep=["page_id"])
    per_page = scan.explode_issues(scanned).groupBy("code", "type", "page_id").agg(F.count("*").alias("n"))
    return per_page.groupBy("code", "type").agg(F.sum("n").alias("n_issues"), F.count("*").alias("n_pages"))


# --- versions and retention ---------------------------------------------------------------


@query(
    "record_versions",
    f"""WITH {_RECORDS_SQL},
half AS (SELECT * FROM recs WHERE event_id % 2 = 0 QUALIFY row_number() OVER (
  PARTITION BY agency, organization, domain, subdomain ORDER BY event_id DESC) = 1)
SELECT 1 AS version, agency, scan_date, count(*) AS n_records, CAST(sum(n) AS BIGINT) AS n_errors FROM half GROUP BY 2, 3
UNION ALL SELECT 2, agency, scan_date, count(*), CAST(sum(n) AS BIGINT) FROM cur GROUP BY 2, 3""",
)
def record_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs of the joiner leave two versions of its table, both readable."""
    rows, path = _records(spark, sf_dir), scratch_path(spark, "data")
    for found in (rows.filter("event_id % 2 = 0"), rows):
        record_io.write_records(records.latest_records(found, "event_id").drop("event_id"), path)

    def counts(version: int) -> DataFrame:
        return record_io.read_records(spark, path, version).groupBy(F.lit(version).alias("version"), "agency", "scan_date").agg(
            F.count("*").alias("n_records"), F.sum("number_of_errors").alias("n_errors")
        )

    return counts(1).unionAll(counts(2))


@query(
    "expired_records",
    f"""WITH {_RECORDS_SQL}
SELECT scan_date, count(*) AS n_records FROM recs
WHERE scan_date >= (SELECT max(scan_date) FROM recs) - 10 GROUP BY 1""",
)
def expired_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records whose expired dates were removed by a written plan."""
    rows, path, plan = _records(spark, sf_dir), scratch_path(spark, "dated"), scratch_path(spark, "plan")
    rows.drop("issues").hint("rebalance", "scan_date").write.partitionBy("scan_date").parquet(path)
    last = rows.agg(F.max("scan_date")).first()[0]
    removal.expired_folders(spark, path, "scan_date", last, records.RECORD_RETENTION_DAYS, plan)
    removal.remove_planned(spark, plan)
    return spark.read.parquet(path).groupBy("scan_date").agg(F.count("*").alias("n_records"))


# --- streams ------------------------------------------------------------------------------


def _deliveries(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    """(event, n) of every message, without a count of its own, and a folder for them to arrive in."""
    n = F.col("event_id")
    body = F.when(n % 7 == 0, F.concat(F.lit('{"agency": '), n)).otherwise(
        F.to_json(F.struct(
            F.col("event_type").alias("agency"), F.concat(F.lit("user"), "user_id").alias("domain"),
            n.alias("seq"), F.to_date("ts").alias("scan_date"),
        ))
    )
    sent = F.create_map(F.lit("SentTimestamp"), F.unix_millis(F.col("ts").cast("timestamp")).cast("string"))
    record = F.struct(n.cast("string").alias("messageId"), body.alias("body"), sent.alias("attributes"))
    event = F.to_json(F.struct(F.array(record).alias("Records")))
    return table(spark, sf_dir, "events").select(event.alias("value"), n.alias("n")), scratch_path(spark, "arrivals")


@query(
    "stream_receives",
    """SELECT 'dead' AS kind, CAST(event_id AS VARCHAR) AS id,
  CASE event_id % 5 WHEN 0 THEN 3 WHEN 1 THEN 2 ELSE 1 END AS number
FROM events WHERE event_id % 7 = 0 OR event_id % 5 = 0
UNION ALL SELECT 'kept', event_type || ' user' || user_id, max(event_id) FROM events WHERE event_id % 7 <> 0 GROUP BY 2""",
)
def stream_receives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages delivered once, twice or three times in different runs, counted by the stream."""
    messages, arrivals = _deliveries(spark, sf_dir)
    target, dead, checkpoint = (scratch_path(spark, name) for name in ("state", "dead", "checkpoint"))
    keys = ["agency", "domain"]
    for again in (messages, messages.filter("n % 5 < 2"), messages.filter("n % 5 = 0")):
        again.select("value").write.mode("append").text(arrivals)
        stream = stream_events.stream_events(spark, arrivals, _STREAM_SCHEMA, one_per_file=False, sent_at=True)
        receives.consume_counted(stream, target, dead, checkpoint, keys, "seq", delay="365 days")
    kept = state.read_latest(spark, target, _STREAM_SCHEMA, keys, "seq")
    return receives.read_counted(spark, dead).select(
        F.lit("dead").alias("kind"), F.col("message_id").alias("id"), F.col("receive_count").alias("number")
    ).unionAll(kept.select(F.lit("kept"), F.concat_ws(" ", *keys), "seq"))


@query(
    "stream_folders",
    """SELECT event_type AS agency, 'user' || user_id AS domain, max(event_id) AS seq,
  arg_max(CAST(ts AS DATE), event_id) AS scan_date
FROM events WHERE event_id % 7 <> 0 GROUP BY 1, 2""",
)
def stream_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages streamed in three runs into state kept in folders by key; the last run's batch runs twice."""
    messages, arrivals = _deliveries(spark, sf_dir)
    target, checkpoint, keys = scratch_path(spark, "state"), scratch_path(spark, "checkpoint"), ["agency", "domain"]

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        for _ in range(2):
            folders.upsert_folders(batch.filter("NOT bad"), target, batch_id, _STREAM_SCHEMA, keys, "seq", folders=8)

    for part in range(3):
        messages.filter(F.col("n") % 3 == part).select("value").write.mode("append").text(arrivals)
        state.run_available(stream_events.stream_events(spark, arrivals, _STREAM_SCHEMA, one_per_file=False), checkpoint, on_batch)
    return folders.read_folders(spark, target, _STREAM_SCHEMA)
