import pytest
from pyspark.sql import functions as F

from siteledger.plans.results import scan_sites
from siteledger.sources.pages import pages_of, read_pages, write_pages
from tests.conftest import rows

SITES = "Agency string, Organization string, domain string, subdomain string, routeable_url string"


def site(k):
    return ("A", "O", f"d{k}", "", f"https://d{k}.gov" + ("/?q" if k % 2 else ""))


@pytest.fixture(scope="module")
def laid_out(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("pages"))
    pages = spark.range(400).select(
        F.concat(F.lit("https://d"), "id", F.lit(".gov/")).alias("url"),
        F.concat(F.lit("<title>t</title><img src="), "id", F.lit(">")).alias("html"),
    )
    write_pages(pages.unionByName(spark.createDataFrame([(None, "no address")], "url string, html string")), path, buckets=16)
    return read_pages(spark, path), pages


def page_files(df):
    """(files the scan of the pages read, whether its folders were pruned by the other side), after a run."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves = [plan.executedPlan()] if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec" else [plan]
    while leaves:
        node = leaves.pop()
        if node.getClass().getSimpleName().endswith("QueryStageExec"):
            leaves.append(node.plan())
            continue
        if node.nodeName().startswith("Scan parquet") and "url#" in node.toString():
            text = node.toString()
            return node.metrics().get("numFiles").get().value(), "dynamicpruning" in text
        children = node.children()
        leaves += [children.apply(k) for k in range(children.size())]
    raise AssertionError("no scan of pages")


def test_files_read_fall_with_the_sites(spark, laid_out):
    table, _ = laid_out
    all_files = len(table.inputFiles())
    counts = []
    for n in (1, 3, 400):
        found = pages_of(table, spark.createDataFrame([site(k) for k in range(n)], SITES)).select("url")
        counts.append(page_files(found))
        assert found.count() == n
    assert all(pruned for _, pruned in counts)
    assert counts[0][0] <= all_files // 8 and counts[0][0] < counts[1][0] < counts[2][0] <= all_files


def test_more_keys_than_may_be_broadcast(spark, laid_out):
    table, _ = laid_out
    sites = spark.createDataFrame([site(7), site(9)], SITES)
    found = pages_of(table, sites, most=10)
    files, pruned = page_files(found.select("url"))
    assert pruned and files < len(table.inputFiles())
    assert {"https://d7.gov/", "https://d9.gov/"} <= {r.url for r in found.collect()}


def test_scan_of_laid_out_pages_is_the_scan_of_all(spark, laid_out):
    table, pages = laid_out
    sites = spark.createDataFrame([site(k) for k in (1, 2, 50, 999)], SITES)
    as_of = F.lit("2024-02-01")
    columns = ["domain", "routeable_url", "number_of_errors"]
    for failures in (False, True):
        got = scan_sites(sites, table, as_of, failures=failures)
        expected = scan_sites(sites, pages, as_of, failures=failures)
        names = ["domain", "routeable_url"] if failures else columns
        assert rows(got, *names) == rows(expected, *names)
    assert rows(scan_sites(sites, table, as_of, failures=True), "domain") == [("d999",)]


def test_no_sites_and_no_pages(spark, laid_out, tmp_path):
    table, pages = laid_out
    nobody = spark.createDataFrame([], SITES)
    assert pages_of(table, nobody).count() == 0
    write_pages(pages.limit(0), str(tmp_path / "none"))
    none = spark.read.schema(table.schema).parquet(str(tmp_path / "none"))
    assert pages_of(none, spark.createDataFrame([site(1)], SITES)).count() == 0
