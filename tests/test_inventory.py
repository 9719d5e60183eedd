"""The composed inventory build from files: S1-S3, S10, J1, F1-F9, G1-G5."""

import csv

import pytest
from pyspark.sql import functions as F

from siteledger import schemas
from siteledger.operators import hosts
from siteledger.plans.inventory import build_inventory, merge_registry_sites
from siteledger.sources import lists
from tests.conftest import rows

EXEC = "Federal Agency - Executive"
REGISTRY = '''Domain Name,Domain Type,Agency,Organization,City
 AGRI.GOV ,Federal Agency - Executive,U.S. Department of Agriculture,"USDA, ""NAL""",X
LABOR.GOV,Federal Agency - Executive,Department of Labor,ETA,X
COURT.GOV,Federal Agency - Judicial,Court,Court,X
gone.gov,Federal Agency - Executive,Gone,Gone,X
SLOW.gov,Federal Agency - Executive,Slow,Slow,X
twin.gov,Federal Agency - Executive,Twin,Twin,X
twin2.gov,Federal Agency - Executive,Twin,Twin,X
'''


@pytest.fixture()
def inputs(spark, tmp_path):
    (tmp_path / "registry.csv").write_text(REGISTRY)
    (tmp_path / "one.csv").write_text("Domain,Agency\nwww.agri.gov,x\nMAPS.agri.gov,y\ntest.agri.gov,z\nlabor.gov,\n")
    (tmp_path / "two.csv").write_text('site\n"maps.agri.gov "\nfed.us\nx.com\n#name?\nforest.fed.us\nnewdomain.gov\ncourt.gov\n')
    suffixes = hosts.default_suffixes(spark)
    registry = lists.read_registry(spark, str(tmp_path / "registry.csv"), suffixes)
    paths = [str(tmp_path / p) for p in ("one.csv", "missing.csv", "two.csv")]
    return registry, paths, suffixes


def probe_log(spark):
    def ok(candidate, final=None):
        return (candidate, "response", 200, final or candidate + "/")

    return spark.createDataFrame(
        [
            ok("https://agri.gov", "https://www.agri.gov/home"),
            ok("https://www.agri.gov"),
            ok("https://maps.agri.gov"),
            ok("https://test.agri.gov"),
            ok("http://www.labor.gov"),
            ok("https://court.gov"),
            ("https://gone.gov", "error", None, None),
            ("https://slow.gov", "timeout", None, None),
            ok("https://twin.gov", "https://same.gov/"),
            ok("https://twin2.gov", "https://same.gov/"),
        ],
        schemas.PROBE,
    )


def test_registry(spark, inputs):
    registry, _, _ = inputs
    first = registry.orderBy("file_row").first()
    assert (first["Domain Name"], first.domain, first.tld, first.subdomain) == ("agri.gov", "agri", "gov", "")
    assert first.Organization == 'USDA, "NAL"'
    assert [r.domain for r in registry.orderBy(*lists.ORDER).collect()] == [
        "agri", "labor", "court", "gone", "slow", "twin", "twin2",
    ]


def test_seed_sites(spark, inputs):
    _, paths, suffixes = inputs
    sites = lists.read_seed_sites(spark, paths, suffixes)
    in_order = [(r.source_idx, r.site) for r in sites.orderBy(*lists.ORDER).collect()]
    assert in_order == [
        (0, "www.agri.gov"), (0, "maps.agri.gov"), (0, "test.agri.gov"), (0, "labor.gov"),
        (2, "maps.agri.gov"), (2, "forest.fed.us"), (2, "newdomain.gov"), (2, "court.gov"),
    ]
    narrow = lists.read_seed_sites(spark, paths, suffixes, compat=True)
    assert "newdomain.gov" not in {r.site for r in narrow.collect()}
    with pytest.raises(ValueError):
        lists.read_seed_sites(spark, ["/nowhere/a.csv"], suffixes)


def test_merge(spark, inputs):
    registry, paths, suffixes = inputs
    sites = lists.read_seed_sites(spark, paths, suffixes)
    merged = merge_registry_sites(registry, sites)
    assert rows(merged, "domain", "tld_fed", "subdomain_sites", "tld_sites", "site") == sorted([
        ("agri", "gov", "maps", "gov", "maps.agri.gov"), ("agri", "gov", "maps", "gov", "maps.agri.gov"),
        ("agri", "gov", "test", "gov", "test.agri.gov"), ("agri", "gov", "www", "gov", "www.agri.gov"),
        ("gone", "gov", None, None, "gone.gov"), ("labor", "gov", "", "gov", "labor.gov"),
        ("slow", "gov", None, None, "slow.gov"), ("twin", "gov", None, None, "twin.gov"),
        ("twin2", "gov", None, None, "twin2.gov"),
    ], key=repr)


def test_single_source(spark, inputs):
    registry, _, suffixes = inputs
    got = build_inventory(registry, suffixes, probe_log(spark))
    assert rows(got, *schemas.INVENTORY.names) == sorted([
        (EXEC, "Department of Agriculture", "National Agricultural Library", "https://www.agri.gov/home", "", "agri", "gov"),
        (EXEC, "Department of Labor", "Employment and Training Administration", "http://www.labor.gov/", "", "labor", "gov"),
        (EXEC, "Twin", "Twin", "https://same.gov/", "", "same", "gov"),
    ], key=repr)


def test_all_sources(spark, inputs, tmp_path):
    registry, paths, suffixes = inputs
    sites = lists.read_seed_sites(spark, paths, suffixes)
    got = build_inventory(registry, suffixes, probe_log(spark), sites)
    found = rows(got, "routeable_url", "subdomain", "domain")
    # Test hosts are left out, and the same address is kept once.
    assert found == sorted([
        ("https://www.agri.gov/", "", "agri"), ("https://maps.agri.gov/", "maps", "agri"),
        ("http://www.labor.gov/", "", "labor"), ("https://same.gov/", "", "same"),
    ], key=repr)
    path = str(tmp_path / "out")
    lists.write_inventory(got, path)
    text = [r for p in (tmp_path / "out").glob("*.csv") for r in csv.DictReader(open(p, newline=""))]
    assert sorted(r["routeable_url"] for r in text) == sorted(f[0] for f in found)
    assert set(text[0]) == set(schemas.INVENTORY.names)
    assert rows(lists.read_inventory(spark, path), "routeable_url", F.coalesce("subdomain", F.lit(""))) == [f[:2] for f in found]


def test_order_survives_partitioning(spark, inputs):
    registry, paths, suffixes = inputs
    sites = lists.read_seed_sites(spark, paths, suffixes)
    one = build_inventory(registry, suffixes, probe_log(spark), sites)
    many = build_inventory(registry.repartition(5), suffixes, probe_log(spark).repartition(3), sites.repartition(4))
    assert rows(one, *schemas.INVENTORY.names) == rows(many, *schemas.INVENTORY.names)
