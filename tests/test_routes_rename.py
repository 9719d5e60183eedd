"""J2, J5, P5, P6, F7, P9."""

import pytest
from pyspark.sql import functions as F

from siteledger import schemas
from siteledger.operators import filters, rename, routes
from siteledger.plans.owner_rules import OWNER_RULES
from tests.conftest import rows

PROBES = [
    # every rank answers 200 for one host each
    ("https://r0.gov", "response", 200, "https://r0.gov/home"),
    ("https://www.r1.gov", "response", 200, "https://www.r1.gov/"),
    ("http://www.r2.gov", "response", 200, "http://www.r2.gov/"),
    ("http://r3.gov", "response", 200, "https://elsewhere.gov/"),
    # 404 is no answer, the walk goes on
    ("https://e.gov", "response", 404, "https://e.gov/"),
    ("https://www.e.gov", "response", 200, "https://www.e.gov/"),
    # so is a connection error
    ("https://c.gov", "error", None, None),
    ("http://c.gov", "response", 200, "http://c.gov/"),
    # a timeout ends the walk
    ("https://t.gov", "timeout", None, None),
    ("https://www.t.gov", "response", 200, "https://www.t.gov/"),
    # another status below 400 ends it without an address
    ("https://n.gov", "response", 204, "https://n.gov/"),
    ("https://www.n.gov", "response", 200, "https://www.n.gov/"),
    # nothing but errors
    ("https://x.gov", "response", 500, "https://x.gov/"),
    # status 399 still answers
    ("https://b.gov", "response", 399, "https://b.gov/"),
]
HOSTS = ["r0", "r1", "r2", "r3", "e", "c", "t", "n", "x", "b", "none"]


def resolved(spark, probes=PROBES):
    sites = spark.createDataFrame([(f"{h}.gov",) for h in HOSTS], "host string")
    log = spark.createDataFrame(probes, schemas.PROBE)
    found = routes.resolve_routes(routes.url_candidates(sites, "host"), log, "host")
    return routes.attach_routes(sites, found, "host")


def test_routes(spark):
    got = {r.host: r.routeable_url for r in resolved(spark).collect()}
    assert got == {
        "r0.gov": "https://r0.gov/home",
        "r1.gov": "https://www.r1.gov/",
        "r2.gov": "http://www.r2.gov/",
        "r3.gov": "https://elsewhere.gov/",
        "e.gov": "https://www.e.gov/",
        "c.gov": "http://c.gov/",
        "t.gov": "timeout",
        "n.gov": None,
        "x.gov": None,
        "b.gov": None,
        "none.gov": None,
    }
    kept = routes.reachable(resolved(spark))
    assert sorted(r.host for r in kept.collect()) == [
        "c.gov", "e.gov", "r0.gov", "r1.gov", "r2.gov", "r3.gov",
    ]


def test_latest_probe_counts(spark):
    log = spark.createDataFrame(
        [("https://a.gov", "response", 200, "https://a.gov/", 1), ("https://a.gov", "error", None, None, 2)],
        "candidate_url string, outcome string, status int, final_url string, at int",
    )
    sites = spark.createDataFrame([("a.gov",)], "host string")
    got = routes.resolve_routes(routes.url_candidates(sites, "host"), log, "host", "at")
    assert rows(got) == []


def test_candidates(spark):
    sites = spark.createDataFrame([("a.gov",), ("https://b.gov",)], "host string")
    assert rows(routes.url_candidates(sites, "host"), "rank", "candidate_url") == [
        (0, "https://a.gov"), (0, "https://b.gov"),
        (1, "https://www.a.gov"), (1, "https://www.b.gov"),
        (2, "http://www.a.gov"), (2, "http://www.b.gov"),
        (3, "http://a.gov"), (3, "http://b.gov"),
    ]


# (agency, organization) -> standard names; every branch, and the odd cases.
NAMES = [
    (("The Corporation for National Service", "Inspector General"),
     ("Corporation for National and Community Service", "Office Of Inspector General")),
    (("U.S. Department of Agriculture", "USDA Forest Service"), ("Department of Agriculture", "Forest Service")),
    (("U.S. Department of Agriculture", "Forest Service Remote Sensing"),
     ("Department of Agriculture", "Forest Service Remote Sensing")),
    (("U.S. Department of Agriculture", "Forest Service Sensing OCIO"),
     ("Department of Agriculture", "Office of the Chief Information Officer")),
    (("U.S. Department of Agriculture", "USDA"), ("Department of Agriculture", "Department of Agriculture")),
    (("U.S. Department of Agriculture", "USDA NAL"), ("Department of Agriculture", "National Agricultural Library")),
    (("U.S. Department of State", "Bureau of State"), ("Department of State", "Department of State")),
    (("Department of State", "ASEAN General"), ("Department of State", "Office Of Inspector General")),
    (("Federal Housing Finance Agency OIG", "x"), ("Federal Housing Finance Agency", "x")),
    (("United States Postal Service", "General"), ("United States Postal Service", "Office Of Inspector General")),
    (("Department of Education", "anything"), ("Department of Education", "Department of Education")),
    (("Broadcasting Board of Governors", "x"), ("Broadcasting Board of Governors", "Broadcasting Board of Governors")),
    (("Department of Justice", "ATF DEA"),
     ("Department of Justice", "Bureau of Alcohol, Tobacco, Firearms and Explosives")),
    (("Department of Justice", "FBI"), ("Department of Justice", "Federal Bureau of Investigation")),
    (("Department of Justice", "FBI x"), ("Department of Justice", "FBI x")),
    (("Department of Justice", "U.S. Department of Justice, BI, Domestic Security Alliance Council (DSAC)"),
     ("Department of Justice", "Domestic Security Alliance Council")),
    (("Department of Justice", "U.S. Department of Justice, Criminal Division"),
     ("Department of Justice", "Criminal Division")),
    (("Department of Veterans Affairs", "U.S. Department of Veterans Affairs"),
     ("Department of Veterans Affairs", "Department of Veterans Affairs")),
    (("National Archives and Records Administration", "NARA"),
     ("National Archives and Records Administration", "National Archives and Records Administration")),
    # an assignment that never happened: the name stays
    (("Environmental Protection Agency", "United Sates Environmental Protection Agency"),
     ("Environmental Protection Agency", "United Sates Environmental Protection Agency")),
    (("Department of Commerce", "NASA Goddard"),
     ("National Aeronautics and Space Administration", "NASA Goddard Space Flight Center")),
    (("Department of Commerce", "ECONOMIC DEVELOPMENT ADMINISTRATION"),
     ("Department of Commerce", "Economic Development Administration")),
    (("Department of Commerce", "NIST Standards"),
     ("Department of Commerce", "National Institute of Standards & Technology")),
    (("Department of Labor", "ETA"), ("Department of Labor", "Employment and Training Administration")),
    (("General Services Administration", "R&D STEERING'S COMMITTEE"),
     ("General Services Administration", "R&D Steering'S Committee")),
    (("General Services Administration", "GSA, FAS, IAE"),
     ("General Services Administration", "Federal Acquisition Service")),
    (("General Services Administration", "GSA"),
     ("General Services Administration", "General Services Administration")),
    (("Consumer Product Safety Commission", "x"),
     ("Consumer Product Safety Commission", "Consumer Product Safety Commission")),
    (("Federal Deposit Insurance Corporation", "x"),
     ("Federal Deposit Insurance Corporation", "Federal Deposit Insurance Corporation")),
    (("United States AbilityOne", "x"),
     ("United States AbilityOne", "Committee for Purchase From People Who are Blind or Severely Disabled")),
    (("Department of Housing and Urban Development", "Policy Development and Urban Development"),
     ("Department of Housing and Urban Development", "Office of Policy Development and Research")),
    (("Council of Inspectors General on Integrity and Efficiency", "x"),
     ("Council of Inspectors General on Integrity and Efficiency",
      "Council of Inspectors General on Integrity and Efficiency")),
    (("Department of Health and Human Services", "HHS"),
     ("Department of Health and Human Services", "Department of Health and Human Services")),
    (("Department of Health and Human Services", "HHS/AHRQ"),
     ("Department of Health and Human Services", "HHS/AHRQ")),
    (("Department of Health and Human Services", "DHHS LIbrary"),
     ("Department of Health and Human Services", "National Library of Medicine")),
    (("Office of Personnel Management", "U.S. Office of Personnel Management"),
     ("Office of Personnel Management", "Office of Personnel Management")),
    (("Department of the Treasury", "General Services Administration, Office of Citizen Services"),
     ("General Services Administration", "Office of Citizen Services")),
    (("Department of the Treasury", "FINCEN"), ("Department of the Treasury", "FinCEN")),
    (("Department of the Treasury", "Treasury"), ("Department of the Treasury", "Department of the Treasury")),
    (("Department of the Treasury", "Department of the Treasury - FS"),
     ("Department of the Treasury", "Bureau of the Fiscal Service")),
    (("National Credit Union Administration", "x"),
     ("National Credit Union Administration", "National Credit Union Administration")),
    (("Department of Transportation", "OCIO"),
     ("Department of Transportation", "Office of the Chief Information Officer")),
    (("Department of Transportation", "OCIO x"), ("Department of Transportation", "OCIO x")),
    (("Department of Transportation", "NHTSA"),
     ("Department of Transportation", "National Highway Traffic Safety Administration")),
    (("Department of the Interior", "US Geological Survey NWRC"),
     ("Department of the Interior", "Wetland and Aquatic Reserch Center")),
    (("Department of the Interior", "Department of Interior"),
     ("Department of the Interior", "Department of the Interior")),
    (("Department of Homeland Security", "FEMA"),
     ("Department of Homeland Security", "Federal Emergency Management Agency")),
    (("Nuclear Regulatory Commission", "x"), ("Nuclear Regulatory Commission", "Nuclear Regulatory Commission")),
    (("U.S. Agency for International Development", "USAID/GH.CECA"),
     ("U.S. Agency for International Development", "Center on Children in Adversity")),
    (("Department of Energy", "US DEPARTMENT OF ENERGY"), ("Department of Energy", "Department of Energy")),
    (("Department of Energy", "DOE Office of the CIO"),
     ("Department of Energy", "Office of the Chief Information Officer")),
    (("Department of Defense", "OFFICE OF WARRIOR CARE POLICY"),
     ("Department of Defense", "Office Of Warrior Care Policy")),
    (("Department of Defense", "NRO x"), ("Department of Defense", "NRO x")),
    # padding goes, other agencies pass through, missing stays missing
    (("\tDepartment of Labor \n", " OCIO"), ("Department of Labor", "Office of the Chief Information Officer")),
    ((" Some Agency ", " Some Org\t"), ("Some Agency", "Some Org")),
    (("Department of Labor", None), ("Department of Labor", None)),
    ((None, "x"), (None, "x")),
]


def test_owner_rules(spark):
    df = spark.createDataFrame([(i, *n[0]) for i, n in enumerate(NAMES)], "i int, Agency string, Organization string")
    got = rename.rename_by_rules(df, rules=OWNER_RULES)
    assert [tuple(r)[1:] for r in sorted(got.collect())] == [n[1] for n in NAMES]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_rule_table_covers_all_agencies():
    assert len(OWNER_RULES) == 30
    seen = {n[0][0] for n in NAMES}
    for rule in OWNER_RULES:
        assert any(rule.agency in (s or "") for s in seen), rule.agency


def test_order_of_rules_decides(spark):
    rules = (
        rename.AgencyRule("A", (rename.OrgRule("first", has=("x",)), rename.OrgRule("second", has=("xy",))), contains=True),
        rename.AgencyRule("AB", (rename.OrgRule("third"),)),
    )
    df = spark.createDataFrame([("AB", "xy"), ("AB", "q"), ("B", "xy")], "a string, o string")
    assert rows(rename.rename_by_rules(df, "a", "o", rules)) == [("AB", "first"), ("AB", "q"), ("B", "xy")]


def test_filters(spark):
    df = spark.createDataFrame(
        [("a.gov",), ("test.a.gov",), ("my.github.gov",), ("fasxmyxsalesforce.gov",), (None,)], "site string"
    )
    assert rows(filters.exclude_terms(df, "site")) == [("a.gov",)]
    urls = spark.createDataFrame(
        [("https://x.ecpic.gov/",), ("https://helix1-redirect.uspto.gov/",), ("https://ecpic.gov",)], "u string"
    )
    kept = filters.exclude_urls(urls, "u", filters.EXCLUDED_URLS, filters.EXCLUDED_URL_ENDINGS)
    assert rows(kept) == [("https://ecpic.gov",)]
    types = spark.createDataFrame([(f" {filters.EXECUTIVE}",), (filters.EXECUTIVE,), ("x",)], "`Domain Type` string")
    assert filters.keep_type(types).count() == 1
    assert filters.keep_type(types, stripped=True).count() == 2


@pytest.mark.parametrize("status, decides", [(200, True), (399, True), (400, False), (503, False)])
def test_status_limits(spark, status, decides):
    log = spark.createDataFrame(
        [("https://a.gov", "response", status, "u"), ("http://a.gov", "response", 200, "v")], schemas.PROBE
    )
    sites = spark.createDataFrame([("a.gov",)], "host string")
    got = routes.resolve_routes(routes.url_candidates(sites, "host"), log, "host").first()
    assert got.routeable_url == (("u" if status == 200 else None) if decides else "v")
