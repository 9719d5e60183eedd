import random

from pyspark.sql import functions as F

from siteledger.functions.punycode import written_host
from siteledger.operators.hosts import split_host


def plain(host):
    """Label by label with the standard library."""
    out = []
    for label in host.split("."):
        low = label.lower()
        if low.startswith("xn--"):
            try:
                decoded = low[4:].encode("ascii").decode("punycode")
                if low[4:] and not any(0xD800 <= ord(c) <= 0xDFFF for c in decoded) and "." not in decoded and not low.endswith("-"):
                    label = decoded
            except (UnicodeError, OverflowError, ValueError):
                pass
        out.append(label)
    return ".".join(out)


def written(spark, hosts):
    frame = spark.createDataFrame([(k, h) for k, h in enumerate(hosts)], "k int, h string")
    return [r[0] for r in frame.orderBy("k").select(written_host(F.col("h"))).collect()]


def test_encoded_names_of_all_scripts(spark):
    draw = random.Random(3)
    pools = ["aüß", "абвгд", "中文公司", "みんなの", "ابجد", "a-b0", "한국", "😀🎉a", "éèê"]
    names = []
    for _ in range(400):
        pool = draw.choice(pools) + draw.choice(["", "abc", "x-"])
        name = "".join(draw.choice(pool) for _ in range(draw.randint(1, 14))).strip("-")
        if name and not name.isascii():
            names.append(name)
    hosts = ["www.xn--" + n.encode("punycode").decode() + ".gov" for n in names]
    assert written(spark, hosts) == [f"www.{n}.gov" for n in names] and len(names) > 200


def test_what_is_no_encoding_stays(spark):
    draw = random.Random(4)
    hosts = ["xn--", "xn---", "a.xn--.b", "XN--BCHER-KVA.Gov", "xn--99999999999999999999999999999999999999999999999999999999999", "xn--ü", "xn", "axn--p1ai", "", "xn--a"]
    hosts += ["xn--" + "".join(draw.choice("abz09-") for _ in range(draw.randint(1, 12))) for _ in range(600)]
    got = written(spark, [*hosts, None])
    assert got[-1] is None
    assert [(h, g) for h, g in zip(hosts, got)] == [(h, plain(h)) for h in hosts]


def test_split_in_either_form(spark):
    suffixes = spark.createDataFrame([("公司.cn", "plain"), ("xn--p1ai", "plain")], "suffix string, kind string")
    hosts = spark.createDataFrame([("a.xn--55qx5d.cn",), ("a.公司.cn",), ("b.рф",), ("b.xn--p1ai",)], "h string")
    found = {r.h: (r.domain, r.tld) for r in split_host(hosts, "h", suffixes).collect()}
    assert found == {"a.xn--55qx5d.cn": ("a", "xn--55qx5d.cn"), "a.公司.cn": ("a", "公司.cn"), "b.рф": ("b", "рф"), "b.xn--p1ai": ("b", "xn--p1ai")}
