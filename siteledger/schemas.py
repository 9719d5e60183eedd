"""Fixed schemas of every table and message."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


CORRUPT = "_corrupt_record"

# Columns of the site registry that are read; further columns of the file are ignored.
REGISTRY = _strings("Domain Name", "Domain Type", "Agency", "Organization")

INVENTORY = _strings(
    "Domain Type", "Agency", "Organization", "routeable_url", "subdomain", "domain", "tld"
)

MESSAGE = INVENTORY

LINK_MESSAGE = _strings(
    "Agency", "Organization", "domain", "subdomain", "tld", "routeable_url", "db_id"
)

EVENT = T.StructType([
    T.StructField("Records", T.ArrayType(T.StructType([
        T.StructField("messageId", T.StringType()),
        T.StructField("receiptHandle", T.StringType()),
        T.StructField("body", T.StringType()),
        T.StructField("attributes", T.MapType(T.StringType(), T.StringType())),
    ])))
])

ISSUE = _strings("code", "type").add("typeCode", T.IntegerType())
for _name in ("message", "context", "selector"):
    ISSUE = ISSUE.add(_name, T.StringType())

SCAN_RESULT = T.StructType([
    T.StructField("documentTitle", T.StringType()),
    T.StructField("pageUrl", T.StringType()),
    T.StructField("issues", T.ArrayType(ISSUE)),
])

# One scan record as stored in a JSON file: all text, issues are JSON inside a string.
SCAN_FILE = _strings(
    "agency", "organization", "domain", "subdomain", "numberOfErrors", "routeableUrl",
    "issues", "scanDate",
)

SCAN_RECORD = T.StructType([
    T.StructField("agency", T.StringType()),
    T.StructField("organization", T.StringType()),
    T.StructField("domain", T.StringType()),
    T.StructField("subdomain", T.StringType()),
    T.StructField("number_of_errors", T.IntegerType()),
    T.StructField("routeable_url", T.StringType()),
    T.StructField("document_title", T.StringType()),
    T.StructField("issues", T.ArrayType(ISSUE)),
    T.StructField("scan_date", T.DateType()),
])

HISTORY = T.StructType([
    T.StructField("snapshot_date", T.DateType()),
    T.StructField("accessible_share", T.DoubleType()),
])

HISTORY_FILE = T.ArrayType(T.MapType(T.StringType(), T.DoubleType()))

PROBE = T.StructType([
    T.StructField("candidate_url", T.StringType()),
    T.StructField("outcome", T.StringType()),
    T.StructField("status", T.IntegerType()),
    T.StructField("final_url", T.StringType()),
])

SUFFIX = _strings("suffix", "kind")
