"""The registered queries of this package, and SQL for those that it can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siteledger.llm.common import read_table
from siteledger.llm.conversation_repair import damaged, repair
from siteledger.llm.embedding_graph import link_vectors
from siteledger.llm.exact_topk import exact_top_k, quantized
from siteledger.llm.licenses import scan_licenses
from siteledger.llm.mixing import mix
from siteledger.llm.packing import pack
from siteledger.llm.prefix_trie import prefix_trie
from siteledger.llm.private_data import find_private_data
from siteledger.llm.quality import score_quality
from siteledger.llm.simhash import near_duplicates
from siteledger.llm.substring import remove_repeats
from siteledger.llm.token_counts import count_tokens
from siteledger.llm.toxicity import score_toxicity

#: Every so many ids, a vector is a query of op10.
EVERY = 50


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(read_table(spark, sf_dir, "documents"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(read_table(spark, sf_dir, "documents")).drop("dig")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = remove_repeats(read_table(spark, sf_dir, "documents"), with_text=False)
    return cleaned.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two categories that the labels name: toxic, and toxic in a text of low quality."""
    labels = read_table(spark, sf_dir, "labels").withColumn("toxic_junk", (F.col("toxic") == 1) & (F.col("quality") == 0))
    return score_toxicity(read_table(spark, sf_dir, "documents"), labels.withColumn("toxic_junk", F.col("toxic_junk").cast("int")), ["toxic", "toxic_junk"])


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(read_table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(read_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op9_embedding_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_vectors(read_table(spark, sf_dir, "embeddings"))


def op10_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = quantized(read_table(spark, sf_dir, "embeddings"))
    return exact_top_k(vectors, vectors.where(F.col("vec_id") % EVERY == 0))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(damaged(read_table(spark, sf_dir, "conversations"))).drop("signature")


def op12_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_private_data(read_table(spark, sf_dir, "documents")).drop("base", "added")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(read_table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scan": op1_license_scan,
    "op2_quality": op2_quality,
    "op3_packing": op3_packing,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_simhash": op5_simhash,
    "op6_toxicity": op6_toxicity,
    "op7_token_counts": op7_token_counts,
    "op8_mixing": op8_mixing,
    "op9_embedding_graph": op9_embedding_graph,
    "op10_exact_topk": op10_exact_topk,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_private_data": op12_private_data,
    "op13_prefix_trie": op13_prefix_trie,
}


def _crc32(text: str) -> str:
    """SQL for the CRC-32 of a string of ASCII characters, bit by bit."""
    codes = f"list_transform(range(1, length({text}) + 1), lambda i: CAST(ascii(substring({text}, CAST(i AS INTEGER), 1)) AS BIGINT))"
    bits = "list_reduce(list_prepend(xor(crc, code), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, bit: xor(x >> 1, 3988292384 * (x & 1)))"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda crc, code: {bits}), 4294967295)"


#: What tells one turn from others, and orders turns of one number.
_TURN = "substring(sha256(length(coalesce(role, '{0}')) || ':' || coalesce(role, '{0}') || coalesce(text, '{0}')), 1, 32)"

def _way(edit: str, cost: str, state: str, line: str | None = None) -> str:
    """SQL for a way of op11: one edit, then the best way from ``state``. Null where that is none."""
    lines = f"{state}.lines" if line is None else f"list_prepend({line}, {state}.lines)"
    return f"{{'cost': {state}.cost + {cost}, 'audit': '{edit}' || {state}.audit, 'lines': {lines}}}"


def _least(*ways: str) -> str:
    return f"list_sort(list_filter([{', '.join(ways)}], lambda w: w IS NOT NULL))[1]"


def _direct(state: str, wanted: str, behind: str, **keep: str) -> str:
    """SQL for the best way from a state whose first edit is no insertion; ``keep`` has the state behind each legal initial."""
    own, more = "role || ':' || text", "CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END"
    ways = [f"CASE WHEN initial = '{i}' AND may_stay THEN {_way('K', more, to, own)} END" for i, to in keep.items()]
    return _least(_way("D", "4", state), f"CASE WHEN may_stay THEN {_way('R', f'3 + {more}', behind, f"'{wanted}:' || text")} END", *ways)


ORACLES: dict[str, str] = {
    "op4_substring_dedup": r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
p AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM w WHERE len(ws) >= 50),
g AS (SELECT doc_id, i, array_to_string(ws[i:i + 49], ' ') AS passage FROM p),
f AS (SELECT passage, min(doc_id) AS first FROM g GROUP BY passage),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS k FROM g JOIN f USING (passage) WHERE first < doc_id),
r AS (SELECT doc_id, list(k) AS gone FROM c GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
  sha256(coalesce(array_to_string(CASE WHEN gone IS NULL THEN ws
    ELSE list_filter(ws, lambda x, k: NOT list_contains(gone, k)) END, ' '), '')) AS kept_sha256
FROM w LEFT JOIN r USING (doc_id)""",
    "op9_embedding_graph": """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
r AS (SELECT vec_id, vec_id AS root FROM embeddings UNION SELECT l.b, r.root FROM r JOIN l ON r.vec_id = l.a),
c AS (SELECT vec_id, min(root) AS component_id FROM r GROUP BY vec_id),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
FROM c LEFT JOIN n ON n.a = c.vec_id""",
    "op10_exact_topk": f"""
WITH v AS (SELECT vec_id, CAST(list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, x.vec_id, CAST(list_dot_product(q.e, x.e) AS BIGINT) AS score
  FROM v q JOIN v x ON q.vec_id <> x.vec_id WHERE q.vec_id % {EVERY} = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
    "op11_conversation_repair": f"""
WITH RECURSIVE src AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  {_crc32("(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))")} % 20 AS harm FROM conversations),
d AS (SELECT conv_id, turn, CASE WHEN harm = 4 THEN 'user' ELSE role END AS role,
  CASE harm WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
  unnest(range(CASE harm WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM src),
o AS (SELECT conv_id, turn, role, text, substring(role, 1, 1) AS initial,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, {_TURN.format(" ")}, copy) AS pos,
  row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth,
  regexp_extract(text, '([^\\x20\\x09-\\x0D])[\\x20\\x09-\\x0D]*$', 1) AS final FROM d),
f AS (SELECT *, CASE WHEN final = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate' WHEN final NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
  coalesce((lag(initial) OVER (PARTITION BY conv_id ORDER BY pos) || initial) NOT IN ('su', 'ua', 'au'), false) AS illegal FROM o),
n AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
  count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (illegal) AS illegal, max(pos) AS turns FROM f GROUP BY conv_id),
w AS (SELECT conv_id, turns AS left_over, {{'cost': 0, 'audit': '', 'lines': []::VARCHAR[]}} AS q0, {{'cost': 6, 'audit': 'II', 'lines': ['user:', 'assistant:']}} AS q1,
  {{'cost': 3, 'audit': 'I', 'lines': ['assistant:']}} AS q2, {{'cost': 0, 'audit': '', 'lines': []::VARCHAR[]}} AS q3 FROM n
UNION ALL SELECT conv_id, left_over, {_least("b0", _way("I", "3", "n2", "'user:'"))}, {_least("b1", _way("I", "3", "n2", "'user:'"))}, n2, {_least("b3", _way("I", "3", "b2", "'user:'"))}
  FROM (SELECT *, {_least("b2", _way("I", "3", "b3", "'assistant:'"))} AS n2 FROM (SELECT conv_id, left_over - 1 AS left_over,
    {_direct("q0", "user", "q2", s="q1", u="q2")} AS b0, {_direct("q1", "user", "q2", u="q2")} AS b1,
    {_direct("q2", "assistant", "q3", a="q3")} AS b2, {_direct("q3", "user", "q2", u="q2")} AS b3
    FROM (SELECT w.*, f.role, f.text, f.initial, f.fault, f.fault NOT IN ('blank', 'duplicate') AS may_stay FROM w JOIN f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.pos = w.left_over)))),
e AS (SELECT conv_id, q0 FROM w WHERE left_over = 0),
c AS (SELECT DISTINCT conv_id FROM conversations)
SELECT c.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, CAST(coalesce(q0.cost, 0) AS BIGINT) AS cost, coalesce(q0.audit, '') AS audit,
  sha256(coalesce(array_to_string(q0.lines, chr(10)), '')) AS repaired_sha256
FROM c LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN e ON e.conv_id IS NOT DISTINCT FROM c.conv_id""",
    "op13_prefix_trie": f"""
WITH t AS (SELECT conv_id, turn, {_TURN.format("")} AS key, length(coalesce(text, '')) AS n FROM conversations WHERE conv_id IS NOT NULL),
p AS (SELECT conv_id, list({{'key': key, 'n': n}} ORDER BY turn NULLS FIRST, key) AS own, {_crc32("CAST(conv_id AS VARCHAR)")} % 6 AS h FROM t GROUP BY conv_id),
r AS (SELECT p.conv_id, list_concat(coalesce(b.own[1:p.h], []), p.own[p.h + 1:]) AS path FROM p LEFT JOIN p b ON b.conv_id = p.conv_id - p.conv_id % 100),
m AS (SELECT conv_id, len(path) AS turns, unnest(range(len(path) + 1)) AS depth, path FROM r),
n AS (SELECT path[1:depth] AS path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
  coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (turns = depth), '') AS ends FROM m GROUP BY ALL),
c AS (SELECT path[1:depth - 1] AS path, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL),
k AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN c ON n.path = c.path),
a AS (SELECT path[1:up] AS path, count(*) FILTER (n_children = 0) AS n_leaves, sum(CASE WHEN depth > 0 THEN (n_convs - 1) * path[depth].n ELSE 0 END) AS saved
  FROM (SELECT *, unnest(range(depth + 1)) AS up FROM k) GROUP BY ALL)
SELECT k.conv_id, k.depth, u.conv_id AS parent_conv_id, k.n_convs, k.n_children, a.n_leaves, CAST(a.saved AS BIGINT) AS saved_tokens, sha256(k.ends) AS ends_sha256
FROM k JOIN a ON a.path = k.path LEFT JOIN k u ON k.depth > 0 AND u.path = k.path[1:k.depth - 1]""",
}
