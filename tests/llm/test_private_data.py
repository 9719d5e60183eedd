import hashlib
import math
import random
import re
import time
from collections import Counter, defaultdict

import pytest

from siteledger.llm.common import read_table
from siteledger.llm.private_data import KINDS, base_spans, contexts, edges, find_private_data, loose_spans, read_spans, score
from siteledger.llm.queries import QUERIES
from tests.llm.helpers import awkward_documents, empty_documents

FORMS = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
]


def luhn(number):
    doubled = [int(c) * (2 if k % 2 else 1) for k, c in enumerate(reversed(number))]
    return sum(x // 10 + x % 10 for x in doubled) % 10 == 0


def plain_base(text):
    out = []
    for kind, form in enumerate(FORMS):
        for m in re.finditer(form, text):
            digits = re.sub("[^0-9]", "", m[0])
            fits = (
                True,
                kind == 1 and all(int(p) <= 255 for p in m[0].split(".")),
                13 <= len(digits) <= 19 and luhn(digits),
                9 <= len(digits) <= 15,
            )[kind]
            if fits:
                out.append((kind, *m.span()))
    return out


def joined(spans):
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def plain(docs):
    """Base and added spans per document, the graph in dictionaries."""
    seen = []
    for n, (_, text) in enumerate(docs):
        base = plain_base(text or "")
        for k, a, b in base:
            seen.append((n, a, b, k, 0))
        for a, b, loose in loose_spans(text or ""):
            if all(b <= x or y <= a for _, x, y in base):
                seen.append((n, a, b, -1, loose))
    form = lambda n, a, b: docs[n][1][a:b].lower()
    graph, kind, fits = defaultdict(set), {}, defaultdict(int)
    for n, a, b, k, loose in seen:
        f = form(n, a, b)
        for c in contexts(docs[n][1], a, b):
            graph[c].add(f)
            kind[c, f] = max(k, kind.get((c, f), -1))
            fits[c, f] |= loose
    sure = {}
    for _ in range(3):
        doubt = defaultdict(lambda: [0.0] * 4)
        for c, forms in graph.items():
            for k in range(4):
                if sum(kind[c, f] == k for f in forms) >= 5:
                    unknown = {f for f in forms if kind[c, f] < 0 and fits[c, f] >> k & 1}
                    good = sum(kind[c, f] == k for f in forms) + sum(0.1 * sure.get(f, [0.0] * 4)[k] for f in unknown)
                    p = good / (len(forms) - 0.9 * len(unknown) + 0.5)
                    if p >= 0.85:
                        for f in forms:
                            if kind[c, f] < 0 and fits[c, f] >> k & 1:
                                doubt[f][k] += math.log1p(-p)
        sure = {f: [1 - math.exp(x) for x in d] for f, d in doubt.items()}
    out = {}
    for n, a, b, k, loose in seen:
        spans = out.setdefault(n, ([], []))
        if k >= 0:
            spans[0].append((k, a, b))
        elif (c := sure.get(form(n, a, b))) and max(c) >= 0.85 and loose >> c.index(max(c)) & 1:
            spans[1].append((a, -b, c.index(max(c))))
    result = []
    for n, (doc, _) in enumerate(docs):
        base, more = out.get(n, ([], []))
        added, end = [], 0
        for a, b, k in sorted(more):
            if a >= end or not added:
                added.append((k, a, -b))
                end = -b
        counts = Counter(k for k, _, _ in base)
        result.append((doc, *[counts[k] for k in range(4)], hashlib.sha256(joined(base).encode()).hexdigest(), joined(base + added)))
    return sorted(result, key=repr)


def corpus(seed=3):
    """Numbers and addresses of known and of looser form after telling words, and the same shapes after others."""
    draw = random.Random(seed)
    number = lambda n: "".join(draw.choice("0123456789") for _ in range(n))
    docs = []
    for d in range(200):
        parts = []
        for _ in range(draw.randint(0, 4)):
            parts.append(draw.choice([
                f"please call +1 ({number(3)}) 555-{number(4)} today",
                f"please call {number(3)}-555-{number(4)} today",
                f"order no. {number(3)}-555-{number(4)} shipped",
                f"write to jo{number(2)}@mail{number(1)}.example.com soon",
                f"write to jo{number(2)} [at] mail{number(1)} [dot] example soon",
                f"look at the dot on page {number(4)}",
                f"host 10.{number(2)}.{number(2)}.7 is up",
                f"host 10-{number(2)}-{number(2)}-7 is up",
                f"version {number(1)}.{number(1)}.{number(1)}.{number(1)} of {number(5)}",
                "und ganz saubere Wörter ohne Zahl",
            ]))
        docs.append((d, " ".join(parts)))
    return docs + docs[:20]


def result(df):
    return sorted((tuple(r) for r in df.select("doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans").collect()), key=repr)


def test_base_forms_are_those_of_the_patterns():
    draw = random.Random(1)
    pieces = ["@", ".", "a", "b-", "+", "1", "22", "333", " ", "-", "(", ")", "256", "0.0.0.0", "é", "_", "4111111111111111", "+1 (", "x@y.z", "\n"]
    for _ in range(20_000):
        text = "".join(draw.choice(pieces) for _ in range(draw.randint(0, 25)))
        assert base_spans(text) == plain_base(text), text


@pytest.mark.parametrize("piece", ["1", "a", "@", "+", "1.", "a@a.", "+1", "(", " 1", "a.", "-", "1 at ", " at a dot", "1,"])
def test_long_texts_of_one_piece_take_linear_time(piece):
    start = time.perf_counter()
    for text in (piece * 400_000, piece * 200_000 + "é"):
        base_spans(text)
        for span in loose_spans(text):
            assert span[0] < span[1]
    assert time.perf_counter() - start < 20


def test_contexts_find_what_the_forms_miss(spark):
    docs = corpus()
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)
    got, expected = result(find_private_data(frame)), plain(docs)
    assert got == expected
    text, spans = dict(docs), defaultdict(set)
    for row in got:
        for span in filter(None, row[6].split(",")):
            kind, a, b = span.split(":")
            spans[kind].add(text[row[0]][int(a) : int(b)])
    assert any(" [at] " in x for x in spans["email"]) and any("-" in x for x in spans["ip"])
    called = {x for x in spans["phone"] if not x.startswith("+")}
    assert called and all(f"call {x}" in " ".join(text.values()) for x in called)
    assert not any(re.fullmatch(r"\d{4,5}", x) for x in called)


def test_patterns_and_scores(spark):
    docs = corpus()
    patterns, forms = score(edges(read_spans(spark.createDataFrame(docs, "doc_id bigint, text string"))))
    found = {r.context: r for r in patterns.collect()}
    assert found["please call *"].p_phone > 0.85 and "no *" not in found and forms.count() > 20


def test_awkward_rows(spark):
    docs = awkward_documents(spark)
    assert result(find_private_data(docs)) == plain([(r.doc_id, r.text) for r in docs.collect()])
    assert find_private_data(empty_documents(spark)).count() == 0
    hot = spark.createDataFrame([(1, "mail a@b.cd now")] * 2000 + [(None, None)], "doc_id bigint, text string")
    assert {r[6] for r in result(find_private_data(hot))} == {"email:5:11", ""}


def test_whole_table(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in read_table(spark, sf_dir, "documents").collect()]
    assert result(QUERIES["op12_private_data"](spark, sf_dir)) == plain(docs)
