import itertools
import random

import xxhash

from siteledger.llm.common import read_table
from siteledger.llm.queries import QUERIES
from siteledger.llm.simhash import covering_masks, fingerprint, fingerprint_links, near_duplicates, one_of_each
from tests.llm.helpers import awkward_documents, components, empty_documents, words


def plain(text, n=3):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = words(lowered)
    if not w:
        return 0
    grams = [" ".join(w[i : i + n]) for i in range(len(w) - n + 1)] or [" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


def test_fingerprint():
    draw = random.Random(1)
    for _ in range(800):
        text = "".join(draw.choice(["a", "B", "É", " ", "  ", "\n", "\xa0", "zz ", "w "]) for _ in range(draw.randint(0, 60)))
        assert plain(text) == fingerprint(text)


def test_masks_leave_out_any_two_bits():
    masks = covering_masks()
    assert len(masks) == 7
    for a, b in itertools.combinations_with_replacement(range(64), 2):
        assert any(not m >> a & 1 and not m >> b & 1 for m in masks)


def _near_values():
    draw, values = random.Random(5), set()
    for _ in range(30):
        base = draw.getrandbits(64)
        for _ in range(draw.choice([1, 2, 5, 60])):
            values.add(base)
            base ^= sum(1 << b for b in draw.sample(range(64), draw.choice([1, 2, 2, 3])))
    return sorted(v - (1 << 64) if v >> 63 else v for v in values)


def _linked(spark, values, **options):
    got = fingerprint_links(spark.createDataFrame([(v,) for v in values], "fp bigint"), **options).collect()
    mask = (1 << 64) - 1
    assert all(((a ^ b) & mask).bit_count() <= 2 for a, b in got)
    return components(values, got)


def test_links_reach_all_that_pairs_reach(spark):
    values = _near_values()
    mask = (1 << 64) - 1
    brute = components(values, [(a, b) for a, b in itertools.combinations(values, 2) if ((a ^ b) & mask).bit_count() <= 2])
    assert _linked(spark, values) == brute
    assert _linked(spark, values, pairwise=2) == brute  # every larger bucket through centres
    assert _linked(spark, values, pairwise=10**6) == brute


def test_whole_table(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").collect()
    prints = {r.doc_id: plain(r.text) for r in docs}
    links = [(a, b) for a, b in itertools.combinations(prints, 2) if (prints[a] ^ prints[b]).bit_count() <= 2]
    component = components(prints, links)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op5_simhash"](spark, sf_dir).collect()}
    assert got == {d: (f"{prints[d]:016x}", component[d]) for d in prints}


def test_awkward_rows(spark):
    docs = awkward_documents(spark)
    rows = near_duplicates(docs).collect()
    assert len(rows) == docs.count()
    component = {(r.doc_id, r.fp & ((1 << 64) - 1)): r.component_id for r in rows}
    assert component[2, 0] == component[3, 0] == component[4, 0] == component[None, 0] == 2
    assert component[9, plain("the quick brown fox jumps over the lazy dog")] == 1
    kept = one_of_each(docs)
    assert kept.columns == docs.columns
    ids = sorted((r.doc_id for r in kept.collect()), key=str)
    assert ids.count(None) == 2 and 9 not in ids and 8 not in ids and 1 in ids
    assert near_duplicates(empty_documents(spark)).count() == one_of_each(empty_documents(spark)).count() == 0
