import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from siteledger.llm.common import read_table
from siteledger.llm.prefix_trie import EMPTY_SHA256, Skeleton, prefix_trie
from siteledger.llm.queries import QUERIES

SCHEMA = "conv_id bigint, turn bigint, role string, text string, path string, skel int"


def plain(rows):
    """Nodes by a dictionary of all prefixes. Equal turns of one conversation are not expected."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 6
        path = own.get(conv - int(conv % 100 if conv >= 0 else -(-conv % 100)), [])[:h] + turns[h:]
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(conv)
        ends[tuple(path)].append(conv)
    children = defaultdict(set)
    for node in members:
        if node:
            children[node[:-1]].add(node)
    leaves, saving = defaultdict(int), defaultdict(int)
    for node, m in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in children
            saving[node[:d]] += (len(m) - 1) * len(node[-1][1]) if node else 0
    return sorted(
        (min(m), len(n), min(members[n[:-1]]) if n else None, len(m), len(children[n]), leaves[n], saving[n], hashlib.sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest())
        for n, m in list(members.items())
    ) if members else []


def drawn(n=600, seed=4):
    """Conversations of few texts, with a first turn that a third shares, long ones, and ids below zero."""
    draw = random.Random(seed)
    rows = []
    for conv in draw.sample(range(-150, 4 * n), n):
        size = draw.choice([1, 1, 2, 3, 6, 7, 40])
        same = conv % 3 == 0
        for turn in range(size):
            text = "hot" if same and size < 7 else draw.choice(["a", "b", "é\U0001f600", "", None])
            rows.append((conv, turn if turn or draw.random() < 0.9 else None, ("user", "assistant")[turn % 2] if draw.random() < 0.95 else None, text))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA).repartition(5)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[:2], r[3:]))


@pytest.mark.parametrize("shards", [1, 2, 7, 60, None])
def test_any_number_of_shards(spark, shards):
    rows = drawn()
    expected = plain(rows)
    got = result(prefix_trie(frame(spark, rows), shards=shards))
    assert got == sorted(expected, key=lambda r: (r[:2], r[3:]))
    assert any(r[1] > 6 for r in got) and len(got) > 1000


def test_paths_longer_than_a_splitter(spark):
    rows = [(100 * c, t, "user", str(t) if t < 90 else f"{c % 4} {t}") for c in range(30) for t in range(100)]
    got = result(prefix_trie(frame(spark, rows), shards=9))
    assert got == sorted(plain(rows), key=lambda r: (r[:2], r[3:]))


def test_copies_of_one_conversation_divide_by_id(spark, monkeypatch):
    import siteledger.llm.prefix_trie as module

    monkeypatch.setattr(module, "CHUNK", 7)
    rows = [(100 * c, t, "user", f"same {t}") for c in range(500) for t in range(2)]
    got = result(prefix_trie(frame(spark, rows), shards=8))
    assert got == sorted(plain(rows), key=lambda r: (r[:2], r[3:])) and len(got) == 3


def test_skeleton_holds_the_prefixes_of_splitters():
    record = lambda k: bytes([k]) * 16 + (k).to_bytes(8, "big")
    trie = Skeleton([(record(1) + record(2), 5), (record(1) + record(2), 9), (record(1) + record(3), 1)])
    assert (trie.parent, trie.depth, trie.chars) == ([-1, 0, 1, 1], [0, 1, 2, 2], [0, 1, 2, 3])


def test_awkward_rows(spark):
    rows = [(1, None, None, None), (1, 3, "user", "x"), (None, 0, "user", "left out"), (2, 0, "user", "x" * 200_000), (700, 0, "user", None), (700, 0, "user", None)]
    nodes = result(prefix_trie(frame(spark, rows)))
    assert nodes[0][:6] == (1, 0, None, 3, len([n for n in nodes if n[1] == 1]), sum(1 for n in nodes if n[4] == 0))
    assert prefix_trie(frame(spark, rows).where("conv_id IS NULL")).count() == prefix_trie(frame(spark, rows).limit(0)).count() == 0
    lone = result(prefix_trie(frame(spark, [(3, 0, "user", "gone")])))  # its only turn is replaced by those of an absent head
    assert zlib.crc32(b"3") % 6 >= 1 and lone == [(3, 0, None, 1, 0, 1, 0, hashlib.sha256(b"3").hexdigest())]
    repeated = result(prefix_trie(frame(spark, [(700, 0, "user", "y")] * 3)))
    assert len(repeated) == 4 and repeated[1][7] == EMPTY_SHA256


def test_whole_table(spark, sf_dir):
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in read_table(spark, sf_dir, "conversations").collect()]
    assert result(QUERIES["op13_prefix_trie"](spark, sf_dir)) == sorted(plain(rows), key=lambda r: (r[:2], r[3:]))
