from collections import defaultdict

import pytest

from siteledger.llm.common import read_table
from siteledger.llm.mixing import mix, mixed_documents, source_targets
from siteledger.llm.queries import QUERIES
from tests.llm.helpers import awkward_documents, empty_documents, words


def plain_targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    """Water filling by rounds: share by weight, cap, share the excess again."""
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, left, open_ = {}, share * sum(sizes.values()), list(names)
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = [s for s in open_ if level * weight[s] > most * sizes[s]]
        if not over:
            target |= {s: level * weight[s] for s in open_}
            break
        for s in over:
            target[s] = most * sizes[s]
            left -= target[s]
            open_.remove(s)
    return target


def check(rows, docs):
    sizes, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in docs:
        sizes[r.source] += len(words(r.text))
        largest[r.source] = max(largest[r.source], len(words(r.text)))
    target = plain_targets(sizes)
    source = {r.doc_id: r.source for r in docs}
    assert len(rows) == len(docs)
    for r in rows:
        s = source[r.doc_id]
        assert r.source_size == sizes[s] and r.target == pytest.approx(target[s])
        assert r.taken <= 2 * r.size
        taken[s] += r.taken
    for s in sizes:
        assert abs(taken[s] - target[s]) <= max(1, largest[s])


def test_mix_of_whole_table(spark, sf_dir):
    rows = QUERIES["op8_mixing"](spark, sf_dir).collect()
    check(rows, read_table(spark, sf_dir, "documents").collect())
    assert sorted(rows) == sorted(QUERIES["op8_mixing"](spark, sf_dir).collect())


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, None: 500}, {"a": 7}, {"a": 0, "b": 5}, {f"s{i:02}": (i * 37) % 91 + 1 for i in range(25)}])
def test_targets(spark, sizes):
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    got = {r.source: r.target for r in source_targets(frame, (3, 1, 2), 1.5, 2.0).collect()}
    assert got == pytest.approx(plain_targets(sizes))


def test_mix_does_not_depend_on_partitions(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    assert sorted(map(tuple, mix(docs).collect())) == sorted(map(tuple, mix(docs.repartition(13)).collect()))


def test_awkward_rows(spark):
    docs = awkward_documents(spark)
    rows = mix(docs).collect()
    assert len(rows) == docs.count()
    assert all(0 <= r.copies <= 2 for r in rows)
    assert {r.size for r in rows if r.doc_id in (2, 3, 4)} == {0}
    assert mix(empty_documents(spark)).count() == 0
    taken = mixed_documents(docs)
    assert taken.columns == docs.columns
    assert taken.count() == sum(r.copies for r in rows)
    assert mix(docs.where("doc_id IN (2, 3)")).where("copies > 0").count() == 0
