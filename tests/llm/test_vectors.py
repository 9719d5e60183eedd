import numpy as np
import pytest

from siteledger.llm import embedding_graph, exact_topk
from siteledger.llm.common import read_table
from siteledger.llm.embedding_graph import build_graph, link_vectors, range_search, robust_prune
from siteledger.llm.exact_topk import exact_top_k, quantized
from siteledger.llm.queries import QUERIES
from tests.llm.helpers import components, unit

SCHEMA = "vec_id bigint, embedding array<float>, label int, size int"


def clustered(n=1500, dim=16, seed=2, groups=12):
    draw = np.random.default_rng(seed)
    x = draw.normal(size=(n, dim))
    for g in range(groups):
        members = draw.choice(n, 40, replace=False)
        x[members] = x[members[0]] + draw.normal(size=(40, dim)) * 0.1
    x[: n // 3] = x[0]
    return x.astype(np.float32)


def frame(spark, x, ids=None):
    rows = [(int(i), [float(c) for c in v], 0, 1) for i, v in zip(ids if ids is not None else range(len(x)), x, strict=True)]
    return spark.createDataFrame(rows, SCHEMA)


def awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 0, 1), (2, [2.0, 0.0], None, 2), (3, None, 0, 3), (4, [nan, 1.0], 0, 4), (5, [inf, 1.0], 0, 5), (6, [None, 1.0], 0, 6), (7, [0.0, 0.0], 0, 7), (8, [0.0, 1.0], 0, 8), (8, [0.0, 1.0], 0, 8), (None, [0.0, 1.0], 0, 9), (9, [], 0, 10), (50, [1.0], 0, 0), (100, [-1.0, 1e-3], 0, 0)]
    return spark.createDataFrame(rows, SCHEMA)


def top_k(x, ids, queries, k=5):
    q = np.floor(256 * x.astype(float)).astype(np.int64)
    out = []
    for a in queries:
        scores = q @ q[ids.index(a)]
        order = sorted((-int(s), i) for s, i in zip(scores, ids, strict=True) if i != a)[:k]
        out += [(a, r + 1, i, -s) for r, (s, i) in enumerate(order)]
    return sorted(out)


def test_top_k_of_whole_table(spark, sf_dir):
    rows = sorted(read_table(spark, sf_dir, "embeddings").collect())
    x, ids = np.array([r.embedding for r in rows], dtype=np.float32), [r.vec_id for r in rows]
    got = sorted(map(tuple, QUERIES["op10_exact_topk"](spark, sf_dir).collect()))
    assert got == top_k(x, ids, [i for i in ids if i % 50 == 0])


@pytest.mark.parametrize("chunk", [4096, 7])
def test_top_k_with_many_blocks_and_equal_vectors(spark, monkeypatch, chunk):
    monkeypatch.setattr(exact_topk, "QUERIES", chunk)
    x = clustered()
    vectors = quantized(frame(spark, x))
    got = exact_top_k(vectors, vectors.where("vec_id % 50 = 0"), pivots=6, block=90)
    assert sorted(map(tuple, got.collect())) == top_k(x, list(range(len(x))), range(0, len(x), 50))


def test_vectors_at_one_distance_are_divided_over_blocks(spark, monkeypatch):
    sizes = []

    def saved(df, name, keep=exact_topk.saved):
        out = keep(df, name)
        if name == "index":
            sizes.extend(r["count"] for r in out.groupBy("block").count().collect())
        return out

    monkeypatch.setattr(exact_topk, "saved", saved)
    x = np.eye(256, dtype=np.float32)
    vectors = quantized(frame(spark, x))
    got = exact_top_k(vectors, vectors.where("vec_id % 50 = 0"), block=32)
    assert sorted(map(tuple, got.collect())) == top_k(x, list(range(256)), range(0, 256, 50))
    assert max(sizes) < 128


def test_top_k_of_awkward_rows(spark):
    vectors = quantized(awkward_vectors(spark))
    got = [tuple(r) for r in exact_top_k(vectors, vectors.where("vec_id % 50 = 0")).collect()]
    fifty = [(r, i, s) for q, r, i, s in sorted(got) if q == 50]
    assert fifty == [(1, 2, 131072), (2, 1, 65536), (3, 7, 0), (4, 8, 0), (5, 9, 0)]
    nothing = vectors.limit(0)
    assert exact_top_k(nothing, nothing).count() == exact_top_k(nothing, vectors).count() == exact_top_k(vectors, nothing).count() == 0
    one = vectors.where("vec_id = 50")
    assert exact_top_k(one, one).count() == 0
    big = quantized(spark.createDataFrame([(50, [1e6, 2e6], 0, 0), (2, [3e6, 1.0], 0, 0)], SCHEMA))
    assert [r.score for r in exact_top_k(big, big.where("vec_id = 50")).collect()] == [256000000 * 768000000 + 512000000 * 256]


def links(x, threshold=0.95):
    cosine = unit(x) @ unit(x).T >= threshold
    np.fill_diagonal(cosine, False)
    return cosine


def check_links(rows, x, ids, least=0.9):
    truth = links(x)
    n = {r.vec_id: r.n_links for r in rows}
    assert len(rows) == len(ids)
    true = {i: int(k) for i, k in zip(ids, truth.sum(axis=1), strict=True)}
    assert all(n[i] <= true[i] for i in ids)  # nothing below the threshold
    assert sum(n.values()) >= least * sum(true.values())
    component = components(ids, [(ids[a], ids[b]) for a, b in zip(*np.nonzero(truth), strict=True)])
    assert np.mean([component[r.vec_id] == r.component_id for r in rows]) >= least
    assert all(r.kept == (r.vec_id == r.component_id) for r in rows)


def test_links_of_whole_table(spark, sf_dir):
    rows = sorted(read_table(spark, sf_dir, "embeddings").collect())
    check_links(QUERIES["op9_embedding_graph"](spark, sf_dir).collect(), np.array([r.embedding for r in rows]), [r.vec_id for r in rows])


@pytest.mark.parametrize("most", [2048, 50])
def test_links_in_many_shards(spark, monkeypatch, most):
    monkeypatch.setattr(embedding_graph, "SHARD", 150)
    monkeypatch.setattr(embedding_graph, "QUERIES", most)
    x = clustered()
    check_links(link_vectors(frame(spark, x)).collect(), x, list(range(len(x))), 0.97)


def test_a_group_cut_into_many_shards_keeps_its_links(spark, monkeypatch):
    """Eight shards a class are not enough here."""
    monkeypatch.setattr(embedding_graph, "SHARD", 10)
    draw = np.random.default_rng(8)
    x = draw.normal(size=(1500, 16)).astype(np.float32)
    x[:1000] = x[0] + draw.normal(size=(1000, 16)) * 0.12
    check_links(link_vectors(frame(spark, x)).collect(), x, list(range(len(x))))


def test_loss_of_rare_pairs_is_noticed(spark, monkeypatch):
    """The first vectors drawn see no link; the search loses all."""
    lossy = lambda classes, *_: classes.selectExpr("node", "0L AS links", "node AS root")
    monkeypatch.setattr(embedding_graph, "_search", lossy)
    draw = np.random.default_rng(12)
    x = draw.normal(size=(3000, 24))
    x[0] = x[1] + draw.normal(size=24) * 0.1
    x = x.astype(np.float32)
    check_links(link_vectors(frame(spark, x)).collect(), x, list(range(len(x))), 1.0)


def test_audit_draws_until_it_has_seen_links(spark, monkeypatch):
    draw = np.random.default_rng(3)
    x = unit(draw.normal(size=(2000, 16)))
    x[:30] = x[30:60] + 1e-3
    classes = spark.createDataFrame([(i, 1, v.tolist()) for i, v in enumerate(x)], "node bigint, weight bigint, v array<double>")
    rows = embedding_graph._truth(classes, 2000, 16, 0.95).collect()
    assert sorted(r.node for r in rows) == list(range(60)) and all(r.near == r.true == 1 for r in rows)
    monkeypatch.setattr(embedding_graph, "MOST_DRAWN", 300)
    assert embedding_graph._truth(classes, 2000, 16, 0.95) is None  # not measured
    monkeypatch.setattr(embedding_graph, "LINKED", 3)
    assert 3 <= embedding_graph._truth(classes, 2000, 16, 0.95).count() < 60


def test_many_links_do_not_hide_few(spark):
    truth = spark.createDataFrame([(1, 1, 1), (2, 1, 1), (3, 900, 900)], "node bigint, near bigint, true bigint")
    found = spark.createDataFrame([(1, 1), (3, 900)], "node bigint, links bigint")
    assert embedding_graph._audit(truth, found) == 0.5


def test_comparison_of_blocks_is_exact(spark, monkeypatch):
    monkeypatch.setattr(embedding_graph, "_audit", lambda *_: 0.0)
    x = clustered(600)
    check_links(link_vectors(frame(spark, x)).collect(), x, list(range(len(x))), 1.0)


def test_links_of_awkward_rows(spark):
    vectors = awkward_vectors(spark)
    got = link_vectors(vectors).collect()
    assert len(got) == vectors.count()
    by = {r.vec_id: r for r in got}
    assert (by[1].n_links, by[2].n_links, by[50].n_links, by[50].component_id, by[50].kept) == (2, 2, 2, 1, False)
    assert by[8].n_links == by[None].n_links == 2 and by[None].component_id == 8
    assert all((by[i].n_links, by[i].component_id, by[i].kept) == (0, i, True) for i in (3, 4, 5, 6, 7, 9, 100))
    assert link_vectors(vectors.limit(0)).count() == 0
    assert link_vectors(vectors.where("vec_id = 7")).count() == 1


def test_search_in_one_graph():
    x = unit(clustered(600))
    graph = build_graph(x, np.arange(600))
    assert graph.shape == (600, embedding_graph.DEGREE) and (graph < 600).all()
    found = np.zeros((600, 600), dtype=bool)
    for a, b in range_search(x, graph, np.array([0, 100]), np.arange(600), 0.95):
        found[a, b] = True
    truth = links(x)
    assert not (found & ~truth).any() and (found & truth).sum() >= 0.95 * truth.sum()


def test_prune_takes_the_nearest_and_spreads():
    x = unit([[1, 0], [1, 0.1], [1, 0.12], [0, 1]])
    kept = robust_prune(x, np.array([0]), np.array([[1, 2, 3]]), 3, 1.2)
    assert kept[0, 0] == 1 and 2 not in kept[0].tolist()
