import random

import numpy as np
import pytest

from siteledger.llm.common import read_table
from siteledger.llm.linear import Sparse, fit_logistic
from siteledger.llm.quality import LABELLERS, fit_labellers, good_documents, labels, score_quality
from siteledger.llm.queries import QUERIES
from siteledger.llm.toxicity import fit_chain, predict_chain, score_toxicity
from tests.llm.helpers import awkward_documents, empty_documents


def test_logistic_finds_the_weights():
    draw = np.random.default_rng(1)
    rows = [np.flatnonzero(draw.random(6) < 0.5) for _ in range(3000)]
    true = np.array([2.0, -2.0, 1.0, 0.0, 0.0, -1.0])
    y = (draw.random(3000) < 1 / (1 + np.exp(-np.array([true[r].sum() for r in rows])))).astype(float)
    weights, _, intercept = fit_logistic(Sparse.of(rows), np.empty((3000, 0)), y, 6, l2=1e-6, steps=400)
    assert np.abs(weights - true).max() < 0.4 and abs(intercept) < 0.3


def test_labeller_accuracies_are_recovered():
    draw = random.Random(3)
    truth, accuracy = [draw.random() < 0.7 for _ in range(20_000)], [0.95, 0.9, 0.8, 0.7, 0.6]
    patterns: dict[str, int] = {}
    for t in truth:
        votes = "".join("2" if draw.random() < 0.3 else str(int(t if draw.random() < a else not t)) for a in accuracy)
        patterns[votes] = patterns.get(votes, 0) + 1
    prior, got = fit_labellers(patterns)
    assert prior == pytest.approx(0.7, abs=0.04)
    assert [got[1, k, 1] for k in range(5)] == pytest.approx(accuracy, abs=0.05)
    assert [got[0, k, 0] for k in range(5)] == pytest.approx(accuracy, abs=0.05)


def test_votes():
    assert labels("") == "0" * len(LABELLERS)
    assert labels("LOOK!! AT!! THIS!! NOW!! BUY!! IT!! ALL!! HERE!! TODAY!! OK!!")[1] == "0"
    assert len(labels("x" * 10**6)) == len(LABELLERS)


def test_quality_agrees_with_labels_it_never_saw(spark):
    sf_dir = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.quality for r in read_table(spark, sf_dir, "labels").collect()}
    rows = {r.doc_id: r for r in QUERIES["op2_quality"](spark, sf_dir).collect()}
    assert len(rows) == 1000
    bad, good = ([rows[d].keep for d, q in truth.items() if q == k] for k in (0, 1))
    assert np.mean(bad) < 0.1 and np.mean(good) > 0.95


def test_quality_of_awkward_rows(spark):
    docs = awkward_documents(spark)
    rows = score_quality(docs).collect()
    assert len(rows) == docs.count()
    assert all(r.score == 0.0 and not r.keep for r in rows if r.doc_id in (2, 3, 4))
    kept = good_documents(docs)
    assert kept.columns == docs.columns and kept.count() == sum(r.keep for r in rows)
    assert score_quality(empty_documents(spark)).count() == good_documents(empty_documents(spark)).count() == 0


def _chain_data(n=4000, seed=2):
    """Two categories; the second depends on the first and on a word of its own."""
    draw = np.random.default_rng(seed)
    first, own = draw.random(n) < 0.3, draw.random(n) < 0.4
    second = first & own
    rows = []
    for a, b in zip(first, own, strict=True):
        row = {int(c) for c in draw.integers(100, 5000, 30)}
        row |= {1} if a and draw.random() < 0.95 else set()
        row |= {2} if b else set()
        rows.append(sorted(row))
    return Sparse.of(rows), np.stack([first, second], axis=1).astype(float), draw.integers(0, 5, n)


def test_chain_on_held_out_rows():
    x, y, fold = _chain_data()
    chain = fit_chain(x, y, fold)
    assert len(chain[0].earlier) == 0 and len(chain[1].earlier) == 1 and chain[1].earlier[0] > 0
    new, truth, _ = _chain_data(seed=9)
    got = predict_chain(chain, new) >= 0.5
    assert ((got == (truth > 0.5)).mean(axis=0) > 0.93).all()


def test_toxicity_on_held_out_labels(spark):
    """Trained on the labels of half of the documents, tried on the other half."""
    sf_dir = "/root/testdata/sf0.1"
    labelled = read_table(spark, sf_dir, "labels")
    rows = score_toxicity(read_table(spark, sf_dir, "documents"), labelled.where("doc_id % 2 = 0"), ["toxic"]).collect()
    got = {r.doc_id: r.toxic for r in rows}
    held = [(got[r.doc_id], r.toxic) for r in labelled.where("doc_id % 2 = 1").collect()]
    assert np.mean([p for p, t in held if t == 1]) > 0.85
    assert np.mean([p for p, t in held if t == 0]) < 0.01


def test_toxicity_of_whole_table(spark, sf_dir):
    rows = QUERIES["op6_toxicity"](spark, sf_dir).collect()
    assert len(rows) == read_table(spark, sf_dir, "documents").count()
    assert all(0 <= r.p_toxic <= 1 and r.toxic == (r.p_toxic >= 0.5) for r in rows)


def test_toxicity_of_awkward_rows(spark):
    docs = awkward_documents(spark)
    labelled = spark.createDataFrame([(1, 1, "t"), (5, 0, "t"), (5, 0, "t"), (6, None, "t"), (None, 1, "t"), (77, 1, "t")], "doc_id bigint, toxic int, text string")
    assert score_toxicity(docs, labelled, ["toxic"]).count() == docs.count()
    none = score_toxicity(docs, labelled.limit(0), ["toxic"]).collect()
    assert {r.p_toxic for r in none} == {0.0}
    assert score_toxicity(empty_documents(spark), labelled, ["toxic"]).count() == 0
