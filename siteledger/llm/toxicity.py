"""Toxicity categories by a chain of linear classifiers."""

from __future__ import annotations

import functools
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siteledger.llm.common import doc_rows, only_memo, slices
from siteledger.llm.features import WordFeatures
from siteledger.llm.linear import Sparse, fit_logistic, sigmoid

#: Labelled documents (at most) that the chain is trained on, columns, folds, and features of a category.
LABELLED, BITS, FOLDS, FEATURES = 8_192, 20, 5, 2_000


@functools.cache
def _features() -> WordFeatures:
    return WordFeatures(BITS)


def _columns(text: str) -> list[int]:
    """The hashed words and shapes that a text holds, each once."""
    lookup, out = _features(), set()
    for word in set(text.split()):
        out.update(lookup[word])
    return sorted(out)


@dataclass
class Link:
    """One classifier: its columns, their weights, the weights of the earlier categories' probabilities."""

    columns: np.ndarray
    weights: np.ndarray
    earlier: np.ndarray
    intercept: float


def _select(x: Sparse, y: np.ndarray) -> np.ndarray:
    """Columns in far more documents of one class than chance allows: at most ``FEATURES``, strongest first."""
    ones, n1 = y[x.rows] > 0.5, max(1.0, float((y > 0.5).sum()))
    n0 = max(1.0, x.n_rows - n1)
    with_, without = np.bincount(x.columns[ones], minlength=1 << BITS), np.bincount(x.columns[~ones], minlength=1 << BITS)
    both = (with_ + without + 1) / (n1 + n0 + 2)
    z = (with_ / n1 - without / n0) / np.sqrt(both * (1 - both) * (1 / n1 + 1 / n0))
    strong = np.flatnonzero((np.abs(z) >= 4) & (with_ + without >= 3))
    if len(strong) < 10:  # few labels
        strong = np.flatnonzero((np.abs(z) >= 2) & (with_ + without >= 2))
    return np.sort(strong[np.argsort(-np.abs(z[strong]), kind="stable")[:FEATURES]])


def _narrow(x: Sparse, columns: np.ndarray) -> Sparse:
    if not len(columns):
        return Sparse(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0), x.n_rows)
    at = np.minimum(np.searchsorted(columns, x.columns), len(columns) - 1)
    here = columns[at] == x.columns
    return Sparse(x.rows[here], at[here], x.values[here], x.n_rows)


def _fit(x: Sparse, earlier: np.ndarray, y: np.ndarray) -> Link:
    columns = _select(x, y)
    weights, chain, intercept = fit_logistic(_narrow(x, columns), earlier, y, len(columns), l2=2e-5, steps=300, rate=0.3)
    return Link(columns, weights, chain, intercept)


def _predict(link: Link, x: Sparse, earlier: np.ndarray) -> np.ndarray:
    narrow = _narrow(x, link.columns)
    z = narrow.times(link.weights) if len(link.columns) else np.zeros(x.n_rows)
    return sigmoid(z + earlier @ link.earlier + link.intercept)


def fit_chain(x: Sparse, targets: np.ndarray, fold: np.ndarray) -> list[Link]:
    """A classifier for each column of ``targets``; each sees the probabilities of the ones before it.

    The probabilities it is trained with are out of fold: predicted by models that have not seen
    the document, as those it meets later are.
    """
    chain, earlier = [], np.empty((x.n_rows, 0))
    for k in range(targets.shape[1]):
        y, out = targets[:, k], np.zeros(x.n_rows)
        for f in np.unique(fold):
            held = fold == f
            if held.all():
                out[:] = y.mean()
                continue
            model = _fit(x.only(~held), earlier[~held], y[~held])
            out[held] = _predict(model, x.only(held), earlier[held])
        chain.append(_fit(x, earlier, y))
        earlier = np.hstack([earlier, out[:, None]])
    return chain


def predict_chain(chain: list[Link], x: Sparse) -> np.ndarray:
    earlier = np.empty((x.n_rows, 0))
    for link in chain:
        earlier = np.hstack([earlier, _predict(link, x, earlier)[:, None]])
    return earlier


def train(docs: DataFrame, labels: DataFrame, categories: Sequence[str], labelled: int = LABELLED) -> list[Link]:
    """The chain, from at most ``labelled`` labelled documents, those with the smallest hashes of their ids.

    ``labels`` is (doc_id, one 0/1 column for each category); several labels of an id count as the
    highest, rows with a null id or label are left out. Its bounded sample is broadcast to the texts.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), *[F.col(c).cast("double").alias(c) for c in categories]).dropna()
    known = known.groupBy("doc_id").agg(*[F.max(c).alias(c) for c in categories])
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(labelled)
    texts = doc_rows(docs).join(F.broadcast(known), "doc_id")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only_memo(_features())
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([_columns(t.as_py()) for t in batch.column("text")], pa.list_(pa.int32())), *[batch.column(c) for c in categories]], ["doc_id", "columns", *categories])

    schema = "doc_id bigint, columns array<int>, " + ", ".join(f"`{c}` double" for c in categories)
    rows = texts.select("doc_id", "text", *categories).mapInArrow(features, schema).limit(2 * labelled).toPandas()
    if not len(rows):
        return []
    rows = rows.sort_values("doc_id", ignore_index=True)
    fold = (rows["doc_id"].to_numpy(dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)) % np.uint64(FOLDS)
    return fit_chain(Sparse.of(rows["columns"].tolist()), rows[list(categories)].to_numpy(dtype=float), fold.astype(np.int64))


class _Slots(dict):
    """Word to the rows of the chain's weights that it adds, mostly none."""

    def __init__(self, chain: list[Link]):
        super().__init__()
        columns = np.unique(np.concatenate([link.columns for link in chain])) if chain else np.empty(0, np.int64)
        self.slot = {int(c): i for i, c in enumerate(columns)}
        self.weights = np.zeros((len(columns), len(chain)))
        for k, link in enumerate(chain):
            self.weights[np.searchsorted(columns, link.columns), k] = link.weights
        self.lookup = WordFeatures(BITS)

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= WordFeatures.MOST:
            self.clear()
        out = tuple({self.slot[c] for c in self.lookup[word] if c in self.slot})
        if len(word) <= 64:
            self[word] = out
        return out

    def logits(self, text: str) -> np.ndarray:
        found = set()
        for rows in map(self.__getitem__, set(text.split())):
            if rows:
                found.update(rows)
        return self.weights[list(found)].sum(axis=0)


def score_toxicity(docs: DataFrame, labels: DataFrame, categories: Sequence[str], threshold: float = 0.5, labelled: int = LABELLED) -> DataFrame:
    """(doc_id, p_<category>..., <category>...) for each row of ``docs``, by whole texts.

    Categories are predicted in the order given; each classifier after the first also takes the
    probabilities of those before it, which in training were predicted out of fold. Features are
    the hashed words and word shapes a text holds, chosen per category where they tell classes
    apart. A category applies where its probability reaches ``threshold``.

    Null and empty texts get what the intercepts say; without any usable label all probabilities are
    0. Repeated rows and null ids come back one for one. An empty table gives no rows.
    """
    categories = list(categories)
    chain = train(docs, labels, categories, labelled)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only_memo()
        slots = _Slots(chain)
        for batch in slices(batches):
            z = np.array([slots.logits(t.as_py()) for t in batch.column("text")]).reshape(batch.num_rows, len(chain))
            p = np.zeros((batch.num_rows, len(categories)))
            for k, link in enumerate(chain):
                p[:, k] = sigmoid(z[:, k] + p[:, :k] @ link.earlier + link.intercept)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(c) for c in p.T.copy()]], ["doc_id", *[f"p_{c}" for c in categories]])

    schema = "doc_id bigint, " + ", ".join(f"`p_{c}` double" for c in categories)
    return doc_rows(docs).mapInArrow(score, schema).select("*", *[(F.col(f"p_{c}") >= threshold).alias(c) for c in categories])
