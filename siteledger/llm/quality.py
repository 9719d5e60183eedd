"""Quality of documents from weak labels."""

from __future__ import annotations

import functools
from collections import Counter
from collections.abc import Iterator
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siteledger.llm.common import doc_rows, only_memo, packed, saved, slices, unpacked
from siteledger.llm.features import WordFeatures
from siteledger.llm.linear import Sparse, fit_logistic, sigmoid

#: Documents (about) whose posteriors the scorer is trained on, and columns it hashes into.
SAMPLE, BITS = 4_096, 16
GOOD, BAD, ABSTAIN = 1, 0, 2

_SYMBOLS = b"#$%&*|~^<>{}\\=_@"
_CAPITALS, _LETTERS = bytes(range(65, 91)), bytes([*range(65, 91), *range(97, 123)])
#: Fixed list: frequent function words of English, German, French and Spanish.
FUNCTION_WORDS = frozenset(
    "the of and to in is was for it with as that this be by on not are or from at an "
    "der die und das von zu mit den ist im dem nicht ein eine als auch es auf für sich "
    "le la les et des en un une du dans que pour qui sur par au est pas plus avec "
    "el los las de y del se con no una su al lo como más pero sus".split()
)


def _vote(bad: bool, good: bool) -> int:
    return BAD if bad else GOOD if good else ABSTAIN


def labels(text: str) -> str:
    """The labellers' votes on a text, a digit each: 1 good, 0 bad, 2 none."""
    data, words = text.encode("utf-8", "surrogatepass"), text.split()
    n, size = len(words), max(1, len(data))
    if not n:
        return "0" * len(LABELLERS)
    symbols = (len(data) - len(data.translate(None, _SYMBOLS))) / size
    letters = len(data) - len(data.translate(None, _LETTERS))
    capitals = (len(data) - len(data.translate(None, _CAPITALS))) / max(1, letters)
    again = sum(map(eq, words, words[1:])) / n
    distinct = len(set(words)) / n
    function = sum(map(FUNCTION_WORDS.__contains__, words)) / n
    shouted = text.count("!") / n
    stops = (text.count(".") + text.count("?") + text.count(":")) / n
    lines = [x for x in text.split("\n") if x.strip()]
    repeated = 1 - len(set(lines)) / max(1, len(lines))
    votes = (
        _vote(symbols > 0.03, symbols < 0.005),
        _vote(capitals > 0.3, capitals < 0.12 and letters > 20),
        _vote(again > 0.15, again < 0.03 and n >= 4),
        _vote(distinct < 0.25 * min(1.0, 400 / n) and n >= 30, distinct > 0.45 * min(1.0, 600 / n) and n >= 4),
        _vote(n < 3, n >= 30),
        _vote(function < 0.02 and n >= 20, function > 0.08),
        _vote(shouted > 0.2, False),
        _vote(stops > 0.6 or (stops == 0 and n > 60), 0.01 < stops < 0.3),
        _vote(repeated > 0.4 and len(lines) > 3, False),
    )
    return "".join(map(str, votes))


LABELLERS = ("symbols", "capitals", "repeats", "variety", "length", "function words", "shouting", "sentences", "repeated lines")


def fit_labellers(patterns: dict[str, int], rounds: int = 60) -> tuple[float, np.ndarray]:
    """Expectation-maximisation over vote patterns: the share of good documents and each labeller's votes given the class.

    ``accuracy[c, l, v]`` is the probability that labeller l, where it votes, votes v on a document
    of class c; that it does not vote says nothing. Starts from the majority of the votes; counts are smoothed, so no vote is ever ruled out.
    """
    votes = np.array([[int(v) for v in p] for p in patterns]).reshape(len(patterns), -1)
    counts = np.array(list(patterns.values()), dtype=float)
    good, bad = (votes == GOOD).sum(axis=1), (votes == BAD).sum(axis=1)
    # one bad sign outweighs what most texts have in common
    posterior = np.where(bad == 0, 0.95, np.where(2 * bad >= good, 0.05, 0.4))
    prior, accuracy = 0.5, np.full((2, votes.shape[1], 2), 0.5)
    for _ in range(rounds):
        weight = np.stack([counts * (1 - posterior), counts * posterior])
        prior = float((weight[1].sum() + 1) / (counts.sum() + 2))
        for v in (BAD, GOOD):
            accuracy[:, :, v] = weight @ (votes == v) + 1.0
        accuracy /= accuracy.sum(axis=2, keepdims=True)
        posterior = _posterior(votes, prior, accuracy)
    return prior, accuracy


def _posterior(votes: np.ndarray, prior: float, accuracy: np.ndarray) -> np.ndarray:
    lines = np.arange(votes.shape[1])
    logs = np.concatenate([np.log(accuracy), np.zeros((*accuracy.shape[:2], 1))], axis=2)
    return sigmoid(np.log(prior / (1 - prior)) + (logs[1, lines, votes] - logs[0, lines, votes]).sum(axis=1))


@functools.cache
def _features() -> WordFeatures:
    return WordFeatures(BITS)


def _columns(text: str) -> tuple[list[int], list[float]]:
    """Square roots of the shares of a text's hashed words, shapes and repeats: a row of length 1, whatever the text's."""
    words, lookup = text.split(), _features()
    if not words:
        return [], []
    counts: dict[int, int] = {}
    for word, n in Counter(words).items():
        for column in lookup[word]:
            counts[column] = counts.get(column, 0) + n
    counts[0] = counts.get(0, 0) + sum(map(eq, words, words[1:])) + 1
    total = 2 * len(words) + 1
    return list(counts), [(n / total) ** 0.5 for n in counts.values()]


def score_quality(docs: DataFrame, threshold: float = 0.5, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, dig, votes, posterior, score, keep) for each row of ``docs``.

    Overlapping heuristic labellers vote on every document. Expectation-maximisation over the
    counts of vote patterns, of which there are few however many documents, estimates how far to
    trust each; no given labels are used. The posteriors of about ``sample`` documents, drawn by
    a hash of id and text, train a linear scorer over hashed words, shapes and repeats, which then reads every whole text.
    A document is kept if its score, a probability, reaches ``threshold``.

    Null and empty texts have no words and score 0. Repeated rows score alike and come back one for
    one; ``dig`` tells apart the texts of one id. An empty table gives no rows.
    """
    rows = doc_rows(docs).withColumn("dig", F.xxhash64("text"))

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only_memo(_features())
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("dig"), pa.array([labels(t.as_py()) for t in batch.column("text")], pa.string())], ["doc_id", "dig", "votes"])

    voted = saved(rows.select("doc_id", "dig", "text").mapInArrow(vote, "doc_id bigint, dig bigint, votes string"), "votes")
    patterns = {r.votes: r.n for r in voted.groupBy("votes").agg(F.count("*").alias("n")).collect()}  # 3 to the number of labellers, at most
    if not patterns:
        return rows.select("doc_id", "dig", F.lit("").alias("votes"), F.lit(0.0).alias("posterior"), F.lit(0.0).alias("score"), F.lit(False).alias("keep"))
    prior, accuracy = fit_labellers(patterns)
    posterior = dict(zip(patterns, _posterior(np.array([[int(v) for v in p] for p in patterns]), prior, accuracy).tolist(), strict=True))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only_memo(_features())
        for batch in slices(batches):
            texts = [t.as_py() for t in batch.column("text")]
            found = [_columns(t) for t in texts]
            yield pa.RecordBatch.from_arrays([pa.array([labels(t) for t in texts], pa.string()), pa.array([c for c, _ in found], pa.list_(pa.int32())), pa.array([v for _, v in found], pa.list_(pa.float32()))], ["votes", "columns", "vals"])

    total = sum(patterns.values())
    drawn = rows.where(F.pmod(F.xxhash64(F.lit(3), "doc_id", "dig"), F.lit(max(1, total))) < sample).limit(2 * sample)
    train = drawn.select("text").mapInArrow(features, "votes string, columns array<int>, vals array<float>").toPandas()
    weights, intercept = _train(train, posterior)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only_memo(_features())
        for batch in slices(batches):
            out = []
            for t in batch.column("text"):
                columns, values = _columns(t.as_py())
                out.append(float(sigmoid(intercept + float(np.dot(weights[columns], values)))) if columns else 0.0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("dig"), pa.array([labels(t.as_py()) for t in batch.column("text")], pa.string()), pa.array(out, pa.float64())], ["doc_id", "dig", "votes", "score"])

    scored = rows.select("doc_id", "dig", "text").mapInArrow(score, "doc_id bigint, dig bigint, votes string, score double")
    known = F.create_map(*[F.lit(x) for item in posterior.items() for x in item])
    return scored.select("doc_id", "dig", "votes", F.element_at(known, F.col("votes")).alias("posterior"), "score", (F.col("score") >= threshold).alias("keep"))


def _train(train: pd.DataFrame, posterior: dict[str, float]) -> tuple[np.ndarray, float]:
    x = Sparse.of(train["columns"].tolist(), train["vals"].tolist())
    target = train["votes"].map(posterior).to_numpy(dtype=float)
    common = np.bincount(x.columns, minlength=1 << BITS)[x.columns] >= min(3, x.n_rows)  # columns of one or two texts tell nothing
    x = Sparse(x.rows[common], x.columns[common], x.values[common], x.n_rows)
    weights, _, intercept = fit_logistic(x, np.empty((x.n_rows, 0)), target, 1 << BITS, l2=1e-5, steps=120, rate=0.8)
    return weights, intercept


def good_documents(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``docs`` without those that the classifier rejects. Rows with a null id are judged like any other."""
    keep = saved(score_quality(docs, threshold).where("keep").select(F.col("doc_id").alias("of"), F.col("dig").alias("of_dig")).distinct(), "kept")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = packed(docs, key=F.col("doc_id").cast("long"), key_dig=F.xxhash64(text))
    return unpacked(rows.join(keep, rows.key.eqNullSafe(keep.of) & (rows.key_dig == keep.of_dig), "left_semi"))
