import hashlib
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from siteledger.llm.common import gram_hashes, read_table
from siteledger.llm.queries import QUERIES
from siteledger.llm.substring import SuffixAutomaton, _anchors, _first_least, deduplicated, remove_repeats, repeated_windows
from tests.llm.helpers import awkward_documents, empty_documents, words


def plain(docs, window):
    """doc_id to kept words, by a dictionary of all windows."""
    first, split = {}, {d: words(t) for d, t in docs}
    for d in sorted(split):
        w = split[d]
        for i in range(len(w) - window + 1):
            first.setdefault(tuple(w[i : i + window]), d)
    out = {}
    for d, w in split.items():
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < d:
                gone[i : i + window] = [True] * window
        out[d] = (len(w), [x for x, g in zip(w, gone, strict=True) if not g])
    return out


def digest(kept):
    return hashlib.sha256(" ".join(kept).encode()).hexdigest()


def scrambled(n=120, seed=3):
    """Texts made of shared passages, cut, altered and repeated, over few words."""
    draw = random.Random(seed)
    passages = [[f"w{draw.randrange(40)}" for _ in range(draw.randint(5, 40))] for _ in range(12)]
    docs = []
    for d in range(n):
        text = []
        for _ in range(draw.randint(0, 6)):
            p = list(draw.choice(passages))
            if draw.random() < 0.4:
                p[draw.randrange(len(p))] = f"x{draw.randrange(9999)}"
            text += p[draw.randrange(3) :]
            if draw.random() < 0.5:
                text += [f"y{draw.randrange(9999)}" for _ in range(draw.randint(1, 9))]
        docs.append((d * 7 % n, " ".join(text)))
    return docs


def test_automaton_matching_statistics():
    draw = random.Random(2)
    for _ in range(150):
        texts = [[draw.randrange(3) for _ in range(draw.randint(0, 25))] for _ in range(draw.randint(1, 5))]
        automaton = SuffixAutomaton()
        for t in texts:
            automaton.add(t)
        grams = {tuple(t[i:j]) for t in texts for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
        asked = [draw.randrange(3) for _ in range(30)]
        expected = [max((n for n in range(1, e + 2) if tuple(asked[e + 1 - n : e + 1]) in grams), default=0) for e in range(30)]
        assert automaton.matching(asked) == expected


def test_every_window_has_its_smallest_gram_as_anchor():
    codes = np.random.default_rng(1).integers(0, 50, 400).astype(np.uint64)
    at, hashes, _ = _anchors(codes, 12)
    grams = gram_hashes(codes, 6, 0x9E3779B97F4A7C15)
    assert (grams[at] == hashes).all()
    chosen = set(at.tolist())
    first = _first_least(grams, 7)
    assert len(first) == len(codes) - 12 + 1
    for i in range(len(codes) - 12 + 1):
        run = grams[i : i + 7]
        assert i + int(run.argmin()) == first[i] and first[i] in chosen


@pytest.mark.parametrize(("window", "pieces"), [(10, 2000), (10, 2), (10, 0), (7, 5), (1, 0), (50, 2000)])
def test_scrambled_texts(spark, window, pieces):
    docs = scrambled()
    expected = plain(docs, window)
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(7)
    got = {r.doc_id: r for r in remove_repeats(frame, window, pieces).collect()}
    assert len(got) == len(docs)
    for d, (n, kept) in expected.items():
        assert (got[d].n_words, got[d].n_removed, got[d].kept_sha256) == (n, n - len(kept), digest(kept))
        assert got[d].kept_text == (" ".join(kept) if len(kept) < n else None)
    assert window == 50 or any(0 < len(k) < n for n, k in expected.values())


def test_whole_table(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in read_table(spark, sf_dir, "documents").collect()]
    expected = {(d, n, n - len(k), digest(k)) for d, (n, k) in plain(docs, 50).items()}
    assert {tuple(r) for r in QUERIES["op4_substring_dedup"](spark, sf_dir).collect()} == expected


def test_awkward_rows(spark):
    docs = awkward_documents(spark)
    rows = remove_repeats(docs).collect()
    assert len(rows) == docs.count()
    by = {r.doc_id: r for r in rows}
    assert (by[2].n_words, by[2].kept_sha256) == (0, digest([]))
    assert by[5].n_words == 30_000 and by[5].n_removed == 0  # a document's own repeats stay
    assert (by[6].n_removed, by[7].n_removed, by[7].kept_text, by[8].n_removed, by[8].kept_text) == (0, 60, "before after", 60, "")
    kept = deduplicated(docs)
    assert kept.columns == docs.columns
    left = {r.doc_id: r for r in kept.collect()}
    assert 8 not in left and left[7].text == "before after" and left[7].n_chars == 12 and left[7].row == "z"
    assert kept.count() == docs.count() - 1
    assert remove_repeats(empty_documents(spark)).count() == deduplicated(empty_documents(spark)).count() == 0


def test_repeated_rows_cost_what_they_are(spark):
    """A thousand equal rows of one id beside texts that share passages with them: one for one, in linear work."""
    text = " ".join(f"w{i % 90}" for i in range(400))
    docs = [(1, " ".join(f"w{i % 90}" for i in range(37, 150))), *[(5, text)] * 1000, (5, "another text of this id"), (9, "x " + text)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(6)
    start = time.perf_counter()
    got = remove_repeats(frame).collect()
    assert time.perf_counter() - start < 60
    by = {(r.doc_id, r.n_words): r for r in got}
    assert len(got) == len(docs) and len(by) == 4
    assert (by[5, 400].n_removed, by[9, 401].n_removed, by[5, 5].n_removed) == (400 - len(plain([docs[0], (5, text)], 50)[5][1]), 400, 0)


def test_windows_compared_by_hash_are_made_once(spark, capsys):
    passage = [f"p{i}" for i in range(8)]
    texts = [(d, " ".join([f"a{d}", *passage, f"b{d}"])) for d in range(6)]
    found = remove_repeats(spark.createDataFrame(texts, "doc_id bigint, text string"), 5, automaton_pieces=2)
    found.explain()
    assert "explode(" not in capsys.readouterr().out
    assert sorted((r.doc_id, r.n_words, r.n_removed) for r in found.collect()) == [(d, 10, 8 if d else 0) for d in range(6)]


def test_a_text_that_repeats_itself_has_a_row_for_each_different_piece(spark):
    """Four documents with two words 300 times over: what the join of pieces finds is not a row for every repeat."""
    docs = [(d, " ".join([f"a{d}", *["is", "one"] * 300, f"b{d}"])) for d in range(4)]
    rows = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("dig", F.xxhash64("text"))
    found = {r.doc_id: r.starts for r in repeated_windows(rows, 50).collect()}
    assert {1, 2, 3} <= set(found) and all(len(starts) < 60 for starts in found.values())
    got = {r.doc_id: (r.n_words, r.n_removed) for r in remove_repeats(rows.select("doc_id", "text")).collect()}
    assert got == {d: (602, 600 if d else 0) for d in range(4)}


@pytest.mark.parametrize(("window", "pieces"), [(10, 2000), (10, 0), (7, 3), (1, 2000), (50, 2000), (50, 0)])
def test_texts_that_repeat_themselves(spark, window, pieces):
    """Periods below and above a window, broken off, shifted and with a word altered, against all windows."""
    draw, docs = random.Random(window), []
    for d in range(60):
        text = [f"a{draw.randrange(4)}"] * draw.randrange(3)
        for _ in range(draw.randint(1, 3)):
            period = [f"p{draw.choice((1, 2, 3, 8, 30, 60))}-{i}" for i in range(draw.choice((1, 2, 3, 8, 30, 60)))]
            part = (period * 130)[draw.randrange(len(period)) :][: draw.randint(1, 130)]
            if draw.random() < 0.5:
                part[draw.randrange(len(part))] = f"x{draw.randrange(9999)}"
            text += part + [f"y{draw.randrange(3)}"] * draw.randrange(2)
        docs.append((d * 7 % 60, " ".join(text)))
    expected = plain(docs, window)
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(7)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in remove_repeats(frame, window, pieces).collect()}
    assert got == {d: (n, n - len(kept), digest(kept)) for d, (n, kept) in expected.items()}
    assert any(0 < len(kept) < n for n, kept in expected.values())
