"""Small tables with every awkward case, and plain versions of what the operators compute."""

from __future__ import annotations

import re

import numpy as np

WORDS = re.compile(r"[^\x20\x09-\x0D]+").findall


def awkward_documents(spark):
    """Nulls in every column, empty and long texts, repeated rows, ties, and columns with clashing names."""
    long = " ".join(f"word{i % 997}" for i in range(30_000))
    shared = " ".join(f"Passage{i}" for i in range(60))
    rows = [
        (1, "the quick brown fox jumps over the lazy dog", "en", "a", 43, "x", 1),
        (2, None, "en", "a", None, None, None),
        (3, "", None, None, 0, "y", 2),
        (4, "   \n\t ", "de", "b", 6, "z", 3),
        (5, long, "en", "b", len(long), "z", 3),
        (6, shared, "en", "c", len(shared), "z", 3),
        (7, f"before {shared} after", "en", "c", 1, "z", 3),
        (8, shared, "en", None, 1, "z", 3),
        (9, "The Quick brown fox jumps over the lazy dog", "en", "a", 43, "x", 1),
        (9, "The Quick brown fox jumps over the lazy dog", "en", "a", 43, "x", 1),
        (None, "a row without an id", "en", "a", 1, None, None),
        (None, None, None, None, None, None, None),
        (10, "özel\xa0boşluk <|endoftext|> end", "tr", "d", 1, "q", 0),
    ]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, size int")


def empty_documents(spark):
    return awkward_documents(spark).limit(0)


def words(text):
    return WORDS(text or "")


def components(nodes, links):
    """Smallest node reachable from each."""
    root = {n: n for n in nodes}

    def top(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = sorted((top(a), top(b)))
        root[b] = a
    return {n: top(n) for n in nodes}


def unit(x):
    x = np.asarray(x, dtype=float)
    return x / np.linalg.norm(x, axis=1, keepdims=True)
