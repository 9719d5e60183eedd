import random

import numpy as np
import pytest

from siteledger.llm import licenses
from siteledger.llm.common import read_table
from siteledger.llm.licenses import TEMPLATES, TemplateIndex, _tokens, align, scan_licenses, scan_text, winnow
from siteledger.llm.queries import QUERIES
from tests.llm.helpers import awkward_documents, empty_documents


def filler(draw, n):
    return " ".join("".join(draw.choice("abcdefghij") for _ in range(6)) for _ in range(n))


def longest_common(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + (x == y))
    return best[-1][-1]


def test_alignment_is_a_longest_common_subsequence():
    draw = random.Random(4)
    for _ in range(200):
        a, b = ([draw.randrange(4) for _ in range(draw.randint(1, 12))] for _ in range(2))
        pairs = align(np.array(a), np.array(b), 0, 12)
        assert len(pairs) == longest_common(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))


def test_winnowing_takes_one_of_each_window():
    hashes = np.random.default_rng(2).integers(0, 30, 200).astype(np.uint64)
    at = winnow(hashes, 4)
    assert all(any(i <= p < i + 4 and hashes[p] == hashes[i : i + 4].min() for p in at) for i in range(197))


def test_edited_templates_are_found_with_their_spans():
    draw, index = random.Random(7), TemplateIndex(TEMPLATES)
    for name, template in TEMPLATES.items():
        words = template.split()
        if len(words) > 30:
            for _ in range(len(words) // 20):
                words[draw.randrange(len(words))] = "changed"
            del words[11]
        before, after = filler(draw, 30), filler(draw, 2000)
        text = f"{before}\n{' '.join(words)} {after} {' '.join(words)}"
        found = [o for o in scan_text(index, text, 0.8) if o[0] == name]
        assert len(found) == 2
        (_, coverage, matched, total, first, last, a, b), second = found
        assert first in (30, 31) and 0.8 <= coverage <= 1 and matched <= total
        assert [w.decode() for w in _tokens(text[a:b])] == [w.decode() for w in _tokens(text)][first:last]
        assert second[4] >= 2030


def test_clean_text_and_half_templates_are_left_alone():
    index, draw = TemplateIndex(TEMPLATES), random.Random(1)
    assert scan_text(index, filler(draw, 5000), 0.8) == []
    half = " ".join(TEMPLATES["mit-grant"].split()[:45])
    assert not [o for o in scan_text(index, half, 0.8) if o[0] == "mit-grant"]


@pytest.mark.parametrize(
    ("text", "names"),
    [
        ("Released under the Apache License.", []),
        ("Released under the terms of the license.", []),
        ("Released under the BSD License.", ["bsd-line"]),
        ("Released under the MIT License.", ["mit-line"]),
        ("Licensed under CC BY 4.0.", ["cc-by-4.0-line"]),
        ("Licensed under CC BY-NC-ND 4.0.", []),
        ("This work is licensed under the GNU General Public License, version 2.", ["gpl-2.0-line"]),
        ("This work is licensed under the GNU Lesser General Public License, version 3.", []),
        ("Licensed under the Apache License, Version 1.1.", []),
        (TEMPLATES["gpl-3.0-notice"].replace("version 3", "version 2"), ["gpl-2.0-notice"]),
        (TEMPLATES["gpl-3.0-notice"].replace("version 3", "version 4"), []),
    ],
)
def test_another_license_is_not_reported(text, names):
    assert [o[0] for o in scan_text(TemplateIndex(TEMPLATES), f"before it {text} and after", 0.8)] == names


def test_short_templates_without_a_name_match_whole(spark):
    docs = awkward_documents(spark)
    assert scan_licenses(docs, {"fox": "quick red fox jumps over"}).count() == 0
    assert scan_licenses(docs, {"fox": "quick red fox jumps over"}, names={"fox": ["fox jumps"]}).count() == 3


def brute(text):
    """Templates whose words all stand in a row in the text."""
    words, out = [w.decode() for w in _tokens(text or "")], set()
    for name, template in TEMPLATES.items():
        t = [w.decode() for w in _tokens(template)]
        out |= {(name, i, i + len(t)) for i in range(len(words) - len(t) + 1) if words[i : i + len(t)] == t}
    return out


def test_whole_table(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").collect()
    expected = {(r.doc_id, *b) for r in docs for b in brute(r.text)}
    got = QUERIES["op1_license_scan"](spark, sf_dir).collect()
    assert {(r.doc_id, r.template, r.start_word, r.end_word) for r in got if r.coverage == 1.0 and r.end_word - r.start_word == r.template_words} == expected
    assert expected


def test_awkward_rows(spark):
    docs = awkward_documents(spark)
    assert scan_licenses(docs).count() == scan_licenses(empty_documents(spark)).count() == scan_licenses(docs, {}).count() == 0
    own = scan_licenses(docs, {"fox": "Quick brown fox jumps over", "empty": "..."}).collect()
    assert sorted((r.doc_id, r.template, r.start_word, r.end_word) for r in own) == [(1, "fox", 1, 6), (9, "fox", 1, 6), (9, "fox", 1, 6)]


def test_templates_are_bounded(monkeypatch):
    monkeypatch.setattr(licenses, "MOST_WORDS", 10)
    with pytest.raises(ValueError, match="several smaller sets"):
        TemplateIndex(TEMPLATES)
