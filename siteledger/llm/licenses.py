"""License texts found in documents: winnowed fingerprints, then banded alignment."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from siteledger.llm.common import WordCodes, doc_rows, gram_hashes, slices

#: Words to a gram, grams to a winnowing window; for templates of under SHORT words, the second pair.
GRAM, WINNOW, SHORT, SHORT_GRAM, SHORT_WINNOW = 5, 4, 15, 3, 1
#: All templates together may have so many words, as their index goes to every task.
MOST_WORDS = 2_000_000
_BY = 0x9E3779B97F4A7C15
_WORD = re.compile(r"[^\W_]+")

#: Well-known notices and grants of public licenses.
TEMPLATES = {
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "mit-line": "Released under the MIT License.",
    "apache-2.0-notice": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
        compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
        Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on
        an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the
        specific language governing permissions and limitations under the License.""",
    "bsd-conditions": """Redistribution and use in source and binary forms, with or without modification, are permitted provided
        that the following conditions are met: Redistributions of source code must retain the above copyright notice, this
        list of conditions and the following disclaimer.""",
    "gpl-3.0-notice": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
        General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your
        option) any later version.""",
    "mit-grant": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
        rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to
        permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright
        notice and this permission notice shall be included in all copies or substantial portions of the Software.""",
    "agpl-3.0-notice": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
        Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at
        your option) any later version.""",
    "bsd-line": "Released under the BSD License.",
    "cc-by-4.0-line": "Licensed under CC BY 4.0.",
    "cc-by-sa-4.0-line": "Licensed under CC BY-SA 4.0.",
    "gpl-2.0-line": "This work is licensed under the GNU General Public License, version 2.",
    "gpl-2.0-notice": """This program is free software; you can redistribute it and/or modify it under the terms of the GNU
        General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your
        option) any later version.""",
    "isc-grant": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
        hereby granted, provided that the above copyright notice and this permission notice appear in all copies.""",
    "lgpl-2.1-notice": """This library is free software; you can redistribute it and/or modify it under the terms of the GNU
        Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at
        your option) any later version.""",
    "mpl-2.0-notice": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the
        MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
}

#: The words that tell a license from others: each of these runs must match word by word, with nothing between.
NAMES = {
    "agpl-3.0-notice": ("GNU Affero General", "version 3"),
    "apache-2.0-line": ("Apache License Version 2.0",),
    "apache-2.0-notice": ("Apache License Version 2.0",),
    "bsd-line": ("BSD License",),
    "cc-by-4.0-line": ("CC BY 4.0",),
    "cc-by-nc-4.0-line": ("CC BY NC 4.0",),
    "cc-by-sa-4.0-line": ("CC BY SA 4.0",),
    "gpl-2.0-line": ("GNU General Public License version 2",),
    "gpl-2.0-notice": ("GNU General", "version 2"),
    "gpl-3.0-line": ("GNU General Public License version 3",),
    "gpl-3.0-notice": ("GNU General", "version 3"),
    "lgpl-2.1-notice": ("GNU Lesser General", "version 2.1"),
    "mit-line": ("MIT License",),
    "mpl-2.0-notice": ("Public License v 2.0", "MPL 2.0"),
}

SPANS = "doc_id bigint, template string, coverage double, matched int, template_words int, start_word bigint, end_word bigint, start_char bigint, end_char bigint"


def _tokens(text: str) -> list[bytes]:
    return [w.encode("utf-8", "surrogatepass") for w in _WORD.findall(text.lower())]


def winnow(hashes: np.ndarray, window: int) -> np.ndarray:
    """Positions of the smallest hash of each run of ``window``, the last one where several are."""
    if len(hashes) <= window:
        return np.array([len(hashes) - 1 - int(hashes[::-1].argmin())]) if len(hashes) else np.empty(0, np.int64)
    view = np.lib.stride_tricks.sliding_window_view(hashes, window)
    return np.unique(np.arange(len(view)) + window - 1 - view[:, ::-1].argmin(axis=1))


def _run(words: np.ndarray, phrase: np.ndarray) -> range:
    """Where the phrase first stands in the words; empty if nowhere."""
    n = len(phrase)
    return next((range(i, i + n) for i in range(len(words) - n + 1) if n and (words[i : i + n] == phrase).all()), range(0))


class TemplateIndex:
    """Inverted index: fingerprint to the places of templates that hold it."""

    def __init__(self, templates: Mapping[str, str], names: Mapping[str, Sequence[str]] = NAMES):
        self.codes, self.words, index = WordCodes(), {}, defaultdict(list)
        self.named: dict[str, list[range]] = {}
        for name in sorted(templates):
            words = self.codes.of(_tokens(templates[name]))
            if not len(words):
                continue
            self.words[name] = words
            runs = [_run(words, self.codes.of(_tokens(phrase))) for phrase in names.get(name, ())]
            # a short template without such words must match whole
            self.named[name] = [r for r in runs if r] or ([range(len(words))] if len(words) < SHORT else [])
            gram, window = (SHORT_GRAM, SHORT_WINNOW) if len(words) < SHORT else (GRAM, WINNOW)
            gram = min(gram, len(words))
            hashes = gram_hashes(words, gram, _BY)
            for at in winnow(hashes, window).tolist():
                index[gram, int(hashes[at])].append((name, at))
        if sum(map(len, self.words.values())) > MOST_WORDS:
            raise ValueError(f"templates of more than {MOST_WORDS} words: scan with several smaller sets")
        self.places = dict(index)
        self.grams = {g: np.array(sorted(h for n, h in index if n == g), dtype=np.uint64) for g in sorted({n for n, _ in index})}

    def hits(self, codes: np.ndarray) -> dict[str, list[tuple[int, int]]]:
        """Template to (place in the text, place in the template) of each fingerprint they share."""
        out = defaultdict(list)
        for gram, known in self.grams.items():
            hashes = gram_hashes(codes, gram, _BY)
            if not len(hashes):
                continue
            at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
            for i in np.flatnonzero(known[at] == hashes).tolist():
                for name, place in self.places[gram, int(hashes[i])]:
                    out[name].append((i, place))
        return out


def align(template: np.ndarray, text: np.ndarray, shift: int, band: int) -> list[tuple[int, int]]:
    """Pairs of equal words of a longest common subsequence, where text minus template place is within ``band`` of ``shift``."""
    m, width = len(template), 2 * band + 1
    columns = np.arange(width) - band + shift
    best = np.zeros((m + 1, width), dtype=np.int32)
    equal = np.zeros((m, width), dtype=bool)
    for i in range(m):
        j = i + columns
        inside = (j >= 0) & (j < len(text))
        equal[i, inside] = text[j[inside]] == template[i]
        # column c of row i + 1 is text place i + c; skipping a template word moves one column to the right above
        above = np.concatenate([best[i, 1:], [0]])
        best[i + 1] = np.maximum.accumulate(np.maximum(above, best[i] + equal[i]))
    pairs, i, c = [], m, int(best[m].argmax())
    while i > 0 and c >= 0 and best[i, c]:
        if c and best[i, c] == best[i, c - 1]:
            c -= 1
        elif equal[i - 1, c] and best[i, c] == best[i - 1, c] + 1:
            pairs.append((i - 1, i - 1 + int(columns[c])))
            i -= 1
        else:
            i, c = i - 1, min(c + 1, width - 1)
    return pairs[::-1]


def occurrences(template: np.ndarray, text: np.ndarray, hits: list[tuple[int, int]], coverage: float, named: Sequence[range] = ()) -> list[tuple[int, int, int]]:
    """(matched words, first place, last place) of each alignment that covers enough of the template, and its ``named`` runs unbroken; none overlap."""
    band = max(2, len(template) // 8)
    found: list[tuple[int, int, int]] = []
    shifts = sorted({at - place for at, place in hits})
    groups: list[list[int]] = []
    for s in shifts:
        if groups and s - groups[-1][0] <= band:
            groups[-1].append(s)
        else:
            groups.append([s])
    for group in groups:
        pairs = align(template, text, group[len(group) // 2], band)
        at = dict(pairs)
        whole = all(at.get(k, -1) == at.get(run[0], -2) + k - run[0] for run in named for k in run)
        if pairs and len(pairs) >= coverage * len(template) and whole:
            found.append((len(pairs), pairs[0][1], pairs[-1][1]))
    kept: list[tuple[int, int, int]] = []
    for one in sorted(found, key=lambda f: (-f[0], f[2] - f[1], f[1])):
        if all(one[2] < k[1] or one[1] > k[2] for k in kept):
            kept.append(one)
    return sorted(kept, key=lambda f: f[1])


def scan_text(index: TemplateIndex, text: str, coverage: float) -> list[tuple]:
    """(template, coverage, matched, template words, word and character spans), by place."""
    codes = index.codes.of(_tokens(text))
    hits = index.hits(codes)
    if not hits:
        return []
    # a letter may change its length in small letters, so characters are counted in the text as it stands
    spans = [m.span() for m in _WORD.finditer(text)]
    lowered = [m.span() for m in _WORD.finditer(text.lower())]
    exact = len(spans) == len(lowered)
    out = []
    for name, places in hits.items():
        template = index.words[name]
        for matched, first, last in occurrences(template, codes, places, coverage, index.named[name]):
            chars = (spans[first][0], spans[last][1]) if exact else (lowered[first][0], lowered[last][1])
            out.append((name, matched / len(template), matched, len(template), first, last + 1, *chars))
    return sorted(out, key=lambda o: (o[4], o[0]))


def scan_licenses(docs: DataFrame, templates: Mapping[str, str] | None = None, coverage: float = 0.8, names: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Occurrences of templates in whole texts: a row for each, with the share of the template matched and its span.

    Templates are winnowed: of each run of word grams the smallest hash is a fingerprint, and the
    inverted index of those, bounded by ``MOST_WORDS``, goes to every task. All grams of a text are
    looked up; a template that shares any is aligned word by word within a band around each place
    the fingerprints point to. An alignment that matches ``coverage`` of the template's words is an
    occurrence if the words that name the license (``names``, by template; ``NAMES`` if not given) all
    match with nothing between them, so that another version or license is none; a template of under
    ``SHORT`` words without such a name must match whole: (doc_id, template, coverage, matched, template_words, start_word, end_word,
    start_char, end_char), ends exclusive. Occurrences of one template do not overlap; different
    templates may. Words are runs of letters and digits, in small letters.

    No row moves between tasks. Null and empty texts have no occurrence; repeated rows and null
    ids are scanned like any other; an empty table, or no templates, gives no rows.
    """
    # names are only those of the templates they were made for
    names = (NAMES if templates is None else {}) if names is None else dict(names)
    templates = TEMPLATES if templates is None else dict(templates)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = TemplateIndex(templates, names)
        for batch in slices(batches):
            out = [(doc, *o) for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True) for o in scan_text(index, text.as_py(), coverage)]
            kinds = [pa.int64(), pa.string(), pa.float64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
            columns = list(zip(*out, strict=True)) if out else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], [c.split()[0] for c in SPANS.split(", ")])

    return doc_rows(docs).mapInArrow(scan, SPANS)
