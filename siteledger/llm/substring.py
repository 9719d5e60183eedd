"""Removal of passages that earlier documents already hold."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siteledger.llm.common import WordCodes, doc_rows, gram_hashes, only_memo, packed, saved, slices, unpacked

#: Multipliers of the rolling hashes of anchors and of what surrounds them.
_BY, _AROUND = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
#: Rows of one anchor with different surroundings that one automaton holds; beyond, windows are compared by hash.
AUTOMATON_PIECES = 256
_ROW = "doc_id bigint, dig bigint"
#: Where a null id stands in the order of documents: last.
_LAST = (1 << 63) - 1
_codes = WordCodes()


class SuffixAutomaton:
    """Suffix automaton over word codes of several texts, built on line."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]

    def _add(self, last: int, code: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if code in nxt[last]:  # a text after the first may repeat what is there
            q = nxt[last][code]
            return q if length[q] == length[last] + 1 else self._split(last, code, q)
        state = len(nxt)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and code not in nxt[p]:
            nxt[p][code] = state
            p = link[p]
        if p >= 0:
            q = nxt[p][code]
            link[state] = q if length[q] == length[p] + 1 else self._split(p, code, q)
        return state

    def _split(self, p: int, code: int, q: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        clone = len(nxt)
        nxt.append(dict(nxt[q]))
        link.append(link[q])
        length.append(length[p] + 1)
        while p >= 0 and nxt[p].get(code) == q:
            nxt[p][code] = clone
            p = link[p]
        link[q] = clone
        return clone

    def add(self, text: list[int]) -> None:
        last = 0
        for code in text:
            last = self._add(last, code)

    def matching(self, text: list[int]) -> list[int]:
        """Matching statistics: for each word, how many up to and with it stand together somewhere in the texts added."""
        nxt, link, length = self.next, self.link, self.length
        state, run, out = 0, 0, []
        for code in text:
            while state and code not in nxt[state]:
                state = link[state]
                run = length[state]
            if code in nxt[state]:
                state = nxt[state][code]
                run += 1
            else:
                run = 0
            out.append(run)
        return out


def _anchor_grams(n_words: int) -> tuple[int, int]:
    """Words to an anchor, and how many of them a window of ``n_words`` holds."""
    if not 0 < n_words <= 120:
        raise ValueError("windows of 1 to 120 words: the places of an anchor's windows are bits of a long")
    gram = max(1, n_words // 2)
    return gram, n_words - gram + 1


def _anchors(codes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions, hashes and surroundings' hashes of a text's anchors.

    Every window's smallest gram hash is an anchor, so equal windows have equal anchors at the
    same place in them. An anchor's surroundings are all words that a window with it can hold.
    """
    gram, span = _anchor_grams(window)
    if len(codes) < window:
        return (np.empty(0, np.int64),) * 3
    hashes = gram_hashes(codes, gram, _BY)
    least, size = hashes, 1
    while size < span:  # smallest of a growing run of grams
        step = min(size, span - size)
        least = np.minimum(least[: len(least) - step], least[step:])
        size += step
    at = np.flatnonzero(hashes == _spread(least, span, len(hashes)))
    reach = window - gram
    padded = np.concatenate([np.zeros(reach, np.uint64), codes, np.zeros(reach, np.uint64)])
    around = gram_hashes(padded, window + reach, _AROUND)
    return at, hashes[at], around[at]


def _distinct(at: np.ndarray, hashes: np.ndarray, around: np.ndarray) -> tuple[list[int], list[np.ndarray | None]]:
    """Which anchors to keep of one text, the first of those with equal surroundings, and the places of the others.

    Where a text repeats a few words over and over, every repeat has the same anchor and surroundings.
    """
    pairs = list(zip(hashes.tolist(), around.tolist(), strict=True))
    if len(set(pairs)) == len(pairs):
        return list(range(len(pairs))), [None] * len(pairs)
    equal: dict[tuple[int, int], list[int]] = {}
    for i, pair in enumerate(pairs):
        equal.setdefault(pair, []).append(i)
    return [i[0] for i in equal.values()], [at[i[1:]].astype(np.int32) if len(i) > 1 else None for i in equal.values()]


def _spread(least: np.ndarray, span: int, n: int) -> np.ndarray:
    """For each gram, the largest of the minima of the windows that hold it; it is an anchor if that is itself."""
    out = np.concatenate([np.zeros(span - 1, np.uint64), least, np.zeros(span - 1, np.uint64)])
    size = 1
    while size < span:
        step = min(size, span - size)
        out = np.maximum(out[: len(out) - step], out[step:])
        size += step
    return out[:n]


def _first_least(hashes: np.ndarray, span: int) -> np.ndarray:
    """For each run of ``span`` grams, the place of its smallest; of equal ones, the first."""
    return np.lib.stride_tricks.sliding_window_view(hashes, span).argmin(axis=1) + np.arange(len(hashes) - span + 1)


def _words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split()  # ASCII white space only


def repeated_windows(rows: DataFrame, window: int, automaton_pieces: int = AUTOMATON_PIECES) -> DataFrame:
    """(doc_id, dig, starts): where the windows start that a document with a smaller id also holds.

    ``rows`` is (doc_id, dig, text), ``dig`` telling apart the texts of one id. ``starts`` has the place
    of an anchor, further places of the same anchor and surroundings, and the windows as bits, to be
    read by ``_kept``. See ``remove_repeats``.
    """
    gram, span = _anchor_grams(window)
    reach = window - gram

    def anchor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only_memo()
        for batch in slices(batches):
            out, more = [[], [], [], [], []], []
            for doc, dig, text in zip(batch.column("doc_id").to_pylist(), batch.column("dig").to_pylist(), batch.column("text"), strict=True):
                at, hashes, around = _anchors(_codes.of(_words(text.as_py())), window)
                kept, others = _distinct(at, hashes, around)
                more += others
                for column, values in zip(out, (np.full(len(kept), doc), np.full(len(kept), dig), at[kept], hashes[kept].view(np.int64), around[kept].view(np.int64)), strict=True):
                    column.append(values)
            columns = [pa.array(np.concatenate(c) if c else [], t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()), strict=True)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(more, pa.list_(pa.int32()))], ["doc_id", "dig", "pos", "anchor", "around", "more"])

    # one row for all places of a text with equal surroundings
    anchors = saved(rows.mapInArrow(anchor, _ROW + ", pos int, anchor bigint, around bigint, more array<int>"), "anchors")
    # pieces: an anchor with its surroundings; equal ones are one row per task before they move
    pieces = anchors.groupBy("anchor", "around").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    shared = pieces.groupBy("anchor").agg(F.count("*").alias("pieces"), F.min("first").alias("low"), F.max("last").alias("high")).where("low < high").select("anchor", "pieces")
    known = saved(pieces.join(shared, "anchor"), "pieces")

    held = anchors.join(known, ["anchor", "around"])
    # a document whose surroundings an earlier one has too repeats every window there
    whole = held.where("doc_id > first").select("doc_id", "dig", "pos", "more", F.lit((1 << span) - 1).cast("long").alias("starts"))
    # the first of several surroundings of an anchor is searched for in those of earlier documents
    asked = saved(held.where("doc_id = first AND pieces > 1").select("doc_id", "dig", "pos", "more", "anchor", "pieces"), "contested")
    lists = asked.groupBy("doc_id", "dig").agg(F.collect_set(F.struct("pos", "anchor", "pieces")).alias("places"))  # places of one document, once for all its rows

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only_memo()
        for batch in slices(batches):
            out: list[tuple] = []
            for doc, dig, text, places in zip(batch.column("doc_id").to_pylist(), batch.column("dig").to_pylist(), batch.column("text"), batch.column("places").to_pylist(), strict=True):
                words = _words(text.as_py())
                for p in places:
                    begin = max(0, p["pos"] - reach)
                    out.append((doc, dig, p["pos"], p["anchor"], p["pieces"], begin, b" ".join(words[begin : p["pos"] + window])))
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
            columns = list(zip(*out, strict=True)) if out else [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["doc_id", "dig", "pos", "anchor", "pieces", "begin", "piece"])

    texts = rows.join(lists, ["doc_id", "dig"]).select("doc_id", "dig", "text", "places")
    cuts = saved(texts.mapInArrow(cut, _ROW + ", pos int, anchor bigint, pieces bigint, begin int, piece binary"), "cuts")

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows arrive sorted by anchor and document: each streams through what earlier documents put in."""
        only_memo()
        now, automaton, waiting, owner, done = None, SuffixAutomaton(), [], None, None
        for batch in batches:
            out: list[tuple] = []
            for doc, dig, pos, key, begin, data in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "dig", "pos", "anchor", "begin", "piece")), strict=True):
                if (key, doc, dig, pos) == done:  # a repeated row
                    continue
                done = (key, doc, dig, pos)
                if key != now:
                    now, automaton, waiting, owner = key, SuffixAutomaton(), [], doc
                elif doc != owner:
                    for text in waiting:
                        automaton.add(text)
                    waiting, owner = [], doc
                text = data.split()
                starts, runs = 0, automaton.matching(text)
                for end, run in enumerate(runs):
                    if run >= window:  # a maximal span reaches back at least a window
                        starts |= 1 << (begin + end - window + 1 - (pos - reach))
                if starts:
                    out.append((doc, dig, pos, starts))
                if starts.bit_count() < len(text) - window + 1:  # nothing new in it otherwise
                    waiting.append(text)
            columns = list(zip(*out, strict=True)) if out else [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int32(), pa.int64()), strict=True)], ["doc_id", "dig", "pos", "starts"])

    found_schema = _ROW + ", pos int, starts bigint"
    routed = cuts.where(F.col("pieces") <= automaton_pieces).select("doc_id", "dig", "pos", "anchor", "begin", "piece")
    matched = routed.repartition("anchor").sortWithinPartitions("anchor", "doc_id", "dig", "pos").mapInArrow(match, found_schema)

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Windows of an anchor with too many surroundings for one automaton."""
        only_memo()
        for batch in batches:
            out: list[list] = [[], [], [], [], [], []]
            for doc, dig, pos, key, begin, data in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "dig", "pos", "anchor", "begin", "piece")), strict=True):
                codes = _codes.of(data.split())
                # each window once: where its first smallest gram is this anchor, as in every window equal to it
                own = _first_least(gram_hashes(codes, gram, _BY), span) == pos - begin
                hashes = gram_hashes(codes, window, _AROUND)[own].view(np.int64)
                places = np.flatnonzero(own) + begin - (pos - reach)
                for column, values in zip(out, (np.full(len(hashes), doc), np.full(len(hashes), dig), np.full(len(hashes), pos), np.full(len(hashes), key), places, hashes), strict=True):
                    column.append(values)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c) if c else [], t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64()), strict=True)], ["doc_id", "dig", "pos", "anchor", "place", "hash"])

    many = cuts.where(F.col("pieces") > automaton_pieces).select("doc_id", "dig", "pos", "anchor", "begin", "piece")
    windows = saved(many.mapInArrow(explode, _ROW + ", pos int, anchor bigint, place int, hash bigint"), "windows")  # read twice
    firsts = windows.groupBy("anchor", "hash").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last").drop("last")
    late = windows.join(firsts, ["anchor", "hash"]).where("doc_id > first")
    late = late.groupBy("doc_id", "dig", "pos").agg(F.bit_or(F.expr("shiftleft(1L, place)")).alias("starts"))

    # what was found at the first place of a piece holds at its others
    others = asked.where("more IS NOT NULL").select("doc_id", "dig", "pos", "more", F.lit(0).cast("long").alias("starts"))
    every = whole.unionByName(others).unionByName(matched.unionByName(late).withColumn("more", F.lit(None).cast("array<int>")))
    return every.groupBy("doc_id", "dig").agg(F.collect_set(F.struct("pos", "more", "starts")).alias("starts"))  # of one document, once for all its rows


def _kept(words: list[bytes], starts: list[dict], window: int) -> list[bytes]:
    gram, _ = _anchor_grams(window)
    gone = np.zeros(len(words) + 1, dtype=np.int64)
    more = {s["pos"]: s["more"] for s in starts if s["more"]}
    for s in starts:
        at, mask = np.array([s["pos"], *more.get(s["pos"], ())], dtype=np.int64) - (window - gram), s["starts"]
        while mask:  # windows side by side, at all places of the piece
            rest = mask & (mask + (mask & -mask))
            run = mask ^ rest
            begin = np.maximum(at + (run & -run).bit_length() - 1, 0)
            end = np.minimum(at + run.bit_length() - 1, len(words) - window)
            here = begin <= end
            np.add.at(gone, begin[here], 1)
            np.add.at(gone, end[here] + window, -1)
            mask = rest
    cover = np.cumsum(gone[:-1])
    return [w for w, c in zip(words, cover.tolist(), strict=True) if not c]


def remove_repeats(docs: DataFrame, window: int = 50, automaton_pieces: int = AUTOMATON_PIECES, with_text: bool = True) -> DataFrame:
    """Documents without the words of any ``window``-word passage that a document with a smaller id holds too.

    Returns (doc_id, dig, n_words, n_removed, kept_sha256, kept_text), a row for each row of
    ``docs``; ``kept_text`` is null where nothing is removed, or without ``with_text``. Words are
    runs without ASCII white space, unchanged, and windows are judged on the input.

    Here the reference is the table itself, so its automata have no size bound and are not
    broadcast whole: they are made in shards by anchor. Every window's smallest half-window gram is an
    anchor, and equal windows share it, so all copies of a passage meet at its anchors. Where an
    anchor's surroundings are equal, a hash tells, and they are one row for each document, however
    often it repeats them; only different surroundings of one anchor are sent on, each once, from
    its first document. In a shard they stream, in order of document, through
    a suffix automaton of what earlier documents brought: matching statistics of at least a
    window mark a repeat, and only what has something new is put in. An anchor with more than
    ``automaton_pieces`` different surroundings would grow too large for one task; its windows are
    compared by a plain grouped minimum, with the same results.

    Null and empty texts have no words. Rows with one id are neither earlier than the other; a null
    id is later than all others. Repeated rows come back one for one. An empty table gives no rows.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = doc_rows(docs).withColumns({"doc_id": F.coalesce("doc_id", F.lit(_LAST)), "dig": F.xxhash64(text)})
    found = repeated_windows(rows, window, automaton_pieces)

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only_memo()
        for batch in slices(batches):
            out: list[tuple] = []
            for doc, dig, value, starts in zip(batch.column("doc_id").to_pylist(), batch.column("dig").to_pylist(), batch.column("text"), batch.column("starts").to_pylist(), strict=True):
                words = _words(value.as_py())
                left = _kept(words, starts, window) if starts else words
                joined = b" ".join(left)
                changed = with_text and len(left) < len(words)
                out.append((None if doc == _LAST else doc, dig, len(words), len(words) - len(left), hashlib.sha256(joined).hexdigest(), joined.decode("utf-8", "surrogatepass") if changed else None))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], ["doc_id", "dig", "n_words", "n_removed", "kept_sha256", "kept_text"])

    joined = rows.join(found, ["doc_id", "dig"], "left").select("doc_id", "dig", "text", "starts")
    return joined.mapInArrow(remove, _ROW + ", n_words bigint, n_removed bigint, kept_sha256 string, kept_text string")


def deduplicated(docs: DataFrame, window: int = 50) -> DataFrame:
    """``docs`` with repeated passages cut out of ``text``; documents of which nothing is left go.

    A document that repeats nothing keeps its text as it is; one that does keeps its remaining
    words, joined by a space. ``n_chars`` follows the new text where there is such a column.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    changes = remove_repeats(docs, window).where("n_removed > 0").select(F.coalesce("doc_id", F.lit(_LAST)).alias("of"), F.col("dig").alias("of_dig"), "kept_text").distinct()
    rows = packed(docs, key=F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)), key_dig=F.xxhash64(text))
    joined = rows.join(saved(changes, "changes"), (F.col("key") == F.col("of")) & (F.col("key_dig") == F.col("of_dig")), "left")
    joined = joined.where("kept_text IS NULL OR kept_text <> ''")
    replaced = {"text": F.when(F.col("kept_text").isNull(), F.col("row.text")).otherwise(F.col("kept_text"))}
    if "n_chars" in docs.columns:
        chars = F.length("kept_text").cast(docs.schema["n_chars"].dataType)
        replaced["n_chars"] = F.when(F.col("kept_text").isNull(), F.col("row.n_chars")).otherwise(chars)
    return unpacked(joined, **replaced)
