"""Packing of tokenized documents into sequences of fixed length."""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siteledger.llm.common import doc_rows, only_memo, saved, slices
from siteledger.llm.tokens import WORD_BPE, word_encoder

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
#: Pieces packed together. Groups are numbered in 24 bits of a sequence's number.
GROUP = 16_384


def token_pieces(docs: DataFrame, capacity: int, tokenizer: str = WORD_BPE, end_id: int = 1) -> DataFrame:
    """Documents as runs of at most ``capacity`` ids, ``end_id`` behind each document's own."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end, width = word_encoder(tokenizer), end_id.to_bytes(4, "little"), 4 * capacity
        only_memo(encoder.memo)
        for batch in slices(batches, most=2 << 20):
            out: list[tuple] = []
            for doc, ids in zip(batch.column("doc_id").to_pylist(), encoder.encode(batch.column("text").to_pylist()), strict=True):
                data = ids + end
                for k, at in enumerate(range(0, len(data), width)):
                    part = data[at : at + width]
                    out.append((doc, k, at // 4, len(part) // 4, zlib.crc32(part)))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return doc_rows(docs).mapInArrow(cut, PIECES)


def best_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Best fit, longest first: bins as lists of item numbers."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_rooms = 0  # bit r: some bin has exactly r left
    for item in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[item])
        if at_least := open_rooms >> need:
            room = need + (at_least & -at_least).bit_length() - 1
            number = by_room[room].pop()
            if not by_room[room]:
                open_rooms &= ~(1 << room)
            bins[number].append(item)
        else:
            room, number = capacity, len(bins)
            bins.append([item])
        by_room[room - need].append(number)
        open_rooms |= 1 << (room - need)
    return bins


def _pairs(by_length: dict[int, list[int]]) -> list[tuple[int, int, int]]:
    """(sum, length, length) of all pairs of documents of a bin that differ in their lengths, by sum."""
    lengths = sorted(by_length)
    found = [(a + b, a, b) for n, a in enumerate(lengths) for b in lengths[n + 1 :]]
    return sorted(found + [(2 * a, a, a) for a in lengths if len(by_length[a]) > 1])


def _largest(values: list, most: int) -> int:
    """Place of the last value, or tuple that begins with one, up to ``most``; -1 without one."""
    return bisect_right(values, most, key=lambda v: v[0] if isinstance(v, tuple) else v) - 1


def empty_bins(bins: list[list[int]], lengths: np.ndarray, capacity: int, stuck_after: int = 8, most_steps: int = 2_000) -> list[list[int]]:
    """Local search between underfull bins until bins empty.

    From the emptiest bin towards fuller ones: move a document; exchange one for a shorter one;
    two for one, or one for two, where the fuller bin gains and does not overflow. Documents of one
    length are alike, and a bin has few lengths, so all exchanges are looked at. Every step
    moves tokens from a bin to one at least as full, so the sum of squared fills rises and the
    search ends. It stops at the least number of bins the total allows, when the ``stuck_after``
    emptiest bins have no such step, or after ``most_steps``.
    """
    size = [int(x) for x in lengths]
    fill = [sum(size[i] for i in b) for b in bins]
    least = -(-sum(size) // capacity)
    alive = {k for k in range(len(bins)) if fill[k]}
    kinds: dict[int, dict[int, list[int]]] = {}

    def of(k: int) -> dict[int, list[int]]:
        """The documents of a bin by length."""
        if k not in kinds:
            kinds[k] = {}
            for i in bins[k]:
                kinds[k].setdefault(size[i], []).append(i)
        return kinds[k]

    def step(low: int, others: list[int]) -> bool:
        mine = sorted(of(low))
        pairs = _pairs(of(low))
        for high in others:
            room = capacity - fill[high]
            best: tuple[int, tuple[int, ...], tuple[int, ...]] = (0, (), ())
            if (at := _largest(mine, room)) >= 0:
                best = (mine[at], (mine[at],), ())
            theirs = sorted(of(high))
            for b in theirs if best[0] < room else ():
                at = _largest(mine, room + b)
                if at >= 0 and mine[at] - b > best[0]:
                    best = (mine[at] - b, (mine[at],), (b,))
                at = _largest(pairs, room + b)
                if at >= 0 and pairs[at][0] - b > best[0]:
                    best = (pairs[at][0] - b, pairs[at][1:], (b,))
            for total, b, c in _pairs(of(high)) if best[0] < room else ():
                at = _largest(mine, room + total)
                if at >= 0 and mine[at] - total > best[0]:
                    best = (mine[at] - total, (mine[at],), (b, c))
            if best[0]:
                gain, give, take = best
                for source, target, moved in ((low, high, give), (high, low, take)):
                    for length in moved:
                        item = of(source)[length].pop()
                        if not of(source)[length]:
                            del of(source)[length]
                        of(target).setdefault(length, []).append(item)
                fill[low] -= gain
                fill[high] += gain
                return True
        return False

    stuck: set[int] = set()
    steps = 0
    while len(alive) > least and len(stuck) < stuck_after and steps < most_steps:
        underfull = sorted((k for k in alive if fill[k] < capacity), key=fill.__getitem__)
        low = next((k for k in underfull if k not in stuck), None)
        if low is None:
            break
        if step(low, [k for k in reversed(underfull) if k != low and fill[k] >= fill[low]]):
            steps += 1
            stuck.clear()
            if not fill[low]:
                alive.discard(low)
        else:
            stuck.add(low)
    return [[i for same in kinds[k].values() for i in same] if k in kinds else bins[k] for k in sorted(alive)]


def pack(docs: DataFrame, capacity: int = 4096, tokenizer: str = WORD_BPE, group: int = GROUP) -> DataFrame:
    """Whole documents packed into sequences of at most ``capacity`` ids.

    Returns (doc_id, piece, start, length, ids_crc32, sequence_id, offset), a row for each piece;
    only documents longer than a sequence are cut. Texts are encoded where they are read; what
    moves is a few numbers per piece. Pieces are dealt evenly over groups of about ``group``,
    whatever their sources or ids, each packed by best fit and then by local search. The emptiest
    sequence of each group is opened again, and the pieces of these are packed in the same way, until one group
    is left, so that not every group ends with a sequence half full.

    Null and empty texts hold the end id only. Repeated rows and null ids are packed like any
    other; an empty table gives no rows.
    """
    rows = saved(token_pieces(docs, capacity, tokenizer), "pieces")
    groups = max(1, -(-rows.count() // group))
    done, level = None, 0
    while True:
        dealt = rows.withColumn("unit", F.pmod(F.monotonically_increasing_id(), F.lit(groups)).cast("int"))
        packed = dealt.groupBy("unit").applyInPandas(_filler(capacity, level, groups > 1), PIECES + ", sequence_id bigint, offset bigint, again boolean")
        if groups == 1:
            kept = packed.drop("again")
            return kept if done is None else done.unionByName(kept)
        packed = saved(packed, f"packed-{level}")
        kept, rows = packed.where("NOT again").drop("again"), packed.where("again").drop("again", "sequence_id", "offset")
        done = kept if done is None else done.unionByName(kept)
        # a sequence opened again holds at most ``capacity`` pieces, so there are fewer groups each time
        groups = min(groups - 1, max(1, -(-rows.count() // group)))
        level += 1


def _filler(capacity: int, level: int, open_last: bool) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def fill_bins(part: pd.DataFrame) -> pd.DataFrame:
        only_memo()
        lengths = part["length"].to_numpy()
        bins = empty_bins(best_fit(lengths, capacity), lengths, capacity)
        fills = [int(lengths[items].sum()) for items in bins]
        emptiest = min(range(len(bins)), key=fills.__getitem__)
        sequence, offset = np.empty(len(part), np.int64), np.empty(len(part), np.int64)
        again = np.zeros(len(part), dtype=bool)
        for number, items in enumerate(bins):
            at = 0
            for item in items:
                sequence[item], offset[item] = number, at
                at += lengths[item]
            again[items] = open_last and number == emptiest and fills[number] < capacity
        unit = int(part["unit"].iloc[0])
        return part.drop(columns="unit").assign(sequence_id=sequence + (unit << 32) + (level << 56), offset=offset, again=again)

    return fill_bins
