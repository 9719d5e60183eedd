import random
import zlib

import numpy as np
import pytest

from siteledger.llm import packing, token_counts, tokens
from siteledger.llm.common import read_table
from siteledger.llm.packing import best_fit, empty_bins, pack, token_pieces
from siteledger.llm.queries import QUERIES
from siteledger.session import scratch_path
from tests.llm.helpers import awkward_documents, empty_documents

PARTS = ["a", "B", "é", "é", "Σ", "ß", "'s", "'", " ", "  ", "\n", "\t", "\r\n", "\xa0", " ", "\x1c", "\x85", "<|endoftext|>", "<|startoftext|>", ".", "!", "5", "42", "日本", "👍", "̸", "=", "of", "the", "​", "İ", "can't", "'LL", "\x0b", "\x00"]


def _texts(n=1500):
    draw = random.Random(4)
    return ["".join(draw.choice(PARTS) for _ in range(draw.randint(0, 14))) for _ in range(n)]


def test_counter_is_the_library():
    library, count = tokens.load(tokens.BYTE_BPE), tokens.counter(tokens.BYTE_BPE).count
    for text in _texts():
        assert count(text) == len(library.encode(text, add_special_tokens=False).ids)


def test_counter_reads_piece_models():
    assert tokens.counter("piece_bpe_32k.model").count("a few words") > 0


def test_word_encoder_is_the_library():
    library, ids = tokens.load(tokens.WORD_BPE), tokens.WordEncoder(tokens.WORD_BPE).ids
    for text in _texts() * 2:
        assert ids(text) == np.array(library.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


@pytest.mark.parametrize("memo", [3, 1_000_000])
def test_word_encoder_forgets(monkeypatch, memo):
    monkeypatch.setattr(tokens, "MEMO_WORDS", memo)
    encoder = tokens.WordEncoder(tokens.WORD_BPE)
    text = "one two three four five, Six! " + "x" * 500
    expected = np.array(encoder.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
    assert [encoder.ids(text) for _ in range(3)] == [expected] * 3


def test_counts_of_whole_texts(spark, sf_dir):
    library = tokens.load(tokens.BYTE_BPE)
    docs = read_table(spark, sf_dir, "documents")
    got = {r.doc_id: r for r in QUERIES["op7_token_counts"](spark, sf_dir).collect()}
    rows = docs.collect()
    assert len(got) == len(rows)
    for r in rows:
        n = len(library.encode(r.text or "", add_special_tokens=False).ids)
        assert got[r.doc_id][1:] == (len((r.text or "").encode()), n, n > 1024)


def test_cache_holds_each_text_once_and_is_used_again(spark):
    cache, docs = scratch_path(spark, "cache"), awkward_documents(spark)
    first = sorted(map(tuple, token_counts.count_tokens(docs, cache=cache).collect()), key=str)
    stored = spark.read.parquet(cache)
    distinct = docs.selectExpr("coalesce(text, '') AS t").distinct().count()
    assert stored.count() == distinct
    # a count changed in the cache shows up: the text is not encoded again
    changed = scratch_path(spark, "changed")
    stored.selectExpr("content", "tokenizer", "n_tokens + 5000 AS n_tokens").write.parquet(changed)
    again = sorted(map(tuple, token_counts.count_tokens(docs, cache=changed).collect()), key=str)
    assert [r[2] + 5000 for r in first] == [r[2] for r in again]
    assert spark.read.parquet(changed).count() == distinct
    # another tokenizer's counts are kept beside them
    token_counts.count_tokens(docs, tokenizer=tokens.WORD_BPE, cache=cache).collect()
    assert spark.read.parquet(cache).count() == 2 * distinct


def test_counts_of_awkward_rows(spark):
    docs = awkward_documents(spark)
    got = token_counts.count_tokens(docs)
    assert got.count() == docs.count()
    assert got.where("doc_id = 2").first()[1:] == (0, 0, False)
    assert token_counts.count_tokens(empty_documents(spark)).count() == 0


def _check_packing(rows, expected, capacity):
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(expected)
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def _pieces(docs, capacity):
    library, out = tokens.load(tokens.WORD_BPE), []
    for r in docs:
        ids = np.array([*library.encode(r.text or "", add_special_tokens=False).ids, 1], dtype="<u4")
        for k, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at : at + capacity]
            out.append((r.doc_id, k, at, len(part), zlib.crc32(part.tobytes())))
    return out


def test_packing_of_whole_table(spark, sf_dir):
    expected = _pieces(read_table(spark, sf_dir, "documents").collect(), 4096)
    used = _check_packing(QUERIES["op3_packing"](spark, sf_dir).collect(), expected, 4096)
    assert used <= -(-sum(p[3] for p in expected) // 4096) + 1


def test_packing_in_several_groups(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    expected = _pieces(docs.collect(), 512)
    rows = pack(docs, capacity=512, group=100).collect()
    used = _check_packing(rows, expected, 512)
    groups = len({r.sequence_id >> 32 for r in rows})
    assert groups >= 3
    assert used <= -(-sum(p[3] for p in expected) // 512) + 2 * groups


def test_packing_of_awkward_rows(spark):
    docs = awkward_documents(spark)
    rows = pack(docs, capacity=100).collect()
    assert len(rows) == token_pieces(docs, 100).count()
    assert [r.length for r in rows if r.doc_id == 2] == [1]
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert all(sum(n for _, n in b) <= 100 for b in bins.values())
    assert pack(empty_documents(spark)).count() == 0


def _bins_hold(bins, lengths, capacity):
    assert sorted(i for b in bins for i in b) == list(range(len(lengths)))
    assert all(sum(lengths[i] for i in b) <= capacity for b in bins)


def test_local_search_empties_bins_that_best_fit_leaves():
    # best fit takes 4 bins; moves and exchanges make it 3
    lengths = np.array([6, 5, 5, 4, 4, 3, 3])
    bins = best_fit(lengths, 10)
    better = empty_bins(bins, lengths, 10)
    _bins_hold(better, lengths, 10)
    assert len(better) == 3
    worse = [[0], [1, 3], [2, 4], [5], [6]]
    assert len(empty_bins(worse, lengths, 10)) == 3


def test_local_search_never_worsens():
    draw = np.random.default_rng(3)
    for _ in range(60):
        capacity = int(draw.integers(10, 200))
        lengths = draw.integers(1, capacity + 1, int(draw.integers(1, 120)))
        bins = best_fit(lengths, capacity)
        better = empty_bins([list(b) for b in bins], lengths, capacity)
        _bins_hold(better, lengths, capacity)
        assert -(-lengths.sum() // capacity) <= len(better) <= len(bins)
        loose = empty_bins([[i] for i in range(len(lengths))], lengths, capacity)
        _bins_hold(loose, lengths, capacity)


def test_group_size_is_documented():
    assert packing.GROUP >= 4096


@pytest.mark.parametrize("text", [" " * 2_000_000, "\n" * 2_000_000, "a" + " \n\t" * 500_000 + "b", "\u3000" * 300_000, " " * 999 + "x"])
def test_long_white_space_is_counted(text):
    library = tokens.load(tokens.BYTE_BPE)
    assert tokens.counter(tokens.BYTE_BPE).count(text) == len(library.encode(text, add_special_tokens=False).ids)


def test_groups_end_in_common_sequences(spark):
    """Many groups of short documents take no more sequences than one packing of everything, or one more."""
    docs = spark.createDataFrame([(k, "a " * (k % 7)) for k in range(2_000)], "doc_id bigint, text string").repartition(4)
    lengths = sorted(r.length for r in token_pieces(docs, 64).collect())
    least = -(-sum(lengths) // 64)
    for group in (100, 300, 5_000):
        placed = pack(docs, 64, group=group).collect()
        _check_packing(placed, _pieces(docs.collect(), 64), 64)
        assert len({r.sequence_id for r in placed}) <= least + 1


def test_search_looks_at_every_exchange():
    """Two for one and one for two among the shortest of many documents of a bin."""
    lengths = np.array([50 + k for k in range(30)] + [1] * 40 + [33, 34, 67], dtype=np.int64)
    for seed in range(20):
        order = np.random.default_rng(seed).permutation(len(lengths))
        bins, room, now = [], 200, []
        for i in order.tolist():  # first come, first packed: many underfull bins
            if lengths[i] > room:
                bins, room, now = [*bins, now], 200, []
            now.append(i)
            room -= int(lengths[i])
        bins.append(now)
        found = empty_bins(bins, lengths, 200)
        assert sorted(i for b in found for i in b) == list(range(len(lengths)))
        assert all(sum(lengths[i] for i in b) <= 200 for b in found) and len(found) <= len(bins)
        assert len(found) == -(-int(lengths.sum()) // 200)
