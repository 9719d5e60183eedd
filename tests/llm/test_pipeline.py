import corpus_pipeline
import pyarrow as pa
import pytest

import __spark_entry__ as entry_points
from siteledger.llm import quality
from siteledger.llm.common import read_table
from siteledger.llm.mixing import mix
from siteledger.llm.packing import token_pieces
from siteledger.llm.quality import score_quality
from siteledger.llm.tokens import WORD_BPE, word_encoder
from tests.llm.helpers import awkward_documents, empty_documents, words
from tests.llm.test_simhash import plain as fingerprint
from tests.llm.test_substring import plain as without_repeats
from tests.llm.test_tokens import _check_packing, _pieces


def test_queries_are_registered():
    names = entry_points.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14))


def test_stages_against_plain_versions(spark, sf_dir):
    stages = dict(corpus_pipeline.STAGES)
    docs = read_table(spark, sf_dir, "documents")
    keep = {r.doc_id for r in score_quality(docs).where("keep").collect()}
    good = stages["quality"](spark, docs, sf_dir).cache()
    assert {r.doc_id for r in good.collect()} == keep and good.columns == docs.columns

    single = stages["near_dedup"](spark, good, sf_dir).cache()
    prints = sorted((r.doc_id, fingerprint(r.text)) for r in good.collect())
    group: dict[int, int] = {}
    for d, p in prints:  # smallest reachable, by flooding
        if d not in group:
            todo, group[d] = [p], d
            while todo:
                q = todo.pop()
                for e, r in prints:
                    if e not in group and (q ^ r).bit_count() <= 2:
                        group[e] = d
                        todo.append(r)
    assert {r.doc_id for r in single.collect()} == set(group.values())

    clean = stages["substring_dedup"](spark, single, sf_dir).cache()
    expected = without_repeats([(r.doc_id, r.text) for r in single.collect()], 50)
    got = {r.doc_id: r.text for r in clean.collect()}
    assert {d: words(t) for d, t in got.items()} == {d: kept for d, (n, kept) in expected.items() if kept or not n}

    mixed = stages["mixing"](spark, clean, sf_dir).cache()
    copies = {r.doc_id: r.copies for r in mix(clean).collect()}
    assert mixed.columns == docs.columns and mixed.count() == sum(copies.values())

    packed = stages["packing"](spark, mixed, sf_dir).collect()
    _check_packing(packed, _pieces(mixed.collect(), 4096), 4096)


def test_run(spark, sf_dir):
    first = corpus_pipeline.run(spark, sf_dir)
    assert first.columns[:3] == ["doc_id", "piece", "start"] and first.count() > 100


@pytest.mark.parametrize("make", [awkward_documents, empty_documents])
def test_stages_on_awkward_rows(spark, make):
    docs = make(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "")
        assert docs.columns == make(spark).columns
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() >= 0


def test_workers_keep_the_memo_of_one_operator(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").repartition(16)
    score_quality(docs).count()
    token_pieces(docs, 4096).count()

    def held(batches):
        sizes = len(quality._features()), len(word_encoder(WORD_BPE).memo)
        yield from (pa.RecordBatch.from_arrays([pa.array([n], pa.int64()) for n in sizes], ["features", "words"]) for b in batches if b.num_rows)

    found = spark.range(0, 64, 1, 64).mapInArrow(held, "features bigint, words bigint").collect()
    assert any(r.words for r in found) and not any(r.features and r.words for r in found)
