"""The registered queries against their SQL, and the pipeline against plain Python."""

import pytest

import corpus_pipeline
from meterlake.llm import oracle, packing, quality, queries
from meterlake.llm.shared import table
from tests import compare
from tests.llm.fixtures import documents, texts
from tests.llm.test_dedup import lines_by_hand, near_by_hand
from tests.llm.test_texts import hits_by_hand

FOLDER = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_query(spark, name):
    got, got_names = compare.spark_rows(queries.queries()[name](spark, FOLDER))
    want, want_names = compare.duck_rows(compare.connect(FOLDER), oracle.oracle_sql()[name])
    assert got_names == want_names
    assert got == want


def test_there_is_one_query_for_each_operator():
    numbers = [int(name[2:].split("_")[0]) for name in queries.queries()]
    assert numbers == list(range(1, 14))
    assert set(oracle.oracle_sql()) <= set(queries.queries())


def test_pipeline(spark):
    docs = table(spark, FOLDER, "documents")
    judged = quality.judge(docs, table(spark, FOLDER, "labels")).where("keep").select("rest.*").collect()
    left = [(r.doc_id, r.text) for r in judged]
    left = [(i, t) for i, _, _, t in lines_by_hand(left)]
    left = [(i, dict(left)[i]) for i, n, c in near_by_hand(left) if c == i or not n]
    items = [(r.item_id, r.text) for r in table(spark, FOLDER, "benchmark").collect()]
    clean = []
    for i, t in left:
        n, hit, _ = hits_by_hand(t, items)
        if not (hit and 20 * hit >= n):
            clean.append(i)
    got = corpus_pipeline.run(spark, FOLDER)
    assert got.columns == packing.pack(docs).columns
    assert sorted(r.doc_id for r in got.collect()) == sorted(clean)


def test_stages_keep_the_columns(spark):
    docs = documents(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER)
        assert docs.schema.simpleString() == documents(spark).schema.simpleString()
    assert 0 < docs.count() < len(texts())
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, documents(spark, []), FOLDER).count() == 0
