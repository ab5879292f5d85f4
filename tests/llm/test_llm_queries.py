"""The registered queries on the smallest tables, and the pipeline stage by stage."""

import re

import pytest
from test_decontamination import brute as contaminated
from test_near_dedup import brute as near
from test_pii import brute as personal

import corpus_pipeline
from check import compare, connect
from trajloom.llm.common import stored
from trajloom.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, sf, name):
    df = QUERIES[name](spark, sf)
    if name in ORACLES:
        assert compare(df, connect(sf), ORACLES[name]) == ""
    else:
        source = "pages" if "html" in name else "embeddings" if "embedding" in name else "documents"
        assert df.count() >= spark.read.parquet(f"{sf}/{source}.parquet").count()


def test_all_operators_are_registered():
    assert {int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES} == set(range(1, 14))


def test_pipeline(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    tests = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    before, columns = {r.doc_id: r.text for r in docs.collect()}, docs.columns
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stored(stage(spark, docs, sf), "stage")
        rows = docs.collect()
        if k == 4:
            assert {r.doc_id for r in rows} == set(before)
            break
        assert docs.columns == columns
        after = {r.doc_id: r.text for r in rows}
        assert len(after) == len(rows) and set(after) <= set(before)
        if k == 0:
            marks = [(labels[i] == 1) == (i in after) for i in before if i in labels]
            assert sum(marks) / len(marks) > 0.9
        elif k == 1:
            assert set(after) == {i for i, _, _, kept in near(list(before.items()), 5) if kept}
        elif k == 2:
            assert set(after) == {i for i, t in before.items() if not contaminated(t, tests)[4]}
        else:
            assert set(after) == set(before)
            assert all((after[i] == t) or personal(t) for i, t in before.items())
            assert not any(personal(t) for t in after.values())
        before = after


def test_the_quality_stage_keeps_all_where_nothing_can_be_learned(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for k, labels in enumerate(("doc_id < 0", "quality = 1")):
        spark.read.parquet(f"{sf}/labels.parquet").where(labels).write.parquet(f"{tmp_path}/{k}/labels.parquet")
        assert corpus_pipeline.STAGES[0][1](spark, docs, f"{tmp_path}/{k}").count() == docs.count()
