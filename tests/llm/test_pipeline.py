import os

import pytest

from tidelog.llm.common import written

corpus_pipeline = pytest.importorskip("corpus_pipeline")
SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_stages(spark, model):
    """Stage by stage: what goes, what stays, what comes again."""
    from tidelog.llm import dedup, mixing, quality, spm

    raw = spark.read.parquet(f"{SF}/documents.parquet")
    columns = raw.columns
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 4
    docs, seen = raw, []
    for _, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF), "test-stage")
        seen.append(docs)
    good, single, mixed, encoded = seen
    model_ = quality.train(raw, spark.read.parquet(f"{SF}/labels.parquet"))
    accepted = {r.doc_id for r in quality.score_documents(raw, model_).where("predicted = 1").collect()}
    assert {r.doc_id for r in good.collect()} == accepted and good.columns == columns
    classes = {r.class_id for r in dedup.near_duplicates(good).collect()}
    assert {r.doc_id for r in single.collect()} == classes and single.count() == len(classes)
    copies = {r.doc_id: r.copies for r in mixing.mix_sources(single).collect() if r.copies}
    got = {}
    for r in mixed.collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + 1
    assert got == copies and mixed.columns == columns
    e = spm.encoder_of(model)
    texts = {r.doc_id: r.text for r in mixed.collect()}
    assert all(r.ids == e.encode(texts[r.doc_id]) for r in encoded.collect()) and encoded.count() == mixed.count()


def test_empty_stages(spark, none):
    for _, stage in corpus_pipeline.STAGES[1:]:
        assert stage(spark, none, "unused").count() == 0
