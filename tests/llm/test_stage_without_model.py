"""The quality stage without a model."""

import corpus_pipeline
from cobasket.llm import quality
from .conftest import TEXTS


def test_nothing_is_rejected_without_a_model(spark, docs):
    marks = spark.createDataFrame([(i, 1, 0) for i in range(len(TEXTS))], "doc_id long, quality int, toxic int")
    for labels in (marks, marks.limit(0)):
        assert {r.doc_id for r in quality.keep_good(docs, labels).collect()} == set(range(len(TEXTS)))


def test_stage_without_labels(spark, docs, monkeypatch):
    monkeypatch.setattr(corpus_pipeline, "read", lambda *_: spark.createDataFrame([], "doc_id long, quality int"))
    assert corpus_pipeline.good(spark, docs, "").count() == len(TEXTS)
