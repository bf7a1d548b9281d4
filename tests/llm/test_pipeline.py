"""The pipeline stage by stage, and what the registry says about it."""

import corpus_pipeline
import __spark_entry__ as registry
from cobasket.llm import queries
from cobasket.llm.common import read

SF = "/root/testdata/sf0.001"


def test_registry():
    assert {"pipeline", *queries.queries()} <= registry.queries().keys()
    assert len(queries.queries()) == 13 and queries.oracle_sql().keys() <= queries.queries().keys()
    assert len(corpus_pipeline.STAGES) == 5


def test_stages(spark):
    """Each stage keeps columns and some of the rows; stages run one by one give what run() gives."""
    docs = before = read(spark, SF, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, before, SF)
        assert docs.columns == before.columns, name
        assert docs.exceptAll(before).isEmpty() and 0 < docs.count() <= before.count(), name
        before = spark.createDataFrame(docs.collect(), docs.schema)
    last = corpus_pipeline.STAGES[-1][1](spark, before, SF)
    assert sorted(map(tuple, last.collect())) == sorted(map(tuple, corpus_pipeline.run(spark, SF).collect()))


def test_stages_of_nothing(spark):
    docs = read(spark, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0
