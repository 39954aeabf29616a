"""The registered queries and the pipeline on the smallest tables."""

import corpus_pipeline
import pytest
from compare import connect, differences
from debutline.llm.queries import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(SQL))
def test_same_rows_as_sql(spark, name):
    assert differences(spark, FOLDER, QUERIES[name], SQL[name], connect(FOLDER)) == []


@pytest.mark.parametrize("name", [name for name in QUERIES if name not in SQL])
def test_a_row_for_each_row(spark, name):
    given = spark.read.parquet(f"{FOLDER}/{'pages' if name == 'op2_html' else 'documents'}.parquet")
    assert QUERIES[name](spark, FOLDER).count() == given.count()


def test_pipeline(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.cut_lineage(stage(spark, docs, FOLDER), name)
        assert docs.columns == columns and docs.count() > 0
    out = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert out.count() == docs.count()
    starts = [(r["start"], r["n_tokens"]) for r in out.orderBy("start").collect()]
    assert all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:]))
