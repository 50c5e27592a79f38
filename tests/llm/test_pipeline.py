import pytest

import __spark_entry__
import corpus_pipeline
from jatoba.llm.queries import QUERIES, SQL
from tests.oracle import SF_DIR, compare, connect


def test_stages_over_a_table(spark, tmp_path):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    given = docs.columns
    counts = [docs.count()]
    for i, (name, function) in enumerate(corpus_pipeline.STAGES):
        function(spark, docs, sf_dir).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if i < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == given
        counts.append(docs.count())
    identified, distinct, cut, mixed, packed = counts[1:]
    assert 0.95 * counts[0] <= identified <= counts[0] and distinct < identified and cut <= distinct and mixed > 0 and packed > mixed
    assert [tuple(r)[:5] for r in corpus_pipeline.run(spark, sf_dir).orderBy("doc_id", "start", "length", "ids_crc32").collect()] == [
        tuple(r)[:5] for r in docs.orderBy("doc_id", "start", "length", "ids_crc32").collect()
    ]


def test_an_empty_table_passes_through(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(0)
    for _, function in corpus_pipeline.STAGES:
        docs = function(spark, docs, "")
        assert docs.collect() == []
        if "ids_crc32" not in docs.columns:
            docs = spark.createDataFrame([], docs.schema)


def test_every_operator_is_registered():
    names = __spark_entry__.queries()
    assert set(QUERIES) <= set(names) and "pipeline" in names and set(SQL) <= set(__spark_entry__.oracle_sql())
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}


@pytest.mark.parametrize("name", list(SQL))
def test_queries_equal_their_sql(spark, name):
    assert compare(spark, connect(SF_DIR), name, QUERIES[name], SQL[name], SF_DIR) > 0
