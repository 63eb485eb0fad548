"""The queries against their SQL, and the pipeline stage by stage."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from __spark_entry__ import SMALL, oracle_sql, queries
from adlake.llm.queries import ORACLES, QUERIES, table
from checks.compare import difference, oracle_connection


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_agrees_with_sql(spark, name):
    assert name in oracle_sql()
    assert difference(spark, oracle_connection(SMALL), name, SMALL) is None


def test_all_are_registered():
    assert {name.split("_")[0] for name in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(queries())


def test_stages(spark, tmp_path):
    docs = table(spark, SMALL, "documents")
    extra = spark.createDataFrame([(None, None, None, None, None), (-5, "", "en", None, 0)], docs.schema)
    docs = docs.unionByName(extra)
    outputs = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / name)
        stage(spark, outputs[-1], SMALL).write.parquet(path)
        outputs.append(spark.read.parquet(path))
    _, civil, single, clean, mixed, tokens = outputs
    assert all(df.columns == docs.columns for df in outputs[:-1])
    assert 0.7 * docs.count() < civil.count() <= docs.count()
    from adlake.llm import neardup, secrets

    groups = neardup.near_duplicates(civil)
    assert sorted(r[0] for r in single.where("doc_id IS NOT NULL").select("doc_id").collect()) == sorted(
        r[0] for r in groups.where("kept AND doc_id IS NOT NULL").select("doc_id").distinct().collect()
    )
    assert single.where("doc_id IS NULL").count() == 1
    assert clean.count() == single.count()
    assert secrets.secret_scan(clean).where(F.size("spans") > 0).count() == 0
    assert mixed.join(clean, "doc_id", "left_anti").count() <= mixed.where("doc_id IS NULL").count()
    assert tokens.count() == mixed.count()


def test_empty_documents(spark):
    docs = table(spark, SMALL, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SMALL)
        assert out.count() == 0
