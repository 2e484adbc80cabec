"""The pipeline's stages, and the registered queries against their SQL."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from check import compare, connect
from watchfold.llm import decontaminate, mixing, near_dups, toxicity

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", ["op2_near_duplicates", "op7_line_dedup", "op10_decontamination"])
def test_queries_agree_with_sql(spark, duck, name):
    assert compare(spark, duck, SF, name).startswith("ok")


def test_thirteen_operators_and_the_pipeline_are_registered():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries()


def test_each_stage_works_on_all_that_the_one_before_kept(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{k}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/{k}")
        kept.append((name, before, docs))
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
    ids = [{r[0] for r in d.select("doc_id").collect()} for _, _, d in kept]
    given = [{r[0] for r in b.select("doc_id").collect()} for _, b, _ in kept]

    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scores = toxicity.score(kept[0][1], toxicity.fit(kept[0][1], labels))
    assert ids[0] == {r[0] for r in scores.filter("score < 0.5").collect()}
    assert ids[1] == {r[0] for r in near_dups.near_duplicates(kept[1][1]).filter("kept").collect()}
    hits = decontaminate.scan(kept[2][1], spark.read.parquet(f"{SF}/benchmark.parquet"))
    assert ids[2] == given[2] - {r[0] for r in hits.filter(F.size("spans") > 0).collect()}
    copies = {r["doc_id"]: round(r["taken"] / r["size"]) for r in mixing.mix(kept[3][1]).collect() if r["size"]}
    found = {r["doc_id"]: r["count"] for r in kept[3][2].groupBy("doc_id").count().collect()}
    assert all(abs(copies.get(i, 0) - found.get(i, 0)) <= 1 for i in given[3])
    assert sum(copies.get(i, 0) != found.get(i, 0) for i in given[3]) <= 40
    sizes = [r["count"] for r in kept[4][2].groupBy("shard").count().collect()]
    assert sum(sizes) == kept[3][2].count() and max(sizes) - min(sizes) <= 1
