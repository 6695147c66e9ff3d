"""The pipeline's stages in turn, on a small real table."""

import corpus_pipeline
from panelspark.llm import jaccard, substrings
from tests.conftest import SF001


def test_stages_keep_columns_and_take_effect(spark, tmp_path):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    seen = []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        stage(spark, docs, SF001).write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        seen.append((name, before, docs))
        if i < 4:
            assert docs.columns == spark.read.parquet(f"{SF001}/documents.parquet").columns and docs.count() <= before.count()
    near = seen[1][2]
    assert near.count() == jaccard.near_components(seen[1][1]).where("doc_id = component_id").count()
    again = substrings.dedup(seen[2][2])
    assert again.agg({"n_removed": "sum"}).first()[0] == 0
    assert {r.doc_id for r in docs.select("doc_id").distinct().collect()} == {r.doc_id for r in seen[3][2].select("doc_id").collect()}
    assert corpus_pipeline.run(spark, SF001).count() == docs.count()


def test_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13 and "pipeline" in names
    assert {"op2_benchmark_decontamination", "op8_url_filter", "op9_substring_dedup", "op10_jaccard_join", "op11_sharding"} <= entry.oracle_sql().keys()
