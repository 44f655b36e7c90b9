import __spark_entry__
import corpus_pipeline
from opinara.llm import jaccard_join, secret_scan, toxicity


def test_stages_take_effect_and_keep_columns(spark, tmp_path):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    made = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{name}")
        made[name] = docs = spark.read.parquet(f"{tmp_path}/{name}")
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    assert 0 < made["near_duplicates"].count() <= made["toxicity"].count() <= 200
    again = jaccard_join.join(made["near_duplicates"]).where("n_shingles > 0")
    assert again.where("doc_id != component_id").count() == 0
    assert made["secrets"].count() == made["near_duplicates"].count()
    assert sum(len(r.spans) for r in secret_scan.scan(made["secrets"]).collect()) == 0
    words = lambda df: sum(len(r.text.split()) for r in df.collect())
    assert 1.4 * words(made["secrets"]) <= words(made["mixture"]) <= 1.5 * words(made["secrets"])
    assert made["byte_bpe"].count() == made["mixture"].count()


def test_registered():
    names = __spark_entry__.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
    assert set(__spark_entry__.oracle_sql()) <= set(names)
    assert 0 < toxicity.THRESHOLD < 1
