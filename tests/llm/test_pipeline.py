import corpus_pipeline
from postgauge.llm import decontaminate, near_dup, secret_scan


def test_stages_over_a_small_corpus(spark, data, rows):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near duplicates", "decontamination", "secrets", "packing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, data)
        assert after.columns == docs.columns
        docs = corpus_pipeline.materialise(after)
    kept = docs.collect()
    assert 0 < len(kept) < len(rows("documents"))
    assert decontaminate.find_contamination(docs, spark.read.parquet(f"{data}/benchmark.parquet")).where("n_hit > 0").isEmpty()
    assert near_dup.near_duplicates(docs, 80).where("not kept").isEmpty()
    assert secret_scan.scan_secrets(docs).where("size(secrets.spans) > 0").isEmpty()
    assert all(r.n_chars == len(r.text) for r in kept if "<secret>" in r.text)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, data)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == {r.doc_id for r in kept}
