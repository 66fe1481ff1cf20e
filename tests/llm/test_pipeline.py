"""The document pipeline on the smallest table: what each stage keeps, drops and returns."""

from collections import Counter

import corpus_pipeline
from marketspark.llm import line_dedup, mixing, outliers, packing, partenum

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "line_dedup", "ngram_jaccard_join", "source_mix", "best_fit_packing"]
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept[name] = docs
        if name != "best_fit_packing":
            assert docs.dtypes == before.dtypes
    ids = lambda df: [r["doc_id"] for r in df.select("doc_id").collect()]
    first = kept["quality_rules"]
    good = {r["doc_id"] for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").collect()}
    failed = {r["doc_id"] for r in outliers.quality_rules(spark.read.parquet(f"{SF}/documents.parquet")).where("base_failed").collect()}
    assert good - failed <= set(ids(first)) and not failed & set(ids(first))
    second = kept["line_dedup"]
    assert line_dedup.line_verdicts(second).where("NOT kept").count() <= line_dedup.line_verdicts(first).where("NOT kept").count() // 10
    third = kept["ngram_jaccard_join"]
    assert partenum.near_duplicates(third, 5, 80).where("doc_id <> component_id").count() == 0
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix_documents(third).collect()}
    assert Counter(ids(kept["source_mix"])) == Counter({i: c for i, c in copies.items() if c})
    encode = packing.encoder()
    want = Counter((r["doc_id"], encode.ids(r["text"]) + b"\0" * 4) for r in kept["source_mix"].collect())
    got = Counter()
    for r in docs.collect():
        got[r["doc_id"]] += r["length"]
    assert got == Counter({i: sum(len(b) // 4 * n for (j, b), n in want.items() if j == i) for i in {k[0] for k in want}})


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0 and corpus_pipeline.ORACLE_SQL is None
