"""The pipeline against its stages' brute-force rules on the small tables."""

import corpus_pipeline
from chartloom.llm import toxicity
from tests.llm.test_copies import near_brute

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    chain = toxicity.learn(docs, labels)
    bad = {r.doc_id for r in toxicity.score(docs, chain).collect() if r.p_toxic >= toxicity.THRESHOLD}
    rows = {r.doc_id: r.text for r in docs.collect() if r.doc_id not in bad}
    rows = {max(d for d, u in rows.items() if u == t): t for t in set(rows.values())}
    rows = {d: rows[d] for d, _, _, kept in near_brute(list(rows.items())) if kept}
    plain = lambda t: " ".join(x.strip(".,!*$%&#").lower() for x in t.split())
    items = [plain(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = {d: t for d, t in rows.items() if not any(i in plain(t) for i in items)}
    got = corpus_pipeline.run(spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(rows)


def test_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, SF)
        assert kept.dtypes == docs.dtypes, name
    assert len(corpus_pipeline.STAGES) == 5


def test_empty(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF) if stage is not corpus_pipeline.tokens else docs
    assert docs.count() == 0
