import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from chartloom import schemas
from chartloom.config import StreamSettings
from chartloom.operators.parse import parse_documents
from chartloom.operators.search import vector_topk
from chartloom.plans import silver
from chartloom.sources import files, tables as tb
from chartloom.streaming import pipelines


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("docs")
    for i in range(12):
        body = "".join(f"<p>CHIEF COMPLAINT: case {i} with line {j} of the long note</p>" for j in range(4))
        (root / f"n{i}.html").write_text(f"<h1>Note {i}</h1>{body}")
    (root / "bad.html").write_bytes(b"\xff\xff")
    (root / "skip.txt").write_text("other")
    (root / "deep").mkdir()
    (root / "deep" / "d.html").write_text("<h1>Deep</h1>")
    return str(root)


def test_scan_and_stream_agree(spark, folder, tmp_path):
    scanned = files.scan_documents(spark, folder, "*.html", recursive=False)
    batch = parse_documents(scanned).drop("ingestion_timestamp")
    assert files.scan_documents(spark, folder, "*.html").count() == 14
    bronze = str(tmp_path / "bronze")
    settings = StreamSettings(max_files_per_trigger=5)
    query = pipelines.ingest(spark, folder, bronze, str(tmp_path / "c1"), "*.html", settings=settings)
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 3
    stream = spark.read.schema(schemas.PARSED_DOCUMENTS).parquet(bronze)
    stored = stream.drop("ingestion_timestamp")
    assert stored.count() == 13
    assert batch.exceptAll(stored).count() == 0 and stored.exceptAll(batch).count() == 0

    again = pipelines.ingest(spark, folder, bronze, str(tmp_path / "c1"), "*.html", settings=settings)
    again.awaitTermination()
    assert spark.read.parquet(bronze).count() == 13

    out = str(tmp_path / "silver")
    pipelines.refine(spark, bronze, out, str(tmp_path / "c2")).awaitTermination()
    got = spark.read.parquet(out).drop("extraction_timestamp")
    want = silver.extracted_entities(stream).drop("extraction_timestamp")
    assert got.count() == 12
    assert got.exceptAll(want).count() == 0

    kept = str(tmp_path / "quarantine")
    pipelines.refine_with_quarantine(spark, bronze, kept, str(tmp_path / "c3")).awaitTermination()
    assert spark.read.parquet(kept).filter("kept = 'true'").count() == 12


def test_gate_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "parsed")
    spark.createDataFrame([], schemas.PARSED_DOCUMENTS).write.parquet(path)
    plan = silver.extracted_entities(spark.read.parquet(path))._jdf.queryExecution()
    text = plan.executedPlan().toString()
    assert "GreaterThan(parse_quality_score,0.7)" in text
    assert "tables" not in text.split("ReadSchema")[1]


def test_tables_keep_their_contract(spark):
    name = "gold_zone.status_log"
    tb.drop_table(spark, name)
    tb.create_table(spark, name, schemas.STATUS_LOG, "status of 'documents'")
    tb.create_table(spark, name, schemas.STATUS_LOG)
    now = datetime.datetime(2024, 1, 1)
    rows = spark.createDataFrame([(now, "extra", "a", "pending_review")],
                                 "updated_timestamp timestamp, more string, document_id string, status string")
    tb.append_table(rows, name, schemas.STATUS_LOG)
    tb.append_table(rows, name, schemas.STATUS_LOG)
    stored = spark.table(name)
    assert stored.schema == schemas.STATUS_LOG and stored.count() == 2
    tb.write_table(rows, name)
    assert spark.table(name).columns == rows.columns and spark.table(name).count() == 1
    tb.drop_table(spark, name)
    assert not spark.catalog.tableExists(name)


def test_gold_contracts():
    queue = schemas.with_identity(schemas.REVIEW_QUEUE)
    assert queue.fieldNames()[:4] == ["mrn", "patient_name", "visit_date", "document_id"]
    assert len(queue) == 12 and len(schemas.with_identity(schemas.CLINICAL_SUMMARIES)) == 12
    assert len(schemas.with_identity(schemas.VALIDATED_ENTITIES)) == 9


def test_replayed_batch_replaces_itself(spark, tmp_path):
    path = str(tmp_path / "log")
    df = spark.range(5)
    tb.append_batch(df, path, 0)
    tb.append_batch(df, path, 1)
    tb.append_batch(df, path, 1)
    assert spark.read.parquet(path).count() == 10


def test_shared_folder_comes_from_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    first, second = tb.fresh_dir(spark, "x"), tb.fresh_dir(spark, "x")
    assert first != second and first.rsplit("/", 1)[0] == second.rsplit("/", 1)[0]
    assert named is None or first.startswith(named)


@pytest.mark.parametrize("block_bytes", [1 << 25, 8 * 8 * 3])
def test_vector_topk_is_exact(spark, block_bytes):
    rng = np.random.default_rng(5)
    vectors = np.concatenate([rng.normal(size=(150, 8)), np.repeat(rng.normal(size=(1, 8)), 75, 0)])
    queries = rng.normal(size=(7, 8))
    corpus = spark.createDataFrame(
        [(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>").repartition(6)
    asked = spark.createDataFrame([(i, q.tolist()) for i, q in enumerate(queries)],
                                  "query_id long, query array<double>")
    got = {}
    for r in vector_topk(corpus, asked, 5, block_bytes=block_bytes).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = r.vec_id
    v = vectors.astype(np.float32).astype(np.float64)
    scores = np.round((queries / np.linalg.norm(queries, axis=1, keepdims=True))
                      @ (v / np.linalg.norm(v, axis=1, keepdims=True)).T, 6)
    for q in range(7):
        want = np.lexsort((np.arange(len(v)), -scores[q]))[:5]
        assert [got[q][r] for r in range(1, 6)] == want.tolist()
