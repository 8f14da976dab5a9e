"""Monitoring, run metrics, vector search, streams and stored tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.functions.text import word_count
from chartloom.operators import measures as ms
from chartloom.operators import review as rv
from chartloom.operators.search import vector_topk
from chartloom.queries import entities as ent
from chartloom.queries.inputs import table, texts
from chartloom.schemas import PARSED_DOCUMENTS, STATUS_LOG
from chartloom.sources.files import stream_table
from chartloom.sources.tables import append_batch, conform, fresh_dir
from chartloom.streaming import pipelines


def _scores(df: DataFrame) -> DataFrame:
    """Events as scored documents; some scores are not numbers."""
    n = F.col("event_id")
    return df.select(
        F.col("ts"),
        F.when(n % 23 == 0, "n/a").otherwise(F.concat(F.lit("0."), (n % 10).cast("string")))
        .alias("overall_score"),
        F.when(n % 29 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("0."), (n % 5 + 5).cast("string")))
        .alias("soap_quality_score"),
        (F.col("event_type") == "error").alias("requires_review"),
    )


def _shown(figures: DataFrame, *extra: str) -> DataFrame:
    return figures.select(
        F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), *extra,
        "documents",
        F.round("avg_validation_score", 6).alias("avg_validation_score"),
        F.round("high_quality_rate", 6).alias("high_quality_rate"),
    )


def monitor_hourly(spark, sf):
    return _shown(ms.monitor(_scores(table(spark, sf, "events")), "1 hour"))


def monitor_daily(spark, sf):
    return _shown(ms.monitor(_scores(table(spark, sf, "events")), "1 day"))


def monitor_slices(spark, sf):
    slices = ("overall_score", "soap_quality_score", "requires_review")
    figures = ms.monitor_slices(_scores(table(spark, sf, "events")), slices)
    return _shown(figures, "slice", *slices)


def latency_seconds(spark, sf):
    ingested = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("document_id"), F.col("o_orderdate").alias("ingestion_timestamp"))
    generated = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("document_id"), F.col("l_shipdate").alias("generation_timestamp"))
    return ms.latency_seconds(ingested, generated).select(
        "document_id", "processing_latency_seconds")


def recent_summaries(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus")
    return ms.newest(orders, "o_orderdate", "o_orderkey").select(
        "o_orderkey", "o_orderstatus", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))


def _runs(spark, sf) -> DataFrame:
    docs = texts(spark, sf, "documents", "doc_id", "text").withColumnRenamed("doc_id", "document_id")
    measured = ms.run_metrics(
        docs, "extraction",
        {"text_length": F.length("text"), "word_count": word_count(F.col("text"))},
        F.timestamp_seconds(F.col("document_id") * 60),
    )
    events = table(spark, sf, "events").withColumnRenamed("event_id", "document_id")
    scored = ms.run_metrics(
        events, "ambiguity_detection", {"processing_time_seconds": F.col("value")},
        F.col("ts").cast("timestamp"),
    )
    return rv.union_all(measured, scored)


def run_metrics_summary(spark, sf):
    return ms.stage_summary(_runs(spark, sf)).select(
        "stage", "metric", "documents", F.round("mean", 4).alias("mean"), "lowest", "highest")


def recent_runs(spark, sf):
    runs = _runs(spark, sf).filter(F.col("stage") == "ambiguity_detection")
    return ms.newest(runs, "start_time", "document_id").select(
        "document_id", "stage", "metric", "value")


def nearest_vectors(spark, sf):
    """The ten nearest of all vectors to one prototype per label."""
    vectors = table(spark, sf, "embeddings")
    prototypes = vectors.groupBy("label").agg(F.min_by("embedding", "vec_id").alias("query"))
    found = vector_topk(
        vectors, prototypes.withColumnRenamed("label", "query_id"), 10
    )
    return found.select(
        "query_id", "vec_id", "score", F.col("rank").cast("bigint").alias("rank"),
    )


def stream_monitor(spark, sf):
    """Hourly figures from a stream of the events."""
    events = stream_table(spark, f"{sf}/events.parquet", table(spark, sf, "events").schema)
    out = fresh_dir(spark, "monitor")
    pipelines.watch(_scores(events), out, fresh_dir(spark, "monitor-state")).awaitTermination()
    return _shown(pipelines.watched(spark, out))


def stream_refine(spark, sf):
    """Bronze to silver as a stream, dropped rows beside the kept ones."""
    bronze, silver = fresh_dir(spark, "bronze"), fresh_dir(spark, "silver")
    parsed = ent.documents_as_parsed(spark, sf)
    missing = [f for f in PARSED_DOCUMENTS.fields if f.name not in parsed.columns]
    full = parsed.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing})
    conform(full, PARSED_DOCUMENTS).write.parquet(bronze)
    pipelines.refine_with_quarantine(
        spark, bronze, silver, fresh_dir(spark, "silver-state"), ent.odd_extraction
    ).awaitTermination()
    rows = spark.read.parquet(silver)
    return rows.select(
        "document_id", "path", "extracted_entities", F.col("kept").cast("boolean").alias("kept"),
        F.array_join("failed_rules", ";").alias("failed_rules"),
    )


def appended_status(spark, sf):
    """Status rows appended in two batches, the second one written twice."""
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("document_id"), "o_orderdate", "o_orderstatus")
    log = fresh_dir(spark, "status")
    day = F.col("o_orderdate").cast("timestamp")
    waiting = conform(orders.select(
        "document_id", F.lit(rv.QUEUED).alias("status"), day.alias("updated_timestamp")), STATUS_LOG)
    done = conform(orders.filter(F.col("o_orderstatus") == "F").select(
        "document_id", F.lit(rv.COMPLETED).alias("status"),
        (day + F.expr("INTERVAL 1 DAY")).alias("updated_timestamp")), STATUS_LOG)
    append_batch(waiting, log, 0)
    append_batch(done, log, 1)
    append_batch(done, log, 1)
    stored = spark.read.parquet(log)
    newest = rv.latest_status(stored)
    return newest.groupBy("status").agg(F.count(F.lit(1)).alias("documents"))


QUERIES: dict[str, Callable] = {
    fn.__name__: fn
    for fn in (
        monitor_hourly, monitor_daily, monitor_slices, latency_seconds, recent_summaries,
        run_metrics_summary, recent_runs, nearest_vectors, stream_monitor, stream_refine,
        appended_status,
    )
}

_SCORES = """
s AS (
  SELECT ts, CASE WHEN event_id % 23 = 0 THEN 'n/a' ELSE '0.' || event_id % 10 END AS overall_score,
    CASE WHEN event_id % 29 <> 0 THEN '0.' || (event_id % 5 + 5) END AS soap_quality_score,
    event_type = 'error' AS requires_review FROM events
)"""
_FIGURES = """
  count(*) AS documents, round(avg(TRY_CAST(overall_score AS DOUBLE)), 6) AS avg_validation_score,
  round(sum(CASE WHEN TRY_CAST(soap_quality_score AS DOUBLE) >= 0.8::DOUBLE THEN 1 ELSE 0 END)
    / count(*), 6) AS high_quality_rate"""


def _monitor_sql(unit: str) -> str:
    return f"""
WITH {_SCORES}
SELECT strftime(date_trunc('{unit}', ts), '%Y-%m-%d %H:%M:%S') AS window_start, {_FIGURES}
FROM s GROUP BY date_trunc('{unit}', ts)"""


ORACLES: dict[str, str] = {
    "monitor_hourly": _monitor_sql("hour"),
    "monitor_daily": _monitor_sql("day"),
    "monitor_slices": f"""
WITH {_SCORES}, d AS (SELECT *, date_trunc('day', ts) AS w FROM s)
SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start,
  CASE WHEN grouping(requires_review) = 0 THEN 'requires_review'
    WHEN grouping(soap_quality_score) = 0 THEN 'soap_quality_score'
    WHEN grouping(overall_score) = 0 THEN 'overall_score' ELSE 'all' END AS slice,
  overall_score, soap_quality_score, requires_review, {_FIGURES}
FROM d GROUP BY GROUPING SETS ((w), (w, overall_score), (w, soap_quality_score),
  (w, requires_review))""",
    "latency_seconds": """
SELECT o_orderkey AS document_id, datediff('second', o_orderdate, last) AS processing_latency_seconds
FROM orders JOIN (SELECT l_orderkey, max(l_shipdate) AS last FROM lineitem GROUP BY l_orderkey)
  ON o_orderkey = l_orderkey""",
    "recent_summaries": """
SELECT o_orderkey, o_orderstatus, strftime(o_orderdate, '%Y-%m-%d') AS day
FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 10""",
    "run_metrics_summary": r"""
WITH r AS (
  SELECT 'extraction' AS stage, 'text_length' AS metric, length(text)::DOUBLE AS v FROM documents
  UNION ALL
  SELECT 'extraction', 'word_count', len(regexp_extract_all(text,
    '[^\s\x{b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+'
  ))::DOUBLE FROM documents
  UNION ALL
  SELECT 'ambiguity_detection', 'processing_time_seconds', value FROM events
)
SELECT stage, metric, count(v) AS documents, round(avg(v), 4) AS mean, min(v) AS lowest,
  max(v) AS highest FROM r GROUP BY stage, metric""",
    "recent_runs": """
SELECT event_id AS document_id, 'ambiguity_detection' AS stage,
  'processing_time_seconds' AS metric, value
FROM events ORDER BY ts DESC, event_id LIMIT 10""",
    "nearest_vectors": """
WITH q AS (
  SELECT label, arg_min(embedding, vec_id)::DOUBLE[] AS query FROM embeddings GROUP BY label
), s AS (
  SELECT q.label, vec_id, round(list_cosine_similarity(embedding::DOUBLE[], query), 6) AS score
  FROM embeddings, q
), r AS (
  SELECT *, row_number() OVER (PARTITION BY label ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT label AS query_id, vec_id, score, rank FROM r WHERE rank <= 10""",
    "stream_monitor": f"""
WITH {_SCORES}
SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start, {_FIGURES}
FROM s GROUP BY date_trunc('hour', ts)""",
    "stream_refine": f"""
WITH {ent.ODD}
SELECT doc_id::VARCHAR AS document_id, source AS path, x AS extracted_entities,
  x IS NOT NULL AND json_extract_string(x, '$.error') IS NULL AS kept,
  CASE WHEN x IS NULL THEN 'has_entities'
    WHEN json_extract_string(x, '$.error') IS NOT NULL THEN 'no_extraction_errors'
    ELSE '' END AS failed_rules
FROM odd""",
    "appended_status": """
SELECT CASE WHEN o_orderstatus = 'F' THEN 'completed' ELSE 'pending_review' END AS status,
  count(*) AS documents FROM orders GROUP BY 1""",
}
