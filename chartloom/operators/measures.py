"""Counts, monitoring and run metrics: aggregates that combine before the shuffle."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Sequence
from typing import TypeVar

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chartloom.config import HIGH_SOAP_QUALITY
from chartloom.operators import unnest

T = TypeVar("T")


def extraction_stats(df: DataFrame, entities: str = "entities") -> DataFrame:
    """Documents per (has_error, confidence)."""
    doc = F.col(entities)
    return (
        df.select(
            F.get_json_object(doc, "$.error").isNotNull().alias("has_error"),
            F.get_json_object(doc, "$.extraction_confidence").alias("confidence"),
        )
        .groupBy("has_error", "confidence")
        .count()
    )


def confidence_totals(df: DataFrame, entities: str = "entities") -> DataFrame:
    """Total and per-confidence counts; the sums are null for an empty input."""
    level = F.get_json_object(F.col(entities), "$.extraction_confidence")
    return df.select(level.alias("level")).agg(
        F.count(F.lit(1)).alias("total_documents"),
        *[
            F.sum(F.when(F.col("level") == name, 1).otherwise(0)).alias(f"{name}_confidence")
            for name in ("high", "medium", "low")
        ],
    )


def success_counts(df: DataFrame, entities: str = "entities") -> DataFrame:
    """Total, successful and failed documents in one pass."""
    ok = F.get_json_object(F.col(entities), "$.error").isNull()
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(ok).alias("successful"),
        F.count_if(~ok).alias("failed"),
    )


def status_tally(df: DataFrame, status: str = "status") -> DataFrame:
    return df.groupBy(status).count()


def latency_seconds(
    ingested: DataFrame, generated: DataFrame, key: str = "document_id"
) -> DataFrame:
    """Seconds from ingestion to the newest note, per document.

    Each side shrinks to one row per document before the join, so a document with very
    many rows meets the join as one row.
    """
    first = ingested.groupBy(key).agg(F.min("ingestion_timestamp").alias("ingestion_timestamp"))
    last = generated.groupBy(key).agg(F.max("generation_timestamp").alias("generation_timestamp"))
    return first.join(last, key).withColumn(
        "processing_latency_seconds",
        F.timestamp_diff("SECOND", F.col("ingestion_timestamp"), F.col("generation_timestamp")),
    )


def _monitor_columns() -> list[Column]:
    soap = F.col("soap_quality_score").try_cast("double")
    return [
        F.count(F.lit(1)).alias("documents"),
        F.avg(F.col("overall_score").try_cast("double")).alias("avg_validation_score"),
        (
            F.sum(F.when(soap >= HIGH_SOAP_QUALITY, 1).otherwise(0)) / F.count(F.lit(1))
        ).alias("high_quality_rate"),
    ]


def monitor(scores: DataFrame, granularity: str = "1 hour", ts: str = "ts") -> DataFrame:
    """Monitoring figures per time window: ``window_start`` and the figures.

    The same function serves a batch and a watermarked stream.
    """
    return (
        scores.groupBy(F.window(ts, granularity).alias("w"))
        .agg(*_monitor_columns())
        .select(F.col("w.start").alias("window_start"), "documents",
                "avg_validation_score", "high_quality_rate")
    )


def monitor_slices(
    scores: DataFrame, slices: Sequence[str], granularity: str = "1 day", ts: str = "ts"
) -> DataFrame:
    """Monitoring figures per window, overall and by each slicing column by itself."""
    windowed = scores.withColumn("window_start", F.window(ts, granularity)["start"])
    sets = [[F.col("window_start")]] + [[F.col("window_start"), F.col(s)] for s in slices]
    keys = [F.col("window_start"), *map(F.col, slices)]
    which = F.lit("all")
    for name in slices:
        which = F.when(F.grouping(name) == 0, F.lit(name)).otherwise(which)
    return windowed.groupingSets(sets, *keys).agg(
        *_monitor_columns(), which.alias("slice")
    )


def newest(df: DataFrame, ts: str, tie: str, limit: int = 10) -> DataFrame:
    """Newest rows; equal times are settled by the second column."""
    return df.orderBy(F.desc(ts), F.asc(tie)).limit(limit)


def first_rows(df: DataFrame, *order: str, limit: int) -> DataFrame:
    return df.orderBy(*order).limit(limit)


def run_metrics(df: DataFrame, stage: str, metrics: dict[str, Column], start: Column) -> DataFrame:
    """Long table of metrics: one row per document, stage and metric."""
    pairs = F.array(
        *[F.struct(F.lit(n).alias("metric"), v.cast("double").alias("value"))
          for n, v in metrics.items()]
    )
    timed = df.withColumn("start_time", start)
    return unnest(timed, pairs, "document_id", "start_time", item="m").select(
        "document_id", F.lit(stage).alias("stage"), "m.metric", "m.value", "start_time"
    )


def observed(df: DataFrame, stage: str, run: Callable[[DataFrame], T], **counts: Column) -> tuple[T, list[tuple]]:
    """Run an action and measure it in the same pass: its result and ``(stage, metric, value)``.

    ``run`` takes the frame and does all the work (a write, say); ``counts`` are aggregates that are
    gathered while it does, next to the number of rows and the seconds it took.
    """
    watcher = Observation(f"{stage}-{uuid.uuid4().hex}")
    started = time.monotonic()
    done = run(df.observe(watcher, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in counts.items()]))
    seconds = time.monotonic() - started
    values = {**watcher.get, "seconds": seconds}
    return done, [(stage, name, None if v is None else float(v)) for name, v in values.items()]


def progress_metrics(query: StreamingQuery, stage: str) -> list[tuple]:
    """``(stage, metric, value)`` of a streaming run, from its own progress reports."""
    reports = query.recentProgress
    milliseconds = sum(r["durationMs"].get("triggerExecution", 0) for r in reports)
    return [(stage, "rows", float(sum(r["numInputRows"] for r in reports))),
            (stage, "batches", float(sum(r["numInputRows"] > 0 for r in reports))),
            (stage, "seconds", milliseconds / 1000)]


def stage_summary(metrics: DataFrame) -> DataFrame:
    """Run metrics per stage and metric."""
    return metrics.groupBy("stage", "metric").agg(
        F.count("value").alias("documents"),
        F.avg("value").alias("mean"),
        F.min("value").alias("lowest"),
        F.max("value").alias("highest"),
    )
