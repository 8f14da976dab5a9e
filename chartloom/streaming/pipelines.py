"""Streaming runs; every one stops by itself unless its settings are continuous."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chartloom.config import StreamSettings
from chartloom.operators.entities import extract_by_rules
from chartloom.operators.measures import monitor
from chartloom.operators.parse import parse_documents
from chartloom.plans.silver import Extract, extracted_entities, with_quarantine
from chartloom.schemas import PARSED_DOCUMENTS
from chartloom.sources.files import list_documents, listing_for, stream_documents, stream_table
from chartloom.sources.tables import COMPACT, beside_stream, run_batches, run_stream


def ingest(
    spark: SparkSession,
    source: str,
    bronze: str,
    checkpoint: str,
    glob: str = "*.pdf",
    parser="html",
    settings: StreamSettings = StreamSettings(),
) -> StreamingQuery:
    """New files to parsed documents, appended to the bronze folder.

    Executors list the folder and open its files where they can; the driver then holds parts of the
    listing, which lies with the checkpoint, and no files.
    """
    most = settings.max_files_per_trigger
    listing = listing_for(spark, source, checkpoint)
    look = partial(list_documents, spark, source, glob, listing, most)
    if listing is not None:
        look()
    files = stream_documents(spark, source, glob, most, listing)
    query = run_stream(
        parse_documents(files, parser), checkpoint, path=bronze, settings=settings, **COMPACT)
    if listing is not None and settings.continuous:
        beside_stream(spark, query, look, settings)
    return query


def first_arrivals(
    rows: DataFrame, key: str = "document_id", ts: str = "arrived", delay: str = "1 day"
) -> DataFrame:
    """Rows of a stream whose key did not come before, within the delay.

    Keys are kept as state until the watermark has passed them, whichever micro-batch they came
    in, so nothing is joined with the target and state does not grow with it.
    """
    return rows.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def refine(
    spark: SparkSession,
    bronze: str,
    silver: str,
    checkpoint: str,
    extract: Extract = extract_by_rules,
    observation: str | None = "expectations",
    settings: StreamSettings = StreamSettings(),
) -> StreamingQuery:
    """New parsed documents to extracted entities, appended to the silver folder.

    With an ``observation`` name the query's progress carries the rule counts.
    """
    parsed = stream_table(spark, bronze, PARSED_DOCUMENTS)
    kept = extracted_entities(parsed, extract, observation=observation)
    return run_stream(kept, checkpoint, path=silver, settings=settings)


def refine_with_quarantine(
    spark: SparkSession,
    bronze: str,
    silver: str,
    checkpoint: str,
    extract: Extract = extract_by_rules,
    settings: StreamSettings = StreamSettings(),
) -> StreamingQuery:
    """The same, with dropped rows kept under ``kept=false`` of the same folder.

    Each micro-batch is computed and written once, into a folder of its own, so a
    replay replaces itself.
    """
    parsed = stream_table(spark, bronze, PARSED_DOCUMENTS)
    marked = with_quarantine(parsed, extract)
    return run_batches(marked, checkpoint, silver, "kept", settings=settings)


def watch(
    scores: DataFrame,
    path: str,
    checkpoint: str,
    granularity: str = "1 hour",
    ts: str = "ts",
    delay: str = "10 minutes",
    settings: StreamSettings = StreamSettings(),
) -> StreamingQuery:
    """Monitoring figures per window, appended whenever a micro-batch changes them.

    So the windows behind the last watermark are there too when a bounded run ends;
    :func:`watched` reads the newest figures of each window.
    """
    timed = scores.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)
    return run_batches(
        monitor(timed, granularity, ts), checkpoint, path, settings=settings, output_mode="update")


def watched(spark: SparkSession, path: str) -> DataFrame:
    """The newest figures of each window that :func:`watch` has written."""
    rows = spark.read.parquet(path)
    figures = [c for c in rows.columns if c not in ("window_start", "batch_id")]
    newest = F.max_by(F.struct(*figures), "batch_id").alias("newest")
    return rows.groupBy("window_start").agg(newest).select("window_start", "newest.*")
