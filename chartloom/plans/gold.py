"""Entities to notes, with or without a human in between."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from chartloom.config import PipelineSettings
from chartloom.functions.ids import visit_id
from chartloom.functions.jsonval import completeness, is_json, to_json
from chartloom.functions.text import join_notes
from chartloom.operators import review, soap
from chartloom.operators.entities import extract_by_rules, normalise_entities
from chartloom.plans.silver import Extract
from chartloom.schemas import (
    CHANGE,
    CLINICAL_SUMMARIES,
    QUESTIONS_DOC,
    REVIEW_QUEUE,
    STATUS_LOG,
    VALIDATED_ENTITIES,
    with_identity,
)
from chartloom.sources.tables import conform, materialise

IDENTITY = ("mrn", "patient_name", "visit_date")


def _contract(df: DataFrame, plain):
    return with_identity(plain) if set(IDENTITY) <= set(df.columns) else plain


def assessed(documents: DataFrame, settings: PipelineSettings = PipelineSettings()) -> DataFrame:
    """``document_id, text, entities`` to ambiguities, questions and a route.

    A failed extraction (an error document, null, or no JSON object) is not routed: its
    status is ``error``, it gets no question and no note, and its completeness is 0.
    """
    read = normalise_entities(documents.withColumn("_valid", is_json(F.col("entities"))))
    valid = F.col("_valid")
    found = review.detect_ambiguities(read, floors=settings.floors, valid=valid)
    routed = review.route(
        review.make_questions(found, limit=settings.max_questions), settings.enable_human_review,
        settled=False,
    )
    return review.set_failures_apart(routed, valid=valid).drop("_valid")


def failures(decided: DataFrame) -> DataFrame:
    """``document_id, error`` of the documents whose extraction failed."""
    told = F.coalesce(F.get_json_object("entities", "$.error"), F.lit("no entity document"))
    return decided.filter(F.col("status") == review.FAILED).select(
        "document_id", told.alias("error"))


def review_queue(decided: DataFrame, now: Column) -> DataFrame:
    """Documents that wait for a reviewer."""
    rows = review.queue_rows(decided, now)
    return conform(rows, _contract(rows, REVIEW_QUEUE))


def waiting(decided: DataFrame) -> DataFrame:
    """The documents of :func:`review_queue` with no more than answers are merged into: identity,
    ``document_id, entities`` and ``questions`` as an array, not as a JSON document."""
    rows = decided.filter(F.col("status") == review.QUEUED)
    asked = F.transform("questions", lambda q: F.struct(
        q["id"].alias("id"), q["field_to_update"].alias("field_to_update")))
    return rows.select(
        *[c for c in IDENTITY if c in decided.columns], "document_id", "entities", asked.alias("questions"))


def _summaries(noted: DataFrame, now: Column) -> DataFrame:
    rows = (
        noted.withColumn("quality_metrics", soap.quality_metrics(now))
        .withColumn("sections", soap.sections_document(F.col("sections")))
        .withColumn("human_feedback", to_json(F.col("changes")))
        .withColumn("generation_timestamp", now)
    )
    return conform(rows, _contract(rows, CLINICAL_SUMMARIES))


def auto_summaries(decided: DataFrame, now: Column) -> DataFrame:
    """Notes of the documents that need no reviewer."""
    ready = decided.filter(F.col("status") == review.AUTO).withColumns(
        {
            "completeness_after": F.col("completeness_before"),
            "improvement_delta": F.lit(0.0),
            "fields_attempted": F.lit(0),
            "changes": F.array().cast(ArrayType(CHANGE)),
        }
    )
    return _summaries(soap.generate_notes(ready), now)


@dataclass(frozen=True)
class Reviewed:
    """Rows to append after reviewers' answers came in."""

    validated_entities: DataFrame
    clinical_summaries: DataFrame
    status_log: DataFrame
    errors: DataFrame


def reviewed(queue: DataFrame, answers: DataFrame, now: Column) -> Reviewed:
    """Merge answers into queued documents.

    ``queue`` is the stored review queue, one row per document, or :func:`waiting`.  The merge is
    written down once and the four results read it; :func:`outcomes` alone stays lazy.
    """
    unread = ("source_text", "ambiguities", "questions", "entities")
    merged = materialise(merged_answers(queue, answers).drop(*unread), "merged")
    return outcomes(merged, queue, answers, now)


def merged_answers(queue: DataFrame, answers: DataFrame) -> DataFrame:
    asked = queue.drop("completeness_before")
    if isinstance(queue.schema["questions"].dataType, StringType):
        asked = asked.withColumn("questions", F.from_json("questions", QUESTIONS_DOC)["questions"])
    return review.merge_feedback(review.answered_questions(asked, answers))


def outcomes(merged: DataFrame, queue: DataFrame, answers: DataFrame, now: Column) -> Reviewed:
    validated = merged.select(
        *[c for c in IDENTITY if c in merged.columns],
        "document_id",
        "updated_entities",
        to_json(F.col("changes")).alias("changes"),
        F.col("completeness_after").alias("validation_score"),
        F.col("fields_attempted").alias("human_verified_fields"),
        now.alias("human_review_timestamp"),
    )
    noted = soap.generate_notes(normalise_entities(merged, "updated_entities"))
    done = review.advance_status(merged, review.COMPLETED, now)
    return Reviewed(
        conform(validated, _contract(validated, VALIDATED_ENTITIES)),
        _summaries(noted, now),
        conform(done, STATUS_LOG),
        review.unknown_documents(answers, queue),
    )


def visit_notes(
    visits: DataFrame, now: Column, extract: Extract = extract_by_rules
) -> DataFrame:
    """Page fields to notes without review: ``mrn, patient_name, visit_date, sections[]``.

    A document whose extraction failed keeps its row: id ``error``, note ``Error: ...``,
    empty results and status ``error``.  Completeness is measured, not assumed.
    """
    documents = visits.select(
        F.coalesce(F.col("mrn").cast("string"), F.lit("None")).alias("mrn"),
        F.coalesce(F.col("patient_name").cast("string"), F.lit("None")).alias("patient_name"),
        F.coalesce(F.col("visit_date").cast("string"), F.lit("None")).alias("visit_date"),
        join_notes(F.col("sections")).alias("text"),
    ).withColumn("document_id", visit_id(F.col("mrn"), F.col("visit_date")))
    extracted = extract(documents).withColumn(
        "_error", F.get_json_object("entities", "$.error")
    )
    measured = normalise_entities(extracted).withColumns(
        {
            "completeness_before": completeness(F.col("entities")),
            "improvement_delta": F.lit(0.0),
            "fields_attempted": F.lit(0),
            "changes": F.array().cast(ArrayType(CHANGE)),
        }
    ).withColumn("completeness_after", F.col("completeness_before"))
    ok = F.col("_error").isNull()
    rows = (
        soap.generate_notes(measured)
        .withColumn("quality_metrics", soap.quality_metrics(now))
        .withColumns(
            {
                "status": F.when(ok, "success").otherwise("error"),
                "document_id": F.when(ok, F.col("document_id")).otherwise("error"),
                "soap_note": F.when(ok, F.col("soap_note")).otherwise(
                    F.concat(F.lit("Error: "), F.col("_error"))),
                "sections": F.when(ok, soap.sections_document(F.col("sections"))).otherwise("{}"),
                "quality_metrics": F.when(ok, F.col("quality_metrics")).otherwise("{}"),
                "human_feedback": F.lit("[]"),
                "completeness_before": F.when(ok, F.col("completeness_before")).otherwise(0.0),
                "completeness_after": F.when(ok, F.col("completeness_after")).otherwise(0.0),
                "generation_timestamp": now,
            }
        )
    )
    contract = with_identity(CLINICAL_SUMMARIES)
    return rows.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in contract.fields], "status"
    )
