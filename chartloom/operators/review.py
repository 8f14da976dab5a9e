"""Ambiguities, questions, routing, the review queue and reviewers' answers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from chartloom.config import QualityFloors
from chartloom.functions.jsonval import (
    completeness, is_object, number_or, reply_or_default, to_json)
from chartloom.functions.text import truncate
from chartloom.operators import settle, unnest
from chartloom.operators.entities import apply_patches
from chartloom.operators.infer import render_prompt
from chartloom.schemas import AMBIGUITY, CHANGE, QUESTION, QUESTIONS_DOC

# What a failed or unreadable model stage counts as.
AMBIGUITY_DEFAULT = (
    '{"ambiguities": [], "confidence_score": 0.5, "requires_review": false, '
    '"reasoning_trace": "Failed to parse response"}'
)
QUESTIONS_DEFAULT = (
    '{"questions": [], "total_questions": 0, "estimated_review_time_seconds": 0}'
)
AMBIGUITY_PROMPT = (
    "Look for gaps in these entities: critical fields that are missing, details that are "
    "insufficient, gaps in medical logic, times that do not fit.\n\n"
    "ENTITIES:\n{entities}\n\nSOURCE:\n{source}\n\n"
    "Answer with one JSON object: ambiguities (id, category, field, description, "
    "clinical_importance, clinical_reasoning), confidence_score, requires_review, "
    "completeness_before, critical_fields_missing, reasoning_trace.\n"
)
QUESTION_PROMPT = (
    "Write {wanted} questions that would settle these ambiguities, the most "
    "important first.\n\nAMBIGUITIES:\n{ambiguities}\n\nENTITIES:\n{entities}\n\n"
    "Answer with one JSON object: questions (id, priority, ambiguity_id, field_to_update, "
    "text, context, input_type, options, placeholder, clinical_note), total_questions, "
    "estimated_review_time_seconds.\n"
)
SECONDS_PER_QUESTION = 18

MISSING, DETAIL, LOGIC, TEMPORAL = (
    "missing_information", "insufficient_detail", "logic_gap", "temporal_inconsistency",
)


def _blank(value: Column) -> Column:
    return F.coalesce(value, F.lit("")) == ""


# What each rule reports: category, clinical importance, description, reasoning.
RULES = {
    "no_complaint": (MISSING, "high", "Chief complaint is missing",
                     "The reason for the visit directs the work-up"),
    "no_diagnosis": (MISSING, "high", "No diagnosis is recorded",
                     "Assessment and plan rest on the diagnosis"),
    "no_medication": (MISSING, "medium", "No medication is recorded",
                      "Current medication matters for every order"),
    "no_indication": (LOGIC, "high", "Medication without a matching diagnosis",
                      "Each medication needs an indication"),
    "severity": (DETAIL, "high", "Symptom severity is missing", "Severity decides urgency"),
    "location": (DETAIL, "medium", "Symptom location is missing",
                 "Location narrows the differential"),
    "onset": (TEMPORAL, "medium", "Symptom onset is unclear",
              "Onset separates acute from chronic"),
    "dosage": (DETAIL, "high", "Medication dosage is missing",
               "A dose is needed to prescribe safely"),
    "frequency": (DETAIL, "low", "Medication frequency is missing",
                  "Frequency completes the order"),
}


def _rule_details() -> Column:
    """The rules as one constant map column."""
    pairs = []
    for rule, (category, importance, description, reasoning) in RULES.items():
        pairs += [F.lit(rule), F.struct(
            F.lit(category).alias("category"), F.lit(importance).alias("importance"),
            F.lit(description).alias("description"), F.lit(reasoning).alias("reasoning"))]
    return F.create_map(*pairs)


def _finding(when: Column, rule: str, field: Column) -> Column:
    """Rule and place where the condition holds, else null."""
    return F.when(when, F.struct(F.lit(rule).alias("rule"), field.alias("field")))


def ambiguity_list(entity: Column) -> Column:
    """Ambiguities of one document in rule order, with ids ``amb_1`` and up."""
    no_diagnosis = F.size(entity["diagnoses"]) == 0
    no_medication = F.size(entity["medications"]) == 0
    critical = F.array(
        _finding(_blank(entity["chief_complaint"]), "no_complaint", F.lit("chief_complaint")),
        _finding(no_diagnosis, "no_diagnosis", F.lit("diagnoses")),
        _finding(no_medication, "no_medication", F.lit("medications")),
        _finding(~no_medication & no_diagnosis, "no_indication", F.lit("medications")),
    )

    def gaps(name: str, *leaves: str) -> Column:
        def of_item(item: Column, i: Column) -> Column:
            place = F.concat(F.lit(f"{name}["), i.cast("string"), F.lit("]."))
            return F.array(
                *[_finding(_blank(item[x]), x, F.concat(place, F.lit(x))) for x in leaves]
            )

        return F.flatten(F.transform(entity[name], of_item))

    found = F.array_compact(
        F.concat(
            critical,
            gaps("symptoms", "severity", "location", "onset"),
            gaps("medications", "dosage", "frequency"),
        )
    )
    details = _rule_details()

    def described(a: Column, i: Column) -> Column:
        rule = F.element_at(details, a["rule"])
        return F.struct(
            F.concat(F.lit("amb_"), (i + 1).cast("string")).alias("id"),
            rule["category"].alias("category"),
            a["field"].alias("field"),
            rule["description"].alias("description"),
            rule["importance"].alias("clinical_importance"),
            rule["reasoning"].alias("clinical_reasoning"),
        )

    return F.transform(found, described)


def detect_ambiguities(
    df: DataFrame,
    entity: str = "entity",
    entities: str = "entities",
    floors: QualityFloors = QualityFloors(),
    valid: Column | None = None,
) -> DataFrame:
    """Add ``ambiguities, critical_fields_missing, confidence_score,
    completeness_before, requires_review`` by rule.  ``valid`` is ``is_json`` of the entities where
    that has been computed already, here and in what follows.

    Confidence falls by 0.05 per ambiguity.  A review is required when something
    critical is missing or confidence is under the overall floor.
    """
    found = df.withColumn("ambiguities", ambiguity_list(F.col(entity)))
    scored = found.withColumns(
        {
            "critical_fields_missing": F.size(
                F.filter("ambiguities", lambda a: a["category"] == MISSING)
            ),
            "confidence_score": F.greatest(
                F.lit(1.0) - F.lit(0.05) * F.size("ambiguities"), F.lit(0.0)
            ),
            "completeness_before": completeness(F.col(entities), valid),
        }
    )
    return scored.withColumn(
        "requires_review",
        (F.col("critical_fields_missing") > 0)
        | (F.col("confidence_score") < floors.overall_quality),
    )


def ambiguities_from_reply(df: DataFrame, reply: str) -> DataFrame:
    """The same columns from a model's reply; an unreadable one counts as the default."""
    doc = df.withColumn("_doc", reply_or_default(F.col(reply), AMBIGUITY_DEFAULT))
    listed = F.get_json_object("_doc", "$.ambiguities")
    schema = ArrayType(AMBIGUITY)
    return doc.withColumns(
        {
            "ambiguities": F.coalesce(F.from_json(listed, schema), F.array().cast(schema)),
            "critical_fields_missing": number_or(
                F.col("_doc"), "$.critical_fields_missing", 0).cast("int"),
            "confidence_score": number_or(F.col("_doc"), "$.confidence_score", 0),
            "completeness_before": number_or(F.col("_doc"), "$.completeness_before", 0),
            "requires_review": F.coalesce(
                F.get_json_object("_doc", "$.requires_review") == "true", F.lit(False)),
        }
    ).drop("_doc")


def ambiguity_prompt(entities: Column, source: Column, chars: int | None = None) -> Column:
    return render_prompt(AMBIGUITY_PROMPT, entities=entities, source=truncate(source, chars))


def question_prompt(
    ambiguities: Column, entities: Column, limit: int | None = None
) -> Column:
    wanted = "the" if limit is None else f"at most {limit}"
    return render_prompt(
        QUESTION_PROMPT, wanted=F.lit(wanted), ambiguities=to_json(ambiguities), entities=entities
    )


def _importance(level: Column) -> Column:
    return F.when(level == "high", 1).when(level == "medium", 2).otherwise(3)


# Question wording per last step of the field path: text, input type, options.
QUESTION_TEMPLATES = {
    "chief_complaint": ("What is the chief complaint?", "text", ()),
    "diagnoses": ("Which diagnosis applies?", "text", ()),
    "medications": ("Which medications does the patient take, and why?", "text", ()),
    "severity": ("How severe is the symptom?", "select", ("mild", "moderate", "severe")),
    "location": ("Where is the symptom located?", "text", ()),
    "onset": ("When did the symptom start?", "text", ()),
    "dosage": ("What is the dosage?", "text", ()),
    "frequency": ("How often is it taken?", "select", ("daily", "BID", "TID", "PRN")),
}


def _templates() -> Column:
    """The templates as one constant map column."""
    pairs = []
    for leaf, (text, input_type, options) in QUESTION_TEMPLATES.items():
        pairs += [F.lit(leaf), F.struct(
            F.lit(text).alias("text"), F.lit(input_type).alias("input_type"),
            F.array(*map(F.lit, options)).cast("array<string>").alias("options"))]
    return F.create_map(*pairs)


def make_questions(
    df: DataFrame, ambiguities: str = "ambiguities", limit: int | None = None
) -> DataFrame:
    """Add ``questions``, all or ``limit`` of them, by importance, then by ambiguity order."""
    ranked = F.array_sort(
        F.transform(
            ambiguities,
            lambda a, i: F.struct(_importance(a["clinical_importance"]).alias("rank"),
                                  i.alias("pos"), a.alias("a")),
        )
    )
    if limit is not None:
        ranked = F.slice(ranked, 1, limit)

    templates = _templates()

    def question(item: Column, i: Column) -> Column:
        a = item["a"]
        template = F.try_element_at(templates, F.substring_index(a["field"], ".", -1))
        return F.struct(
            F.concat(F.lit("q"), (i + 1).cast("string")).alias("id"),
            (i + 1).cast("int").alias("priority"),
            a["id"].alias("ambiguity_id"),
            a["field"].alias("field_to_update"),
            F.coalesce(
                template["text"], F.concat(F.lit("What is the value of "), a["field"], F.lit("?"))
            ).alias("text"),
            a["description"].alias("context"),
            F.coalesce(template["input_type"], F.lit("text")).alias("input_type"),
            F.coalesce(template["options"], F.array().cast("array<string>")).alias("options"),
            F.lit("").alias("placeholder"),
            a["clinical_reasoning"].alias("clinical_note"),
        )

    return df.withColumn("_ranked", ranked).withColumn(
        "questions", F.transform("_ranked", question)
    ).drop("_ranked")


def questions_document(questions: Column) -> Column:
    """Questions as the stored JSON document."""
    return to_json(
        F.struct(
            questions.alias("questions"),
            F.size(questions).alias("total_questions"),
            (F.size(questions) * SECONDS_PER_QUESTION).alias("estimated_review_time_seconds"),
        )
    )


def questions_from_reply(df: DataFrame, reply: str, limit: int | None = None) -> DataFrame:
    """``questions`` from a model's reply; an unreadable one counts as no questions."""
    doc = F.from_json(reply_or_default(F.col(reply), QUESTIONS_DEFAULT), QUESTIONS_DOC)
    none = F.array().cast(ArrayType(QUESTION))
    asked = F.coalesce(doc["questions"], none)
    return df.withColumn("questions", asked if limit is None else F.slice(asked, 1, limit))


AUTO, QUEUED, COMPLETED, FAILED = "completed_auto", "pending_review", "completed", "error"


def extraction_failed(entities: Column, valid: Column | None = None) -> Column:
    """True where an extraction left an error, nothing, or no JSON object."""
    error = F.get_json_object(entities, "$.error").isNotNull()
    return error | ~is_object(F.coalesce(entities, F.lit("")), valid)


def set_failures_apart(
    df: DataFrame, entities: str = "entities", valid: Column | None = None
) -> DataFrame:
    """Failed extractions get the status ``error``: nothing to ask, nothing complete."""
    staged = df.withColumn("_failed", extraction_failed(F.col(entities), valid))  # used often, so not repeated
    failed = F.col("_failed")

    def instead(column: str, value: Column) -> Column:
        return F.when(failed, value.cast(df.schema[column].dataType)).otherwise(F.col(column))

    none = F.array()
    apart = staged.withColumns({
        "ambiguities": instead("ambiguities", none), "questions": instead("questions", none),
        "critical_fields_missing": instead("critical_fields_missing", F.lit(0)),
        "confidence_score": instead("confidence_score", F.lit(0.0)),
        "completeness_before": instead("completeness_before", F.lit(0.0)),
        "requires_review": instead("requires_review", F.lit(False)),
        "status": instead("status", F.lit(FAILED)),
    })
    return settle(apart.drop("_failed"), "status")


def route(df: DataFrame, enable_human_review: bool = True, settled: bool = True) -> DataFrame:
    """Add ``status``: straight to a note, or to the review queue.  It need not be settled here
    where a later step does so."""
    review = F.coalesce(F.col("requires_review"), F.lit(False)) & F.lit(enable_human_review)
    routed = df.withColumn("status", F.when(review, QUEUED).otherwise(AUTO))
    return settle(routed, "status") if settled else routed


def queue_rows(
    df: DataFrame, now: Column, text: str = "text", chars: int | None = None
) -> DataFrame:
    """Documents that wait for review, under the queue's column names."""
    doc = F.struct(
        "ambiguities", "confidence_score", "requires_review", "completeness_before",
        "critical_fields_missing",
    )
    waiting = df.filter(F.col("status") == QUEUED)
    return waiting.select(
        *[c for c in ("mrn", "patient_name", "visit_date") if c in df.columns],
        "document_id",
        "entities",
        truncate(F.col(text), chars).alias("source_text"),
        to_json(doc).alias("ambiguities"),
        questions_document(F.col("questions")).alias("questions"),
        "status",
        F.col("completeness_before").cast("float").alias("completeness_before"),
        now.alias("created_timestamp"),
        now.alias("updated_timestamp"),
    )


def latest_status(log: DataFrame, *carry: str) -> DataFrame:
    """Newest row per document of an append-only status log.

    One maximum per document, combined before the shuffle, so that a document with
    any number of rows stays one small state per task.  Equal times are settled by
    the greater status.
    """
    columns = ["updated_timestamp", "status", *carry]
    newest = log.groupBy("document_id").agg(F.max(F.struct(*columns)).alias("_new"))
    return newest.select("document_id", *[F.col(f"_new.{c}").alias(c) for c in columns])


def advance_status(document_ids: DataFrame, status: str, now: Column) -> DataFrame:
    """Rows to append to the status log for these documents."""
    return document_ids.select(
        "document_id", F.lit(status).alias("status"), now.alias("updated_timestamp")
    )


def latest_answers(answers: DataFrame) -> DataFrame:
    """One answer per question of a document, the newest; empty ones drop out."""
    newest = answers.groupBy("document_id", "question_id").agg(
        F.max(F.struct("answered_at", "answer")).alias("_new")
    )
    return newest.select(
        "document_id", "question_id", F.col("_new.answer").alias("answer")
    ).filter(F.coalesce("answer", F.lit("")) != "")


def answered_documents(answers: DataFrame) -> DataFrame:
    """``document_id`` of the documents that :func:`latest_answers` has answers of, each once.

    Of equally new answers any text outdoes an empty one, so a question is answered where the newest
    text is as new as the newest answer.  Times alone are compared, which needs no sorting.
    """
    text = F.coalesce("answer", F.lit("")) != ""
    newest = answers.groupBy("document_id", "question_id").agg(
        F.max("answered_at").alias("_any"), F.max(F.when(text, F.col("answered_at"))).alias("_text"),
        F.count_if(text).alias("_texts"))
    held = newest.filter((F.col("_texts") > 0) & F.col("_text").eqNullSafe(F.col("_any")))
    return held.select("document_id").distinct()


def unknown_documents(answers: DataFrame, queue: DataFrame) -> DataFrame:
    """Error rows for answers to documents that are not in the queue."""
    ids = answers.select("document_id").distinct()
    return ids.join(queue.select("document_id"), "document_id", "left_anti").select(
        "document_id",
        F.lit("error").alias("status"),
        F.concat(F.lit("Document "), F.col("document_id"),
                 F.lit(" not found in review queue")).alias("message"),
    )


def unprocessed(documents: DataFrame, done: DataFrame, key: str = "document_id") -> DataFrame:
    """Documents whose id is not in the target yet."""
    return documents.join(done.select(key).distinct(), key, "left_anti")


def answered_questions(queue: DataFrame, answers: DataFrame) -> DataFrame:
    """Queue rows with the answered questions in question order.

    ``queue`` holds ``document_id, entities, questions`` (array of questions), once per
    document.  Answers meet their questions on document and question together, so no
    document gathers more answers than it has questions, however many were sent.
    """
    asked = unnest(queue, "questions", "document_id", item="q").select(
        "document_id", "pos", F.col("q.id").alias("question_id"),
        F.col("q.field_to_update").alias("field"),
    )
    matched = (
        asked.join(latest_answers(answers), ["document_id", "question_id"])
        .groupBy("document_id")
        .agg(
            F.sort_array(
                F.collect_list(F.struct("pos", "question_id", "field", "answer"))
            ).alias("answered")
        )
    )
    return queue.join(matched, "document_id")


def merge_feedback(answered: DataFrame) -> DataFrame:
    """Write answers into entities and measure the effect.

    Adds ``updated_entities, changes, completeness_before, completeness_after,
    improvement_delta, fields_attempted, fields_improved``.  Answers apply in question
    order, so a second answer to a field has the first one as its old value.  A change
    whose path does not fit counts as attempted and leaves the document alone.
    """
    patches = F.transform(
        "answered", lambda a: F.struct(a["field"].alias("path"), a["answer"].alias("value"))
    )
    merged = answered.withColumn("_merged", apply_patches(F.col("entities"), patches))

    def change(item: Column, i: Column) -> Column:
        return F.struct(
            item["field"].alias("field"),
            F.get(F.col("_merged.old_values"), i).alias("old_value"),
            F.get(F.col("_merged.new_values"), i).alias("new_value"),
            F.lit("human_review").alias("source"),
            item["question_id"].alias("question_id"),
        )

    measured = merged.withColumns(
        {
            "updated_entities": F.col("_merged.document"),
            "changes": F.transform("answered", change).cast(ArrayType(CHANGE)),
        }
    ).withColumns(
        {
            "completeness_before": completeness(F.col("entities")),
            "completeness_after": completeness(F.col("updated_entities")),
        }
    )
    differs = F.filter("changes", lambda c: ~c["old_value"].eqNullSafe(c["new_value"]))
    return measured.withColumns(
        {
            "improvement_delta": F.col("completeness_after") - F.col("completeness_before"),
            "fields_attempted": F.size("changes"),
            "fields_improved": F.size(differs),
        }
    ).drop("_merged", "answered")


def by_importance(ambiguities: DataFrame, limit: int) -> DataFrame:
    """Top ambiguities per document from rows that are stored one per ambiguity.

    ``row_number`` under a limit is cut to ``limit`` rows per document before the
    shuffle, so a document with very many rows does not gather in one task.
    """
    order = Window.partitionBy("document_id").orderBy(
        _importance(F.col("clinical_importance")), F.col("pos")
    )
    ranked = ambiguities.withColumn("priority", F.row_number().over(order))
    return ranked.filter(F.col("priority") <= limit)


def union_all(*frames: DataFrame) -> DataFrame:
    """Rows of all frames, matched by column name."""
    return reduce(lambda a, b: a.unionByName(b), frames)
