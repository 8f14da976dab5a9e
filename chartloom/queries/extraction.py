"""Fields and entities out of notes, by rule and through a model."""

from __future__ import annotations

import json
import threading
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chartloom.config import ModelSettings, PipelineSettings, RetrySettings
from chartloom.functions.jsonval import reply_or_default
from chartloom.functions.text import NOTE_LABELS, field_name
from chartloom.operators import measures
from chartloom.operators import pages as pg
from chartloom.operators.elements import element_tree, text_elements
from chartloom.operators.entities import (
    EXTRACTION_PROMPT,
    UNREADABLE_ENTITIES,
    extract_by_rules,
    extract_with_model,
    normalise_entities,
)
from chartloom.operators.infer import (
    infer_cached, infer_distinct, infer_udf, render_prompt, reply_document, stage_options)
from chartloom.operators.review import AMBIGUITY_PROMPT, ambiguity_prompt
from chartloom.queries.inputs import ENC, encounters, table, texts
from chartloom.sources.tables import materialise

NO_WAIT = RetrySettings(max_attempts=2, initial_wait_seconds=0.0)
FLAT_LABELS = (
    "ENCOUNTER DATE", "PATIENT", "MRN", "CHIEF COMPLAINT:", "SUBJECTIVE:", "OBJECTIVE:",
    "ASSESSMENT:", "PLAN:",
)


def _note_trees(spark, sf) -> DataFrame:
    return encounters(spark, sf).select(
        F.col("document_id").alias("path"),
        element_tree(text_elements(F.col("text"))).alias("parsed_content"),
    )


def page_fields(spark, sf):
    fields = pg.page_fields(pg.pages_of_tree(_note_trees(spark, sf)))
    return fields.select(
        "MRN", "PATIENT", "ENCOUNTER_DATE", F.array_join("Notes", "|").alias("notes")
    )


def named_fields(spark, sf):
    notes = encounters(spark, sf).select("document_id", "text")
    found = pg.extract_fields(notes, F.col("text"), NOTE_LABELS)
    return found.select("document_id", *[field_name(label) for label in NOTE_LABELS])


def flat_fields(spark, sf):
    found = pg.flat_fields(_note_trees(spark, sf), FLAT_LABELS)
    return found.withColumn("page_id", F.col("page_id").cast("bigint"))


def regex_matches(spark, sf):
    events = table(spark, sf, "events").select("event_id", "props")
    return pg.explode_matches(events, "props", r'"k"\s*:\s*([0-9]+)').select(
        "event_id", "comments"
    )


def _event_entities(spark, sf) -> DataFrame:
    """Events as extraction results: errors, words of confidence, and gaps."""
    level = (
        F.when(F.col("event_id") % 17 == 0, F.lit("{}"))
        .when(F.col("event_id") % 3 == 0, '{"extraction_confidence": "high"}')
        .when(F.col("event_id") % 3 == 1, '{"extraction_confidence": "medium"}')
        .otherwise('{"extraction_confidence": "low"}')
    )
    failure = F.lit('{"error": "API timeout", "extraction_confidence": "failed"}')
    return table(spark, sf, "events").select(
        "event_id",
        F.when(F.col("event_type") == "error", failure).otherwise(level).alias("entities"),
    )


def extraction_stats(spark, sf):
    return measures.extraction_stats(_event_entities(spark, sf)).withColumnRenamed("count", "documents")


def confidence_totals(spark, sf):
    return measures.confidence_totals(_event_entities(spark, sf))


def success_counts(spark, sf):
    return measures.success_counts(_event_entities(spark, sf))


def reply_cleaning(spark, sf):
    """Replies in every shape a model gives them, from the events' JSON."""
    props, kind = F.col("props"), F.col("event_id") % 6
    fence = F.lit("```")
    reply = (
        F.when(kind == 0, props)
        .when(kind == 1, F.concat(F.lit("```json\n"), props, F.lit("\n```")))
        .when(kind == 2, F.concat(F.lit("```\n"), props, F.lit("\n```\n")))
        .when(kind == 3, F.concat(F.lit("Here it is:\n```json\n"), props, fence, F.lit(" ok")))
        .when(kind == 4, F.concat(F.lit("{broken "), props))
        .otherwise(F.concat(F.lit(" \n"), props, F.lit("\n ")))
    )
    cleaned = table(spark, sf, "events").select(
        "event_id", reply_or_default(reply, UNREADABLE_ENTITIES).alias("doc")
    )
    return cleaned.select(
        "event_id",
        F.get_json_object("doc", "$.k").alias("k"),
        F.get_json_object("doc", "$.extraction_confidence").alias("confidence"),
    )


def entity_samples(spark, sf):
    docs = encounters(spark, sf).select("document_id", "entities")
    first = measures.first_rows(docs, "document_id", limit=10)
    return first.select(
        "document_id",
        *[F.get_json_object("entities", f"$.{name}").alias(name) for name in (
            "chief_complaint", "symptoms", "diagnoses", "medications", "extraction_confidence")],
    )


def rule_extraction(spark, sf):
    notes = encounters(spark, sf).select("document_id", "text")
    found = normalise_entities(extract_by_rules(notes))
    e = F.col("entity")

    def joined(name: str, *parts: str):
        def shown(item):
            return F.concat_ws("/", *[F.coalesce(item[p], F.lit("-")) for p in parts])

        return F.array_join(F.transform(e[name], shown), ";").alias(name)

    return found.select(
        "document_id",
        e["chief_complaint"].alias("chief_complaint"),
        joined("symptoms", "symptom", "severity"),
        joined("diagnoses", "diagnosis", "status"),
        joined("medications", "name", "dosage", "frequency"),
        joined("procedures", "procedure"),
        *[e["vital_signs"][v].alias(v) for v in (
            "blood_pressure", "temperature", "heart_rate", "respiratory_rate",
            "oxygen_saturation")],
        e["extraction_confidence"].alias("confidence"),
        F.array_join(e["missing_information"], ",").alias("missing"),
    )


def _note_in(prompt: str) -> str:
    return prompt.split("NOTE:\n", 1)[1].rsplit("\n\nAnswer with", 1)[0]


def offline_model():
    """A stand-in for a hosted model: fixed answers and failures by note length."""
    def answer(prompt: str) -> str:
        chars = len(_note_in(prompt))
        if chars % 7 == 0:
            raise TimeoutError("no answer in time")
        if chars % 11 == 0:
            raise ConnectionError("endpoint refused")
        if chars % 13 == 0:
            return "I cannot answer that."
        level = "high" if chars > 2000 else "medium"
        body = json.dumps({"chief_complaint": str(chars), "extraction_confidence": level})
        return f"```json\n{body}\n```"

    return answer


def second_model():
    def answer(prompt: str) -> str:
        return json.dumps(
            {"chief_complaint": str(len(_note_in(prompt))), "extraction_confidence": "low"}
        )

    return answer


def _model_fields(df: DataFrame) -> DataFrame:
    return df.select(
        "doc_id",
        *[F.get_json_object("entities", f"$.{name}").alias(name) for name in (
            "chief_complaint", "extraction_confidence", "error", "raw_response")],
    )


def model_extraction(spark, sf):
    docs = texts(spark, sf, "documents", "doc_id", "text")
    return _model_fields(extract_with_model(docs, offline_model, retry=NO_WAIT, threads=4))


def model_fallback(spark, sf):
    docs = texts(spark, sf, "documents", "doc_id", "text")
    return _model_fields(
        extract_with_model(
            docs, offline_model, fallback=second_model, retry=NO_WAIT, distinct=True
        )
    )


#: Every call may take a second; hanging ones would take a minute.
IN_TIME = PipelineSettings(
    extraction=ModelSettings(timeout_seconds=1.0),
    retry=RetrySettings(max_attempts=2, initial_wait_seconds=0.0))


def hanging_model(settings: ModelSettings):
    """A hosted model that now and then does not answer at all."""
    def answer(prompt: str) -> str:
        chars = len(_note_in(prompt))
        if chars % 50 == 0:
            time.sleep(60 * settings.timeout_seconds)
        if chars % 11 == 0:
            raise ConnectionError("endpoint refused")
        return json.dumps({"chief_complaint": str(chars), "extraction_confidence": "high"})

    return answer


def model_deadlines(spark, sf):
    """Calls that hang end at their stage's time limit; their rows come back as timed out."""
    docs = texts(spark, sf, "documents", "doc_id", "text")
    return _model_fields(extract_with_model(
        docs, hanging_model, threads=32, **stage_options("extraction", IN_TIME)))


CALLS_PER_SECOND, CALLERS = 40.0, 4


def stamped_model():
    def answer(prompt: str) -> str:
        return json.dumps({"at": time.time(), "caller": threading.get_ident()})

    return answer


def rate_limited_calls(spark, sf):
    """One call per language and source, under a budget for all tasks; ``in_budget`` tells that
    a task's k-th call came no sooner after its first one than its share allows."""
    asked = table(spark, sf, "documents").select("lang", "source").distinct().withColumn(
        "prompt", render_prompt("Describe {s} in {l}.", s=F.col("source"), l=F.col("lang")))
    numbered = asked.repartition(CALLERS).withColumn("task", F.spark_partition_id())
    answered = numbered.withColumn("inference", infer_udf(
        stamped_model, threads=8, retry=NO_WAIT, calls_per_second=CALLS_PER_SECOND / CALLERS)(
            F.col("prompt")))
    stored = materialise(answered.select(
        "lang", "source", "task", F.get_json_object("inference.reply", "$.at").cast("double").alias("at"),
        F.col("inference.attempts").alias("attempts")), "calls")
    own = Window.partitionBy("task").orderBy("at")
    soonest = (F.row_number().over(own) - 1) * CALLERS / CALLS_PER_SECOND
    late = 0.25  # seconds by which the first call itself may be late
    return stored.select(
        "lang", "source", F.col("attempts").cast("bigint").alias("attempts"),
        (F.col("at") - F.min("at").over(own) >= soonest - late).alias("in_budget"))


def echo_model():
    def answer(prompt: str) -> str:
        return json.dumps({"length": len(prompt)})

    return answer


def distinct_prompts(spark, sf):
    """Few different prompts behind very many rows: each is sent once."""
    asked = table(spark, sf, "events").select(
        "event_id", render_prompt("Explain {what}.", what=F.col("event_type")).alias("prompt")
    )
    answered = infer_distinct(asked, "prompt", echo_model, retry=NO_WAIT)
    return answered.select(
        "event_id",
        F.get_json_object(reply_document(F.col("inference")), "$.length")
        .cast("bigint").alias("length"),
        F.col("inference.attempts").cast("bigint").alias("attempts"),
    )


def cached_replies(spark, sf):
    """Replies of the last ten days count, older ones are asked again."""
    asked = table(spark, sf, "events").select(
        "event_id",
        F.concat_ws("/", "event_type", F.col("user_id").cast("string")).alias("prompt"),
        "ts",
    )
    cache = asked.filter(F.col("event_id") % 4 == 0).select(
        F.sha2("prompt", 256).alias("prompt_hash"),
        F.concat(F.lit("known "), "prompt").alias("reply"),
        F.col("ts").cast("timestamp").alias("cached_at"),
    )
    now = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz").cast("timestamp")
    answered, _ = infer_cached(
        asked.select("event_id", "prompt"), "prompt", echo_model, cache, now,
        ttl_seconds=10 * 86400, retry=NO_WAIT,
    )
    return answered.select(
        "event_id",
        F.col("inference.model").alias("source"),
        F.col("inference.reply").alias("reply"),
    )


def rendered_prompts(spark, sf):
    docs = encounters(spark, sf)
    return docs.select(
        "document_id",
        F.md5(render_prompt(EXTRACTION_PROMPT, note=F.col("text"))).alias("extraction"),
        F.md5(ambiguity_prompt(F.col("entities"), F.col("text"))).alias("ambiguity"),
    )


QUERIES: dict[str, Callable] = {
    fn.__name__: fn
    for fn in (
        page_fields, named_fields, flat_fields, regex_matches, extraction_stats,
        confidence_totals, success_counts, reply_cleaning, entity_samples, rule_extraction,
        model_extraction, model_fallback, model_deadlines, rate_limited_calls, distinct_prompts, cached_replies, rendered_prompts,
    )
}

_CC = "nullif(coalesce(e.chief_complaint, ''), '')"
_DX = "array_to_string([d.diagnosis FOR d IN e.diagnoses], '. ') || '.'"
_PLAN = "nullif(array_to_string([p.procedure || ' ordered.' FOR p IN e.procedures], ' '), '')"
_EVENT_ENTITIES = """
ent AS (
  SELECT event_id, event_type = 'error' AS has_error,
    CASE WHEN event_type = 'error' THEN 'failed' WHEN event_id % 17 = 0 THEN NULL
      WHEN event_id % 3 = 0 THEN 'high' WHEN event_id % 3 = 1 THEN 'medium' ELSE 'low' END AS c
  FROM events
)"""


def _quoted(template: str) -> str:
    return template.replace("'", "''")


def _filled(template: str, **slots: str) -> str:
    """SQL text that fills a template's slots with expressions."""
    out = "'" + _quoted(template) + "'"
    for name, expression in slots.items():
        out = out.replace("{" + name + "}", "' || " + expression + " || '")
    return out


_MODEL = """
m AS (
  SELECT doc_id, text, length(text) AS n,
    length(trim(text)) = 0 AS short FROM documents
), f AS (
  SELECT *, NOT short AND n % 7 = 0 AS late, NOT short AND n % 7 <> 0 AND n % 11 = 0 AS refused,
    NOT short AND n % 7 <> 0 AND n % 11 <> 0 AND n % 13 = 0 AS odd FROM m
)"""

ORACLES: dict[str, str] = {
    "page_fields": f"""
WITH {ENC}
SELECT mrn AS MRN, patient_name AS PATIENT, visit_date AS ENCOUNTER_DATE,
  array_to_string(list_filter([trim(l) FOR l IN string_split(text, chr(10))],
    lambda x: x <> ''), '|') AS notes
FROM enc""",
    "named_fields": f"""
WITH {ENC}
SELECT document_id, mrn AS MRN, patient_name AS PATIENT, visit_date AS ENCOUNTER_DATE,
  {_CC} AS CHIEF_COMPLAINT, NULL AS SUBJECTIVE, NULL AS OBJECTIVE, {_DX} AS ASSESSMENT,
  {_PLAN} AS PLAN, NULL AS IMPRESSION, NULL AS REASON_FOR_REFERRAL, NULL AS page_id
FROM enc""",
    "flat_fields": f"""
WITH {ENC}, parts AS (
  SELECT document_id, visit_date AS d, patient_name AS p, mrn AS m, NULL AS cc, NULL AS a,
    NULL AS pl FROM enc
  UNION ALL SELECT document_id, NULL, NULL, NULL, {_CC}, NULL, NULL FROM enc
  UNION ALL SELECT document_id, NULL, NULL, NULL, NULL, {_DX}, NULL FROM enc
  UNION ALL SELECT document_id, NULL, NULL, NULL, NULL, NULL, {_PLAN} FROM enc
  UNION ALL SELECT document_id, NULL, NULL, NULL, NULL, NULL, NULL FROM enc
)
SELECT DISTINCT document_id AS path, 1 AS page_id, d AS ENCOUNTER_DATE, p AS PATIENT, m AS MRN,
  cc AS CHIEF_COMPLAINT, NULL AS SUBJECTIVE, NULL AS OBJECTIVE, a AS ASSESSMENT, pl AS PLAN
FROM parts""",
    "regex_matches": """
SELECT event_id, json_extract_string(props, '$.k') AS comments FROM events
WHERE json_extract_string(props, '$.k') IS NOT NULL""",
    "extraction_stats": f"""
WITH {_EVENT_ENTITIES}
SELECT has_error, c AS confidence, count(*) AS documents FROM ent GROUP BY has_error, c""",
    "confidence_totals": f"""
WITH {_EVENT_ENTITIES}
SELECT count(*) AS total_documents,
  sum(CASE WHEN c = 'high' THEN 1 ELSE 0 END)::BIGINT AS high_confidence,
  sum(CASE WHEN c = 'medium' THEN 1 ELSE 0 END)::BIGINT AS medium_confidence,
  sum(CASE WHEN c = 'low' THEN 1 ELSE 0 END)::BIGINT AS low_confidence
FROM ent""",
    "success_counts": f"""
WITH {_EVENT_ENTITIES}
SELECT count(*) AS total, count(*) FILTER (WHERE NOT has_error) AS successful,
  count(*) FILTER (WHERE has_error) AS failed FROM ent""",
    "reply_cleaning": """
SELECT event_id,
  CASE WHEN event_id % 6 <> 4 THEN json_extract_string(props, '$.k') END AS k,
  CASE WHEN event_id % 6 = 4 THEN '0.5' END AS confidence
FROM events""",
    "entity_samples": f"""
WITH {ENC}
SELECT document_id, e.chief_complaint AS chief_complaint, to_json(e.symptoms)::VARCHAR AS symptoms,
  to_json(e.diagnoses)::VARCHAR AS diagnoses, to_json(e.medications)::VARCHAR AS medications,
  e.extraction_confidence AS extraction_confidence
FROM enc ORDER BY document_id LIMIT 10""",
    "rule_extraction": f"""
WITH {ENC}
SELECT document_id, {_CC} AS chief_complaint,
  array_to_string([s.symptom || '/-' FOR s IN e.symptoms], ';') AS symptoms,
  array_to_string([d.diagnosis || '/-' FOR d IN e.diagnoses], ';') AS diagnoses,
  CASE WHEN k % 13 = 0 THEN '' ELSE array_to_string([concat_ws('/', m.name,
    coalesce(m.dosage, '-'), coalesce(m.frequency, '-')) FOR m IN e.medications], ';') END
    AS medications,
  array_to_string([p.procedure FOR p IN e.procedures], ';') AS procedures,
  e.vital_signs.blood_pressure AS blood_pressure, e.vital_signs.temperature AS temperature,
  e.vital_signs.heart_rate AS heart_rate, NULL AS respiratory_rate,
  e.vital_signs.oxygen_saturation AS oxygen_saturation,
  CASE WHEN {_CC} IS NULL THEN 'medium' ELSE 'high' END AS confidence,
  CASE WHEN {_CC} IS NULL THEN 'chief_complaint' ELSE '' END AS missing
FROM enc""",
    "model_extraction": f"""
WITH {_MODEL}
SELECT doc_id,
  CASE WHEN short THEN '' WHEN late OR refused OR odd THEN NULL ELSE n::VARCHAR END
    AS chief_complaint,
  CASE WHEN short THEN 'low' WHEN late OR refused OR odd THEN 'failed'
    WHEN n > 2000 THEN 'high' ELSE 'medium' END AS extraction_confidence,
  CASE WHEN late THEN 'API timeout' WHEN refused THEN 'API error: endpoint refused'
    WHEN odd THEN 'JSON parse error: reply is not valid JSON' END AS error,
  CASE WHEN odd THEN 'I cannot answer that.' END AS raw_response
FROM f""",
    "model_fallback": f"""
WITH {_MODEL}
SELECT doc_id,
  CASE WHEN short THEN '' WHEN odd THEN NULL ELSE n::VARCHAR END AS chief_complaint,
  CASE WHEN short OR late OR refused THEN 'low' WHEN odd THEN 'failed'
    WHEN n > 2000 THEN 'high' ELSE 'medium' END AS extraction_confidence,
  CASE WHEN odd THEN 'JSON parse error: reply is not valid JSON' END AS error,
  CASE WHEN odd THEN 'I cannot answer that.' END AS raw_response
FROM f""",
    "model_deadlines": f"""
WITH {_MODEL}
SELECT doc_id,
  CASE WHEN short THEN '' WHEN n % 50 = 0 OR n % 11 = 0 THEN NULL ELSE n::VARCHAR END AS chief_complaint,
  CASE WHEN short THEN 'low' WHEN n % 50 = 0 OR n % 11 = 0 THEN 'failed' ELSE 'high' END
    AS extraction_confidence,
  CASE WHEN short THEN NULL WHEN n % 50 = 0 THEN 'API timeout'
    WHEN n % 11 = 0 THEN 'API error: endpoint refused' END AS error,
  NULL::VARCHAR AS raw_response
FROM f""",
    "rate_limited_calls": """
SELECT DISTINCT lang, source, 1 AS attempts, true AS in_budget FROM documents""",
    "distinct_prompts": """
SELECT event_id, length('Explain ' || event_type || '.') AS length, 1 AS attempts FROM events""",
    "cached_replies": """
WITH asked AS (SELECT event_id, event_type || '/' || user_id AS prompt, ts FROM events),
known AS (
  SELECT DISTINCT prompt FROM asked
  WHERE event_id % 4 = 0
    AND epoch(TIMESTAMP '2024-02-01')::BIGINT - floor(epoch(ts))::BIGINT < 864000)
SELECT event_id, CASE WHEN k.prompt IS NULL THEN 'primary' ELSE 'cache' END AS source,
  CASE WHEN k.prompt IS NULL THEN '{"length": ' || length(a.prompt) || '}'
    ELSE 'known ' || a.prompt END AS reply
FROM asked a LEFT JOIN known k ON a.prompt = k.prompt""",
    "rendered_prompts": f"""
WITH {ENC}
SELECT document_id,
  md5({_filled(EXTRACTION_PROMPT, note="text")}) AS extraction,
  md5({_filled(AMBIGUITY_PROMPT, entities="entities", source="text")}) AS ambiguity
FROM enc""",
}
