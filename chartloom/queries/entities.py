"""Completeness, paths, checks and scores of entities."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.functions.jsonval import completeness, leaf_counts
from chartloom.functions.scores import confidence_value
from chartloom.operators import entities as en
from chartloom.operators import validate as va
from chartloom.plans import silver
from chartloom.queries.inputs import ENC, encounters, table


def completeness_by_document(spark, sf):
    counted = encounters(spark, sf).select(
        "document_id", "entities", leaf_counts(F.col("entities")).alias("leaves")
    )
    return counted.select(
        "document_id",
        F.col("leaves.total").cast("bigint").alias("total"),
        F.col("leaves.filled").cast("bigint").alias("filled"),
        F.round(completeness(F.col("entities")), 6).alias("completeness"),
    )


def entity_counts(spark, sf):
    counts = en.entity_counts(encounters(spark, sf), "document_id")
    return counts.select(
        "document_id",
        *[F.col(c).cast("bigint").alias(c) for c in counts.columns if c != "document_id"],
    )


def leaf_rows(spark, sf):
    leaves = en.flatten_leaves(encounters(spark, sf), "document_id")
    return leaves.withColumn("field", F.regexp_replace("path", r"\[\d+\]", "[]")).groupBy(
        "field"
    ).agg(
        F.count(F.lit(1)).alias("leaves"),
        F.count_if("is_empty").alias("empty"),
        F.min("value").alias("lowest"),
        F.max("value").alias("highest"),
    )


def read_paths(spark, sf):
    path = (
        F.when(F.col("k") % 4 == 0, "chief_complaint")
        .when(F.col("k") % 4 == 1, "symptoms[0].severity")
        .when(F.col("k") % 4 == 2, "vital_signs.temperature")
        .otherwise("medications.7.name")
    )
    docs = encounters(spark, sf).select("document_id", "entities", path.alias("path"))
    return en.read_paths(docs, "entities", "path").select("document_id", "path", "value")


def _older_keys(spark, sf) -> DataFrame:
    """Every second document with the older key names."""
    old = F.col("entities")
    for current, former in (
        ('"symptom":', '"name":'), ('"onset":', '"duration":'), ('"icd10_code":', '"icd10":'),
        ('"cpt_code":', '"cpt":'),
    ):
        old = F.replace(old, F.lit(current), F.lit(former))
    return encounters(spark, sf).select(
        "document_id", F.when(F.col("k") % 2 == 0, old).otherwise(F.col("entities")).alias("entities")
    )


def normalised_keys(spark, sf):
    e = F.col("entity")
    return en.normalise_entities(_older_keys(spark, sf)).select(
        "document_id",
        F.get(e["symptoms"], F.lit(0))["symptom"].alias("symptom"),
        F.get(e["symptoms"], F.lit(0))["onset"].alias("onset"),
        F.get(e["diagnoses"], F.lit(0))["icd10_code"].alias("icd10_code"),
        F.size(e["procedures"]).cast("bigint").alias("procedures"),
        e["extraction_confidence"].alias("confidence"),
    )


def _checked(spark, sf) -> DataFrame:
    docs = encounters(spark, sf).drop("entity")
    checked = va.coherence(va.grounding(en.normalise_entities(docs)))
    scored = checked.withColumn("completeness", completeness(F.col("entities")))
    return va.overall_quality(scored)


def grounding(spark, sf):
    docs = encounters(spark, sf).select("document_id", "text", "entity")
    return va.grounding(docs).select(
        "document_id",
        F.col("total_values").cast("bigint").alias("total_values"),
        F.col("grounded_values").cast("bigint").alias("grounded_values"),
        F.array_join("hallucinations", ";").alias("hallucinations"),
        F.round("accuracy_score", 6).alias("accuracy_score"),
        F.col("pass").alias("passed"),
    )


def document_passages(spark, sf):
    """Values cut from each document, and one made up, looked up in its whole text."""
    docs = table(spark, sf, "documents").select(
        "doc_id",
        "text",
        F.array(F.substring("text", 1, 40), F.substring("text", 11, 50),
                F.concat("lang", F.lit("-"), "source")).alias("values"),
    )
    missing = va.unfounded(F.col("values"), F.col("source"))
    return docs.withColumn("source", F.lower("text")).select(
        "doc_id", (F.size("values") - F.size(missing)).cast("bigint").alias("grounded"))


def coherence(spark, sf):
    docs = encounters(spark, sf).select("document_id", "entity")
    return va.coherence(docs).select(
        "document_id",
        F.array_join("contradictions", ";").alias("contradictions"),
        F.col("diagnosis_symptom_alignment").alias("alignment"),
        F.round("coherence_score", 6).alias("coherence_score"),
        "risk_level",
    )


def weighted_quality(spark, sf):
    return _checked(spark, sf).select(
        "document_id", F.round("overall_score", 6).alias("overall_score"), "grade",
        "overall_pass", "recommendation",
    )


def threshold_gate(spark, sf):
    scored = _checked(spark, sf).withColumn(
        "confidence", confidence_value(F.col("entity.extraction_confidence"))
    )
    gated = va.threshold_gate(
        scored,
        {
            "extraction_confidence": "confidence",
            "entity_validation": "accuracy_score",
            "coherence_score": "coherence_score",
            "overall_quality": "overall_score",
        },
    )
    return gated.select("document_id", F.array_join("reject_reasons", ";").alias("reasons"))


def validation_gate(spark, sf):
    """Verdicts from labels, with true as a word and as a value."""
    labels = table(spark, sf, "labels")
    passed = (
        F.when((F.col("quality") == 1) & (F.col("doc_id") % 2 == 0), '"pass": true')
        .when(F.col("quality") == 1, '"pass": "true"')
        .when(F.col("toxic") == 1, '"issues": []')
        .otherwise('"pass": false')
    )
    verdicts = labels.select(
        "doc_id", F.concat(F.lit('{"accuracy_score": 0.9, '), passed, F.lit("}")).alias("validation")
    )
    return va.validation_gate(verdicts).select("doc_id")


def gold_validated(spark, sf):
    docs = encounters(spark, sf).select(F.col("document_id").alias("path"), "text", "entities")
    kept = silver.gold_validated(docs)
    return kept.select(
        "path",
        F.round(F.get_json_object("validation", "$.accuracy_score").cast("double"), 6)
        .alias("accuracy_score"),
        F.json_array_length(F.get_json_object("validation", "$.issues"))
        .cast("bigint").alias("issues"),
    )


def documents_as_parsed(spark, sf) -> DataFrame:
    return table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("document_id"),
        F.col("source").alias("path"),
        "text",
        F.lit("[]").alias("sections"),
        (F.col("doc_id") % 10 / 10).alias("parse_quality_score"),
    )


def odd_extraction(df: DataFrame) -> DataFrame:
    """Entities with every kind of trouble, by document id."""
    number = F.col("document_id").cast("bigint")
    return df.withColumn(
        "entities",
        F.when(number % 13 == 0, F.lit(None).cast("string"))
        .when(number % 11 == 0, '{"error": "API timeout"}')
        .when(number % 7 == 0, '{"chief_complaint": "medication error"}')
        .otherwise('{"chief_complaint": "cough"}'),
    )


def silver_entities(spark, sf):
    kept = silver.extracted_entities(documents_as_parsed(spark, sf), odd_extraction)
    return kept.select("document_id", "path", "extracted_entities")


def silver_entities_legacy(spark, sf):
    kept = silver.extracted_entities(
        documents_as_parsed(spark, sf), odd_extraction, legacy_error_match=True
    )
    return kept.select("document_id", "path", "extracted_entities")


def expectation_counts(spark, sf):
    made = silver.candidates(documents_as_parsed(spark, sf), odd_extraction)
    return va.expectation_counts(made, va.extraction_rules("extracted_entities"))


def quarantine(spark, sf):
    marked = silver.with_quarantine(documents_as_parsed(spark, sf), odd_extraction)
    return marked.filter(~F.col("kept")).select(
        "document_id", F.array_join("failed_rules", ";").alias("failed_rules")
    )


QUERIES: dict[str, Callable] = {
    fn.__name__: fn
    for fn in (
        completeness_by_document, entity_counts, leaf_rows, read_paths, normalised_keys,
        grounding, document_passages, coherence, weighted_quality, threshold_gate,
        validation_gate, gold_validated, silver_entities, silver_entities_legacy,
        expectation_counts, quarantine,
    )
}

# Leaves of an entity document: fixed ones, and those of each list item.
LEAVES = """
leaves AS (
  SELECT *,
    10 + 4 * len(e.symptoms) + 3 * len(e.diagnoses) + 4 * len(e.medications)
      + 2 * len(e.procedures) + len(e.allergies) AS total,
    len(list_filter(
      list_concat([e.chief_complaint, e.extraction_confidence, e.vital_signs.blood_pressure,
          e.vital_signs.temperature, e.vital_signs.heart_rate, e.vital_signs.respiratory_rate,
          e.vital_signs.oxygen_saturation, e.social_history.smoking, e.social_history.alcohol,
          e.social_history.occupation],
        flatten([[s.symptom, s.onset, s.severity, s.location] FOR s IN e.symptoms]),
        flatten([[d.diagnosis, d.icd10_code, d.status] FOR d IN e.diagnoses]),
        flatten([[m.name, m.dosage, m.frequency, m.route] FOR m IN e.medications]),
        flatten([[p.procedure, p.cpt_code] FOR p IN e.procedures]), e.allergies),
      lambda v: v IS NOT NULL AND v <> '')) AS filled
  FROM enc
)"""
_CHECKED = """
stated AS (
  SELECT *, list_filter(list_concat([e.chief_complaint], [s.symptom FOR s IN e.symptoms],
      [d.diagnosis FOR d IN e.diagnoses], [m.name FOR m IN e.medications],
      [m.dosage FOR m IN e.medications], [p.procedure FOR p IN e.procedures],
      [e.vital_signs.blood_pressure, e.vital_signs.temperature, e.vital_signs.heart_rate,
       e.vital_signs.respiratory_rate, e.vital_signs.oxygen_saturation], e.allergies),
    lambda v: v IS NOT NULL AND v <> '') AS vals
  FROM leaves
), wrong AS (
  SELECT *, list_filter(vals, lambda v: NOT contains(lower(text), lower(v))) AS missing FROM stated
), acc AS (
  SELECT *, CASE WHEN len(vals) > 0 THEN (len(vals) - len(missing))::DOUBLE / len(vals)
    ELSE 1::DOUBLE END AS accuracy,
    list_filter([CASE WHEN len(e.medications) > 0 AND len(e.diagnoses) = 0
        THEN 'medication_without_diagnosis' END,
      CASE WHEN len(e.procedures) > 0 AND len(e.diagnoses) = 0
        THEN 'procedure_without_diagnosis' END], lambda c: c IS NOT NULL) AS contradictions,
    CASE WHEN len(e.diagnoses) = 0 AND len(e.symptoms) > 0 THEN 'misaligned'
      WHEN len(e.diagnoses) > 0 AND len(e.symptoms) = 0 THEN 'partial' ELSE 'aligned' END AS alignment
  FROM wrong
), coh AS (
  SELECT *, greatest(1::DOUBLE - 0.3::DOUBLE * len(contradictions)
    - CASE alignment WHEN 'misaligned' THEN 0.2::DOUBLE WHEN 'partial' THEN 0.1::DOUBLE
      ELSE 0::DOUBLE END
    - CASE WHEN len(list_filter(e.medications, lambda m: coalesce(m.dosage, '') = '')) > 0
      THEN 0.1::DOUBLE ELSE 0::DOUBLE END, 0::DOUBLE) AS coherence
  FROM acc
), scored AS (
  SELECT *, 0.5::DOUBLE * accuracy + 0.3::DOUBLE * coherence
    + 0.2::DOUBLE * (filled::DOUBLE / total) AS overall
  FROM coh
)"""
CHECKED = f"WITH {ENC}, {LEAVES}, {_CHECKED}"

_LEAF_FIELDS = (
    [("chief_complaint", "e.chief_complaint", None),
     ("extraction_confidence", "e.extraction_confidence", None)]
    + [(f"vital_signs.{v}", f"e.vital_signs.{v}", None) for v in (
        "blood_pressure", "temperature", "heart_rate", "respiratory_rate", "oxygen_saturation")]
    + [(f"social_history.{v}", f"e.social_history.{v}", None)
       for v in ("smoking", "alcohol", "occupation")]
    + [(f"symptoms[].{v}", f"x.{v}", "symptoms")
       for v in ("symptom", "onset", "severity", "location")]
    + [(f"diagnoses[].{v}", f"x.{v}", "diagnoses") for v in ("diagnosis", "icd10_code", "status")]
    + [(f"medications[].{v}", f"x.{v}", "medications")
       for v in ("name", "dosage", "frequency", "route")]
    + [(f"procedures[].{v}", f"x.{v}", "procedures") for v in ("procedure", "cpt_code")]
    + [("allergies[]", "x", "allergies")]
)


def _leaf_union() -> str:
    parts = []
    for field, value, items in _LEAF_FIELDS:
        source = "enc" if items is None else f"(SELECT unnest(e.{items}) AS x FROM enc)"
        parts.append(f"SELECT '{field}' AS field, {value} AS v FROM {source}")
    return " UNION ALL ".join(parts)


ODD = """
odd AS (
  SELECT doc_id, source, CASE WHEN doc_id % 13 = 0 THEN NULL
    WHEN doc_id % 11 = 0 THEN '{"error": "API timeout"}'
    WHEN doc_id % 7 = 0 THEN '{"chief_complaint": "medication error"}'
    ELSE '{"chief_complaint": "cough"}' END AS x
  FROM documents WHERE doc_id % 10 > 7
)"""

ORACLES: dict[str, str] = {
    "completeness_by_document": f"""
WITH {ENC}, {LEAVES}
SELECT document_id, total, filled, round(filled::DOUBLE / total, 6) AS completeness FROM leaves""",
    "entity_counts": f"""
WITH {ENC}
SELECT document_id, len(e.symptoms) AS num_symptoms, len(e.diagnoses) AS num_diagnoses,
  len(e.medications) AS num_medications FROM enc""",
    "leaf_rows": f"""
WITH {ENC}, l AS ({_leaf_union()})
SELECT field, count(*) AS leaves, count(*) FILTER (WHERE coalesce(v, '') = '') AS empty,
  min(v) AS lowest, max(v) AS highest FROM l GROUP BY field""",
    "read_paths": f"""
WITH {ENC}
SELECT document_id, CASE k % 4 WHEN 0 THEN 'chief_complaint' WHEN 1 THEN 'symptoms[0].severity'
    WHEN 2 THEN 'vital_signs.temperature' ELSE 'medications.7.name' END AS path,
  CASE k % 4 WHEN 0 THEN e.chief_complaint WHEN 1 THEN e.symptoms[1].severity
    WHEN 2 THEN e.vital_signs.temperature END AS value
FROM enc""",
    "normalised_keys": f"""
WITH {ENC}
SELECT document_id, e.symptoms[1].symptom AS symptom, e.symptoms[1].onset AS onset,
  e.diagnoses[1].icd10_code AS icd10_code, len(e.procedures) AS procedures,
  e.extraction_confidence AS confidence FROM enc""",
    "grounding": f"""
{CHECKED}
SELECT document_id, len(vals) AS total_values, len(vals) - len(missing) AS grounded_values,
  array_to_string(missing, ';') AS hallucinations, round(accuracy, 6) AS accuracy_score,
  accuracy >= 0.75 AS passed FROM scored""",
    "document_passages": """
SELECT doc_id, len(list_filter([text[1:40], text[11:60], lang || '-' || source],
  lambda v: contains(lower(text), lower(v)))) AS grounded
FROM documents""",
    "coherence": f"""
{CHECKED}
SELECT document_id, array_to_string(contradictions, ';') AS contradictions, alignment,
  round(coherence, 6) AS coherence_score,
  CASE WHEN len(contradictions) > 0 THEN 'high' WHEN coherence < 0.9::DOUBLE THEN 'medium'
    ELSE 'low' END AS risk_level
FROM scored""",
    "weighted_quality": f"""
{CHECKED}
SELECT document_id, round(overall, 6) AS overall_score,
  CASE WHEN overall >= 0.9::DOUBLE THEN 'excellent' WHEN overall >= 0.75::DOUBLE THEN 'good'
    WHEN overall >= 0.6::DOUBLE THEN 'fair' ELSE 'poor' END AS grade,
  overall >= 0.75::DOUBLE AS overall_pass,
  CASE WHEN overall >= 0.75::DOUBLE THEN 'approve' WHEN overall >= 0.6::DOUBLE THEN 'review'
    ELSE 'reject' END AS recommendation
FROM scored""",
    "threshold_gate": f"""
{CHECKED}
SELECT document_id, array_to_string(list_filter([
    CASE WHEN e.extraction_confidence = 'low' THEN 'extraction_confidence' END,
    CASE WHEN accuracy < 0.75::DOUBLE THEN 'entity_validation' END,
    CASE WHEN coherence < 0.7::DOUBLE THEN 'coherence_score' END,
    CASE WHEN overall < 0.75::DOUBLE THEN 'overall_quality' END], lambda r: r IS NOT NULL), ';')
  AS reasons
FROM scored""",
    "validation_gate": "SELECT doc_id FROM labels WHERE quality = 1",
    "gold_validated": f"""
{CHECKED}
SELECT document_id AS path, round(accuracy, 6) AS accuracy_score, len(missing) AS issues
FROM scored WHERE accuracy >= 0.75""",
    "silver_entities": f"""
WITH {ODD}
SELECT doc_id::VARCHAR AS document_id, source AS path, x AS extracted_entities
FROM odd WHERE x IS NOT NULL AND json_extract_string(x, '$.error') IS NULL""",
    "silver_entities_legacy": f"""
WITH {ODD}
SELECT doc_id::VARCHAR AS document_id, source AS path, x AS extracted_entities
FROM odd WHERE x IS NOT NULL AND x NOT LIKE '%error%'""",
    "expectation_counts": f"""
WITH {ODD}
SELECT count(*) AS total,
  count(*) FILTER (WHERE x IS NOT NULL AND json_extract_string(x, '$.error') IS NULL) AS kept,
  count(*) FILTER (WHERE x IS NULL) AS failed_has_entities,
  count(*) FILTER (WHERE json_extract_string(x, '$.error') IS NOT NULL)
    AS failed_no_extraction_errors
FROM odd""",
    "quarantine": f"""
WITH {ODD}
SELECT doc_id::VARCHAR AS document_id,
  CASE WHEN x IS NULL THEN 'has_entities' ELSE 'no_extraction_errors' END AS failed_rules
FROM odd WHERE x IS NULL OR json_extract_string(x, '$.error') IS NOT NULL""",
}
