"""Evidence for extracted values, facts left out, and negated findings."""

from __future__ import annotations

from pyspark.sql import functions as F

from chartloom.operators import evidence as ev
from chartloom.operators import validate as va
from chartloom.operators.entities import extract_by_rules, normalise_entities
from chartloom.queries.inputs import ENC, encounters


def _misspelt(spark, sf):
    """Notes in which some words are misspelt."""
    k = F.col("k")
    text = F.when(k % 5 == 0, F.replace("text", F.lit("chest pain"), F.lit("chest pian"))).otherwise(F.col("text"))
    text = F.when(k % 7 == 0, F.replace(text, F.lit("drug "), F.lit("durg "))).otherwise(text)
    return encounters(spark, sf).select("k", "document_id", "entity", text.alias("text"))


def evidence_spans(spark, sf):
    rows = ev.evidence(_misspelt(spark, sf), "document_id")
    return rows.select(
        "document_id", "kind", "value", "status", F.col("distance").cast("bigint").alias("distance"), "correction")


def evidence_by_kind(spark, sf):
    """How much of each kind of value is borne out, misspelt or made up."""
    rows = ev.evidence_counts(ev.evidence(_misspelt(spark, sf), "document_id"), "document_id")
    return rows.groupBy("kind").agg(*[F.sum(c).alias(c) for c in ("values", "stated", "near", "absent")])


def missing_facts(spark, sf):
    """What notes state and thinned-out entities leave out."""
    k = F.col("k")
    docs = normalise_entities(extract_by_rules(
        encounters(spark, sf).withColumnRenamed("entity", "given").drop("entities")), "entities", "found")
    given = F.col("given")
    thinned = F.struct(
        given["chief_complaint"].alias("chief_complaint"),
        F.filter(given["symptoms"], lambda s: k % 4 != 1).alias("symptoms"),
        F.transform(given["diagnoses"], lambda d: F.struct(
            F.when(k % 3 == 0, F.upper(d["diagnosis"])).otherwise(d["diagnosis"]).alias("diagnosis"))).alias("diagnoses"),
        F.filter(given["medications"], lambda m: k % 7 != 2).alias("medications"),
        F.filter(given["procedures"], lambda p: k % 16 != 0).alias("procedures"),
        given["allergies"].alias("allergies"))
    return ev.missing_facts(docs.withColumn("entity", thinned), "document_id")


def validation_verdicts(spark, sf):
    """The whole verdict on thinned-out entities of misspelt notes."""
    k = F.col("k")
    docs = _misspelt(spark, sf).withColumnRenamed("entity", "given")
    read = normalise_entities(extract_by_rules(docs), "entities", "found")
    given = F.col("given")
    thinned = given.withField("medications", F.filter(given["medications"], lambda m: k % 11 != 3))
    v = F.col("verdict")
    listed = lambda values, *names: F.array_join(F.transform(
        values, lambda x: F.concat_ws("=", *[x[n] for n in names])), ";")
    return ev.verdicts(read.withColumn("entity", thinned)).select(
        "document_id", F.round(v["accuracy_score"], 6).alias("accuracy_score"),
        v["counts"]["values"].cast("bigint").alias("values"), v["counts"]["near"].cast("bigint").alias("near"),
        listed(v["hallucinations"], "kind", "value").alias("hallucinations"),
        listed(v["corrections"], "value", "correction").alias("corrections"),
        listed(v["missing_critical"], "kind", "value").alias("missing"), v["pass"].alias("passed"))


# Notes by remainder: what they say of the two symptoms.
REVIEWS = (
    "Patient denies cough, fever and chest pain.",
    "No chest pain today, but cough persists. No other signs.",
    "Possible chest pain; cough was ruled out.",
    "Reports cough without fever. Later: no cough, no fever. Chest pain is absent.",
)


def _reviewed(spark, sf):
    k = F.col("k")
    said = F.element_at(F.array(*map(F.lit, REVIEWS)), (k % 4 + 1).cast("int"))
    text = F.concat(F.lit("Review of systems.\n"), said, F.lit(" Suspected condition "), (k % 50).cast("string"), F.lit("."))
    return encounters(spark, sf).select("document_id", "entity", text.alias("text"))


def negated_findings(spark, sf):
    rows = ev.judged_findings(_reviewed(spark, sf), "document_id")
    return rows.select("document_id", "finding", *[
        F.col(c).cast("bigint").alias(c) for c in ("mentions", "negated", "uncertain")], "status")


def coherence_with_text(spark, sf):
    """Coherence, with findings that the note denies counted as contradictions."""
    return va.coherence(_reviewed(spark, sf), text="text").select(
        "document_id", F.array_join("contradictions", ";").alias("contradictions"),
        F.round("coherence_score", 6).alias("coherence_score"), "risk_level")


QUERIES = {fn.__name__: fn for fn in (
    evidence_spans, evidence_by_kind, missing_facts, validation_verdicts, negated_findings, coherence_with_text)}

_VALUES = f"""
WITH {ENC},
noted AS (
  SELECT *, CASE WHEN k % 7 = 0 THEN replace(t, 'drug ', 'durg ') ELSE t END AS note
  FROM (SELECT *, CASE WHEN k % 5 = 0 THEN replace(text, 'chest pain', 'chest pian') ELSE text END AS t FROM enc)),
vals AS (
  SELECT document_id, note, unnest(
    [{{'kind': 'chief_complaint', 'value': e.chief_complaint}}]
    || [{{'kind': 'symptom', 'value': s.symptom}} FOR s IN e.symptoms]
    || [{{'kind': 'diagnosis', 'value': d.diagnosis}} FOR d IN e.diagnoses]
    || [{{'kind': 'medication', 'value': m.name}} FOR m IN e.medications]
    || [{{'kind': 'dosage', 'value': m.dosage}} FOR m IN e.medications]
    || [{{'kind': 'procedure', 'value': p.procedure}} FOR p IN e.procedures]
    || [{{'kind': 'allergy', 'value': a}} FOR a IN e.allergies]) AS v
  FROM noted),
given AS (
  SELECT document_id, v.kind AS kind, v.value AS value, lower(note) AS note,
    regexp_extract_all(lower(note), '[\\p{{L}}\\p{{N}}](?:[^\\s,;]*[\\p{{L}}\\p{{N}}%])?') AS words,
    greatest(1, floor(length(v.value) * 0.25)::INT) AS most,
    len(regexp_split_to_array(trim(v.value), '\\s+')) AS own,
    row_number() OVER () AS id
  FROM vals WHERE coalesce(trim(v.value), '') <> ''),
runs AS (
  SELECT id, value, most, i, size, array_to_string(words[i:i + size - 1], ' ') AS passage
  FROM (SELECT *, unnest(range(1, len(words) - size + 2)) AS i
        FROM (SELECT *, unnest([own - 1, own, own + 1]) AS size FROM given WHERE NOT contains(note, lower(value)))
        WHERE size > 0)),
near AS (
  SELECT id, d, passage FROM (SELECT *, levenshtein(lower(value), passage) AS d FROM runs) WHERE d <= most
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY d, i, size) = 1),
spans AS (
  SELECT document_id, kind, value,
    CASE WHEN contains(note, lower(value)) THEN 'stated' WHEN d IS NOT NULL THEN 'near' ELSE 'absent' END AS status,
    CASE WHEN contains(note, lower(value)) THEN 0 ELSE d END AS distance, passage AS correction
  FROM given LEFT JOIN near USING (id))"""

_REVIEW_ROWS = """
said(r, finding, mentions, negated, uncertain, status) AS (VALUES
  (0, 'cough', 1, 1, 0, 'negated'), (0, 'chest pain', 1, 1, 0, 'negated'),
  (1, 'cough', 1, 0, 0, 'affirmed'), (1, 'chest pain', 1, 1, 0, 'negated'),
  (2, 'cough', 1, 1, 0, 'negated'), (2, 'chest pain', 1, 0, 1, 'uncertain'),
  (3, 'cough', 2, 1, 0, 'affirmed'), (3, 'chest pain', 1, 1, 0, 'negated'))"""

ORACLES = {
    "evidence_spans": f"""{_VALUES}
SELECT document_id, kind, value, status, distance, correction FROM spans""",
    "evidence_by_kind": f"""{_VALUES}
SELECT kind, count(*) AS values, count(*) FILTER (status = 'stated') AS stated,
  count(*) FILTER (status = 'near') AS near, count(*) FILTER (status = 'absent') AS absent
FROM spans GROUP BY kind""",
    "missing_facts": f"""
WITH {ENC}
SELECT DISTINCT document_id, v.kind AS kind, v.value AS value
FROM (SELECT document_id, unnest(
    [{{'kind': 'symptom', 'value': s.symptom}} FOR s IN e.symptoms IF k % 4 = 1]
    || [{{'kind': 'medication', 'value': m.name}} FOR m IN e.medications IF k % 7 = 2 AND k % 13 <> 0]
    || [{{'kind': 'dosage', 'value': m.dosage}} FOR m IN e.medications IF k % 7 = 2 AND k % 13 <> 0 AND m.dosage IS NOT NULL]
    || [{{'kind': 'procedure', 'value': p.procedure}} FOR p IN e.procedures IF k % 16 = 0]) AS v FROM enc)""",
    "validation_verdicts": f"""{_VALUES},
kept AS (
  SELECT s.*, e, k FROM spans s JOIN enc USING (document_id)
  WHERE NOT (kind IN ('medication', 'dosage') AND k % 11 = 3)),
ranked AS (
  SELECT *, CASE kind WHEN 'chief_complaint' THEN 0 WHEN 'symptom' THEN 1 WHEN 'diagnosis' THEN 2
    WHEN 'medication' THEN 3 WHEN 'dosage' THEN 4 WHEN 'procedure' THEN 5 ELSE 6 END AS o FROM kept),
summed AS (
  SELECT document_id, count(*) AS n, count(*) FILTER (status = 'stated') AS held, count(*) FILTER (status = 'near') AS near,
    coalesce(string_agg(kind || '=' || value, ';' ORDER BY o) FILTER (status = 'absent'), '') AS hallucinations,
    coalesce(string_agg(value || '=' || correction, ';' ORDER BY o) FILTER (status = 'near'), '') AS corrections
  FROM ranked GROUP BY document_id),
lost AS (
  SELECT document_id, CASE WHEN (k % 11 = 3 OR k % 7 = 0) AND k % 13 <> 0 AND len(e.medications) > 0 THEN
    'medication=' || CASE WHEN k % 7 = 0 THEN replace(e.medications[1].name, 'drug ', 'durg ')
      ELSE e.medications[1].name END ELSE '' END AS missing FROM enc)
SELECT document_id, CASE WHEN n > 0 THEN round(held / n, 6) ELSE 1 END AS accuracy_score, coalesce(n, 0) AS values,
  coalesce(near, 0) AS near, coalesce(hallucinations, '') AS hallucinations, coalesce(corrections, '') AS corrections,
  missing, (CASE WHEN n > 0 THEN held / n ELSE 1 END) >= 0.75 AND missing = '' AS passed
FROM lost LEFT JOIN summed USING (document_id)""",
    "negated_findings": f"""
WITH {ENC}, {_REVIEW_ROWS}
SELECT document_id, finding, mentions, negated, uncertain, status
FROM (SELECT document_id, k, unnest([s.symptom FOR s IN e.symptoms]) AS finding FROM enc) JOIN said USING (finding)
WHERE r = k % 4
UNION ALL
SELECT document_id, unnest([d.diagnosis FOR d IN e.diagnoses]), 1, 0, 1, 'uncertain' FROM enc""",
    "coherence_with_text": f"""
WITH {ENC}, {_REVIEW_ROWS},
x AS (
  SELECT *, len(e.diagnoses) = 0 AS nd, len(e.symptoms) = 0 AS ns,
    len([m FOR m IN e.medications IF coalesce(m.dosage, '') = '']) > 0 AS untold,
    (SELECT count(*) FROM said WHERE r = k % 4 AND status = 'negated'
       AND list_contains([s.symptom FOR s IN e.symptoms], finding)) > 0 AS denied FROM enc),
y AS (
  SELECT *, list_filter([
      CASE WHEN len(e.medications) > 0 AND nd THEN 'medication_without_diagnosis' END,
      CASE WHEN len(e.procedures) > 0 AND nd THEN 'procedure_without_diagnosis' END,
      CASE WHEN denied THEN 'negated_finding' END], lambda c: c IS NOT NULL) AS c FROM x),
z AS (
  SELECT *, greatest(0, 1.0::DOUBLE - 0.3::DOUBLE * len(c) - CASE WHEN nd AND NOT ns THEN 0.2::DOUBLE
    WHEN NOT nd AND ns THEN 0.1::DOUBLE ELSE 0 END - CASE WHEN untold THEN 0.1::DOUBLE ELSE 0 END) AS score FROM y)
SELECT document_id, array_to_string(c, ';') AS contradictions, round(score, 6) AS coherence_score,
  CASE WHEN len(c) > 0 THEN 'high' WHEN score < 0.9 THEN 'medium' ELSE 'low' END AS risk_level
FROM z""",
}
