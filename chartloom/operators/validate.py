"""Checks on extracted entities: gates, expectations, grounding, coherence, scores."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from chartloom.config import QualityFloors
from chartloom.functions.jsonval import to_json
from chartloom.operators import settle
from chartloom.operators.evidence import contradicted
from chartloom.functions.scores import grade, recommendation, reject_reasons, weighted_quality


def succeeded(entities: str = "entities") -> Column:
    return F.get_json_object(F.col(entities), "$.error").isNull()


def successful(df: DataFrame, entities: str = "entities") -> DataFrame:
    return df.filter(succeeded(entities))


def failed(df: DataFrame, entities: str = "entities") -> DataFrame:
    return df.filter(~succeeded(entities))


def validation_gate(df: DataFrame, validation: str = "validation") -> DataFrame:
    """Rows whose verdict passes; ``true`` and ``"true"`` both count."""
    return df.filter(F.get_json_object(F.col(validation), "$.pass") == "true")


def extraction_rules(column: str, legacy_error_match: bool = False) -> dict[str, str]:
    """The two expectations on extracted entities.

    The second looks at the ``error`` field; the older form drops every document
    with the word "error" in it, clean ones too, and is there for comparison.
    """
    if legacy_error_match:
        no_error = f"{column} NOT LIKE '%error%'"
    else:
        no_error = f"get_json_object({column}, '$.error') IS NULL"
    return {"has_entities": f"{column} IS NOT NULL", "no_extraction_errors": no_error}


def _holds(condition: str) -> Column:
    return F.coalesce(F.expr(condition), F.lit(False))


def expect_or_drop(
    df: DataFrame, rules: Mapping[str, str], observation: Observation | str | None = None
) -> DataFrame:
    """Keep the rows that meet every rule; unknown counts as not met.

    With an ``observation`` the rows and the failures per rule are counted in the
    same pass (an ``Observation`` on a batch, a name on a stream).
    """
    if observation is not None:
        counts = [
            F.sum(F.when(_holds(c), 0).otherwise(1)).alias(f"failed_{name}")
            for name, c in rules.items()
        ]
        df = df.observe(observation, F.count(F.lit(1)).alias("total"), *counts)
    for condition in rules.values():
        df = df.filter(_holds(condition))
    return df


def split_expected(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """All rows, with the names of the rules each one breaks."""
    broken = [F.when(~_holds(c), F.lit(name)) for name, c in rules.items()]
    return df.withColumn("failed_rules", F.array_compact(F.array(*broken)))


def expectation_counts(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """One row: number of rows, kept rows and failures per rule."""
    every = F.lit(True)
    for condition in rules.values():
        every = every & _holds(condition)
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(every).alias("kept"),
        *[F.count_if(~_holds(c)).alias(f"failed_{name}") for name, c in rules.items()],
    )


def stated_values(entity: Column) -> Column:
    """Every value in the entities that a source text would have to contain."""
    vitals = entity["vital_signs"]
    groups = [
        F.array(entity["chief_complaint"]),
        F.transform(entity["symptoms"], lambda s: s["symptom"]),
        F.transform(entity["diagnoses"], lambda d: d["diagnosis"]),
        F.transform(entity["medications"], lambda m: m["name"]),
        F.transform(entity["medications"], lambda m: m["dosage"]),
        F.transform(entity["procedures"], lambda p: p["procedure"]),
        F.array(*[vitals[n] for n in (
            "blood_pressure", "temperature", "heart_rate", "respiratory_rate",
            "oxygen_saturation")]),
        entity["allergies"],
    ]
    return F.filter(F.concat(*groups), lambda v: v.isNotNull() & (v != ""))


def unfounded(values: Column, source: Column) -> Column:
    """Those of the values that a lower-cased source text does not hold, whatever their case."""
    held = F.coalesce(source, F.lit(""))
    return F.filter(values, lambda v: ~F.contains(held, F.lower(v)))


def grounding(
    df: DataFrame,
    text: str = "text",
    entity: str = "entity",
    floors: QualityFloors = QualityFloors(),
) -> DataFrame:
    """Check entities against their source text, row by row.

    Adds ``total_values``, ``grounded_values``, ``hallucinations``,
    ``accuracy_score`` (1.0 when nothing was stated) and ``pass``.
    """
    staged = df.withColumns(
        {"_values": stated_values(F.col(entity)), "_source": F.lower(F.col(text))}
    )
    missing = unfounded(F.col("_values"), F.col("_source"))
    checked = staged.withColumn("hallucinations", missing).withColumns(
        {
            "total_values": F.size("_values"),
            "grounded_values": F.size("_values") - F.size("hallucinations"),
        }
    )
    accuracy = F.when(
        F.col("total_values") > 0,
        F.col("grounded_values").cast("double") / F.col("total_values"),
    ).otherwise(F.lit(1.0))
    return (
        checked.withColumn("accuracy_score", accuracy)
        .withColumn("pass", F.col("accuracy_score") >= floors.entity_validation)
        .drop("_values", "_source")
    )


def verdict(accuracy: Column, issues: Column, passed: Column) -> Column:
    """Validation verdict document ``{accuracy_score, issues, pass}``."""
    return to_json(
        F.struct(accuracy.alias("accuracy_score"), issues.alias("issues"), passed.alias("pass"))
    )


def validate_entities(df: DataFrame, text: str = "text", entity: str = "entity") -> DataFrame:
    """Add the ``validation`` verdict computed by grounding."""
    checked = grounding(df, text, entity)
    judged = checked.withColumn(
        "validation",
        verdict(F.col("accuracy_score"), F.col("hallucinations"), F.col("pass")),
    ).drop("total_values", "grounded_values", "hallucinations", "accuracy_score", "pass")
    return settle(judged, "validation")


def coherence(df: DataFrame, entity: str = "entity", text: str | None = None) -> DataFrame:
    """Logical consistency of the entities by rule, and with their source ``text`` if it is named:
    findings that it negates throughout are a contradiction.

    Adds ``contradictions``, ``diagnosis_symptom_alignment``, ``coherence_score``
    and ``risk_level``.
    """
    e = F.col(entity)
    no_diagnosis, no_symptom = F.size(e["diagnoses"]) == 0, F.size(e["symptoms"]) == 0
    untold_dose = F.exists(
        e["medications"], lambda m: F.coalesce(m["dosage"], F.lit("")) == ""
    )
    denied = F.lit(False) if text is None else F.size(contradicted(F.col(text), e)) > 0
    contradictions = F.array_compact(
        F.array(
            F.when((F.size(e["medications"]) > 0) & no_diagnosis, F.lit("medication_without_diagnosis")),
            F.when((F.size(e["procedures"]) > 0) & no_diagnosis, F.lit("procedure_without_diagnosis")),
            F.when(denied, F.lit("negated_finding")),
        )
    )
    alignment = (
        F.when(no_diagnosis & ~no_symptom, "misaligned")
        .when(~no_diagnosis & no_symptom, "partial")
        .otherwise("aligned")
    )
    score = (
        F.lit(1.0)
        - F.lit(0.3) * F.size("contradictions")
        - F.when(F.col("diagnosis_symptom_alignment") == "misaligned", F.lit(0.2))
        .when(F.col("diagnosis_symptom_alignment") == "partial", F.lit(0.1))
        .otherwise(F.lit(0.0))
        - F.when(untold_dose, F.lit(0.1)).otherwise(F.lit(0.0))
    )
    return (
        df.withColumns(
            {"contradictions": contradictions, "diagnosis_symptom_alignment": alignment}
        )
        .withColumn("coherence_score", F.greatest(score, F.lit(0.0)))
        .withColumn(
            "risk_level",
            F.when(F.size("contradictions") > 0, "high")
            .when(F.col("coherence_score") < 0.9, "medium")
            .otherwise("low"),
        )
    )


def overall_quality(
    df: DataFrame,
    accuracy: str = "accuracy_score",
    coherence: str = "coherence_score",
    completeness: str = "completeness",
    floors: QualityFloors = QualityFloors(),
) -> DataFrame:
    """Weighted score with grade, pass mark and recommendation."""
    scored = df.withColumn(
        "overall_score",
        weighted_quality(F.col(accuracy), F.col(coherence), F.col(completeness)),
    )
    score = F.col("overall_score")
    return settle(scored, "overall_score").withColumns(
        {
            "grade": grade(score),
            "overall_pass": score >= floors.overall_quality,
            "recommendation": recommendation(score, floors),
        }
    )


def threshold_gate(
    df: DataFrame, scores: Mapping[str, str], floors: QualityFloors = QualityFloors()
) -> DataFrame:
    """Add ``reject_reasons``; an empty array means that every floor is met.

    ``scores`` maps floor names to score columns.
    """
    limits = {name: getattr(floors, name) for name in scores}
    gated = df.withColumn(
        "reject_reasons",
        reject_reasons({name: F.col(c) for name, c in scores.items()}, limits),
    )
    return settle(gated, "reject_reasons")
