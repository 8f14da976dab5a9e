"""Sectioned notes: rendering from entities and splitting back into sections."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartloom.functions.jsonval import to_json
from chartloom.functions.text import filled, strip, word_count
from chartloom.operators.infer import change_summary, render_prompt

# Note sections in order, their markers, and the word for a gap.
SECTIONS = ("subjective", "objective", "assessment", "plan")
MARKERS = {name: f"**{name.upper()}**" for name in SECTIONS}
NOT_DOCUMENTED = "Not documented"
SECTIONS_TYPE = "struct<" + ",".join(f"{s}:string" for s in SECTIONS) + ">"

SOAP_PROMPT = (
    "Write a professional note with the sections **SUBJECTIVE**, **OBJECTIVE**, "
    "**ASSESSMENT** and **PLAN** from these validated entities. Say \"Not documented\" for "
    "what is missing and close with the number of fields a reviewer verified.\n\n"
    "ENTITIES:\n{entities}\n\nREVIEWED FIELDS ({count}):\n{changes}\n"
)


def _or_gap(value: Column) -> Column:
    return F.coalesce(filled(value), F.lit(NOT_DOCUMENTED))


def _filled(value: Column, prefix: str = "", suffix: str = "") -> Column:
    """Value with its label, null when there is none, so that joins skip it."""
    return F.when(
        F.coalesce(value, F.lit("")) != "", F.concat(F.lit(prefix), value, F.lit(suffix))
    )


def render_soap(entity: Column, verified_fields: Column) -> Column:
    """Note text from the entity struct."""
    e, vitals, social = entity, entity["vital_signs"], entity["social_history"]

    def lines(items: Column) -> Column:
        return _or_gap(F.array_join(items, "\n"))

    history = F.transform(
        e["symptoms"],
        lambda s: F.concat_ws(
            "",
            s["symptom"],
            _filled(s["onset"], ", onset "),
            _filled(s["severity"], ", "),
            _filled(s["location"], ", location "),
        ),
    )
    drugs = F.transform(
        e["medications"],
        lambda m: F.concat_ws(
            " ", m["name"], _filled(m["dosage"]), _filled(m["frequency"]), _filled(m["route"])
        ),
    )
    assessed = F.transform(
        e["diagnoses"],
        lambda d, i: F.concat_ws(
            "",
            (i + 1).cast("string"), F.lit(". "), d["diagnosis"],
            _filled(d["icd10_code"], " (", ")"), _filled(d["status"], " - "),
        ),
    )
    procedures = F.transform(
        e["procedures"], lambda p: F.concat_ws("", p["procedure"], _filled(p["cpt_code"], " (", ")"))
    )
    signs = F.concat_ws(
        ", ",
        _filled(vitals["blood_pressure"], "BP: "),
        _filled(vitals["heart_rate"], "HR: "),
        _filled(vitals["temperature"], "Temp: "),
        _filled(vitals["respiratory_rate"], "RR: "),
        _filled(vitals["oxygen_saturation"], "SpO2: "),
    )
    habits = F.concat_ws(
        ", ",
        _filled(social["smoking"], "smoking: "),
        _filled(social["alcohol"], "alcohol: "),
        _filled(social["occupation"], "occupation: "),
    )
    # Headings of the note.
    return F.concat(
        F.lit("**SUBJECTIVE**\n\nChief Complaint: "), _or_gap(e["chief_complaint"]),
        F.lit("\n\nHistory of Present Illness:\n"), lines(history),
        F.lit("\n\nMedications: "), _or_gap(F.array_join(drugs, "; ")),
        F.lit("\n\nAllergies: "), _or_gap(F.array_join(e["allergies"], ", ")),
        F.lit("\n\nSocial History: "), _or_gap(habits),
        F.lit("\n\n**OBJECTIVE**\n\nVital Signs:\n"), _or_gap(signs),
        F.lit("\n\nPhysical Examination:\n" + NOT_DOCUMENTED),
        F.lit("\n\n**ASSESSMENT**\n\n"), lines(assessed),
        F.lit("\n\n**PLAN**\n\nDiagnostics:\n"), lines(procedures),
        F.lit("\n\nTreatment:\n"), lines(drugs),
        F.lit("\n\nFollow-up:\n" + NOT_DOCUMENTED),
        F.lit("\n\nHuman-verified fields: "), verified_fields.cast("string"),
    )


def split_soap(df: DataFrame, note: str = "soap_note", output: str = "sections") -> DataFrame:
    """Add the note's sections as ``struct(subjective, objective, assessment, plan)``.

    A line with a marker opens its section and is not part of it; text before the first
    marker belongs nowhere; a marker without a line after it gives nothing; of a
    repeated section the last one stays.
    """
    lines = F.split(F.col(note), "\n")

    def section_of(line: Column) -> Column:
        name = F.when(F.contains(line, F.lit(MARKERS[SECTIONS[0]])), SECTIONS[0])
        for other in SECTIONS[1:]:
            name = name.when(F.contains(line, F.lit(MARKERS[other])), other)
        return name

    opened = F.filter(
        F.transform(
            F.col("_lines"), lambda line, i: F.struct(section_of(line).alias("name"), i.alias("i"))
        ),
        lambda m: m["name"].isNotNull(),
    )

    def body(mark: Column, k: Column) -> Column:
        end = F.coalesce(F.get(F.col("_marks"), k + 1)["i"], F.size("_lines"))
        inside = F.slice(F.col("_lines"), mark["i"] + 2, end - mark["i"] - 1)
        return F.struct(
            mark["name"].alias("name"),
            F.when(F.size(inside) > 0, strip(F.array_join(inside, "\n"))).alias("text"),
        )

    staged = (
        df.withColumn("_lines", lines)
        .withColumn("_marks", opened)
        .withColumn("_bodies", F.transform("_marks", body))
    )

    def last(name: str) -> Column:
        kept = F.filter("_bodies", lambda b: (b["name"] == name) & b["text"].isNotNull())
        return F.try_element_at(kept, F.lit(-1))["text"].alias(name)

    return staged.withColumn(output, F.struct(*[last(s) for s in SECTIONS])).drop(
        "_lines", "_marks", "_bodies"
    )


def soap_quality(sections: Column) -> Column:
    """Share of a note's four sections that say something."""
    said = [F.when(F.coalesce(F.trim(sections[n]), F.lit("")) != "", 1).otherwise(0)
            for n in ("subjective", "objective", "assessment", "plan")]
    return reduce(Column.__add__, said) / F.lit(len(said))


def sections_document(sections: Column) -> Column:
    """Sections as JSON with only the names that are present."""
    return F.to_json(sections)


def soap_prompt(entities: Column, changes: Column) -> Column:
    return render_prompt(
        SOAP_PROMPT, entities=entities, count=F.size(changes), changes=change_summary(changes)
    )


def model_note(inference: Column) -> Column:
    """Note from a model's reply; a failed call gives an ``Error`` note."""
    return F.when(
        inference["error_kind"].isNotNull(),
        F.concat(F.lit("Error generating SOAP note: "), inference["error"]),
    ).otherwise(inference["reply"])


def quality_metrics(now: Column) -> Column:
    """Quality metrics document of a note from the row's measures."""
    return to_json(
        F.struct(
            F.col("completeness_after").alias("completeness_score"),
            "completeness_before",
            "improvement_delta",
            F.col("fields_attempted").alias("human_verified_fields"),
            word_count(F.col("soap_note")).alias("word_count"),
            F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss").alias("generation_timestamp"),
        )
    )


def generate_notes(df: DataFrame, entity: str = "entity") -> DataFrame:
    """Add ``soap_note`` and ``sections``; ``fields_attempted`` must be there."""
    noted = df.withColumn("soap_note", render_soap(F.col(entity), F.col("fields_attempted")))
    return split_soap(noted)
