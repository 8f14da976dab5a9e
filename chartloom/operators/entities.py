"""Clinical entities: extraction, key normalisation, completeness, paths."""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartloom.functions.jsonedit import patched
from chartloom.functions.jsonval import array_size, read_path, to_json
from chartloom.functions.text import filled, is_blank, labelled_value, mentions, strip, truncate
from chartloom.operators import settle, unnest
from chartloom.operators.infer import Backend, infer, infer_distinct, render_prompt, reply_document
from chartloom.schemas import ENTITIES, ENTITIES_ANY_KEYS

# Fixed value: what a text without a note extracts to.
SHORT_TEXT_ENTITIES = json.dumps(
    {
        "chief_complaint": "",
        "symptoms": [],
        "diagnoses": [],
        "medications": [],
        "procedures": [],
        "vital_signs": {},
        "extraction_confidence": "low",
    }
)
# Fixed value: what an unreadable reply becomes in the page-wise batch run.
UNREADABLE_ENTITIES = json.dumps(
    {
        "chief_complaint": "",
        "symptoms": [],
        "diagnoses": [],
        "medications": [],
        "vital_signs": {},
        "allergies": [],
        "extraction_confidence": 0.5,
    }
)

EXTRACTION_PROMPT = (
    "Read the encounter note and list what it states, nothing more.\n\n"
    "NOTE:\n{note}\n\n"
    "Answer with one JSON object with the keys chief_complaint, symptoms (symptom, onset, "
    "severity, location), diagnoses (diagnosis, icd10_code, status), medications (name, "
    "dosage, frequency, route), procedures (procedure, cpt_code), vital_signs "
    "(blood_pressure, temperature, heart_rate, respiratory_rate, oxygen_saturation), "
    "allergies, social_history (smoking, alcohol, occupation), extraction_confidence "
    "(high, medium or low) and missing_information. Use null for what is not stated.\n"
)


def extract_with_model(
    df: DataFrame,
    backend: Backend,
    text: str = "text",
    output: str = "entities",
    distinct: bool = False,
    limit: int | None = None,
    **options,
) -> DataFrame:
    """Entity JSON per document from a model; blank texts are not sent.

    The whole text is sent, or its first ``limit`` characters.  The cheap guard runs first;
    failures come back as error documents.
    """
    note = truncate(F.col(text), limit)
    prompt = F.when(~is_blank(F.col(text)), render_prompt(EXTRACTION_PROMPT, note=note))
    call = infer_distinct if distinct else infer
    asked = call(df.withColumn("_prompt", prompt), "_prompt", backend, "_inference", **options)
    answered = asked.withColumn(
        output,
        F.when(F.col("_prompt").isNull(), F.lit(SHORT_TEXT_ENTITIES)).otherwise(
            reply_document(F.col("_inference"))
        ),
    ).drop("_prompt", "_inference")
    return settle(answered, output)


MEDICATION = r"^(.*?)(?:\s+(\d[\d.]*\s?(?:mcg|mg|g|ml|units?)))?(?:\s+(QD|BID|TID|QID|PRN|daily))?$"
ORDERED = r"(?i)^(.*?)\s+(?:ordered|done|performed)$|^(.*)$"


def _listed(value: Column, separator: str) -> Column:
    items = F.transform(F.split(value, separator), strip)
    return F.coalesce(F.filter(items, lambda v: v != ""), F.array().cast("array<string>"))


def _entities_of_note(text: Column, upper: Column, complaint: Column, assessed: Column) -> Column:
    """Entities that a labelled note, also given in upper case, states, as a struct."""
    def value(label: str) -> Column:
        return labelled_value(text, label, upper=upper)

    def vital(pattern: str) -> Column:
        word = re.search(r"\\b(\w+):", pattern)[1]
        return F.when(mentions(upper, word), filled(F.regexp_extract(text, pattern, 1)))

    null = F.lit(None).cast("string")

    def part(item: Column, group: int) -> Column:
        return filled(F.regexp_extract(item, MEDICATION, group))

    return F.struct(
        complaint.alias("chief_complaint"),
        F.transform(
            _listed(value("SYMPTOMS"), "[,;]"),
            lambda s: F.struct(
                s.alias("symptom"), null.alias("onset"), null.alias("severity"),
                null.alias("location"),
            ),
        ).alias("symptoms"),
        F.transform(
            _listed(assessed, r"\."),
            lambda d: F.struct(
                d.alias("diagnosis"), null.alias("icd10_code"),
                F.when(d.rlike("(?i)^rule out"), "differential")
                .when(d.rlike("(?i)likely|suspected|possible"), "suspected")
                .alias("status"),
            ),
        ).alias("diagnoses"),
        F.transform(
            _listed(value("MEDICATIONS"), "[,;]"),
            lambda m: F.struct(
                part(m, 1).alias("name"), part(m, 2).alias("dosage"),
                part(m, 3).alias("frequency"), null.alias("route"),
            ),
        ).alias("medications"),
        F.transform(
            F.filter(_listed(value("PLAN"), r"\."), lambda p: p.rlike("(?i) ordered$")),
            lambda p: F.struct(
                F.regexp_replace(p, "(?i) ordered$", "").alias("procedure"),
                null.alias("cpt_code"),
            ),
        ).alias("procedures"),
        F.struct(
            vital(r"\bBP: ?(\d+/\d+)").alias("blood_pressure"),
            vital(r"\bTemp: ?([\d.]+ ?°?[FC])").alias("temperature"),
            vital(r"\bHR: ?(\d+)").alias("heart_rate"),
            vital(r"\bRR: ?(\d+)").alias("respiratory_rate"),
            vital(r"\bSpO2: ?(\d+%)").alias("oxygen_saturation"),
        ).alias("vital_signs"),
        _listed(value("ALLERGIES"), "[,;]").alias("allergies"),
        F.struct(
            vital(r"(?i)\bsmoking: ?([^,;.\n]+)").alias("smoking"),
            vital(r"(?i)\balcohol: ?([^,;.\n]+)").alias("alcohol"),
            vital(r"(?i)\boccupation: ?([^,;.\n]+)").alias("occupation"),
        ).alias("social_history"),
        F.when(complaint.isNotNull() & assessed.isNotNull(), "high")
        .when(complaint.isNotNull() | assessed.isNotNull(), "medium")
        .otherwise("low")
        .alias("extraction_confidence"),
        F.array_compact(
            F.array(
                F.when(complaint.isNull(), F.lit("chief_complaint")),
                F.when(assessed.isNull(), F.lit("diagnoses")),
            )
        ).alias("missing_information"),
    )


def extract_by_rules(df: DataFrame, text: str = "text", output: str = "entities") -> DataFrame:
    """Entity JSON per document from label rules, without a model, wholly in the JVM."""
    note = F.col(text)
    upper = F.col("_upper")
    labelled = df.withColumn("_upper", F.upper(note)).withColumns(
        {
            "_complaint": labelled_value(note, "CHIEF COMPLAINT", upper=upper),
            "_assessed": labelled_value(note, "ASSESSMENT", upper=upper),
        }
    )
    found = _entities_of_note(note, upper, F.col("_complaint"), F.col("_assessed"))
    extracted = labelled.withColumn(
        output, F.when(is_blank(note), F.lit(SHORT_TEXT_ENTITIES)).otherwise(to_json(found))
    ).drop("_complaint", "_assessed", "_upper")
    return settle(extracted, output)


def _normalised(doc: Column) -> Column:
    def items(name: str, build) -> Column:
        return F.coalesce(F.transform(doc[name], build), F.array()).alias(name)

    return F.struct(
        doc["chief_complaint"].alias("chief_complaint"),
        items("symptoms", lambda s: F.struct(
            F.coalesce(s["symptom"], s["name"]).alias("symptom"),
            F.coalesce(s["onset"], s["duration"]).alias("onset"),
            s["severity"].alias("severity"),
            s["location"].alias("location"),
        )),
        items("diagnoses", lambda d: F.struct(
            d["diagnosis"].alias("diagnosis"),
            F.coalesce(d["icd10_code"], d["icd10"]).alias("icd10_code"),
            d["status"].alias("status"),
        )),
        items("medications", lambda m: m),
        items("procedures", lambda p: F.struct(
            p["procedure"].alias("procedure"),
            F.coalesce(p["cpt_code"], p["cpt"]).alias("cpt_code"),
        )),
        doc["vital_signs"].alias("vital_signs"),
        F.coalesce(doc["allergies"], F.array()).alias("allergies"),
        doc["social_history"].alias("social_history"),
        doc["extraction_confidence"].alias("extraction_confidence"),
        F.coalesce(doc["missing_information"], F.array()).alias("missing_information"),
    ).cast(ENTITIES)


def normalise_entities(
    df: DataFrame, entities: str = "entities", output: str = "entity"
) -> DataFrame:
    """Entity JSON under either set of key names to the one entity struct.

    The JSON is parsed once, into a column of its own.
    """
    parsed = df.withColumn("_any", F.from_json(entities, ENTITIES_ANY_KEYS))
    return parsed.withColumn(output, _normalised(F.col("_any"))).drop("_any")


def entity_counts(df: DataFrame, *keys: str, entities: str = "entities") -> DataFrame:
    """Number of symptoms, diagnoses and medications per document."""
    doc = F.col(entities)
    return df.select(
        *keys,
        array_size(doc, "$.symptoms").alias("num_symptoms"),
        array_size(doc, "$.diagnoses").alias("num_diagnoses"),
        array_size(doc, "$.medications").alias("num_medications"),
    )


def flatten_leaves(
    df: DataFrame, *keys: str, entities: str = "entities", max_depth: int | None = None
) -> DataFrame:
    """One row per scalar leaf: ``keys, path, value, is_empty``.

    A document is opened level by level within its row, as often as it is deep itself; nothing
    is counted beforehand and nothing shuffled, so it works on streams too.  With
    ``max_depth``, something nested deeper is kept as one row that holds its JSON text.
    """
    depth = _depth(F.col(entities))
    levels = depth if max_depth is None else F.least(depth, F.lit(max_depth))

    def item(path: Column, node: Column, leaf: bool = False) -> Column:
        return F.struct(path.alias("path"), node.alias("node"), F.lit(leaf).alias("leaf"))

    def opened(held: Column) -> Column:
        """The children of a container, a leaf itself, which is marked and not opened again."""
        path, node = held["path"], held["node"]
        fields = F.map_entries(F.try_variant_get(node, "$", "map<string,variant>"))
        items = F.try_variant_get(node, "$", "array<variant>")
        place = lambda i: F.concat(path, F.lit("["), i.cast("string"), F.lit("]"))
        return F.when(held["leaf"], F.array(held)).otherwise(F.coalesce(
            F.transform(fields, lambda f: item(F.concat(path, F.lit("."), f["key"]), f["value"])),
            F.transform(items, lambda v, i: item(place(i), v)),
            F.array(item(path, node, leaf=True)),
        ))

    root = F.array(item(F.lit(""), F.col("_doc")))
    rounds = F.when(levels > 0, F.sequence(F.lit(1), levels)).otherwise(F.array().cast("array<int>"))
    leaves = F.aggregate(
        rounds, root, lambda held, _: F.flatten(F.transform(held, opened)))
    # parsed once; a text that is no JSON has no leaves
    read = df.withColumn("_doc", F.try_parse_json(entities))
    found = F.when(F.col("_doc").isNotNull(), leaves)
    level = unnest(read.select(*keys, found.alias("_leaves")), "_leaves", *keys, item="leaf").select(*keys, "leaf.path", "leaf.node")
    value = F.try_variant_get("node", "$", "string")
    return level.select(
        *keys,
        F.regexp_replace("path", r"^\.", "").alias("path"),
        value.alias("value"),
        (F.coalesce(value, F.lit("")) == "").alias("is_empty"),
    )


def _depth(doc: Column) -> Column:
    """How deep the brackets of a JSON text are nested."""
    bare = F.regexp_replace(doc, r'(?:"(?:[^"\\]++|\\.)*+"|[^\[\]{}"]++|")++', "")
    brackets = F.split(bare, "")
    start = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))

    def step(held: Column, c: Column) -> Column:
        now = held["now"] + F.when(c.isin("[", "{"), 1).when(c.isin("]", "}"), -1).otherwise(0)
        return F.struct(now.alias("now"), F.greatest(held["most"], now).alias("most"))

    return F.aggregate(brackets, start, step, lambda held: held["most"])


def read_paths(df: DataFrame, entities: str, path: str, output: str = "value") -> DataFrame:
    """Value at a path given by a column; null when nothing is there."""
    return (
        df.withColumn("_doc", F.try_parse_json(entities))
        .withColumn(output, read_path(F.col("_doc"), F.col(path)))
        .drop("_doc")
    )


def apply_patches(entities: Column | str, patches: Column | str) -> Column:
    """Write a list of ``(path, value)`` into an entity JSON, as of :func:`jsonedit.patched`."""
    return patched(*[F.col(c) if isinstance(c, str) else c for c in (entities, patches)])
