"""Column contracts of every table and nested value."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _struct(**fields) -> StructType:
    return StructType([StructField(k, v, True) for k, v in fields.items()])


def _strings(*names: str) -> StructType:
    return _struct(**{n: StringType() for n in names})


STR, INT, LONG, DBL, FLT, TS = (
    StringType(), IntegerType(), LongType(), DoubleType(), FloatType(), TimestampType(),
)

BINARY_FILE = _struct(path=STR, modificationTime=TS, length=LONG, content=BinaryType())
# A file of a folder, and when it changed, in milliseconds.
LISTED_FILE = _struct(path=STR, modified=LONG)

# One typed block of a document, in reading order.
ELEMENT = _struct(type=STR, text=STR, page_number=INT, html=STR)
ELEMENTS = ArrayType(ELEMENT)

# Element tree as a JSON document parser emits it.
ELEMENT_TREE = _struct(
    document=_struct(
        elements=ArrayType(
            _struct(
                bbox=ArrayType(_struct(coord=ArrayType(INT), page_id=INT)),
                content=STR,
                description=STR,
                id=INT,
                type=STR,
            )
        )
    )
)

DOCS_PARSED = _struct(path=STR, modificationTime=TS, length=LONG, parsed_content=STR)

PARSED_DOCUMENTS = _struct(
    document_id=STR, path=STR, ingestion_timestamp=TS, text=STR, sections=STR,
    tables=STR, metadata=STR, parse_quality_score=DBL, parse_errors=STR,
)

SILVER_EXTRACTED_ENTITIES = _struct(
    document_id=STR, path=STR, text=STR, sections=STR, extracted_entities=STR,
    extraction_timestamp=TS,
)
EXTRACTED_FULL = StructType(PARSED_DOCUMENTS.fields + [StructField("entities", STR)])
EXTRACTED_SIMPLE = _strings("path", "text", "entities")
PAGE_FIELDS = _struct(MRN=STR, PATIENT=STR, ENCOUNTER_DATE=STR, Notes=ArrayType(STR))
GOLD_VALIDATED = StructType(EXTRACTED_SIMPLE.fields + [StructField("validation", STR)])

_IDENTITY = _strings("mrn", "patient_name", "visit_date")

REVIEW_QUEUE = _struct(
    document_id=STR, entities=STR, source_text=STR, ambiguities=STR, questions=STR,
    status=STR, completeness_before=FLT, created_timestamp=TS, updated_timestamp=TS,
)
CLINICAL_SUMMARIES = _struct(
    document_id=STR, soap_note=STR, sections=STR, quality_metrics=STR, human_feedback=STR,
    completeness_before=FLT, completeness_after=FLT, improvement_delta=FLT,
    generation_timestamp=TS,
)
VALIDATED_ENTITIES = _struct(
    document_id=STR, updated_entities=STR, changes=STR, validation_score=FLT,
    human_verified_fields=INT, human_review_timestamp=TS,
)


def with_identity(contract: StructType) -> StructType:
    """The same gold table with patient identity columns in front."""
    return StructType(_IDENTITY.fields + contract.fields)


STATUS_LOG = _struct(document_id=STR, status=STR, updated_timestamp=TS)
ANSWERS = _struct(document_id=STR, question_id=STR, answer=STR, answered_at=TS)
RUN_METRICS = _struct(
    document_id=STR, stage=STR, metric=STR, value=DBL, start_time=TS,
)
REPLY_CACHE = _struct(prompt_hash=STR, reply=STR, cached_at=TS)

SYMPTOM = _strings("symptom", "onset", "severity", "location")
DIAGNOSIS = _strings("diagnosis", "icd10_code", "status")
MEDICATION = _strings("name", "dosage", "frequency", "route")
PROCEDURE = _strings("procedure", "cpt_code")
VITAL_SIGNS = _strings(
    "blood_pressure", "temperature", "heart_rate", "respiratory_rate", "oxygen_saturation"
)
SOCIAL_HISTORY = _strings("smoking", "alcohol", "occupation")

ENTITIES = _struct(
    chief_complaint=STR,
    symptoms=ArrayType(SYMPTOM),
    diagnoses=ArrayType(DIAGNOSIS),
    medications=ArrayType(MEDICATION),
    procedures=ArrayType(PROCEDURE),
    vital_signs=VITAL_SIGNS,
    allergies=ArrayType(STR),
    social_history=SOCIAL_HISTORY,
    extraction_confidence=STR,
    missing_information=ArrayType(STR),
)

# Reader for replies that use the older key names next to the current ones.
ENTITIES_ANY_KEYS = _struct(
    chief_complaint=STR,
    symptoms=ArrayType(
        _strings("symptom", "name", "onset", "duration", "severity", "location")
    ),
    diagnoses=ArrayType(_strings("diagnosis", "icd10_code", "icd10", "status")),
    medications=ArrayType(MEDICATION),
    procedures=ArrayType(_strings("procedure", "cpt_code", "cpt")),
    vital_signs=VITAL_SIGNS,
    allergies=ArrayType(STR),
    social_history=SOCIAL_HISTORY,
    extraction_confidence=STR,
    missing_information=ArrayType(STR),
)

AMBIGUITY = _strings(
    "id", "category", "field", "description", "clinical_importance", "clinical_reasoning"
)
QUESTION = _struct(
    id=STR, priority=INT, ambiguity_id=STR, field_to_update=STR, text=STR, context=STR,
    input_type=STR, options=ArrayType(STR), placeholder=STR, clinical_note=STR,
)
QUESTIONS_DOC = _struct(
    questions=ArrayType(QUESTION), total_questions=INT, estimated_review_time_seconds=INT
)
CHANGE = _strings("field", "old_value", "new_value", "source", "question_id")
PATCHED = _struct(document=STR, old_values=ArrayType(STR), new_values=ArrayType(STR))
INFERENCE = _struct(reply=STR, error=STR, error_kind=STR, attempts=INT, model=STR)
