"""Parsed documents to extracted entities; the same steps on batch and stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartloom.operators.entities import extract_by_rules
from chartloom.operators.structure import quality_gate
from chartloom.operators.validate import (
    expect_or_drop,
    extraction_rules,
    split_expected,
    successful,
    validate_entities,
    validation_gate,
)
from chartloom.operators.entities import normalise_entities
from chartloom.schemas import SILVER_EXTRACTED_ENTITIES
from chartloom.sources.tables import conform, stamped

Extract = Callable[[DataFrame], DataFrame]


def candidates(
    parsed: DataFrame, extract: Extract = extract_by_rules, now: Column | None = None
) -> DataFrame:
    """Gate on parse quality, then extract: cheap filter first."""
    extracted = extract(quality_gate(parsed)).withColumnRenamed("entities", "extracted_entities")
    return conform(
        stamped(extracted, "extraction_timestamp", now), SILVER_EXTRACTED_ENTITIES
    )


def extracted_entities(
    parsed: DataFrame,
    extract: Extract = extract_by_rules,
    now: Column | None = None,
    observation=None,
    legacy_error_match: bool = False,
) -> DataFrame:
    """Candidates that meet both expectations."""
    rules = extraction_rules("extracted_entities", legacy_error_match)
    return expect_or_drop(candidates(parsed, extract, now), rules, observation)


def with_quarantine(
    parsed: DataFrame, extract: Extract = extract_by_rules, now: Column | None = None
) -> DataFrame:
    """All candidates with ``failed_rules`` and ``kept``, for one write that keeps the
    dropped rows next to the good ones."""
    rules = extraction_rules("extracted_entities")
    marked = split_expected(candidates(parsed, extract, now), rules)
    return marked.withColumn("kept", F.size("failed_rules") == 0)


def full_extract(parsed: DataFrame, extract: Extract = extract_by_rules) -> DataFrame:
    """All columns of the parsed documents plus ``entities``, successes only."""
    return successful(extract(parsed))


def simple_extract(parsed: DataFrame, extract: Extract = extract_by_rules) -> DataFrame:
    """``path, text, entities`` of every document, failures as error documents."""
    return extract(parsed).select("path", "text", "entities")


def gold_validated(extracted: DataFrame) -> DataFrame:
    """``path, text, entities, validation`` of the documents whose verdict passes."""
    checked = validate_entities(normalise_entities(extracted)).drop("entity")
    return validation_gate(checked)
