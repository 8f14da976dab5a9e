"""Elements to sections, tables, metadata, full text and quality score.

A document's elements sit in one array, so no window or grouping is needed:
sections are slices between title positions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartloom.config import PARSE_QUALITY_MIN
from chartloom.functions.jsonval import array_size, to_json
from chartloom.functions.scores import parse_quality
from chartloom.operators import settle
from chartloom.operators.elements import LIST_ITEM, NARRATIVE, TABLE, TITLE


def add_sections(df: DataFrame) -> DataFrame:
    """``sections``: array of ``struct(title, content[])``.

    A title opens a section; narrative text and list items join it; everything
    before the first title and all other elements stay out.
    """
    elements = F.col("elements")
    titles = F.array_compact(
        F.transform(elements, lambda e, i: F.when(e["type"] == TITLE, i))
    )
    df = df.withColumn("_titles", titles)

    def section(start: Column, k: Column) -> Column:
        end = F.coalesce(F.get(F.col("_titles"), k + 1), F.size(elements))
        body = F.slice(elements, start + 2, end - start - 1)
        kept = F.filter(body, lambda e: e["type"].isin(NARRATIVE, LIST_ITEM))
        return F.struct(
            F.get(elements, start)["text"].alias("title"),
            F.transform(kept, lambda e: e["text"]).alias("content"),
        )

    return df.withColumn("sections", F.transform(F.col("_titles"), section)).drop("_titles")


def tables(elements: Column) -> Column:
    """Array of ``struct(data, type, text)``: HTML where known, else the text."""
    found = F.filter(elements, lambda e: e["type"] == TABLE)
    return F.transform(
        found,
        lambda e: F.struct(
            F.coalesce(e["html"], e["text"]).alias("data"),
            F.lit("clinical_data").alias("type"),
            e["text"].alias("text"),
        ),
    )


def metadata(elements: Column) -> Column:
    """``struct(num_pages, num_sections, num_tables, total_elements)``."""
    pages = F.filter(
        F.array_distinct(F.transform(elements, lambda e: e["page_number"])),
        lambda p: p.isNotNull() & (p != 0),
    )

    def count(kind: str) -> Column:
        return F.size(F.filter(elements, lambda e: e["type"] == kind))

    return F.struct(
        F.size(pages).alias("num_pages"),
        count(TITLE).alias("num_sections"),
        count(TABLE).alias("num_tables"),
        F.size(elements).alias("total_elements"),
    )


def full_text(elements: Column) -> Column:
    return F.array_join(F.transform(elements, lambda e: e["text"]), "\n")


def add_structure(df: DataFrame) -> DataFrame:
    """``elements`` to ``text, sections, tables, metadata, parse_quality_score``."""
    elements = F.col("elements")
    return (
        add_sections(df)
        .withColumn("text", full_text(elements))
        .withColumn("tables", tables(elements))
        .withColumn("metadata", metadata(elements))
        .withColumn(
            "parse_quality_score",
            parse_quality(
                F.col("text"), F.size("sections"), F.size("tables"),
                F.col("metadata.num_pages"),
            ),
        )
    )


def structure_as_json(df: DataFrame) -> DataFrame:
    """Nested results to the JSON strings that the bronze table holds."""
    return df.withColumns(
        {name: to_json(F.col(name)) for name in ("sections", "tables", "metadata")}
    )


def quality_gate(
    df: DataFrame, minimum: float = PARSE_QUALITY_MIN, computed: bool = False
) -> DataFrame:
    """Documents whose parse quality is strictly above the minimum.

    On a stored score the filter reaches the scan; say ``computed`` when the score was
    made in the same run, so that it is not made twice.
    """
    df = settle(df, "parse_quality_score") if computed else df
    return df.filter(F.col("parse_quality_score") > F.lit(float(minimum)))


def parse_report(parsed: DataFrame) -> DataFrame:
    """One line per parsed document for checking the parser's work."""
    return parsed.select(
        "document_id",
        F.col("parse_quality_score").alias("quality_score"),
        (F.length(F.coalesce("text", F.lit(""))) > 0).alias("has_text"),
        array_size(F.col("sections")).alias("num_sections"),
        array_size(F.col("tables")).alias("num_tables"),
        F.col("parse_errors").alias("errors"),
    )
