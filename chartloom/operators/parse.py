"""File bytes to the bronze ``parsed_documents`` rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from chartloom.functions.ids import content_id
from chartloom.functions.jsonval import to_json
from chartloom.operators.elements import element_tree, html_elements, text_elements
from chartloom.operators.structure import add_structure
from chartloom.schemas import ELEMENTS, PARSED_DOCUMENTS

# A parser of one file: bytes in, element dictionaries out
# (type, text, page_number, html).  Built once per task by its factory.
FileParser = Callable[[bytes], list[dict]]

_PARSED = StructType(
    [
        StructField("elements", ELEMENTS),
        StructField("parser", StringType()),
        StructField("parse_errors", StringType()),
    ]
)


def _decoded(to_elements: Callable[[Column], Column], name: str) -> Callable[[Column], Column]:
    """Parser in pure expressions: UTF-8 bytes to elements, or an error message."""
    def parse(content: Column) -> Column:
        text = F.try_validate_utf8(content.cast("string"))
        ok = text.isNotNull()
        return F.struct(
            F.when(ok, to_elements(text)).cast(ELEMENTS).alias("elements"),
            F.lit(name).alias("parser"),
            F.when(content.isNull(), "empty file content")
            .when(~ok, "content is not valid UTF-8")
            .alias("parse_errors"),
        )

    return parse


BUILT_IN: dict[str, Callable[[Column], Column]] = {
    "html": _decoded(html_elements, "html"),
    "text": _decoded(text_elements, "text"),
}


def parser_chain(
    factories: Sequence[tuple[str, Callable[[], FileParser]]],
) -> Callable[[Column], Column]:
    """Parser that hands the bytes to Python libraries, first one that is available.

    ``factories`` are ``(name, factory)``; a factory that raises ``ImportError`` makes
    room for the next one.  A file that fails to parse becomes an error row and does
    not touch its neighbours.
    """
    chain = list(factories)

    @F.pandas_udf(_PARSED)
    def parse(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        name, parser, missing = None, None, []
        for name, factory in chain:
            try:
                parser = factory()
                break
            except ImportError as error:
                missing.append(f"{name}: {error}")
        for contents in batches:
            rows = []
            for content in contents:
                try:
                    if parser is None:
                        raise ImportError("no parser available: " + "; ".join(missing))
                    rows.append((parser(bytes(content)), name, None))
                except Exception as error:  # one bad file is one error row
                    rows.append((None, name, str(error) or type(error).__name__))
            yield pd.DataFrame(rows, columns=["elements", "parser", "parse_errors"])

    return parse


def parse_documents(
    files: DataFrame,
    parser: str | Callable[[Column], Column] = "html",
    now: Column | None = None,
) -> DataFrame:
    """Binary file rows to ``parsed_documents``; the payload is dropped on the way.

    ``parser`` is a built-in name or the result of :func:`parser_chain`.
    A file that cannot be parsed keeps its row, with null results, score 0.0 and the
    message in ``parse_errors``.
    """
    parse = BUILT_IN[parser] if isinstance(parser, str) else parser
    opened = files.select(
        content_id(F.col("path"), F.col("length")).alias("document_id"),
        "path",
        (F.current_timestamp() if now is None else now).alias("ingestion_timestamp"),
        parse(F.col("content")).alias("parsed"),
    ).select("document_id", "path", "ingestion_timestamp", "parsed.*")
    built = add_structure(opened)
    failed = F.col("parse_errors").isNotNull()
    tagged = F.struct(
        "metadata.*", F.col("parser")
    )

    def unless_failed(value: Column) -> Column:
        return F.when(~failed, value)

    return built.select(
        "document_id",
        "path",
        "ingestion_timestamp",
        unless_failed(F.col("text")).alias("text"),
        unless_failed(to_json(F.col("sections"))).alias("sections"),
        unless_failed(to_json(F.col("tables"))).alias("tables"),
        unless_failed(to_json(tagged)).alias("metadata"),
        F.when(failed, F.lit(0.0))
        .otherwise(F.col("parse_quality_score"))
        .alias("parse_quality_score"),
        "parse_errors",
    ).select(*PARSED_DOCUMENTS.fieldNames())


def parse_to_tree(
    files: DataFrame, parser: str | Callable[[Column], Column] = "html"
) -> DataFrame:
    """Binary file rows to ``docs_parsed``: the element tree as JSON, payload dropped."""
    parse = BUILT_IN[parser] if isinstance(parser, str) else parser
    opened = files.select(
        "path", "modificationTime", "length", parse(F.col("content")).alias("parsed")
    )
    tree = element_tree(F.col("parsed.elements"))
    failure = to_json(F.struct(F.col("parsed.parse_errors").alias("error_status")))
    return opened.select(
        "path",
        "modificationTime",
        "length",
        F.when(F.col("parsed.parse_errors").isNull(), tree)
        .otherwise(failure)
        .alias("parsed_content"),
    )


def tree_parts(docs_parsed: DataFrame) -> DataFrame:
    """Pages, elements, error status and metadata of the tree, read by path."""
    doc = docs_parsed.withColumn("_doc", F.try_parse_json("parsed_content"))
    paths = {
        "pages": "$.document.pages",
        "elements": "$.document.elements",
        "error_status": "$.error_status",
        "metadata": "$.metadata",
    }
    return doc.select(
        "path",
        "modificationTime",
        "length",
        *[F.try_variant_get("_doc", p, "variant").alias(n) for n, p in paths.items()],
    )
