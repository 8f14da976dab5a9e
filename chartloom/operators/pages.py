"""Element trees to notes per page, and named fields out of notes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartloom.functions.text import PAGE_LABELS, field_name, labelled_value
from chartloom.operators import unnest
from chartloom.operators.elements import first_page, read_element_tree


def tree_rows(docs_parsed: DataFrame, *keep: str) -> DataFrame:
    """One row per element of a parsed document: ``path, page_id, id, type, content``.

    Documents with null, empty or broken content drop out.
    """
    tree = docs_parsed.select(
        "path", *keep, read_element_tree(F.col("parsed_content")).alias("pc")
    )
    return unnest(tree, "pc.document.elements", "path", *keep, item="e").select(
        "path", *keep, first_page(F.col("e.bbox")).alias("page_id"), "e.id", "e.type", "e.content"
    )


def variant_rows(docs_parsed: DataFrame) -> DataFrame:
    """The same rows read by path from a semi-structured value, without a schema."""
    trees = docs_parsed.select(
        "path", F.try_parse_json(F.col("parsed_content")).alias("_doc")
    ).select("path", F.try_variant_get("_doc", "$.document.elements", "variant").alias("_all"))
    spark = docs_parsed.sparkSession
    items = trees.lateralJoin(spark.tvf.variant_explode(F.col("_all").outer()))
    return items.select(
        "path",
        F.try_variant_get("value", "$.bbox[0].page_id", "int").alias("page_id"),
        F.try_variant_get("value", "$.id", "int").alias("id"),
        F.try_variant_get("value", "$.type", "string").alias("type"),
        F.try_variant_get("value", "$.content", "string").alias("content"),
    )


def pages_of_tree(docs_parsed: DataFrame) -> DataFrame:
    """One row per (path, page): ``path, page_id, Notes`` in element order.

    The pages of a document are slices of its own sorted elements, so nothing is
    shuffled and the size of a group is bounded by the row it came from.
    """
    nodes = F.array_sort(
        F.transform(
            F.col("pc.document.elements"),
            lambda e: F.struct(
                first_page(e["bbox"]).alias("page_id"),
                e["id"].alias("id"),
                e["content"].alias("content"),
            ),
        )
    )
    df = docs_parsed.select(
        "path", read_element_tree(F.col("parsed_content")).alias("pc")
    ).select("path", nodes.alias("nodes"))
    starts = F.array_compact(
        F.transform(
            F.col("nodes"),
            lambda n, i: F.when(
                (i == 0)
                | ~n["page_id"].eqNullSafe(F.get(F.col("nodes"), i - 1)["page_id"]),
                i,
            ),
        )
    )
    df = df.withColumn("starts", starts)

    def page(start: Column, k: Column) -> Column:
        end = F.coalesce(F.get(F.col("starts"), k + 1), F.size("nodes"))
        body = F.slice(F.col("nodes"), start + 1, end - start)
        contents = F.transform(body, lambda n: n["content"])
        return F.struct(
            F.get(F.col("nodes"), start)["page_id"].alias("page_id"),
            F.array_compact(contents).alias("Notes"),
        )

    pages = df.select("path", F.transform(F.col("starts"), page).alias("pages"))
    return unnest(pages, "pages", "path", item="p").select("path", "p.*")


def notes_by_page(
    rows: DataFrame,
    key: str = "path",
    page: str = "page_id",
    order: str = "id",
    content: str = "content",
) -> DataFrame:
    """Notes per page, a row each, from rows that are already exploded, e.g. a stored element
    table.  A page is one row's worth of text, so its group is as large as that row."""
    gathered = rows.groupBy(key, page).agg(
        F.sort_array(F.collect_list(F.struct(F.col(order), F.col(content)))).alias("_n")
    )
    notes = F.transform(
        F.filter(F.col("_n"), lambda n: n[content].isNotNull()), lambda n: n[content]
    )
    return gathered.select(key, page, notes.alias("Notes"))


def extract_fields(
    df: DataFrame, text: Column, labels: Sequence[str] = PAGE_LABELS
) -> DataFrame:
    """One column per label with the value written after it in the text."""
    staged = df.withColumn("_text", text).withColumn("_upper", F.upper("_text"))
    return staged.withColumns({
        field_name(label): labelled_value(F.col("_text"), label, labels, F.col("_upper"))
        for label in labels
    }).drop("_text", "_upper")


def page_fields(pages: DataFrame) -> DataFrame:
    """Notes per page to ``MRN, PATIENT, ENCOUNTER_DATE, Notes``."""
    found = extract_fields(pages, F.array_join("Notes", " "))
    return found.select(*[field_name(label) for label in PAGE_LABELS], "Notes")


def flat_fields(docs_parsed: DataFrame, labels: Sequence[str], *keep: str) -> DataFrame:
    """Fields of every element by itself, each distinct combination of a path once.

    Elements are made distinct within their task first, so only those combinations are shuffled.
    """
    rows = tree_rows(docs_parsed, *keep)
    names = [field_name(label) for label in labels]
    found = extract_fields(rows, F.col("content"), labels)
    return found.select("path", *keep, "page_id", *names).distinct()


def in_order(rows: DataFrame, *order: str) -> DataFrame:
    """Rows of pages by path, page and further columns, over all partitions."""
    return rows.orderBy("path", F.asc_nulls_first("page_id"), *order)


def explode_matches(df: DataFrame, col: str, pattern: str, group: int = 1) -> DataFrame:
    """One row per match of a regular expression."""
    found = F.regexp_extract_all(F.col(col).cast("string"), F.lit(pattern), F.lit(group))
    return unnest(df, found, *df.columns, item="comments").drop("pos")
