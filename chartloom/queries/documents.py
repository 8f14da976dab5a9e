"""Parsing and structure of documents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartloom.functions import ids
from chartloom.functions.text import is_short, truncate, word_count
from chartloom.operators import elements as el
from chartloom.operators import unnest
from chartloom.operators import pages as pg
from chartloom.operators import structure as st
from chartloom.operators.parse import parse_documents, parser_chain, tree_parts
from chartloom.queries.inputs import BLOCKS, LINES, paged_documents, table, texts


def _structured_pages(spark: SparkSession, sf: str) -> DataFrame:
    return st.add_structure(el.html_to_elements(texts(spark, sf, "pages", "page_id", "html")))


def _structured_documents(spark: SparkSession, sf: str) -> DataFrame:
    return st.add_structure(
        el.text_to_elements(texts(spark, sf, "documents", "doc_id", "text"))
    )


def page_elements(spark, sf):
    pages = el.html_to_elements(texts(spark, sf, "pages", "page_id", "html"))
    return el.explode_elements(pages, "page_id").select(
        "page_id", F.col("pos").cast("bigint").alias("pos"), "type", "text"
    )


def page_words(spark, sf):
    """Words that the elements of a page hold, against all words outside its tags."""
    pages = el.html_to_elements(texts(spark, sf, "pages", "page_id", "html"))
    words = F.aggregate("elements", F.lit(0), lambda n, e: n + word_count(e["text"]))
    return pages.select("page_id", words.cast("bigint").alias("words"))


def page_sections(spark, sf):
    pages = _structured_pages(spark, sf)
    return unnest(pages, "sections", "page_id", pos="section", item="s").select(
        "page_id",
        F.col("section").cast("bigint").alias("section"),
        "s.title",
        F.size("s.content").cast("bigint").alias("blocks"),
        F.array_join("s.content", "\n").alias("content"),
    )


def document_sections(spark, sf):
    docs = _structured_documents(spark, sf)
    return unnest(docs, "sections", "doc_id", pos="section", item="s").select(
        "doc_id",
        F.col("section").cast("bigint").alias("section"),
        "s.title",
        F.size("s.content").cast("bigint").alias("blocks"),
        F.array_join("s.content", "\n").alias("content"),
    )


def document_tables(spark, sf):
    docs = _structured_documents(spark, sf)
    return unnest(docs, "tables", "doc_id", pos="n", item="t").select(
        "doc_id", F.col("n").cast("bigint").alias("n"), "t.data", "t.type", "t.text"
    )


def _metadata(df: DataFrame, key: str) -> DataFrame:
    return df.select(
        key,
        *[F.col(f"metadata.{c}").cast("bigint").alias(c)
          for c in ("num_pages", "num_sections", "num_tables", "total_elements")],
    )


def page_metadata(spark, sf):
    return _metadata(_structured_pages(spark, sf), "page_id")


def document_metadata(spark, sf):
    return _metadata(_structured_documents(spark, sf), "doc_id")


def page_text(spark, sf):
    return _structured_pages(spark, sf).select("page_id", "text")


def parse_quality_gate(spark, sf):
    pages = _structured_pages(spark, sf).withColumn("kind", F.lit("page"))
    docs = _structured_documents(spark, sf).withColumn("kind", F.lit("document"))
    both = pages.withColumnRenamed("page_id", "id").select(
        "kind", "id", "text", "sections", "tables", "parse_quality_score"
    ).unionByName(
        docs.withColumnRenamed("doc_id", "id").select(
            "kind", "id", "text", "sections", "tables", "parse_quality_score")
    )
    return st.quality_gate(both, computed=True).select(
        "kind",
        "id",
        F.length("text").cast("bigint").alias("chars"),
        F.size("sections").cast("bigint").alias("sections"),
        F.size("tables").cast("bigint").alias("tables"),
        F.round("parse_quality_score", 6).alias("score"),
    )


def _page_files(spark, sf) -> DataFrame:
    """Pages as files: every fifth one is cut short inside a character."""
    html = F.encode("html", "UTF-8")
    return texts(spark, sf, "pages", "page_id", "url", "html").select(
        F.col("url").alias("path"),
        F.lit(None).cast("timestamp").alias("modificationTime"),
        F.length(html).cast("bigint").alias("length"),
        F.when(F.col("page_id") % 5 == 0, F.concat(html, F.unhex(F.lit("C3"))))
        .otherwise(html)
        .alias("content"),
    )


def parsed_documents(spark, sf):
    parsed = parse_documents(_page_files(spark, sf), "html", F.lit(None).cast("timestamp"))
    return parsed.select(
        "document_id", "path", "text", "sections", "tables", "metadata",
        F.round("parse_quality_score", 6).alias("parse_quality_score"), "parse_errors",
    )


def parse_report(spark, sf):
    parsed = parse_documents(_page_files(spark, sf), "html")
    return st.parse_report(parsed).select(
        "document_id",
        F.round("quality_score", 6).alias("quality_score"),
        "has_text",
        F.col("num_sections").cast("bigint").alias("num_sections"),
        F.col("num_tables").cast("bigint").alias("num_tables"),
        "errors",
    )


def _absent_library():
    raise ImportError("layout library is not installed")


def _plain_parser():
    def parse(content: bytes) -> list[dict]:
        pages = content.decode("utf-8").split("\f")
        return [
            {"type": "NarrativeText", "text": text, "page_number": number, "html": None}
            for number, text in enumerate(pages, 1)
        ]

    return parse


def fallback_parse(spark, sf):
    files = texts(spark, sf, "documents", "doc_id", "text").select(
        F.concat(F.lit("doc/"), F.col("doc_id").cast("string")).alias("path"),
        F.length(F.encode("text", "UTF-8")).cast("bigint").alias("length"),
        F.encode("text", "UTF-8").alias("content"),
    )
    chain = parser_chain([("layout", _absent_library), ("plain", _plain_parser)])
    parsed = parse_documents(files, chain)
    return parsed.select(
        "path",
        F.md5("text").alias("text_md5"),
        F.get_json_object("metadata", "$.parser").alias("parser"),
        F.get_json_object("metadata", "$.num_pages").cast("bigint").alias("num_pages"),
        F.round("parse_quality_score", 6).alias("score"),
        "parse_errors",
    )


def tree_rows(spark, sf):
    return pg.tree_rows(paged_documents(spark, sf)).select(
        "path", F.col("page_id").cast("bigint").alias("page_id"),
        F.col("id").cast("bigint").alias("id"), "type", "content",
    )


def variant_rows(spark, sf):
    rows = pg.variant_rows(paged_documents(spark, sf))
    return rows.groupBy("type").agg(
        F.count(F.lit(1)).alias("elements"),
        F.sum(F.length("content")).alias("chars"),
        F.max("page_id").cast("bigint").alias("last_page"),
        F.max("id").cast("bigint").alias("last_id"),
    )


def tree_paths(spark, sf):
    docs = paged_documents(spark, sf).withColumns(
        {"modificationTime": F.lit(None).cast("timestamp"), "length": F.lit(0)}
    )
    return tree_parts(docs).select(
        "path",
        F.json_array_length(F.to_json("elements")).cast("bigint").alias("elements"),
        F.col("pages").isNull().alias("no_pages"),
        F.col("error_status").isNull().alias("no_error"),
    )


def page_notes(spark, sf):
    pages = pg.pages_of_tree(paged_documents(spark, sf))
    return pages.select(
        "path", F.col("page_id").cast("bigint").alias("page_id"),
        F.size("Notes").cast("bigint").alias("notes"),
        F.md5(F.array_join("Notes", " ")).alias("notes_md5"),
    )


def notes_by_page(spark, sf):
    rows = table(spark, sf, "conversations").select(
        F.col("conv_id").alias("path"), F.col("turn").alias("id"),
        F.col("role").alias("page_id"), F.col("text").alias("content"),
    )
    return pg.notes_by_page(rows).select(
        "path", "page_id", F.array_join("Notes", " ").alias("notes")
    )


def rows_in_order(spark, sf):
    """All rows of all pages, sorted by path, page and element."""
    rows = pg.tree_rows(paged_documents(spark, sf))
    return pg.in_order(rows, "id").select(
        "path", F.col("page_id").cast("bigint").alias("page_id"),
        F.col("id").cast("bigint").alias("id"), "type")


def rows_in_full_order(spark, sf):
    """All rows of all pages by path, page and element."""
    rows = pg.tree_rows(paged_documents(spark, sf))
    return pg.in_order(rows, "id").select(
        "path", F.col("page_id").cast("bigint").alias("page_id"),
        F.col("id").cast("bigint").alias("id"), "type")


def text_guard_truncate(spark, sf):
    text = F.col("text")
    return texts(spark, sf, "documents", "doc_id", "text").select(
        "doc_id",
        is_short(text).alias("is_short"),
        F.md5(truncate(text, 4000)).alias("prompt_md5"),
        F.length(truncate(text, 5000)).cast("bigint").alias("queued_chars"),
        word_count(text).cast("bigint").alias("words"),
    )


def document_ids(spark, sf):
    orders = table(spark, sf, "orders")
    mrn = F.when(F.col("o_orderkey") % 9 != 0, F.col("o_custkey"))
    return orders.select(
        "o_orderkey",
        ids.visit_id(mrn, F.date_format("o_orderdate", "yyyy-MM-dd")).alias("visit_id"),
        ids.content_id(F.col("o_orderpriority"), F.col("o_custkey")).alias("content_id"),
    )


def first_documents(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    return docs.orderBy(F.desc("n_chars"), "doc_id").limit(10)


QUERIES: dict[str, Callable] = {
    fn.__name__: fn
    for fn in (
        page_elements, page_words, page_sections, document_sections, document_tables, page_metadata,
        document_metadata, page_text, parse_quality_gate, parsed_documents, parse_report,
        fallback_parse, tree_rows, variant_rows, tree_paths, page_notes, notes_by_page, rows_in_order,
        rows_in_full_order, text_guard_truncate, document_ids, first_documents,
    )
}

_PAGE_SECTIONS = """
sec AS (
  SELECT *, sum(CASE WHEN type = 'Title' THEN 1 ELSE 0 END)
    OVER (PARTITION BY page_id ORDER BY pos) AS s
  FROM blocks
)"""
_DOC_SECTIONS = """
sec AS (
  SELECT *, sum(CASE WHEN type = 'Title' THEN 1 ELSE 0 END)
    OVER (PARTITION BY doc_id ORDER BY n) AS s
  FROM lines
)"""


def _sections_sql(base: str, sec: str, key: str, order: str) -> str:
    kept = "FILTER (WHERE type IN ('NarrativeText', 'ListItem'))"
    return f"""
WITH {base}, {sec}
SELECT {key}, s - 1 AS section, max(text) FILTER (WHERE type = 'Title') AS title,
  count(*) {kept} AS blocks,
  coalesce(string_agg(text, chr(10) ORDER BY {order}) {kept}, '') AS content
FROM sec WHERE s > 0 GROUP BY {key}, s"""


def _metadata_sql(base: str, rel: str, key: str, source: str) -> str:
    return f"""
WITH {base}
SELECT {key}, CASE WHEN count(type) > 0 THEN 1 ELSE 0 END AS num_pages,
  count(*) FILTER (WHERE type = 'Title') AS num_sections,
  count(*) FILTER (WHERE type = 'Table') AS num_tables, count(type) AS total_elements
FROM {source} LEFT JOIN {rel} USING ({key}) GROUP BY {key}"""


_SCORE = """
  0::DOUBLE + CASE WHEN length(text) > 100 THEN 0.4::DOUBLE ELSE 0::DOUBLE END
  + CASE WHEN sections > 0 THEN 0.3::DOUBLE ELSE 0::DOUBLE END
  + CASE WHEN tables > 0 THEN 0.2::DOUBLE ELSE 0::DOUBLE END
  + CASE WHEN elements > 0 THEN 0.1::DOUBLE ELSE 0::DOUBLE END"""

_DOCS = f"""
docs AS (
  SELECT 'page' AS kind, page_id AS id, string_agg(text, chr(10) ORDER BY pos) AS text,
    count(*) FILTER (WHERE type = 'Title') AS sections,
    count(*) FILTER (WHERE type = 'Table') AS tables, count(*) AS elements
  FROM blocks GROUP BY page_id
  UNION ALL
  SELECT 'document', doc_id, string_agg(text, chr(10) ORDER BY n),
    count(*) FILTER (WHERE type = 'Title'), count(*) FILTER (WHERE type = 'Table'), count(*)
  FROM lines GROUP BY doc_id
), scored AS (SELECT *, least({_SCORE}, 1::DOUBLE) AS score FROM docs)"""

_PARSED = f"""
WITH {BLOCKS}, {_PAGE_SECTIONS}, sect AS (
  SELECT page_id, s, max(text) FILTER (WHERE type = 'Title') AS title,
    coalesce(list(text ORDER BY pos) FILTER (WHERE type IN ('NarrativeText', 'ListItem')),
      []::VARCHAR[]) AS content
  FROM sec WHERE s > 0 GROUP BY page_id, s
), js AS (
  SELECT page_id, to_json(list({{'title': title, 'content': content}} ORDER BY s))::VARCHAR AS sections
  FROM sect GROUP BY page_id
), whole AS (
  SELECT page_id, string_agg(text, chr(10) ORDER BY pos) AS text,
    coalesce(to_json(list({{'data': html, 'type': 'clinical_data', 'text': text}} ORDER BY pos)
      FILTER (WHERE type = 'Table'))::VARCHAR, '[]') AS tables_json,
    count(*) FILTER (WHERE type = 'Title') AS sections,
    count(*) FILTER (WHERE type = 'Table') AS tables, count(*) AS elements
  FROM blocks GROUP BY page_id
), p AS (
  SELECT sha256(url || '|' || strlen(html)::VARCHAR) AS document_id, url AS path,
    page_id % 5 = 0 AS bad, coalesce(w.text, '') AS text, coalesce(js.sections, '[]') AS sections_json,
    coalesce(w.tables_json, '[]') AS tables_json, coalesce(w.sections, 0) AS sections,
    coalesce(w.tables, 0) AS tables, coalesce(w.elements, 0) AS elements
  FROM pages LEFT JOIN whole w USING (page_id) LEFT JOIN js USING (page_id)
)"""

ORACLES: dict[str, str] = {
    "page_elements": f"WITH {BLOCKS} SELECT page_id, pos, type, text FROM blocks",
    "page_words": r"""
SELECT page_id, len(regexp_extract_all(regexp_replace(regexp_replace(html,
    '(?is)<head.*?</head>|<script.*?</script>|<style.*?</style>|<!--.*?-->', ' ', 'g'),
    '<[^>]*>', ' ', 'g'), '\S+')) AS words
FROM pages""",
    "page_sections": _sections_sql(BLOCKS, _PAGE_SECTIONS, "page_id", "pos"),
    "document_sections": _sections_sql(LINES, _DOC_SECTIONS, "doc_id", "n"),
    "document_tables": f"""
WITH {LINES}
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY n) - 1 AS n, text AS data,
  'clinical_data' AS type, text
FROM lines WHERE type = 'Table'""",
    "page_metadata": _metadata_sql(BLOCKS, "blocks", "page_id", "pages"),
    "document_metadata": _metadata_sql(
        LINES, "lines", "doc_id", "(SELECT doc_id FROM documents)"),
    "page_text": f"""
WITH {BLOCKS}
SELECT page_id, coalesce(string_agg(text, chr(10) ORDER BY pos), '') AS text
FROM pages LEFT JOIN blocks USING (page_id) GROUP BY page_id""",
    "parse_quality_gate": f"""
WITH {BLOCKS}, {LINES}, {_DOCS}
SELECT kind, id, length(text) AS chars, sections, tables, round(score, 6) AS score
FROM scored WHERE score > 0.7::DOUBLE""",
    "parsed_documents": f"""
{_PARSED}
SELECT document_id, path, CASE WHEN NOT bad THEN text END AS text,
  CASE WHEN NOT bad THEN sections_json END AS sections,
  CASE WHEN NOT bad THEN tables_json END AS tables,
  CASE WHEN NOT bad THEN '{{"num_pages":' || CASE WHEN elements > 0 THEN 1 ELSE 0 END
    || ',"num_sections":' || sections || ',"num_tables":' || tables
    || ',"total_elements":' || elements || ',"parser":"html"}}' END AS metadata,
  CASE WHEN bad THEN 0::DOUBLE ELSE round({_SCORE}, 6) END AS parse_quality_score,
  CASE WHEN bad THEN 'content is not valid UTF-8' END AS parse_errors
FROM p""",
    "parse_report": f"""
{_PARSED}
SELECT document_id, CASE WHEN bad THEN 0::DOUBLE ELSE round({_SCORE}, 6) END AS quality_score,
  NOT bad AND text <> '' AS has_text, CASE WHEN bad THEN 0 ELSE sections END AS num_sections,
  CASE WHEN bad THEN 0 ELSE tables END AS num_tables,
  CASE WHEN bad THEN 'content is not valid UTF-8' END AS errors
FROM p""",
    "fallback_parse": """
SELECT 'doc/' || doc_id AS path, md5(text) AS text_md5, 'plain' AS parser, 1 AS num_pages,
  CASE WHEN length(text) > 100 THEN 0.5::DOUBLE ELSE 0.1::DOUBLE END AS score,
  NULL AS parse_errors
FROM documents""",
    "tree_rows": f"""
WITH {LINES}
SELECT 'doc/' || doc_id AS path, n // 10 + 1 AS page_id,
  row_number() OVER (PARTITION BY doc_id ORDER BY n) - 1 AS id, type, text AS content
FROM lines""",
    "variant_rows": f"""
WITH {LINES}, r AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n) - 1 AS id FROM lines)
SELECT type, count(*) AS elements, sum(length(text))::BIGINT AS chars,
  max(n // 10 + 1) AS last_page, max(id) AS last_id
FROM r GROUP BY type""",
    "tree_paths": f"""
WITH {LINES}
SELECT 'doc/' || doc_id AS path, count(type) AS elements, true AS no_pages, true AS no_error
FROM documents LEFT JOIN lines USING (doc_id) GROUP BY doc_id""",
    "page_notes": f"""
WITH {LINES}
SELECT 'doc/' || doc_id AS path, n // 10 + 1 AS page_id, count(*) AS notes,
  md5(string_agg(text, ' ' ORDER BY n)) AS notes_md5
FROM lines GROUP BY doc_id, n // 10""",
    "rows_in_order": f"""
WITH {LINES}
SELECT 'doc/' || doc_id AS path, n // 10 + 1 AS page_id,
  row_number() OVER (PARTITION BY doc_id ORDER BY n) - 1 AS id, type
FROM lines ORDER BY 'doc/' || doc_id, n // 10, n""",
    "rows_in_full_order": f"""
WITH {LINES}
SELECT 'doc/' || doc_id AS path, n // 10 + 1 AS page_id,
  row_number() OVER (PARTITION BY doc_id ORDER BY n) - 1 AS id, type
FROM lines ORDER BY 'doc/' || doc_id, n // 10, n""",
    "notes_by_page": """
SELECT conv_id AS path, role AS page_id, string_agg(text, ' ' ORDER BY turn) AS notes
FROM conversations GROUP BY conv_id, role""",
    "text_guard_truncate": r"""
SELECT doc_id, length(text) < 50 AS is_short, md5(text[1:4000]) AS prompt_md5,
  least(length(text), 5000) AS queued_chars,
  len(regexp_extract_all(text,
    '[^\s\x{b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+'
  )) AS words
FROM documents""",
    "document_ids": """
SELECT o_orderkey,
  CASE WHEN o_orderkey % 9 <> 0 THEN o_custkey::VARCHAR ELSE 'None' END || '_'
    || strftime(o_orderdate, '%Y-%m-%d') AS visit_id,
  sha256(o_orderpriority || '|' || o_custkey) AS content_id
FROM orders""",
    "first_documents": """
SELECT doc_id, lang, n_chars FROM documents ORDER BY n_chars DESC, doc_id LIMIT 10""",
}
