"""Documents to typed elements, inside the row.

``elements`` is an array in reading order of
``struct(type, text, page_number, html)``.
"""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartloom.functions.jsonval import to_json
from chartloom.operators import unnest
from chartloom.schemas import ELEMENT_TREE, ELEMENTS

# Element categories.
TITLE, NARRATIVE, LIST_ITEM, TABLE = "Title", "NarrativeText", "ListItem", "Table"

HTML_HIDDEN = (
    r"(?is)<head\b.*?</head>|<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->"
)
# Tags, opening or closing, at which a block ends and the next one begins.
HTML_BLOCKS = (
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol "
    "option p pre section select summary table tbody td textarea tfoot th thead title tr ul"
).split()
HTML_BREAK = rf"(?i)<(/?(?:{'|'.join(HTML_BLOCKS)}))(?:\s[^>]*)?/?>"
LINE_TABLE = r"\||\t"
LINE_ITEM = r"^\s*(?:[-*•]|\d+[.)])\s"
LINE_LABEL = r"^\s*[A-Z][A-Z /]+:\s*\S"
LINE_TITLE = r"^\s*\p{Lu}[^.!?]*$"


def _element(kind: Column, text: Column, page: Column, html: Column) -> Column:
    return F.struct(
        kind.alias("type"),
        text.alias("text"),
        page.cast("int").alias("page_number"),
        html.cast("string").alias("html"),
    )


def decode_entities(text: Column) -> Column:
    """Named and numeric character references, each decoded once; others stay as they are."""
    names = F.create_map(*[F.lit(v) for name, code in sorted(name2codepoint.items())
                           for v in (name, chr(code))])

    def character(code: Column) -> Column:
        fits = (code > 0) & (code <= 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        return F.when(fits, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))

    def decoded(piece: Column) -> Column:
        name = F.regexp_extract(
            piece, "^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});", 1)
        digits = F.regexp_replace(name, "^#[xX]?", "")
        value = (
            F.when(name == "", None)
            .when(name.rlike("^#[xX]"), character(F.conv(digits, 16, 10).cast("long")))
            .when(name.startswith("#"), character(digits.try_cast("long")))
            .when(name == "apos", "'")
            .otherwise(F.try_element_at(names, name))
        )
        return F.coalesce(
            F.concat(value, F.substring(piece, F.length(name) + 2, F.length(piece))),
            F.concat(F.lit("&"), piece))

    pieces = F.split(text, "&")
    return F.when(F.contains(text, F.lit("&")), F.array_join(F.transform(
        pieces, lambda piece, i: F.when(i == 0, piece).otherwise(decoded(piece))), "")
    ).otherwise(text)


def _plain(fragment: Column) -> Column:
    """Text of an HTML fragment: tags out, entities decoded, spaces collapsed."""
    text = decode_entities(F.regexp_replace(fragment, r"<[^>]*>", " "))
    return F.trim(F.regexp_replace(text, r"[\s\xa0]+", " "))


def html_elements(html: Column, page: Column | None = None) -> Column:
    """The visible text of an HTML text, every word of it in one element.

    A block ends where any other begins or ends, whether it was closed or not.  A table is
    one element, up to its own end; headings and list items are told by their tag, all else
    is narrative.
    """
    page = F.lit(1) if page is None else page
    visible = F.regexp_replace(F.translate(html, "\x01\x02\x03", "   "), HTML_HIDDEN, " ")
    apart = F.regexp_replace(visible, r"(?i)<table\b", "\x03$0")
    apart = F.regexp_replace(apart, r"(?i)</table\s*>", "$0\x03")

    def typed(block: Column) -> Column:
        tag = F.lower(F.substring_index(block, "\x02", 1))
        kind = (
            F.when(~F.contains(block, F.lit("\x02")), NARRATIVE)
            .when(tag.rlike("^h[1-6]$"), TITLE)
            .when(tag == "li", LIST_ITEM)
            .otherwise(NARRATIVE)
        )
        return _element(kind, _plain(F.substring_index(block, "\x02", -1)), page, F.lit(None))

    def blocks(part: Column) -> Column:
        table = F.array(_element(F.lit(TABLE), _plain(part), page, part))
        marked = F.regexp_replace(part, HTML_BREAK, "\x01$1\x02")
        rest = F.transform(F.split(marked, "\x01"), typed)
        return F.when(part.rlike(r"(?i)^<table\b"), table).otherwise(rest)

    found = F.flatten(F.transform(F.split(apart, "\x03"), blocks))
    return F.filter(found, lambda e: e["text"] != "")


def text_elements(text: Column) -> Column:
    """Lines of a plain text; form feeds separate pages, blank lines drop out."""
    def typed(line: Column, page: Column) -> Column:
        kind = (
            F.when(line.rlike(LINE_TABLE), TABLE)
            .when(line.rlike(LINE_ITEM), LIST_ITEM)
            .when(line.rlike(LINE_LABEL), NARRATIVE)
            .when(line.rlike(LINE_TITLE), TITLE)
            .otherwise(NARRATIVE)
        )
        return _element(kind, F.trim(line), page + 1, F.lit(None))

    def page_lines(body: Column, page: Column) -> Column:
        lines = F.filter(F.split(body, "\n"), lambda line: F.trim(line) != "")
        return F.transform(lines, lambda line: typed(line, page))

    return F.flatten(F.transform(F.split(text, "\f"), page_lines))


def html_to_elements(pages: DataFrame, html: str = "html") -> DataFrame:
    return pages.withColumn("elements", html_elements(F.col(html)))


def text_to_elements(documents: DataFrame, text: str = "text") -> DataFrame:
    return documents.withColumn("elements", text_elements(F.col(text)))


def explode_elements(df: DataFrame, *keys: str) -> DataFrame:
    """One row per element, with its position; documents without elements drop out."""
    return unnest(df, "elements", *keys).select(*keys, "pos", "item.*")


def element_tree(elements: Column) -> Column:
    """The element tree as JSON: ids from 0, one box with the page id per element."""
    nodes = F.transform(
        elements,
        lambda e, i: F.struct(
            F.array(
                F.struct(
                    F.array().cast("array<int>").alias("coord"),
                    e["page_number"].alias("page_id"),
                )
            ).alias("bbox"),
            e["text"].alias("content"),
            F.lit(None).cast("string").alias("description"),
            i.cast("int").alias("id"),
            e["type"].alias("type"),
        ),
    )
    return to_json(F.struct(F.struct(nodes.alias("elements")).alias("document")))


def read_element_tree(parsed_content: Column) -> Column:
    """Element tree from its JSON; null when the JSON does not parse."""
    return F.from_json(parsed_content.cast("string"), ELEMENT_TREE)


def first_page(box: Column) -> Column:
    """Page id of the first box; null when there is none."""
    return F.get(box, F.lit(0))["page_id"]


def tree_elements(tree: Column) -> Column:
    """Element tree to the ``elements`` array."""
    return F.transform(
        tree["document"]["elements"],
        lambda e: _element(e["type"], e["content"], first_page(e["bbox"]), F.lit(None)),
    ).cast(ELEMENTS)
