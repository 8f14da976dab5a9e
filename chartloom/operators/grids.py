"""Cells of HTML tables in their places, nested tables apart from those around them."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, StringType, StructField, StructType

CELL = StructType([
    *[StructField(name, IntegerType()) for name in ("table", "parent", "row", "column", "rows", "columns")],
    StructField("header", BooleanType()), StructField("text", StringType())])
_ARROW = [*[pa.int32()] * 6, pa.bool_(), pa.string()]
#: What browsers take as the most of a span.
MOST_COLUMNS, MOST_ROWS = 1000, 65534
#: Cells that go to Spark at once, and tags that a task remembers.
CELLS_AT_ONCE, REMEMBERED = 20_000, 10_000

# A tag that cannot be read in two ways, and elements whose content is no markup.
_PLAIN = re.compile(r'(/?)([a-zA-Z][a-zA-Z0-9]*)((?: [a-zA-Z]+=(?:"[^"&]*"|[a-zA-Z0-9]+))*)')
_ATTRIBUTE = re.compile(r' ([a-zA-Z]+)=(?:"([^"]*)"|([a-zA-Z0-9]+))')
_RAW = frozenset(("script", "style", "textarea", "title", "iframe", "noembed", "noframes", "noscript",
                  "plaintext", "xmp"))


class _Table:
    def __init__(self, number: int, parent: int | None):
        self.number, self.parent = number, parent
        self.row, self.column = -1, 0
        self.taken: dict[int, int] = {}  # column -> the last row that a cell from above reaches
        self.cell: list | None = None


class _Grid(HTMLParser):
    """Tables as they open; rows and cells end where others begin or their table ends."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[_Table] = []
        self.tables, self.cells = 0, []
        self.silent = 0

    def _close_cell(self) -> None:
        table = self.open[-1]
        if table.cell is not None:
            *place, texts = table.cell
            self.cells.append((*place, " ".join("".join(texts).split())))
            table.cell = None

    def _begin_row(self) -> None:
        self._close_cell()
        self.open[-1].row += 1
        self.open[-1].column = 0

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style"):
            self.silent += 1
        elif tag == "table":
            self.open.append(_Table(self.tables, self.open[-1].number if self.open else None))
            self.tables += 1
        elif self.open and tag == "tr":
            self._begin_row()
        elif self.open and tag in ("td", "th"):
            self._close_cell()
            table = self.open[-1]
            if table.row < 0:
                self._begin_row()
            while table.taken.get(table.column, -1) >= table.row:
                table.column += 1
            wide, high = _span(attrs, "colspan", MOST_COLUMNS), _span(attrs, "rowspan", MOST_ROWS)
            for column in range(table.column, table.column + wide):
                table.taken[column] = table.row + high - 1
            table.cell = [table.number, table.parent, table.row, table.column, high, wide, tag == "th", []]
            table.column += wide
        elif self.open and tag in ("br", "p", "div", "li"):
            self.handle_data(" ")

    def handle_endtag(self, tag):
        if tag in ("script", "style"):
            self.silent = max(0, self.silent - 1)
        elif self.open and tag in ("td", "th", "tr"):
            self._close_cell()
        elif self.open and tag == "table":
            self._close_cell()
            self.open.pop()

    def handle_data(self, data):
        if self.open and self.open[-1].cell is not None and not self.silent:
            self.open[-1].cell[-1].append(data)

    def finished(self) -> list[tuple]:
        self.close()
        while self.open:
            self._close_cell()
            self.open.pop()
        return sorted(self.cells, key=lambda c: (c[0], c[2], c[3]))


def _span(attrs, name: str, most: int) -> int:
    value = next((v for n, v in attrs if n == name), None) or "1"
    return min(max(int(value), 1), most) if value.strip().isdecimal() else 1


class _Tags(dict):
    """What stands between ``<`` and ``>`` -> (opens, name, attributes), null if it is not plain."""

    def __missing__(self, raw: str) -> tuple | None:
        if len(self) >= REMEMBERED:
            self.clear()
        plain = _PLAIN.fullmatch(raw)
        if plain is None or plain[2].lower() in _RAW or (plain[1] and plain[3]):
            self[raw] = None
        else:
            attributes = [(n.lower(), q or bare) for n, q, bare in _ATTRIBUTE.findall(plain[3])]
            self[raw] = (not plain[1], plain[2].lower(), attributes)
        return self[raw]


def _pieces(text: str, tags: _Tags) -> list[tuple] | None:
    """(tag, text behind it) of a page of plain tags only; null if there are others."""
    out = []
    for piece in text.split("<")[1:]:
        raw, end, data = piece.partition(">")
        tag = tags[raw] if end else None
        if tag is None:
            return None
        out.append((tag, data))
    return out


def _cells(text: str | None, tags: _Tags) -> list[tuple]:
    """The cells of a page.  The parser's work is done by cutting where tags are plain, and by
    the parser itself where they are not."""
    if not text or "<table" not in text.lower():
        return []
    grid = _Grid()
    pieces = _pieces(text, tags)
    if pieces is None:
        grid.feed(text)
        return grid.finished()
    for (opens, name, attributes), data in pieces:
        if opens:
            grid.handle_starttag(name, attributes)
        else:
            grid.handle_endtag(name)
        if data:
            grid.handle_data(unescape(data) if "&" in data else data)
    return grid.finished()


def table_cells(df: DataFrame, *keys: str, html: str = "html") -> DataFrame:
    """A row per cell: ``keys, table, parent, row, column, rows, columns, header, text``.

    Tables are numbered as they open; ``parent`` is the table around a nested one, whose cells are
    its own and not part of the text around it.  A cell stands at the first free column, spans
    from above counted; a table without an end ends with its text.
    """
    given = df.select(*keys, F.col(html).cast("string").alias("_html"))
    schema = StructType([*given.schema.fields[:-1], *CELL.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tags = _Tags()

        def rows(batch: pa.RecordBatch, at: list[int], cells: list[tuple]) -> pa.RecordBatch:
            places = pa.array(at, pa.int32())
            return pa.RecordBatch.from_arrays(
                [*[c.take(places) for c in batch.columns[:-1]],
                 *[pa.array(values, kind) for values, kind in zip(zip(*cells), _ARROW)]], schema.fieldNames())

        for batch in batches:
            at, cells = [], []
            for i, text in enumerate(batch.column(batch.num_columns - 1)):
                own = _cells(text.as_py(), tags)
                at += [i] * len(own)
                cells += own
                if len(cells) >= CELLS_AT_ONCE:
                    yield rows(batch, at, cells)
                    at, cells = [], []
            if cells:
                yield rows(batch, at, cells)

    return given.mapInArrow(run, schema)
