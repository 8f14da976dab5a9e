"""JSON-in-string expressions; all stay in the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from chartloom.functions.text import strip

KEEP_NULLS = {"ignoreNullFields": "false"}

# One step through a JSON text: an optional key, then a scalar (the group) or the
# opening of a container.  Possessive loops match long strings without growing the
# matcher's stack.
_STRING = r'"(?:[^"\\]++|\\.)*+"'
_STEP = (
    rf"(?:{_STRING}\s*+:\s*+)?+"
    rf"(?:[\[{{]|({_STRING}|null|true|false|-?[0-9][0-9.eE+-]*+))"
)


def to_json(col: Column) -> Column:
    """Serialise with explicit nulls."""
    return F.to_json(col, KEEP_NULLS)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def clean_reply(reply: Column) -> Column:
    """Body of the first ``json`` fence, else of the first fence, else all of it."""
    def fenced(fence: str) -> Column:
        after = F.get(F.split(reply, fence), F.lit(1))
        return F.get(F.split(after, "```"), F.lit(0))

    body = (
        F.when(F.contains(reply, F.lit("```json")), fenced("```json"))
        .when(F.contains(reply, F.lit("```")), fenced("```"))
        .otherwise(reply)
    )
    return strip(body)


def is_json(text: Column) -> Column:
    """True for a text that is JSON, else false or null; a key that occurs twice makes it none."""
    return F.try_parse_json(text).isNotNull()


def is_object(text: Column, valid: Column | None = None) -> Column:
    """True for a text that is one JSON object; ``valid`` is :func:`is_json` of it where that has
    been computed already."""
    begins = F.ltrim(text, F.lit(" \t\r\n")).startswith("{")
    return F.coalesce(begins & (is_json(text) if valid is None else valid), F.lit(False))


def reply_or_default(reply: Column, default: str) -> Column:
    """Cleaned reply where it is a JSON object, else the stage's default document."""
    return let(
        clean_reply(reply), lambda text: F.when(is_object(text), text).otherwise(F.lit(default))
    )


def scalar(doc: Column, path: str) -> Column:
    return F.get_json_object(doc, path)


def number_or(doc: Column, path: str, default: float) -> Column:
    """Number at ``path``; the default when absent or not a number."""
    return F.coalesce(F.get_json_object(doc, path).try_cast("double"), F.lit(float(default)))


def array_size(doc: Column, path: str | None = None) -> Column:
    """Length of a JSON array, 0 when absent or not an array."""
    value = doc if path is None else F.get_json_object(doc, path)
    return F.coalesce(F.json_array_length(value), F.lit(0))


def _leaves(doc: Column) -> Column:
    """Scalar leaves of a valid JSON text, as they are written."""
    return F.array_remove(F.regexp_extract_all(doc, F.lit(_STEP), F.lit(1)), "")


def _count_filled(leaves: Column) -> Column:
    return F.size(F.array_remove(F.array_remove(leaves, "null"), '""'))


def leaf_counts(doc: Column) -> Column:
    """``struct(total, filled)`` over the scalar leaves of a valid JSON text.

    Null and ``""`` are not filled; ``0`` and ``false`` are.  An empty object or
    array has no leaf.  Works at any depth, inside the row.
    """
    return let(
        _leaves(doc),
        lambda leaves: F.struct(
            F.size(leaves).alias("total"), _count_filled(leaves).alias("filled")
        ),
    )


def completeness(doc: Column, valid: Column | None = None) -> Column:
    """Share of filled leaves; 0.0 for a document without leaves and for text that is no JSON.
    ``valid`` is :func:`is_json` of it where that has been computed already."""
    return let(
        _leaves(F.when(is_json(doc) if valid is None else valid, doc)),
        lambda leaves: F.when(
            F.size(leaves) > 0, _count_filled(leaves).cast("double") / F.size(leaves)
        ).otherwise(F.lit(0.0)),
    )


# A path such as ``symptoms[0].severity``; digits between dots are positions.
_PATH = r"^[A-Za-z_]\w*(?:\[\d+\]|\.\w+)*$"


def read_path(variant: Column, path: Column) -> Column:
    """Value at ``path`` (a column) as text; null when anything does not fit."""
    normal = F.regexp_replace(path, r"\.(\d+)(?=\.|\[|$)", "[$1]")
    safe = F.when(path.rlike(_PATH), F.concat(F.lit("$."), normal))
    return F.try_variant_get(variant, F.coalesce(safe, F.lit("$.__none__")), "string")
