"""Writing into JSON text by position: what is not written stays as it is spelt.

One scan cuts the top level of a container into its members; the step of a path picks one of them
and goes on in its text.  All of it is column expressions, so that it stays in the JVM and is
linear in the text for each step of a path.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chartloom.functions.jsonval import let
from chartloom.schemas import PATCHED

#: Documents nested deeper are left as they are.
DEEPEST = 200

_STRING = r'"(?:[^"\\]++|\\.)*+"'
_ATOM = r'[^\s,\[\]{}":]++'


def _nested(depth: int) -> str:
    """A container whose brackets pair up, to a depth; possessive, so it never goes back."""
    inner = rf'[^\[\]{{}}"]++|{_STRING}'
    out = rf"[\[{{](?:{inner})*+[\]}}]"
    for _ in range(depth - 1):
        out = rf"[\[{{](?:{inner}|{out})*+[\]}}]"
    return out


_VALUE = rf"(?s:{_STRING}|{_nested(DEEPEST)}|{_ATOM})"
_ROOT = rf"^\s*+{_nested(DEEPEST)}\s*+$"
#: A member with the mark before it: an opening bracket or a comma.
_MEMBER = rf"\G[\[{{,](?:{_STRING}:)?+{_VALUE}"
_KEY = rf"^[{{,]({_STRING}):"
_HEAD = rf"^[\[{{,](?:{_STRING}:)?+"
_SPACE = rf"({_STRING})|\s++"
#: Text up to a comma or colon, from where the last one ended, so that none is found inside a string.
_MARKED = rf'\G((?:{_STRING}|[^",:]++)*+)([,:])'

_STATE = ("struct<head:string,node:string,tail:string,fits:boolean>")


def is_json(doc: Column) -> Column:
    """True for one whole JSON object or array."""
    return F.coalesce(doc.rlike(_ROOT) & F.try_parse_json(doc).isNotNull(), F.lit(False))


def compact(doc: Column) -> Column:
    """The document without white space between its tokens."""
    return F.regexp_replace(doc, _SPACE, "$1")


def quoted(value: Column) -> Column:
    """A text as a JSON string; null as null."""
    return F.when(value.isNull(), "null").otherwise(let(
        F.to_json(F.array(value)), lambda listed: F.substring(listed, F.lit(2), F.length(listed) - 2)))


def unquoted(value: Column) -> Column:
    """What a JSON value stands for, as text: strings without quotes, null as null, containers
    with a blank behind each comma and colon, all else as it is spelt."""
    return (
        F.when(value == "null", None)
        .when(value.startswith('"'), F.from_json(
            F.concat(F.lit("["), value, F.lit("]")), "array<string>")[0])
        .otherwise(F.regexp_replace(value, _MARKED, "$1$2 ")))


def _members(node: Column) -> Column:
    return F.regexp_extract_all(node, F.lit(_MEMBER), F.lit(0))


def _key(member: Column) -> Column:
    """A member's key as compared with a step: quoted, its escapes resolved."""
    return let(F.regexp_extract(member, _KEY, 1), lambda raw: F.when(
        raw.contains("\\"), quoted(unquoted(raw))).otherwise(raw))


def _state(head: Column, node: Column, tail: Column, fits: Column) -> Column:
    return F.struct(head.alias("head"), node.alias("node"), tail.alias("tail"), fits.alias("fits"))


def _open(held: Column, members: Column, at: Column) -> Column:
    """The state inside member ``at`` (from 1) of the node."""
    def cut(x: Column) -> Column:
        return let(F.regexp_extract(x["member"], _HEAD, 0), lambda mark: _state(
            F.concat(held["head"], x["before"], mark),
            F.substring(x["member"], F.length(mark) + 1, F.length(x["member"])),
            F.concat(F.substring(held["node"], F.length(x["before"]) + F.length(x["member"]) + 1,
                                 F.length(held["node"])), held["tail"]),
            F.lit(True)))

    return let(F.struct(F.get(members, at - 1).alias("member"), F.array_join(
        F.slice(members, F.lit(1), at - 1), "").alias("before")), cut)


def _descend(held: Column, step: Column) -> Column:
    """One step further; a key that an object lacks leads into a null node, to be made."""
    node = held["node"]
    index = step.try_cast("int")
    is_index = step.rlike(r"^\d+$")
    misfit = _state(held["head"], node, held["tail"], F.lit(False))

    def made(key: Column) -> Column:
        return _state(
            F.concat(held["head"], F.lit("{"), key, F.lit(":")), node, F.concat(F.lit("}"), held["tail"]),
            F.lit(True))

    def in_object(x: Column) -> Column:
        members, key = x["members"], x["key"]
        added = _state(
            F.concat(held["head"], F.substring(node, F.lit(1), F.length(node) - 1),
                     F.when(F.size(members) > 0, ",").otherwise(""), key, F.lit(":")),
            F.lit(None).cast("string"), F.concat(F.lit("}"), held["tail"]), F.lit(True))
        place = F.array_position(F.transform(members, _key), key).cast("int")
        return let(place, lambda at: F.when(at > 0, _open(held, members, at)).otherwise(added))

    def in_array(members: Column) -> Column:
        return F.when(index < F.size(members), _open(held, members, index + 1)).otherwise(misfit)

    return (
        F.when(~held["fits"], misfit)
        .when(is_index, F.when(node.startswith("["), let(_members(node), in_array)).otherwise(misfit))
        .when(node.isNull(), let(quoted(step), made))
        .when(node.startswith("{"), let(F.struct(
            _members(node).alias("members"), quoted(step).alias("key")), in_object))
        .otherwise(misfit))


def steps_of(path: Column) -> Column:
    """Keys and positions of a path such as ``symptoms[0].severity``."""
    return F.filter(F.split(F.coalesce(path, F.lit("")), r"[.\[\]]+"), lambda s: s != "")


def _write(held: Column, patch: Column) -> Column:
    """One patch into ``held.doc``."""
    steps = steps_of(patch["path"])
    start = _state(F.lit(""), held["doc"], F.lit(""), F.size(steps) > 0).cast(_STATE)
    found = F.aggregate(steps, start, lambda s, step: _descend(s, step).cast(_STATE))

    def written(place: Column) -> Column:
        fits = place["fits"]
        return F.struct(
            F.when(fits, F.concat(place["head"], quoted(patch["value"]), place["tail"]))
            .otherwise(held["doc"]).alias("doc"),
            F.concat(held["old"], F.array(F.when(fits, unquoted(place["node"])))).alias("old"),
            F.concat(held["new"], F.array(F.when(fits, patch["value"]))).alias("new"),
            (held["any"] | fits).alias("any"))

    return let(found, written)


def patched(doc: Column, patches: Column) -> Column:
    """Write a list of ``(path, value)`` into a JSON document, one after the other.

    Missing objects are created.  A null path or one that does not fit, and any path into a text
    that is no JSON, leaves the document as it is.  A document that was written to has no white
    space between its tokens; all tokens keep their spelling.  Gives ``struct(document,
    old_values, new_values)`` with the value at each path before and after its own write.
    """
    kind = "struct<doc:string,old:array<string>,new:array<string>,any:boolean>"
    none = F.array().cast("array<string>")

    def start(text: Column) -> Column:
        return F.struct(text.alias("doc"), none.alias("old"), none.alias("new"),
                        F.lit(False).alias("any")).cast(kind)

    readable = let(compact(doc), lambda text: F.aggregate(
        patches, start(text), lambda held, patch: _write(held, patch).cast(kind)))
    unread = F.transform(patches, lambda _: F.lit(None).cast("string"))

    def result(held: Column) -> Column:
        return F.struct(
            F.when(held["any"], held["doc"]).otherwise(doc).alias("document"),
            F.coalesce(held["old"], unread).alias("old_values"),
            F.coalesce(held["new"], unread).alias("new_values")).cast(PATCHED)

    kept = F.struct(doc.alias("document"), none.alias("old_values"), none.alias("new_values")).cast(PATCHED)
    return F.when(doc.isNull() | F.coalesce(F.size(patches) == 0, F.lit(True)), kept).otherwise(
        let(F.when(is_json(doc), readable), result))
