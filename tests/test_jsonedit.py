"""Writing into JSON text, against a parser that reads and dumps the whole document."""

import json
import re

import pytest
from hypothesis import Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chartloom.functions import jsonedit
from chartloom.operators import entities as en

SCHEMA = "e string, p array<struct<path:string,value:string>>"


def steps_of(path):
    return [int(s) if s.isdigit() else s for s in re.split(r"[.\[\]]+", path or "") if s]


def read(doc, steps):
    for step in steps:
        try:
            doc = None if isinstance(doc, str) else doc[step]
        except (IndexError, KeyError, TypeError):
            return None
    return doc


def fits(doc, steps):
    for step in steps:
        if isinstance(doc, dict) and isinstance(step, str):
            doc = doc.get(step, {})
        elif isinstance(doc, list) and isinstance(step, int) and step < len(doc):
            doc = doc[step]
        else:
            return False
    return bool(steps)


def write(doc, steps, value):
    if not fits(doc, steps):
        return False
    for step in steps[:-1]:
        doc = doc.setdefault(step, {}) if isinstance(doc, dict) else doc[step]
    doc[steps[-1]] = value
    return True


def shown(value):
    if value is None or isinstance(value, str):
        return value
    return json.dumps(value, ensure_ascii=False, separators=(",", ":"))


def plain(text, patches):
    doc, old, new = json.loads(text), [], []
    for path, value in patches:
        steps = steps_of(path)
        before = shown(read(doc, steps)) if steps else None
        done = write(doc, steps, value)
        old.append(before if done else None)
        new.append(value if done else None)
    return doc, old, new


def read_back(value):
    """A value as read from a document: containers compare by what they hold."""
    return json.loads(value) if value and value[0] in "[{" and jsonlike(value) else value


def jsonlike(value):
    try:
        return json.loads(value) is not None
    except ValueError:
        return False


def check(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("id", F.monotonically_increasing_id())
    got = [r.m for r in df.select("id", en.apply_patches("e", "p").alias("m")).orderBy("id").collect()]
    for (text, patches), m in zip(rows, got, strict=True):
        doc, old, new = plain(text, patches)
        assert json.loads(m.document) == doc, (text, patches)
        assert [*map(read_back, m.old_values)] == [*map(read_back, old)], (text, patches)
        assert m.new_values == new, (text, patches)


KEYS = st.sampled_from(["a", "b", "c d", "é\u2028", 'q"', "back\\slash", "0", "12", "tab\t"])
VALUES = st.recursive(
    st.none() | st.booleans() | st.integers(-99, 99) | st.text('ab"\\{}[],: \n\té', max_size=6),
    lambda c: st.lists(c, max_size=4) | st.dictionaries(KEYS, c, max_size=4), max_leaves=14)
PATHS = st.none() | st.lists(
    KEYS.filter(lambda k: not re.search(r"[.\[\]]", k)) | st.integers(0, 4).map(str), max_size=4).map(".".join)


@settings(max_examples=12, deadline=None, phases=[Phase.generate])
@given(st.lists(st.tuples(
    st.dictionaries(KEYS, VALUES, max_size=4) | st.lists(VALUES, max_size=4), st.integers(0, 3),
    st.lists(st.tuples(PATHS, st.none() | st.text('x"\\{é\n', max_size=4)), max_size=4)),
    min_size=10, max_size=40))
def test_any_document_and_path(spark, made):
    check(spark, [(json.dumps(doc, indent=indent or None, ensure_ascii=indent > 1), patches)
                  for doc, indent, patches in made])


def test_old_values_keep_marks_inside_strings(spark):
    docs = ({"a": ["x", "b,c:d"]}, {"a": {"k:1": "e, f: \"g\",h"}}, {"a": ["i:j"]}, {"a": ["k,l", 1, {"m": ":,"}]})
    check(spark, [(json.dumps(doc), [("a", "v")]) for doc in docs])


def test_spelling_stays(spark):
    text = '{ "n": 1.50, "e" : [1e400, -0.0, "\\u00e9"], "z": {"k": 12345678901234567890.10} }'
    rows = [(text, [("z.new", "v"), ("e[1]", "w")])]
    [m] = [r.m for r in spark.createDataFrame(rows, SCHEMA).select(en.apply_patches("e", "p").alias("m")).collect()]
    assert m.document == '{"n":1.50,"e":[1e400,"w","\\u00e9"],"z":{"k":12345678901234567890.10,"new":"v"}}'
    assert m.old_values == [None, "-0.0"]


def test_odd_texts(spark):
    rows = [(None, [("a", "v")]), ("", [("a", "v")]), ("{}x", [("a", "v")]), ('{"a":1}{', [("a", "v")]),
            ('"a"', [("a", "v")]), ("{'a':1}", [("a", "v")]), ('{"a":1}', None), ('{"a":1,"a":2}', [("a", "v")])]
    got = [r.m for r in spark.createDataFrame(rows, SCHEMA).select(en.apply_patches("e", "p").alias("m")).collect()]
    assert [m.document for m in got] == [r[0] for r in rows]
    assert all(m.new_values in ([], [None]) for m in got)


@pytest.mark.parametrize("depth, changed", [(60, True), (199, True), (230, False)])
def test_deep_documents(spark, depth, changed):
    text = '{"a":' * depth + '"x"' + "}" * depth
    rows = [(text, [(".".join("a" * depth), "y")])]
    [m] = [r.m for r in spark.createDataFrame(rows, SCHEMA).select(en.apply_patches("e", "p").alias("m")).collect()]
    assert m.document == (text.replace("x", "y") if changed else text)


def test_long_documents(spark):
    doc = {"l": [{"s": "x" * 50, "n": i} for i in range(40_000)], "t": "]}" * 200_000, "end": 1}
    check(spark, [(json.dumps(doc), [("l[39999].n", "last"), ("end", "e"), ("l[0].new", "n"), ("t", "u")])])


def test_no_python(spark):
    df = spark.createDataFrame([("{}", [("a", "v")])], SCHEMA)
    plan = df.select(en.apply_patches("e", "p").alias("m"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert df.select(jsonedit.quoted(F.lit('a"b\n')).alias("q")).first().q == '"a\\"b\\n"'
