import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chartloom.functions import jsonval as jv
from chartloom.operators import entities as en

# A document with gaps; 19 of its 35 leaves are filled.
GAPPY = {
    "chief_complaint": "Chest pain",
    "symptoms": [
        {"symptom": "Chest pain", "onset": "yesterday evening", "severity": None,
         "location": None, "radiation": None},
        {"symptom": "Shortness of breath", "onset": "yesterday evening", "severity": None,
         "location": None},
        {"symptom": "Sweating", "onset": "yesterday evening", "severity": None,
         "location": None},
    ],
    "diagnoses": [
        {"diagnosis": "Chest pain, likely cardiac in origin", "icd10_code": None,
         "status": "suspected"},
        {"diagnosis": "Rule out acute coronary syndrome", "icd10_code": None,
         "status": "differential"},
    ],
    "medications": [
        {"name": "blood pressure medication", "dosage": None, "frequency": None, "route": None}
    ],
    "procedures": [
        {"procedure": "ECG", "cpt_code": None},
        {"procedure": "Troponin levels", "cpt_code": None},
    ],
    "vital_signs": {"blood_pressure": "145/92", "temperature": "98.6F", "heart_rate": "98",
                    "respiratory_rate": "22", "oxygen_saturation": "96%"},
    "allergies": [],
    "social_history": {"smoking": None, "alcohol": None},
}


def leaves(value):
    if isinstance(value, dict):
        return [x for v in value.values() for x in leaves(v)]
    if isinstance(value, list):
        return [x for v in value for x in leaves(v)]
    return [value]


def counted(spark, docs):
    df = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)], "i int, j string")
    rows = df.select("i", jv.leaf_counts(F.col("j")).alias("c"),
                     jv.completeness(F.col("j")).alias("s")).orderBy("i").collect()
    return [(r.c.total, r.c.filled, r.s) for r in rows]


def test_document_with_gaps(spark):
    assert counted(spark, [GAPPY]) == [(35, 19, pytest.approx(19 / 35))]


@settings(max_examples=6, deadline=None)
@given(st.lists(st.recursive(
    st.none() | st.booleans() | st.integers(-99, 99) | st.floats(-1e9, 1e9) |
    st.text(max_size=8),
    lambda c: st.lists(c, max_size=4) | st.dictionaries(st.text(max_size=5), c, max_size=4),
    max_leaves=12), min_size=5, max_size=25))
def test_completeness_of_any_document(spark, docs):
    for doc, (total, filled, share) in zip(docs, counted(spark, docs)):
        want = leaves(doc)
        full = [v for v in want if v is not None and v != ""]
        assert (total, filled) == (len(want), len(full))
        assert 0.0 <= share <= 1.0
        assert share == pytest.approx(len(full) / len(want) if want else 0.0)


def test_long_strings_do_not_overflow(spark):
    doc = {"a": "x\n\"" * 400_000, "b": None}
    assert counted(spark, [doc])[0][:2] == (2, 1)


@pytest.mark.parametrize("reply, want", [
    ('{"a": 1}', '{"a": 1}'),
    ('```json\n{"a": 1}\n```', '{"a": 1}'),
    ('```\n{"a": 1}\n```', '{"a": 1}'),
    ('Sure.\n```json\n{"a": 1}\n``` and ```json\n{"b": 2}\n```', '{"a": 1}'),
    ('  {"a": 1}\n\n', '{"a": 1}'),
    ('{"a": ', '{"d": 0}'),
    ("no json here", '{"d": 0}'),
])
def test_reply_cleaning(spark, reply, want):
    df = spark.createDataFrame([(reply,)], "r string")
    assert df.select(jv.reply_or_default(F.col("r"), '{"d": 0}')).first()[0] == want


def test_read_path(spark):
    paths = ["symptoms[0].symptom", "symptoms.1.onset", "symptoms[9].onset", "none.at.all",
             "vital_signs.heart_rate", "bad path!", "chief_complaint", "social_history.smoking"]
    df = spark.createDataFrame([(json.dumps(GAPPY), p) for p in paths], "e string, p string")
    got = {r.p: r.value for r in en.read_paths(df, "e", "p").collect()}
    assert got == {
        "symptoms[0].symptom": "Chest pain", "symptoms.1.onset": "yesterday evening",
        "symptoms[9].onset": None, "none.at.all": None, "vital_signs.heart_rate": "98",
        "bad path!": None, "chief_complaint": "Chest pain", "social_history.smoking": None,
    }


def test_apply_patches(spark):
    patches = [("symptoms[0].severity", "severe"), ("symptoms[7].severity", "mild"),
               ("plan.next.step", "call"), ("symptoms[0].severity", "mild")]
    df = spark.createDataFrame(
        [(json.dumps(GAPPY), patches), (json.dumps(GAPPY), [])],
        "e string, p array<struct<path:string,value:string>>")
    rows = df.select(en.apply_patches("e", "p").alias("m")).collect()
    doc = json.loads(rows[0].m.document)
    assert doc["symptoms"][0]["severity"] == "mild"
    assert len(doc["symptoms"]) == 3
    assert doc["plan"] == {"next": {"step": "call"}}
    assert rows[0].m.old_values == [None, None, None, "severe"]
    assert rows[0].m.new_values == ["severe", None, "call", "mild"]
    assert json.loads(rows[1].m.document) == GAPPY


def test_flatten_leaves(spark):
    df = spark.createDataFrame([("d", json.dumps(GAPPY)), ("e", "{}"), ("x", "oops")],
                               "id string, entities string")
    rows = en.flatten_leaves(df, "id").collect()
    assert {r.id for r in rows} == {"d"}
    assert len(rows) == 35 and sum(not r.is_empty for r in rows) == 19
    values = {r.path: r.value for r in rows}
    assert values["symptoms[1].symptom"] == "Shortness of breath"
    assert values["vital_signs.oxygen_saturation"] == "96%"


def test_any_depth_or_a_chosen_one(spark):
    df = spark.createDataFrame([(1, '{"a":{"b":{"c":{"d":{"e":1}}}},"z":[]}')], "id int, entities string")
    rows = {r.path: r.value for r in en.flatten_leaves(df, "id").collect()}
    assert rows == {"a.b.c.d.e": "1"}
    rows = {r.path: r.value for r in en.flatten_leaves(df, "id", max_depth=4).collect()}
    assert rows == {"a.b.c.d": '{"e":1}'}


def test_deep_and_mixed_documents(spark):
    """Each row is opened as often as it is deep, without a job of its own."""
    deep = '{"a":[' * 30 + '{"x":null,"y":[1.50,"s",{}],"z":[]}' + "]}" * 30
    rows = [(1, deep), (2, "[1,[2]]"), (3, '"alone"'), (4, None), (5, '{"a":1}{'), (6, "{}"),
            (7, json.dumps({f"k{i}": list(range(50)) for i in range(200)}))]
    df = spark.createDataFrame(rows, "id int, entities string")
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup()
    leaves = en.flatten_leaves(df, "id")
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup()) == len(jobs)
    got = {}
    for r in leaves.collect():
        got.setdefault(r.id, {})[r.path] = (r.value, r.is_empty)
    base = ".".join(["a[0]"] * 30)
    assert got[1] == {f"{base}.x": (None, True), f"{base}.y[0]": ("1.5", False), f"{base}.y[1]": ("s", False)}
    assert got[2] == {"[0]": ("1", False), "[1][0]": ("2", False)}
    assert got[3] == {"": ("alone", False)} and set(got) == {1, 2, 3, 5, 7}
    assert len(got[7]) == 10_000 and got[7]["k199[49]"] == ("49", False)


def test_patches_that_do_not_fit(spark):
    """Null and misfit paths, broken documents: nothing changes, nothing fails."""
    kept = '{"a": 1.10, "big": 12345678901234567890.123, "far": 1e400, "t": "x", "l": [1]}'
    rows = [(kept, [(None, "v")]), (kept, [("t.u.v", "v"), ("l[4].x", "v"), ("", "v"), ("l.k", "v")]),
            ("oops", [("a", "v")]), ('{"a": NaN}', [("a", "v")]), (kept, [("n", "v"), ("a", None)])]
    df = spark.createDataFrame(rows, "e string, p array<struct<path:string,value:string>>")
    got = [r.m for r in df.select(en.apply_patches("e", "p").alias("m")).collect()]
    assert [g.document for g in got[:4]] == [r[0] for r in rows[:4]]
    assert [len(g.old_values) for g in got] == [1, 4, 1, 1, 2]
    assert got[4].document == (
        '{"a":null,"big":12345678901234567890.123,"far":1e400,"t":"x","l":[1],"n":"v"}')
    assert got[4].old_values == [None, "1.10"]


def test_older_keys(spark):
    old = {"symptoms": [{"name": "cough", "duration": "2 days"}],
           "diagnoses": [{"diagnosis": "flu", "icd10": "J10"}],
           "procedures": [{"procedure": "swab", "cpt": "87"}], "extraction_confidence": 0.85}
    df = spark.createDataFrame([(json.dumps(old),)], "entities string")
    e = en.normalise_entities(df).first().entity
    assert (e.symptoms[0].symptom, e.symptoms[0].onset) == ("cough", "2 days")
    assert e.diagnoses[0].icd10_code == "J10" and e.procedures[0].cpt_code == "87"
    assert e.extraction_confidence == "0.85" and e.allergies == []
