"""Evidence spans against all windows, and negation scopes."""

import random
import time

import pytest
from pyspark.sql import functions as F

from chartloom.operators import evidence as ev
from chartloom.schemas import ENTITIES


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        last, row[0] = row[0], i + 1
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], min(row[j + 1] + 1, row[j] + 1, last + (x != y))
    return row[-1]


def test_nearest_passage_against_all_windows(spark):
    rng = random.Random(3)
    words = ["chest", "pain", "pian", "drug", "durg", "12", "mg", "x", "swelling", "sweling"]
    rows = []
    for _ in range(150):
        text = " ".join(rng.choices(words, k=rng.randint(0, 12)))
        rows.append((text, " ".join(rng.choices(words, k=rng.randint(1, 3)))))
    df = spark.createDataFrame(rows, "text string, value string")
    got = df.select("text", "value", ev.nearest_passage(ev.words_of(F.col("text")), F.col("value")).alias("n")).collect()
    for r in got:
        w, most, own = r.text.split(), max(1, len(r.value) // 4), len(r.value.split())
        runs = [(edits(r.value, " ".join(w[i:i + n])), i + 1, n) for n in (own - 1, own, own + 1) if n > 0
                for i in range(len(w) - n + 1)]
        want = min((x for x in runs if x[0] <= most), default=None)
        assert (tuple(r.n) if r.n else None) == want, r


def entities(**values):
    empty = {f.name: [] if f.dataType.typeName() == "array" else None for f in ENTITIES.fields}
    return {**empty, **values}


def test_evidence_and_counts(spark):
    e = entities(symptoms=[{"symptom": "Chest pain"}, {"symptom": "coughing"}, {"symptom": ""}, {"symptom": "rash"}],
                 allergies=["Penicilin"], chief_complaint=None)
    df = spark.createDataFrame(
        [(1, "Has chest  pain? CHEST PAIN, cougning; penicillin.", e), (2, None, e), (3, "", entities())],
        f"id int, text string, entity {ENTITIES.simpleString()}")
    rows = ev.evidence(df, "id")
    got = {(r.id, r.value): (r.status, r.distance, r.correction) for r in rows.collect()}
    assert got == {
        (1, "Chest pain"): ("stated", 0, None), (1, "coughing"): ("near", 1, "cougning"),
        (1, "rash"): ("absent", None, None), (1, "Penicilin"): ("near", 1, "penicillin"),
        **{(2, v): ("absent", None, None) for v in ("Chest pain", "coughing", "rash", "Penicilin")}}
    counts = {(r.id, r.kind): (r.values, r.stated, r.near, r.absent) for r in ev.evidence_counts(rows, "id").collect()}
    assert counts[1, "symptom"] == (3, 1, 1, 1) and counts[2, "allergy"] == (1, 0, 0, 1)


def test_missing_facts(spark):
    given = entities(symptoms=[{"symptom": "cough"}], allergies=["latex"])
    found = entities(symptoms=[{"symptom": "Cough"}, {"symptom": "coughs"}, {"symptom": "fever"}, {"symptom": "fever"}],
                     medications=[{"name": "latex", "dosage": None}])
    df = spark.createDataFrame([(1, given, found)], f"id int, entity {ENTITIES.simpleString()}, found {ENTITIES.simpleString()}")
    assert sorted((r.kind, r.value) for r in ev.missing_facts(df, "id").collect()) == [
        ("medication", "latex"), ("symptom", "fever")]


@pytest.mark.parametrize("text, finding, want", [
    ("Denies cough.", "cough", "negated"), ("Denies fever but has cough.", "cough", "affirmed"),
    ("No evidence of new or old cough", "cough", "negated"), ("Cough was ruled out.", "cough", "negated"),
    ("No fever. Cough.", "cough", "affirmed"), ("No fever; cough", "cough", "affirmed"),
    ("Not one two three four five six cough", "cough", "affirmed"),
    ("Possible cough", "Cough", "uncertain"), ("possible cough, no cough", "cough", "uncertain"),
    ("coughing without end", "cough", "absent"), (None, "cough", "absent"), ("", "a.b", "absent"),
    ("Temp 98.6 no cough", "cough", "negated"), ("without chest\tpain or chest pain", "chest pain", "negated"),
    ("denies a (mild) cough", "(mild) cough", "negated"), ("no fever, no cough", "cough", "negated"),
    ("no\ncough", "cough", "affirmed"), ("nothing but cough", "cough", "affirmed"),
])
def test_scopes(spark, text, finding, want):
    df = spark.createDataFrame([(text, finding)], "t string, f string")
    assert df.select(ev.finding_status(ev.marked(F.col("t")), F.col("f"))["status"]).first()[0] == want


def test_scopes_of_long_runs_of_words(spark):
    """Without a mark behind them, words are not cut into pieces in every possible way."""
    text = " ".join(["immunohistochemical " * 12, "x" * 200, "no cough"])
    df = spark.createDataFrame([(text, "cough")] * 20, "t string, f string").select(
        ev.finding_status(ev.marked(F.col("t")), F.col("f"))["status"].alias("s"))
    began = time.monotonic()
    assert {r.s for r in df.collect()} == {"negated"} and time.monotonic() - began < 30


def test_scopes_behind_reach_six_words(spark):
    rows = [("one two three four five cough was excluded",), ("cough one two three four five six was excluded",),
            ("cough,one\ttwo  three four five is absent",), ("rash was excluded, cough is absent",)]
    df = spark.createDataFrame(rows, "t string")
    got = df.select(ev.finding_status(ev.marked(F.col("t")), F.lit("cough"))["status"].alias("s")).collect()
    assert [r.s for r in got] == ["negated", "affirmed", "negated", "negated"]
