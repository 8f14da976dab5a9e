"""Steps whose cost per row decides how large a table can be, counted in plans and files."""

import random
from pathlib import Path

from pyspark.sql import functions as F

from chartloom.functions import text
from chartloom.operators import evidence, grids
from chartloom.operators import review as rv
from chartloom.operators.entities import flatten_leaves
from chartloom.operators.infer import infer
from chartloom.plans import gold
from chartloom.queries import review, storage
from chartloom.queries.inputs import encounters
from chartloom.sources import tables

PIECES = (
    "<table>", "</table>", "<TABLE class=\"x\">", "<tr>", "</tr>", "<td>", "</td>", "<th colspan=2>", "<td rowspan=\"3\">",
    "<p>", "<br>", "<br/>", "<div id='a'>", "<script>", "</script>", "<!-- <td> -->", "<title>", "</title>", "a &amp; b", "&lt",
    "&#65;", " \n\x1f ", "x < y", "<td", "plain", "<td/>", "</ td>", "<li>", "<td COLSPAN=\"0\">", "<td colspan>", ">")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_cells_by_cutting_and_by_the_parser():
    rng, tags, plain = random.Random(5), grids._Tags(), 0
    for n in range(6000):
        some = PIECES if n % 2 else [p for p in PIECES if p[0] != "<" or grids._Tags()[p[1:-1]]]
        text = "<table>" + "".join(rng.choices(some, k=rng.randint(0, 25)))
        grid = grids._Grid()
        grid.feed(text)
        assert grids._cells(text, tags) == grid.finished(), text
        plain += grids._pieces(text, tags) is not None
    assert plain > 1000


def test_cells_of_many_keys_come_as_columns(spark, monkeypatch):
    monkeypatch.setattr(grids, "CELLS_AT_ONCE", 3)
    page = "<table><tr><th>a</th><td>b &amp; c</td></tr></table>"
    df = spark.createDataFrame([(i, None, page if i % 2 else None) for i in range(20)], "k long, other string, html string")
    cells = grids.table_cells(df, "k", "other")
    assert "ArrowEvalPython" not in plan(cells)
    assert sorted((r.k, r.column, r.header, r.text) for r in cells.collect()) == [
        x for i in range(1, 20, 2) for x in ((i, 0, True, "a"), (i, 1, False, "b & c"))]


def test_leaves_parse_a_document_once(spark):
    rows = [(1, '{"a": [1, {"b": [null, "x"]}], "c": {}, "d": "[{\\"", "e": []}'), (2, "no"), (3, None), (4, "7"), (5, "[]")]
    leaves = flatten_leaves(spark.createDataFrame(rows, "id int, entities string"), "id")
    assert plan(leaves).count("parseJson") == 1
    assert sorted((r.id, r.path, r.value) for r in leaves.collect()) == [
        (1, "a[0]", "1"), (1, "a[1].b[0]", None), (1, "a[1].b[1]", "x"), (1, "d", '[{"'), (4, "", "7")]


def test_assessed_parses_a_document_once(spark):
    df = spark.createDataFrame([("1", '{"chief_complaint": "x"}', "t")], "document_id string, entities string, text string")
    decided = gold.assessed(df).filter("status = 'pending_review'")
    assert plan(decided).count("parseJson") == 1 and plan(decided).count("Generate") == 1


def visits(spark, folder):
    orders = [(i, i % 3, "FOP"[i % 3], 1.0, "2024-01-01", "1-URGENT") for i in range(1, 60)] * 2
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
                          "o_orderdate string, o_orderpriority string").write.parquet(f"{folder}/orders.parquet")
    spark.createDataFrame([(i, f"c{i}", "BUILDING") for i in range(3)], "c_custkey long, c_name string, c_mktsegment string"
                          ).write.parquet(f"{folder}/customer.parquet")


def test_failed_routes_assess_once(spark, tmp_path):
    visits(spark, tmp_path)
    routes = review.failed_routes(spark, str(tmp_path))
    assert "orders.parquet" not in plan(routes)
    failed = {r.error: r.documents for r in routes.filter("status = 'error'").collect()}
    assert failed == {"API timeout": 4, "no entity document": 8}  # each key twice, and met twice


def test_arrivals_are_written_by_all_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "shared_dir", lambda _: str(tmp_path / "shared"))
    spark.range(400).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), (F.col("id") % 90).cast("string")).alias("text")
                            ).write.parquet(str(tmp_path / "documents.parquet"))
    assert storage.stream_unprocessed(spark, str(tmp_path)).count() == 90
    [source] = Path(tmp_path / "shared").glob("arrivals-*")
    assert len(list(source.glob("*.parquet"))) > 4


def test_prompts_travel_in_small_batches(spark):
    kept = spark.conf.get(tables.BATCH_SETTING)
    try:
        spark.conf.set(tables.BATCH_SETTING, tables.USUAL_BATCH)
        infer(spark.createDataFrame([("p",)], "p string"), "p", lambda: str)
        assert spark.conf.get(tables.BATCH_SETTING) == str(tables.BATCH_BYTES)
        spark.conf.set(tables.BATCH_SETTING, "1000000")
        infer(spark.createDataFrame([("p",)], "p string"), "p", lambda: str)
        assert spark.conf.get(tables.BATCH_SETTING) == "1000000"
    finally:
        spark.conf.set(tables.BATCH_SETTING, kept)


def test_notes_are_spread_behind_the_join(spark, tmp_path):
    visits(spark, tmp_path)
    splits = spark.read.parquet(f"{tmp_path}/orders.parquet").rdd.getNumPartitions()
    notes = encounters(spark, str(tmp_path))
    assert splits > 1 and notes.rdd.getNumPartitions() == 8 * splits
    assert notes.count() == 118 and notes.select("document_id").distinct().count() == 59


def test_labels_are_searched_only_in_texts_that_hold_their_word(spark):
    """Same values as by the plain pattern, which looks at every character."""
    rng = random.Random(9)
    pieces = ("PLAN:", "plan #", "Plan", "MRN:", "DATE :", "ENCOUNTER  DATE:", "ASSESSMENT:", "page_id: 7", "xPLAN: y", "é", "\n",
              "ok", "_PLAN:", "9", " ", "\t", ": ", "dates", "PLAN:PLAN: a", "ſ", "physical exam:", "PHYSICAL", "́plan: ")
    texts = ["".join(rng.choices(pieces, k=rng.randint(0, 12))) for _ in range(3000)] + [None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for label in ("PLAN:", "ASSESSMENT:", "MEDICATIONS"):
        stops = text._stops((label, *text.NOTE_LABELS, *text.NOTE_HEADINGS))
        plain = rf"(?i)\b{text._label_pattern(label)}\s*[:#][ \t]*((?:(?!\b(?:{stops})\s*[:#])[\s\S])*+)"
        values = F.transform(F.regexp_extract_all("t", F.lit(plain), F.lit(1)), text.strip)
        both = df.select("t", text.labelled_value(F.col("t"), label).alias("quick"),
                         text.filled(F.array_join(F.array_remove(values, ""), "\n")).alias("slow"))
        assert "Contains(upper(" in plan(both)
        assert both.filter(~F.col("quick").eqNullSafe(F.col("slow"))).collect() == []


def test_values_are_looked_up_once(spark):
    visits = encounters(spark, "/root/testdata/sf0.001")
    assert plan(evidence.evidence(visits, "document_id")).lower().count("position(") == 1


def test_answered_documents_without_sorting_answers(spark):
    rng = random.Random(4)
    rows = [(rng.choice(["a", "b", "c", None, *map(str, range(60))]), rng.choice(["q1", "q2", None]),
             rng.choice([None, "", "", "x", " "]), rng.choice([None, 1, 2])) for _ in range(400)]
    answers = spark.createDataFrame(rows, "document_id string, question_id string, answer string, t long").withColumn(
        "answered_at", F.timestamp_seconds("t")).drop("t")
    held = rv.answered_documents(answers)
    assert "SortAggregate" not in plan(held)
    assert sorted(held.collect(), key=repr) == sorted(
        rv.latest_answers(answers).select("document_id").distinct().collect(), key=repr)


def test_answers_meet_questions_that_were_never_json(spark):
    df = spark.createDataFrame([("1", '{"chief_complaint": ""}', "t")], "document_id string, entities string, text string")
    waiting = gold.waiting(gold.assessed(df))
    assert "StructsToJson" in plan(gold.review_queue(gold.assessed(df), F.current_timestamp()))
    assert waiting.columns == ["document_id", "entities", "questions"] and "StructsToJson" not in plan(waiting)
    answers = spark.createDataFrame([("1", "q1", "pain", 1)], "document_id string, question_id string, answer string, answered_at long")
    [row] = gold.merged_answers(waiting, answers).collect()
    assert row.updated_entities == '{"chief_complaint":"pain"}' and row.fields_improved == 1
