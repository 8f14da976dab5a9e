import json
import time

import pytest
from pyspark.sql import functions as F

from chartloom.config import ModelSettings, RetrySettings
from chartloom.operators import infer as inf
from chartloom.operators.entities import extract_by_rules, extract_with_model
from tests.test_documents import NOTE

FAST = RetrySettings(max_attempts=3, initial_wait_seconds=0.0)


def flaky():
    seen = {}

    def answer(prompt):
        seen[prompt] = seen.get(prompt, 0) + 1
        if "late" in prompt:
            raise TimeoutError("late")
        if "refused" in prompt:
            raise ConnectionError("refused")
        if "odd" in prompt:
            raise RuntimeError("odd")
        if "second try" in prompt and seen[prompt] < 2:
            raise ConnectionError("busy")
        return "not json" if "prose" in prompt else json.dumps({"n": len(prompt)})

    return answer


def steady():
    return lambda prompt: '{"by": "fallback"}'


def test_every_row_answers(spark):
    words = ["fine", "late", "refused", "odd", "prose", "second try", None]
    df = spark.createDataFrame(list(enumerate(words)), "id int, prompt string")
    out = inf.infer(df, "prompt", flaky, retry=FAST, threads=3, max_concurrency=2)
    rows = {r.prompt: r for r in out.withColumn(
        "doc", inf.reply_document(F.col("inference"))).collect()}
    assert len(rows) == len(words)
    docs = {w: json.loads(rows[w].doc) for w in words if w is not None}
    assert docs["late"]["error"] == "API timeout"
    assert docs["refused"]["error"] == "API error: refused"
    assert docs["odd"]["error"] == "Unexpected error: odd"
    assert docs["prose"]["raw_response"] == "not json"
    assert all(docs[w]["extraction_confidence"] == "failed" for w in ("late", "odd", "prose"))
    assert docs["fine"] == {"n": 4}
    assert rows["second try"].inference.attempts == 2 and rows["late"].inference.attempts == 3
    assert rows[None].inference.reply is None and rows[None].inference.attempts == 0


def test_only_failures_reach_the_fallback(spark):
    df = spark.createDataFrame([("fine",), ("late",)], "prompt string")
    out = inf.infer(df, "prompt", flaky, fallback=steady, retry=FAST)
    assert {r.prompt: r.inference.model for r in out.collect()} == {
        "fine": "primary", "late": "fallback"}


def test_equal_prompts_are_sent_once(spark, tmp_path):
    folder = str(tmp_path)

    def logging_model():
        def answer(prompt):
            import uuid

            open(f"{folder}/{uuid.uuid4().hex}", "w").write(prompt)
            return json.dumps({"p": prompt})

        return answer

    hot = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(
            F.concat(F.lit("p"), F.col("id") % 5)).alias("prompt"))
    out = inf.infer_distinct(hot, "prompt", logging_model).collect()
    assert len(out) == 3000
    assert all(json.loads(r.inference.reply)["p"] == r.prompt for r in out)
    assert sorted(f.read_text() for f in tmp_path.iterdir()) == ["hot", "p0", "p1", "p2", "p3", "p4"]


def test_cache_answers_first(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",)], "prompt string")
    now = F.lit("2024-01-01 12:00:00").cast("timestamp")
    cache = spark.createDataFrame(
        [("a", "known", "2024-01-01 11:30:00"), ("b", "stale", "2024-01-01 10:00:00")],
        "p string, reply string, at string",
    ).select(F.sha2("p", 256).alias("prompt_hash"), "reply",
             F.col("at").cast("timestamp").alias("cached_at"))
    out, fresh = inf.infer_cached(df, "prompt", steady, cache, now)
    got = {r.prompt: (r.inference.model, r.inference.reply) for r in out.collect()}
    assert got["a"] == ("cache", "known")
    assert got["b"] == got["c"] == ("primary", '{"by": "fallback"}')
    assert fresh.count() == 2


def test_prompt_slots_do_not_nest(spark):
    df = spark.createDataFrame([("{b}", "B")], "a string, b string")
    row = df.select(inf.render_prompt("<{a}|{b}>", a=F.col("a"), b=F.col("b"))).first()
    assert row[0] == "<{b}|B>"


def test_blank_texts_are_not_sent(spark):
    df = spark.createDataFrame([(" \n",), (None,), ("long " * 20,)], "text string")
    rows = extract_with_model(df, flaky, retry=FAST).collect()
    kinds = [json.loads(r.entities).get("extraction_confidence") for r in rows]
    assert kinds[:2] == ["low", "low"] and "n" in json.loads(rows[2].entities)


def test_rules_read_a_note(spark):
    df = spark.createDataFrame([(NOTE,)], "text string")
    e = json.loads(extract_by_rules(df).first().entities)
    assert e["chief_complaint"] == "Swollen left calf"
    assert e["vital_signs"] == {
        "blood_pressure": "128/76", "temperature": "99.1F", "heart_rate": "84",
        "respiratory_rate": "16", "oxygen_saturation": "97%"}
    assert [d["status"] for d in e["diagnoses"]] == ["suspected", "differential"]
    assert e["procedures"] == [{"procedure": "Ultrasound", "cpt_code": None}]
    assert e["extraction_confidence"] == "high"


@pytest.mark.parametrize("changes, want", [
    ([], ""), ([("f", None, "v", "human_review", "q1")], "- f: None → v")])
def test_change_summary(spark, changes, want):
    from chartloom.schemas import CHANGE

    df = spark.createDataFrame([(changes,)], f"c array<{CHANGE.simpleString()}>")
    assert df.select(inf.change_summary(F.col("c"))).first()[0] == want


def hangs():
    def answer(prompt):
        if "hang" in prompt:
            time.sleep(30)
        if "slow start" in prompt and not seen.setdefault(prompt, 0):
            seen[prompt] = 1
            time.sleep(30)
        return json.dumps({"p": prompt})

    seen = {}
    return answer


def test_hanging_calls_end_at_their_deadline(spark):
    words = ["fine", "hang 1", "slow start", None] + [f"hang {i}" for i in range(2, 12)]
    df = spark.createDataFrame(list(enumerate(words)), "id int, prompt string").coalesce(1)
    settings = ModelSettings(timeout_seconds=0.4)
    start = time.monotonic()
    rows = {r.prompt: r.inference for r in inf.infer(
        df, "prompt", hangs, retry=FAST, threads=4, settings=settings).collect()}
    assert time.monotonic() - start < 25
    assert len(rows) == len(words) and rows["fine"].error_kind is None
    assert (rows["slow start"].attempts, rows["slow start"].error_kind) == (2, None)
    assert all((r.error_kind, r.attempts, r.reply) == ("timeout", 3, None)
               for p, r in rows.items() if p and p.startswith("hang"))


def test_deadline_respects_the_total():
    retry = RetrySettings(max_attempts=50, initial_wait_seconds=0.0, timeout_seconds=0.5)
    start = time.monotonic()
    result = inf._call(lambda p: time.sleep(5), "x", "m", retry, 0.2)
    assert result[2] == "timeout" and 2 <= result[3] <= 4
    assert time.monotonic() - start < 2


def test_late_calls_reach_the_fallback(spark):
    df = spark.createDataFrame([("fine",), ("hang",)], "prompt string")
    out = inf.infer(df, "prompt", hangs, fallback=steady, retry=RetrySettings(max_attempts=1),
                    settings=ModelSettings(timeout_seconds=0.3))
    assert {r.prompt: r.inference.model for r in out.collect()} == {
        "fine": "primary", "hang": "fallback"}


def test_settings_reach_the_backend(spark):
    def told(settings):
        return lambda prompt: json.dumps([settings.max_tokens, settings.timeout_seconds])

    df = spark.createDataFrame([("x",)], "prompt string")
    for stage, want in (("scoring", [800, 15.0]), ("summary", [2500, 40.0])):
        row = inf.infer(df, "prompt", told, **inf.stage_options(stage)).first()
        assert json.loads(row.inference.reply) == want


def test_budget_spaces_calls():
    budget, start = inf.Budget(50.0, burst=3), time.monotonic()
    waits = [budget.take() for _ in range(13)]
    assert waits[:3] == [0.0] * 3 and 0.18 <= time.monotonic() - start < 1.0
    with pytest.raises(ValueError):
        inf.Budget(0)


def test_budget_counts_retries_and_waits_as_time(spark):
    def stamps():
        def answer(prompt):
            raise ConnectionError(str(time.time()))
        return answer

    df = spark.range(6).select(F.col("id").cast("string").alias("prompt"))
    start = time.monotonic()
    rows = inf.infer(df, "prompt", stamps, retry=RetrySettings(2, 1.0, 0.0), threads=6,
                     max_concurrency=2, calls_per_second=20.0).collect()
    assert time.monotonic() - start >= 0.5 and all(r.inference.attempts == 2 for r in rows)
    with pytest.raises(ValueError):
        inf.infer(df, "prompt", stamps, calls_per_second=1.0)
