"""What a failed extraction becomes, and what counts as a reply or a complete document."""

from pyspark.sql import functions as F

from chartloom.functions import jsonval
from chartloom.operators import review
from chartloom.plans import gold
from chartloom.sources import files


def test_failures_are_told_apart(spark):
    docs = spark.createDataFrame(
        [("bad", "t", '{"error": "API timeout", "extraction_confidence": "failed"}'), ("none", "t", None),
         ("text", "t", "I cannot answer"), ("good", "t", '{"chief_complaint": "cough"}')],
        "document_id string, text string, entities string")
    decided = gold.assessed(docs)
    rows = {r.document_id: r for r in decided.collect()}
    for name in ("bad", "none", "text"):
        r = rows[name]
        assert (r.status, r.completeness_before, r.questions, r.ambiguities) == (review.FAILED, 0, [], [])
    assert rows["good"].status == review.QUEUED
    now = F.lit("2024-01-01").cast("timestamp")
    assert gold.auto_summaries(decided, now).count() == 0
    assert gold.review_queue(decided, now).count() == 1
    assert {tuple(r) for r in gold.failures(decided).collect()} == {
        ("bad", "API timeout"), ("none", "no entity document"), ("text", "no entity document")}


def test_replies_and_completeness(spark):
    texts = ['{"a": 1, "b": null}', "42", '{"a": 1, "a": 2}', 'sorry, I cannot "answer" 5', "[1]", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(
        jsonval.reply_or_default(F.col("t"), "D").alias("reply"),
        jsonval.completeness(F.col("t")).alias("share"))
    rows = df.collect()
    assert [r.reply for r in rows] == [texts[0], "D", "D", "D", "D", "D"]
    assert [r.share for r in rows][:4] == [0.5, 1.0, 0.0, 0.0]


def test_stream_of_a_table_folder_or_file(spark, tmp_path):
    folder = str(tmp_path / "events.parquet")
    frame = spark.range(10).withColumn("x", F.lit("a"))
    frame.repartition(3).write.parquet(folder)
    one = str(next((tmp_path / "events.parquet").glob("part-*.parquet")))
    for path in (folder, one):
        out, state = str(tmp_path / f"out{len(path)}"), str(tmp_path / f"state{len(path)}")
        rows = files.stream_table(spark, path, frame.schema)
        query = rows.writeStream.format("parquet").option("checkpointLocation", state).trigger(
            availableNow=True).start(out)
        query.awaitTermination()
        assert spark.read.parquet(out).count() == spark.read.parquet(path).count()
