"""Folders that executors list for a stream, so that the driver holds parts of a listing and no files."""

import json
import os
import time
from pathlib import Path

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from chartloom.config import StreamSettings
from chartloom.operators.parse import parse_documents
from chartloom.sources import files
from chartloom.sources.tables import run_stream
from chartloom.streaming import pipelines


def put(folder, name, when, text="<p>words of a page</p>"):
    path = Path(folder) / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    os.utime(path, (when, when))


def ingest(spark, folder, top, most=5, **more):
    settings = StreamSettings(max_files_per_trigger=most, **more)
    return pipelines.ingest(spark, str(folder), f"{top}/bronze", f"{top}/state", "*.html", settings=settings)


def ingested(spark, top):
    return sorted(r.path.rsplit("/", 1)[1] for r in spark.read.parquet(f"{top}/bronze").collect())


def followed(top):
    """What the stream's source has taken note of."""
    logs = [p.read_text().splitlines()[1:] for p in Path(top, "state/sources/0").iterdir() if not p.name.startswith(".")]
    return {json.loads(entry)["path"] for log in logs for entry in log}


def test_the_driver_follows_parts_and_no_files(spark, tmp_path):
    names = [f"p{i:02}.html" for i in range(40)]
    for i, name in enumerate(names):
        put(tmp_path / "in", name, 1_700_000_000 - i)  # the last one is the oldest
    query = ingest(spark, tmp_path / "in", tmp_path, 10)
    query.awaitTermination()
    assert [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]] == [10] * 4
    assert ingested(spark, tmp_path) == names
    assert len(followed(tmp_path)) == 4 and not any(p.endswith(".html") for p in followed(tmp_path))
    batches = spark.read.parquet(f"{tmp_path}/bronze").groupBy("ingestion_timestamp").agg(
        F.min("path").alias("least")).orderBy("ingestion_timestamp").collect()
    assert [r.least[-8:] for r in batches] == ["p30.html", "p20.html", "p10.html", "p00.html"]

    put(tmp_path / "in", "new.html", 1_600_000_000)  # older than all that were there
    for _ in range(2):
        ingest(spark, tmp_path / "in", tmp_path, 10).awaitTermination()
    assert ingested(spark, tmp_path) == ["new.html", *names]


@pytest.mark.parametrize("most, total, parts", [(10, 33, 10), (None, 9, 3), (3, 7, 3), (100, 6, 2)])
def test_parts_fill_micro_batches(spark, tmp_path, monkeypatch, most, total, parts):
    monkeypatch.setattr(files, "FILES_A_PART", 4)
    for i in range(total):
        put(tmp_path / "in", f"{i}.html", 1_700_000_000 + i % 3)
    listing = str(tmp_path / "listed")
    look = lambda: files.list_documents(spark, str(tmp_path / "in"), "*.html", listing, most)
    assert look() == total and look() == 0
    rows = spark.read.parquet(listing)
    found = [r["count"] for r in rows.groupBy(F.input_file_name()).count().collect()]
    assert len(found) == parts and sum(found) == total and max(found) <= 4
    [lost, *_] = Path(listing).glob("*.parquet")  # a call that failed before its last part
    left = total - spark.read.parquet(str(lost)).count()
    lost.unlink()
    assert spark.read.parquet(listing).count() == left and look() == total - left
    assert spark.read.parquet(listing).select("path").distinct().count() == total == spark.read.parquet(listing).count()


@pytest.mark.parametrize("glob", ["*.html", "{a,b*}.html", "[!a-c]*.html", "?.*", "*"])
def test_rows_are_those_of_sparks_own_source(spark, tmp_path, glob):
    for i, name in enumerate(("a.html", "b c.html", "p%20q.html", "x#y.html", "é.html", "_h.html", ".h.html", "_k=v.html",
                              "z.html._COPYING_", "e.HTML", "a,+1.html", "deep/d.html")):
        put(tmp_path / "in", name, 1_700_000_000.123 + i, name * (i + 1))
    put(tmp_path / "in", "empty.html", 1_700_000_000, "")
    (tmp_path / "in/link.html").symlink_to(tmp_path / "in/a.html")
    (tmp_path / "in/broken.html").symlink_to(tmp_path / "none")
    got = []
    for n, listing in enumerate((None, str(tmp_path / "listed"))):
        if listing:
            files.list_documents(spark, f"file://{tmp_path}/in", glob, listing, 3)
        stream = files.stream_documents(spark, str(tmp_path / "in"), glob, 3, listing)
        run_stream(stream, str(tmp_path / f"state{n}"), str(tmp_path / f"out{n}")).awaitTermination()
        rows = spark.read.schema(stream.schema).parquet(str(tmp_path / f"out{n}")).collect()
        got.append(sorted((r.path, r.modificationTime, r.length, bytes(r.content)) for r in rows))
    assert got[0] == got[1] != []


def test_a_file_that_has_gone_fails_the_stream_unless_the_session_ignores_it(spark, tmp_path):
    for name in ("a.html", "b.html"):
        put(tmp_path / "in", name, 1_700_000_000)
    files.list_documents(spark, str(tmp_path / "in"), "*.html", f"{tmp_path}/state/listed", 5)
    (tmp_path / "in/a.html").unlink()
    with pytest.raises(StreamingQueryException):
        ingest(spark, tmp_path / "in", tmp_path).awaitTermination()
    spark.conf.set("spark.sql.files.ignoreMissingFiles", "true")
    try:
        ingest(spark, tmp_path / "in", tmp_path).awaitTermination()
    finally:
        spark.conf.unset("spark.sql.files.ignoreMissingFiles")
    assert ingested(spark, tmp_path) == ["b.html"]


def test_other_folders_and_checkpoints_keep_sparks_own_source(spark, tmp_path):
    put(tmp_path / "in", "a.html", 1_700_000_000)
    folder, state = str(tmp_path / "in"), f"{tmp_path}/state"
    assert files.listing_for(spark, folder, state) == f"{state}/listed"
    for other in (f"{tmp_path}/i*", f"{tmp_path}/none", "viewfs://store/in"):
        assert files.listing_for(spark, other, state) is None
    run_stream(parse_documents(files.stream_documents(spark, folder, "*.html", 5)), state, f"{tmp_path}/bronze").awaitTermination()
    put(tmp_path / "in", "b.html", 1_700_000_001)
    ingest(spark, folder, tmp_path).awaitTermination()  # a checkpoint of before
    assert ingested(spark, tmp_path) == ["a.html", "b.html"]
    assert {Path(p).name for p in followed(tmp_path)} == {"a.html", "b.html"}


def test_continuous_streams_find_files_that_arrive_later(spark, tmp_path):
    (tmp_path / "in").mkdir()
    query = ingest(spark, tmp_path / "in", tmp_path, continuous=True, processing_time="1 second")
    try:
        for count, name in enumerate(("a.html", "b.html"), 1):
            put(tmp_path / "in", name, 1_700_000_000)
            until = time.time() + 60
            while sum(p["numInputRows"] for p in query.recentProgress) < count and time.time() < until:
                time.sleep(0.5)
    finally:
        query.stop()
    assert ingested(spark, tmp_path) == ["a.html", "b.html"]
