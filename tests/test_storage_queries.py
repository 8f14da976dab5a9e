"""Snapshots under crashes and replays, table grids, files, arrivals, and the index."""

import pytest
from pyspark.sql import functions as F

from chartloom.operators import grids, search
from chartloom.operators import measures as ms
from chartloom.operators import review as rv
from chartloom.schemas import STATUS_LOG
from chartloom.sources import snapshots
from chartloom.sources.files import scan_documents, stream_table, write_files
from chartloom.sources.tables import run_stream
from chartloom.streaming import pipelines


def log(spark, *rows):
    return spark.createDataFrame(rows, "document_id string, status string, at string").select(
        "document_id", "status", F.col("at").cast("timestamp").alias("updated_timestamp"))


def state(spark, folder):
    return {r.document_id: r.status for r in snapshots.read_snapshot(spark, folder, STATUS_LOG).collect()}


def compact(spark, folder, changes):
    return snapshots.compact(spark, folder, changes, "document_id", STATUS_LOG, rv.latest_status)


def test_snapshots(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "t")
    snapshots.create_snapshots(spark, folder, buckets=8)
    assert state(spark, folder) == {} and compact(spark, folder, log(spark, ("x", "s", "2024-01-01")).limit(0)) == []
    first = log(spark, *[(f"d{i}", "new", "2024-01-01") for i in range(40)])
    assert len(compact(spark, folder, first)) == 8
    before = snapshots.current(spark, folder)
    change = log(spark, ("d1", "done", "2024-01-03"), ("d1", "older", "2024-01-02"), ("extra", "new", "2024-01-01"))
    publish = snapshots._publish
    monkeypatch.setattr(snapshots, "_publish", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        compact(spark, folder, change)
    assert snapshots.current(spark, folder) == before and len(state(spark, folder)) == 40
    monkeypatch.setattr(snapshots, "_publish", publish)
    reader = snapshots.read_snapshot(spark, folder, STATUS_LOG)  # of the version before
    touched = compact(spark, folder, change)
    assert touched == compact(spark, folder, change) and len(touched) <= 2
    after = snapshots.current(spark, folder)
    assert all(after[2][b] == p for b, p in before[2].items() if b not in touched)
    want = {f"d{i}": "new" for i in range(40)} | {"d1": "done", "extra": "new"}
    assert state(spark, folder) == want and reader.count() == 40


def cells(spark, html):
    df = spark.createDataFrame([(html,)], "html string")
    return [(r.table, r.parent, r.row, r.column, r.rows, r.columns, r.header, r.text)
            for r in grids.table_cells(df).orderBy("table", "row", "column").collect()]


@pytest.mark.parametrize("html, want", [
    (None, []), ("<p>none", []), ("<table></table>", []),
    ("<table><td>a<td rowspan=2>b<tr><td>c<td>d</table>",
     [(0, None, 0, 0, 1, 1, False, "a"), (0, None, 0, 1, 2, 1, False, "b"), (0, None, 1, 0, 1, 1, False, "c"),
      (0, None, 1, 2, 1, 1, False, "d")]),
    ("<TABLE><tr><th>o &lt; x<table><tr><td>in<table><tr><td>most</table>ner</table> out<tr><td>z",
     [(0, None, 0, 0, 1, 1, True, "o < x out"), (0, None, 1, 0, 1, 1, False, "z"), (1, 0, 0, 0, 1, 1, False, "inner"),
      (2, 1, 0, 0, 1, 1, False, "most")]),
    ("</td></table><table><tr><td colspan=x rowspan=0>a<script>if (a<td>b)</script><!-- <td> --></td><td>b",
     [(0, None, 0, 0, 1, 1, False, "a"), (0, None, 0, 1, 1, 1, False, "b")]),
])
def test_grids(spark, html, want):
    assert cells(spark, html) == want


def test_deeply_nested_tables(spark):
    got = cells(spark, "<table><tr><td>x" * 300)
    assert len(got) == 300 and got[299][:2] == (299, 298)


def test_written_files_read_back(spark, tmp_path):
    folder = str(tmp_path / "files")
    df = spark.createDataFrame([("a.html", b"one"), ("b.html", None), ("c.txt", b"two")], "name string, content binary")
    assert write_files(df, folder, "name", "content") == 3 == write_files(df, folder, "name", "content")
    rows = scan_documents(spark, folder, "*.html").select("path", "content").collect()
    assert sorted((r.path.rsplit("/", 1)[1], bytes(r.content)) for r in rows) == [("a.html", b"one")]
    assert (tmp_path / "files" / "b.html").read_bytes() == b""  # Spark's scan passes empty files over


def test_first_arrivals_across_batches(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "state"))
    rows = lambda *r: spark.createDataFrame(r, "document_id string, t string").select(
        "document_id", F.col("t").cast("timestamp").alias("arrived")).coalesce(1)
    got = []
    for batch in (rows(("a", "2024-01-01 00:00:00"), ("a", "2024-01-01 00:01:00"), ("b", "2024-01-01 00:00:00")),
                  rows(("a", "2024-01-01 01:00:00"), ("c", "2024-01-01 01:00:00")),
                  rows(("b", "2024-01-01 02:00:00"), ("c", "2024-01-01 02:00:00"))):
        batch.write.mode("append").parquet(source)
        stream = pipelines.first_arrivals(stream_table(spark, source, batch.schema, max_files=1))
        run_stream(stream, checkpoint, path=out).awaitTermination()  # the state outlives each run
        got.append(sorted(r.document_id for r in spark.read.parquet(out).collect()))
    assert got == [["a", "b"], ["a", "b", "c"], ["a", "b", "c"]]


def test_observed(spark, tmp_path):
    path = str(tmp_path / "o")
    done, rows = ms.observed(
        spark.range(10), "stage", lambda df: df.write.parquet(path), most=F.max("id"), none=F.max(F.lit(None).cast("int")))
    values = {name: value for stage, name, value in rows}
    assert done is None and values["rows"] == 10 and values["most"] == 9 and values["none"] is None and values["seconds"] > 0


def test_index_cells_and_recall(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(search, "CELL_ROWS", 20)
    monkeypatch.setattr(search, "CELL_QUERIES", 3)
    vectors = spark.range(400).select(
        F.col("id").alias("vec_id"),
        F.array(*[F.sin(F.col("id") * (i + 1) / 7.0) for i in range(6)]).alias("embedding"))
    queries = vectors.filter("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))
    index = search.build_index(vectors, str(tmp_path / "lists"), 8, sample=100)
    assert spark.read.parquet(index.folder).count() == 400
    exact = search.vector_topk(vectors, queries, 5)
    whole = search.index_topk(queries, index, 5, probes=8)
    key = lambda df: sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in df.collect())
    assert key(whole) == key(exact)
    probes = search.probes_for(queries, exact, index, 0.95)
    hits = search.recall(search.index_topk(queries, index, 5, probes), exact).agg(F.sum("hits"), F.sum("wanted")).first()
    assert hits[0] >= 0.9 * hits[1] and hits[1] == 100
