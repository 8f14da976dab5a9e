"""Document files and tables as batch or stream."""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator
from itertools import batched
from urllib.parse import unquote, urlsplit

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from chartloom.config import StreamSettings
from chartloom.schemas import BINARY_FILE, LISTED_FILE
from chartloom.sources.tables import BATCH_BYTES, materialise

#: Files in a part of a listing, and files that one task opens, at most.
FILES_A_PART, FILES_A_TASK = 8192, 2048

#: Jobs that write a listing at most; micro-batches written by one job come in any order.
LISTING_JOBS = 100


def scan_documents(
    spark: SparkSession, path: str, glob: str = "*.pdf", recursive: bool = True
) -> DataFrame:
    """Files under a folder: ``path, modificationTime, length, content``.

    The content is only read when a later step uses it.  Files without a byte are passed over.
    """
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", str(recursive).lower())
        .load(path)
    )


def stream_documents(
    spark: SparkSession,
    path: str,
    glob: str = "*.pdf",
    max_files: int | None = StreamSettings.max_files_per_trigger,
    listing: str | None = None,
) -> DataFrame:
    """The same rows as a stream of new files, a few files per micro-batch.

    Spark's own source keeps every file of the folder in the driver.  With a ``listing``, which
    :func:`list_documents` fills, the stream follows its parts and executors open the files.
    """
    if listing is None:
        return (
            spark.readStream.format("binaryFile")
            .schema(BINARY_FILE)
            .option("pathGlobFilter", glob)
            .option("maxFilesPerTrigger", max_files)
            .load(path)
        )
    rows = stream_table(spark, listing, LISTED_FILE, max_files and _split(max_files, FILES_A_PART))
    cores = spark.sparkContext.defaultParallelism
    return _opened(rows.repartition(max(cores, _split(max_files or 0, FILES_A_TASK)), "path"))


def listing_for(spark: SparkSession, path: str, checkpoint: str) -> str | None:
    """Where a stream with that checkpoint has the listing of a folder.

    None where Spark's own source is needed: for patterns, for stores that are not part of the
    executors' file tree, and for checkpoints that began with that source.
    """
    listing = f"{checkpoint}/listed"
    if _place(spark, path) is None:
        return None
    if _stored(spark, listing) is None:
        begun = _stored(spark, f"{checkpoint}/sources/0", "text", "value string")
        if begun is not None and begun.inputFiles():
            return None
    return listing


def list_documents(
    spark: SparkSession, path: str, glob: str, listing: str, max_files: int | None = None
) -> int:
    """Append the files of a folder that are not listed yet, oldest first; how many they are.

    The files of a micro-batch of ``max_files`` fill as many parts as :func:`stream_documents` takes
    at once.  A part appears as a whole, and files of parts that are missing after a failure
    are found again by the next call.
    """
    found, known = _found(spark, _place(spark, path), glob), _stored(spark, listing)
    if known is not None:
        found = found.join(known.select("path"), "path", "left_anti")
    new = materialise(found.select(*LISTED_FILE.fieldNames()).orderBy("modified", "path").withColumns({
        "share": F.spark_partition_id(),
        "row": F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)}), "listing")  # within the share
    before, starts = 0, []
    for share, count in sorted(new.groupBy("share").count().collect()):
        starts.append((share, before))
        before += count
    if not before:
        return 0
    size = max_files or before
    whole, rest, parts = before // size, before % size, _split(size, FILES_A_PART)
    last = _split(rest, FILES_A_PART)
    row, edge = F.col("row") + F.col("before"), whole * size
    numbered = new.join(F.broadcast(spark.createDataFrame(starts, "share int, before long")), "share").withColumn(
        "part", F.when(row < edge, F.floor(row * parts / size))
        .otherwise(whole * parts + F.floor((row - edge) * last / max(rest, 1))))
    every = whole * parts + last
    step = parts * _split(whole + 1, LISTING_JOBS)
    for start in range(0, every, step):  # a part's time is that of its job, and streams follow times
        some = numbered.filter(F.col("part").between(start, start + step - 1))
        some.repartitionById(min(step, every - start), (F.col("part") - start).cast("int")).select(
            *LISTED_FILE.fieldNames()).write.mode("append").parquet(listing, compression="zstd")
    return before


def _split(count: int, most: int) -> int:
    return -(-count // most)


def _stored(spark: SparkSession, folder: str, kind: str = "parquet", schema=LISTED_FILE) -> DataFrame | None:
    try:
        return spark.read.schema(schema).format(kind).load(folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _place(spark: SparkSession, path: str) -> str | None:
    """A folder in the file tree that all executors share."""
    scheme, place = re.fullmatch(r"(?:([A-Za-z][\w+.-]*):(?://[^/]*)?)?(.*)", path, re.DOTALL).groups()
    usual = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")
    if (scheme or usual.partition(":")[0]) != "file" or re.search(r"[*?\[\]{}\\]", place):
        return None
    return os.path.abspath(place) if os.path.isdir(place) else None


def _files(folder: str, partition: bool = False) -> Iterator[os.DirEntry]:
    """What Spark's stream finds in a folder: no hidden files, no folders but those of partitions."""
    with os.scandir(folder) as entries:
        for entry in entries:
            name = entry.name
            if name.startswith(".") or name.startswith("_") and "=" not in name or name.endswith("._COPYING_"):
                continue
            if entry.is_file():
                yield entry
            elif (partition or "=" in name) and entry.is_dir():
                yield from _files(entry.path, True)


def _found(spark: SparkSession, place: str, glob: str) -> DataFrame:
    """Path and time of each file as it lies in the folder, read by one task as a stream of entries."""
    pattern = spark.sparkContext._jvm.org.apache.hadoop.fs.GlobPattern(glob).compiled().pattern()
    matches = re.compile(pattern, re.DOTALL).fullmatch

    def entries() -> Iterator[tuple[str, int]]:
        for entry in _files(place):
            if matches(entry.name):
                try:
                    yield f"file:{entry.path}", entry.stat().st_mtime_ns // 1_000_000
                except FileNotFoundError:  # gone meanwhile
                    continue

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _ in batches:
            for some in batched(entries(), FILES_A_PART):
                paths, times = zip(*some)
                yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(times, pa.int64())], LISTED_FILE.fieldNames())

    return spark.range(0, 1, 1, 1).mapInArrow(run, LISTED_FILE)


def _opened(listed: DataFrame) -> DataFrame:
    """Listed files as ``path, modificationTime, length, content``, as they are when they are opened."""
    ignored = listed.sparkSession.conf.get("spark.sql.files.ignoreMissingFiles") == "true"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(rows: list[tuple]) -> pa.RecordBatch:
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["path", "modified", "length", "content"])

        for paths in batches:
            rows, size = [], 0
            for path in paths.column(0).to_pylist():
                try:
                    with open(path.removeprefix("file:"), "rb") as file:
                        raw, time = file.read(), os.fstat(file.fileno()).st_mtime_ns // 1_000_000
                except FileNotFoundError:
                    if ignored:
                        continue
                    raise
                if raw:  # Spark's scans pass empty files over
                    rows.append((path, time, len(raw), raw))
                    size += len(raw)
                if size >= BATCH_BYTES:
                    yield batch(rows)
                    rows, size = [], 0
            if rows:
                yield batch(rows)

    rows = listed.select("path").mapInArrow(run, "path string, modified long, length long, content binary")
    return rows.select("path", F.timestamp_millis("modified").alias("modificationTime"), "length", "content")


def stream_table(
    spark: SparkSession,
    path: str,
    schema: StructType,
    max_files: int | None = None,
    glob: str | None = None,
) -> DataFrame:
    """Rows appended to a parquet folder, as a stream; a table of a single file works too."""
    reader = spark.readStream.format("parquet").schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    # as a pattern, for a stream's plain path must be a folder
    return reader.load(f"{path[:-1]}[{path[-1]}]")


def write_files(df: DataFrame, folder: str, name: str, content: str) -> int:
    """Lay out rows as files in a folder that all executors share; how many were written.

    A file appears under its name when it is whole, so a task may run again.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if "://" in folder:
            fs, place = pafs.FileSystem.from_uri(folder)
        else:
            parts = urlsplit(folder)
            fs, place = pafs.LocalFileSystem(), unquote(parts.path) if parts.scheme == "file" else folder
        fs.create_dir(place, recursive=True)
        for batch in batches:
            for own, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                attempt = f"{place}/.{own}.{uuid.uuid4().hex}"
                with fs.open_output_stream(attempt, compression=None) as out:
                    out.write(raw or b"")
                fs.move(attempt, f"{place}/{own}")
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["n"])

    rows = df.select(F.col(name).cast("string"), F.col(content).cast("binary"))
    return rows.mapInArrow(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
