"""WARC archives: written as one gzip stream a file, normalised to a member per record.

Records are written by Spark's text writer: a record ends with two line ends, and so does each
of the writer's rows, so a compressed part file is a monolithic WARC archive.  The normaliser
inflates each such file once, as a stream, cuts it into records by their stated lengths and
writes every record as a gzip member of its own, with a sidecar index of offsets beside the
archive.  The reader opens archives by their sidecars, a record at a time.

Archives and sidecars are first written under a name of the attempt and then renamed, so tasks
can be lost and run again.  Files are opened through pyarrow's file systems, which know local,
hdfs, s3 and gs folders; the folder must be one that all executors share.

Rows and cases: a null payload is empty; payloads that are equal and have at least the stated
number of bytes are kept once, by the row with the largest id, and revisited by the others;
null ids get no records and no rows; rows that repeat an id are a record each, those with the
kept payload all responses; a null address is written as empty; other columns play no
part; an empty table gives no archives.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import unquote, urlsplit

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartloom.llm.common import fresh_dir

LINE = "\r\n"
LEAST_BYTES = 0
RECORDS_PER_FILE = 20_000
CHUNK = 1 << 20


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    if "://" not in uri:
        parts = urlsplit(uri)
        return pafs.LocalFileSystem(), unquote(parts.path) if parts.scheme == "file" else uri
    return pafs.FileSystem.from_uri(uri)


def base32_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _base32(sha1_hex: Column) -> Column:
    """Upper-case base32 of a 20-byte digest in hex: 8 groups of 5 hex digits, 4 letters each."""
    digits = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    groups = [F.lpad(F.conv(F.substring(sha1_hex, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*groups), digits, letters)


def classified(pages: DataFrame, id_col: str, payload_col: str, url_col: str,
               least_bytes: int) -> DataFrame:
    """page_id, url, payload, bytes, digest, refers_to: null for a response."""
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.coalesce(F.col(url_col).cast("string"), F.lit("")).alias("url"),
        F.coalesce(F.col(payload_col).cast("string"), F.lit("")).alias("payload"),
    ).filter("page_id IS NOT NULL").withColumn("bytes", F.octet_length("payload").cast("long"))
    rows = rows.withColumn("digest", _base32(F.sha1(F.col("payload").cast("binary"))))
    winners = (
        rows.filter(F.col("bytes") >= least_bytes)
        .groupBy("digest", "bytes").agg(F.max("page_id").alias("winner"), F.count("*").alias("n"))
        .filter("n > 1").select("digest", "bytes", "winner")
    )
    joined = rows.join(winners, ["digest", "bytes"], "left")
    return joined.select(
        "page_id", "url", "payload", "bytes", "digest",
        F.when(F.col("winner") != F.col("page_id"), F.col("winner")).alias("refers_to"))


def _clean(value: Column) -> Column:
    return F.regexp_replace(value, "[\\r\\n]+", " ")


def record_text(date: str) -> Column:
    """A record without its two closing line ends, which the writer adds."""
    revisit = F.col("refers_to").isNotNull()
    page = lambda c: F.concat(F.lit("<urn:page:"), F.col(c).cast("string"), F.lit(">"))
    body = F.when(revisit, F.lit("")).otherwise(F.col("payload"))
    head = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        F.concat(F.lit("WARC-Record-ID: "), page("page_id")),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Target-URI: "), _clean(F.col("url"))),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), page("refers_to"))),
        F.when(revisit, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        F.when(revisit, F.concat(F.lit("X-Payload-Length: "), F.col("bytes").cast("string"))),
        F.lit("Content-Type: text/html; charset=utf-8"),
        F.concat(F.lit("Content-Length: "), F.octet_length(body).cast("string")),
    ]
    return F.concat(F.concat_ws(LINE, *head), F.lit(LINE * 2), body)


def write_monolithic(pages: DataFrame, folder: str, id_col: str = "page_id",
                     payload_col: str = "html", url_col: str = "url",
                     least_bytes: int = LEAST_BYTES, records_per_file: int = RECORDS_PER_FILE,
                     date: str = "2020-01-01T00:00:00Z") -> None:
    rows = classified(pages, id_col, payload_col, url_col, least_bytes)
    (
        rows.select(record_text(date).alias("value"))
        .write.option("lineSep", LINE * 2).option("compression", "gzip")
        .option("maxRecordsPerFile", records_per_file).text(folder)
    )


def _inflated(file, size: int = CHUNK) -> Iterator[bytes]:
    """The bytes of a gzip file, whatever its members, in pieces."""
    stream = zlib.decompressobj(31)
    while raw := file.read(size):
        while raw:
            yield stream.decompress(raw)
            raw = stream.unused_data
            if stream.eof:
                stream = zlib.decompressobj(31)
            else:
                break
    yield stream.flush()


def header_of(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8").split(LINE)
    return {name.lower(): value.strip() for name, _, value in (x.partition(":") for x in lines[1:])}


def records(pieces: Iterator[bytes]) -> Iterator[bytes]:
    """Whole records, closing line ends included, from a stream."""
    held = bytearray()
    mark = LINE.encode() * 2

    def fill(n: int) -> bool:
        while len(held) < n:
            piece = next(pieces, None)
            if piece is None:
                return False
            held.extend(piece)
        return True

    while True:
        at = held.find(mark)
        while at < 0:
            seen = len(held)
            if not fill(seen + 1):
                if held.strip():
                    raise ValueError("an archive ends within a record's head")
                return
            at = held.find(mark, max(0, seen - 3))
        length = at + 4 + int(header_of(bytes(held[:at]))["content-length"]) + 4
        if not fill(length):
            raise ValueError("an archive ends within a record")
        yield bytes(held[:length])
        del held[:length]


def normalise(spark, source: str, target: str) -> DataFrame:
    """Rewrite each archive of ``source`` in ``target``; (archive, records, bytes) of each."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(source).select(
        "path")
    files = files.repartition(max(1, spark.sparkContext.defaultParallelism), "path")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_pylist([_normalise_one(path, target)])

    return files.mapInArrow(run, "archive string, records long, bytes long")


def _normalise_one(path: str, target: str) -> dict:
    fs, source = file_system(path)
    out, folder = file_system(target)
    name = path.rsplit("/", 1)[-1].removesuffix(".gz").removesuffix(".txt") + ".warc.gz"
    attempt = f"{folder}/.{name}.{uuid.uuid4().hex}"
    out.create_dir(folder, recursive=True)
    offset, index = 0, []
    with fs.open_input_stream(source, compression=None) as file, out.open_output_stream(
            attempt, compression=None) as archive:
        for record in records(_inflated(file)):
            packer = zlib.compressobj(6, zlib.DEFLATED, 31)
            member = packer.compress(record) + packer.flush()
            archive.write(member)
            index.append((offset, len(member)))
            offset += len(member)
    with out.open_output_stream(f"{attempt}.idx", compression=None) as side:
        side.write("".join(json.dumps({"offset": o, "length": n}) + "\n" for o, n in index).encode())
    out.move(f"{attempt}.idx", f"{folder}/{name}.idx")
    out.move(attempt, f"{folder}/{name}")
    return {"archive": f"{target}/{name}", "records": len(index), "bytes": offset}


def read_archives(archives: DataFrame) -> DataFrame:
    """A row per record of the normalised archives: page_id, record_type, refers_to, url,
    payload (null for a revisit), payload_bytes, payload_digest, offset, length.

    Each record is inflated alone, at its offset; a response whose payload does not have the
    stated digest raises.
    """
    schema = pa.schema([
        ("page_id", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64()),
        ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()), ("archive", pa.string()), ("offset", pa.int64()),
        ("length", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                held, size = [], 0
                for row in _rows(path):
                    held.append(row)
                    size += row["length"]
                    if size > CHUNK:
                        yield pa.RecordBatch.from_pylist(held, schema)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema)

    return archives.select("archive").mapInArrow(
        run, "page_id long, record_type string, refers_to long, url string, payload binary, "
        "payload_bytes long, payload_digest string, archive string, offset long, length long")


def _rows(path: str) -> Iterator[dict]:
    fs, place = file_system(path)
    with fs.open_input_stream(f"{place}.idx", compression=None) as side:
        index = [json.loads(line) for line in side.read().decode().splitlines()]
    number = lambda urn: int(urn.removeprefix("<urn:page:").removesuffix(">"))
    with fs.open_input_file(place) as archive:
        for entry in index:
            archive.seek(entry["offset"])
            record = zlib.decompress(archive.read(entry["length"]), 31)
            head, _, rest = record.partition(LINE.encode() * 2)
            about = header_of(head)
            payload = rest[: int(about["content-length"])]
            digest = about["warc-payload-digest"].removeprefix("sha1:")
            response = about["warc-type"] == "response"
            if response and base32_digest(payload) != digest:
                raise ValueError(f"{path} at {entry['offset']}: the payload has another digest")
            yield {
                "page_id": number(about["warc-record-id"]), "record_type": about["warc-type"],
                "refers_to": None if response else number(about["warc-refers-to"]),
                "url": about["warc-target-uri"], "payload": payload if response else None,
                "payload_bytes": len(payload) if response else int(about["x-payload-length"]),
                "payload_digest": digest, "archive": path, **entry}


def round_trip(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Write, normalise and read back the records of all pages, as of :func:`read_archives`."""
    spark = pages.sparkSession
    raw, normal = fresh_dir(spark, "warc-raw"), fresh_dir(spark, "warc")
    write_monolithic(pages, raw, least_bytes=least_bytes)
    listed = f"{normal}-list"
    normalise(spark, raw, normal).write.parquet(listed)
    archives = spark.read.parquet(listed).repartition(
        max(1, spark.sparkContext.defaultParallelism), "archive")
    return read_archives(archives)
