"""Archives written, normalised and read back."""

import gzip
import zlib

import pytest

from chartloom.llm import warc
from chartloom.llm.common import fresh_dir

PAGES = [
    (1, "http://a", "<p>one</p>"), (2, "http://b\r\nx: y", "<p>one</p>"), (3, None, None), (4, "d", ""),
    (5, "e", "é\r\n\r\nWARC/1.1\r\nContent-Length: 9\r\n\r\n"), (6, "f", "long " * 300_000),
    (9, "g", "<p>one</p>"), (9, "g", "<p>one</p>"), (None, "h", "lost"), (10, "i", "last\r\n\r\n"),
]


def pages(spark, rows=PAGES):
    return spark.createDataFrame([(*r, b"x", 1) for r in rows],
                                 "page_id long, url string, html string, payload binary, digest int")


def test_round_trip(spark):
    rows = warc.round_trip(pages(spark)).collect()
    assert sorted((r.page_id, r.record_type, r.refers_to, r.payload_bytes) for r in rows) == [
        (1, "revisit", 9, 10), (2, "revisit", 9, 10), (3, "revisit", 4, 0), (4, "response", None, 0),
        (5, "response", None, len(PAGES[4][2].encode())), (6, "response", None, 1_500_000), (9, "response", None, 10),
        (9, "response", None, 10), (10, "response", None, 8)]
    html = {i: (h or "").encode() for i, _, h in PAGES}
    for r in rows:
        assert r.payload_digest == warc.base32_digest(html[r.page_id])
        assert r.record_type == "revisit" or r.payload == html[r.page_id]


def test_least_bytes(spark):
    rows = warc.round_trip(pages(spark), least_bytes=11).collect()
    assert all(r.record_type == "response" for r in rows) and len(rows) == 9


def test_members_and_index(spark, tmp_path):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    warc.write_monolithic(pages(spark).coalesce(1), raw, records_per_file=4)
    done = warc.normalise(spark, raw, out).collect()
    assert sum(r.records for r in done) == 9 and len(done) >= 3
    for part in (tmp_path / "raw").glob("*.gz"):
        stream = zlib.decompressobj(31)  # one stream holds the whole file
        stream.decompress(part.read_bytes())
        assert stream.eof and not stream.unused_data
    for r in warc.read_archives(spark.createDataFrame(done)).collect():
        with open(r.archive, "rb") as file:
            file.seek(r.offset)
            member = file.read(r.length)
        assert gzip.decompress(member).startswith(b"WARC/1.1\r\n")
    assert not list((tmp_path / "out").glob(".*warc*"))


def test_streams():
    text = b"WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" * 2
    for size in (1, 5, 1000):
        pieces = iter([text[i:i + size] for i in range(0, len(text), size)])
        assert list(warc.records(pieces)) == [text[: len(text) // 2]] * 2
    with pytest.raises(ValueError):
        list(warc.records(iter([text[:-3]])))


def test_empty_table(spark):
    assert warc.round_trip(pages(spark, [])).count() == 0
    assert fresh_dir(spark, "x") != fresh_dir(spark, "x")
