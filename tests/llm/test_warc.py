"""WARC archives: exact round trips and broken archives."""

import io
import struct

import pytest
from pyspark.sql import functions as F

from seqtally.llm import warc_zstd as W
from seqtally.llm._files import filesystem, new_folder

PAGES = "page_id long, url string, html string"


def want(rows, min_bytes=0):
    least = {}
    for i, _, h in rows:
        if i is not None:
            least[h or ""] = min(least.get(h or "", i), i)
    out = []
    for i, _, h in rows:
        data = (h or "").encode()
        first = least.get(h or "", i) if len(data) >= min_bytes else i
        out.append((i, len(data), W.payload_digest(data), "response" if first == i else "revisit", None if first == i else first))
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r)[:5] for r in df.collect()), key=str)


ROWS = ([(i, f"http://x/{i} é\r\n", f"<html>{i % 40}\r\n\r\n</html>" + "pad " * (i % 7)) for i in range(400)]
        + [(500, None, None), (501, "u", ""), (502, "u", "é" * 300_000), (None, "u", "é" * 300_000), (None, "v", "alone"),
           (7, "again", "<html>7\r\n\r\n</html>"), (503, "u", "\x00\r\n\r\nWARC/1.1\r\n")])


@pytest.mark.parametrize("min_bytes", [0, 30])
def test_round_trip(spark, min_bytes):
    folder = new_folder(spark, "warc-test")
    pages = spark.createDataFrame(ROWS, PAGES).withColumn("digest", F.lit("clash")).repartition(5)
    archives = W.write_archives(pages, folder, min_bytes)
    got = W.read_archives(archives, folder)
    assert result(got) == want(ROWS, min_bytes)
    uris = {r.page_id: r.target_uri for r in got.collect()}
    assert uris[3] == "http://x/3%20é%0D%0A" and uris[500] is None


def test_empty_table(spark):
    assert W.archive_table(spark, spark.createDataFrame([], PAGES)).count() == 0


def test_broken_records():
    good = W.record(1, "u", b"body", None, "2024-01-01T00:00:00Z")
    assert W.parse(good)[:4] == (1, 4, W.payload_digest(b"body"), "response")
    for bad in (good.replace(b"WARC/1.1", b"WARC/9"), good.replace(b"body", b"bod"), good.replace(b"body", b"hody"),
                good.replace(b"WARC-Date", b"X-Date"), good[:-1], good.replace(b"response", b"metadata"),
                good.replace(b"Content-Length: 4", b"Content-Length: 5"), good.replace(b"WARC-Type:", b"WARC-Type")):
        with pytest.raises(W.WarcError):
            W.parse(bad)
    for bad in (b"", struct.pack("<II", 1, 0), struct.pack("<II", W.SKIPPABLE, 50) + b"x",
                struct.pack("<II", W.SKIPPABLE, 0) + b"no frame"):
        with pytest.raises(W.WarcError):
            list(W.frames(io.BytesIO(bad)))


def test_cut_archive_is_reported(spark):
    folder = new_folder(spark, "warc-cut")
    pages = spark.createDataFrame([(i, "u", f"text {i}") for i in range(50)], PAGES).coalesce(1)
    archives = W.write_archives(pages, folder)
    file = archives.first().file
    fs, path = filesystem(folder)
    with fs.open_input_stream(f"{path}/{file}") as f:
        data = f.read()
    with fs.open_output_stream(f"{path}/{file}") as f:
        f.write(data[:-9])
    with pytest.raises(Exception, match="record 49"):
        W.read_archives(archives, folder).collect()
    rows = W.read_archives(archives, folder, errors="report").collect()
    assert sum(r.error is None for r in rows) == 49 and sum(r.error is not None for r in rows) == 1
