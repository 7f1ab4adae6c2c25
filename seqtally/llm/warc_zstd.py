"""WARC archives with one zstandard frame per record and a shared dictionary.

An archive begins with a skippable frame (magic 0x184D2A5D) that holds the
dictionary, then has one frame per record.  The writer turns each page into a
``response`` record, or into a ``revisit`` of the page with the smallest page_id
among those with an equal payload.  The reader loads the dictionary from the
leading frame, decodes frame by frame (a record is all it holds at once) and
validates version, headers, lengths and digests.

Which pages are revisits is found on digests alone; html is joined to the list
of revisits by page_id, so a payload that a third of all pages share makes no
hot join key.  Tasks write archives into the shared folder under names of their
own; the table of archives written by Spark says which count.

Defined results: a null html is the empty payload; pages with the smallest
page_id of their payload are responses (all of them, where a page_id repeats);
a null page_id is larger than any other and comes back null; a null url has no
WARC-Target-URI; control characters and blanks of a url are percent-encoded;
further columns are ignored; an empty table makes no archive and no rows."""

from __future__ import annotations

import base64
import hashlib
import struct

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqtally.llm._files import filesystem, new_folder, own_name, staged
from seqtally.llm._sample import hashed_sample

# --- fixed values: names and magic numbers of the formats -----------------------
SKIPPABLE = 0x184D2A5D
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REQUIRED = ("warc-type", "warc-record-id", "warc-date", "content-length")
# --------------------------------------------------------------------------------
LEVEL = 3
#: A task starts another archive beyond so many bytes.
ARCHIVE_BYTES = 1 << 30
#: The dictionary's sample: about so many pages of at most so many bytes.
SAMPLE_PAGES, SAMPLE_BYTES, DICTIONARY_BYTES = 400, 32 << 10, 64 << 10
READ_BYTES = 1 << 20

ARCHIVES = "file string, n_records long, n_bytes long"
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, target_uri string"


class WarcError(ValueError):
    """An archive or record that breaks the format."""


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _urn(page_id) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}>"


def _uri(url: str) -> str:
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url)


def record(page_id, url: str | None, payload: bytes, refers_to, date: str) -> bytes:
    """One whole record; a revisit keeps the payload's length in its HTTP head."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = head.encode() + (payload if refers_to is None else b"")
    lines = [VERSION, f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {_urn(page_id)}",
             f"WARC-Date: {date}", "Content-Type: application/http;msgtype=response",
             f"WARC-Payload-Digest: sha1:{payload_digest(payload)}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_uri(url)}")
    if refers_to is not None:
        lines += [f"WARC-Refers-To: {_urn(refers_to)}", f"WARC-Profile: {REVISIT_PROFILE}"]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _headers(raw: bytes, what: str) -> dict[str, str]:
    out = {}
    for line in raw.decode().split("\r\n"):
        name, colon, value = line.partition(":")
        if not colon or not name.strip():
            raise WarcError(f"{what}: no header: {line[:80]!r}")
        out[name.strip().lower()] = value.strip()
    return out


def _page(urn: str):
    if not urn.startswith("<urn:x-page:") or not urn.endswith(">"):
        raise WarcError(f"no page identifier: {urn[:80]!r}")
    return int(urn[12:-1]) if urn[12:-1] else None


def parse(raw: bytes) -> tuple:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to,
    target_uri) of one record, or ``WarcError``."""
    head, blank, rest = raw.partition(b"\r\n\r\n")
    version, _, fields = head.partition(b"\r\n")
    if not blank or version != VERSION.encode():
        raise WarcError(f"no {VERSION} record: {raw[:40]!r}")
    headers = _headers(fields, "record")
    missing = [h for h in REQUIRED if h not in headers]
    if missing:
        raise WarcError(f"no header {', '.join(missing)}")
    if not headers["content-length"].isdigit() or len(rest) != int(headers["content-length"]) + 4 or rest[-4:] != b"\r\n\r\n":
        raise WarcError(f"a block of {len(rest) - 4} bytes, stated as {headers['content-length']}")
    http, blank, payload = rest[:-4].partition(b"\r\n\r\n")
    status, _, fields = http.partition(b"\r\n")
    if not blank or not status.startswith(b"HTTP/"):
        raise WarcError("the block is no HTTP response")
    size = _headers(fields, "response").get("content-length", "")
    digest = headers.get("warc-payload-digest", "").removeprefix("sha1:")
    kind, refers_to = headers["warc-type"], None
    if kind == "response":
        if str(len(payload)) != size:
            raise WarcError(f"a payload of {len(payload)} bytes, stated as {size}")
        if payload_digest(payload) != digest:
            raise WarcError("the payload has another digest")
    elif kind == "revisit":
        if payload or "warc-refers-to" not in headers or headers.get("warc-profile") != REVISIT_PROFILE or not size.isdigit():
            raise WarcError("a revisit has no payload but a length, a profile and a record it refers to")
        refers_to = _page(headers["warc-refers-to"])
    else:
        raise WarcError(f"an unknown record type {kind!r}")
    return _page(headers["warc-record-id"]), int(size), digest, kind, refers_to, headers.get("warc-target-uri")


def frames(stream):
    """The records of an archive, one decoded frame at a time."""
    import zstandard

    def exactly(n):
        data = stream.read(n)
        if len(data) != n:
            raise WarcError("the archive ends within its dictionary")
        return data
    magic, size = struct.unpack("<II", exactly(8))
    if magic != SKIPPABLE:
        raise WarcError("the archive does not begin with a dictionary frame")
    dictionary = exactly(size)
    reader = (zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary)) if size
              else zstandard.ZstdDecompressor())
    rest, frame, out = b"", None, []
    while data := rest or stream.read(READ_BYTES):
        frame = frame or reader.decompressobj()
        try:
            out.append(frame.decompress(data))
        except zstandard.ZstdError as e:
            raise WarcError(f"a broken frame: {e}") from None
        rest = b""
        if frame.eof:
            yield b"".join(out)
            rest, frame, out = frame.unused_data, None, []
    if frame is not None:
        raise WarcError("the archive ends within a frame")


def train_dictionary(pages: DataFrame, date: str) -> bytes:
    """A dictionary trained on the records of a bounded sample of pages, picked
    by a hash; empty where there are too few."""
    import zstandard
    short = pages.select("page_id", "url", "html").filter(F.octet_length("html") <= SAMPLE_BYTES)
    rows = sorted(hashed_sample(short, SAMPLE_PAGES, "page_id", "html").collect(), key=lambda r: (r.html, r.page_id or 0))
    try:
        return zstandard.train_dictionary(
            DICTIONARY_BYTES, [record(r.page_id, r.url, r.html.encode(), None, date) for r in rows]).as_bytes()
    except zstandard.ZstdError:
        return b""


def revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, digest, first: the pages that revisit an equal payload of at
    least ``min_bytes``, and the smallest page_id that has it."""
    html = F.coalesce("html", F.lit(""))
    keys = pages.select("page_id", F.sha1(html).alias("digest"), F.octet_length(html).alias("size"))
    firsts = (keys.filter(F.col("size") >= min_bytes).groupBy("digest", "size")
              .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1 AND first IS NOT NULL"))
    return (keys.join(firsts, ["digest", "size"]).filter(~F.col("page_id").eqNullSafe(F.col("first")))
            .select("page_id", "digest", "first").distinct())


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write ``pages`` (page_id, url, html) to archives in ``folder``; the table
    of archives, itself written to the shared folder."""
    dictionary = train_dictionary(pages, date)

    def run(batches):
        import zstandard
        press = (zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary))
                 if dictionary else zstandard.ZstdCompressor(level=LEVEL))
        fs, path = filesystem(folder)
        out, n, size, done = None, 0, 0, []
        for batch in batches:
            for page_id, url, html, first in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "first"))):
                if out is None or size > ARCHIVE_BYTES:
                    if out is not None:
                        out.close()
                        done.append((name, n, size))
                    name = own_name(f"pages-{TaskContext.get().partitionId():06d}", ".warc.zst")
                    out, n, size = fs.open_output_stream(f"{path}/{name}"), 0, 8 + len(dictionary)
                    out.write(struct.pack("<II", SKIPPABLE, len(dictionary)) + dictionary)
                frame = press.compress(record(page_id, url, (html or "").encode(), first, date))
                out.write(frame)
                n, size = n + 1, size + len(frame)
        if out is not None:
            out.close()
            done.append((name, n, size))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=["file", "n_records", "n_bytes"])
    again = revisits(pages, min_bytes).alias("r")
    digest = F.sha1(F.coalesce(F.col("p.html"), F.lit("")))
    rows = (pages.alias("p").join(again, F.col("p.page_id").eqNullSafe(F.col("r.page_id")) & (digest == F.col("r.digest")), "left")
            .select("p.page_id", "p.url", "p.html", "r.first"))
    return staged(rows.mapInArrow(run, ARCHIVES), "archives")


def read_archives(archives: DataFrame, folder: str, errors: str = "raise") -> DataFrame:
    """A row for each record.  ``errors``: ``raise`` stops at a broken record;
    ``report`` gives it a row of nulls with ``error`` (a broken frame ends its
    archive)."""
    def run(batches):
        fs, path = filesystem(folder)
        for batch in batches:
            for file, n in zip(batch.column("file").to_pylist(), batch.column("n_records").to_pylist()):
                rows = []
                with fs.open_input_stream(f"{path}/{file}") as stream:
                    for row in _checked(frames(stream), file, n, errors):
                        rows.append(row)
                        if len(rows) >= 5000:
                            yield _rows(rows)
                            rows = []
                if rows:
                    yield _rows(rows)
    many = max(1, archives.count())
    return archives.repartition(many).mapInArrow(run, RECORDS + ", error string")


def _checked(records, file: str, n: int, errors: str):
    """Fields and error of each of an archive's ``n`` records."""
    seen, broken = 0, False
    while not broken:
        try:
            broken = True  # unless the frame can be read
            raw = next(records, None)
            if raw is None:
                if seen != n:
                    raise WarcError(f"{seen} records, of {n} written")
                return
            broken, seen = False, seen + 1
            yield (*parse(raw), None)
        except WarcError as e:
            said = f"{file}, record {seen}: {e}"
            if errors == "raise":
                raise WarcError(said) from None
            yield (None,) * 6 + (said,)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string())
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "target_uri", "error"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def archive_table(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write ``pages`` to a fresh shared folder and read the archives back."""
    folder = new_folder(spark, "warc")
    return read_archives(write_archives(pages, folder), folder)
