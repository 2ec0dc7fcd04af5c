"""Web archives in which a payload is stored once.

Headers - page, payload digest, payload length - are shuffled by digest, the page with the smallest id of each payload
becomes its response, and all others revisits of it.  Then the archives are written, one gzip member for each record, with
headers that say so.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxtally.llm.common import Scratch, map_batches, new_file, opened, present

# Fixed values of the archive format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RESPONSE, REVISIT = "response", "revisit"
#: Archives are made, not crawled: every run writes the same date.
DATE = "2024-01-01T00:00:00Z"

#: Tasks that read archives, at most.
MOST_TASKS = 10_000

FILES = "file string, n_records long, n_bytes long"
RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, digest_ok boolean, payload binary"


def resolve(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """The pages with ``record_type`` and ``refers_to``.

    Of pages whose payloads are equal and have at least ``least_bytes`` bytes that with the smallest ``page_id`` is the
    response; smaller payloads are all responses.  A null ``html`` is an empty payload.  Rows that repeat both
    ``page_id`` and payload of a response are responses too; a null ``page_id`` is larger than any other.
    Only digests and ids meet to decide; a payload of a third of all rows is pre-aggregated there, and its pages are a
    skewed key of narrow rows.  The verdicts go back to the pages by id and digest, so no two pages' texts meet for having
    the same payload.
    """
    page = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    ).withColumn("digest", F.sha1("html"))
    originals = page.groupBy("digest").agg(F.min("page_id").alias("original"), F.count(F.lit(1)).alias("n")).where("n > 1 and original is not null")
    again = page.where(F.octet_length("html") >= least_bytes).select("page_id", "digest").join(originals, "digest")
    again = again.where(~F.col("page_id").eqNullSafe(F.col("original"))).select(F.col("page_id").alias("_page"), F.col("digest").alias("_digest"), "original").distinct()
    same = F.col("page_id").eqNullSafe(F.col("_page")) & (F.col("digest") == F.col("_digest"))
    is_revisit = F.col("original").isNotNull()
    return page.join(again, same, "left").select(
        "page_id", "url", "html", F.when(is_revisit, REVISIT).otherwise(RESPONSE).alias("record_type"), F.col("original").alias("refers_to")
    )


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record as a gzip member.  A revisit has the response's HTTP headers and no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    headers = [
        VERSION, f"WARC-Type: {RESPONSE if refers_to is None else REVISIT}", f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(hashlib.sha1(payload).digest()).decode()}",
    ]
    if url is not None:
        headers.append("WARC-Target-URI: " + url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A"))
    if refers_to is not None:
        headers += [f"WARC-Refers-To: {record_id(refers_to)}", f"WARC-Profile: {PROFILE}"]
    headers += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return gzip.compress("\r\n".join(headers).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", 6, mtime=0)


def write_archives(resolved: DataFrame, folder: str, largest: int = 1 << 28) -> DataFrame:
    """Write resolved pages; the result names the files and must be landed before it is used.

    A task starts a new file beyond ``largest`` bytes.  Files of attempts that did not count are in no manifest.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, file, records, size = None, "", 0, 0
        for batch in batches:
            columns = [batch.column(c) for c in ("page_id", "url", "html", "refers_to")]
            for row in zip(*columns, strict=True):
                page_id, url, html, refers_to = (v.as_py() for v in row)
                if out is None:
                    file, records, size = new_file(folder, ".warc.gz"), 0, 0
                    out = opened(file, write=True)
                made = record(page_id, url, html.encode(), refers_to)
                out.write(made)
                records, size = records + 1, size + len(made)
                if size >= largest:
                    out.close()
                    out = None
                    yield _file(file, records, size)
        if out is not None:
            out.close()
            yield _file(file, records, size)

    return map_batches(resolved, work, FILES)


def _file(file: str, records: int, size: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([file]), pa.array([records]), pa.array([size])], ["file", "n_records", "n_bytes"])


def read_records(source) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of an archive, one at a time."""
    with gzip.GzipFile(fileobj=source) as lines:
        while line := lines.readline():
            if line.strip() != VERSION.encode():
                raise ValueError(f"no record begins with {line[:40]!r}")
            headers = {}
            while (line := lines.readline().rstrip(b"\r\n")):
                name, _, value = line.decode().partition(": ")
                headers[name.lower()] = value
            block = lines.read(int(headers["content-length"]))
            lines.read(4)
            yield headers, block


def _page_of(urn: str | None) -> int | None:
    digits = present(urn).removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


def read_archives(files: DataFrame, payloads: bool = False) -> DataFrame:
    """Every record of the named files, which must be a written table.  A revisit's length is that of the response's HTTP headers, which it repeats;
    ``digest_ok`` says whether a response's payload has the digest of its header (null for revisits)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column("file").to_pylist():
                rows: list[tuple] = []
                held = 0
                with opened(file) as source:
                    for headers, block in read_records(source):
                        http, _, payload = block.partition(b"\r\n\r\n")
                        response = headers["warc-type"] == RESPONSE
                        told = headers["warc-payload-digest"].removeprefix("sha1:")
                        length = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
                        url = headers.get("warc-target-uri")
                        rows.append((
                            _page_of(headers["warc-record-id"]), None if url is None else url.replace("%0D", "\r").replace("%0A", "\n").replace("%25", "%"),
                            len(payload) if response else length, told, headers["warc-type"], _page_of(headers.get("warc-refers-to")),
                            base64.b32encode(hashlib.sha1(payload).digest()).decode() == told if response else None, payload if payloads and response else None,
                        ))
                        held += len(payload) if payloads else 0
                        if len(rows) >= 4096 or held > 1 << 24:
                            yield _records(rows)
                            rows, held = [], 0
                if rows:
                    yield _records(rows)

    # A number of tasks that is given is not merged again; each has a few files.
    return map_batches(files.repartition(max(1, min(files.count(), MOST_TASKS))), work, RECORDS)


_RECORD_TYPES = [
    ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()),
    ("refers_to", pa.int64()), ("digest_ok", pa.bool_()), ("payload", pa.binary()),
]


def _records(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, (_, kind) in zip(zip(*rows, strict=True), _RECORD_TYPES, strict=True)], [n for n, _ in _RECORD_TYPES])


def archived(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write deduplicated archives of ``pages`` to the shared folder, read them back, and return a row for each record.

    The archives are deleted once their records are landed; to keep them, call ``write_archives`` with a folder.
    """
    scratch = Scratch(pages.sparkSession, "warc")
    files = scratch.land(write_archives(resolve(pages, least_bytes), scratch.folder("archives")), "files")
    result = scratch.land(read_archives(files).select("page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "digest_ok"), "records")
    scratch.delete(scratch.folder("archives"))
    scratch.drop(files)
    return result
