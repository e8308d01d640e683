"""WARC archives with an index first: write, select, read byte ranges.

``write_archives`` turns every page into a record of its own gzip member in archives
below a shared folder and returns the index: archive, offset, length, URL and
payload digest per record.  Of records with equal payloads the one with the largest
identifier is a response, the others are revisits that refer to it.
``read_records`` takes any selection of the index, sorts it by place, joins ranges
that lie close together into one read, and parses and verifies the records.

Files are written under a temporary name and moved when complete; name and
content depend on the partition only, so a repeated task replaces its own files.
Folders can be on any file system that pyarrow opens by URI.

Defined results: null html is the empty payload; a null URL leaves the header out; a
null identifier never is referred to while its payload has an identified record
(if it has none, all of them are responses); rows that repeat an identifier
with the same payload are all responses or all revisits; an empty table gives an
empty index; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.joins import broadcast_if_bounded
from .common import BROADCAST_ROWS, bounded_arrow, cut, work_uri, written

ARCHIVE_BYTES = 256 << 20
GAP, READ_BYTES = 64 << 10, 8 << 20
# Bytes of archives that a reading task is given.
TASK_BYTES = 4 << 20
DATE = "2024-01-16T00:00:00Z"
INDEX = ("page_id bigint, url string, digest string, record_type string, archive string, offset bigint, length bigint")
RECORDS = ("page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, "
           "payload_digest string, payload binary")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _name(page_id) -> str:
    return f"<urn:x-page:{'null' if page_id is None else page_id}>"


def _id(name: str):
    inner = name.removeprefix("<urn:x-page:").removesuffix(">")
    return None if inner == "null" else int(inner)


def record(page_id, url, payload: bytes, refers_to, date: str = DATE) -> bytes:
    """One WARC/1.1 record (not compressed)."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
             f"WARC-Record-ID: {_name(page_id)}", f"WARC-Date: {date}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if refers_to is None:
        block += payload
    else:
        lines += [f"WARC-Refers-To: {_name(refers_to)}", f"WARC-Profile: {PROFILE}"]
    lines += [f"WARC-Payload-Digest: sha1:{digest(payload)}", "Content-Type: application/http; msgtype=response",
              f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """Fields of a record; raises if lengths or the payload's digest don't fit."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    fields = dict(x.split(": ", 1) for x in lines)
    size = int(fields["Content-Length"])
    if not version.startswith("WARC/") or rest[size:] != b"\r\n\r\n":
        raise ValueError("not a whole WARC record")
    http, _, payload = rest[:size].partition(b"\r\n\r\n")
    full = int(re.search(rb"(?i)^Content-Length: (\d+)", http, re.M)[1])
    named = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    revisit = fields["WARC-Type"] == "revisit"
    if not revisit and (len(payload) != full or digest(payload) != named):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not fit its digest")
    return {"page_id": _id(fields["WARC-Record-ID"]), "url": fields.get("WARC-Target-URI"),
            "record_type": fields["WARC-Type"], "refers_to": _id(fields["WARC-Refers-To"]) if revisit else None,
            "payload_bytes": full, "payload_digest": named, "payload": None if revisit else payload}


def _member(raw: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(raw) + z.flush()


def _repeated(pages: DataFrame) -> DataFrame:
    """(print, top): digests of the payloads of several pages and the largest identifier
    of each; only digests are shuffled."""
    return cut(pages.groupBy("print").agg(F.max("page_id").alias("top"), F.count(F.lit(1)).alias("n"))
               .where("n > 1 and top is not null").select("print", "top"))


def write_archives(pages: DataFrame, folder: str, id_col="page_id", url_col="url", html_col="html",
                   archive_bytes: int = ARCHIVE_BYTES, date: str = DATE) -> DataFrame:
    """Write all pages; returns the index, itself a written table."""
    pages = bounded_arrow(pages).select(
        F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html")) \
        .withColumn("print", F.unhex(F.sha2("html", 256)))
    # Both scans of the pages meet by payload digest and identifier, which are the same
    # however the input is split.
    rows = pages.join(broadcast_if_bounded(_repeated(pages), BROADCAST_ROWS), "print", "left") \
        .withColumn("refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("top")), F.col("top")))

    def run(batches):
        from pyarrow import fs
        system, base = fs.FileSystem.from_uri(folder)
        context = TaskContext.get()
        part, attempt = context.partitionId(), context.taskAttemptId()
        system.create_dir(base, recursive=True)
        number, out, at = 0, None, 0

        def finish():
            nonlocal out, number, at
            if out is not None:
                out.close()
                target = f"{base}/part-{part:05d}-{number:05d}.warc.gz"
                # A repeated task replaces what an earlier attempt left (not every store moves onto a file).
                if system.get_file_info(target).type != fs.FileType.NotFound:
                    system.delete_file(target)
                system.move(f"{base}/.{attempt}-{number}", target)
                out, number, at = None, number + 1, 0

        try:
            for batch in batches:
                columns = [[] for _ in range(7)]
                for page_id, url, html, refers_to in zip(*(batch.column(i) for i in range(4))):
                    page_id, url, refers_to = page_id.as_py(), url.as_py(), refers_to.as_py()
                    payload = html.as_py().encode()
                    member = _member(record(page_id, url, payload, refers_to, date))
                    if at and at + len(member) > archive_bytes:
                        finish()
                    if out is None:
                        out = system.open_output_stream(f"{base}/.{attempt}-{number}")
                    out.write(member)
                    for c, v in zip(columns, (page_id, url, digest(payload), "response" if refers_to is None else "revisit",
                                              f"part-{part:05d}-{number:05d}.warc.gz", at, len(member))):
                        c.append(v)
                    at += len(member)
                kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                                 names=[x.split()[0] for x in INDEX.split(", ")])
            finish()
        finally:
            if out is not None:
                out.close()
                system.delete_file(f"{base}/.{attempt}-{number}")

    return written(rows.select("page_id", "url", "html", "refers_to").mapInArrow(run, INDEX), "warc-index")


def ranges(rows, gap: int = GAP, most: int = READ_BYTES):
    """Coalesce (archive, offset, length) rows sorted by place into lists that are read at once."""
    run, end = [], 0
    for r in rows:
        if run and (r[0] != run[0][0] or r[1] > end + gap or r[1] + r[2] - run[0][1] > most):
            yield run
            run = []
        end = r[1] + r[2] if not run else max(end, r[1] + r[2])
        run.append(r)
    if run:
        yield run


def read_records(selected: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """The records of the selected index rows, parsed and verified."""
    def run(batches):
        from pyarrow import fs
        system, base = fs.FileSystem.from_uri(folder)

        def places():
            for batch in batches:
                yield from zip(*(batch.column(i).to_pylist() for i in range(3)))

        name, source, out = None, None, []
        for group in ranges(places()):
            if group[0][0] != name:
                if source is not None:
                    source.close()
                name, source = group[0][0], system.open_input_file(f"{base}/{group[0][0]}")
            first = group[0][1]
            raw = source.read_at(max(o + n for _, o, n in group) - first, first)
            for _, offset, length in group:
                fields = parse(zlib.decompress(raw[offset - first:offset - first + length], 31))
                out.append(fields if with_payload else fields | {"payload": None})
            yield _records(out)
            out = []
        yield _records(out)
        if source is not None:
            source.close()

    # As many tasks as the bytes to be read ask for, however small the index is.
    parts = max(1, -(-(selected.agg(F.sum("length")).first()[0] or 0) // TASK_BYTES))
    return bounded_arrow(selected).select("archive", "offset", "length").repartitionByRange(parts, "archive", "offset") \
        .sortWithinPartitions("archive", "offset").mapInArrow(run, RECORDS)


def _records(out: list[dict]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
    names = [x.split()[0] for x in RECORDS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[n] for r in out], k) for n, k in zip(names, kinds)], names=names)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write all pages into archives below the shared folder and read every record back."""
    folder = work_uri(pages.sparkSession, "warc")
    return read_records(write_archives(pages, folder), folder, with_payload=False)
