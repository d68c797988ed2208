"""WARC archives: written by tasks, read back record by record.

Writing: one gzip member per record, one archive per task, in the shared folder. Of records with
equal payloads (of at least ``least`` bytes) the one with the smallest page_id is a response; the
others are revisits that name it and hold no payload. Equal payloads are found by SHA-1 and
length, with a partial minimum before the shuffle, so a payload that fills a third of the table is
one row per task.

Reading: a sequential reader decompresses in small steps, frames each block by Content-Length,
goes on to the next member at the end of one, and checks every block digest. Only one record is in
memory at a time.

Cases: a null html is an empty payload; empty payloads are equal to each other. A null url has no
target header. Rows with a null page_id are written and come back with it null; among equal
payloads they are responses only if no row has a page_id. Rows that repeat the smallest page_id
with an equal payload are responses each. An empty table gives no archive and an empty result.
Other columns are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlake.llm.common import prepare, scratch_dir, staged
from cohortlake.llm.store import open_file, qualified, write_file

#: Bytes taken from the archive at a time.
STEP = 1 << 16
#: The date in the records; a parameter, so that a task that runs again writes the same bytes.
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FIELDS = (
    "page_id long, url string, record_type string, refers_to long, payload_bytes long, "
    "payload_digest string, payload binary, digest_ok boolean"
)


class WarcError(ValueError):
    """An archive that is cut short, wrongly framed, or doesn't match its digests."""


def sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(headers: dict[str, str], block: bytes) -> bytes:
    """One record as a gzip member."""
    lines = "".join(f"{name}: {value}\r\n" for name, value in headers.items())
    head = f"WARC/1.1\r\n{lines}Content-Length: {len(block)}\r\n\r\n".encode()
    packer = zlib.compressobj(6, zlib.DEFLATED, zlib.MAX_WBITS | 16)
    return packer.compress(head + block + b"\r\n\r\n") + packer.flush()


def members(file) -> Iterator[bytes]:
    """The decompressed gzip members of a file, one after the other."""
    rest = b""
    while True:
        data = rest or file.read(STEP)
        if not data:
            return
        unpacker, parts = zlib.decompressobj(zlib.MAX_WBITS | 16), []
        while True:
            try:
                parts.append(unpacker.decompress(data))
            except zlib.error as error:
                raise WarcError(str(error)) from error
            if unpacker.eof:
                rest = unpacker.unused_data
                break
            data = file.read(STEP)
            if not data:
                raise WarcError("the archive ends within a record")
        yield b"".join(parts)


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of a record, framed by its length and held against its digest."""
    head, found, rest = member.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not found or not lines[0].startswith("WARC/"):
        raise WarcError("a record without a header")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    size = int(headers["Content-Length"])
    if rest[size:] != b"\r\n\r\n":
        raise WarcError("a block that doesn't have the length of its header")
    block = rest[:size]
    if headers.get("WARC-Block-Digest", "").removeprefix("sha1:") != sha1(block):
        raise WarcError("a block that doesn't have the digest of its header")
    return headers, block


def _identifier(page: int | None) -> str:
    return f"<urn:page:{'' if page is None else page}>"


def _number(identifier: str | None) -> int | None:
    number = (identifier or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def page_record(page: int | None, url: str | None, payload: bytes, first: int | None) -> bytes:
    """A response, or, if ``first`` names another page, a revisit of it."""
    revisit = first is not None and first != page
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    headers = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": _identifier(page),
        "WARC-Date": DATE,
    }
    if url is not None:
        headers["WARC-Target-URI"] = quote(url, safe="%/:=&?~#+!$,;'@()*[]") if url else ""
        headers["X-Target"] = quote(url)
    headers["WARC-Payload-Digest"] = f"sha1:{sha1(payload)}"
    headers["X-Payload-Length"] = str(len(payload))
    if revisit:
        headers |= {"WARC-Refers-To": _identifier(first), "WARC-Profile": PROFILE}
    else:
        block += payload
    headers["WARC-Block-Digest"] = f"sha1:{sha1(block)}"
    headers["Content-Type"] = "application/http;msgtype=response"
    return record(headers, block)


def archive_name(task: int) -> str:
    return f"pages-{task:06d}.warc.gz"


def write_archives(pages: DataFrame, folder: str, least: int = 0) -> int:
    """Write (page_id, url, html) to archives in ``folder``; returns how many archives.

    Every task writes one, also without rows; their numbers run from 0 on."""
    prepare(pages.sparkSession)
    rows = pages.select(
        F.col("page_id").cast("long"),
        F.col("url").cast("string"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    )
    raw = F.encode("html", "UTF-8")
    same = [F.sha1(raw).alias("digest"), F.octet_length(raw).alias("bytes")]
    first = (
        rows.select("page_id", *same)
        .groupBy("digest", "bytes")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("copies"))
        .where(f"copies > 1 AND bytes >= {int(least)}")
        .drop("copies")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        count = [0]

        def records() -> Iterator[bytes]:
            for part in batches:
                columns = (part.column(c).to_pylist() for c in ("page_id", "url", "html", "first"))
                for page, url, html, of in zip(*columns, strict=True):
                    count[0] += 1
                    yield page_record(page, url, html.encode(), of)

        size = write_file(folder, archive_name(task), records())
        row = ([task], [size], [count[0]])
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, pa.int64()) for x in row], names=["task", "bytes", "records"]
        )

    written = staged(
        rows.select("*", *same)
        .join(first, ["digest", "bytes"], "left")
        .mapInArrow(run, "task long, bytes long, records long")
    )
    return (written.agg(F.max("task")).first()[0] or 0) + 1 if not written.isEmpty() else 0


def read_archives(spark: SparkSession, folder: str, archives: int) -> DataFrame:
    """One row per record, an archive per task; the columns of ``FIELDS``.

    ``digest_ok`` says of a response whether its payload matches the payload digest, and of a
    revisit that there was none to check."""
    prepare(spark)

    def rows(name: str) -> Iterator[tuple]:
        with open_file(folder, name) as file:
            for member in members(file):
                headers, block = parse(member)
                revisit = headers["WARC-Type"] == "revisit"
                payload = None if revisit else block.partition(b"\r\n\r\n")[2]
                digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                target = headers.get("X-Target")
                yield (
                    _number(headers["WARC-Record-ID"]),
                    None if target is None else unquote(target),
                    headers["WARC-Type"],
                    _number(headers.get("WARC-Refers-To")),
                    int(headers["X-Payload-Length"]) if revisit else len(payload),
                    digest,
                    payload,
                    revisit or sha1(payload) == digest,
                )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            for task in part.column("id").to_pylist():
                held, size = [], 0
                for row in rows(archive_name(task)):
                    held.append(row)
                    size += len(row[6] or b"")
                    if len(held) >= 2000 or size >= 1 << 22:
                        yield _batch(held)
                        held, size = [], 0
                yield _batch(held)

    return spark.range(0, archives, 1, max(archives, 1)).mapInArrow(run, FIELDS)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}
    fields = [f.split() for f in FIELDS.split(", ")]
    columns = zip(*rows, strict=True) if rows else ([] for _ in fields)
    arrays = [pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=[n for n, _ in fields])


def archived_pages(pages: DataFrame, folder: str | None = None, least: int = 0) -> DataFrame:
    """Write the pages to archives and read them back."""
    spark = pages.sparkSession
    folder = qualified(spark, folder or scratch_dir(spark))
    return read_archives(spark, folder, write_archives(pages, folder, least))
