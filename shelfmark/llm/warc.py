"""WARC archives: one gzip member per record, written and read back sequentially.

Writing: pages with equal payloads are found by digest and length in one aggregation; the one
with the largest page_id becomes a ``response`` record, the others ``revisit`` records without
payload.  Every task writes its own archives to the shared folder under a temporary name and
renames them when complete, so a task that runs again replaces the same files.

Reading: one archive at a time, as a stream of gzip members decompressed piece by piece
(bounded memory: one record), framed by Content-Length, digests checked.

Archives are opened with ``pyarrow.fs``, so the folder may be on any file system it knows.
"""

from __future__ import annotations

import base64
import hashlib
import zlib

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, new_folder, prepare, with_defaults

ARCHIVE_BYTES = 64 << 20
READ_BYTES = 256 << 10
ID = "urn:page:"
# fixed values of the format
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """One record as a gzip member.  A revisit (refers_to given) holds the HTTP headers only."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    block = http if refers_to is not None else http + payload
    head = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": f"<{ID}{'' if page_id is None else page_id}>",
        "WARC-Date": "1970-01-01T00:00:00Z",
        "WARC-Target-URI": "".join((url or "").split()),
        "Content-Type": "application/http;msgtype=response",
        "WARC-Payload-Digest": f"sha1:{digest}",
        "WARC-Block-Digest": f"sha1:{base32_sha1(block)}",
        "Content-Length": str(len(block)),
    }
    if refers_to is not None:
        head["WARC-Profile"] = PROFILE
        head["WARC-Refers-To"] = f"<{ID}{refers_to}>"
    lines = [VERSION, *[f"{k}: {v}".encode() for k, v in head.items()], b"", b""]
    press = zlib.compressobj(6, zlib.DEFLATED, 31)
    return press.compress(b"\r\n".join(lines) + block + b"\r\n\r\n") + press.flush()


def _writer(folder: str):
    def run(batches):
        files, base = fs.FileSystem.from_uri(folder)
        files.create_dir(base, recursive=True)
        task = TaskContext.get()
        part, attempt = task.partitionId(), task.taskAttemptId()
        out, size, count, n = None, 0, 0, 0

        def close():
            out.close()
            files.move(temporary, final)
            return pa.RecordBatch.from_pylist([{"path": final, "records": count}])

        for batch in batches:
            for row in zip(*[batch.column(c) for c in ("page_id", "url", "html", "sha1", "refers_to")]):
                page, url, html, sha1, refers = (x.as_py() if i != 2 else x for i, x in enumerate(row))
                payload = html.as_buffer().to_pybytes() if html.is_valid else b""
                data = record(page, url, payload, base64.b32encode(bytes.fromhex(sha1)).decode(), refers)
                if out is None:
                    final = f"{base}/pages-{part:06d}-{n:04d}.warc.gz"
                    temporary = f"{final}.{attempt}.tmp"
                    out, size, count = files.open_output_stream(temporary, compression=None), 0, 0
                out.write(data)
                size, count = size + len(data), count + 1
                if size >= ARCHIVE_BYTES:
                    yield close()
                    out, n = None, n + 1
        if out is not None:
            yield close()
    return run


def write_archives(pages: DataFrame, min_payload: int = 0) -> DataFrame:
    """Write a record per row of ``pages`` (page_id, url, html); returns the table (path, records).

    Of rows with equal payloads of at least ``min_payload`` bytes the one with the largest
    page_id is the response.  Null html is an empty payload.  A null page_id is below all others;
    rows that repeat the response's page_id and payload are responses too.
    """
    spark = prepare(pages.sparkSession)
    pages = with_defaults(pages, {"page_id": "long", "url": "string", "html": "string"}).select(
        "*", F.sha1(F.coalesce("html", F.lit("")).cast("binary")).alias("sha1"),
        F.octet_length(F.coalesce("html", F.lit(""))).alias("size"))
    groups = (pages.where(F.col("size") >= min_payload).groupBy("sha1", "size")
              .agg(F.max("page_id").alias("last"), F.count("*").alias("n")).where("n > 1 AND last IS NOT NULL").drop("n"))
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("last")), F.col("last"))
    rows = pages.join(materialize(groups, "payload_groups"), ["sha1", "size"], "left").select(
        "page_id", "url", F.when(refers.isNull(), F.col("html")).alias("html"), "sha1", refers.alias("refers_to"))
    return materialize(rows.mapInArrow(_writer(new_folder(spark, "archives")), "path string, records long"), "manifest")


def members(stream):
    """The gzip members of a stream, each decompressed piece by piece."""
    data = stream.read(READ_BYTES)
    while data:
        press, parts = zlib.decompressobj(31), []
        while True:
            parts.append(press.decompress(data))
            if press.eof:
                break
            data = stream.read(READ_BYTES)
            if not data:
                raise ValueError("the archive ends inside a gzip member")
        yield b"".join(parts)
        data = press.unused_data or stream.read(READ_BYTES)


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of the one record of a member, framed by its Content-Length."""
    head, gap, rest = member.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not gap or lines[0] != VERSION.decode():
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    length = int(fields["Content-Length"])
    if rest[length:] != b"\r\n\r\n":
        raise ValueError("a record's length differs from its Content-Length")
    return fields, rest[:length]


READ = "page_id long, url string, record_type string, payload_digest string, refers_to long, payload_bytes long, payload binary"


def _reader(folder_uri: str, payloads: bool):
    def run(batches):
        for batch in batches:
            for path in batch.column("path").to_pylist():
                files, _ = fs.FileSystem.from_uri(folder_uri)
                rows, size = [], 0
                with files.open_input_stream(path, compression=None) as stream:
                    for member in members(stream):
                        head, block = parse(member)
                        if head["WARC-Block-Digest"] != f"sha1:{base32_sha1(block)}":
                            raise ValueError(f"{path}: a block's digest differs")
                        payload = block.partition(b"\r\n\r\n")[2]
                        revisit = head["WARC-Type"] == "revisit"
                        if not revisit and head["WARC-Payload-Digest"] != f"sha1:{base32_sha1(payload)}":
                            raise ValueError(f"{path}: a payload's digest differs")
                        page = head["WARC-Record-ID"].strip("<>").removeprefix(ID)
                        rows.append({
                            "page_id": int(page) if page else None, "url": head["WARC-Target-URI"], "record_type": head["WARC-Type"],
                            "payload_digest": head["WARC-Payload-Digest"].removeprefix("sha1:"),
                            "refers_to": int(head["WARC-Refers-To"].strip("<>").removeprefix(ID)) if revisit else None,
                            "payload_bytes": None if revisit else len(payload), "payload": payload if payloads and not revisit else None})
                        size += len(payload)
                        if size > 4 << 20 or len(rows) >= 4096:
                            yield pa.RecordBatch.from_pylist(rows, schema=READ_ARROW)
                            rows, size = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema=READ_ARROW)
    return run


READ_ARROW = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_digest", pa.string()),
                        ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload", pa.binary())])


def read_archives(manifest: DataFrame, folder_uri: str | None = None, payloads: bool = True) -> DataFrame:
    """A row per record of the archives that ``manifest`` (path) lists; digests are verified.

    payload_bytes and payload are null for revisits (``payloads=False``: payload is null for all).
    A damaged archive raises.  ``folder_uri`` names the file system (default: the shared folder's).
    """
    spark: SparkSession = manifest.sparkSession
    paths = manifest.select("path").distinct().repartition(max(1, spark.sparkContext.defaultParallelism), "path")
    return paths.mapInArrow(_reader(folder_uri or new_folder(spark, "any"), payloads), READ)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """``records`` with the payload_bytes of revisits taken from the response that they refer to.

    The records are written once without payloads, so the archives are read once.
    """
    records = materialize(records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"), "records")
    source = (records.where("record_type = 'response' AND page_id IS NOT NULL")
              .select(F.col("page_id").alias("s_page"), F.col("payload_digest").alias("s_digest"), F.col("payload_bytes").alias("s_bytes"))
              .distinct())
    joined = records.join(source, (F.col("refers_to") == F.col("s_page")) & (F.col("payload_digest") == F.col("s_digest")), "left")
    return joined.select("page_id", F.coalesce("payload_bytes", "s_bytes").alias("payload_bytes"), "payload_digest", "record_type", "refers_to")
