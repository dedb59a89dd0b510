"""WARC archives with an index first: write, select in the index, read only the byte ranges of what was selected.

Each task writes archives of its own, named by attempt, and returns an index row for each record: file, offset, length,
URL, digest. Every record is a gzip member of its own, so that a byte range is enough to read it. The index is a Parquet
table, and its commit is the commit of the archives: files of lost or repeated attempts are in no index row. Reading
range-partitions the selected index rows by file and offset, joins neighbouring ranges to reads of up to READ_BYTES
where the gap is at most GAP_BYTES, and parses the records it asked for.

Of records with equal payloads of at least ``least_bytes`` bytes the one with the largest id is a ``response``; the
others are ``revisit`` records, which name it and carry the digest and length of the payload but not the payload.

Files are reached through ``pyarrow.fs``, so the folder may be any store it knows. It must be shared by all executors.

Defined results: a null page is an empty payload, a null URL is left out of the record and null in the index, control
characters and blanks of a URL are percent-encoded. All rows that share the largest id and the payload are responses,
and a group without any id has no one to refer to, so its rows are responses as well. An empty table writes no archive.
Other columns of the input are ignored.
"""

from __future__ import annotations

import base64
import gzip
import re
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shared_folder, staged
from .common import text_batches

LEAST_BYTES = 1000
FILE_BYTES, READ_BYTES, GAP_BYTES = 1 << 30, 8 << 20, 64 << 10
#: Bytes of archives that one reading task gets.
TASK_BYTES = 32 << 20
#: Date written into records: crawl times are no column of the pages.
CRAWLED = "1970-01-01T00:00:00Z"

INDEX = ("file string, offset long, length long, record_type string, record_id long, url string, digest string, "
         "payload_bytes long, refers_to long")
RECORD = ("record_id long, record_type string, url string, header_digest string, header_bytes long, refers_to long, "
          "payload binary")

_CRLF = b"\r\n"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
_UNSAFE = re.compile(r"[\x00-\x20\x7f]")


def _name(record_id: int | None) -> str:
    return f"<urn:page:{'' if record_id is None else record_id}>"


def _number(name: str) -> int | None:
    digits = name.rpartition(":")[2].rstrip(">")
    return int(digits) if digits else None


def record_bytes(row: dict, crawled: str = CRAWLED) -> bytes:
    """One record. ``row``: page_id, url, payload (bytes), digest (hex), payload_bytes, refers_to, record_type."""
    head = _HTTP % row["payload_bytes"]
    block = head + row["payload"] if row["record_type"] == "response" else head
    digest = base64.b32encode(bytes.fromhex(row["digest"])).decode()
    lines = ["WARC/1.1", f"WARC-Type: {row['record_type']}", f"WARC-Record-ID: {_name(row['page_id'])}",
             f"WARC-Date: {crawled}"]
    if row["url"] is not None:
        lines.append("WARC-Target-URI: " + _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", row["url"]))
    lines += [f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {row['payload_bytes']}"]
    if row["record_type"] == "revisit":
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"WARC-Refers-To: {_name(row['refers_to'])}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + _CRLF * 2 + block + _CRLF * 2


def parse_record(data: bytes) -> dict:
    """A record's header fields and payload; raises if its length does not agree with its header."""
    head, _, rest = data.partition(_CRLF * 2)
    version, *lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    block = rest[:int(fields["Content-Length"])]
    if not version.startswith("WARC/") or rest[len(block):] != _CRLF * 2:
        raise ValueError("the byte range is no WARC record")
    payload = block.partition(_CRLF * 2)[2] if fields["WARC-Type"] == "response" else None
    refers = fields.get("WARC-Refers-To")
    return {
        "record_id": _number(fields["WARC-Record-ID"]), "record_type": fields["WARC-Type"],
        "url": fields.get("WARC-Target-URI"),
        "header_digest": base64.b32decode(fields["WARC-Payload-Digest"].partition(":")[2]).hex(),
        "header_bytes": int(fields["X-Payload-Length"]), "refers_to": refers and _number(refers), "payload": payload,
    }


def with_record_types(pages: DataFrame, id_column: str = "page_id", url_column: str = "url",
                      html_column: str = "html", least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Pages as records to write. The groups are counted before the shuffle; the join has one row per payload on the
    side of the groups, so Spark can split a payload that many pages share."""
    rows = pages.select(F.col(id_column).cast("long").alias("page_id"), F.col(url_column).alias("url"),
                        F.coalesce(F.col(html_column), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("payload_bytes", F.octet_length("payload").cast("long"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    rows = rows.withColumn("proof", F.xxhash64("payload"))
    groups = rows.filter(F.col("payload_bytes") >= least_bytes).groupBy(
        F.col("digest").alias("_digest"), F.col("proof").alias("_proof"), F.col("payload_bytes").alias("_bytes")).agg(
        F.max("page_id").alias("refers_to"), F.count("*").alias("_n")).filter("_n > 1").drop("_n")
    same = ((rows.digest == groups["_digest"]) & (rows.proof == groups["_proof"])
            & (rows.payload_bytes == groups["_bytes"]))
    out = rows.join(groups, same, "left")
    revisit = F.col("refers_to").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("refers_to"))
    return out.select(
        "page_id", "url", "digest", "payload_bytes", F.when(~revisit, F.col("payload")).alias("payload"),
        F.when(revisit, F.col("refers_to")).alias("refers_to"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"))


def _writer(folder: str, file_bytes: int, crawled: str) -> Callable:
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        out, path, at = None, "", 0
        try:
            for batch in batches:
                rows = []
                for row in batch.to_pylist():
                    if out is None:
                        path = f"{root}/{uuid.uuid4().hex}.warc.gz"
                        store.create_dir(root, recursive=True)
                        out, at = store.open_output_stream(path, compression=None), 0  # records are members already
                    data = gzip.compress(record_bytes(row, crawled), mtime=0)
                    out.write(data)
                    rows.append((path.removeprefix(root), at, len(data), row["record_type"], row["page_id"],
                                 row["url"], row["digest"], row["payload_bytes"], row["refers_to"]))
                    at += len(data)
                    if at >= file_bytes:
                        out.close()
                        out = None
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), _INDEX_TYPES)] if rows
                    else [pa.array([], t) for t in _INDEX_TYPES], names=_INDEX_NAMES)
        finally:
            if out is not None:
                out.close()
    return write


_INDEX_NAMES = [c.split()[0] for c in INDEX.split(", ")]
_INDEX_TYPES = [{"string": pa.string(), "long": pa.int64()}[c.split()[1]] for c in INDEX.split(", ")]
_RECORD_NAMES = [c.split()[0] for c in RECORD.split(", ")]
_RECORD_TYPES = [{"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[c.split()[1]]
                 for c in RECORD.split(", ")]


def write_archives(records: DataFrame, folder: str, file_bytes: int = FILE_BYTES,
                   crawled: str = CRAWLED) -> DataFrame:
    """Write the records of :func:`with_record_types` and return the committed index."""
    text_batches(records.sparkSession)
    return staged(records.mapInArrow(_writer(folder, file_bytes, crawled), INDEX), "warc-index")


def _reader(folder: str, read_bytes: int, gap_bytes: int) -> Callable:
    def spans(batches):
        """Lists of (offset, length) of one file that one read fetches."""
        held, name = [], None
        for batch in batches:
            for file, offset, length in zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length"))):
                end = held[-1][0] + held[-1][1] if held else 0
                if held and (file != name or offset > end + gap_bytes or offset + length - held[0][0] > read_bytes):
                    yield name, held
                    held = []
                name = file
                held.append((offset, length))
        if held:
            yield name, held

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        opened, source = None, None
        for name, held in spans(batches):
            if name != opened:
                opened, source = name, store.open_input_file(root + name)
            start = held[0][0]
            data = source.read_at(held[-1][0] + held[-1][1] - start, start)
            rows = [parse_record(gzip.decompress(data[o - start:o - start + n])) for o, n in held]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[c] for r in rows], t) for c, t in zip(_RECORD_NAMES, _RECORD_TYPES)],
                names=_RECORD_NAMES)
    return read


def read_records(index: DataFrame, folder: str, read_bytes: int = READ_BYTES,
                 gap_bytes: int = GAP_BYTES) -> DataFrame:
    """The records of the given index rows, with the payload of responses. Tasks are cut by the bytes of the archives
    that they read; the index itself is small beside these."""
    spark = index.sparkSession
    wanted = index.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("n")).first()["n"]
    tasks = max(-(-wanted // TASK_BYTES), spark.sparkContext.defaultParallelism)
    ordered = index.select("file", "offset", "length").repartitionByRange(tasks, "file", "offset").sortWithinPartitions(
        "file", "offset")
    return ordered.mapInArrow(_reader(folder, read_bytes, gap_bytes), RECORD)


def archive_folder(spark) -> str:
    return f"{shared_folder(spark)}/warc/{uuid.uuid4().hex}"
