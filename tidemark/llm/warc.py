"""WARC archives: written with an index of their records, read back by coalesced byte ranges.

Every task appends its records to archives of its own below the shared folder, and returns
the index row of each record (archive, offset, length, url, digest). The index is a table
that Spark commits as a whole; archives that it doesn't name, left by a lost executor or a
second attempt, are never read. A record is one gzip member, as in .warc.gz files, so each
can be read by its byte range alone.

A reader takes any selection of index rows, sorts them by archive and offset, and reads
ranges that lie next to each other (up to GAP bytes apart, READ bytes together) at once.

Of records with equal payloads of at least ``least`` bytes the one with the largest page_id
is a response. The others are revisits without payload that refer to it; as the format asks
they keep the HTTP header, which names the full length, and the payload's digest.

Archives are written and read through pyarrow's file systems, which know local paths, HDFS
and the large object stores; the folder must be one that executors share.

Defined cases: null html is the empty payload; a null url writes no target; equal payloads
without any page_id stay responses, as there is nothing to refer to, and rows that repeat
the largest page_id are all responses; equal payloads are told by length, SHA-1 and SHA-256.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import checked_broadcast, materialize, read_table
from tidemark.session import scratch_path, shuffle_partitions

#: Payloads below it are never written as revisits.
LEAST_PAYLOAD = 1000
#: An archive is closed beyond so many bytes.
ARCHIVE = 256 << 20
#: Ranges at most GAP bytes apart are read together, up to READ bytes; bytes of records a reading task gets.
GAP, READ, PER_TASK = 64 << 10, 8 << 20, 64 << 20
#: Groups of copies that are broadcast at most (about 60 bytes each); more meet their pages in a shuffle.
BROADCAST_GROUPS = 200_000

REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = (
    "archive string, offset long, length long, url string, payload_digest string, "
    "page_id long, payload_bytes long, record_type string, refers_to long"
)
RECORD = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string"


def file_system(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a folder that Spark was given, and its path there."""
    return pyarrow.fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


# ------------------------------------------------------------------------- records


def _sha1(digest: str) -> str:
    """The digest as WARC headers have it: base32, not hex."""
    return "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()


def _name(page_id: int | None, digest: str) -> str:
    return f"<urn:x-page:{page_id}>" if page_id is not None else f"<urn:x-page:none:{digest}>"


def _page(name: str) -> int | None:
    found = re.fullmatch(r"<urn:x-page:(-?\d+)>", name)
    return int(found[1]) if found else None


def _header(first: str, fields: dict[str, str | None]) -> bytes:
    lines = [first, *(f"{k}: {v}" for k, v in fields.items() if v is not None)]
    return ("\r\n".join(lines) + "\r\n\r\n").encode("utf-8", "surrogatepass")


def record(row: dict, date: str) -> bytes:
    """One record, uncompressed; ``row`` has page_id, url, payload, digest, bytes, refers_to."""
    http = _header("HTTP/1.1 200 OK", {"Content-Type": "text/html; charset=utf-8", "Content-Length": str(row["bytes"])})
    revisit = row["refers_to"] is not None
    block = http if revisit else http + row["payload"]
    url = row["url"]
    if url is not None:  # a header is one line
        url = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
    fields = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": _name(row["page_id"], row["digest"]),
        "WARC-Date": date,
        "WARC-Target-URI": url,
        "WARC-Payload-Digest": _sha1(row["digest"]),
        "WARC-Profile": REVISIT if revisit else None,
        "WARC-Refers-To": _name(row["refers_to"], row["digest"]) if revisit else None,
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    return _header("WARC/1.1", fields) + block + b"\r\n\r\n"


def packed(data: bytes) -> bytes:
    """One gzip member."""
    gz = zlib.compressobj(level=4, wbits=31)
    return gz.compress(data) + gz.flush()


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")[1:]
    return dict(line.split(": ", 1) for line in lines if line)


def parsed(member: bytes) -> dict:
    """The record of one gzip member, its payload's length and digest taken from the payload.

    A response whose payload has another digest than its header says is an error.
    """
    data = zlib.decompress(member, wbits=31)
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = _fields(head)
    block = rest[: int(fields["Content-Length"])]
    if rest[len(block) :] != b"\r\n\r\n":
        raise ValueError(f"record {fields['WARC-Record-ID']} does not end where its header says")
    http, _, payload = block.partition(b"\r\n\r\n")
    said = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    out = {"page_id": _page(fields["WARC-Record-ID"]), "record_type": fields["WARC-Type"], "refers_to": None, "payload": None}
    if fields["WARC-Type"] == "revisit":
        return out | {"refers_to": _page(fields["WARC-Refers-To"]), "payload_bytes": int(_fields(http)["Content-Length"]), "payload_digest": said}
    digest = hashlib.sha1(payload, usedforsecurity=False).hexdigest()
    if digest != said:
        raise ValueError(f"payload of {fields['WARC-Record-ID']} has digest {digest}, not {said}")
    return out | {"payload": payload, "payload_bytes": len(payload), "payload_digest": digest}


# ------------------------------------------------------------------------- writing


def _written(root: str, date: str, most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    names = ["archive", "offset", "length", "url", "payload_digest", "page_id", "payload_bytes", "record_type", "refers_to"]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = file_system(root)
        task, out, name, offset = TaskContext.get(), None, "", 0
        try:
            for batch in batches:
                rows = []
                for row in batch.to_pylist():
                    if out is None or offset >= most:
                        if out is not None:
                            out.close()
                        name = f"pages-{task.partitionId():06d}-{task.taskAttemptId()}-{uuid.uuid4().hex[:8]}.warc.gz"
                        out = fs.open_output_stream(f"{path}/{name}", compression=None)
                        info = b"software: tidemark\r\nformat: WARC File Format 1.1\r\n"
                        fields = {"WARC-Type": "warcinfo", "WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>", "WARC-Date": date, "WARC-Filename": name, "Content-Type": "application/warc-fields", "Content-Length": str(len(info))}
                        offset = out.write(packed(_header("WARC/1.1", fields) + info + b"\r\n\r\n"))
                    data = packed(record(row, date))
                    kind = "revisit" if row["refers_to"] is not None else "response"
                    rows.append((name, offset, len(data), row["url"], row["digest"], row["page_id"], row["bytes"], kind, row["refers_to"]))
                    out.write(data)
                    offset += len(data)
                cols = zip(*rows, strict=True) if rows else [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)
        finally:
            if out is not None:
                out.close()

    return run


def write_archives(pages: DataFrame, root: str, least: int = LEAST_PAYLOAD, date: str = "2024-01-01T00:00:00Z", archive_bytes: int = ARCHIVE) -> DataFrame:
    """Write a record for each row of (page_id, url, html) below ``root``; returns the committed index.

    Only groups of copies are looked up, by 60 bytes each: where they are few the pages
    aren't shuffled, and a payload that a third of all pages share is never sent anywhere.
    """
    fs, path = file_system(root)
    fs.create_dir(path, recursive=True)
    html = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("payload")).withColumns(
        {"bytes": F.octet_length("payload").cast("long"), "digest": F.sha1("payload"), "key": F.unhex(F.sha2("payload", 256))}
    )
    copies = (
        rows.where(F.col("bytes") >= least)
        .groupBy("bytes", "digest", "key")
        .agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 and first is not null")
        .drop("n")
    )
    copies = materialize(copies, "warc-copies")
    groups = copies.limit(BROADCAST_GROUPS + 1).count()
    told = rows.join(checked_broadcast(copies, groups, BROADCAST_GROUPS), ["bytes", "digest", "key"], "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    told = told.select(
        "page_id", "url", "bytes", "digest",
        F.when(~revisit, F.col("payload")).alias("payload"),
        F.when(revisit, F.col("first")).alias("refers_to"),
    )
    return materialize(told.mapInArrow(_written(root, date, archive_bytes), INDEX), "warc-index")


# ------------------------------------------------------------------------- reading


def ranges(rows: list[tuple[str, int, int]], gap: int = GAP, most: int = READ) -> list[tuple[int, int]]:
    """Cuts sorted (archive, offset, length) into runs [from, to) that are read at once."""
    out, start, end = [], 0, 0
    for i, (archive, offset, length) in enumerate(rows):
        first = rows[start]
        if i and (archive != first[0] or offset > end + gap or offset + length - first[1] > most):
            out.append((start, i))
            start, end = i, 0
        end = max(end, offset + length)
    return [*out, (start, len(rows))] if rows else []


def _read(root: str, payloads: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    names = [x.split()[0] for x in RECORD.split(", ")] + ["payload"] * payloads
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = file_system(root)
        file, name = None, None
        try:
            for batch in batches:
                rows = batch.to_pylist()
                for lo, hi in ranges([(r["archive"], r["offset"], r["length"]) for r in rows]):
                    run_of, found = rows[lo:hi], []
                    if run_of[0]["archive"] != name:
                        if file is not None:
                            file.close()
                        name = run_of[0]["archive"]
                        file = fs.open_input_file(f"{path}/{name}")
                    first = run_of[0]["offset"]
                    data = file.read_at(max(r["offset"] + r["length"] for r in run_of) - first, first)
                    for r in run_of:
                        got = parsed(data[r["offset"] - first : r["offset"] - first + r["length"]])
                        if got["payload_digest"] != r["payload_digest"]:
                            raise ValueError(f"{name} holds another record at {r['offset']} than its index says")
                        found.append(got | {"url": r["url"]})
                    yield pa.RecordBatch.from_arrays([pa.array([f[n] for f in found], k) for n, k in zip(names, kinds, strict=False)], names=names)
        finally:
            if file is not None:
                file.close()

    return run


def read_records(index: DataFrame, root: str, payloads: bool = True) -> DataFrame:
    """The records of the given index rows (any selection): page_id, url, type, reference, length,
    digest and, with ``payloads``, the payload (null for revisits).

    Rows are range-partitioned by archive and offset, so neighbours meet in one task and a
    large archive is read by many.
    """
    size = index.agg(F.sum("length")).first()[0] or 0
    tasks = max(shuffle_partitions(index.sparkSession), -(-size // PER_TASK))
    places = index.select("archive", "offset", "length", "url", "payload_digest")
    placed = places.repartitionByRange(int(tasks), "archive", "offset").sortWithinPartitions("archive", "offset")
    return placed.mapInArrow(_read(root, payloads), RECORD + (", payload binary" if payloads else ""))


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``pages`` written as archives and read back from them."""
    root = scratch_path(spark, "warc")
    index = write_archives(read_table(spark, sf_dir, "pages"), root)
    return read_records(index, root, payloads=False).drop("url")


OP12_SQL = f"""WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes FROM pages),
g AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS first FROM p)
SELECT page_id, payload_bytes, sha1(html) AS payload_digest,
       CASE WHEN payload_bytes >= {LEAST_PAYLOAD} AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= {LEAST_PAYLOAD} AND page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM g"""
