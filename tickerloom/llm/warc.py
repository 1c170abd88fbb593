"""WARC archives with a two-level capture index.

Writing: each task writes gzip-per-record archive files and returns one capture row per record.
A payload of at least ``min_revisit`` bytes is stored once, with the smallest page_id that has
it; the other pages are revisit records that refer to it. Indexing: captures are sorted by
reversed-host URL key over the whole table and written as compressed blocks of lines; a sparse
directory has one row per block (first and last key, file, offset, length). Reading: binary
search in the directory, one range read per block, binary search in its lines, one range read
per record. Only files named by a manifest that Spark committed count.

Defined cases: a null html is empty; a null or unparsable URL is kept as it is and sorts under
its own text; a null page_id is never referred to and never a revisit; pages with one page_id
and payload are separate records of one kind; an empty table writes nothing and reads as no
rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import json
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.common import (
    materialize, open_file, read_range, scratch_path, task_count, write_bytes,
)

CAPTURES = (
    "key string, url string, page_id long, record_type string, payload_digest string, "
    "payload_bytes long, path string, offset long, length long"
)
DIRECTORY = (
    "part int, seq int, first_key string, last_key string, path string, offset long, "
    "length long, n_lines int"
)
RECORDS = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
    "refers_to long, payload binary"
)
_CAPTURE_FIELDS = [f.split()[0] for f in CAPTURES.split(", ")]

FILE_BYTES = 1 << 27
BLOCK_LINES = 3000
WARC_DATE = "1970-01-01T00:00:00Z"
_GZIP_LEVEL = 3


def url_key(url: str | None) -> str:
    """The reversed host, then ``)`` and the path with its query: com,example,www)/a?b=c.

    Scheme, user, default port and fragment are left out; host and path case is folded in the
    host only. What has no host is its own key.
    """
    try:
        parts = urlsplit(url or "")
        host, port = parts.hostname, parts.port
    except ValueError:
        host = None
    if not host:
        return url or ""
    usual = {"http": 80, "https": 443}.get(parts.scheme)
    tail = f":{port}" if port and port != usual else ""
    query = f"?{parts.query}" if parts.query else ""
    return f"{','.join(reversed(host.split('.')))}{tail}){parts.path or '/'}{query}"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# --- records ------------------------------------------------------------------------------


def _gzip(data: bytes) -> bytes:
    squeeze = zlib.compressobj(_GZIP_LEVEL, zlib.DEFLATED, 31)
    return squeeze.compress(data) + squeeze.flush()


def _one_line(value: str) -> str:
    """Header values hold no line breaks; percent signs mark what was replaced."""
    return value.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def _as_read(value: str) -> str:
    return value.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


def warc_record(
    page_id: int | None, url: str | None, payload: bytes, digest: str, first: int | None
) -> bytes:
    """A response record, or a revisit of the page ``first`` without the payload."""
    kind = "response" if first is None else "revisit"
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http + payload if first is None else http
    head = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Date: {WARC_DATE}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{digest}", f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {_one_line(url)}")
    if first is not None:
        head += [
            f"WARC-Refers-To: <urn:page:{first}>",
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
        ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _page(urn: str | None) -> int | None:
    number = (urn or "")[len("<urn:page:") : -1]
    return int(number) if number else None


def _headers(raw: bytes) -> dict[str, str]:
    lines = raw.decode().split("\r\n")[1:]
    return dict(line.split(": ", 1) for line in lines if ": " in line)


def parse_record(raw: bytes) -> dict:
    """What one gzip member of an archive holds; digests and sizes are checked."""
    data = zlib.decompress(raw, 47)
    cut = data.index(b"\r\n\r\n")
    head = _headers(data[:cut])
    block = data[cut + 4 : cut + 4 + int(head["Content-Length"])]
    cut = block.index(b"\r\n\r\n")
    size, payload = int(_headers(block[:cut])["Content-Length"]), block[cut + 4 :]
    digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
    whole = head["WARC-Type"] == "response"
    if whole and (len(payload) != size or base32_sha1(payload) != digest):
        raise ValueError(f"damaged record {head['WARC-Record-ID']}")
    url = head.get("WARC-Target-URI")
    return {
        "page_id": _page(head["WARC-Record-ID"]), "url": None if url is None else _as_read(url),
        "payload_bytes": size, "payload_digest": digest, "record_type": head["WARC-Type"],
        "refers_to": _page(head.get("WARC-Refers-To")), "payload": payload if whole else None,
    }


# --- writing --------------------------------------------------------------------------------


def _with_first(pages: DataFrame, min_revisit: int) -> DataFrame:
    """page_id, url, payload and ``first``: the page to refer to, or null for a response.

    Only digests are grouped, and only pages that are revisits are joined back.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col("page_id").cast("long"), F.col("url").cast("string"), payload.alias("payload")
    ).withColumn("_sha1", F.sha1("payload"))
    keys = rows.filter(F.length("payload") >= min_revisit).select("page_id", "_sha1")
    keys = materialize(keys, "page-digests")
    first = keys.groupBy("_sha1").agg(F.min("page_id").alias("first"), F.count("*").alias("_n"))
    first = first.filter("_n > 1").drop("_n")
    repeats = keys.join(first, "_sha1").filter("page_id > first").distinct()
    return rows.join(repeats, ["page_id", "_sha1"], "left").drop("_sha1")


def write_archives(
    pages: DataFrame, folder: str | None = None, min_revisit: int = 0,
    file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Write a record per page; returns the committed captures (url key, place, digest)."""
    folder = folder or scratch_path(pages.sparkSession, "warc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, size = TaskContext.get().partitionId(), 0, 0
        chunks: list[bytes] = []
        rows: list[tuple] = []

        def flush() -> pa.RecordBatch:
            path = write_bytes(folder, f"{part:06d}-{seq:06d}", chunks)
            full = [(*row[:6], path, *row[6:]) for row in rows]
            return _batch(full, CAPTURES)

        for batch in batches:
            columns = [batch.column(c) for c in ("page_id", "url", "payload", "first")]
            for page_id, url, payload, first in zip(*columns):
                page_id, url, payload = page_id.as_py(), url.as_py(), payload.as_py()
                digest = base32_sha1(payload)
                record = warc_record(page_id, url, payload, digest, first.as_py())
                member = _gzip(record)
                kind = "revisit" if first.is_valid else "response"
                rows.append(
                    (url_key(url), url, page_id, kind, digest, len(payload), size, len(member))
                )
                chunks.append(member)
                size += len(member)
                if size >= file_bytes:
                    yield flush()
                    chunks, rows, size, seq = [], [], 0, seq + 1
        if rows:
            yield flush()

    rows = _with_first(pages, min_revisit)
    return materialize(rows.mapInArrow(run, CAPTURES), "captures")


_ARROW = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [field.split() for field in schema.split(", ")]
    columns = list(zip(*rows)) if rows else [()] * len(fields)
    arrays = [pa.array(c, _ARROW[kind]) for c, (_, kind) in zip(columns, fields)]
    return pa.RecordBatch.from_arrays(arrays, [name for name, _ in fields])


# --- the index ------------------------------------------------------------------------------


def write_index(
    captures: DataFrame, folder: str | None = None, block_lines: int = BLOCK_LINES
) -> DataFrame:
    """Sorted, compressed blocks of capture lines; returns the committed sparse directory.

    Keys are dealt by ranges with the page and place added, so a host or URL with any share of
    the captures is spread over tasks, and blocks that share a key are neighbours.
    """
    folder = folder or scratch_path(captures.sparkSession, "cdx")
    order = ["key", "page_id", "path", "offset"]
    ranged = captures.repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, at = TaskContext.get().partitionId(), 0, 0
        members: list[bytes] = []
        blocks: list[tuple] = []
        lines: list[str] = []
        edge: list[str] = []

        def close() -> None:
            nonlocal at, seq
            member = _gzip("\n".join(lines).encode())
            blocks.append((part, seq, edge[0], edge[-1], at, len(member), len(lines)))
            members.append(member)
            at, seq = at + len(member), seq + 1
            lines.clear()
            edge.clear()

        for batch in batches:
            for row in batch.to_pylist():
                edge.append(row["key"])
                lines.append(json.dumps([row[f] for f in _CAPTURE_FIELDS]))
                if len(lines) >= block_lines:
                    close()
        if lines:
            close()
        if blocks:
            path = write_bytes(folder, f"{part:06d}", members)
            yield _batch([(*b[:4], path, *b[4:]) for b in blocks], DIRECTORY)

    return materialize(ranged.mapInArrow(run, DIRECTORY), "cdx-directory")


def read_block(path: str, offset: int, length: int) -> list[list]:
    """The capture lines of one block, by one range read."""
    raw = zlib.decompress(read_range(path, offset, length), 47)
    return [json.loads(line) for line in raw.decode().split("\n")]


def read_captures(directory: DataFrame) -> DataFrame:
    """All captures, block by block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                lines = read_block(row["path"], row["offset"], row["length"])
                yield _batch([tuple(line) for line in lines], CAPTURES)

    tasks = task_count(directory.sparkSession)
    blocks = directory.select("path", "offset", "length").repartition(tasks, "path", "offset")
    return blocks.mapInArrow(run, CAPTURES)


def look_up(directory: DataFrame, urls: list[str]) -> DataFrame:
    """The captures of some URLs (a list the caller holds): a task bisects its stretch of the
    directory for each key, reads the blocks that may hold it and bisects their lines."""
    keys = sorted({url_key(u) for u in urls})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = sorted(batch.to_pylist(), key=lambda r: (r["part"], r["seq"]))
            lasts = [r["last_key"] for r in rows]
            held: dict[int, list[list]] = {}
            found: list[tuple] = []
            for key in keys:
                at = bisect.bisect_left(lasts, key)
                while at < len(rows) and rows[at]["first_key"] <= key:
                    if at not in held:
                        held = {at: read_block(*(rows[at][f] for f in ("path", "offset", "length")))}
                    lines = held[at]
                    low = bisect.bisect_left(lines, key, key=lambda line: line[0])
                    high = bisect.bisect_right(lines, key, key=lambda line: line[0])
                    found += [tuple(line) for line in lines[low:high]]
                    at += 1
            yield _batch(found, CAPTURES)

    span = directory
    if keys:
        span = span.filter((F.col("last_key") >= keys[0]) & (F.col("first_key") <= keys[-1]))
    else:
        span = span.limit(0)
    return span.mapInArrow(run, CAPTURES)


def read_records(captures: DataFrame, payloads: bool = True) -> DataFrame:
    """The records at the captures' places. The captures of an archive (at most about
    ``file_bytes``) go to one task, which reads its ranges in the order of offsets and checks
    the digests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, source = None, None
        for batch in batches:
            rows = []
            for place, offset, length in zip(*(c.to_pylist() for c in batch.columns)):
                if place != path:
                    path, source = place, open_file(place)
                found = parse_record(source.read_at(length, offset))
                if not payloads:
                    found["payload"] = None
                rows.append(tuple(found.values()))
                if len(rows) >= 256:
                    yield _batch(rows, RECORDS)
                    rows = []
            yield _batch(rows, RECORDS)

    places = captures.select("path", "offset", "length")
    dealt = places.repartition(task_count(captures.sparkSession), "path")
    return dealt.sortWithinPartitions("path", "offset").mapInArrow(run, RECORDS)
