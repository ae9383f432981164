"""WARC archives: a writer, and a reader that goes on behind damage.

Archives are files of gzip members, one member for each record, written by
Spark's own writer into a folder all executors reach and read by its binary
source, so any file system that Spark knows will do. A file written here takes
about ``BLOBS * BLOB_BYTES`` bytes; a reading task holds one or a few files whole.
Archives from elsewhere are read whole, too: a file must fit a task's memory beside
its largest member unpacked, and Spark's binary source takes files below 2 GiB.

The reader takes any WARC/1.x record: field names in any case, folded lines, any
record type, with or without digests (SHA-1, SHA-2 or MD5, in hex or base 32). It
checks the gzip trailer, the version line, the header, the length, the end of the
record and, if it has one of a known kind, the digest of the block. Where a check
fails it searches for the next gzip member or version line at which a record
passes all checks, and goes on there, in time that grows with the archive and not
with its square. Bytes in between are returned as gaps (archive, offset, length,
reason) beside the records; nothing is lost unsaid. A member that holds several
records gives each; all but the first have the member's end as place and no length.

A payload is what follows the HTTP header, or the whole block of records that are
not HTTP messages; a transfer coding is left as it is. The page id is a field of
its own, so records of others have none, and ``record_id`` is the standard one.

Records with equal payloads of ``REVISIT_BYTES`` or more are written once, as the
response of the smallest page id; others become revisit records without the
payload. First ids are found on (digest, id) alone and joined back to the ids that
revisit. Pages meet that table by digest and id, so a payload that a third of the
pages share is dealt by its ids; a digest and id that repeat as often are broadcast.

A null payload is empty. A null id is written as an empty id and read as null; it is
never the smallest. Equal rows have equal record ids. Rows that repeat the smallest id are responses all.
No rows, no archives. Other columns are not written.
"""

from __future__ import annotations

import base64
import datetime
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultloom.llm.common import HOT_KEYS, batch, has_rows, join_facts
from faultloom.session import materialize, scratch_path

REVISIT_BYTES, BLOB_BYTES, BLOBS = 100, 2 << 20, 8

MAGIC, VERSION, END = b"\x1f\x8b\x08", b"WARC/1.", b"\r\n\r\n"
#: What stays as it is in an address, beside letters and digits.
URL_SAFE = "!#$&'()*+,/:;=?@[]"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: Digests that records may name, by the names they use.
DIGESTS = {"md5": "md5", "sha1": "sha1", "sha256": "sha256", "sha384": "sha384", "sha512": "sha512"}

#: Rows of the reader. A record's ``payload`` is null for a revisit; a gap has only place and reason.
#: ``payload_digest`` is bare for SHA-256 and bears its name otherwise.
READ = (
    "archive string, `offset` long, length long, gap_reason string, warc_type string, record_id string,"
    " warc_date string, page_id long, url string, payload_digest string, refers_to_id string,"
    " refers_to long, payload binary"
)
_READ = pa.schema([
    ("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("gap_reason", pa.string()),
    ("warc_type", pa.string()), ("record_id", pa.string()), ("warc_date", pa.string()),
    ("page_id", pa.int64()), ("url", pa.string()), ("payload_digest", pa.string()),
    ("refers_to_id", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()),
])


class Damaged(Exception):
    """A record that fails a check."""


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page_id}:{digest}')}>"


def record(page_id, url, digest: str, refers_to, payload: bytes | None, date: str = "1970-01-01T00:00:00Z") -> bytes:
    """One record. ``refers_to`` makes it a revisit, whose payload stays out."""
    revisit = refers_to is not None
    block = HTTP if revisit else HTTP + (payload or b"")
    fields = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_record_id(page_id, digest)}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {quote(url or '', safe=URL_SAFE)}",
        f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"Page-ID: {'' if page_id is None else page_id}",
    ]
    if revisit:
        fields += [
            f"WARC-Refers-To: {_record_id(refers_to, digest)}",
            f"Page-Refers-To: {refers_to}",
            f"WARC-Profile: {PROFILE}",
        ]
    fields += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(fields).encode() + END + block + END


def _revisits(rows: DataFrame) -> DataFrame:
    """(key, refers_to, n): digests and ids of pages that revisit, and on how many rows; no payloads."""
    ids = materialize(
        rows.filter("large").groupBy("digest", "page_id", "key").agg(F.count(F.lit(1)).alias("n")),
        "warc-ids",
    )
    firsts = materialize(
        ids.groupBy("digest")
        .agg(F.min("page_id").alias("refers_to"), F.sum("n").alias("n"))
        .filter("n > 1 AND refers_to IS NOT NULL"),
        "warc-firsts",
    )
    total = ids.agg(F.sum("n")).first()[0] or 0
    others = join_facts(ids, firsts, "digest", total).filter("NOT page_id <=> refers_to")
    return materialize(others.select("key", "refers_to", "n"), "warc-revisits")


def classify(pages: DataFrame, id: str, url: str, payload: str) -> DataFrame:
    body = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(id).cast("long").alias("page_id"),
        F.col(url).cast("string").alias("url"),
        body.alias("payload"),
        F.sha2(body, 256).alias("digest"),
        (F.octet_length(body) >= REVISIT_BYTES).alias("large"),
    )
    # Rows too small to revisit have a key of their own, so that no key is hot.
    rows = rows.withColumn(
        "key",
        F.when(F.col("large"), F.concat_ws(":", "digest", F.col("page_id").cast("string"))).otherwise(
            F.concat(F.lit("-"), F.monotonically_increasing_id())
        ),
    )
    revisits = _revisits(rows)
    total = revisits.agg(F.sum("n")).first()[0] or 0
    hot = F.col("n") * HOT_KEYS > total
    # Hot keys are fewer than HOT_KEYS.
    loud, quiet = F.broadcast(revisits.filter(hot).drop("n")), revisits.filter(~hot).drop("n")
    if not has_rows(quiet):
        joined = rows.join(loud, "key", "left")
    elif not has_rows(loud):
        joined = rows.join(quiet, "key", "left")
    else:
        joined = rows.join(loud, "key").unionByName(
            rows.join(loud, "key", "left_anti").join(quiet, "key", "left")
        )
    return joined.withColumn("payload", F.when(F.col("refers_to").isNull(), F.col("payload"))).drop(
        "key", "large"
    )


def _blobs(batches: Iterator[pa.RecordBatch], date: str) -> Iterator[pa.RecordBatch]:
    """Gzip members strung together. The last byte of a blob, a zero, is left to the writer's separator."""
    schema, made, size = pa.schema([("data", pa.binary())]), [], 0

    def blob() -> pa.RecordBatch:
        # A member ends with the high byte of its length: zero below 16 MiB. An empty member ends so too.
        data = b"".join(made)
        if data[-1]:
            data += gzip.compress(b"", mtime=0)
        made.clear()
        return batch(schema, {"data": [data[:-1]]})

    for b in batches:
        for row in zip(*(b.column(n).to_pylist() for n in ("page_id", "url", "digest", "refers_to", "payload")), strict=True):
            made.append(gzip.compress(record(*row, date), compresslevel=4, mtime=0))
            size += len(made[-1])
            if size >= BLOB_BYTES:
                yield blob()
                size = 0
    if made:
        yield blob()


def write(
    pages: DataFrame, path: str, id: str = "page_id", url: str = "url", payload: str = "html", date: str | None = None
) -> None:
    """Archives of a table of pages under a new folder; records bear ``date``, by default the time of this call."""
    rows = classify(pages, id, url, payload)
    date = date or f"{datetime.datetime.now(datetime.UTC):%Y-%m-%dT%H:%M:%SZ}"
    (
        rows.mapInArrow(lambda batches: _blobs(batches, date), "data binary")
        .select(F.col("data").cast("string").alias("value"))
        .write.option("lineSep", "\0")
        .option("maxRecordsPerFile", BLOBS)
        .text(path)
    )


class Marks:
    """Where marks come next in some bytes. A hit is remembered until it is passed, so no stretch is searched twice."""

    def __init__(self, data: bytes):
        self.data, self.hits = data, {}

    def next(self, mark: bytes, at: int) -> int:
        """The mark's first place from ``at`` on, which never falls; the end if there is none."""
        hit = self.hits.get(mark, -1)
        if hit < at:
            hit = self.data.find(mark, at)
            hit = self.hits[mark] = len(self.data) if hit < 0 else hit
        return hit


def _fields(data: bytes, at: int, head: int) -> dict[str, str]:
    """Header fields by lower-case name. Of repeated ones the first counts; folded lines are joined."""
    fields, name = {}, None
    at = data.find(b"\r\n", at) + 2
    while at < head:
        end = data.find(b"\r\n", at)
        line = data[at:end].decode("utf-8", "replace")
        at = end + 2
        if line[:1] in (" ", "\t"):
            if name:
                fields[name] += " " + line.strip(" \t")
            continue
        name, colon, value = line.partition(":")
        name = name.strip(" \t").lower()
        if not colon or not name:
            raise Damaged("unreadable header")
        if name in fields:
            name = None
        else:
            fields[name] = value.strip(" \t")
    return fields


def _agrees(wanted: str, block: memoryview) -> bool:
    """Whether a block has a labelled digest, in hex or base 32. Unknown kinds are not checked."""
    kind, _, value = wanted.partition(":")
    kind = kind.strip().lower().replace("-", "")
    if kind not in DIGESTS:
        return True
    made = hashlib.new(DIGESTS[kind], block, usedforsecurity=False).digest()
    value = value.strip()
    if value.lower() == made.hex():
        return True
    return value.upper().rstrip("=") == base64.b32encode(made).decode().rstrip("=")


def _number(value: str | None) -> int | None:
    return int(value) if value else None


def _parse(marks: Marks, at: int) -> tuple[dict, int]:
    """The record at a place and where it ends."""
    data = marks.data
    if not data.startswith(VERSION, at):
        raise Damaged("no version line and header")
    head = marks.next(END, at)
    if head == len(data):
        raise Damaged("no version line and header")
    fields = _fields(data, at, head)
    try:
        start = head + len(END)
        end = start + int(fields["content-length"])
        url = fields.get("warc-target-uri")
        page_id, refers_to = _number(fields.get("page-id")), _number(fields.get("page-refers-to"))
        kind = fields["warc-type"].lower()
        record_id = fields["warc-record-id"]
    except (ValueError, KeyError) as e:
        raise Damaged("unreadable header") from e
    if end < start or not data.startswith(END, end):
        raise Damaged("length does not lead to the record's end")
    block = memoryview(data)[start:end]
    if "warc-block-digest" in fields and not _agrees(fields["warc-block-digest"], block):
        raise Damaged("block digest")
    body = start
    if fields.get("content-type", "").lower().startswith("application/http"):
        body = data.find(END, start, end) + len(END)
        # An HTTP message without a body may end with its last header line.
        body = end if body < len(END) else body
    if "page-id" in fields:
        url = unquote(url or "")
    elif url and url.startswith("<") and url.endswith(">"):
        url = url[1:-1]
    return {
        "warc_type": kind,
        "record_id": record_id,
        "warc_date": fields.get("warc-date"),
        "page_id": page_id,
        "url": url,
        "payload_digest": (fields.get("warc-payload-digest") or "").removeprefix("sha256:") or None,
        "refers_to_id": fields.get("warc-refers-to"),
        "refers_to": refers_to,
        "payload": None if kind == "revisit" else data[body:end],
    }, end + len(END)


def _member(data: bytes, at: int) -> tuple[bytes, int]:
    """Content of the gzip member at ``at`` and where it ends."""
    d, out, fed = zlib.decompressobj(31), [], at
    try:
        while not d.eof and fed < len(data):
            out.append(d.decompress(data[fed : fed + (1 << 16)]))
            fed += 1 << 16
    except zlib.error as e:
        raise Damaged("gzip member") from e
    if not d.eof:
        raise Damaged("truncated gzip member")
    return b"".join(out), min(fed, len(data)) - len(d.unused_data)


def _at(marks: Marks, at: int) -> tuple[list[dict], int]:
    """The records at a place, none for an empty member, and the place behind them."""
    data = marks.data
    if data.startswith(MAGIC, at):
        content, end = _member(data, at)
        inner, found, place = Marks(content), [], 0
        while place < len(content):
            one, place = _parse(inner, place)
            found.append(one)
        return found, end
    if data.startswith(VERSION, at):
        one, end = _parse(marks, at)
        return [one], end
    raise Damaged("neither member nor version line")


def salvage(data: bytes) -> Iterator[dict]:
    """Records and gaps of one archive in order, each with offset and length; they tile the archive."""
    marks, at, gap, reason = Marks(data), 0, None, ""
    while at < len(data):
        try:
            found, end = _at(marks, at)
        except Damaged as e:
            if gap is None:
                gap, reason = at, str(e)
            at = min(marks.next(MAGIC, at + 1), marks.next(VERSION, at + 1))
            continue
        if gap is not None:
            yield {"offset": gap, "length": at - gap, "gap_reason": reason}
            gap = None
        for i, one in enumerate(found):
            yield one | {"offset": end if i else at, "length": 0 if i else end - at}
        at = end
    if gap is not None:
        yield {"offset": gap, "length": len(data) - gap, "gap_reason": reason}


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for path, content in zip(b.column("path").to_pylist(), b.column("content"), strict=True):
            rows, size = [], 0
            for found in salvage(content.as_py() or b""):
                rows.append({"archive": path} | found)
                size += len(found.get("payload") or b"") + 500
                if size > 8 << 20:
                    yield batch(_READ, {f.name: [r.get(f.name) for r in rows] for f in _READ})
                    rows, size = [], 0
            if rows:
                yield batch(_READ, {f.name: [r.get(f.name) for r in rows] for f in _READ})


def read(spark: SparkSession, path: str) -> DataFrame:
    """Records and, with ``gap_reason``, the quarantined gaps of all archives of a folder."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(_read, READ)


def gaps(found: DataFrame) -> DataFrame:
    return found.filter("gap_reason IS NOT NULL").select("archive", "offset", "length", "gap_reason")


def digests(found: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to), made from what was read."""
    own = F.col("payload").isNotNull()
    return found.filter("gap_reason IS NULL").select(
        "page_id",
        F.when(own, F.octet_length("payload")).cast("long").alias("payload_bytes"),
        F.when(own, F.sha2("payload", 256)).otherwise(F.col("payload_digest")).alias("payload_digest"),
        F.col("warc_type").alias("record_type"),
        "refers_to",
    )


def resolved(rows: DataFrame) -> DataFrame:
    """Digest rows whose revisits have the size of the response they refer to, null if that was lost."""
    firsts = (
        rows.filter("record_type = 'response'")
        .groupBy(F.col("page_id").alias("refers_to"), "payload_digest")
        .agg(F.max("payload_bytes").alias("whole"))
    )
    return rows.join(firsts, ["refers_to", "payload_digest"], "left").select(
        "page_id", F.coalesce("payload_bytes", "whole").alias("payload_bytes"),
        "payload_digest", "record_type", "refers_to",
    )


def roundtrip(pages: DataFrame) -> DataFrame:
    """Write all pages, read the archives back, and describe each record read."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write(pages, path)
    return resolved(materialize(digests(read(spark, path)), "warc-records"))


ORACLE_SQL = f"""
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes,
    sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (
  SELECT *, CASE WHEN payload_bytes >= {REVISIT_BYTES}
    THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first FROM p
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to FROM f"""
