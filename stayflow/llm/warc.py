"""Write captures as WARC records and assemble them again.

A page becomes a request, a response and a metadata record; request and
metadata name the response in ``WARC-Concurrent-To``. Of pages with equal
payloads the one with the largest id is the response, the others are revisit
records that refer to it and carry no payload. Archives are gzip files written
by Spark's text writer, whose line separator is the end of a record.

The reader takes any ``.warc`` or ``.warc.gz`` files (one or many gzip members)
through Spark's binary source, so every store that Spark reads will do. Records
of all files meet on the identifier they are concurrent to.

Nulls: a null html is an empty payload, a null url an empty target, a null page
id an empty one that sorts below all others. Rows equal in all columns give
equal records, which are counted and come back as often. An empty table gives
an empty folder. Other columns are not written.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayflow.llm.common import importable, sliced
from stayflow.session import materialize

_END = "\r\n\r\n"
#: The alphabet of base32.
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(data: Column) -> Column:
    """SHA-1 in base32: four groups of 40 bits, eight characters each."""
    digest = F.sha1(data)
    groups = [F.conv(F.substring(digest, 1 + 10 * g, 10), 16, 10).cast("bigint") for g in range(4)]
    letter = lambda bits, n: F.substring(F.lit(_BASE32), (F.shiftright(bits, 35 - 5 * n).bitwiseAND(F.lit(31)) + 1).cast("int"), F.lit(1))
    return F.concat(*[letter(bits, n) for bits in groups for n in range(8)])


def _id(page_id: Column, key: Column, kind: str) -> Column:
    return F.concat(F.lit("<urn:page:"), page_id, F.lit(":"), key, F.lit(f":{kind}>"))


def _record(headers: list[tuple[str, Column]], block: Column) -> Column:
    lines = [F.lit("WARC/1.1\r\n")]
    for name, value in headers:
        lines.append(F.when(value.isNull(), F.lit("")).otherwise(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))))
    return F.concat(*lines, F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit(_END), block)


def _header_value(text: Column) -> Column:
    """A target as one header line: line ends and per cent signs as in URLs."""
    for raw, escaped in (("%", "%25"), ("\r", "%0D"), ("\n", "%0A")):
        text = F.replace(text, F.lit(raw), F.lit(escaped))
    return text


def warc_records(pages: DataFrame, least_payload: int = 0, captured_at: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """One row per record, ``value`` being the record without its closing line ends.

    Payloads below ``least_payload`` bytes are written in full every time.
    Equal payloads are found by digest: the largest id per digest comes from an
    aggregation, and the rows of a payload shared by many are never in one group.
    """
    rows = pages.select(
        F.col("page_id"),
        F.coalesce(F.col("page_id").cast("string"), F.lit("")).alias("page"),
        _header_value(F.coalesce("url", F.lit(""))).alias("url"),
        F.coalesce("html", F.lit("")).alias("html"),
    )
    rows = rows.withColumn("digest", base32_sha1(F.col("html").cast("binary")))
    rows = rows.withColumn("key", F.substring(F.md5(F.concat("url", F.lit("\n"), "digest").cast("binary")), 1, 16))
    first = rows.groupBy("digest").agg(F.max(F.struct("page_id", "page", "key", "url")).alias("first"))
    rows = rows.join(first, "digest")
    # rows of one id and payload are all responses, also if their targets differ
    is_first = F.col("first.page_id").eqNullSafe(F.col("page_id")) | (F.octet_length("html") < least_payload)
    rows = rows.withColumn("kind", F.when(is_first, F.lit("response")).otherwise(F.lit("revisit")))
    main, at, digest = _id(F.col("page"), F.col("key"), "main"), F.lit(captured_at), F.concat(F.lit("sha1:"), "digest")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length("html").cast("string"), F.lit(_END))
    revisit = F.col("kind") == "revisit"
    of_revisit = lambda value: F.when(revisit, value)
    capture = _record(
        [
            ("WARC-Type", F.col("kind")),
            ("WARC-Record-ID", main),
            ("WARC-Date", at),
            ("WARC-Target-URI", F.col("url")),
            ("WARC-Payload-Digest", digest),
            ("WARC-Profile", of_revisit(F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
            ("WARC-Refers-To", of_revisit(_id(F.col("first.page"), F.col("first.key"), "main"))),
            ("WARC-Refers-To-Target-URI", of_revisit(F.col("first.url"))),
            ("WARC-Refers-To-Date", of_revisit(at)),
            ("Content-Type", F.lit("application/http; msgtype=response")),
        ],
        F.when(revisit, http).otherwise(F.concat(http, "html")),
    )
    request = _record(
        [
            ("WARC-Type", F.lit("request")),
            ("WARC-Record-ID", _id(F.col("page"), F.col("key"), "request")),
            ("WARC-Concurrent-To", main),
            ("WARC-Date", at),
            ("WARC-Target-URI", F.col("url")),
            ("Content-Type", F.lit("application/http; msgtype=request")),
        ],
        F.concat(F.lit("GET "), "url", F.lit(" HTTP/1.1\r\nAccept: text/html" + _END)),
    )
    metadata = _record(
        [
            ("WARC-Type", F.lit("metadata")),
            ("WARC-Record-ID", _id(F.col("page"), F.col("key"), "metadata")),
            ("WARC-Concurrent-To", main),
            ("WARC-Date", at),
            ("WARC-Target-URI", F.col("url")),
            ("Content-Type", F.lit("application/warc-fields")),
        ],
        F.concat(F.lit("page-id: "), "page", F.lit("\r\npayload-bytes: "), F.octet_length("html").cast("string"), F.lit("\r\n")),
    )
    return rows.select(F.explode(F.array(request, capture, metadata)).alias("value"))


def write_warc(pages: DataFrame, path: str, least_payload: int = 0, captures_per_file: int = 20_000, file_bytes: int = 256 << 20) -> None:
    """Archives of the pages under ``path``.

    A file holds ``captures_per_file`` captures at most, and not more than make
    up ``file_bytes`` of payload at the mean size of a page: a reader holds a file.
    """
    mean = pages.agg(F.avg(F.coalesce(F.octet_length("html"), F.lit(0)))).first()[0] or 0
    captures_per_file = max(1, min(captures_per_file, int(file_bytes / (mean + 2_000))))
    warc_records(pages, least_payload).write.option("lineSep", _END).option("compression", "gzip").option("maxRecordsPerFile", 3 * captures_per_file).text(path)


#: Bytes unpacked at a time.
_PIECE = 1 << 20


def _inflated(data: bytes) -> Iterator[bytes]:
    """The content in pieces: gzip members one after the other, or the bytes as they are."""
    if data[:2] != b"\x1f\x8b":
        yield data
        return
    while data:
        member = zlib.decompressobj(31)
        rest = data
        while not member.eof and rest:
            yield member.decompress(rest, _PIECE)
            rest = member.unconsumed_tail
        yield member.flush()
        data = member.unused_data


class _Reader:
    """A window on the pieces of an archive that moves forward."""

    def __init__(self, pieces: Iterator[bytes]):
        self.pieces, self.held, self.at, self.ended = pieces, b"", 0, False

    def more(self) -> bool:
        """Take one more piece; what was read is let go."""
        piece = next(self.pieces, None)
        if piece is None:
            self.ended = True
            return False
        self.held, self.at = self.held[self.at :] + piece, 0
        return True

    def has(self, n: int) -> bool:
        while len(self.held) - self.at < n and self.more():
            pass
        return len(self.held) - self.at >= n

    def until(self, mark: bytes) -> bytes | None:
        """What stands before the next ``mark``, and moves after it; None without one."""
        while (end := self.held.find(mark, self.at)) < 0:
            if not self.more():
                return None
        out = self.held[self.at : end]
        self.at = end + len(mark)
        return out

    def take(self, n: int) -> bytes:
        if not self.has(n):
            raise ValueError("a WARC record ends early")
        out = self.held[self.at : self.at + n]
        self.at += n
        return out


def parse_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """The records of an archive: headers by lower-case name, and the block. Holds one record at a time."""
    reader = _Reader(_inflated(data))
    while True:
        while reader.has(2) and reader.held.startswith(b"\r\n", reader.at):
            reader.at += 2
        if not reader.has(1):
            return
        head = reader.until(_END.encode())
        if head is None or not head.startswith(b"WARC/"):
            raise ValueError("not a WARC record")
        fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:])}
        yield fields, reader.take(int(fields["content-length"]))


RECORD = "type string, record_id string, concurrent_to string, uri string, refers_to string, payload_digest string, fields string, payload_bytes bigint, payload binary"
_RECORD = pa.schema([("type", pa.string()), ("record_id", pa.string()), ("concurrent_to", pa.string()), ("uri", pa.string()), ("refers_to", pa.string()), ("payload_digest", pa.string()), ("fields", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary())])
_BATCH_BYTES = 8 << 20


def _records(with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size = 0
        for batch in sliced(batches, 1):  # a row is a file
            for content in batch.column("content"):
                for head, block in parse_warc(content.as_py()):
                    kind, payload, fields = head.get("warc-type"), None, None
                    digest = head.get("warc-payload-digest", "").removeprefix("sha1:") or None
                    if kind in ("response", "resource"):
                        payload = block.partition(b"\r\n\r\n")[2] if kind == "response" else block
                        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                    elif kind == "metadata":
                        fields = block.decode("utf-8", "replace")
                    rows.append((kind, head.get("warc-record-id"), head.get("warc-concurrent-to"), head.get("warc-target-uri"), head.get("warc-refers-to"), digest, fields, None if payload is None else len(payload), payload if with_payload else None))
                    size += len(payload or b"") + 200
                    if size >= _BATCH_BYTES:
                        yield _batch(rows)
                        rows, size = [], 0
        if rows:
            yield _batch(rows)

    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _RECORD)], schema=_RECORD)


def read_warc(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """One row per record of the archives under ``path``.

    ``payload_bytes`` and the digest of a response are taken from its payload
    as read. Without ``payload`` that column is null and never leaves the task.
    """
    importable(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.{gz,warc}").load(path).select("content")
    return files.mapInArrow(_records(payload), RECORD)


def assemble_captures(records: DataFrame) -> DataFrame:
    """One nested row per capture: capture_id, capture, request, metadata.

    A record belongs to the capture it is concurrent to, a response or revisit
    to its own identifier. Equal records are counted and give as many rows; a
    capture without request or metadata keeps its row with nulls there.
    """
    is_main = F.col("type").isin("response", "revisit", "resource")
    row = F.struct(*[c for c in records.columns if c not in ("concurrent_to",)])
    key = F.when(is_main, F.col("record_id")).otherwise(F.coalesce("concurrent_to", "record_id"))
    pick = lambda kept: F.first(F.when(kept, row), ignorenulls=True)
    met = records.groupBy(key.alias("capture_id")).agg(
        pick(is_main).alias("capture"),
        pick(F.col("type") == "request").alias("request"),
        pick(F.col("type") == "metadata").alias("metadata"),
        F.sum(is_main.cast("int")).alias("times"),
    )
    return met.where("capture is not null").withColumn("time", F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))).drop("time", "times")


def resolve_revisits(captures: DataFrame) -> DataFrame:
    """The captures with ``payload_bytes`` and ``payload_digest`` of the full payload, also for revisits.

    A revisit takes them from the capture it refers to. Its length stays null
    where that capture is not there or has another digest than the revisit says.
    """
    captures = materialize(captures, "captures")  # read twice
    full = captures.where("capture.payload_bytes is not null").groupBy(F.col("capture_id").alias("target")).agg(F.min(F.struct("capture.payload_bytes", "capture.payload_digest")).alias("full"))
    # captures that refer to none have keys of their own
    at = F.when(F.col("capture.type") == "revisit", F.col("capture.refers_to"))
    met = captures.withColumn("target_id", F.coalesce(at, F.concat(F.lit("none "), F.coalesce("capture_id", F.lit(""))))).join(full, F.col("target_id") == F.col("target"), "left")
    said = F.col("capture.payload_digest")
    found = F.when(said.isNull() | (said == F.col("full.payload_digest")), F.col("full.payload_bytes"))
    return met.select(*captures.columns, F.coalesce("capture.payload_bytes", found).alias("payload_bytes"), F.coalesce(said, F.col("full.payload_digest")).alias("payload_digest"))
