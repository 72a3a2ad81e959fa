"""Web archive (WARC) files as tables of record chunks, written and read by Spark's own file sources.

Writing: payloads with equal digests are one response record, that with the largest id, and revisit
records that refer to it. A payload longer than ``CHUNK`` bytes becomes a first record and ``continuation``
records of the format's segmentation, so the writer handles one chunk at a time. Records go out as lines of
gzip text files; each file holds whole records, with all segments of a record in turn. Only the digests that repeat are
joined to the rows, so payloads cross no exchange while those digests are few (see ``skew_join``).

Reading: a file is a stream of lines. The parser follows Content-Length and keeps running digests per
record, never a whole record; every ``CHUNK`` bytes leave as a row of the chunk table (record, chunk number, bytes,
length so far, digest of the payload so far). The last chunk carries the digest of the whole payload.

Archives of other writers: records of every type are rows. Header names have any case, lines end with or without a carriage
return, folded lines belong to the line before. Digests may be base32 or hex; a digest that is missing or not SHA-1 is
NULL, and so is ``intact`` of its record. In a block of type ``application/http`` the payload begins after the HTTP header;
transfer encodings are not undone. A record that its file cuts off, or without a usable Content-Length, ends with a chunk whose
``broken`` is true, and reading goes on with the next record. A gzip stream that is cut off fails the job, unless
``spark.sql.files.ignoreCorruptFiles`` is set. A line longer than a task's memory cannot be read.

A NULL payload is empty. NULL and repeated ids are records of their own rows; rows that share id and payload with
the response are responses too, and payloads of rows with NULL ids only are all responses. An empty
table gives no files and no rows.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from talkatlas.operators.skew import skew_join

CHUNK = 1 << 16
MIN_BYTES = 0
LINE = "\r\n"
CHUNKS = (
    "record string, page_id long, record_type string, refers_to long, url string, refers_record string, chunk int, last boolean, "
    "broken boolean, bytes binary, length long, digest string, stated string, stated_bytes long"
)


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def _base32_of_hex(digest: Column) -> Column:
    """Base32 of a SHA-1 in hex: five hex digits are four of base32."""
    groups = [F.lpad(F.conv(F.substring(digest, 5 * k + 1, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _header(*fields: tuple[str, Column | str]) -> Column:
    """Header lines; a field whose value is NULL is left out. A final line feed comes with the row."""
    lines = [F.lit("WARC/1.1\r")]
    for name, value in fields:
        lines.append(F.concat(F.lit(f"{name}: "), F.lit(value) if isinstance(value, str) else value.cast("string"), F.lit("\r")))
    return F.array_join(F.filter(F.array(*lines), lambda x: x.isNotNull()), "\n")


def record_rows(pages: DataFrame, page_id: str, url: str, payload: str, min_bytes: int = MIN_BYTES, chunk: int = CHUNK) -> DataFrame:
    """One row ``value`` per segment, in file order within a partition: header, payload bytes, record end."""
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), body.alias("body")
    ).withColumns({"sha1": F.sha1("body"), "size": F.octet_length("body").cast("long")})
    shared = rows.where(F.col("size") >= min_bytes).groupBy("sha1").agg(F.max("page_id").alias("response"), F.count(F.lit(1)).alias("n"))
    rows = skew_join(rows, shared.where("n > 1").drop("n"), "sha1", "left")
    revisit = F.col("response").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response"))
    sent = F.when(revisit, 0).otherwise(F.col("size"))
    count = F.greatest(F.ceil(sent / F.lit(chunk)), F.lit(1)).cast("int")
    rows = rows.select(
        "*",
        revisit.alias("revisit"),
        sent.alias("sent"),
        count.alias("chunks"),
        F.expr("uuid()").alias("record"),
    ).withColumn("n", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    part = F.when(F.col("revisit"), F.lit(b"")).otherwise(F.substring("body", F.col("n") * chunk + 1, F.lit(chunk)))
    first, many = F.col("n") == 0, F.col("chunks") > 1
    last = F.col("n") == F.col("chunks") - 1
    url_line = F.when(first, F.regexp_replace("url", "[\\r\\n]", "%0A"))
    kind = F.when(~first, F.lit("continuation")).when(F.col("revisit"), F.lit("revisit")).otherwise(F.lit("response"))
    header = _header(
        ("WARC-Type", kind),
        ("WARC-Record-ID", F.concat(F.lit("<urn:uuid:"), "record", F.when(first, F.lit("")).otherwise(F.concat(F.lit("."), F.col("n").cast("string"))), F.lit(">"))),
        ("WARC-Date", "2000-01-01T00:00:00Z"),
        ("WARC-Target-URI", url_line),
        ("X-Page-ID", F.col("page_id")),
        ("WARC-Payload-Digest", F.when(first, F.concat(F.lit("sha1:"), _base32_of_hex(F.col("sha1"))))),
        ("X-Payload-Length", F.when(first, F.col("size"))),
        ("WARC-Profile", F.when(F.col("revisit"), F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        ("X-Refers-To-Page-ID", F.when(F.col("revisit"), F.col("response"))),
        ("WARC-Segment-Number", F.when(many, F.col("n") + 1)),
        ("WARC-Segment-Origin-ID", F.when(~first, F.concat(F.lit("<urn:uuid:"), "record", F.lit(">")))),
        ("WARC-Segment-Total-Length", F.when(many & last, F.col("size"))),
        ("Content-Type", "application/octet-stream"),
        ("Content-Length", F.octet_length(part)),
    )
    value = F.concat(header.cast("binary"), F.lit(b"\n\r\n"), part, F.lit(b"\r\n\r"))
    return rows.select(value.cast("string").alias("value"))


def write_archives(
    pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", payload: str = "html", min_bytes: int = MIN_BYTES, chunk: int = CHUNK
) -> None:
    """Archives under ``path``: one gzip file per task, which one later task reads as a stream."""
    rows = record_rows(pages, page_id, url, payload, min_bytes, chunk)
    rows.write.option("lineSep", "\n").option("compression", "gzip").text(path)


def _sha1(stated: str | None) -> str | None:
    """A stated SHA-1, base32 or hex, as base32; None for anything else."""
    kind, _, digest = (stated or "").strip().partition(":")
    if kind.lower() not in ("sha1", "sha-1"):
        return None
    try:
        raw = bytes.fromhex(digest) if len(digest) == 40 else base64.b32decode(digest.upper())
    except (ValueError, binascii.Error):
        return None
    return base32(raw) if len(raw) == 20 else None


def _number(text: str | None) -> int | None:
    """A number of at most 18 digits; None for anything else."""
    text = (text or "").strip()
    bare = text.removeprefix("-")
    return int(text) if bare.isascii() and bare.isdigit() and len(bare) <= 18 else None


def _bare(name: str | None) -> str | None:
    return None if name is None else name.strip("<> ").removeprefix("urn:uuid:")


class Record:
    """What is known of the record that is being read, with its running digest."""

    def __init__(self, fields: dict[str, str]):
        self.record = _bare(fields.get("warc-record-id"))
        self.page = _number(fields.get("x-page-id"))
        self.kind = fields.get("warc-type")
        self.refers = _number(fields.get("x-refers-to-page-id"))
        self.url = fields.get("warc-target-uri")
        self.refers_record = _bare(fields.get("warc-refers-to"))
        http = fields.get("content-type", "").lower().startswith("application/http")
        self.stated = _sha1(fields.get("warc-payload-digest") or (None if http else fields.get("warc-block-digest")))
        self.stated_bytes = _number(fields.get("x-payload-length"))
        self.seam = b"" if http else None  # the end of the HTTP header so far; None inside the payload
        self.sha1 = hashlib.sha1()
        self.length = 0
        self.chunk = 0

    def row(self, data: bytes, last: bool, broken: bool, with_bytes: bool) -> tuple:
        payload = data
        if self.seam is not None:
            head = self.seam + data
            end = head.find(b"\r\n\r\n")
            payload = head[end + 4 :] if end >= 0 else b""
            self.seam = None if end >= 0 else head[-3:]
        self.sha1.update(payload)
        self.length += len(payload)
        self.chunk += 1
        return (
            self.record, self.page, self.kind, self.refers, self.url, self.refers_record, self.chunk - 1, last, broken,
            payload if with_bytes else None, self.length, base32(self.sha1.digest()), self.stated, self.stated_bytes,
        )


class Parser:
    """Follows the lines of archive files and hands on one row per chunk."""

    def __init__(self, with_bytes: bool, chunk: int = CHUNK):
        self.with_bytes, self.chunk = with_bytes, chunk
        self.file = None
        self.fields: dict[str, str] | None = None
        self.name = ""
        self.left = -1  # payload bytes to come; -1 outside of a payload
        self.body, self.held = [], 0
        self.record: Record | None = None
        self.rows: list[tuple] = []

    def line(self, file: int | None, line: bytes) -> None:
        if file != self.file:
            self.end()
            self.file = file
        if self.left >= 0:
            self._payload(line + b"\n")
        elif self.fields is None:
            if line.startswith(b"WARC/"):
                self.fields = {}
        elif line.rstrip(b"\r"):
            self._header(line.rstrip(b"\r").decode("utf-8", "replace"))
        else:
            self._begin()

    def _header(self, line: str) -> None:
        if line[0] in " \t" and self.name:
            self.fields[self.name] += " " + line.strip()
            return
        name, _, value = line.partition(":")
        self.name = name.strip().lower()
        self.fields[self.name] = value.strip()

    def _begin(self) -> None:
        fields = self.fields
        origin = _bare(fields.get("warc-segment-origin-id")) if fields.get("warc-type") == "continuation" else None
        if self.record is not None and (origin is None or origin != self.record.record):
            self._emit(True, True)  # its other segments are missing
            self.record = None
        if self.record is None:
            self.record = Record(fields)
        size = _number(fields.get("content-length"))
        if size is None or size < 0:
            self._emit(True, True)
            self.fields, self.left, self.name, self.record = None, -1, "", None
            return
        self.left = size
        if not size:
            self._finish()

    def _payload(self, data: bytes) -> None:
        take = data[: self.left]
        self.left -= len(take)
        self.body.append(take)
        self.held += len(take)
        if not self.left:
            self._finish()
        elif self.held >= self.chunk:
            self._emit(False, False)

    def _emit(self, last: bool, broken: bool) -> None:
        data = b"".join(self.body)
        self.body, self.held = [], 0
        for at in range(0, max(1, len(data)), self.chunk):
            ends = at + self.chunk >= len(data)
            self.rows.append(self.record.row(data[at : at + self.chunk], last and ends, broken and ends, self.with_bytes))

    def _finish(self) -> None:
        """End of a segment; what follows up to the next version line is the record's end."""
        last = "warc-segment-number" not in self.fields or "warc-segment-total-length" in self.fields
        self._emit(last, False)
        self.fields, self.left, self.name = None, -1, ""
        if last:
            self.record = None

    def end(self) -> None:
        """End of a file: a record that is still open is broken."""
        if self.fields is not None and self.left < 0:  # within a header
            self.record = self.record or Record(self.fields)
        if self.record is not None:
            self._emit(True, True)
        self.fields, self.left, self.name, self.record = None, -1, "", None

    def take(self) -> list[tuple]:
        rows, self.rows = self.rows, []
        return rows


def _parse(with_bytes: bool):
    kinds = [
        pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.bool_(), pa.bool_(),
        pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64(),
    ]
    names = [c.split()[0] for c in CHUNKS.split(", ")]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser, held = Parser(with_bytes), 0
        for batch in batches:
            for file, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                parser.line(file, line)
                held += len(line)
                if held > 1 << 22 and parser.rows:
                    yield batch_of(parser.take())
                    held = 0
        parser.end()
        if parser.rows:
            yield batch_of(parser.take())

    return parse


def read_chunks(spark: SparkSession, path: str, with_bytes: bool = True) -> DataFrame:
    """The chunk table of all archives under ``path``. One task reads a file whole: a plain file that Spark would split is an error."""
    lines = spark.read.schema("value string").option("lineSep", "\n").text(path)
    split = F.raise_error(F.lit("archives must be gzipped, or smaller than a split"))
    file = F.when(F.col("_metadata.file_block_start") > 0, split).otherwise(F.xxhash64("_metadata.file_path"))
    return lines.select(file.alias("file"), F.col("value").cast("binary").alias("value")).mapInArrow(_parse(with_bytes), CHUNKS)


def records(chunks: DataFrame) -> DataFrame:
    """One row per record: what its last chunk says; a revisit states length and digest of the payload it stands for.

    ``intact`` says whether the record is whole and its payload has the digest and the length that are stated; NULL where
    no digest is.
    """
    revisit = F.col("record_type") == "revisit"
    sized = F.coalesce(F.col("length") == F.col("stated_bytes"), F.lit(True))
    return chunks.where("last").select(
        "record",
        "page_id",
        F.when(revisit, F.col("stated_bytes")).otherwise(F.col("length")).alias("payload_bytes"),
        F.when(revisit, F.col("stated")).otherwise(F.col("digest")).alias("payload_digest"),
        "record_type",
        "refers_to",
        "url",
        "refers_record",
        (~F.col("broken") & (F.coalesce(revisit, F.lit(False)) | ((F.col("digest") == F.col("stated")) & sized))).alias("intact"),
    )
