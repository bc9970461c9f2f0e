"""Web archives: write records, read them back, and turn repeated payloads into revisit records."""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbung.llm.arrow import arrow_fields, map_arrow
from lumbung.session import stage, stage_path

CRLF = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
HEADERS = "type string, record_id string, refers_record string, page string, uri string, digest string, payload_bytes bigint"


def digest(payload: Column) -> Column:
    """Base32 of the SHA-1, twenty bits (five hex digits, four base32 digits) at a time."""
    code = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(code, i, 5), 16, 32), 4, "0") for i in range(1, 41, 5)]
    return F.translate(F.upper(F.concat(*parts)), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _line(name: str, value: Column) -> Column:
    """A header line, or nothing for a null; line breaks inside the value are percent-encoded."""
    safe = F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), safe, F.lit(CRLF)), F.lit(""))


def _record(kind: Column, record_id: Column, page: Column, uri: Column, code: Column, payload: Column, refers: Column, date: str) -> Column:
    """One record as text; a revisit record keeps the head of the response and no payload."""
    revisit = kind == "revisit"
    block = F.concat(F.lit(HTTP_HEAD), F.when(revisit, "").otherwise(payload))
    return F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        _line("WARC-Type", kind),
        _line("WARC-Record-ID", F.concat(F.lit("<urn:uuid:"), record_id, F.lit(">"))),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", uri),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), code)),
        _line("WARC-Profile", F.when(revisit, PROFILE)),
        _line("WARC-Refers-To", F.when(revisit, F.concat(F.lit("<urn:uuid:"), refers, F.lit(">")))),
        _line("X-Page-ID", page),
        _line("Content-Type", F.lit("application/http; msgtype=response")),
        _line("Content-Length", F.octet_length(block).cast("string")),
        F.lit(CRLF),
        block,
    )


def _fresh(record_id: Column, salt: str) -> Column:
    """The id of a record in the new archive, the same wherever it is asked for."""
    return F.regexp_replace(F.md5(F.concat(record_id, F.lit(salt))), "^(.{8})(.{4})(.{4})(.{4})", "$1-$2-$3-$4-")


def _now() -> str:
    return datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")


def _save(records: DataFrame, path: str) -> None:
    """Records as gzip files; the line separator is the end mark of a record."""
    options = {"lineSep": CRLF * 2, "compression": "gzip"}
    records.write.options(**options).text(path)


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> None:
    """A response record for every row: id, url and payload (UTF-8, null: empty)."""
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    none = F.lit(None).cast("string")
    record = _record(
        F.lit("response"), F.expr("uuid()"), F.col(id_col).cast("string"), F.col(url_col).cast("string"),
        digest(payload.cast("binary")), payload, none, _now(),
    )
    _save(pages.select(record.alias("value")), path)


class _Parser:
    """Reads records from the lines of archives; bodies are taken by Content-Length, whatever they hold."""

    def __init__(self, payloads: bool):
        self.payloads, self.head, self.body, self.missing = payloads, {}, [], None

    def lines(self, lines: list[bytes]) -> Iterator[tuple]:
        for line in lines:
            if self.missing is not None:
                self.body.append(line)
                self.missing -= len(line) + 1
                if self.missing <= 0:
                    yield self.record()
            elif line.strip():
                name, colon, value = line.partition(b":")
                if colon:
                    self.head[name.strip().lower()] = value.strip()
                else:
                    self.head = {}  # the version line
            elif self.head:
                self.missing = int(self.head.get(b"content-length", b"0"))
                if self.missing == 0:
                    yield self.record()

    def record(self) -> tuple:
        head, length = self.head, int(self.head.get(b"content-length", b"0"))
        block = b"".join(line + b"\n" for line in self.body)[:length]
        self.head, self.body, self.missing = {}, [], None
        kind = head.get(b"warc-type", b"").decode()
        if head.get(b"content-type", b"").startswith(b"application/http"):
            block = block.partition(b"\r\n\r\n")[2]
        code = head.get(b"warc-payload-digest", b"").removeprefix(b"sha1:").decode()
        if kind != "revisit":
            code = base64.b32encode(hashlib.sha1(block).digest()).decode()

        def bare(name: bytes) -> str | None:
            value = head.get(name)
            return value.decode("utf-8", "replace").removeprefix("<urn:uuid:").removesuffix(">") if value is not None else None

        found = (
            kind, bare(b"warc-record-id"), bare(b"warc-refers-to"), bare(b"x-page-id"), bare(b"warc-target-uri"), code or None,
            len(block) if kind != "revisit" else None,
        )
        return (*found, block) if self.payloads else found


def read_archive(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """The records of gzip archives: type, record_id, refers_record, page, uri, digest, payload_bytes and, if asked for, payload.

    Digest and length of a response are taken from its payload, those of a revisit record from its
    header (no length). Gzip files are not split, so a task reads the lines of whole archives in
    order, and holds one record and one batch of lines at a time.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(F.col("value").cast("binary").alias("line"))
    ddl = HEADERS + (", payload binary" if payloads else "")
    fields = arrow_fields(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser, waiting, size = _Parser(payloads), [], 0
        for batch in batches:
            for record in parser.lines(batch.column(0).to_pylist()):
                waiting.append(record)
                size += len(record[-1]) if payloads else 1
                if len(waiting) >= 2000 or payloads and size > 8 << 20:
                    yield table(waiting)
                    waiting, size = [], 0
        if waiting:
            yield table(waiting)

    def table(records: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*records))
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, fields)], names=[f.name for f in fields])

    return map_arrow(lines, run, ddl)


def resolve_revisits(spark: SparkSession, source: str, target: str, min_bytes: int = 0, id_type: str = "bigint") -> None:
    """Write the records of ``source`` to ``target`` with fresh headers and each payload once.

    Of the responses with one payload digest and at least ``min_bytes``, that with the largest page
    (then record) id stays a response, the others become revisit records of it, and so do revisit
    records read from ``source``; those without a response of their digest stay as they are.
    Only headers are grouped and joined by digest: the largest id of a digest is found by partial
    sums, and a digest shared by a third of all records meets one row in the join. Payloads meet
    the list of records that change, which is staged; where that is short, Spark broadcasts it.
    """
    page = F.col("page").cast(id_type)
    heads = stage(read_archive(spark, source), "warc-heads")
    whole = heads.where((F.col("type") != "revisit") & (F.col("payload_bytes") >= min_bytes))
    winners = whole.groupBy("digest").agg(F.max(F.struct(page.alias("page"), "record_id")).alias("best"))
    can_move = (F.col("type") == "revisit") | (F.col("payload_bytes") >= min_bytes)
    found = heads.where(can_move).join(winners.select("digest", F.col("best.record_id").alias("winner")), "digest")
    moved = stage(found.where("winner != record_id").select("record_id", "winner"), "warc-moved")
    records = read_archive(spark, source, payloads=True).join(moved, "record_id", "left")
    salt = uuid.uuid4().hex
    again = F.col("winner").isNotNull()
    record = _record(
        F.when(again, "revisit").otherwise(F.col("type")), _fresh(F.col("record_id"), salt), F.col("page"), F.col("uri"),
        F.col("digest"), F.col("payload").cast("string"),
        F.when(again, _fresh(F.col("winner"), salt)).otherwise(F.col("refers_record")), _now(),
    )
    _save(records.select(record.alias("value")), target)


def archive_pages(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_bytes: int = 0
) -> DataFrame:
    """Archive ``pages``, resolve repeated payloads, and read the result back.

    Per row: ``id_col``, payload_bytes, payload_digest (bare base32 SHA-1 of the full payload),
    record_type (response or revisit) and refers_to (the id of the response that a revisit record
    stands for). A null payload is an empty one; a null id is smaller than all others and comes back
    as null; of repeated rows one stays a response; an empty table gives an empty result; other
    columns are not read. Both archives stay in the shared folder of the session.
    """
    spark, kind = pages.sparkSession, pages.schema[id_col].dataType.simpleString()
    first, second = stage_path(spark, "warc"), stage_path(spark, "warc-deduplicated")
    write_archive(pages, first, id_col, url_col, payload_col)
    resolve_revisits(spark, first, second, min_bytes, kind)
    index = stage(read_archive(spark, second), "warc-index")
    responses = index.where("type != 'revisit'").select(
        F.col("record_id").alias("refers_record"), F.col("page").alias("to"), F.col("payload_bytes").alias("full")
    )
    # Responses refer to nothing: only revisit records look for a partner.
    revisits = index.where("type = 'revisit'").join(responses, "refers_record", "left").select("page", "payload_bytes", "full", "digest", "type", "to")
    none = [F.lit(None).cast(responses.schema[c].dataType).alias(c) for c in ("full", "to")]
    plain = index.where("type != 'revisit'").select("page", "payload_bytes", none[0], "digest", "type", none[1])
    return plain.union(revisits).select(
        F.col("page").cast(kind).alias(id_col),
        F.coalesce("payload_bytes", "full").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        F.col("type").alias("record_type"),
        F.col("to").cast(kind).alias("refers_to"),
    )
