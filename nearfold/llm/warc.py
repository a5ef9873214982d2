"""WARC archives: a writer with revisit records and a salvage reader.

The writer turns pages into WARC/1.1 records and has Spark's own text writer put
them into files of bounded size, so archives go to any store Spark can write to.
Of pages with equal payloads of ``min_revisit`` bytes or more, the one with the
largest id is stored and the others are ``revisit`` records that refer to it.
Who refers to whom is decided on digests and ids alone; payloads are not
shuffled unless more than ``BROADCAST_IDS`` pages are revisits.

The reader takes whole files (plain, gzip with one or several records a member, or both mixed), checks
every record (version line, header lines, length, the blank lines behind the
block, block and payload digest) and after a failed check searches for the next
place where a record can begin: a gzip member that inflates, or a version line
(not only at the start of a line, as the record before may be cut) whose record
passes. What it skips is reported as a gap with
its byte range and cause; later records are recovered. Inside a member the same search runs over
the inflated bytes; the gaps of a member are one row ahead of its records, with the file range of
the member, and the cause names the inflated ranges. Of a member that is cut or fails its own check, what inflates up to the fault is searched,
and only records whose stated digest was compared are recovered. A member is inflated up
to ``MAX_INFLATED`` bytes, what Spark can hold in one value; the rest is a gap. A file is one row for
Spark and must be under 2 GB.

Defined cases: null html is an empty payload; null url and null id leave their
header out; line breaks in a url are percent-encoded; rows that share the largest
id of a group are all stored; rows repeated below it all refer to it; an empty
table gives no record; other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nearfold.llm.common import sized_hint, whole
from nearfold.sources.scratch import scratch_root, stage

MIN_REVISIT = 1000
FILE_BYTES = 8 << 20
END = "\r\n\r\n"
_VERSION_LINE = re.compile(rb"WARC/1\.[01]\r\n")
_MEMBER = b"\x1f\x8b\x08"
_HEADER = re.compile(r"[!#$%&'*+.^_`|~0-9A-Za-z-]+:.*", re.S)
#: The end of a header is looked for here first.
MAX_HEADER_BYTES = 1 << 16
MAX_INFLATED = (1 << 31) - 1
_STEP = 1 << 16


# -- writing ----------------------------------------------------------------


def revisits(pages: DataFrame, id_col: str, text_col: str, min_revisit: int) -> DataFrame:
    """``(id, _digest, refers_to)`` of the pages whose payload is stored under a larger id."""
    payload = whole(text_col)
    large = pages.select(F.col(id_col), F.sha1(payload.cast("binary")).alias("_digest"),
                         F.octet_length(payload).alias("_bytes")).where(F.col("_bytes") >= min_revisit)
    large = stage(large.drop("_bytes"), "warc-digests")
    groups = large.groupBy("_digest").agg(F.max(id_col).alias("refers_to"), F.count(F.lit(1)).alias("_n"))
    groups = stage(groups.where("_n > 1").drop("_n"), "warc-groups")
    found = large.join(sized_hint(groups), "_digest")
    found = found.where(F.col(id_col).isNull() | (F.col(id_col) != F.col("refers_to")))
    return found.where("refers_to is not null").distinct()


def write_warc(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    text_col: str = "html",
    min_revisit: int = MIN_REVISIT,
    file_bytes: int = FILE_BYTES,
    date: str = "2000-01-01T00:00:00Z",
) -> None:
    """Write one record a row of ``pages`` to the new folder ``path``."""
    referring = stage(revisits(pages, id_col, text_col, min_revisit), "warc-revisits")
    payload = whole(text_col)
    rows = pages.select(
        F.col(id_col).alias("_id"), F.col(url_col).alias("_url"), payload.alias("_payload"),
        F.octet_length(payload).alias("_bytes"), F.sha1(payload.cast("binary")).alias("_digest"),
    )
    known = referring.select(F.col(id_col).alias("_ref_id"), F.col("_digest").alias("_ref_digest"), "refers_to")
    rows = rows.join(
        sized_hint(known),
        F.col("_id").eqNullSafe(F.col("_ref_id")) & (F.col("_digest") == F.col("_ref_digest"))
        & (F.col("_bytes") >= min_revisit),
        "left",
    )
    mean = pages.agg(F.avg(F.octet_length(payload))).head()[0] or 0
    records = rows.select(record_text(date).alias("value"))
    records.write.option("lineSep", END).option(
        "maxRecordsPerFile", max(1, int(file_bytes / (mean + 512)))
    ).text(path)


def record_text(date: str) -> Column:
    """A record without the blank lines at its end, from the columns made in :func:`write_warc`."""
    revisit = F.col("refers_to").isNotNull()
    block = F.when(revisit, F.lit("")).otherwise(F.col("_payload"))
    url = F.regexp_replace(F.regexp_replace("_url", "\r", "%0D"), "\n", "%0A")
    record_id = F.concat(F.lit("<urn:page:"), F.col("_id").cast("string"), F.lit(">"))
    refers = F.concat(F.lit("<urn:page:"), F.col("refers_to").cast("string"), F.lit(">"))

    def line(name: str, value: Column) -> Column:
        """Null where the value is null, so that concat_ws leaves the line out."""
        return F.concat(F.lit(f"{name}: "), value)

    headers = F.concat_ws(
        "\r\n",
        F.lit("WARC/1.1"),
        line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", record_id),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", url),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("_digest"))),
        line("WARC-Block-Digest", F.concat(F.lit("sha1:"), F.sha1(block.cast("binary")))),
        line("WARC-Payload-Length", F.col("_bytes").cast("string")),
        line("WARC-Profile", F.when(revisit, F.lit(
            "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        line("WARC-Refers-To", refers),
        line("Content-Length", F.octet_length(block).cast("string")),
    )
    return F.concat(headers, F.lit(END), block)


# -- reading ----------------------------------------------------------------


class Damaged(Exception):
    """A record that fails a check; the message names the cause."""


def parse_record(data: bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    """Headers (names in lower case), block and end of the record that begins at ``at``."""
    if not _VERSION_LINE.match(data, at):
        raise Damaged("version line")
    line_end = data.index(b"\r\n", at) + 2
    blank = data.find(b"\r\n\r\n", line_end - 2, line_end + MAX_HEADER_BYTES)
    if blank < 0:  # a long header; it can reach to the next version line, as none is a header line
        line = data.find(b"\r\nWARC/1.", line_end - 2)
        blank = data.find(b"\r\n\r\n", line_end - 2, line + 2 if line >= 0 else len(data))
    if blank < 0:
        raise Damaged("header not ended")
    headers: dict[str, str] = {}
    for raw in data[line_end:blank].split(b"\r\n") if blank > line_end else ():
        line = raw.decode("utf-8", "replace")
        if not _HEADER.fullmatch(line):
            raise Damaged("header line")
        name, value = line.split(":", 1)
        headers[name.lower()] = value.strip()
    length = headers.get("content-length", "")
    if not re.fullmatch(r"[0-9]{1,18}", length):
        raise Damaged("content length")
    begin = blank + 4
    end = begin + int(length)
    if data[end : end + 4] != END.encode():
        raise Damaged("block not ended")
    block = data[begin:end]
    digest = f"sha1:{hashlib.sha1(block).hexdigest()}"
    for name in compared_digests(headers):
        if headers[name] != digest:
            raise Damaged(name)
    return headers, block, end + 4


def compared_digests(headers: dict[str, str]) -> list[str]:
    """The digest headers that are held against the block."""
    stated = {n for n, v in headers.items() if v.startswith("sha1:") and len(v) == 45}
    # A payload inside HTTP headers has its own digest; only bare payloads can be checked.
    bare = headers.get("warc-type") == "response" and not headers.get("content-type", "").startswith("application/http")
    names = ["warc-block-digest", "warc-payload-digest"] if bare else ["warc-block-digest"]
    return [n for n in names if n in stated]


def salvage(data: bytes) -> Iterator[tuple[str, int, int, dict[str, str] | None, bytes | None, str | None]]:
    """``(kind, start, end, headers, block, cause)``; kind: record or gap, in order, covering the file."""
    places = {"line": -1, "member": -1}

    def following(at: int) -> int:
        """The nearest place from ``at`` on where a gzip member or a version line begins."""
        if places["line"] < at:
            line = _VERSION_LINE.search(data, at)
            places["line"] = line.start() if line else len(data)
        if places["member"] < at:
            member = data.find(_MEMBER, at)
            places["member"] = member if member >= 0 else len(data)
        return min(places.values())

    at, lost, cause = 0, None, None
    while at < len(data):
        try:
            if data[at : at + 3] == _MEMBER:
                inflated, end, fault = _inflate(data, at)
                records, gaps = _member_rows(inflated, fault)
                if not records and (fault or gaps):
                    raise Damaged(fault or gaps)
                if end is None:  # the member's end is unknown: it lasts to the next place where a record can begin
                    end = following(at + 1)
            else:
                headers, block, end = parse_record(data, at)
                records, gaps = [(headers, block)], None
        except Damaged as failed:
            if lost is None:
                lost, cause = at, str(failed)
            at = following(at + 1)
            continue
        if lost is not None:
            yield "gap", lost, at, None, None, cause
            lost = None
        if gaps:
            yield "gap", at, end, None, None, gaps
        for headers, block in records:
            yield "record", at, end, headers, block, None
        at = end
    if lost is not None:
        yield "gap", lost, len(data), None, None, cause


def _inflate(data: bytes, at: int) -> tuple[bytes, int | None, str | None]:
    """Contents of the gzip member at ``at``, and its end; or what precedes a fault, None and the fault.

    Fed in steps, so that no step copies the rest.
    """
    inflater, parts, held, end, step = zlib.decompressobj(wbits=31), [], 0, at, _STEP
    while not inflater.eof and end < len(data):
        before = inflater.copy(), len(parts), held
        try:
            piece = data[end : end + step]
            while piece and not inflater.eof:
                parts.append(inflater.decompress(piece, _STEP * 16))
                held += len(parts[-1])
                if held > MAX_INFLATED:
                    return b"".join(parts)[:MAX_INFLATED], None, "gzip member too large"
                piece = inflater.unconsumed_tail
            end = min(end + step, len(data))
        except zlib.error:
            if step == 1:
                return b"".join(parts), None, "gzip data"
            # Again from before this step, a byte at a time, to keep what precedes the fault.
            inflater, count, held = before
            del parts[count:]
            step = 1
    if not inflater.eof:
        return b"".join(parts), None, "gzip member not ended"
    return b"".join(parts), end - len(inflater.unused_data), None


def _member_rows(inflated: bytes, fault: str | None) -> tuple[list[tuple[dict[str, str], bytes]], str | None]:
    """Headers and blocks of the records in a member, and the causes of its gaps with their inflated ranges."""
    records, gaps, at, lost, cause = [], [], 0, None, None
    while at < len(inflated):
        try:
            headers, block, end = parse_record(inflated, at)
            if fault and not compared_digests(headers):
                raise Damaged(f"{fault}, no digest")
        except Damaged as failed:
            if lost is None:
                lost, cause = at, str(failed)
            line = _VERSION_LINE.search(inflated, at + 1)
            at = line.start() if line else len(inflated)
            continue
        if lost is not None:
            gaps.append(f"{cause}, inflated bytes {lost} to {at}")
            lost = None
        records.append((headers, block))
        at = end
    if lost is not None:
        gaps.append(f"{cause}, inflated bytes {lost} to {at}")
    if fault:
        gaps.append(f"{fault}, after {at} inflated bytes")
    return records, "; ".join(gaps) or None


READ_SCHEMA = (
    "file string, kind string, start long, end long, cause string, record_id string, "
    "record_type string, uri string, refers_to string, stated_digest string, stated_bytes long, "
    "payload_digest string, payload_bytes long, payload binary"
)
#: Payload bytes gathered before a batch is handed on.
BATCH_BYTES = 8 << 20


def read_warc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Records and gaps (see ``READ_SCHEMA``) of all files in ``path``; without payloads on request."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column(0), batch.column(1), strict=True):
                rows, held = [], 0
                for kind, start, end, headers, block, cause in salvage(content.as_py()):
                    row = {"file": file.as_py(), "kind": kind, "start": start, "end": end, "cause": cause}
                    if headers is not None:
                        row |= _described(headers, block, payloads)
                        held += len(block)
                    rows.append(row)
                    if held >= BATCH_BYTES or len(rows) >= 10_000:
                        yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)
                        rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)

    return files.mapInArrow(read, READ_SCHEMA)


_ARROW = pa.schema(
    [
        (part.split()[0], {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[part.split()[1]])
        for part in READ_SCHEMA.split(", ")
    ]
)


def _described(headers: dict[str, str], block: bytes, payloads: bool) -> dict:
    stated = headers.get("warc-payload-length", "")
    return {
        "record_id": headers.get("warc-record-id"),
        "record_type": headers.get("warc-type"),
        "uri": headers.get("warc-target-uri"),
        "refers_to": headers.get("warc-refers-to"),
        "stated_digest": headers.get("warc-payload-digest"),
        "stated_bytes": int(stated) if re.fullmatch(r"[0-9]{1,18}", stated) else None,
        "payload_digest": hashlib.sha1(block).hexdigest(),
        "payload_bytes": len(block),
        "payload": block if payloads else None,
    }


def archive_pages(pages: DataFrame, **options) -> DataFrame:
    """Write ``pages`` into a new folder of the shared scratch space and read the archives back."""
    spark = pages.sparkSession
    path = f"{scratch_root(spark)}/nearfold-warc-{uuid.uuid4().hex}"
    write_warc(pages, path, **options)
    return read_warc(spark, path, payloads=False)


def page_number(column: str) -> Column:
    """The number in ``<urn:page:number>``; null for anything else."""
    return F.regexp_extract(column, "^<urn:page:(-?[0-9]+)>$", 1).try_cast("long")


def page_rows(records: DataFrame) -> DataFrame:
    """``(page_id, payload_bytes, payload_digest, record_type, refers_to)`` of the records read."""
    revisit = F.col("record_type") == "revisit"
    stated = F.regexp_replace("stated_digest", "^sha1:", "")
    return records.where("kind = 'record'").select(
        page_number("record_id").alias("page_id"),
        F.when(revisit, F.col("stated_bytes")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(revisit, stated).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type",
        page_number("refers_to").alias("refers_to"),
    )
