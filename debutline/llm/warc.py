"""WARC archives: pages written as records, long ones in segments, and read back whole.

A record is one value of Spark's text writer with the blank lines after it as the line separator, so archives are written by the usual
commit protocol and any file system that Spark knows. A response holds its page in chunked transfer framing; a block above `SEGMENT_BYTES` is
cut into a first segment and continuation records, which may lie in any file. A page whose payload another page has is a revisit of it.

Reading parses files of bounded size; segments meet by origin id, are ordered by their number, checked for gaps and against the total length,
and only then unframed.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from debutline.llm.shared import cut_lineage, scratch_path

SEGMENT_BYTES = 16 << 10
CHUNK_BYTES = 4 << 10
RECORDS_PER_FILE = 1000
LEAST_REVISIT_BYTES = 0
# --- fixed values of the formats
_END = "\r\n\r\n"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# --- end of fixed values


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    parts = [payload[at : at + size] for at in range(0, len(payload), size)]
    return b"".join(b"%x\r\n%s\r\n" % (len(part), part) for part in parts) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    """The payload of a chunked body; chunk extensions and trailers are read over. ValueError where the framing is broken."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            raise ValueError("chunk size without an end")
        size = int(body[at:end].split(b";")[0].strip() or b"x", 16)
        at = end + 2
        if size == 0:
            return b"".join(out)
        if at + size + 2 > len(body) or body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("chunk cut short")
        out.append(body[at : at + size])
        at += size + 2


def http_payload(block: bytes) -> bytes:
    head, gap, body = block.partition(b"\r\n\r\n")
    if not gap:
        return b""
    return unchunked(body) if re.search(rb"(?im)^transfer-encoding:[ \t]*chunked[ \t]*\r?$", head) else body


def _record(fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    head = "".join(f"{name}: {value}\r\n" for name, value in fields if value is not None)
    return f"WARC/1.0\r\n{head}Content-Length: {len(block)}{_END}".encode() + block


def _safe(value: str | None) -> str | None:
    return None if value is None else quote(value, safe="%/:?#[]@!$&'()*+,;=-._~ ")


def records_of(name: str, url: str | None, kind: str, refers_to: str | None, payload: bytes, segment_bytes: int = SEGMENT_BYTES) -> list[bytes]:
    """The record of a page, or its segments."""
    uri = lambda x: f"<urn:page:{x}>"
    fields = [("WARC-Type", kind), ("WARC-Record-ID", uri(name)), ("WARC-Date", "2025-01-01T00:00:00Z"), ("WARC-Target-URI", _safe(url)), ("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", f"sha1:{payload_digest(payload)}")]
    if kind == "revisit":
        return [_record([*fields, ("WARC-Refers-To", uri(refers_to)), ("WARC-Profile", _PROFILE)], _HTTP)]
    block = _HTTP + chunked(payload)
    if len(block) <= segment_bytes:
        return [_record(fields, block)]
    parts = [block[at : at + segment_bytes] for at in range(0, len(block), segment_bytes)]
    out = [_record([*fields, ("WARC-Segment-Number", "1")], parts[0])]
    for number, part in enumerate(parts[1:], 2):
        last = ("WARC-Segment-Total-Length", str(len(block)) if number == len(parts) else None)
        own = [("WARC-Type", "continuation"), ("WARC-Record-ID", uri(f"{name}.{number}")), ("WARC-Date", "2025-01-01T00:00:00Z")]
        out.append(_record([*own, ("WARC-Segment-Origin-ID", uri(name)), ("WARC-Segment-Number", str(number)), last], part))
    return out


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields in lower case, block) of each record of an archive; ValueError where it is broken."""
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        if end < 0 or data[at : at + 5] != b"WARC/":
            raise ValueError(f"no record at byte {at}")
        fields = {}
        for line in data[at:end].decode("utf-8", "replace").split("\r\n")[1:]:
            name, _, value = line.partition(":")
            fields[name.strip().lower()] = value.strip()
        start = end + 4
        size = int(fields["content-length"])
        if start + size > len(data):
            raise ValueError(f"record at byte {at} is cut short")
        yield fields, data[start : start + size]
        at = start + size + 4


def write(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html", least_bytes: int = LEAST_REVISIT_BYTES, segment_bytes: int = SEGMENT_BYTES, records_per_file: int = RECORDS_PER_FILE) -> None:
    """One record per page below `folder`. Of pages with equal payloads of `least_bytes` or more that with the greatest id is the response.

    Null html is empty; a null id counts as the least; of rows with one id and payload one is the response.
    """
    held = cut_lineage(
        pages.select(F.monotonically_increasing_id().alias("row"), F.col(page_id).cast("string").alias("id"), F.col(page_id).alias("rank"), F.col(url).alias("url"), F.coalesce(F.col(html), F.lit("")).alias("html")),
        "pages",
    )
    payload = F.col("html").cast("binary")
    light = cut_lineage(held.select("row", "rank", F.sha1(payload).alias("digest"), F.octet_length("html").alias("bytes")), "payloads")
    # a digest with very many copies is reduced where it is read; the way back is a join that Spark may split
    first = light.where(F.col("bytes") >= least_bytes).groupBy("digest").agg(F.max(F.struct("rank", "row")).alias("first"), F.count("*").alias("n")).where("n > 1")
    again = light.where(F.col("bytes") >= least_bytes).join(first.select("digest", F.col("first.row").alias("of")), "digest").where("row <> of").select("row", "of")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(name).to_pylist() for name in ("row", "id", "url", "html", "of")]
            out: list[bytes] = []
            for row, name, target, text, of in zip(*columns):
                own = f"{row}" if name is None else f"{row}:{name}"
                out += records_of(own, target, "response" if of is None else "revisit", None if of is None else f"{of}", text.encode("utf-8", "surrogatepass"), segment_bytes)
                if len(out) >= 500:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])
                    out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])

    # revisits may be any share of the pages, so they are never sent everywhere: the same join at every size
    records = held.join(again.hint("merge"), "row", "left").select("row", "id", "url", "html", "of").mapInArrow(scan, "value binary")
    # the writer takes bytes as they are; a task's own records go to files of `records_per_file`
    records.select(F.col("value").cast("string")).write.option("lineSep", _END).option("maxRecordsPerFile", records_per_file).option("compression", "gzip").text(folder)


_FIELDS = {"name": pa.string(), "page": pa.string(), "kind": pa.string(), "refers_to": pa.string(), "digest": pa.string(), "bytes": pa.int64(), "payload": pa.binary(), "problem": pa.string()}
_PARTS = {"number": pa.int32(), "total": pa.int64()}
_KINDS = {pa.string(): "string", pa.int64(): "long", pa.int32(): "int", pa.binary(): "binary"}


def _schema(fields: dict[str, pa.DataType]) -> str:
    return ", ".join(f"{name} {_KINDS[kind]}" for name, kind in fields.items())


def _batch(rows: list[tuple], fields: dict[str, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([row[k] for row in rows], kind) for k, kind in enumerate(fields.values())], names=list(fields))


def _whole(name: str, kind: str, refers_to: str | None, digest: str | None, block: bytes, problem: str | None, keep: bool) -> tuple:
    """A record by `_FIELDS`; the digest is compared here, so a payload need not be kept to be sure of it."""
    row, _, page = name.partition(":")
    payload = None
    if problem is None and kind != "revisit":
        try:
            payload = http_payload(block)
            if digest and digest != payload_digest(payload):
                problem, payload = "payload digest differs", None
        except ValueError as error:
            problem = str(error)
    return row, page or None, kind, refers_to, digest, None if payload is None else len(payload), payload if keep else None, problem


def _inner(uri: str | None) -> str | None:
    return None if uri is None else uri.strip("<>").removeprefix("urn:page:")


def read(spark: SparkSession, folder: str, keep_payloads: bool = True) -> DataFrame:
    """Whole records of the archives below `folder`: name, page, kind, refers_to, digest, bytes, payload (of revisits none), problem.

    `problem` names what is wrong with a record (a gap between segments, a wrong total length, broken framing, a wrong digest); it has no payload.
    Archives may be packed by gzip. Only segments are shuffled.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("content")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                data, rows = content.as_py(), []
                for fields, block in parse(gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data):
                    origin, number = fields.get("warc-segment-origin-id"), int(fields.get("warc-segment-number", 0))
                    digest = (fields.get("warc-payload-digest") or "").removeprefix("sha1:") or None
                    known = _inner(origin or fields["warc-record-id"]), fields["warc-type"], _inner(fields.get("warc-refers-to")), digest
                    if number:  # as it is, to be joined
                        rows.append((known[0], None, *known[1:], None, block, None, number, int(fields.get("warc-segment-total-length", -1))))
                    else:
                        rows.append((*_whole(*known, block, None, keep_payloads), 0, -1))
                    if len(rows) >= 500:
                        yield _batch(rows, _FIELDS | _PARTS)
                        rows = []
                if rows:
                    yield _batch(rows, _FIELDS | _PARTS)

    records = cut_lineage(files.mapInArrow(scan, _schema(_FIELDS | _PARTS)), "records")

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come by origin and number."""

        def finish(rows):
            problem, head = None, rows[0]
            if [row["number"] for row in rows] != list(range(1, len(rows) + 1)) or head["kind"] == "continuation":
                problem = "segments missing"
            elif rows[-1]["total"] != sum(len(row["payload"]) for row in rows):
                problem = "total length differs"
            return _whole(head["name"], head["kind"], head["refers_to"], head["digest"], b"".join(row["payload"] for row in rows), problem, keep_payloads)

        held: list[dict] = []
        for batch in batches:
            out = []
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                if held and held[0]["name"] != row["name"]:
                    out.append(finish(held))
                    held = []
                held.append(row)
            if out:
                yield _batch(out, _FIELDS)
        if held:
            yield _batch([finish(held)], _FIELDS)

    segments = records.where("number > 0").repartition("name").sortWithinPartitions("name", "number")
    return records.where("number = 0").select(*_FIELDS).unionAll(segments.mapInArrow(joined, _schema(_FIELDS)))


def read_pages(spark: SparkSession, folder: str) -> DataFrame:
    """A row per page of the archives: page_id, payload_bytes, payload_digest, record_type, refers_to, problem.

    What a revisit says of its payload is looked up in the response that it refers to.
    """
    rows = cut_lineage(read(spark, folder, keep_payloads=False).drop("payload"), "read")
    own = rows.where("kind <> 'revisit'")
    again = rows.where("kind = 'revisit'").join(own.select(F.col("name").alias("of"), F.col("page").alias("of_page"), F.col("bytes").alias("of_bytes"), F.col("digest").alias("of_digest")), F.col("refers_to") == F.col("of"), "left")
    lost = F.coalesce("problem", F.when(F.col("of").isNull(), "response missing"), F.when(F.col("of_digest") != F.col("digest"), "payload digest differs"))
    page = lambda name: F.col(name).cast("long")
    return own.select(page("page").alias("page_id"), F.col("bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"), F.col("kind").alias("record_type"), F.lit(None).cast("long").alias("refers_to"), "problem").unionAll(
        again.select(page("page").alias("page_id"), F.col("of_bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"), F.col("kind").alias("record_type"), page("of_page").alias("refers_to"), lost.alias("problem"))
    )


def round_trip(pages: DataFrame, **options) -> DataFrame:
    """`pages` written as archives in the shared folder and read back."""
    folder = scratch_path(pages.sparkSession, "warc")
    write(pages, folder, **options)
    return read_pages(pages.sparkSession, folder)
