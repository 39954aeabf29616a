"""Quartile bucket digests: a text's hashed byte triplets are counted in 128 buckets, and each bucket's quartile is two bits.

A digest is hex: a byte for the length (its logarithm), a byte for how the first two quartiles stand to the third, and 32 bytes for the
buckets. Two digests are compared by a difference score with a bound: quartile distances of all buckets, plus distances of the
two header bytes that count up to a limit; likeness is 1 less the share of the bound.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from debutline.llm.shared import shards

BUCKETS = 128
HEADER = 2
MOST_HEADER = 32
MOST_BUCKETS = 4 * BUCKETS
_SHARD_CHARS = 1 << 19
# of text in one block of neighbours
BLOCK_BYTES = 32 << 20

_rng = np.random.default_rng(128)
_TABLES = [_rng.permutation(256).astype(np.uint8) for _ in range(9)]
# which bytes of a window of four make a triplet
_TRIPLETS = ((0, 1, 2), (0, 1, 3), (0, 2, 3))
# a quartile apart counts 1, two 2, opposite ends 4
_APART = np.array([0, 1, 2, 4], np.int64)


def bucket_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of 128 counts per text; triplets do not reach over the end of a text."""
    texts = len(offsets) - 1
    out = np.zeros(texts * BUCKETS, np.int64)
    owner = np.repeat(np.arange(texts, dtype=np.int64), np.diff(offsets))
    for number, places in enumerate(_TRIPLETS):
        last = len(data) - places[2]
        if last <= 0:
            continue
        mixed = _TABLES[3 * number][data[:last]] ^ _TABLES[3 * number + 1][data[places[1] : last + places[1]]] ^ _TABLES[3 * number + 2][data[places[2] :]]
        whole = owner[:last] == owner[places[2] :]
        out += np.bincount((owner[:last] * BUCKETS + (mixed & np.uint8(BUCKETS - 1)))[whole], minlength=len(out))
    return out.reshape(texts, BUCKETS)


def digests(texts: list[bytes]) -> np.ndarray:
    """A row of 34 bytes per text."""
    sizes = np.array([len(t) for t in texts], np.int64)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    counts = bucket_counts(np.frombuffer(b"".join(texts), np.uint8), offsets)
    ranked = np.sort(counts, axis=1)
    q1, q2, q3 = (ranked[:, BUCKETS * k // 4 - 1] for k in (1, 2, 3))
    body = (counts > q1[:, None]).astype(np.uint8) + (counts > q2[:, None]) + (counts > q3[:, None])
    ratio = lambda q: np.minimum(q * 15 // np.maximum(q3, 1), 15)
    out = np.zeros((len(texts), HEADER + BUCKETS // 4), np.uint8)
    out[:, 0] = np.minimum(np.round(np.log2(sizes + 1.0) * 8), 255)
    out[:, 1] = ratio(q1) * 16 + ratio(q2)
    four = body.reshape(len(texts), -1, 4)
    out[:, HEADER:] = four[:, :, 0] * 64 + four[:, :, 1] * 16 + four[:, :, 2] * 4 + four[:, :, 3]
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """1 for equal digests, down to 0 for the bound of the difference score; rows of two tables of digests."""
    a, b = a.astype(np.int64), b.astype(np.int64)
    header = np.minimum(np.abs(a[:, 0] - b[:, 0]), MOST_HEADER // 2) + np.minimum(
        np.abs((a[:, 1] >> 4) - (b[:, 1] >> 4)) + np.abs((a[:, 1] & 15) - (b[:, 1] & 15)), MOST_HEADER // 2
    )
    score = header
    for shift in (6, 4, 2, 0):
        score = score + _APART[np.abs(((a[:, HEADER:] >> shift) & 3) - ((b[:, HEADER:] >> shift) & 3))].sum(axis=1)
    return 1 - score / (MOST_HEADER + MOST_BUCKETS)


def fingerprints(documents: DataFrame, text: str = "text") -> DataFrame:
    """`documents` with `_digest` in place of the text; null is empty, and texts of less than three bytes count no triplet."""
    names = [name for name in documents.columns if name != text]
    kinds = ", ".join([*(f"`{name}` {documents.schema[name].dataType.simpleString()}" for name in names), "_digest string"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows = digests([(t or "").encode("utf-8", "surrogatepass") for t in part.column(text).to_pylist()])
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), pa.array([r.tobytes().hex() for r in rows])], names=[*names, "_digest"])

    return documents.select(*[f"`{n}`" for n in names], text).mapInArrow(scan, kinds)


def _cuts(light: DataFrame, order: list[Column], parts: int) -> list[tuple]:
    """The first row (id, mark) of each of about `parts` ranges of the order."""

    def first(batches):
        for batch in batches:
            if batch.num_rows:
                yield batch.slice(0, 1)
                break
        for _ in batches:
            pass

    rows = light.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(first, light.schema).collect()
    return sorted({(row[0] is None, -row[0] if row[0] is not None else 0, row[1]) for row in rows})


def with_next(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", parts: int | None = None) -> DataFrame:
    """Each whole-numbered document beside the next in descending id order (after the last: the first), as digests.

    Columns: the id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next. The edited text is the text with its
    last floor(n_chars / 3) code points replaced by as many first ones of the next document, or all that it has. Null texts are empty;
    null ids come last; rows with the same id are ordered by a hash of the text. A single document is its own next.

    Texts are shuffled once, into blocks of neighbours; the row that opens a block also goes to the block before it. What comes to the driver
    is one id per block.
    """
    spark = documents.sparkSession
    kind = documents.schema[doc_id].dataType.simpleString()
    if kind not in ("tinyint", "smallint", "int", "bigint"):
        raise ValueError(f"{doc_id} is {kind}; the order of documents goes by whole numbers")
    if parts is None:
        size = documents.agg(F.sum(F.octet_length(text))).first()[0] or 0
        parts = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BLOCK_BYTES))
    rows = documents.select(F.col(doc_id).alias("id"), F.xxhash64(text).alias("mark"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    order = [F.col("id").desc_nulls_last(), F.col("mark").asc()]
    cuts = _cuts(rows.select("id", "mark"), order, parts)
    keys = np.array([(int(none), minus, mark) for none, minus, mark in cuts], dtype=[("none", "i8"), ("minus", "i8"), ("mark", "i8")])
    shared = spark.sparkContext.broadcast(keys)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = shared.value
        for batch in batches:
            ids, marks = batch.column(0), batch.column(1).to_numpy(zero_copy_only=False)
            own = np.zeros(len(ids), keys.dtype)
            own["none"] = ids.is_null().to_numpy(zero_copy_only=False)
            own["minus"] = -ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            own["mark"] = marks
            block = np.searchsorted(keys, own, side="right") - 1
            opens = np.flatnonzero(keys[block] == own)
            at = 0
            for part in shards([batch], "text", _SHARD_CHARS):
                here = block[at : at + part.num_rows]
                yield pa.RecordBatch.from_arrays([pa.array(here, pa.int64()), pa.array(np.zeros(len(here), bool)), *part.columns], names=["block", "tail", *batch.schema.names])
                at += part.num_rows
            if len(opens):
                part = batch.take(pa.array(opens))
                before = (block[opens] - 1) % len(keys)
                yield pa.RecordBatch.from_arrays([pa.array(before, pa.int64()), pa.array(np.ones(len(opens), bool)), *part.columns], names=["block", "tail", *batch.schema.names])

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def flush(rows):
            """All but the last of `rows`, each with the row after it."""
            own = [t[3].encode("utf-8", "surrogatepass") for t in rows]
            marks = digests(own)
            first = np.array([k for k in range(len(rows) - 1) if not rows[k][1] and rows[k + 1][0] == rows[k][0]], np.int64)
            edited = []
            for k in first.tolist():
                cut = len(rows[k][3]) // 3
                edited.append((rows[k][3][: len(rows[k][3]) - cut] + rows[k + 1][3][:cut]).encode("utf-8", "surrogatepass"))
            changed = digests(edited) if edited else np.zeros((0, marks.shape[1]), np.uint8)
            columns = [
                pa.array([rows[k][2] for k in first.tolist()], id_type),
                pa.array([len(rows[k][3]) for k in first.tolist()], pa.int64()),
                pa.array([hashlib.sha256(t).hexdigest() for t in edited], pa.string()),
                pa.array([marks[k].tobytes().hex() for k in first.tolist()], pa.string()),
                pa.array([row.tobytes().hex() for row in changed], pa.string()),
                pa.array(likeness(marks[first], changed), pa.float64()),
                pa.array(likeness(marks[first], marks[first + 1]), pa.float64()),
            ]
            return pa.RecordBatch.from_arrays(columns, names=names)

        id_type = None
        for batch in batches:
            id_type = batch.column("id").type
            for part in shards([batch], "text", _SHARD_CHARS):
                for row in zip(*[part.column(n).to_pylist() for n in ("block", "tail", "id", "text")]):
                    held.append(row)
                    size += len(row[3])
                    if size >= _SHARD_CHARS:
                        yield flush(held)
                        held, size = [row], 0
        if len(held) > 1:
            yield flush(held)

    names = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    dealt = rows.mapInArrow(deal, f"block long, tail boolean, id {kind}, mark long, text string")
    # rows of a block with the same id and text may both open it; only the first tail row is read
    together = dealt.repartition(parts, "block").sortWithinPartitions("block", "tail", *order)
    schema = f"id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return together.mapInArrow(pairs, schema).withColumnRenamed("id", doc_id)
