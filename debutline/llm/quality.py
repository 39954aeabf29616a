"""Quality classifier: logistic regression on hashed word n-grams, trained by follow-the-regularised-leader updates.

A text is a bag of hashed words, word pairs, and runs of one to three word shapes (case, length, punctuation, sameness with the
word before); the value of an n-gram is its share of the text's n-grams. Scoring is a sparse dot product per text, where the
text is. Learning uses a bounded sample of labelled rows: one in so many by a hash of the id, about `TRAIN_ROWS` at most.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from debutline.llm.shared import shards, text_bytes

BITS = 18
TRAIN_ROWS = 4_000
EPOCHS = 4
ALPHA, BETA, L1, L2 = 0.5, 1.0, 1e-3, 1e-3
SCALE = 30.0
GOOD = 0.7

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_UPPER, _LOWER, _DIGIT, _OTHER = (np.zeros(256, bool) for _ in range(4))
_UPPER[0x41:0x5B] = True
_LOWER[0x61:0x7B] = True
_DIGIT[0x30:0x3A] = True
_OTHER[0x21:0x7F] = True
_OTHER[0x41:0x5B] = _OTHER[0x61:0x7B] = _OTHER[0x30:0x3A] = False
_VALUE = np.random.default_rng(8).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))


def _mix(values: np.ndarray, salt: int) -> np.ndarray:
    values = (values ^ np.uint64(salt)) * np.uint64(0xBF58476D1CE4E5B9)
    return ((values ^ (values >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)) >> np.uint64(64 - BITS)


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of every n-gram of the texts; n-grams do not reach over the end of a text."""
    size = len(data)
    if not size:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    word = ~_SPACE[data]
    cut = np.zeros(size + 1, bool)
    cut[offsets] = True
    starts = np.flatnonzero(word & np.concatenate([[True], ~word[:-1] | cut[1:-1]]))
    ends = np.flatnonzero(word & np.concatenate([~word[1:] | cut[1:-1], [True]])) + 1
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    steps, backs = np.full(size, _STEP), np.full(size, _BACK)
    steps[0] = backs[0] = 1
    sums = np.zeros(size + 1, np.uint64)
    np.cumsum(_VALUE[data] * np.multiply.accumulate(steps), out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * np.multiply.accumulate(backs)[starts]
    text_of = np.searchsorted(offsets, starts, side="right") - 1

    def count(table):
        total = np.concatenate([[0], np.cumsum(table[data])])
        return total[ends] - total[starts]

    upper, lower, digit, other, length = count(_UPPER), count(_LOWER), count(_DIGIT), count(_OTHER), ends - starts
    joined = text_of[1:] == text_of[:-1]
    same = np.concatenate([[False], joined & (hashes[1:] == hashes[:-1])])
    last = data[ends - 1]
    shape = np.minimum(upper, 2) + 3 * (lower > 0) + 6 * np.minimum(digit, 2) + 18 * np.minimum(other, 4) + 90 * np.minimum(length // 4, 4) + 450 * same
    shape = (shape.astype(np.uint64) << np.uint64(8)) | np.where(_OTHER[last], last, 0).astype(np.uint64)
    places, buckets = [text_of, text_of], [_mix(hashes, 1), _mix(shape, 2)]
    if len(hashes) > 1:
        pair = hashes[:-1] * np.uint64(3) + hashes[1:] * _STEP
        shapes = shape[:-1] * np.uint64(5) + shape[1:] * _STEP
        places += [text_of[1:][joined], text_of[1:][joined]]
        buckets += [_mix(pair, 3)[joined], _mix(shapes, 4)[joined]]
    if len(hashes) > 2:
        run = joined[1:] & joined[:-1]
        places.append(text_of[2:][run])
        buckets.append(_mix((shape[:-2] * np.uint64(5) + shape[1:-1]) * _STEP + shape[2:] * np.uint64(7), 5)[run])
    return np.concatenate(places), np.concatenate(buckets).astype(np.int64)


def learnable(doc_id: str) -> Column:
    """Rows to learn from: the crc32 of the id as text leaves other than 2 by 4; a null id is held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 != 2, F.lit(False))


def _ftrl(rows: list[tuple[int, np.ndarray, np.ndarray]], epochs: int) -> np.ndarray:
    """Weights, with the bias last."""
    z, n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)

    def weights(at):
        part = z[at]
        return np.where(np.abs(part) <= L1, 0.0, (np.sign(part) * L1 - part) / ((BETA + np.sqrt(n[at])) / ALPHA + L2))

    order = np.random.default_rng(4)
    for _ in range(epochs):
        for k in order.permutation(len(rows)):
            label, at, value = rows[k]
            w = weights(at)
            error = 1 / (1 + np.exp(-np.clip(w @ value, -30, 30))) - label
            g = error * value
            square = g * g
            z[at] += g - (np.sqrt(n[at] + square) - np.sqrt(n[at])) / ALPHA * w
            n[at] += square
    return weights(np.arange(len(z))).astype(np.float32)


def fit(labelled: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", epochs: int = EPOCHS) -> np.ndarray:
    """Weights from a bounded table of (doc_id, text, label 0/1), as `labelled_rows` gives; null labels are left out.

    The n-grams are counted where the texts are; the sparse rows come to the driver, which makes the updates in the order of hashed
    ids. Without any row all scores are 0.5.
    """
    chosen = labelled.where(F.col(label).isNotNull())

    def scan(batches):
        for batch in batches:
            ids, labels = batch.column("id").to_pylist(), batch.column("label").to_pylist()
            for shard in shards([batch], "text", 1 << 20):
                place, bucket = features(*text_bytes(shard.column("text")))
                total = np.bincount(place, minlength=shard.num_rows)
                keys, counts = np.unique(place * (1 << BITS) + bucket, return_counts=True)
                owner = keys >> BITS
                cuts = np.searchsorted(owner, np.arange(shard.num_rows + 1))
                at = (keys & ((1 << BITS) - 1)).astype(np.int32)
                value = (counts / np.maximum(total[owner], 1) * SCALE).astype(np.float32)
                rows = [(at[a:b].tobytes(), value[a:b].tobytes()) for a, b in zip(cuts[:-1], cuts[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[: shard.num_rows], pa.int64()), pa.array(labels[: shard.num_rows], pa.int32()), pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.binary())],
                    names=["id", "label", "at", "value"],
                )
                ids, labels = ids[shard.num_rows :], labels[shard.num_rows :]

    sample = chosen.select(F.xxhash64(doc_id).alias("id"), F.col(text).alias("text"), (F.col(label) > 0).cast("int").alias("label"))
    found = sample.mapInArrow(scan, "id long, label int, at binary, value binary").toLocalIterator()
    held = sorted(((row["id"], row["label"], bytes(row["at"]), bytes(row["value"])) for row in found), key=lambda row: row[:3])
    bias = 1 << BITS
    rows = [(label, np.append(np.frombuffer(at, np.int32), bias), np.append(np.frombuffer(value, np.float32), 1.0)) for _, label, at, value in held]
    return _ftrl(rows, epochs)


def score(documents: DataFrame, weights: np.ndarray, text: str = "text") -> DataFrame:
    """`documents` with `_score`, the likelihood of label 1; null and empty texts get the bias alone. `_score` may not be in use."""
    if "_score" in documents.columns:
        raise ValueError("column name in use: _score")
    shared = documents.sparkSession.sparkContext.broadcast(weights)
    kinds = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema), "_score double"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = shared.value
        for shard in shards(batches, text, 1 << 20):
            place, bucket = features(*text_bytes(shard.column(text)))
            total = np.bincount(place, minlength=shard.num_rows)
            dot = np.bincount(place, weights[bucket], minlength=shard.num_rows) * SCALE / np.maximum(total, 1) + weights[-1]
            yield pa.RecordBatch.from_arrays([*shard.columns, pa.array(1 / (1 + np.exp(-dot)), pa.float64())], names=[*shard.schema.names, "_score"])

    return documents.mapInArrow(scan, kinds)


def labelled_rows(documents: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", train_rows: int = TRAIN_ROWS) -> DataFrame:
    """A bounded choice of (doc_id, text, label) to learn from; of several labels of a document the greater share counts, 1 on a tie.

    The labels are thinned before the join, so that what meets the documents is bounded, and small enough to broadcast.
    """
    known = labels.where(learnable(doc_id) & F.col(label).isNotNull()).groupBy(doc_id).agg((F.avg(label) >= 0.5).cast("int").alias(label))
    every = max(1, -(-known.count() // train_rows))
    chosen = known.where(F.pmod(F.xxhash64(doc_id), F.lit(every)) == 0)
    return documents.select(doc_id, text).join(F.broadcast(chosen), doc_id)
