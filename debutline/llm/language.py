"""Language identification with a blended-spectrum string kernel.

A piece of text is the set of its hashed byte n-grams (n = 1 to 4); the kernel of two pieces is the number of n-grams they share
over the geometric mean of their sizes. Nyström: a bounded set of labelled pieces are the landmarks; one-versus-rest kernel ridge
regression is solved over the kernel columns of the landmarks. As the kernel is a product of presence vectors, landmarks and coefficients
fold into one matrix of n-grams by languages, and pieces are scored by batched products of presence rows with it.

Texts are read whole, in pieces of `PIECE` bytes whose scores are averaged by letters, so a long text counts by its amounts.
Learning uses one in so many labelled rows of each language, at most about `TRAIN_ROWS` in all, and `LANDMARKS` landmarks; scoring
reads all rows where they are, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from debutline.llm.shared import cut_lineage, shards, text_bytes

UNDETERMINED = "und"
PIECE = 2048
TRAIN_ROWS = 12_000
LANDMARKS = 384
SAMPLE_TASKS = 8
RIDGE = 1e-3
SHARPNESS = 6.0
# of four languages a guess scores 0.25; texts in one language score 0.9 and more, mixed ones about 0.5
LEAST_SCORE = 0.3
SIZES = (256, 8192, 16384, 16384)
STARTS = np.concatenate([[0], np.cumsum(SIZES)])
WIDTH = int(STARTS[-1])
_PIECES_AT_ONCE = 128

# letters keep their byte, A-Z in lower case; ASCII that is no letter is one class; UTF-8 bytes stay
_CLASS = np.full(256, 0x20, np.uint8)
_CLASS[0x61:0x7B] = np.arange(0x61, 0x7B)
_CLASS[0x41:0x5B] = np.arange(0x61, 0x7B)
_CLASS[0x80:] = np.arange(0x80, 0x100)


def folded(data: np.ndarray) -> np.ndarray:
    """Bytes in lower case as far as Latin-1 letters go; other than letters become spaces."""
    out = _CLASS[data]
    capital = np.zeros(len(out), bool)
    if len(out):
        capital[1:] = (out[:-1] == 0xC3) & (out[1:] >= 0x80) & (out[1:] <= 0x9E) & (out[1:] != 0x97)
    out[capital] += 0x20
    return out


def presence(data: np.ndarray, piece_of: np.ndarray, pieces: int) -> np.ndarray:
    """A row of 0 and 1 per piece; n-grams do not reach over the end of a piece."""
    out = np.zeros(pieces * WIDTH, np.float32)
    base = piece_of.astype(np.int64) * WIDTH
    key = np.zeros(len(data), np.uint32)
    wide = data.astype(np.uint32)
    for n, size in enumerate(SIZES, 1):
        last = len(data) - n + 1
        if last <= 0:
            break
        key = (key[:last] << np.uint32(8)) | wide[n - 1 :]
        mixed = key if n == 1 else (key * np.uint32(2654435761)) >> np.uint32(32 - size.bit_length() + 1)
        whole = piece_of[:last] == piece_of[n - 1 :]
        out[(base[:last] + STARTS[n - 1] + mixed)[whole]] = 1
    out = out.reshape(pieces, WIDTH)
    out[:, 0x20] = 0
    return out


def unit(rows: np.ndarray) -> np.ndarray:
    sizes = np.sqrt(rows.sum(axis=1, keepdims=True))
    return rows / np.maximum(sizes, 1)


def pieces_of(batch: pa.RecordBatch, text: str, piece: int = PIECE) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rows of the batch, letters, unit presence rows) of groups of pieces."""
    data, offsets = text_bytes(batch.column(text))
    sizes = np.diff(offsets)
    counts = -(-sizes // piece)
    owner = np.repeat(np.arange(len(sizes)), counts)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    start = offsets[owner] + number * piece
    stop = np.minimum(start + piece, offsets[owner + 1])
    for at in range(0, len(owner), _PIECES_AT_ONCE):
        end = min(at + _PIECES_AT_ONCE, len(owner))
        # pieces follow one another in the bytes, as texts do
        part = folded(data[start[at] : stop[end - 1]])
        piece_at = np.repeat(np.arange(end - at), stop[at:end] - start[at:end])
        letters = np.bincount(piece_at, part != 0x20, minlength=end - at)
        yield owner[at:end], letters, unit(presence(part, piece_at, end - at))


def _unpacked(bits: np.ndarray) -> np.ndarray:
    return unit(np.unpackbits(bits, axis=1)[:, :WIDTH].astype(np.float32))


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # n-grams x languages
    bias: np.ndarray


def learnable(doc_id: str) -> Column:
    """Rows to learn from: the crc32 of the id as text is not divisible by 5; a null id is held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 != 0, F.lit(False))


def fit(labelled: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", train_rows: int = TRAIN_ROWS, landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """Fit on (doc_id, text, lang) rows. Null texts and languages are left out, as are pieces with few letters.

    Rows are chosen by a hash of the id, one in so many of each language, so that the choice does not depend on the partitions and is
    bounded also where one text has many copies. The chosen rows are written once in the shared folder.
    """
    spark = labelled.sparkSession
    known = labelled.select(F.xxhash64(doc_id).alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang")).where("lang is not null and text is not null")
    counts = sorted((row["lang"], row["n"]) for row in known.groupBy("lang").agg(F.count("*").alias("n")).collect())
    languages = [name for name, _ in counts]
    if not languages:
        return Model([], np.zeros((WIDTH, 0), np.float32), np.zeros(0, np.float32))
    share = max(1, train_rows // len(languages))
    every = F.create_map(*[F.lit(x) for name, n in counts for x in (name, max(1, n // share))])
    chosen = known.where(F.pmod("key", F.element_at(every, F.col("lang"))) == 0)
    # dealt by the id too, as many documents may have one text
    chosen = cut_lineage(chosen.repartition(SAMPLE_TASKS, "key", F.xxhash64("text")).select("text", "lang"), "language-sample")

    def first_pieces(batches):
        for batch in batches:
            names = batch.column("lang").to_pylist()
            marks, packed = [], []
            for shard in shards([batch], "text", 1 << 20):
                for owner, letters, rows in pieces_of(shard, "text"):
                    some = np.flatnonzero(letters > 40)
                    marks += [names[i] for i in owner[some]]
                    packed += [row.tobytes() for row in np.packbits(rows[some] > 0, axis=1)]
                names = names[shard.num_rows :]
            yield pa.RecordBatch.from_arrays([pa.array(marks, pa.string()), pa.array(packed, pa.binary())], names=["lang", "bits"])

    per_language = max(1, landmarks // len(languages))
    # a bounded sample: the rows chosen above
    ranked = chosen.mapInArrow(first_pieces, "lang string, bits binary").withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("bits"), "bits")))
    marks = ranked.where(F.col("rank") <= per_language).orderBy("lang", "rank").select("bits").collect()
    if not marks:
        return Model(languages, np.zeros((WIDTH, len(languages)), np.float32), np.zeros(len(languages), np.float32))
    packed_marks = np.stack([np.frombuffer(row[0], np.uint8) for row in marks])
    stones = _unpacked(packed_marks)
    shared = spark.sparkContext.broadcast(packed_marks)  # `landmarks` rows of bits

    def products(batches):
        stones_t, place = _unpacked(shared.value).T.copy(), {name: i for i, name in enumerate(languages)}
        size = stones_t.shape[1] + 1
        gram, target, seen = np.zeros((size, size)), np.zeros((size, len(languages))), 0
        for batch in batches:
            names = batch.column("lang").to_pylist()
            for shard in shards([batch], "text", 1 << 20):
                for owner, letters, rows in pieces_of(shard, "text"):
                    some = np.flatnonzero(letters > 40)
                    kernel = np.concatenate([rows[some] @ stones_t, np.ones((len(some), 1), np.float32)], 1).astype(np.float64)
                    labels = np.full((len(some), len(languages)), -1.0)
                    labels[np.arange(len(some)), [place[names[i]] for i in owner[some]]] = 1
                    gram += kernel.T @ kernel
                    target += kernel.T @ labels
                    seen += len(some)
                names = names[shard.num_rows :]
        yield pa.RecordBatch.from_arrays([pa.array([gram.tobytes()]), pa.array([target.tobytes()]), pa.array([seen], pa.int64())], names=["gram", "target", "seen"])

    sums = chosen.mapInArrow(products, "gram binary, target binary, seen long").collect()
    size = len(stones) + 1
    gram = sum(np.frombuffer(row["gram"]).reshape(size, size) for row in sums)
    target = sum(np.frombuffer(row["target"]).reshape(size, len(languages)) for row in sums)
    seen = max(1, sum(row["seen"] for row in sums))
    penalty = np.zeros((size, size))
    penalty[:-1, :-1] = stones @ stones.T
    alpha = np.linalg.solve(gram / seen + ridge * penalty + 1e-6 * np.eye(size), target / seen)
    return Model(languages, (stones.T @ alpha[:-1]).astype(np.float32), alpha[-1].astype(np.float32))


def _has_letter(value: str | None) -> bool:
    return bool(value) and any(map(str.isalpha, value))


def with_letters(documents: DataFrame, text: str = "text") -> DataFrame:
    """The rows whose text has a letter, by the rule of `predict`; no model is needed."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([_has_letter(value.as_py()) for value in batch.column(text)], pa.bool_()))

    return documents.mapInArrow(scan, documents.schema)


def determined(lang: str = "_lang", score: str = "_score", least: float = LEAST_SCORE) -> Column:
    """Does one of the learned languages stand out? A score near that of a guess says that none does."""
    return (F.col(lang) != UNDETERMINED) & (F.col(score) >= least)


def predict(documents: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """`documents` with `_lang` and `_score` (0 to 1) added; null texts and texts without a letter are `und` with score 0.

    Ties between languages go to the first by code point. Only the names `_lang` and `_score` may not be in use.
    """
    taken = {"_lang", "_score"} & set(documents.columns)
    if taken:
        raise ValueError(f"column names in use: {sorted(taken)}")
    shared = documents.sparkSession.sparkContext.broadcast(model)
    kinds = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema), "_lang string, _score double"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for shard in shards(batches, text, 1 << 20):
            totals, weight = np.zeros((shard.num_rows, len(model.languages))), np.zeros(shard.num_rows)
            for owner, letters, rows in pieces_of(shard, text):
                np.add.at(totals, owner, (rows @ model.weights + model.bias) * letters[:, None])
                np.add.at(weight, owner, letters)
            plain = [_has_letter(value.as_py()) and len(model.languages) > 0 for value in shard.column(text)]
            if model.languages:
                values = SHARPNESS * totals / np.maximum(weight, 1)[:, None]
                best = values.argmax(axis=1)
                share = np.exp(values - values.max(axis=1, keepdims=True))
                score = (share / share.sum(axis=1, keepdims=True)).max(axis=1)
            else:
                best, score = np.zeros(shard.num_rows, int), np.zeros(shard.num_rows)
            names = [model.languages[b] if ok else UNDETERMINED for b, ok in zip(best, plain)]
            scores = np.where(plain, score, 0.0)
            columns = [*shard.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*shard.schema.names, "_lang", "_score"])

    return documents.mapInArrow(scan, kinds)
