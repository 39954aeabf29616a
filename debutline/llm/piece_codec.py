"""SentencePiece encoding and decoding for merge-type vocabularies, row by row as the library does.

A text is a row of symbols, one a character at first. An agenda holds every pair of neighbours whose joint spelling is a piece,
best score first and leftmost first among equals; the head of the agenda is merged and its new neighbours are put on the agenda,
until it is empty. What is no piece then falls back to its bytes, or to the unknown piece.

No merge reaches across two characters that stand side by side in no piece of the vocabulary, so a text is cut there, and the agenda runs
once for each distinct cut of a worker's texts. Every cut is also encoded by the library itself, many at a time for each Arrow batch, and a difference ends
the job. Nothing is shuffled.
"""

from __future__ import annotations

import hashlib
import re
import struct
from array import array
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from debutline.llm.cuts import BREAK, MOST_CUTS, CutStream
from debutline.llm.shared import shards

SPACE = "▁"
REPLACEMENT = "�"
# fixed values of the model file: kinds of pieces, the merge-type model, names of byte pieces
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
MERGES = 2
BYTE_NAME = re.compile("<0x([0-9A-F]{2})>")
# a control piece inside a text ends a run of byte pieces; this byte is in no UTF-8 text
NOTHING = b"\xff"
BATCH_BYTES = 4 << 20


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a protocol buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = number()
        kind = key & 7
        if kind == 0:
            yield key >> 3, number()
            continue
        size = number() if kind == 2 else {1: 8, 5: 4}[kind]
        yield key >> 3, data[at : at + size]
        at += size


class Vocabulary:
    """Pieces, scores and rules of a model file; files whose rules are not kept here are refused by name."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            parts = list(_fields(file.read()))
        trainer = dict(_fields(next(value for key, value in parts if key == 2)))
        rules = dict(_fields(next(value for key, value in parts if key == 3)))
        if trainer.get(3, 1) != MERGES:
            raise ValueError(f"{path} is no merge-type vocabulary")
        if rules.get(2) or rules.get(4, 1) or not rules.get(5, 1) or trainer.get(24):
            raise ValueError(f"{path} changes texts before it splits them, which this codec does not do")
        self.dummy_prefix = bool(rules.get(3, 1))
        self.pieces, self.scores, self.kinds = [], [], []
        for key, value in parts:
            if key == 1:
                piece = dict(_fields(value))
                self.pieces.append(piece[1].decode())
                self.scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
                self.kinds.append(piece.get(3, NORMAL))
        if set(self.kinds) - {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError(f"{path} has pieces of the user or unused ones, which this codec does not know")
        self.ids = {piece: k for k, (piece, kind) in enumerate(zip(self.pieces, self.kinds)) if kind == NORMAL}
        self.rank = {piece: -self.scores[k] for piece, k in self.ids.items()}
        self.unknown = self.kinds.index(UNKNOWN)
        self.bytes = [0] * 256
        for k, (piece, kind) in enumerate(zip(self.pieces, self.kinds)):
            if kind == BYTE:
                self.bytes[int(BYTE_NAME.fullmatch(piece).group(1), 16)] = k
        self.byte_fallback = BYTE in self.kinds
        self.begin, self.end = trainer.get(41, 1), trainer.get(42, 2)
        self.joined = {piece[k : k + 2] for piece in self.ids for k in range(len(piece) - 1)}
        self.classes = {c: k + 1 for k, c in enumerate(sorted({c for pair in self.joined for c in pair}))}
        self.class_of = np.zeros(0x110000, np.uint16 if len(self.classes) < 65535 else np.uint32)
        for c, k in self.classes.items():
            self.class_of[ord(c)] = k
        self.joins = np.zeros((len(self.classes) + 1, len(self.classes) + 1), bool)
        for one, other in self.joined:
            self.joins[self.classes[one], self.classes[other]] = True
        surface = trainer.get(44, b" \xe2\x81\x87 ")
        self.spelled = []
        for piece, kind in zip(self.pieces, self.kinds):
            if kind == BYTE:
                self.spelled.append(bytes([int(BYTE_NAME.fullmatch(piece).group(1), 16)]))
            else:
                self.spelled.append({NORMAL: piece.replace(SPACE, " ").encode(), CONTROL: NOTHING, UNKNOWN: surface}[kind])


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


@lru_cache(maxsize=2)
def library(path: str):
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=path)


def merged(text: str, rank: dict[str, float]) -> list[str]:
    """The symbols of `text` after all merges of the agenda."""
    symbols: list[str] = list(text)
    last = len(symbols) - 1
    if last < 1:
        return symbols
    agenda = []
    for left in range(last):
        cost = rank.get(symbols[left] + symbols[left + 1])
        if cost is not None:
            agenda.append((cost, left, left + 1, 2))
    if not agenda:
        return symbols
    heapify(agenda)
    before, after = list(range(-1, last)), list(range(1, last + 2))
    while agenda:
        _, left, right, size = heappop(agenda)
        one, other = symbols[left], symbols[right]
        # a pair is stale if one of its sides was merged since
        if not one or not other or len(one) + len(other) != size:
            continue
        symbols[left], symbols[right] = one + other, ""
        follower = after[left] = after[right]
        if follower <= last:
            before[follower] = left
            both = symbols[left] + symbols[follower]
            cost = rank.get(both)
            if cost is not None:
                heappush(agenda, (cost, left, follower, len(both)))
        leader = before[left]
        if leader >= 0:
            both = symbols[leader] + symbols[left]
            cost = rank.get(both)
            if cost is not None:
                heappush(agenda, (cost, leader, left, len(both)))
    return [symbol for symbol in symbols if symbol]


class PieceCodec:
    """Encoder and decoder of one vocabulary, with the cuts that a worker has met so far; about `most` cuts are remembered."""

    def __init__(self, path: str, most: int = MOST_CUTS):
        self.path, self.vocabulary = path, vocabulary(path)
        self.stream = CutStream(most)
        known = self.vocabulary
        # a character that no piece joins to another one: in front of a cut it keeps the library's own prefix away
        self.guard = next(c for c in map(chr, [*range(1, 32), *range(0xE000, 0xF8FF)]) if c not in known.classes)
        self.guarded = library(path).encode(self.guard)
        self.between = np.array([known.end, known.begin], "<u4").tobytes()

    def _ids_of(self, cut: str) -> bytes:
        if cut == BREAK:
            return self.between
        known, ids = self.vocabulary, array("I")
        for symbol in merged(cut, known.rank):
            at = known.ids.get(symbol)
            if at is not None:
                ids.append(at)
            elif known.byte_fallback:
                ids.extend([known.bytes[byte] for byte in symbol.encode()])
            else:
                ids.append(known.unknown)
        return ids.tobytes()

    def _check(self, cuts: list[str], ids: list[bytes]) -> None:
        """The same cuts by the library, many at a time."""
        skip, pairs = len(self.guarded), [(cut, own) for cut, own in zip(cuts, ids) if cut != BREAK]
        for at in range(0, len(pairs), 1 << 14):
            part = pairs[at : at + (1 << 14)]
            for (cut, own), found in zip(part, library(self.path).encode([self.guard + cut for cut, _ in part], num_threads=1)):
                if own != array("I", found[skip:]).tobytes():
                    raise ValueError(f"the agenda and the library differ on {cut[:200]!r}")

    def _edges(self, points: np.ndarray) -> np.ndarray:
        kinds = self.vocabulary.class_of[points]
        return ~self.vocabulary.joins[kinds[:-1], kinds[1:]]

    def _learn(self, cuts: list[str]) -> list[bytes]:
        ids = [self._ids_of(cut) for cut in cuts]
        self._check(cuts, ids)
        return ids

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers, between the begin and the end id."""
        if not texts:
            return []
        known = self.vocabulary
        prefix = SPACE if known.dummy_prefix else ""
        text = BREAK.join([prefix + text if text else "" for text in texts]).replace(" ", SPACE)
        ids, breaks = self.stream.encode(text, self._edges, self._learn)
        data = np.concatenate([[known.begin], ids, [known.end]]).astype("<u4").tobytes()
        edges = [0, *((breaks + 2) * 4).tolist(), len(data)]
        rows = [data[a:b] for a, b in zip(edges, edges[1:])]
        return rows if known.byte_fallback else [self._one_unknown(row) for row in rows]

    def _one_unknown(self, row: bytes) -> bytes:
        """Neighbouring unknown symbols are one unknown piece, as in the library."""
        ids = np.frombuffer(row, "<u4")
        unknown = ids == self.vocabulary.unknown
        return ids[~(unknown & np.concatenate([[False], unknown[:-1]]))].tobytes()

    def decode(self, rows: list[bytes]) -> list[bytes]:
        """The texts of rows of ids in UTF-8: spellings side by side, without the space that encoding put first."""
        known, out = self.vocabulary, []
        spelled = known.spelled.__getitem__
        for row in rows:
            ids = array("I", row).tolist()
            while ids and known.kinds[ids[0]] == CONTROL:
                ids.pop(0)
            while ids and known.kinds[ids[-1]] == CONTROL:
                ids.pop()
            text = b"".join(map(spelled, ids))
            try:
                text.decode()
            except UnicodeDecodeError:
                text = self._mended(ids)
            if known.dummy_prefix and text[:1] == b" " and known.kinds[ids[0]] == NORMAL:
                text = text[1:]
            out.append(text)
        return out

    def _mended(self, ids: list[int]) -> bytes:
        """Each byte that belongs to no character becomes a replacement character; runs of byte pieces are read on their own."""
        known, out, run = self.vocabulary, [], b""
        for k in [*ids, None]:
            if k is not None and known.kinds[k] == BYTE:
                run += known.spelled[k]
                continue
            out.append(_each_bad_byte(run))
            run = b""
            if k is not None and known.kinds[k] != CONTROL:
                out.append(known.spelled[k])
        return b"".join(out)


def _each_bad_byte(run: bytes) -> bytes:
    out = ""
    while run:
        try:
            return (out + run.decode()).encode()
        except UnicodeDecodeError as error:
            out += run[: error.start].decode() + REPLACEMENT
            run = run[error.start + 1 :]
    return out.encode()


@lru_cache(maxsize=1)
def _codec(path: str) -> PieceCodec:
    """One for all tasks that a Python worker runs."""
    return PieceCodec(path)


def round_trip(documents: DataFrame, path: str, text: str = "text", keep: bool = False) -> DataFrame:
    """`documents` without `text`, with `_n_tokens` (all ids), `_ids_sha256` and `_decoded_sha256`; with `keep` also `_ids` (binary, little-endian unsigned
    32-bit) and `_decoded`.

    A null text is an empty one and has the begin and the end id. A very long text is one row of a batch of its own, whole. Repeated rows
    and rows without an id stay rows; an empty table has no rows. Columns of any other name are carried along; those of these five names are refused.
    """
    added = {"_n_tokens": "long", "_ids_sha256": "string", "_decoded_sha256": "string"} | ({"_ids": "binary", "_decoded": "string"} if keep else {})
    clash = set(added) & set(documents.columns)
    if clash:
        raise ValueError(f"columns {sorted(clash)} are given already")
    others = [name for name in documents.columns if name != text]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(path)
        for batch in shards(batches, "_text_of_row", BATCH_BYTES):
            rows = codec.encode(batch.column(len(others)).to_pylist())
            decoded = codec.decode(rows)
            found = [
                pa.array([len(row) // 4 for row in rows], pa.int64()),
                pa.array([hashlib.sha256(row).hexdigest() for row in rows], pa.string()),
                pa.array([hashlib.sha256(row).hexdigest() for row in decoded], pa.string()),
            ]
            if keep:
                found += [pa.array(rows, pa.binary()), pa.array([row.decode() for row in decoded], pa.string())]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(others)], *found], names=[*others, *added])

    given = documents.select(*[F.col(f"`{name}`") for name in others], F.col(f"`{text}`").alias("_text_of_row"))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in given.schema[:-1]), *(f"{name} {kind}" for name, kind in added.items())])
    return given.mapInArrow(scan, schema)
