"""Token ids as files: canonical Huffman codes of limited length, in blocks that decode on their own.

A file set is a folder of two parquet tables. `blocks` holds, in ascending order of documents, blocks of whole documents with about
`BLOCK_IDS` ids: ids of the documents, their numbers of token ids, the bits, and the bit offset of every `STRIDE`th id. `head` holds the code length of
each token id, from which both sides build the canonical code, and the number of ids before each part. A reader needs `head` and
any blocks; within a block every checkpoint is a place to start, so all of them are decoded side by side, a table look-up per step.

Texts are tokenised where they are read; what is shuffled, once and by ranges of the document id, is their packed ids.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from debutline.llm.cuts import BREAK, CutStream
from debutline.llm.shared import cut_lineage, scratch_path, shards

END_ID = 1
MOST_BITS = 16
BLOCK_IDS = 1 << 16
STRIDE = 256
CACHED_WORDS = 1_500_000
BATCH_BYTES = 4 << 20
_TOGETHER = 1 << 20


# --- tokenising ---------------------------------------------------------------------------------


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


# the byte-level alphabet: bytes that print stand for themselves, the others for the letters from 256 on
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
_LETTER_OF = {byte: chr(byte) for byte in _PRINTED} | {byte: chr(256 + k) for k, byte in enumerate(sorted(set(range(256)) - set(_PRINTED)))}
_BYTE_LETTERS = [_LETTER_OF[byte] for byte in range(256)]
# words that normalising and splitting leave as they are: the model alone is several times as fast on them
_PLAIN = re.compile("[a-zß-öø-ÿ]+")
# fixed values: how a tokenizer file must treat texts for words to be encoded on their own
_NORMALIZER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_BYTES = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}

# kinds of ASCII characters; all others, and those that special tokens are made of, are OTHER and cut from nothing but white space
OTHER, WHITE, LETTER, SIGN, QUOTE, DIGIT, BETWEEN = range(7)
_KINDS = np.zeros(0x110000, np.uint8)
_KINDS[[9, 10, 11, 12, 13, 32]] = WHITE
_KINDS[[*range(65, 91), *range(97, 123)]] = LETTER
_KINDS[[c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in "'|"]] = SIGN
_KINDS[39] = QUOTE
_CAPITAL = np.zeros(0x110000, bool)
_CAPITAL[65:91] = True
_KINDS[48:58] = DIGIT
_KINDS[ord(BREAK)] = BETWEEN
# is there a cut between kinds? A quote stays with the letters after it, as it may be a contraction
_CUT = np.zeros((7, 7), bool)
_CUT[WHITE, :] = _CUT[:, WHITE] = True
_CUT[WHITE, WHITE] = False
_CUT[LETTER, [SIGN, QUOTE, DIGIT]] = _CUT[SIGN, [LETTER, DIGIT]] = _CUT[DIGIT, [LETTER, SIGN, QUOTE, DIGIT]] = _CUT[QUOTE, DIGIT] = True
_CUT[BETWEEN, :] = _CUT[:, BETWEEN] = True


@lru_cache(maxsize=2)
def _model(path: str):
    return _tokenizer(path).model


@lru_cache(maxsize=2)
def splits_words(path: str) -> bool:
    """Does the tokenizer drop white space, lower-case, and never join a sign or a digit to a letter? Then cuts have ids of their own."""
    with open(path, encoding="utf-8") as file:
        rules = json.load(file)
    split = {"type": "Split", "pattern": {"Regex": _SPLIT}, "behavior": "Removed", "invert": True}
    special = all(re.fullmatch(r"<\|[a-z]+\|>", token["content"]) and not (token["lstrip"] or token["rstrip"] or token["single_word"]) for token in rules["added_tokens"])
    return (
        special
        and rules["normalizer"] == {"type": "Sequence", "normalizers": _NORMALIZER}
        and rules["pre_tokenizer"] == {"type": "Sequence", "pretokenizers": [split, _BYTES]}
        and rules["post_processor"] is None
        and rules["model"]["type"] == "BPE"
    )


class WordIds:
    """Ids of texts.

    Where the tokenizer keeps words apart (`splits_words`), texts are cut at white space and between letters, signs and digits, and each distinct cut is encoded once;
    cuts of ASCII letters are known by their lower-case form, and those of plain letters reach the model directly. Any other tokenizer gets whole texts.
    """

    def __init__(self, path: str, most_words: int = CACHED_WORDS, end_id: int = END_ID):
        self.path, self.end = path, array("I", [end_id]).tobytes()
        self.stream = CutStream(most_words) if splits_words(path) else None

    @staticmethod
    def _edges(points: np.ndarray) -> np.ndarray:
        kinds = _KINDS[points]
        return _CUT[kinds[:-1], kinds[1:]]

    @staticmethod
    def _prepare(points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Lower-case the cuts that hold nothing but ASCII letters; all others with a capital letter keep it."""
        capital = np.flatnonzero(_CAPITAL[points])
        if not len(capital):
            return points
        of = np.searchsorted(starts, capital, side="right") - 1
        others = np.concatenate([[0], np.cumsum(_KINDS[points] != LETTER)])
        out = points.copy()
        out[capital[others[ends[of]] == others[starts[of]]]] += 32
        return out

    @staticmethod
    def _skip(first: np.ndarray) -> np.ndarray:
        return _KINDS[first] == WHITE

    def _learn(self, cuts: list[str]) -> list[bytes]:
        out: list[bytes] = [b""] * len(cuts)
        tokenize, other = _model(self.path).tokenize, []
        for at, cut in enumerate(cuts):
            if cut == BREAK:
                out[at] = self.end
            else:
                low = cut.lower() if cut.isascii() and cut.isalpha() else cut
                if _PLAIN.fullmatch(low):
                    text = low if low.isascii() else "".join([_BYTE_LETTERS[byte] for byte in low.encode()])
                    out[at] = array("I", [token.id for token in tokenize(text)]).tobytes()
                else:
                    other.append(at)
        for at in range(0, len(other), 1 << 14):
            part = other[at : at + (1 << 14)]
            for place, code in zip(part, self._whole([cuts[k] for k in part])):
                out[place] = code
        return out

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [array("I", code.ids).tobytes() for code in _tokenizer(self.path).encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        return [row[:-1] for row in self.closed(texts)]

    def closed(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text with the end id after them."""
        texts = [text or "" for text in texts]
        if self.stream is None:
            return [np.frombuffer(row + self.end, np.uint32) for row in self._whole(texts)]
        ids, breaks = self.stream.encode("".join([text + BREAK for text in texts]), self._edges, self._learn, self._prepare, self._skip)
        edges = [0, *(breaks + 1).tolist()]
        return [ids[a:b] for a, b in zip(edges, edges[1:])]


@lru_cache(maxsize=1)
def _word_ids(path: str, end_id: int) -> WordIds:
    """One for all tasks that a Python worker runs."""
    return WordIds(path, end_id=end_id)


def packed(ids: np.ndarray) -> bytes:
    """Ids by byte planes, compressed; smaller on the way than as they are."""
    ids = ids.astype("<u4")
    width = 1 if not len(ids) else max(1, (int(ids.max()).bit_length() + 7) // 8)
    planes = ids.view(np.uint8).reshape(-1, 4)[:, :width].T.tobytes()
    return bytes([width]) + len(ids).to_bytes(8, "little") + pa.compress(planes, "zstd", asbytes=True)


def unpacked(data: bytes) -> np.ndarray:
    width, size = data[0], int.from_bytes(data[1:9], "little")
    planes = np.frombuffer(pa.decompress(data[9:], width * size, "zstd", asbytes=True), np.uint8).reshape(width, size)
    out = np.zeros((size, 4), np.uint8)
    out[:, :width] = planes.T
    return out.view("<u4").reshape(-1)


def tokenised(documents: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", end_id: int = END_ID) -> DataFrame:
    """(id, ids) with `end_id` after the ids of each text; a null or empty text has the end id alone."""
    kind = documents.schema[doc_id].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _word_ids(path, end_id)
        for part in shards(batches, "text", BATCH_BYTES):
            ids = [packed(row) for row in words.closed(part.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary())], names=["id", "ids"])

    return documents.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).mapInArrow(scan, f"id {kind}, ids binary")


def id_counts(tokens: DataFrame) -> dict[int, int]:
    """How often each id occurs; the vocabulary bounds the result."""

    def scan(batches):
        totals, held, size = np.zeros(0, np.int64), [], 0

        def counted(totals, held):
            more = np.bincount(np.concatenate(held))
            if len(more) > len(totals):
                totals = np.concatenate([totals, np.zeros(len(more) - len(totals), np.int64)])
            totals[: len(more)] += more
            return totals

        for batch in batches:
            for ids in batch.column(0):
                held.append(unpacked(ids.as_py()))
                size += len(held[-1])
                if size >= _TOGETHER:
                    totals, held, size = counted(totals, held), [], 0
        if held:
            totals = counted(totals, held)
        used = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(totals[used], pa.int64())], names=["token", "n"])

    rows = tokens.select("ids").mapInArrow(scan, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).collect()
    return {row["token"]: row["n"] for row in rows}


# --- the code -----------------------------------------------------------------------------------


def code_lengths(counts: dict[int, int], most_bits: int = MOST_BITS) -> np.ndarray:
    """Best code lengths of at most `most_bits` bits, by package-merge; 0 for ids that do not occur.

    The limit rises where there are more ids than codes of that length.
    """
    used = sorted(counts)
    lengths = np.zeros(max(used, default=-1) + 1, np.uint8)
    if len(used) == 1:
        lengths[used[0]] = 1
    if len(used) < 2:
        return lengths
    most_bits = max(most_bits, (len(used) - 1).bit_length())
    weight = np.array([counts[k] for k in used], np.int64)
    order = np.argsort(weight, kind="stable")
    leaves = weight[order]
    size = len(leaves)
    levels, carried = [], np.zeros(0, np.int64)
    for _ in range(most_bits):
        both = np.concatenate([leaves, carried])
        sort = np.argsort(both, kind="stable")
        levels.append(sort < size)  # is the k-th cheapest a leaf?
        merged = both[sort]
        even = len(merged) // 2 * 2
        carried = merged[0:even:2] + merged[1:even:2]
    take, bits = 2 * size - 2, np.zeros(size, np.int64)
    for leaf in reversed(levels):
        chosen = int(leaf[:take].sum())
        bits[:chosen] += 1  # leaves are taken from the lightest up
        take = 2 * (take - chosen)
    lengths[np.array(used)[order]] = bits
    return lengths


def canonical(lengths: np.ndarray) -> np.ndarray:
    """Codes by length, then id."""
    codes, code, before = np.zeros(len(lengths), np.uint64), 0, 0
    for k in np.lexsort((np.arange(len(lengths)), lengths)).tolist():
        bits = int(lengths[k])
        if bits:
            code = (code << (bits - before)) if before else 0
            codes[k] = code
            code, before = code + 1, bits
    return codes


def encode(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray, stride: int = STRIDE) -> tuple[bytes, bytes]:
    """The bits of `ids`, first bit highest, and the bit offsets of every `stride`th id."""
    bits = lengths[ids].astype(np.int64)
    ends = np.cumsum(bits)
    at = ends - bits
    value = codes[ids]
    word, room = at >> 6, 64 - (at & 63) - bits
    over = room < 0
    high = np.where(over, value >> np.where(over, -room, 0).astype(np.uint64), value << np.where(over, 0, room).astype(np.uint64))
    total = np.zeros(int(ends[-1] + 63) // 64 + 1 if len(ids) else 1, np.uint64)
    if len(ids):
        starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        total[word[starts]] = np.add.reduceat(high, starts)
        total[word[over] + 1] += value[over] << (64 + room[over]).astype(np.uint64)
    size = (int(ends[-1]) + 7) // 8 if len(ids) else 0
    return total.astype(">u8").tobytes()[:size], at[::stride].astype("<i8").tobytes()


class Decoder:
    """The look-up table of a canonical code: the next bits of a stream give an id and the bits it takes."""

    def __init__(self, lengths: np.ndarray):
        self.bits = int(lengths.max(initial=0))
        codes = canonical(lengths)
        self.ids = np.zeros(1 << self.bits, np.uint32)
        self.taken = np.zeros(1 << self.bits, np.int64)
        for k in np.flatnonzero(lengths).tolist():
            free = self.bits - int(lengths[k])
            first = int(codes[k]) << free
            self.ids[first : first + (1 << free)] = k
            self.taken[first : first + (1 << free)] = lengths[k]

    def decode(self, blocks: list[tuple[int, bytes, bytes]], stride: int = STRIDE) -> list[np.ndarray]:
        """Ids of blocks given as (number of ids, bits, checkpoints); all checkpoints are followed side by side."""
        starts, left, bases, where = [], [], [], 0
        for size, data, checkpoints in blocks:
            offsets = np.frombuffer(checkpoints, "<i8")
            starts.append(offsets + 8 * where)
            left.append(np.minimum(stride, size - stride * np.arange(len(offsets))))
            bases.append(len(offsets))
            where += len(data)
        data = np.frombuffer(b"".join([b[1] for b in blocks]) + bytes(8), np.uint8).astype(np.uint64)
        size = len(data) - 4
        window = (data[:size] << np.uint64(32)) | (data[1 : size + 1] << np.uint64(24)) | (data[2 : size + 2] << np.uint64(16)) | (data[3 : size + 3] << np.uint64(8)) | data[4 : size + 4]
        at = np.concatenate(starts) if starts else np.zeros(0, np.int64)
        left = np.concatenate(left) if left else at
        out = np.zeros((len(at), stride), np.uint32)
        # lanes that hold more ids first, so that those at work are always the first ones
        order = np.argsort(-left, kind="stable")
        at, sorted_left = at[order], left[order]
        mask = np.uint64((1 << self.bits) - 1)
        for step in range(int(left.max(initial=0))):
            live = int(np.searchsorted(-sorted_left, -step, side="left"))
            here = at[:live]
            shift = (40 - self.bits - (here & 7)).astype(np.uint64)
            look = (window[here >> 3] >> shift) & mask
            out[order[:live], step] = self.ids[look]
            at[:live] = here + self.taken[look]
        result, lane = [], 0
        for (size, _, _), count in zip(blocks, bases):
            result.append(out[lane : lane + count].reshape(-1)[:size])
            lane += count
        return result


# --- files --------------------------------------------------------------------------------------


def _block_schema(id_type: pa.DataType) -> pa.Schema:
    long, bits = pa.int64(), pa.binary()
    kinds = {"part": pa.int32(), "block": long, "first": long, "n": long, "ids": pa.list_(id_type), "sizes": pa.list_(long), "bits": bits, "checkpoints": bits}
    return pa.schema(list(kinds.items()))


def write(tokens: DataFrame, folder: str, most_bits: int = MOST_BITS, block_ids: int = BLOCK_IDS, stride: int = STRIDE) -> None:
    """Write (id, ids) as `blocks` and `head` below `folder`, in ascending id order, null ids last; equal ids by their token ids.

    The parts are ranges of the ids. A task that is repeated writes the same part again under Spark's commit protocol.
    """
    spark = tokens.sparkSession
    lengths = code_lengths(id_counts(tokens), most_bits)
    codes = canonical(lengths)
    shared = spark.sparkContext.broadcast((codes, lengths))  # bounded by the vocabulary
    kind = tokens.schema["id"].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, lengths = shared.value
        part, held, names, size, first, number, schema = TaskContext.get().partitionId(), [], [], 0, 0, 0, None

        def block():
            bits, checkpoints = encode(np.concatenate(held), codes, lengths, stride)
            row = [part, number, first, size, names, [len(h) for h in held], bits, checkpoints]
            return pa.RecordBatch.from_arrays([pa.array([value], field.type) for value, field in zip(row, schema)], schema=schema)

        for batch in batches:
            schema = _block_schema(batch.column(0).type)
            for name, ids in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = unpacked(ids.as_py())
                held.append(ids)
                names.append(name)
                size += len(ids)
                if size >= block_ids:
                    yield block()
                    first, number, held, names, size = first + size, number + 1, [], [], 0
        if held:
            yield block()

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    by = [F.col("id").asc_nulls_last(), F.xxhash64("ids"), F.col("ids")]
    ordered = tokens.repartitionByRange(parts, by[0]).sortWithinPartitions(*by)
    schema = f"part int, block long, first long, n long, ids array<{kind}>, sizes array<long>, bits binary, checkpoints binary"
    ordered.mapInArrow(scan, schema).write.option("parquet.block.size", 16 << 20).parquet(f"{folder}/blocks")
    totals = sorted((row["part"], row["n"]) for row in spark.read.parquet(f"{folder}/blocks").groupBy("part").agg(F.sum("n").alias("n")).collect())
    rows, before = [], 0
    for part, n in totals:
        rows.append((part, before, None, None))
        before += n
    rows.append((None, before, bytearray(lengths.tobytes()), stride))
    spark.createDataFrame(rows, "part int, before long, lengths binary, stride int").coalesce(1).write.parquet(f"{folder}/head")


def read(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, Decoder, int]:
    """(blocks, ids before each part, decoder, stride) of a folder that `write` made."""
    head = spark.read.parquet(f"{folder}/head")
    row = head.where("lengths is not null").first()
    return spark.read.parquet(f"{folder}/blocks"), head.where("lengths is null").select("part", "before"), Decoder(np.frombuffer(bytes(row["lengths"]), np.uint8)), row["stride"]


def read_back(spark: SparkSession, folder: str, keep_ids: bool = False) -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of every document, decoded from the files; with `keep_ids` also its `ids`."""
    blocks, before, decoder, stride = read(spark, folder)
    kind = blocks.schema["ids"].dataType.elementType.simpleString()
    shared = spark.sparkContext.broadcast(decoder)

    def documents_of(rows: list[dict], id_type) -> pa.RecordBatch:
        found = shared.value.decode([(r["n"], r["bits"], r["checkpoints"]) for r in rows], stride)
        part, name, start, size, crc, ids = [], [], [], [], [], []
        for row, all_ids in zip(rows, found):
            cuts = np.concatenate([[0], np.cumsum(row["sizes"])]).astype(np.int64)
            flat = all_ids.astype("<u4")
            for k, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())):
                part.append(row["part"])
                name.append(row["ids"][k])
                start.append(row["first"] + a)
                size.append(b - a)
                crc.append(zlib.crc32(flat[a:b].tobytes()))
                if keep_ids:
                    ids.append(flat[a:b].astype(np.int64))
        arrays = [pa.array(part, pa.int32()), pa.array(name, id_type), pa.array(start, pa.int64()), pa.array(size, pa.int64()), pa.array(crc, pa.int64())]
        return pa.RecordBatch.from_arrays(arrays + ([pa.array(ids, pa.list_(pa.int64()))] if keep_ids else []), names=["part", "id", "first", "n_tokens", "ids_crc32", *(["ids"] if keep_ids else [])])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            id_type, rows, size = batch.column("ids").type.value_type, [], 0
            for k in range(batch.num_rows):
                rows.append(batch.slice(k, 1).to_pylist()[0])
                size += rows[-1]["n"]
                if size >= _TOGETHER:
                    yield documents_of(rows, id_type)
                    rows, size = [], 0
            if rows:
                yield documents_of(rows, id_type)

    schema = f"part int, id {kind}, first long, n_tokens long, ids_crc32 long" + (", ids array<long>" if keep_ids else "")
    out = blocks.mapInArrow(scan, schema).join(F.broadcast(before), "part")  # a row per part
    return out.select("id", (F.col("before") + F.col("first")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if keep_ids else []))


def token_table(documents: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", folder: str | None = None, **options) -> DataFrame:
    """Tokenise, write below `folder` (a fresh one in the shared folder if not named), and read back: a row per row of `documents`.

    Null and empty texts hold the end id alone. An empty table gives no rows.
    """
    spark = documents.sparkSession
    folder = folder or scratch_path(spark, "tokens")
    write(cut_lineage(tokenised(documents, path, doc_id, text), "tokenised"), folder, **options)
    return read_back(spark, folder).withColumnRenamed("id", doc_id)
