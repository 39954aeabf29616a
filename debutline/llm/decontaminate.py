"""Benchmark decontamination by suffix arrays over shards of the training text.

Each shard (some megabytes of whole documents, cut where the scan delivers them) becomes an array of word codes, whose
suffixes are sorted by prefix doubling. Every suffix of every benchmark item is then looked up by binary search: the range
of equal 13-word prefixes gives all places of the window. Documents never move: one row per document leaves the task that read
it, so neither copies nor a passage shared by a third of all documents gather in one place.

The benchmark is the stated query set. It reaches the tasks in blocks of at most `block_words` words and 65,000 distinct words,
so what is broadcast does not grow with it; with more than one block each block's finds are written in the shared folder and
merged per document.

Suffixes that begin with a word of no benchmark item would all sort below the first test suffix; they are left out of the array.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from debutline.llm.shared import scratch_path, shards, text_bytes

WINDOW = 13
SHARD_BYTES = 4 << 20
BLOCK_WORDS = 400_000
BLOCK_VOCABULARY = 65_000

_LOWER = np.zeros(256, np.uint8)
_LOWER[0x30:0x3A] = np.arange(0x30, 0x3A)
_LOWER[0x61:0x7B] = np.arange(0x61, 0x7B)
_LOWER[0x41:0x5B] = np.arange(0x61, 0x7B)
_LOWER[0x80:] = np.arange(0x80, 0x100)
_BYTE_VALUE = np.random.default_rng(13).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = 0x9E3779B97F4A7C15 | 5
_POWERS: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _powers(length: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS["up"]) < length:
        for name, step in (("up", _STEP), ("down", pow(_STEP, -1, 2**64))):
            steps = np.full(length, step, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"][:length], _POWERS["down"][:length]


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word of the texts in `data`, in order, and the number of the text that each is in."""
    size = len(data)
    if not size:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    low = _LOWER[data]
    inside = low != 0
    cut = np.zeros(size + 1, bool)
    cut[offsets] = True
    before = np.empty(size, bool)
    before[0], before[1:] = False, inside[:-1]
    after = np.empty(size, bool)
    after[-1], after[:-1] = False, inside[1:]
    starts = np.flatnonzero(inside & (~before | cut[:-1]))
    ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
    up, down = _powers(size)
    sums = np.zeros(size + 1, np.uint64)
    np.cumsum(_BYTE_VALUE[low] * up, out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64)
    return hashes, np.searchsorted(offsets, starts, side="right") - 1


def packed(codes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Four codes from each place on as one number."""
    key = codes[at].astype(np.uint64)
    for step in (1, 2, 3):
        key = (key << np.uint64(16)) | codes[at + step]
    return key


def suffix_array(codes: np.ndarray, depth: int) -> np.ndarray:
    """Places of `codes` other than 0 in the order of the codes from there on, as far as `depth` codes tell.

    0 ends every document and stands for words of no item: what follows it is not compared. `codes` ends with at least four zeros.
    """
    at = np.flatnonzero(codes).astype(np.int64)
    keys = packed(codes, at)
    order = np.argsort(keys)
    at, keys = at[order], keys[order]
    slots = np.arange(len(at))
    fresh = np.ones(len(at), bool)
    fresh[1:] = keys[1:] != keys[:-1]
    rank = np.zeros(len(codes) + depth + 4, np.int64)
    heads = np.maximum.accumulate(np.where(fresh, slots, 0))
    rank[at] = heads + 1
    reach = 4
    # keys that hold a 0 are as far told apart as any search can ask
    members = slots[(np.bincount(heads, minlength=len(at))[heads] > 1) & (codes[at + 3] != 0)] if len(at) else slots
    while len(members) and reach < depth:
        places = at[members]
        further = rank[places + reach]
        order = np.lexsort((further, rank[places]))
        places, further = places[order], further[order]
        # members of one group keep the slots of that group, whose rank is the first slot + 1
        same = rank[places]
        at_slots = np.sort(members)
        at[at_slots] = places
        fresh = np.ones(len(places), bool)
        fresh[1:] = (same[1:] != same[:-1]) | (further[1:] != further[:-1])
        heads = at_slots[np.maximum.accumulate(np.where(fresh, np.arange(len(places)), 0))]
        rank[places] = heads + 1
        group = np.cumsum(fresh) - 1
        members = at_slots[(np.bincount(group)[group] > 1) & (further != 0)]
        reach *= 2
    return at


def _bounds(codes, array, lo, hi, step, key, mask, upper):
    """First place in array[lo:hi] whose four codes after `step` are at least (or, with `upper`, above) `key` under `mask`."""
    lo, hi = lo.copy(), hi.copy()
    while True:
        open_ = np.flatnonzero(lo < hi)
        if not len(open_):
            return lo
        mid = (lo[open_] + hi[open_]) >> 1
        seen = packed(codes, array[mid] + step[open_]) & mask[open_]
        right = seen <= key[open_] if upper else seen < key[open_]
        lo[open_[right]] = mid[right] + 1
        hi[open_[~right]] = mid[~right]


_MASKS = np.array([0, 0xFFFF << 48, 0xFFFFFFFF << 32, 0xFFFFFFFFFFFF << 16, 0xFFFFFFFFFFFFFFFF], np.uint64)


def find(codes: np.ndarray, array: np.ndarray, test: np.ndarray, at: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranges of `array` whose suffixes begin with test[at : at + length], by binary search, four codes at a time."""
    lo = np.zeros(len(at), np.int64)
    hi = np.full(len(at), len(array), np.int64)
    for step in range(0, int(lengths.max(initial=0)), 4):
        rows = np.flatnonzero((lengths > step) & (lo < hi))
        if not len(rows):
            break
        mask = _MASKS[np.minimum(lengths[rows] - step, 4)]
        key = packed(test, at[rows] + step) & mask
        steps = np.full(len(rows), step, np.int64)
        first = _bounds(codes, array, lo[rows], hi[rows], steps, key, mask, False)
        hi[rows] = _bounds(codes, array, first, hi[rows], steps, key, mask, True)
        lo[rows] = first
    return lo, hi


@dataclass
class Block:
    """Some benchmark items: their words as codes (0 after each item), windows, and the items that hold each window."""

    vocabulary: np.ndarray  # hashes, ascending; the code of a word is its place + 1
    codes: np.ndarray
    starts: np.ndarray  # a place for each distinct window
    lengths: np.ndarray
    holders: list[list[str | None]]  # item ids of each distinct window
    suffixes: np.ndarray
    remaining: np.ndarray
    suffix_item: np.ndarray
    suffix_word: np.ndarray
    items: list[str | None]

    def code(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.vocabulary):
            return np.zeros(len(hashes), np.uint16)
        place = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[place] == hashes, place + 1, 0).astype(np.uint16)


def make_block(items: list[tuple[str | None, np.ndarray]], window: int) -> Block:
    items = [(name, words) for name, words in items if len(words)]
    vocabulary = np.unique(np.concatenate([w for _, w in items])) if items else np.zeros(0, np.uint64)
    parts, windows, at = [], {}, 0
    suffixes, remaining, owner, word = [], [], [], []
    for number, (name, words) in enumerate(items):
        codes = (np.searchsorted(vocabulary, words) + 1).astype(np.uint16)
        length = min(window, len(codes))
        for first in range(len(codes) - length + 1):
            known = windows.setdefault(codes[first : first + length].tobytes(), (at + first, length, {}))
            known[2][name] = None
        suffixes.append(at + np.arange(len(codes)))
        remaining.append(len(codes) - np.arange(len(codes)))
        owner.append(np.full(len(codes), number))
        word.append(np.arange(len(codes)))
        parts += [codes, np.zeros(1, np.uint16)]
        at += len(codes) + 1
    flat = lambda rows: np.concatenate(rows).astype(np.int64) if rows else np.zeros(0, np.int64)
    return Block(
        vocabulary,
        np.concatenate([*parts, np.zeros(8, np.uint16)]),
        np.array([w[0] for w in windows.values()], np.int64),
        np.array([w[1] for w in windows.values()], np.int64),
        [list(w[2]) for w in windows.values()],
        flat(suffixes),
        flat(remaining),
        flat(owner),
        flat(word),
        [name for name, _ in items],
    )


def pieces(words: np.ndarray, window: int, most: int) -> Iterator[np.ndarray]:
    """`words` in parts within the bounds of a block that overlap by window - 1 words, so each window is in one of them."""
    first = 0
    while True:
        part = words[first : first + most]
        fresh = np.sort(np.unique(part, return_index=True)[1])
        size = len(part) if len(fresh) <= BLOCK_VOCABULARY else int(fresh[BLOCK_VOCABULARY])
        size = max(size, min(window, len(words) - first))
        yield words[first : first + size]
        if first + size >= len(words):
            return
        first += size - window + 1


def item_blocks(benchmark: DataFrame, item_id: str, text: str, window: int | None, block_words: int) -> Iterator[Block]:
    """The benchmark in blocks, streamed; items without words have no window.

    An item over the bounds of a block is cut into several. Without a window items stay whole; one with too many distinct words raises.
    """
    held: list[tuple[str | None, np.ndarray]] = []
    words, seen = 0, set()
    for row in benchmark.select(F.col(item_id).cast("string"), F.col(text)).toLocalIterator():
        data = np.frombuffer((row[1] or "").encode("utf-8", "surrogatepass"), np.uint8)
        hashes, _ = word_hashes(data, np.array([0, len(data)]))
        if not len(hashes):
            continue
        for part in [hashes] if window is None else pieces(hashes, window, block_words):
            more = set(part.tolist())
            if window is None and len(more) > BLOCK_VOCABULARY:
                raise ValueError(f"item {row[0]} has more than {BLOCK_VOCABULARY} distinct words")
            if held and (words + len(part) > block_words or len(seen | more) > BLOCK_VOCABULARY):
                yield make_block(held, window or WINDOW)
                held, words, seen = [], 0, set()
            held.append((row[0], part))
            words, seen = words + len(part), seen | more
    yield make_block(held, window or WINDOW)


class Shard:
    """Whole documents as one code array with their suffix array, for one block of items."""

    def __init__(self, hashes: np.ndarray, text_of: np.ndarray, texts: int, block: Block):
        self.place = np.arange(len(hashes)) + text_of  # one 0 stands between texts
        self.codes = np.zeros(len(hashes) + texts + 12 + int(block.remaining.max(initial=0)), np.uint16)
        self.codes[self.place] = block.code(hashes)
        self.array = suffix_array(self.codes, int(block.remaining.max(initial=0)))
        self.block = block

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """Places in the shard of every occurrence of every window, and the window's number."""
        lo, hi = find(self.codes, self.array, self.block.codes, self.block.starts, self.block.lengths)
        counts = np.maximum(hi - lo, 0)
        number = np.repeat(np.arange(len(counts)), counts)
        within = np.arange(len(number)) - np.repeat(np.cumsum(counts) - counts, counts)
        return self.array[lo[number] + within], number

    def longest(self) -> tuple[np.ndarray, np.ndarray]:
        """The longest prefix of each test suffix that occurs in the shard, and one place of it."""
        at, left = self.block.suffixes, self.block.remaining
        short, long_ = np.zeros(len(at), np.int64), left.copy()
        places = np.full(len(at), -1, np.int64)
        while True:  # halving on the length: a prefix of a match matches
            rows = np.flatnonzero(short < long_)
            if not len(rows):
                return short, places
            middle = (short[rows] + long_[rows] + 1) >> 1
            lo, hi = find(self.codes, self.array, self.block.codes, at[rows], middle)
            hit = lo < hi
            short[rows[hit]] = middle[hit]
            places[rows[hit]] = self.array[lo[hit]]
            long_[rows[~hit]] = middle[~hit] - 1


def _spans(places: np.ndarray, lengths: np.ndarray, size: int) -> np.ndarray:
    """Which of `size` places are inside any [place, place + length)."""
    edge = np.zeros(size + 1, np.int32)
    np.add.at(edge, places, 1)
    np.add.at(edge, places + lengths, -1)
    return np.cumsum(edge[:-1]) > 0


def _scan(block_of, text: str, shard_bytes: int, names: list[str]):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = block_of.value
        spans_type = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        for shard in shards(batches, text, shard_bytes):
            hashes, text_of = word_hashes(*text_bytes(shard.column(text)))
            n_words = np.bincount(text_of, minlength=shard.num_rows)
            first = np.concatenate([[0], np.cumsum(n_words)[:-1]])
            spans: list[list] = [[] for _ in range(shard.num_rows)]
            items: list[set] = [set() for _ in range(shard.num_rows)]
            made = Shard(hashes, text_of, shard.num_rows, block)
            places, number = made.windows()
            if len(places):
                word = np.searchsorted(made.place, places)
                for doc, window in np.unique(np.stack([text_of[word], number], 1), axis=0).tolist():
                    items[doc].update(block.holders[window])
                inside = _spans(word, block.lengths[number], len(hashes)).astype(np.int8)
                # a run also ends where its document does
                change = np.ones(len(hashes) + 1, bool)
                change[1:-1] = (inside[1:] != inside[:-1]) | (text_of[1:] != text_of[:-1])
                cuts = np.flatnonzero(change)
                for start, stop in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                    if inside[start]:
                        doc = int(text_of[start])
                        spans[doc].append({"start": start - int(first[doc]), "stop": stop - int(first[doc])})
            columns = [shard.column(name) for name in names]
            columns += [pa.array(n_words, pa.int64()), pa.array(spans, spans_type), pa.array([sorted(s, key=lambda name: (name is None, name)) for s in items], pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "_n_words", "_spans", "_items"])

    return scan


def _apply(documents: DataFrame, text: str, block: Block, shard_bytes: int) -> DataFrame:
    kinds = [f"`{field.name}` {field.dataType.simpleString()}" for field in documents.schema]
    schema = ", ".join([*kinds, "_n_words long", "_spans array<struct<start:long,stop:long>>", "_items array<string>"])
    shared = documents.sparkSession.sparkContext.broadcast(block)
    return documents.mapInArrow(_scan(shared, text, shard_bytes, documents.columns), schema)


def find_windows(
    documents: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """Every row of `documents` with `_n_words`, `_spans` (hit words, as disjoint ascending ranges) and `_items`.

    Words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after lower-casing A-Z. A window is `window` consecutive words of an item, or all
    words of a shorter one. Null and wordless texts have 0 words, no spans and no items; an item that is null or wordless is never
    found; an id on several rows counts once, and so do all items without an id, which stand last as null. Other columns are carried along; only the names `_row`, `_n_words`, `_spans` and
    `_items` may not be in use.
    """
    taken = {"_row", "_n_words", "_spans", "_items"} & set(documents.columns)
    if taken:
        raise ValueError(f"column names in use: {sorted(taken)}")
    blocks = item_blocks(benchmark, item_id, item_text, window, block_words)
    block = next(blocks)
    following = next(blocks, None)
    if following is None:
        return _apply(documents, text, block, shard_bytes)
    # several blocks: rows that hold finds are few; they are written block by block and merged
    spark = documents.sparkSession
    path, found = scratch_path(spark, "numbered-documents"), scratch_path(spark, "found")
    documents.withColumn("_row", F.monotonically_increasing_id()).write.parquet(path)
    base = spark.read.parquet(path)
    while block is not None:
        out = _apply(base.select("_row", text), text, block, shard_bytes).where(F.size("_items") > 0)
        out.select("_row", "_spans", "_items").write.mode("append").parquet(found)
        block, following = following, next(blocks, None)
    merged = (
        spark.read.parquet(found)
        .groupBy("_row")
        .agg(F.flatten(F.collect_list("_spans")).alias("_spans"), F.flatten(F.collect_list("_items")).alias("_items"))
        .select("_row", _merged_spans(F.col("_spans")).alias("_spans"), F.array_sort(F.array_distinct("_items")).alias("_items"))
    )
    counted = _apply(base, text, make_block([], window), shard_bytes).drop("_spans", "_items")
    return (
        counted.join(merged, "_row", "left")
        .withColumn("_spans", F.coalesce("_spans", F.expr("cast(array() as array<struct<start:bigint,stop:bigint>>)")))
        .withColumn("_items", F.coalesce("_items", F.expr("cast(array() as array<string>)")))
        .select(*[F.col(f"`{name}`") for name in documents.columns], "_n_words", "_spans", "_items")
    )


def _merged_spans(spans):
    """Overlapping ranges joined; ranges of one document, a few per item found."""
    empty = F.expr("cast(array() as array<struct<start:bigint,stop:bigint>>)")

    def add(done, span):
        last = F.element_at(done, -1)
        joined = F.concat(
            F.slice(done, F.lit(1), F.size(done) - 1),
            F.array(F.struct(last["start"].alias("start"), F.greatest(last["stop"], span["stop"]).alias("stop"))),
        )
        return F.when((F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["stop"] >= span["start"]), joined).otherwise(
            F.concat(done, F.array(span))
        )

    return F.aggregate(F.array_sort(spans), empty, add)


def judged(found: DataFrame, share: int = 20) -> DataFrame:
    """`found` of find_windows with `n_words`, `n_hit`, `n_items`, `items_sha256` and `contaminated` in place of the three.

    A null id counts in `n_items` and has no part in `items_sha256`.
    """
    hit = F.aggregate("_spans", F.lit(0).cast("long"), lambda total, span: total + span["stop"] - span["start"])
    return (
        found.withColumn("n_words", F.col("_n_words"))
        .withColumn("n_hit", hit)
        .withColumn("n_items", F.size("_items").cast("long"))
        .withColumn("items_sha256", F.sha2(F.array_join("_items", ",").cast("binary"), 256))
        .withColumn("contaminated", (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words")))
        .drop("_n_words", "_spans", "_items")
    )


def remove_contaminated(documents: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of `documents` of which less than a twentieth of the words is inside a window of `benchmark`."""
    found = find_windows(documents, benchmark, **options)
    hit = F.aggregate("_spans", F.lit(0).cast("long"), lambda total, span: total + span["stop"] - span["start"])
    return found.where((hit == 0) | (20 * hit < F.col("_n_words"))).select(*[F.col(f"`{name}`") for name in documents.columns])


def longest_matches(documents: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", block_words: int = BLOCK_WORDS, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """For every suffix of every item (item_id, item_word): the longest verbatim match over all documents and one place of it.

    An item with more than `BLOCK_VOCABULARY` distinct words raises, as a match may be as long as the item. The first document by id is named where several hold a match of that length. Suffixes without any match are left out.
    """
    spark = documents.sparkSession
    schema = "item_id string, item_word long, n_words long, doc_id string, doc_word long"

    def scan_of(block_of):
        def scan(batches):
            block = block_of.value
            for shard in shards(batches, "_text", shard_bytes):
                hashes, text_of = word_hashes(*text_bytes(shard.column("_text")))
                made = Shard(hashes, text_of, shard.num_rows, block)
                length, places = made.longest()
                rows = np.flatnonzero(length > 0)
                word = np.searchsorted(made.place, places[rows])
                doc = text_of[word]
                first = np.concatenate([[0], np.cumsum(np.bincount(text_of, minlength=shard.num_rows))[:-1]])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([block.items[i] for i in block.suffix_item[rows]], pa.string()),
                        pa.array(block.suffix_word[rows], pa.int64()),
                        pa.array(length[rows], pa.int64()),
                        shard.column("_id").take(pa.array(doc)),
                        pa.array(word - first[doc], pa.int64()),
                    ],
                    names=["item_id", "item_word", "n_words", "doc_id", "doc_word"],
                )

        return scan

    out = None
    for block in item_blocks(benchmark, item_id, item_text, None, block_words):
        part = documents.select(F.col(doc_id).cast("string").alias("_id"), F.col(text).alias("_text")).mapInArrow(scan_of(spark.sparkContext.broadcast(block)), schema)
        out = part if out is None else out.unionAll(part)
    best = F.min_by(F.struct("n_words", "doc_id", "doc_word"), F.struct(-F.col("n_words"), "doc_id", "doc_word"))
    return out.groupBy("item_id", "item_word").agg(best.alias("best")).select("item_id", "item_word", "best.*")
