"""Near-duplicates by 64-bit SimHash: vantage-point trees deal fingerprints to shards that hold every pair within reach.

Two fingerprints that differ in at most 3 bits differ in at most 1 bit of one half. There is a tree per half. A node of a tree has a
vantage point, a distance (over its half, or over all 64 bits) and a radius; a fingerprint lives on one side, and also visits the
other side if, by the triangle inequality, a partner can live there: its distance is within 1 (half) or 3 (all bits) of the radius.
So every pair meets in the leaf where one of the two lives, and the exact distance decides.

Equal fingerprints are one row from the start, however many documents share one. A leaf that holds many is cut into blocks, and pairs of
blocks are compared, so that no task holds a whole group. A block leaves as a spanning forest of the links it found, never as
pairs, and components are joined by star rounds in the cluster.

The trees are fitted on one in `SAMPLE_EVERY` distinct fingerprints, at most `SAMPLE_ROWS`; every fingerprint is dealt by them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from debutline.llm.components import components
from debutline.llm.shared import cut_lineage, picked

BITS = 3
WORDS = 3
SEED = 42
SAMPLE_EVERY = 64
SAMPLE_ROWS = 2_000_000
LEAF_SAMPLE = 16
BLOCK = 4096

_HALVES = np.array([0xFFFFFFFF00000000, 0x00000000FFFFFFFF], np.uint64)
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingle_hashes(text: str | None, words: int = WORDS) -> np.ndarray:
    """XXH64 of every run of `words` words, repeats included; of the whole sequence if it is shorter; none without words."""
    if not text:
        return np.zeros(0, np.uint64)
    found = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z only, ASCII white space only
    if not found:
        return np.zeros(0, np.uint64)
    if len(found) < words:
        return np.array([xxhash.xxh64_intdigest(b" ".join(found), SEED)], np.uint64)
    runs = map(b" ".join, zip(*(found[k:] for k in range(words))))
    digest, seed = xxhash.xxh64_intdigest, SEED
    return np.fromiter((digest(run, seed) for run in runs), np.uint64, len(found) - words + 1)


def majority(hashes: np.ndarray) -> int:
    """The bits set in over half of the hashes; 0 of none."""
    totals = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 15):
        part = hashes[at : at + (1 << 15)].astype(">u8").view(np.uint8).reshape(-1, 8)
        totals += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * totals > len(hashes))
    return int.from_bytes(bits.tobytes(), "big")


def fingerprints(documents: DataFrame, text: str = "text", words: int = WORDS) -> DataFrame:
    """`documents` with `_fingerprint` (64 bits as a long) in place of the text. Null, empty and wordless texts have 0."""
    names = [name for name in documents.columns if name != text]
    kinds = ", ".join([*(f"`{name}` {documents.schema[name].dataType.simpleString()}" for name in names), "_fingerprint long"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([majority(shingle_hashes(value.as_py(), words)) for value in batch.column(text)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*(batch.column(name) for name in names), pa.array(prints, pa.int64())], names=[*names, "_fingerprint"])

    return documents.select(*[f"`{name}`" for name in names], text).mapInArrow(scan, kinds)


def distance(a: np.ndarray, b) -> np.ndarray:
    return np.bitwise_count(a ^ b)


@dataclass
class Tree:
    """Nodes as columns; a node with `left` of -1 is a leaf."""

    half: int
    vantage: list[int] = field(default_factory=list)
    mask: list[int] = field(default_factory=list)
    reach: list[int] = field(default_factory=list)
    radius: list[int] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)

    def add(self) -> int:
        for column in (self.vantage, self.mask, self.reach, self.radius, self.left, self.right):
            column.append(-1)
        return len(self.left) - 1

    def deal(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place of the fingerprint, leaf, lives there) for every leaf that a fingerprint lives in or visits."""
        rows, leaves, homes = [], [], []
        open_ = [(0, np.arange(len(prints)), np.ones(len(prints), bool))]
        while open_:
            node, at, home = open_.pop()
            if not len(at):
                continue
            if self.left[node] < 0:
                rows.append(at)
                leaves.append(np.full(len(at), node, np.int64))
                homes.append(home)
                continue
            far = distance(prints[at] & np.uint64(self.mask[node]), np.uint64(self.vantage[node] & self.mask[node])).astype(np.int64)
            radius, reach = self.radius[node], self.reach[node]
            inner, outer = far - reach <= radius, far + reach > radius
            open_.append((self.left[node], at[inner], home[inner] & (far[inner] <= radius)))
            open_.append((self.right[node], at[outer], home[outer] & (far[outer] > radius)))
        if not rows:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
        return np.concatenate(rows), np.concatenate(leaves), np.concatenate(homes)


def grow(sample: np.ndarray, half: int, bits: int = BITS, leaf_sample: int = LEAF_SAMPLE) -> Tree:
    """A tree over `sample`: of some vantage points, distances and radii, a node takes those that leave the fewest comparisons."""
    tree = Tree(half)
    rng = np.random.default_rng(half + 1)
    metrics = [(int(_HALVES[half]), bits // 2), (int(_ALL), bits)]
    open_ = [(tree.add(), sample)]
    while open_:
        node, held = open_.pop()
        if len(held) < 2 * leaf_sample:
            continue
        best = None
        seen = held if len(held) <= 4096 else rng.choice(held, 4096, replace=False)
        for vantage in rng.choice(seen, 6):
            for mask, reach in metrics:
                far = distance(seen & np.uint64(mask), vantage & np.uint64(mask)).astype(np.int64)
                upto = np.cumsum(np.bincount(far, minlength=66 + reach)) / len(seen)
                for radius in np.unique(np.quantile(far, (0.35, 0.5, 0.65), method="lower")):
                    inside = upto[radius]
                    to_left, to_right = upto[radius + reach], 1 - (upto[radius - reach] if radius >= reach else 0)
                    cost = inside * to_left + (1 - inside) * to_right
                    if 0 < inside < 1 and (best is None or cost < best[0]):
                        best = (cost, int(vantage), mask, reach, int(radius))
        if best is None or best[0] > 0.9:  # nothing to gain: the blocks of the leaf do the rest
            continue
        _, tree.vantage[node], tree.mask[node], tree.reach[node], tree.radius[node] = best
        far = distance(held & np.uint64(best[2]), np.uint64(best[1] & best[2])).astype(np.int64)
        tree.left[node], tree.right[node] = tree.add(), tree.add()
        open_.append((tree.left[node], held[far <= best[4]]))
        open_.append((tree.right[node], held[far > best[4]]))
    return tree


def forest(residents: np.ndarray, others: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Each fingerprint of the two sides that is linked to a lesser one by links residents x others, with the least it is linked to.

    `others` may hold the residents themselves. Pairs are looked at 64 rows at a time and never kept.
    """
    values = np.unique(np.concatenate([residents, others]))
    column = np.searchsorted(values, residents)
    root = np.arange(len(values))
    for at in range(0, len(others), 64):
        part = others[at : at + 64]
        near = distance(part[:, None], residents[None, :]) <= bits
        rows, columns = np.nonzero(near)
        a, b = np.searchsorted(values, part)[rows], column[columns]
        while True:
            ra, rb = root[a], root[b]
            apart = ra != rb
            if not apart.any():
                break
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
            while True:
                shorter = root[root]
                if (shorter == root).all():
                    break
                root = shorter
    linked = np.flatnonzero(root != np.arange(len(values)))
    return values[linked], values[root[linked]]


def links(prints: DataFrame, bits: int = BITS, block: int = BLOCK, sample_every: int = SAMPLE_EVERY, sample_rows: int = SAMPLE_ROWS, leaf_sample: int = LEAF_SAMPLE) -> DataFrame:
    """(a, b) links whose components are those of all pairs of `prints` (`_fingerprint`, distinct) at most `bits` bits apart."""
    if bits >= 2 * 32:
        raise ValueError("at most 63 bits")
    spark = prints.sparkSession
    size = prints.count()
    every = max(sample_every, -(-size // sample_rows))
    chosen = prints.where(F.pmod(F.xxhash64("_fingerprint"), F.lit(every)) == 0)
    sample = np.sort(np.array([row[0] for row in chosen.collect()], np.int64)).view(np.uint64)
    trees = spark.sparkContext.broadcast([grow(sample, half, bits, leaf_sample) for half in (0, 1)])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for tree in trees.value:
                rows, leaf, home = tree.deal(own)
                for at in range(0, len(rows), 1 << 16):
                    some = slice(at, at + (1 << 16))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(leaf[some] * 2 + tree.half), pa.array(own[rows[some]].view(np.int64)), pa.array(home[some])], names=["leaf", "print", "home"]
                    )

    dealt = cut_lineage(prints.select("_fingerprint").mapInArrow(deal, "leaf long, print long, home boolean"), "dealt")
    # pieces of a leaf: residents go to one row of blocks, and everything in the leaf to one column; a pair of residents is met once
    counts = dealt.groupBy("leaf").agg(F.sum(F.col("home").cast("long")).alias("homes"), F.count("*").alias("all"))
    sizes = counts.select("leaf", F.ceil(F.greatest(F.col("homes"), F.lit(1)) / block).cast("int").alias("across"), F.ceil(F.col("all") / (2 * block)).cast("int").alias("down"))
    placed = dealt.join(sizes, "leaf")
    mixed = F.xxhash64("print")
    resident = placed.where("home").select("leaf", "print", F.lit(True).alias("home"), F.pmod(mixed, "across").cast("int").alias("x"), F.explode(F.sequence(F.lit(0), F.col("down") - 1)).alias("y"))
    other = placed.select("leaf", "print", F.lit(False).alias("home"), F.explode(F.sequence(F.lit(0), F.col("across") - 1)).alias("x"), F.pmod(mixed, "down").cast("int").alias("y"))

    def meet(group: pa.Table) -> pa.Table:
        own = group.column("print").to_numpy().view(np.uint64)
        home = group.column("home").to_numpy(zero_copy_only=False)
        a, b = forest(own[home], own[~home], bits)
        return pa.table({"a": pa.array(a.view(np.int64)), "b": pa.array(b.view(np.int64))})

    return resident.unionAll(other).groupBy("leaf", "x", "y").applyInArrow(meet, "a long, b long")


def near_groups(prints: DataFrame, doc_id: str, bits: int = BITS, **options) -> DataFrame:
    """(_fingerprint, root, component): a fingerprint of its component, the same for all, and the least id of the documents in it.

    `prints` has the id and `_fingerprint`, a row per document. Null ids count last, so only groups without any id have a null component.
    """
    distinct = cut_lineage(prints.groupBy("_fingerprint").agg(F.min(doc_id).alias("least")), "distinct")
    found = cut_lineage(components(links(distinct, bits, **options)), "components")
    rooted = distinct.join(found, F.col("_fingerprint") == F.col("node"), "left").select("_fingerprint", "least", F.coalesce("root", "_fingerprint").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component"))
    return rooted.join(least, "root").select("_fingerprint", "root", "component")


def near_duplicates(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per row of `documents`: its id, `fingerprint` (16 hex digits) and `component_id`, the least id of its component.

    Null and wordless texts have the fingerprint 0 and are linked like any other; a null id never names a component.
    """
    prints = cut_lineage(fingerprints(documents.select(doc_id, text), text), "prints")
    groups = near_groups(prints, doc_id, **options)
    return prints.join(groups, "_fingerprint").select(
        doc_id, F.lower(F.lpad(F.hex("_fingerprint"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id")
    )


def keep_one(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """`documents` with one row of each component: that with the least id.

    Of rows with that same id (repeated rows, or an id given twice) the one with the least text hash stays; of equal ones, one.
    A component of rows without ids keeps the one with the least text hash. Names that `shared.picked` uses may not be in use.
    """
    light = documents.select(F.col(doc_id).alias("_id"), F.xxhash64(text).alias("_hash"), F.col(text).alias("_t"))
    prints = cut_lineage(fingerprints(light, "_t").groupBy("_id", "_hash", "_fingerprint").agg(F.count("*").alias("_rows")), "prints")
    groups = near_groups(prints, "_id", **options)
    first = F.min(F.struct(F.col("_id").isNull().alias("no_id"), "_id", "_hash", "_rows")).alias("first")
    kept = prints.join(groups, "_fingerprint").groupBy("root").agg(first).select(F.col("first._id").alias(doc_id), "first._hash", "first._rows", F.lit(1).alias("_times"))
    return picked(documents, cut_lineage(kept, "kept"), text, [doc_id])
