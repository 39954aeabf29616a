"""Centroid clustering over integers, with a matrix of dot products that is kept and mended.

Vectors travel in packed blocks. With each block goes its matrix of exact dot products with all centroids. When the centroids move, only the components
that changed are multiplied: product += vector component * change. The squared distance is |x|^2 - 2 x.c + |c|^2, and all of it is
whole numbers, so the mended matrix equals a fresh one and the result depends on no order.

Every round writes the blocks with their matrix once to the shared folder and drops the round before; the sums that move the centroids are part of
the blocks. The driver holds the centroids and one sum per centroid and component. No vector is shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from debutline.llm.shared import discard, scratch_path

DIMENSIONS = 64
CENTROIDS = 40
ROUNDS = 5
SCALE = 256
SALT = "2:"
# with components within this bound every squared distance of 64 components fits in a long
MOST = 1 << 27
_EXACT = 1 << 53
_KINDS = (np.int8, np.int16, np.int32, np.int64)


def packed(values: np.ndarray) -> bytes:
    """Whole numbers in the narrowest type that holds them; the first byte names it."""
    top = int(np.abs(values).max(initial=0))
    kind = next(k for k, t in enumerate(_KINDS) if top <= np.iinfo(t).max)
    return bytes([kind]) + np.ascontiguousarray(values, _KINDS[kind]).tobytes()


def unpacked(data: bytes, width: int) -> np.ndarray:
    return np.frombuffer(data, _KINDS[data[0]], offset=1).reshape(-1, width)


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """left @ right.T in whole numbers; in floating point where every partial sum is exact in it."""
    bound = int(np.abs(left).max(initial=0)) * int(np.abs(right).max(initial=0)) * left.shape[1]
    if bound < _EXACT:
        return (left.astype(np.float64) @ right.astype(np.float64).T).astype(np.int64)
    return left.astype(np.int64) @ right.astype(np.int64).T


def mend(dots: np.ndarray, vectors: np.ndarray, change: np.ndarray) -> None:
    """Dot products with the moved centroids, in place: each centroid's changed components only."""
    full = []
    for k in np.flatnonzero(change.any(axis=1)).tolist():
        moved = np.flatnonzero(change[k])
        if 2 * len(moved) >= change.shape[1]:
            full.append(k)  # most of it moved: multiplied together with others of that kind
        else:
            dots[:, k] += products(vectors[:, moved], change[k : k + 1, moved])[:, 0]
    if full:
        dots[:, full] += products(vectors, change[full])


def distances(dots: np.ndarray, vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    wide = vectors.astype(np.int64)
    return (wide * wide).sum(axis=1)[:, None] - 2 * dots + (centroids * centroids).sum(axis=1)[None, :]


def fits(vector: Column, dimensions: int) -> Column:
    """Has `vector` exactly so many components, all of them finite numbers?"""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) == dimensions) & good, F.lit(False))


def _block_schema(kind: str) -> str:
    return f"ids array<{kind}>, vectors binary, dots binary, places binary, reach binary, sums binary"


def _row(ids: pa.Array, vectors: np.ndarray, dots: np.ndarray, centroids: np.ndarray) -> pa.RecordBatch:
    """A block: nearest centroid and distance of each vector, and count, component sums and distance sum of each centroid."""
    away = distances(dots, vectors, centroids)
    places = away.argmin(axis=1)  # the first of equals
    reach = away[np.arange(len(away)), places]
    chosen = np.zeros((len(centroids), len(vectors)), np.int8)
    chosen[places, np.arange(len(vectors))] = 1
    inertia = np.zeros(len(centroids), np.int64)
    np.add.at(inertia, places, reach)
    sums = np.column_stack([chosen.sum(axis=1, dtype=np.int64), products(chosen, vectors.T), inertia])
    row = [ids, packed(vectors), packed(dots), packed(places), packed(reach), packed(sums)]
    arrays = [pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), *[pa.array([value], pa.binary()) for value in row[1:]]]
    return pa.RecordBatch.from_arrays(arrays, names=["ids", "vectors", "dots", "places", "reach", "sums"])


def _first_blocks(kept: DataFrame, centroids: np.ndarray, scale: int, kind: str) -> DataFrame:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                flat = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                vectors = np.floor(scale * flat).astype(np.int64).reshape(batch.num_rows, -1)
                yield _row(batch.column(0), vectors, products(vectors, centroids), centroids)

    return kept.mapInArrow(scan, _block_schema(kind))


def _next_blocks(blocks: DataFrame, before: np.ndarray, centroids: np.ndarray, kind: str) -> DataFrame:
    dimensions, many, change = centroids.shape[1], len(centroids), centroids - before

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                vectors = unpacked(batch.column("vectors")[at].as_py(), dimensions)
                dots = unpacked(batch.column("dots")[at].as_py(), many).astype(np.int64)
                mend(dots, vectors, change)
                yield _row(batch.column("ids")[at].values, vectors, dots, centroids)

    return blocks.select("ids", "vectors", "dots").mapInArrow(scan, _block_schema(kind))


def _totals(blocks: DataFrame, many: int, dimensions: int) -> list[list[int]]:
    """Count, component sums and distance sum of each centroid over all blocks: many * (dimensions + 2) numbers."""
    width = dimensions + 2

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * (many * width)
        held = np.zeros(many * width, np.int64)
        for batch in batches:
            for data in batch.column(0):
                sums = unpacked(data.as_py(), width).reshape(-1).astype(np.int64)
                if int(np.abs(held).max()) + int(np.abs(sums).max()) >= 1 << 62:
                    total, held = [a + b for a, b in zip(total, held.tolist())], np.zeros_like(held)
                held += sums
        total = [a + b for a, b in zip(total, held.tolist())]
        used = [k for k, value in enumerate(total) if value]
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array([str(total[k]) for k in used], pa.string())], names=["slot", "total"])

    rows = blocks.select("sums").mapInArrow(scan, "slot int, total string").groupBy("slot").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    out = [[0] * width for _ in range(many)]
    for row in rows.collect():
        out[row["slot"] // width][row["slot"] % width] = int(row["total"])
    return out


def starts(kept: DataFrame, centroids: int, salt: str, scale: int) -> np.ndarray:
    """The vectors whose salted id has the smallest SHA-256, in that order; equal ids by their components, null ids last."""
    by = [F.sha2(F.concat(F.lit(salt), F.col("_id").cast("string")), 256).asc_nulls_last(), F.col("_vector")]
    rows = kept.orderBy(*by).limit(centroids).select("_vector").collect()
    return np.array([[int(np.floor(scale * float(x))) for x in row[0]] for row in rows], np.int64)


def cluster(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    dimensions: int = DIMENSIONS,
    centroids: int = CENTROIDS,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    salt: str = SALT,
) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256): a row for every row whose vector has `dimensions` finite components.

    Component x becomes floor(scale * x). Equal distances go to the smaller number; a centroid without vectors stays. Repeated rows count as often as they
    occur. Fewer vectors than `centroids` start with as many centroids; no vector gives no rows. A component beyond 2**27 after scaling has squared
    distances that no long holds: such a row takes no part, its cluster and distance are null.
    """
    spark, kind = vectors.sparkSession, vectors.schema[vec_id].dataType.simpleString()
    column = F.col(f"`{embedding}`")
    rows = vectors.where(fits(column, dimensions)).select(F.col(f"`{vec_id}`").alias("_id"), column.alias("_vector"))
    within = F.forall("_vector", lambda x: F.abs(F.floor(x.cast("double") * scale)) <= MOST)
    kept = rows.where(within)
    schema = f"`{vec_id}` {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    now = starts(kept, centroids, salt, scale)
    if not len(now):
        return rows.select(F.col("_id").alias(vec_id), *[F.lit(None).cast(t).alias(n) for n, t in RESULT.items()])
    blocks, path = _written(_first_blocks(kept, now, scale, kind), spark)
    for _ in range(rounds):
        totals = _totals(blocks, len(now), dimensions)
        moved = np.array([[s // t[0] for s in t[1:-1]] if t[0] else now[k].tolist() for k, t in enumerate(totals)], np.int64)
        following, new_path = _written(_next_blocks(blocks, now, moved, kind), spark)
        discard(spark, path)
        blocks, path, now = following, new_path, moved
    totals = _totals(blocks, len(now), dimensions)
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in now.tolist()]
    inertia, everything = [t[-1] for t in totals], sum(t[-1] for t in totals)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                places = unpacked(batch.column("places")[at].as_py(), 1)[:, 0]
                of = places.tolist()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("ids")[at].values,
                        pa.array(places.astype(np.int32)),
                        pa.array(unpacked(batch.column("reach")[at].as_py(), 1)[:, 0].astype(np.int64)),
                        pa.array([inertia[k] for k in of], pa.int64()),
                        pa.array([everything] * len(of), pa.int64()),
                        pa.array([digests[k] for k in of]),
                    ],
                    names=[vec_id, *RESULT],
                )

    found = blocks.select("ids", "places", "reach").mapInArrow(scan, schema)
    beyond = rows.where(~within).select(F.col("_id").alias(vec_id), *[F.lit(None).cast(t).alias(n) for n, t in RESULT.items()])
    return found.unionAll(beyond)


RESULT = {"cluster": "int", "distance": "long", "cluster_inertia": "long", "inertia": "long", "centroid_sha256": "string"}


def _written(blocks: DataFrame, spark: SparkSession) -> tuple[DataFrame, str]:
    path = scratch_path(spark, "blocks")
    blocks.write.option("compression", "zstd").option("parquet.block.size", 16 << 20).parquet(path)
    return spark.read.schema(blocks.schema).parquet(path), path
