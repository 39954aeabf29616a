"""Mixing sources to target weights by balanced sampling with the cube method.

Every document of a source is taken floor(r) times, r = target / size of the source, and once more with probability r - floor(r). Which ones
are taken once more is drawn by the cube method: the vector of probabilities moves at random through the null space of the constraints
(documents and words of the source stay as expected) until each unit has reached 0 or 1. With two constraints a step needs three units,
so a block of units is walked through in one pass and leaves two undecided at most. `LANDING_UNITS` of all sizes wait outside the walk.

Blocks hold about `BLOCK_UNITS` units, picked by a hash of the id; what a round leaves undecided meets in blocks again, until one block per source
is left with a small landing problem: the two undecided units and those that waited, of which the choice nearest to the expected words is
taken. Only ids and sizes are shuffled, never texts,
and a source with a third of all rows is as many blocks as it needs. Draws come from a hash of source, round and block, and units are
walked in an order of their own, so reruns agree.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from debutline.llm.shared import cut_lineage, numbered, picked

WEIGHTS = (1, 2, 3)
MOST_REPEATS = 3
BLOCK_UNITS = 8192
SPREAD = 1024
LANDING_UNITS = 12
SEED = 20240229
_NEAR = 1e-9
WORD = r"[^\x20\x09-\x0D]+"


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST_REPEATS) -> DataFrame:
    """(source, units, source_size, target) from rows of (source, size).

    Sources in the order of their code points, null last, get `weights` by turns, and share the sum of all sizes by weight; no target is
    above `most` times its source's size, and what that cuts off is shared again by the weights of the others. A source of size 0 has
    the target 0. Only sums come to the driver, so there may be any number of sources.
    """
    sums = sizes.groupBy("source").agg(F.count("*").alias("units"), F.coalesce(F.sum("size"), F.lit(0)).cast("long").alias("source_size"))
    ranked = numbered(sums, [F.col("source").asc_nulls_last()], "_rank")
    share = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    ranked = cut_lineage(ranked.withColumn("_weight", share), "sources")
    cap = F.col("source_size") * F.lit(float(most))
    level, full = None, -1
    while True:
        capped = F.lit(False) if level is None else F.lit(level) * F.col("_weight") > cap
        row = ranked.agg(
            F.sum("source_size").alias("all"),
            F.sum(F.when(capped, cap).otherwise(0.0)).alias("cut"),
            F.sum(F.when(~capped, F.col("_weight")).otherwise(0.0)).alias("open"),
            F.sum(capped.cast("int")).alias("full"),
        ).first()
        if row["full"] is None or row["full"] == full or not row["open"]:
            break
        full, level = row["full"], (row["all"] - row["cut"]) / row["open"]
    target = F.least(F.lit(level if level is not None else 0.0) * F.col("_weight"), cap)
    return ranked.select("source", "units", "source_size", target.alias("target"), F.col("_rank").alias("_source"))


def flight(shares: np.ndarray, sizes: np.ndarray, draws: Iterator[float], units: np.ndarray) -> np.ndarray:
    """Shares after the walk over `units`, taken in their order: 0 or 1 but for two of them at most."""
    out = shares.tolist()
    size = sizes.astype(np.float64).tolist()
    waiting = iter([k for k in units.tolist() if _NEAR < out[k] < 1 - _NEAR])
    active: list[int] = []
    while True:
        active = [k for k in active if 0.0 < out[k] < 1.0]
        while len(active) < 3 and (k := next(waiting, None)) is not None:
            active.append(k)
        if len(active) < 3:
            break
        a, b, c = (size[k] for k in active)
        step = [c - b, a - c, b - a]  # keeps the sum of the shares and that of the words
        if not any(step):
            step = [1.0, -1.0, 0.0]
        up = down = float("inf")
        for k, s in zip(active, step):
            if s > 0:
                up, down = min(up, (1 - out[k]) / s), min(down, out[k] / s)
            elif s < 0:
                up, down = min(up, out[k] / -s), min(down, (1 - out[k]) / -s)
        by = up if next(draws) * (up + down) < down else -down
        for k, s in zip(active, step):
            value = out[k] + by * s
            out[k] = 0.0 if value < _NEAR else 1.0 if value > 1 - _NEAR else value
    return np.array([0.0 if p <= _NEAR else 1.0 if p >= 1 - _NEAR else p for p in out])


def landing(shares: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A few undecided units decided together: of all ways that whose words, then units, are nearest to what was expected."""
    open_ = np.flatnonzero((shares > 0) & (shares < 1))
    ways = (np.arange(1 << len(open_))[:, None] >> np.arange(len(open_))) & 1
    words = np.abs(ways @ sizes[open_] - float(sizes[open_] @ shares[open_]))
    units = np.abs(ways.sum(axis=1) - shares[open_].sum())
    out = shares.copy()
    out[open_] = ways[np.lexsort((units, words))[0]]
    return out


def _walk(land: bool, number: int, columns: list[str]):
    def walk(group: pa.Table) -> pa.Table:
        size = group.column("size").to_numpy()
        mark = group.column("_mark").to_numpy()
        key = int(group.column("_source")[0].as_py()), number, int(group.column("_block")[0].as_py())
        rng = np.random.Generator(np.random.Philox(key=np.array([SEED, abs(hash(key))], np.uint64)))
        draws = iter(lambda: float(rng.random()), None)
        share = group.column("_share").to_numpy()
        order = np.lexsort((mark, -size))
        order = order[(share[order] > _NEAR) & (share[order] < 1 - _NEAR)]
        # units of all sizes wait for the landing, where they make up for what the walk leaves
        late = np.unique(np.linspace(0, len(order) - 1, LANDING_UNITS).astype(np.int64)) if len(order) else np.zeros(0, np.int64)
        share = flight(share, size, draws, np.delete(order, late))
        if land:
            share = landing(share, size)
        at = group.schema.get_field_index("_share")
        return group.set_column(at, "_share", pa.array(share)).select(columns)

    return walk


def drawn(units: DataFrame, targets: DataFrame, block_units: int = BLOCK_UNITS, spread: int = SPREAD) -> DataFrame:
    """`units` (key, source, size, ...) with source_size, target and `repeats`, how often the mix takes the unit."""
    # units alike in every way are told apart by a number, without being brought together
    alike = units.groupBy(*[f"`{name}`" for name in units.columns]).agg(F.count(F.lit(1)).alias("_alike"))
    units = alike.withColumn("_number", F.explode(F.sequence(F.lit(1), F.col("_alike").cast("int")))).drop("_alike")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    joined = units.join(targets.withColumnRenamed("source", "_name"), F.col("source").eqNullSafe(F.col("_name"))).drop("_name")
    state = (
        joined.withColumn("_whole", F.floor(rate).cast("int"))
        .withColumn("_share", rate - F.floor(rate))
        .withColumn("_mark", F.when(F.col("_number") == 1, F.xxhash64("key", "size")).otherwise(F.xxhash64("key", "size", "_number")))
        .withColumn("_block", F.pmod("_mark", F.ceil(F.col("units") / block_units)))
    )
    most = targets.agg(F.max("units")).first()[0] or 0
    blocks, number, parts = -(-most // block_units), 0, []
    schema = state.schema
    while True:
        land = blocks <= 1
        kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        state = cut_lineage(state.groupBy("_source", "_block").applyInArrow(_walk(land, number, schema.names), kinds), "walk")
        decided = state.where((F.col("_share") == 0) | (F.col("_share") == 1))
        parts.append(decided)
        if land:
            break
        state = state.where((F.col("_share") > 0) & (F.col("_share") < 1)).withColumn("_block", F.floor(F.col("_block") / spread))
        blocks, number = -(-blocks // spread), number + 1
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    extra = [name for name in units.columns if name not in ("key", "source", "size", "_number")]
    return out.select("key", *extra, "size", "source_size", "target", (F.col("_whole") + F.col("_share").cast("int")).alias("repeats"))


def word_count(text: str):
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def mix(documents: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text", **options) -> DataFrame:
    """A row per row of `documents`: id, size, source_size, target (both of its source), taken (words) and repeats.

    Null texts have size 0; null is a source of its own, after the others. Rows that are alike are drawn one by one; which of them is taken
    makes no difference. An empty table gives no rows.
    """
    units = cut_lineage(documents.select(F.col(doc_id).alias("key"), F.col(source).alias("source"), word_count(text).alias("size")), "units")
    out = drawn(units, source_targets(units), **options)
    return out.select(F.col("key").alias(doc_id), "size", "source_size", "target", (F.col("size") * F.col("repeats")).alias("taken"), "repeats")


def mixed(documents: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text", **options) -> DataFrame:
    """The mix itself: the rows of `documents`, each as often as it is taken.

    Repeated rows (alike in id, source and text) are drawn one by one, and come out as copies of one of them.
    """
    light = documents.select(F.col(doc_id).alias("key"), F.col(source).alias("source"), word_count(text).alias("size"), F.xxhash64(text).alias("_hash"))
    units = cut_lineage(light, "units")
    taken = drawn(units.withColumn("_from", F.col("source")), source_targets(units), **options)
    chosen = taken.groupBy("key", "_from", "_hash").agg(F.sum("repeats").alias("_times"), F.count("*").alias("_rows")).where("_times > 0")
    chosen = chosen.select(F.col("key").alias(doc_id), F.col("_from").alias(source), "_hash", "_times", "_rows")
    return picked(documents, cut_lineage(chosen, "taken"), text, [doc_id, source])
