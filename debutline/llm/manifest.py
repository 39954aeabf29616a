"""Merkle manifest of a dataset: a tree of hashes for each group of rows, one tree over the groups, and a proof for every row.

Leaves of a group stand in order; while several nodes remain, every `FANOUT` consecutive ones become their hash. The leaves are dealt in aligned
blocks of FANOUT ** BLOCK_LEVELS; a block builds its own lower levels. The upper levels are a butterfly: in round r the blocks whose numbers
differ in digit r only (base FANOUT) swap the roots of their subtrees, and each of them hashes the common ancestor for itself. After the last round every
block knows the root and all siblings on its way to it, so nothing is sent down again. The trees of the groups meet in a butterfly of their own.

Only digests are shuffled, never texts; no task holds more than a block or FANOUT nodes of one exchange.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from debutline.llm.shared import cut_lineage, numbered

FANOUT = 16
BLOCK_LEVELS = 3
# block rows that share one copy of what their group needs
CHUNK = 1024
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(values: list[Column]) -> Column:
    """Lowercase hex SHA-256 of all values one after the other: '-' for null, else number of UTF-8 bytes, ':', the value."""
    return F.sha2(F.concat(*[_field(value) for value in values]), 256)


def node_digest(digests: list[str]) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def levels_of(leaves: list[str], fanout: int, most: int | None = None) -> list[list[str]]:
    """The levels above and with the leaves, up to the root or `most` levels of hashing."""
    levels = [leaves]
    while (len(levels[-1]) > 1) if most is None else (len(levels) <= most):
        below = levels[-1]
        levels.append([node_digest(below[at : at + fanout]) for at in range(0, len(below), fanout)])
    return levels


def tree_height(leaves: int, fanout: int) -> int:
    height = 0
    while leaves > 1:
        leaves, height = -(-leaves // fanout), height + 1
    return height


def butterfly(nodes: DataFrame, by: list[str], at: str, size: str, most: int, fanout: int = FANOUT) -> DataFrame:
    """`nodes` with the root above them in `top`, and in `befores` and `afters` their siblings on the way, joined level by level.

    `nodes` has a row per node: keys `by`, its number `at` of `size` nodes under the same keys, and its digest `top`; `most` is the largest size. One
    exchange a round, of at most `fanout` nodes. Where the last subtree is short, its last node stands in for the ones it lacks.
    """
    empty = F.array().cast("array<string>")
    state = nodes.withColumn("befores", empty).withColumn("afters", empty)
    span = 1
    while span < most:
        low, digit = F.col(at) % span, F.floor(F.col(at) / span) % fanout
        # the numbers that no node of the last subtree has
        alone = (F.col(at) == F.col(size) - 1) & (low < span - 1) & (F.col(size) > span)
        sent = state.withColumn("_low", F.explode(F.when(alone, F.sequence(low, F.lit(span - 1))).otherwise(F.array(low))))
        group = Window.partitionBy(*by, F.floor(F.col(at) / (span * fanout)), "_low")
        run = F.array_sort(F.collect_list(F.struct(digit.alias("digit"), F.col("top").alias("top"))).over(group))
        met = sent.withColumn("_run", run).where(F.col("_low") == low)

        def joined(nodes: Column) -> Column:
            return F.array_join(F.transform(nodes, lambda node: node["top"]), "")

        own = F.floor(F.col(at) / span) % fanout
        going = F.col(size) > span
        state = met.select(
            *by,
            at,
            size,
            F.when(going, F.sha2(joined(F.col("_run")), 256)).otherwise(F.col("top")).alias("top"),
            F.when(going, F.concat("befores", F.array(joined(F.filter("_run", lambda node: node["digit"] < own))))).otherwise(F.col("befores")).alias("befores"),
            F.when(going, F.concat("afters", F.array(joined(F.filter("_run", lambda node: node["digit"] > own))))).otherwise(F.col("afters")).alias("afters"),
        )
        span *= fanout
    return state


def manifest(
    documents: DataFrame,
    fields: list[str],
    key: str = "doc_id",
    group: str = "source",
    text: str = "text",
    tampered: Column | None = None,
    fanout: int = FANOUT,
    block_levels: int = BLOCK_LEVELS,
) -> DataFrame:
    """(key, leaf, subroot, root, proof_sha256, folded_root, verified): a row per row of `documents`.

    A leaf is the digest of `fields`. Leaves of a group (null groups are one group, and come first) ascend by `key`, nulls first, then by digest, so rows
    that are alike in every field may change places without a difference. `proof_sha256` is the digest of all siblings on the way from the leaf to the root, level by
    level, left to right. `folded_root` folds the proof with the leaf of the row as it is now: where the condition `tampered` holds, A-Z of
    `text` are in lower case (a null stays). A null key is never tampered with unless `tampered` says so. No rows give no rows; other columns take no part.
    """
    unfit = {"_leaf", "_now"} & {key, group, text, *fields}
    if unfit:
        raise ValueError(f"columns {sorted(unfit)} are names of this operator's own")
    value = {name: F.col(f"`{name}`") for name in {*fields, key, group, text}}
    changed = {name: F.translate(column, UPPER, LOWER) if name == text else column for name, column in value.items()}
    now = F.when(F.coalesce(tampered, F.lit(False)), leaf_digest([changed[name] for name in fields])) if tampered is not None else F.lit(None).cast("string")
    leaves = cut_lineage(
        documents.select(
            value[key].alias("_key"), value[group].alias("_group"), F.unhex(leaf_digest([value[name] for name in fields])).alias("_leaf"), F.unhex(now).alias("_now")
        ),
        "leaves",
    )
    spark, size = documents.sparkSession, fanout**block_levels
    ordered = numbered(leaves, [F.col("_group"), F.col("_key"), F.col("_leaf")], "_number")
    placed = _placed(ordered)
    kind = documents.schema[key].dataType.simpleString()
    group_kind = documents.schema[group].dataType.simpleString()

    def build(batches: pa.Table) -> pa.Table:
        table = batches.sort_by("_at")
        leaf = table.column("_leaf").to_pylist()
        total, number = table.column("_total")[0].as_py(), table.column("_block")[0].as_py()
        height = min(block_levels, tree_height(total, fanout))
        top = levels_of([digest.hex() for digest in leaf], fanout, height)[-1][0]
        return pa.table(
            {
                "_group": table.column("_group").slice(0, 1).combine_chunks(),
                "_block": pa.array([number], pa.int64()),
                "_total": pa.array([total], pa.int64()),
                "_keys": pa.array([table.column("_key").to_pylist()], pa.list_(table.schema.field("_key").type)),
                "_leaves": pa.array([b"".join(leaf)], pa.binary()),
                "_nows": pa.array([table.column("_now").to_pylist()], pa.list_(pa.binary())),
                "top": pa.array([top], pa.string()),
            }
        )

    schema = f"_group {group_kind}, _block long, _total long, _keys array<{kind}>, _leaves binary, _nows array<binary>, top string"
    cut = placed.withColumn("_block", F.floor(F.col("_at") / size))
    blocks = cut_lineage(cut.groupBy("_group", "_block").applyInArrow(build, schema), "blocks")

    count = F.ceil(F.col("_total") / size).cast("long")
    most = blocks.agg(F.max(count)).first()[0]
    if most is None:
        return spark.createDataFrame([], f"`{key}` {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")
    nodes = blocks.select("_group", "_block", count.alias("_blocks"), "top")
    upper = cut_lineage(butterfly(nodes, ["_group"], "_block", "_blocks", most, fanout), "upper")

    groups = numbered(upper.where("_block = 0").select("_group", "_blocks", "top"), [F.col("_group")], "_place")
    groups = groups.withColumn("_subroot", F.col("top")).withColumn("_all", F.lit(0))
    many = groups.count()
    met = butterfly(groups.select(F.col("_all"), "_place", F.lit(many).cast("long").alias("_many"), "top"), ["_all"], "_place", "_many", many, fanout)
    above = groups.select("_group", "_blocks", "_subroot", F.col("_place").alias("_of")).join(met, F.col("_of") == F.col("_place"))
    # a copy for every CHUNK blocks, so that the blocks of a large group do not meet in one task
    above = above.select(
        F.col("_group").alias("_g"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_blocks") - 1) / CHUNK))).alias("_chunk"),
        "_subroot",
        F.col("top").alias("_root"),
        F.col("befores").alias("_befores"),
        F.col("afters").alias("_afters"),
    )
    way = upper.join(above, F.col("_group").eqNullSafe(F.col("_g")) & (F.floor(F.col("_block") / CHUNK) == F.col("_chunk"))).select(
        F.col("_group").alias("_g"), F.col("_block").alias("_b"), "_subroot", "_root",
        F.concat("befores", "_befores").alias("_befores"), F.concat("afters", "_afters").alias("_afters"),
    )
    proven = blocks.drop("top").join(way, F.col("_group").eqNullSafe(F.col("_g")) & (F.col("_block") == F.col("_b")))

    def prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = {name: batch.column(name)[at] for name in batch.schema.names}
                yield _proofs(row, batch.column("_keys").type.value_type, key, fanout, block_levels)

    out = f"`{key}` {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    needed = proven.select("_total", "_keys", "_leaves", "_nows", "_subroot", "_root", "_befores", "_afters")
    return needed.mapInArrow(prove, out)


def _placed(ordered: DataFrame) -> DataFrame:
    """Numbered leaves with `_at`, the place within their group, and `_total`, the size of the group.

    Leaves stand in the order of their groups, so a group that is cut over ranges of numbers has few rows in the table of starts; leaves meet the
    start of their group by group and range, so that a large group is not one task's.
    """
    spread = 1 << 16
    ranged = ordered.withColumn("_range", F.floor(F.col("_number") / spread))
    parts = ranged.groupBy("_group", "_range").agg(F.min("_number").alias("_first"), F.count(F.lit(1)).alias("_n"))
    # a row per 65,536 leaves of a group
    whole = Window.partitionBy("_group")
    starts = parts.select(F.col("_group").alias("_g"), F.col("_range").alias("_r"), F.min("_first").over(whole).alias("_start"), F.sum("_n").over(whole).alias("_total"))
    met = ranged.join(starts, F.col("_group").eqNullSafe(F.col("_g")) & (F.col("_range") == F.col("_r")))
    return met.select("_key", "_group", "_leaf", "_now", (F.col("_number") - F.col("_start")).alias("_at"), "_total")


def _proofs(row: dict, key_type: pa.DataType, key: str, fanout: int, block_levels: int) -> pa.RecordBatch:
    """The rows of one block, with their siblings below the block's root and those above it."""
    data = row["_leaves"].as_py()
    leaves = [data[at : at + 32].hex() for at in range(0, len(data), 32)]
    nows = row["_nows"].as_py()
    height = min(block_levels, tree_height(row["_total"].as_py(), fanout))
    levels = levels_of(leaves, fanout, height)
    subroot, root = row["_subroot"].as_py(), row["_root"].as_py()
    befores = [part.encode() for part in row["_befores"].as_py()]
    afters = [part.encode() for part in row["_afters"].as_py()]
    higher = b"".join(part for pair in zip(befores, afters) for part in pair)
    # siblings of each node, joined, by level
    sides = []
    for level in levels[:height]:
        cut = []
        for at in range(len(level)):
            first = at - at % fanout
            cut.append(("".join(level[first:at]).encode(), "".join(level[at + 1 : first + fanout]).encode()))
        sides.append(cut)
    proofs, folded = [], []
    for at, (leaf, now) in enumerate(zip(leaves, nows)):
        proof, digest, place = hashlib.sha256(), (leaf if now is None else now.hex()).encode(), at
        for cut in sides:
            before, after = cut[place]
            proof.update(before)
            proof.update(after)
            digest = hashlib.sha256(before + digest + after).hexdigest().encode()
            place //= fanout
        proof.update(higher)
        for before, after in zip(befores, afters):
            digest = hashlib.sha256(before + digest + after).hexdigest().encode()
        proofs.append(proof.hexdigest())
        folded.append(digest.decode())
    size = len(leaves)
    arrays = [pa.array(row["_keys"].as_py(), key_type), pa.array(leaves), pa.array([subroot] * size), pa.array([root] * size), pa.array(proofs), pa.array(folded)]
    arrays.append(pa.array([found == root for found in folded]))
    return pa.RecordBatch.from_arrays(arrays, names=[key, "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])
