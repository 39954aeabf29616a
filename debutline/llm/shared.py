"""Small helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from debutline.session import scratch_path

__all__ = ["cut_lineage", "discard", "scratch_path", "table", "text_bytes", "shards", "numbered", "picked"]


def cut_lineage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write `df` once to the shared folder, well packed, and read it back, so that retries start from files."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all rows of a string or binary column and the offsets between rows; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def shards(batches: Iterator[pa.RecordBatch], text: str, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of at most `most_bytes` bytes of `text`; a longer text is a shard of its own, whole."""
    for batch in batches:
        _, offsets = text_bytes(batch.column(text))
        at = 0
        while at < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[at] + most_bytes, side="right")) - 1
            end = min(max(end, at + 1), batch.num_rows)
            yield batch.slice(at, end - at)
            at = end


def numbered(rows: DataFrame, by: list[Column], name: str, tasks: int | None = None) -> DataFrame:
    """`rows` with `name` = 0, 1, 2, ... in the order of `by`, without bringing all rows into one task.

    The rows are dealt by ranges and written once in the shared folder; only the number of rows of each range comes to
    the driver. `by` must name columns of `rows` that tell all rows apart, or rows that are alike in every way.
    """
    spark = rows.sparkSession
    parts = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    held = cut_lineage(
        rows.repartitionByRange(parts, *by).sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id()), "numbered"
    )
    range_of = F.shiftright("_at", 33)
    counts = sorted((row[0], row[1]) for row in held.groupBy(range_of.alias("part")).count().collect())
    starts, total = {}, 0
    for part, count in counts:
        starts[part], total = total, total + count
    if not starts:
        return held.withColumn(name, F.lit(0).cast("long")).drop("_at")
    first = F.create_map(*[F.lit(x) for pair in starts.items() for x in pair])
    in_range = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return held.withColumn(name, F.element_at(first, range_of.cast("int" if all(p < 2**31 for p in starts) else "long")) + in_range).drop("_at")


def picked(documents: DataFrame, chosen: DataFrame, text: str, keys: list[str]) -> DataFrame:
    """The rows of `documents` that `chosen` names, each `_times` times.

    `chosen` has a row per (keys, `_hash`), with `_hash` the xxhash64 of the text, and `_rows`, how many rows of `documents` that is. Repeated rows
    (alike in keys and text) are one row, that of the least hash of all its columns, taken `_times` times; only those are brought together. Texts are shuffled
    once, and no copy of the documents is written. Columns of `documents` may have any names: they travel under others.
    """
    columns = documents.columns
    plain = documents.select(*[F.col(f"`{name}`").alias(f"_c{at}") for at, name in enumerate(columns)])
    held_as = {name: f"_c{at}" for at, name in enumerate(columns)}
    chosen = chosen.select(*[F.col(f"`{key}`").alias(f"_key_{at}") for at, key in enumerate(keys)], F.col("_hash").alias("_of"), "_times", "_rows")
    hashed = plain.withColumn("_hash", F.xxhash64(held_as[text]))
    on = F.col("_hash") == F.col("_of")
    for at, key in enumerate(keys):
        on = on & F.col(held_as[key]).eqNullSafe(F.col(f"_key_{at}"))
    # the choice grows with the documents, so the plan is the same at every size: both sides dealt by their keys
    held = hashed.join(chosen.hint("merge"), on)
    names = list(held_as.values())
    out = held.where("_rows = 1").select(*names, "_times")
    if not chosen.where("_rows > 1").isEmpty():
        whole = F.struct(*names)
        least = F.min_by(F.struct(*names, "_times"), F.xxhash64(whole))
        again = held.where("_rows > 1").groupBy(*(f"_key_{at}" for at in range(len(keys))), "_of").agg(least.alias("_row"))
        out = out.unionAll(again.select("_row.*"))
    taken = out.select(*names, F.explode(F.sequence(F.lit(1), F.col("_times").cast("int"))).alias("_copy"))
    return taken.select(*[F.col(name).alias(given) for given, name in held_as.items()])


def discard(spark: SparkSession, path: str) -> None:
    """Drop a folder of the shared folder that a later table has replaced."""
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
