"""Incremental refresh: landed extracts are transformed and merged as they arrive."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from debutline.operators.match import refresh_filter
from debutline.operators.merge import last_per_key
from debutline.plans.extract import LATEST, transform
from debutline.sources.store import Store


def refresh_stream(
    spark: SparkSession,
    landing: str,
    schema: T.StructType,
    store: Store,
    checkpoint: str,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    order_by: Sequence[str] | None = None,
    keep_order_columns: bool = True,
    files_per_batch: int | None = None,
    file_format: str = "parquet",
) -> StreamingQuery:
    """Merge every file that has landed since the last run, then stop.

    The store is the keyed state of the stream: a batch reads and writes the buckets of its own keys. The store also keeps a ledger of merged batches, so one that
    is run again after a failure is left out, and with `order_by` the order values of each row, so rows that land late never undo newer ones.
    """
    reader = spark.readStream.format(file_format).schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def merge(batch: DataFrame, number: int) -> None:
        rows = prepare(batch) if prepare else batch
        store.upsert(rows, order_by, keep_order_columns, newest=order_by is not None, batch=f"{checkpoint}#{number}")

    return (
        reader.load(landing)
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def offering_refresh(spark: SparkSession, landing: str, schema: T.StructType, store: Store, checkpoint: str) -> StreamingQuery:
    """Landed extract rows: keep new and unfinished offers, transform them, merge them by name.

    Of several rows of one offer in a batch that with the latest dates counts.
    """

    def prepare(batch: DataFrame) -> DataFrame:
        wanted = batch.select("Company_name", "IPO_category").dropDuplicates()
        names = refresh_filter(wanted, store.read()).select("Company_name")
        return last_per_key(transform(batch.join(names, "Company_name", "left_semi")), store.keys, LATEST)

    return refresh_stream(spark, landing, schema, store, checkpoint, prepare)
