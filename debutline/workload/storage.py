"""Files, the versioned store and the stream on the given tables."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from debutline.operators.merge import distinct_rows
from debutline.operators.project import clean_stored, stored_text
from debutline.session import scratch_path
from debutline.sources.files import read_csv_text, read_features, write_csv, write_features, write_json
from debutline.sources.store import Store
from debutline.streaming.refresh import refresh_stream
from debutline.workload.tables import events, table

USER_TYPES = {"user_id": T.LongType(), "value": T.DoubleType(), "kind": T.StringType(), "day": T.DateType()}


def _changes(df: DataFrame) -> DataFrame:
    """Events as changes of a user's row; errors blank the value."""
    return df.select(
        "user_id",
        F.when(F.col("event_type") != "error", F.col("value")).alias("value"),
        F.col("event_type").alias("kind"),
        F.col("ts").cast("date").alias("day"),
        "ts",
        "event_id",
    )


def collection_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Stored text of all events, each held twice under another surrogate id, cleaned and typed."""
    rows = events(spark, folder).select(
        F.col("event_id").alias("_id"),
        F.col("event_id").cast("string").alias("event_id"),
        F.when(F.col("event_type") == "view", F.lit("nan")).otherwise(F.col("value").cast("string")).alias("value"),
        F.when(F.col("value") > 100, F.lit("2024-13-45")).otherwise(F.date_format("day", "yyyy-MM-dd")).alias("day"),
        F.col("event_type").alias("kind"),
    )
    doubled = rows.unionByName(rows.withColumn("_id", F.col("_id") + F.lit(1_000_000_000)))
    types = {"event_id": T.LongType(), "value": T.DoubleType(), "day": T.DateType(), "kind": T.StringType()}
    out = clean_stored(distinct_rows(doubled), types)
    return out.select("event_id", "value", F.date_format("day", "yyyy-MM-dd").alias("day"), "kind")


SCAN_SQL = """
SELECT event_id, CASE WHEN event_type <> 'view' THEN value END AS value,
  CASE WHEN value <= 100 THEN strftime(ts, '%Y-%m-%d') END AS day, CASE WHEN event_type <> 'error' THEN event_type END AS kind
FROM events
"""


def csv_round(spark: SparkSession, folder: str) -> DataFrame:
    """All documents, whole texts with their line breaks, through a CSV file and back, quotes and commas included."""
    path = scratch_path(spark, "csv")
    rows = table(spark, folder, "documents").select(
        "doc_id", F.concat(F.lit('"'), "lang", F.lit('", '), "source").alias("tag"), F.when(F.col("n_chars") > 500, F.col("n_chars").cast("string")).otherwise("error").alias("n_chars"), "text"
    )
    write_csv(rows, path)
    types = {"doc_id": T.LongType(), "tag": T.StringType(), "n_chars": T.DoubleType(), "text": T.StringType()}
    text = T.StructType([T.StructField(name, T.StringType()) for name in types])
    return clean_stored(read_csv_text(spark, path, text), types).select("doc_id", "tag", "n_chars", F.md5("text").alias("text_md5"), F.length("text").alias("text_chars"))


CSV_SQL = """
SELECT doc_id, '"' || lang || '", ' || source AS tag, CASE WHEN n_chars > 500 THEN CAST(n_chars AS DOUBLE) END AS n_chars,
  md5(text) AS text_md5, CAST(length(text) AS INTEGER) AS text_chars FROM documents
"""


def stored_form(spark: SparkSession, folder: str) -> DataFrame:
    """All events in the form a stored table keeps, written as JSON, read as text and typed again."""
    path = scratch_path(spark, "stored")
    rows = events(spark, folder).select("event_id", "event_type", "value", "day")
    kept = stored_text(rows)
    write_json(kept, path)
    types = {"event_id": T.LongType(), "event_type": T.StringType(), "value": T.DoubleType(), "day": T.DateType()}
    text = T.StructType([T.StructField(name, T.StringType()) for name in types])
    typed = clean_stored(spark.read.schema(text).json(path), types)
    return typed.select("event_id", "value", F.date_format("day", "yyyy-MM-dd").alias("day"), "event_type")


STORED_FORM_SQL = """
SELECT event_id, value, strftime(ts, '%Y-%m-%d') AS day, CASE WHEN event_type <> 'error' THEN event_type END AS event_type FROM events
"""


def feature_matrix(spark: SparkSession, folder: str) -> DataFrame:
    """All embeddings as a feature matrix, written and read back: its label, size and both ends."""
    path = scratch_path(spark, "matrix")
    rows = table(spark, folder, "embeddings").select(
        array_to_vector(F.col("embedding").cast("array<double>")).alias("features"), F.col("label").cast("double").alias("label"), F.col("vec_id").cast("string").alias("split")
    )
    write_features(rows, path)
    values = vector_to_array("features")
    return read_features(spark, path).select(
        F.col("split").cast("long").alias("vec_id"), "label", F.size(values).alias("width"), values[0].alias("first"), F.element_at(values, -1).alias("last")
    )


MATRIX_SQL = """
SELECT vec_id, CAST(label AS DOUBLE) AS label, CAST(len(embedding) AS INTEGER) AS width, CAST(embedding[1] AS DOUBLE) AS first, CAST(embedding[-1] AS DOUBLE) AS last
FROM embeddings
"""


def store_cycle(spark: SparkSession, folder: str) -> DataFrame:
    """Three versions: users from customers, merged with all events, then purchasers deleted."""
    store = Store(spark, scratch_path(spark, "store"), ["user_id"], USER_TYPES)
    first = table(spark, folder, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_acctbal").alias("value"), F.col("c_name").alias("name"))
    store.upsert(first)
    store.upsert(_changes(table(spark, folder, "events")), ["ts", "event_id"], keep_order_columns=False)
    poor = table(spark, folder, "customer").filter(F.col("c_acctbal") < 0)
    store.delete_in("user_id", poor, "c_custkey")
    return store.read_clean().select("user_id", "value", "kind", F.date_format("day", "yyyy-MM-dd").alias("day"), "name")


LAST = """
SELECT user_id, CASE WHEN event_type <> 'error' THEN value END AS value, event_type AS kind, strftime(ts, '%Y-%m-%d') AS day FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
"""
STORE_SQL = f"""
WITH s AS ({LAST})
SELECT coalesce(s.user_id, c_custkey) AS user_id, CASE WHEN s.user_id IS NOT NULL THEN s.value ELSE c_acctbal END AS value,
  CASE WHEN kind <> 'error' THEN kind END AS kind, day, c_name AS name
FROM customer FULL OUTER JOIN s ON s.user_id = c_custkey
WHERE c_acctbal IS NULL OR c_acctbal >= 0
"""


def stream_refresh(spark: SparkSession, folder: str) -> DataFrame:
    """All events landed as three files in time order, merged one micro-batch per file."""
    landing, rows = scratch_path(spark, "landing"), events(spark, folder)
    for low, high in (("2000-01-01", "2024-01-11"), ("2024-01-11", "2024-01-21"), ("2024-01-21", "2100-01-01")):
        part = rows.filter((F.col("day") >= F.lit(low).cast("date")) & (F.col("day") < F.lit(high).cast("date")))
        part.drop("day").coalesce(1).write.mode("append").parquet(landing)
    store = Store(spark, scratch_path(spark, "store"), ["user_id"], USER_TYPES)
    schema = rows.drop("day").schema
    stream = refresh_stream(
        spark, landing, schema, store, scratch_path(spark, "progress"), _changes, ["ts", "event_id"],
        keep_order_columns=False, files_per_batch=1,
    )
    stream.awaitTermination()
    return store.read().select("user_id", "value", "kind", F.date_format("day", "yyyy-MM-dd").alias("day"))


CASES = {
    "collection_scan": (collection_scan, SCAN_SQL),
    "csv_round": (csv_round, CSV_SQL),
    "stored_form": (stored_form, STORED_FORM_SQL),
    "feature_matrix": (feature_matrix, MATRIX_SQL),
    "store_cycle": (store_cycle, STORE_SQL),
    "stream_refresh": (stream_refresh, LAST),
}
