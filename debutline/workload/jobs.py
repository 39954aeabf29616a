"""Jobs bound to the given tables with SQL for what they leave behind: loads, validation, grids, predictions, logs."""

from __future__ import annotations

import datetime as dt

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from debutline.functions.dates import date_text
from debutline.operators.boost import AdaBoostModel
from debutline.operators.features import add_features
from debutline.operators.knn import KnnClassifier
from debutline.operators.models import BandText, grid_scores, metric_rows
from debutline.operators.project import matching_days, split_target
from debutline.operators.quality import counted, route_splits, schema_conforms, schema_report
from debutline.operators.ranks import numbered, rank_index
from debutline.operators.scores import macro_scores
from debutline.operators.select import order_by_list
from debutline.plans.extract import transform
from debutline.plans.prediction import archive_table, latest_table, predict
from debutline.schema import ARCHIVE_SCHEMA, KEY_COLUMN, PREDICTION_COLUMN
from debutline.session import cut_lineage, scratch_path
from debutline.sources.files import append_metrics, read_instruments, save_model, write_csv, write_json
from debutline.sources.store import Store
from debutline.workload.learning import MONTH, STORED_SQL, offerings
from debutline.workload.tables import events, lineitem, orders, table

CUSTOMER_TYPES = {"name": T.StringType(), "balance": T.DoubleType(), "segment": T.StringType()}


def seed_load(spark: SparkSession, folder: str) -> DataFrame:
    """A store seeded from a CSV of all customers and loaded with a second one of those in debt, whose segment is unknown."""
    rows = table(spark, folder, "customer").select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    seed, later = scratch_path(spark, "seed"), scratch_path(spark, "load")
    write_csv(rows, seed)
    write_csv(rows.filter("balance < 0").select("name", (F.col("balance") * 2).alias("balance"), F.lit("error").alias("segment")), later)
    store = Store(spark, scratch_path(spark, "store"), ["name"], CUSTOMER_TYPES)
    store.load_csv(seed)
    store.load_csv(later)
    return store.read().select("name", F.round("balance", 2).alias("balance"), "segment")


SEED_SQL = """
SELECT c_name AS name, round(CASE WHEN c_acctbal < 0 THEN 2 * c_acctbal ELSE c_acctbal END, 2) AS balance,
  CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS segment FROM customer
"""


def instrument_master(spark: SparkSession, folder: str) -> DataFrame:
    """All parts as a landed instrument list, read back: symbol, token and exchange of each, and that places differ."""
    path = scratch_path(spark, "instruments")
    listed = F.when(F.col("p_size") % 2 == 0, "NSE").otherwise("BSE")
    write_json(table(spark, folder, "part").select(F.col("p_brand").alias("symbol"), F.col("p_partkey").cast("string").alias("token"), listed.alias("exch_seg")), path)
    held = read_instruments(spark, path)
    return held.groupBy("symbol", "exch_seg").agg(
        F.count("token").alias("tokens"), F.sum(F.col("token").cast("bigint")).alias("token_sum"), (F.countDistinct("position") == F.count("*")).alias("ordered")
    )


INSTRUMENT_SQL = """
SELECT p_brand AS symbol, CASE WHEN p_size % 2 = 0 THEN 'NSE' ELSE 'BSE' END AS exch_seg, count(*) AS tokens,
  CAST(sum(p_partkey) AS BIGINT) AS token_sum, true AS ordered FROM part GROUP BY ALL
"""


def validated_route(spark: SparkSession, folder: str) -> DataFrame:
    """Orders cut by status, checked against two schemas and routed: a good check goes below validated/, one with a missing column below invalid/."""
    rows = orders(spark, folder).select("o_orderkey", "o_totalprice", "o_orderstatus")
    splits = {name: rows.filter(F.col("o_orderstatus") == name) for name in ("F", "O", "P")}
    found = []
    for expected in ({"o_totalprice": "double"}, {"o_totalprice": "double", "o_gone": "double"}):
        passed = all(schema_conforms(schema_report(part, expected), len(part.columns), 3) for part in splits.values())
        path = route_splits(splits, passed, scratch_path(spark, "splits"))
        for name in splits:
            held = spark.read.parquet(f"{path}/{name}")
            found.append(held.select(F.lit(path.rsplit("/", 1)[1]).alias("folder"), F.lit(name).alias("split"), "o_orderkey"))
    out = found[0]
    for part in found[1:]:
        out = out.unionByName(part)
    return out


ROUTE_SQL = """
SELECT f.folder, o_orderstatus AS split, o_orderkey FROM orders CROSS JOIN (SELECT unnest(['validated', 'invalid']) AS folder) f
WHERE o_orderstatus IN ('F', 'O', 'P')
"""


def grid_choice(spark: SparkSession, folder: str) -> DataFrame:
    """Cross-validated accuracy of six numbers of neighbours over all embeddings, three folds by id, and the chosen one."""
    rows = table(spark, folder, "embeddings").select(
        "vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("features"), F.col("label").cast("double").alias("label"), (F.col("vec_id") % 3).cast("int").alias("fold")
    )
    knn = KnnClassifier(key="vec_id")
    settings = [1, 2, 3, 5, 9, 15]
    scores = grid_scores(knn, rows, [{knn.k: k} for k in settings])
    best = scores.index(max(scores))
    found = [(k, round(score, 9), at == best) for at, (k, score) in enumerate(zip(settings, scores))]
    return spark.createDataFrame(found, "k int, accuracy double, chosen boolean")


GRID_SQL = """
WITH n AS (
  SELECT a.vec_id, a.label AS truth, a.vec_id % 3 AS fold, b.label, row_number() OVER (PARTITION BY a.vec_id ORDER BY
    list_sum(list_transform(list_zip(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), lambda x: (x[1] - x[2]) * (x[1] - x[2]))), b.vec_id) AS place
  FROM embeddings a JOIN embeddings b ON a.vec_id % 3 <> b.vec_id % 3 QUALIFY place <= 15),
v AS (SELECT k, vec_id, truth, fold, label, count(*) AS c FROM n JOIN (SELECT unnest([1, 2, 3, 5, 9, 15]) AS k) ON place <= k GROUP BY ALL),
p AS (SELECT k, fold, truth, label FROM v QUALIFY row_number() OVER (PARTITION BY k, vec_id ORDER BY c DESC, label) = 1),
f AS (SELECT k, fold, avg(CASE WHEN truth = label THEN 1.0 ELSE 0.0 END) AS a FROM p GROUP BY ALL),
g AS (SELECT k, sum(a) / 3 AS a FROM f GROUP BY k)
SELECT k, round(a, 9) AS accuracy, row_number() OVER (ORDER BY round(a, 9) DESC, k) = 1 AS chosen FROM g
"""


def offering_features(spark: SparkSession, folder: str) -> DataFrame:
    """Features derived from all stored offerings, before any imputation: percent changes and last price before the close, issue size without zeros; and the target apart."""
    held = transform(offerings(spark, folder))
    # written once, with what is returned alone: the counts and the rows would each go through the transform
    shown = add_features(held).select(KEY_COLUMN, "gmp_sum_roc", "gmp_pu_day", "IPO_issue_size", "IPO_listing_gain_category")
    inputs, target = split_target(cut_lineage(shown, "features"), "IPO_listing_gain_category")
    targets = target.agg(F.count("*").alias("n"), F.count("IPO_listing_gain_category").alias("known")).first()
    return inputs.select(
        KEY_COLUMN, F.round("gmp_sum_roc", 6).alias("gmp_sum_roc"), F.round("gmp_pu_day", 6).alias("gmp_pu_day"), "IPO_issue_size",
        F.lit(targets["n"]).alias("targets"), F.lit(targets["known"]).alias("known_targets"), F.lit("IPO_listing_gain_category" in inputs.columns).alias("leaks"),
    )


# a series holds line numbers 1 to 7, with a date each; dates run from three days before the opening on, and the close is three days after it
FEATURES_SQL = """
WITH l AS (SELECT l_orderkey, l_linenumber AS pos, round(CAST(sum(CAST(l_discount AS DECIMAL(18,2))) AS DOUBLE) * 1000) AS p FROM lineitem WHERE l_linenumber <= 7 GROUP BY 1, 2),
g AS (SELECT o_orderkey, r.pos, l.p FROM orders CROSS JOIN (SELECT unnest(range(1, 9)) AS pos) r LEFT JOIN l ON l.l_orderkey = o_orderkey AND l.pos = r.pos),
f AS (SELECT o_orderkey, min(pos) FILTER (WHERE p IS NULL OR p <> 0) AS first FROM g GROUP BY 1),
k AS (SELECT g.o_orderkey, g.pos, g.p FROM g JOIN f USING (o_orderkey) WHERE g.pos >= first AND g.pos <= 7 AND g.p IS NOT NULL AND g.pos - 4 <= 2),
c AS (SELECT *, lag(p) OVER (PARTITION BY o_orderkey ORDER BY pos) AS before FROM k),
a AS (SELECT o_orderkey, count(*) AS n, CASE WHEN bool_or(before = 0) THEN NULL ELSE sum((p - before) / before * 100) END AS roc, arg_max(p, pos) AS last FROM c GROUP BY 1),
s AS (""" + STORED_SQL + """),
t AS (SELECT count(*) AS n, count(IPO_listing_gain_category) AS known FROM s)
SELECT 'Offer ' || o.o_orderkey AS IPO_company_name, CASE WHEN a.n >= 2 THEN round(roc, 6) END AS gmp_sum_roc, CASE WHEN a.n >= 2 THEN round(last, 6) END AS gmp_pu_day,
  CASE WHEN o_orderstatus <> 'P' AND round(o_totalprice / 77, 1) <> 0 THEN round(o_totalprice / 77, 1) END AS IPO_issue_size,
  t.n AS targets, t.known AS known_targets, false AS leaks
FROM orders o LEFT JOIN a ON a.o_orderkey = o.o_orderkey CROSS JOIN t WHERE o_orderpriority <> '5-LOW'
"""


def predict_display(spark: SparkSession, folder: str) -> DataFrame:
    """A saved model with votes set by hand scores the offers of two months; both land in the archive, which is shown as the latest and the archive table."""
    store = Store(spark, scratch_path(spark, "store"))
    store.upsert(transform(offerings(spark, folder)))
    stumps = AdaBoostModel()._set(
        places=[0, 1], borders=[150.0, 700.0], low=[1.0, 1.0], high=[3.0, 2.0], weights=[2.0, 1.5], featuresCol="features", labelCol="label", predictionCol="prediction"
    )
    path = scratch_path(spark, "model")
    save_model(PipelineModel(stages=[VectorAssembler(inputCols=["IPO_issue_price", "IPO_lot_size"], outputCol="features"), stumps, BandText()]), path)
    archive = Store(spark, scratch_path(spark, "archive"), types={f.name: f.dataType for f in ARCHIVE_SCHEMA})
    predict(store, archive, path, MONTH)
    predict(store, archive, path, MONTH - dt.timedelta(days=31))
    held = archive.read_clean()
    shown = [("latest", latest_table(held, MONTH)), ("archive", archive_table(held, MONTH, dt.date(2000, 1, 1)))]
    parts = [frame.select(F.lit(name).alias("table"), *frame.columns) for name, frame in shown]
    out = parts[0].unionByName(parts[1])
    key, predicted = next(c for c in out.columns if "ompany" in c), next(c for c in out.columns if "redict" in c)
    return out.select("table", F.col(f"`{key}`").alias("offer"), F.col(f"`{predicted}`").alias("predicted"))


# two of three votes by weight: 2 for the issue price, 1.5 for the lot size; both sides may name one class
PREDICT_SQL = """
WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, round(o_totalprice / 1000, 2) AS issue, o_custkey + 1 AS lot FROM orders WHERE o_orderpriority <> '5-LOW'),
q AS (SELECT l_orderkey, count(*) FILTER (WHERE l_linenumber BETWEEN 2 AND 4) AS later FROM lineitem GROUP BY 1),
p AS (SELECT o.*, CASE WHEN issue <= 150 THEN '-20 to 0' ELSE '10 to 20' END AS predicted FROM o JOIN q ON q.l_orderkey = o_orderkey AND later > 0
      WHERE d >= DATE '2001-06-01' AND d < DATE '2001-08-01')
SELECT 'latest' AS "table", 'Offer ' || o_orderkey AS offer, predicted FROM p WHERE d >= DATE '2001-07-01'
UNION ALL SELECT 'archive', 'Offer ' || o_orderkey, predicted FROM p WHERE d <= DATE '2001-07-01'
"""


def metric_history(spark: SparkSession, folder: str) -> DataFrame:
    """Scores of return flag as a guess of line status over three splits, appended by two runs and read back."""
    split = F.element_at(F.array(F.lit("train"), F.lit("vald"), F.lit("test")), (F.col("l_orderkey") % 3 + 1).cast("int"))
    lines = lineitem(spark, folder).select(F.lit("flags").alias("model"), split.alias("split"), F.col("l_linestatus").alias("y"), F.col("l_returnflag").alias("p"), "l_quantity")
    path = scratch_path(spark, "metrics")
    for run, rows in (("all", lines), ("large", lines.filter("l_quantity > 25"))):
        append_metrics(metric_rows(macro_scores(rows, "y", "p", ("model", "split"))), path, run)
    return spark.read.parquet(path).withColumn("value", F.round("value", 9))


METRIC_SQL = """
WITH r AS (SELECT 'all' AS run_id, 0 AS least UNION ALL SELECT 'large', 25),
a AS (SELECT run_id, list_extract(['train', 'vald', 'test'], CAST(l_orderkey % 3 + 1 AS INTEGER)) AS split, l_linestatus AS y, l_returnflag AS p FROM lineitem JOIN r ON l_quantity > least),
l AS (SELECT DISTINCT run_id, split, y AS k FROM a UNION SELECT DISTINCT run_id, split, p FROM a),
c AS (SELECT l.run_id, l.split, k, count(*) FILTER (WHERE y = k AND p = k) AS tp, count(*) FILTER (WHERE p = k) AS pp, count(*) FILTER (WHERE y = k) AS yy
      FROM l JOIN a ON a.run_id = l.run_id AND a.split = l.split GROUP BY ALL),
s AS (SELECT run_id, split, avg(CASE WHEN pp + yy = 0 THEN 0 ELSE 2.0 * tp / (pp + yy) END) AS f1_score, avg(CASE WHEN pp = 0 THEN 0 ELSE tp / pp END) AS precision_score,
             avg(CASE WHEN yy = 0 THEN 0 ELSE tp / yy END) AS recall_score FROM c GROUP BY ALL)
SELECT 'flags' AS model, split, metric, round(value, 9) AS value, run_id FROM s UNPIVOT (value FOR metric IN (f1_score, precision_score, recall_score))
"""


def listed_order(spark: SparkSession, folder: str) -> DataFrame:
    """All orders in the order in which another table lists their status, by key within a status, with their places; statuses that it lacks come last.
    Beside each place: the rows of its status, the status's turn, and whether its rows lie apart from those of others."""
    listed = spark.createDataFrame([("P", 1), ("O", 2), ("P", 3)], "status string, place int")
    rows = orders(spark, folder).select("o_orderkey", "o_orderstatus")
    placed = numbered(order_by_list(rows, "o_orderstatus", listed, "status", "place", ["o_orderkey"]), "place")
    groups = placed.groupBy("o_orderstatus").agg(F.count("*").alias("rows"), F.min("place").alias("first"), F.max("place").alias("last"))
    turns = groups.select(
        F.col("o_orderstatus").alias("_status"), "rows", F.row_number().over(_by("first")).alias("turn"), (F.max("last").over(_by("first")) == F.col("last")).alias("apart")
    )
    return placed.join(turns, F.col("o_orderstatus").eqNullSafe(F.col("_status")), "left").drop("_status")


def _by(name: str):
    from pyspark.sql import Window

    return Window.orderBy(name)  # over a row per status


LISTED_SQL = """
WITH p AS (SELECT o_orderkey, o_orderstatus, CASE o_orderstatus WHEN 'P' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS listed FROM orders)
SELECT o_orderkey, o_orderstatus, row_number() OVER (ORDER BY listed, o_orderstatus NULLS LAST, o_orderkey NULLS LAST) AS place,
  count(*) OVER (PARTITION BY o_orderstatus) AS rows, CAST(dense_rank() OVER (ORDER BY listed, o_orderstatus NULLS LAST) AS INTEGER) AS turn, true AS apart
FROM p
"""


def metric_days(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of all events whose type is one of the wanted names; a name with a bracket after it is another one."""
    kind = F.when(F.col("event_id") % 5 == 0, F.concat("event_type", F.lit(" (times)"))).otherwise(F.col("event_type"))
    found = matching_days(events(spark, folder).withColumn("metric", kind), "metric", ["view", "click"])
    return found.select("event_id", "metric", date_text("day").alias("day"))


MATCHING_SQL = """
SELECT event_id, event_type AS metric, strftime(ts, '%Y-%m-%d') AS day FROM events WHERE event_id % 5 <> 0 AND (event_type LIKE 'view%' OR event_type LIKE 'click%')
"""


def observed_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Rows seen and rows kept by a write of all orders, as the write itself reports them; no second job counts."""
    seen, kept = counted(orders(spark, folder), "seen"), F.col("o_orderstatus") != "F"
    passed = counted(seen.frame.filter(kept), "kept", F.struct(F.count(F.lit(1)).alias("rows"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("price")))
    passed.frame.write.parquet(scratch_path(spark, "kept"))
    totals = passed.rows
    return spark.createDataFrame([(seen.rows, totals["rows"], float(totals["price"]))], "seen bigint, kept bigint, price double")


OBSERVED_SQL = """
SELECT count(*) AS seen, count(*) FILTER (WHERE o_orderstatus <> 'F') AS kept,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (WHERE o_orderstatus <> 'F') AS DOUBLE) AS price FROM orders
"""


def deep_page(spark: SparkSession, folder: str) -> DataFrame:
    """The last full display pages of all line items, from one index: pages near the end cost what the first one does."""
    lines = lineitem(spark, folder).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    index = rank_index(lines, [F.col("l_extendedprice").desc(), F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey")])
    number = index.total // 20
    pages = [index.page(at, 20).withColumn("page", F.lit(name)) for at, name in ((1, "first"), (number, "last"))]
    return pages[0].unionByName(pages[1])


DEEP_PAGE_SQL = """
WITH r AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
             row_number() OVER (ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey) - 1 AS n, count(*) OVER () // 20 AS pages FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, CASE WHEN n < 20 THEN 'first' ELSE 'last' END AS page
FROM r WHERE n < 20 OR (n >= (pages - 1) * 20 AND n < pages * 20)
"""

CASES = {
    "seed_load": (seed_load, SEED_SQL),
    "instrument_master": (instrument_master, INSTRUMENT_SQL),
    "validated_route": (validated_route, ROUTE_SQL),
    "grid_choice": (grid_choice, GRID_SQL),
    "offering_features": (offering_features, FEATURES_SQL),
    "predict_display": (predict_display, PREDICT_SQL),
    "metric_history": (metric_history, METRIC_SQL),
    "listed_order": (listed_order, LISTED_SQL),
    "metric_days": (metric_days, MATCHING_SQL),
    "observed_counts": (observed_counts, OBSERVED_SQL),
    "deep_page": (deep_page, DEEP_PAGE_SQL),
}
