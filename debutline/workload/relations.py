"""Upsert, lookups, windows in time, checks and splits on the given tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from debutline.functions.dates import date_text
from debutline.operators import match, merge, quality
from debutline.operators.drift import drift_free, drift_report, ks_statistics
from debutline.operators.scores import macro_scores
from debutline.operators.split import class_counts, split_rows
from debutline.workload.tables import events, lineitem, orders, table


def upsert(spark: SparkSession, folder: str) -> DataFrame:
    """All events, the last per user winning, merged into the suppliers; errors blank the balance."""
    source = table(spark, folder, "events").select(
        F.col("user_id").alias("s_suppkey"),
        F.when(F.col("event_type") != "error", F.col("value")).alias("s_acctbal"),
        F.col("event_type").alias("last_event"),
        "ts",
        "event_id",
    )
    target = table(spark, folder, "supplier")
    return merge.upsert(target, source, ["s_suppkey"], ["ts", "event_id"]).drop("ts")


UPSERT_SQL = """
WITH src AS (
  SELECT user_id, CASE WHEN event_type <> 'error' THEN value END AS bal, event_type, event_id FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)
SELECT coalesce(s_suppkey, user_id) AS s_suppkey, s_name, s_nationkey,
  CASE WHEN user_id IS NOT NULL THEN bal ELSE s_acctbal END AS s_acctbal, event_type AS last_event, event_id
FROM supplier FULL OUTER JOIN src ON s_suppkey = user_id
"""


def delete_in(spark: SparkSession, folder: str) -> DataFrame:
    """Orders without those of customers in debt, who are read from their table."""
    debtors = table(spark, folder, "customer").filter(F.col("c_acctbal") < 0)
    return merge.delete_in(orders(spark, folder), "o_custkey", debtors, "c_custkey").select("o_orderkey", "o_custkey", "o_totalprice")


DELETE_SQL = """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)
"""


def keep_in(spark: SparkSession, folder: str) -> DataFrame:
    """Line items of urgent orders."""
    urgent = orders(spark, folder).filter(match.in_list("o_orderpriority", ["1-URGENT", "2-HIGH"]))
    return merge.keep_in(lineitem(spark, folder), "l_orderkey", urgent, "o_orderkey").select("l_orderkey", "l_linenumber", "l_extendedprice")


KEEP_SQL = """
SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH'))
"""


def rows_in(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers that match some customer on nation and rounded balance sign, the name being left out."""
    suppliers = table(spark, folder, "supplier").select("s_name", F.col("s_nationkey").alias("nation"), F.round(F.col("s_acctbal") / 100).alias("level"))
    customers = table(spark, folder, "customer").select(F.col("c_name").alias("s_name"), F.col("c_nationkey").alias("nation"), F.round(F.col("c_acctbal") / 100).alias("level"))
    return merge.rows_in(suppliers, customers, ["s_name"])


ROWS_IN_SQL = """
SELECT s_name, s_nationkey AS nation, round(s_acctbal / 100) AS level FROM supplier
WHERE EXISTS (SELECT 1 FROM customer WHERE c_nationkey IS NOT DISTINCT FROM s_nationkey
              AND round(c_acctbal / 100) IS NOT DISTINCT FROM round(s_acctbal / 100))
"""


def distinct_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct user, kind and day, the event id being the surrogate."""
    rows = events(spark, folder).select(F.col("event_id").alias("_id"), "user_id", "event_type", date_text("day").alias("day"))
    return merge.distinct_rows(rows)


DISTINCT_SQL = "SELECT DISTINCT user_id, event_type, strftime(ts, '%Y-%m-%d') AS day FROM events"


def refresh_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Customers without orders, or with an order whose price is still open."""
    scraped = table(spark, folder, "customer")
    store = orders(spark, folder).withColumn("price", F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")))
    kept = match.refresh_filter(scraped, store, "c_custkey", "o_custkey", "price", "c_mktsegment", "BUILDING")
    return kept.select("c_custkey", "c_name", "c_mktsegment")


REFRESH_SQL = """
SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_mktsegment <> 'BUILDING' AND (
  c_custkey NOT IN (SELECT o_custkey FROM orders)
  OR c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P'))
"""


def lookup_first(spark: SparkSession, folder: str) -> DataFrame:
    """For each supplier the first part of the brand that carries its number."""
    suppliers = table(spark, folder, "supplier").withColumn("brand", F.concat(F.lit("Brand#"), "s_nationkey"))
    return match.lookup_first(suppliers, "brand", table(spark, folder, "part"), "p_brand", ["p_partkey", "p_name"], ["p_partkey"]).select(
        "s_suppkey", "brand", "p_partkey", "p_name"
    )


LOOKUP_SQL = """
WITH first AS (SELECT p_brand, p_partkey, p_name FROM part QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) = 1)
SELECT s_suppkey, 'Brand#' || s_nationkey AS brand, p_partkey, p_name
FROM supplier LEFT JOIN first ON p_brand = 'Brand#' || s_nationkey
"""


def link_zip(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with details joined by key: first line item, customer, and a replaced status."""
    lines = lineitem(spark, folder).select("l_orderkey", "l_extendedprice", "l_shipdate", "l_linenumber", "l_partkey", "l_linestatus")
    out = match.attach(orders(spark, folder), lines, "o_orderkey", "l_orderkey", ["l_linenumber", "l_partkey", "l_extendedprice"])
    out = match.attach(out, table(spark, folder, "customer").select("c_custkey", "c_name").withColumn("at", F.lit(0)), "o_custkey", "c_custkey", ["at"])
    out = match.replace_by_lookup(out, "o_orderstatus", "o_orderkey", lines, "l_orderkey", "l_linestatus", ["l_linenumber", "l_partkey", "l_extendedprice"])
    return out.select("o_orderkey", "o_orderstatus", "c_name", date_text("l_shipdate").alias("shipped"))


LINK_ZIP_SQL = """
WITH f AS (SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_extendedprice) = 1)
SELECT o_orderkey, l_linestatus AS o_orderstatus, c_name, strftime(l_shipdate, '%Y-%m-%d') AS shipped
FROM orders LEFT JOIN f ON l_orderkey = o_orderkey LEFT JOIN customer ON c_custkey = o_custkey
"""


def first_in_window(spark: SparkSession, folder: str) -> DataFrame:
    """For each signup the first other event of the user within an hour."""
    all_events = table(spark, folder, "events")
    starts = all_events.filter(F.col("event_type") == "signup").select("event_id", "user_id", "ts")
    others = all_events.filter(F.col("event_type") != "signup").select("user_id", "ts", "value", "event_id")
    return match.first_within(starts, others, ["user_id"], "ts", "ts", "value", dt.timedelta(hours=1), "event_id").select(
        "event_id", "user_id", "first_value"
    )


FIRST_IN_WINDOW_SQL = """
WITH s AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'signup'),
o AS (SELECT user_id, ts, value, event_id FROM events WHERE event_type <> 'signup'),
m AS (
  SELECT s.event_id, o.value FROM s JOIN o ON o.user_id = s.user_id AND o.ts >= s.ts AND o.ts <= s.ts + INTERVAL 1 HOUR
  QUALIFY row_number() OVER (PARTITION BY s.event_id ORDER BY o.ts, o.event_id) = 1)
SELECT s.event_id, s.user_id, m.value AS first_value FROM s LEFT JOIN m ON m.event_id = s.event_id
"""


def listing_price(spark: SparkSession, folder: str) -> DataFrame:
    """Events as offers: the first reading of the user's instrument between 09:00 and 10:00 that day."""
    all_events = events(spark, folder)
    instruments = table(spark, folder, "customer").select(
        F.col("c_custkey").cast("string").alias("symbol"), F.col("c_name").alias("token"), F.col("c_mktsegment").alias("exch_seg"), F.col("c_custkey").alias("position")
    )
    candles = all_events.join(table(spark, folder, "customer"), F.col("user_id") == F.col("c_custkey")).select(
        F.col("c_mktsegment").alias("exchange"), F.col("c_name").alias("token"), "ts", F.col("value").alias("open")
    )
    offers = all_events.select(
        "event_id",
        F.when(F.col("event_type") == "view", F.lit("")).otherwise(F.col("user_id").cast("string")).alias("nse_symbol"),
        F.when(F.col("event_type") != "click", F.col("user_id").cast("string")).alias("bse_symbol"),
        F.col("day").alias("IPO_list_date"),
    )
    return match.listing_prices(offers, instruments, candles).select("event_id", F.col("IPO_listing_price").alias("price"))


LISTING_SQL = """
WITH first AS (
  SELECT user_id, CAST(ts AS DATE) AS day, value FROM events
  WHERE CAST(date_trunc('second', ts) AS TIME) BETWEEN TIME '09:00:00' AND TIME '10:00:00'
    AND user_id IN (SELECT c_custkey FROM customer)
  QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, value) = 1)
SELECT e.event_id, f.value AS price FROM events e
LEFT JOIN first f ON f.user_id = e.user_id AND f.day = CAST(e.ts AS DATE)
"""


def attempts(spark: SparkSession, folder: str) -> DataFrame:
    """A user's events of one day as attempts; errors and small values are failures."""
    tries = events(spark, folder).groupBy("user_id", "day", F.hour("ts").alias("attempt_no")).agg(
        F.max(F.when((F.col("event_type") != "error") & (F.col("value") > 60), F.col("value"))).alias("value")
    )
    return match.settle_attempts(tries, ["user_id", "day"]).select("user_id", date_text("day").alias("day"), "value")


ATTEMPTS_SQL = """
WITH t AS (
  SELECT user_id, CAST(ts AS DATE) AS day, hour(ts) AS n, max(CASE WHEN event_type <> 'error' AND value > 60 THEN value END) AS v
  FROM events GROUP BY ALL),
ok AS (SELECT * FROM t WHERE v IS NOT NULL AND n <= 11 QUALIFY row_number() OVER (PARTITION BY user_id, day ORDER BY n) = 1)
SELECT k.user_id, strftime(k.day, '%Y-%m-%d') AS day, ok.v AS value
FROM (SELECT DISTINCT user_id, day FROM t) k LEFT JOIN ok ON ok.user_id = k.user_id AND ok.day = k.day
"""


def null_counts(spark: SparkSession, folder: str) -> DataFrame:
    rows = events(spark, folder).withColumns(
        {"reading": F.when(F.col("value") > 20, F.col("value")), "kind": F.when(F.col("event_type") != "error", F.col("event_type"))}
    )
    return quality.null_counts(rows, ["user_id", "reading", "kind", "ts"])


NULL_COUNTS_SQL = """
SELECT 'user_id' AS "column", count(*) AS total, count(*) - count(user_id) AS nulls FROM events
UNION ALL SELECT 'reading', count(*), count(*) FILTER (WHERE NOT coalesce(value > 20, false)) FROM events
UNION ALL SELECT 'kind', count(*), count(*) FILTER (WHERE NOT coalesce(event_type <> 'error', false)) FROM events
UNION ALL SELECT 'ts', count(*), count(*) - count(ts) FROM events
"""


def schema_check(spark: SparkSession, folder: str) -> DataFrame:
    """Event text columns against number, date and missing columns."""
    rows = table(spark, folder, "events").select(
        "event_id",
        F.when(F.col("value") > 50, F.col("event_type")).otherwise(F.col("value").cast("string")).alias("value"),
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
        F.when(F.col("event_type") != "view", F.col("props")).alias("props"),
    )
    expected = {"event_id": T.LongType(), "value": T.DoubleType(), "day": T.DateType(), "props": T.IntegerType(), "absent": T.StringType()}
    return quality.schema_report(rows, expected)


SCHEMA_SQL = """
SELECT 'event_id' AS "column", true AS present, count(*) AS total, 0 AS nulls, 0 AS bad_casts FROM events
UNION ALL SELECT 'value', true, count(*), 0, count(*) FILTER (WHERE value > 50) FROM events
UNION ALL SELECT 'day', true, count(*), 0, 0 FROM events
UNION ALL SELECT 'props', true, count(*), count(*) FILTER (WHERE event_type = 'view'),
  count(*) FILTER (WHERE event_type <> 'view' AND TRY_CAST(props AS INTEGER) IS NULL) FROM events
UNION ALL SELECT 'absent', false, count(*), count(*), 0 FROM events
"""

DRIFT_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def ks_drift(spark: SparkSession, folder: str) -> DataFrame:
    """Largest distribution gap between finished and open line items, per numeric column."""
    lines = lineitem(spark, folder)
    found = ks_statistics(lines.filter("l_linestatus = 'F'"), lines.filter("l_linestatus <> 'F'"), DRIFT_COLUMNS)
    rows = [(r["column"], r["n_base"], r["n_current"], round(r["statistic"], 9)) for r in found]
    return spark.createDataFrame(rows, "column string, n_base bigint, n_current bigint, statistic double")


KS_PART = """
SELECT '{c}' AS "column", any_value(n1) AS n_base, any_value(n2) AS n_current, round(max(abs(s1 / n1 - s2 / n2)), 9) AS statistic
FROM (
  SELECT v, sum(CAST(c1 AS DOUBLE)) OVER w AS s1, sum(CAST(c2 AS DOUBLE)) OVER w AS s2,
         CAST(sum(c1) OVER () AS BIGINT) AS n1, CAST(sum(c2) OVER () AS BIGINT) AS n2
  FROM (SELECT {c} AS v, count(*) FILTER (WHERE l_linestatus = 'F') AS c1, count(*) FILTER (WHERE l_linestatus <> 'F') AS c2
        FROM lineitem GROUP BY 1)
  WINDOW w AS (ORDER BY v))
"""
KS_SQL = "UNION ALL".join(KS_PART.format(c=name) for name in DRIFT_COLUMNS)


def drift_table(spark: SparkSession, folder: str) -> DataFrame:
    """The drift report of finished and open line items: like columns, one that moved, one that was cut, one with unknown values."""
    moved = lineitem(spark, folder).withColumns(
        {
            "moved": F.col("l_extendedprice") + F.when(F.col("l_linestatus") == "F", 0.0).otherwise(F.col("l_quantity") * 5),
            "cut": F.when((F.col("l_linestatus") == "F") | (F.col("l_tax") < 0.07), F.col("l_tax")).otherwise(0.0),
            "gap": F.when(F.col("l_quantity") > 1, F.col("l_quantity")),
        }
    )
    report = drift_report(moved.filter("l_linestatus = 'F'"), moved.filter("l_linestatus <> 'F'"), [*DRIFT_COLUMNS, *MOVED_COLUMNS])
    rounded = report.withColumns({"statistic": F.round("statistic", 9), "p_value": F.round("p_value", 6)})
    return rounded.withColumn("all_clear", F.lit(drift_free(report)))


MOVED_COLUMNS = ["moved", "cut", "gap"]
REPORT_PART = """
SELECT '{c}' AS "column", any_value(n1) AS n_base, any_value(n2) AS n_current,
  CASE WHEN any_value(nulls) = 0 THEN max(abs(s1 / n1 - s2 / n2)) END AS d
FROM (
  SELECT v, sum(CAST(c1 AS DOUBLE)) OVER w AS s1, sum(CAST(c2 AS DOUBLE)) OVER w AS s2, sum(CASE WHEN v IS NULL THEN c1 + c2 ELSE 0 END) OVER () AS nulls,
         CAST(sum(c1) OVER () AS BIGINT) AS n1, CAST(sum(c2) OVER () AS BIGINT) AS n2
  FROM (SELECT {c} AS v, count(*) FILTER (WHERE l_linestatus = 'F') AS c1, count(*) FILTER (WHERE l_linestatus <> 'F') AS c2
        FROM m GROUP BY 1)
  WINDOW w AS (ORDER BY v))
"""
REPORT_SQL = f"""
WITH m AS (SELECT *, l_extendedprice + CASE WHEN l_linestatus = 'F' THEN 0.0 ELSE l_quantity * 5 END AS moved,
  CASE WHEN l_linestatus = 'F' OR l_tax < 0.07 THEN l_tax ELSE 0.0 END AS cut, CASE WHEN l_quantity > 1 THEN l_quantity END AS gap FROM lineitem),
k AS ({"UNION ALL".join(REPORT_PART.format(c=name) for name in [*DRIFT_COLUMNS, *MOVED_COLUMNS])}),
s AS (SELECT *, round(CAST(n_base AS DOUBLE) * n_current / (n_base + n_current)) AS size FROM k),
z AS (SELECT *, d * sqrt(size) + 1 / (6 * sqrt(size)) + (d * sqrt(size) - 1) / (4 * size) AS z FROM s),
p AS (SELECT *, CASE WHEN d IS NULL THEN NULL WHEN z < 0.2 THEN 1.0 ELSE greatest(0.0, least(1.0,
  list_sum(list_transform(range(1, 101), lambda i: 2 * pow(-1, i - 1) * exp(-2 * pow(i * z, 2)))))) END AS p FROM z)
SELECT "column", n_base, n_current, round(d, 9) AS statistic, round(p, 6) AS p_value, p < 0.05 AS drift_status,
  CASE WHEN d IS NULL THEN 'Skipped due to NaN values' END AS note, (SELECT count(*) = 0 FROM p WHERE p < 0.05) AS all_clear
FROM p
"""


def split_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Sizes of the exact split of all orders: training rows per class, the other parts as a whole."""
    rows = split_rows(orders(spark, folder), ["o_orderkey"], "o_orderpriority")
    label = F.when(F.col("split") == "train", F.col("o_orderpriority")).otherwise("all")
    return rows.groupBy("split", label.alias("class")).agg(F.count(F.lit(1)).alias("rows"))


SPLIT_SQL = """
WITH c AS (SELECT o_orderpriority AS class, count(*) AS n FROM orders GROUP BY 1),
q AS (SELECT class, n, CAST(floor(0.7 * n) AS BIGINT) AS base, 0.7 * n - floor(0.7 * n) AS rest FROM c),
t AS (SELECT CAST(floor(0.7 * sum(n)) AS BIGINT) AS train, sum(n) AS n FROM c),
r AS (SELECT class, base + CASE WHEN row_number() OVER (ORDER BY rest DESC, class) <= (SELECT train FROM t) - (SELECT sum(base) FROM q)
                            THEN 1 ELSE 0 END AS rows FROM q),
s AS (SELECT n - train AS left_over FROM t)
SELECT 'train' AS split, class, CAST(rows AS BIGINT) AS rows FROM r
UNION ALL SELECT 'test', 'all', CAST(ceil(0.5 * left_over) AS BIGINT) FROM s
UNION ALL SELECT 'vald', 'all', CAST(left_over - ceil(0.5 * left_over) AS BIGINT) FROM s
"""


def class_distribution(spark: SparkSession, folder: str) -> DataFrame:
    return class_counts(orders(spark, folder), "o_orderpriority")


CLASS_SQL = "SELECT o_orderpriority, count(*) AS rows FROM orders GROUP BY 1"


def macro(spark: SparkSession, folder: str) -> DataFrame:
    """Scores of return flag as a guess of line status, and of toxic as a guess of quality."""
    lines = lineitem(spark, folder).select(
        F.lit("lineitem").alias("source"), F.col("l_linestatus").alias("y"), F.col("l_returnflag").alias("p")
    )
    labels = table(spark, folder, "labels").select(
        F.lit("labels").alias("source"), F.col("quality").cast("string").alias("y"), F.col("toxic").cast("string").alias("p")
    )
    scores = macro_scores(lines.unionByName(labels), "y", "p", ("source",))
    return scores.select("source", *[F.round(name, 9).alias(name) for name in ("f1_score", "precision_score", "recall_score")])


MACRO_SQL = """
WITH a AS (SELECT 'lineitem' AS source, l_linestatus AS y, l_returnflag AS p FROM lineitem
           UNION ALL SELECT 'labels', CAST(quality AS VARCHAR), CAST(toxic AS VARCHAR) FROM labels),
l AS (SELECT source, y AS k FROM a UNION SELECT source, p FROM a),
c AS (SELECT l.source, k, count(*) FILTER (WHERE y = k AND p = k) AS tp, count(*) FILTER (WHERE p = k) AS pp, count(*) FILTER (WHERE y = k) AS yy
      FROM l JOIN a ON a.source = l.source GROUP BY l.source, k)
SELECT source, round(avg(CASE WHEN pp + yy = 0 THEN 0 ELSE 2.0 * tp / (pp + yy) END), 9) AS f1_score,
  round(avg(CASE WHEN pp = 0 THEN 0 ELSE tp / pp END), 9) AS precision_score,
  round(avg(CASE WHEN yy = 0 THEN 0 ELSE tp / yy END), 9) AS recall_score
FROM c GROUP BY source
"""

CASES = {
    "upsert": (upsert, UPSERT_SQL),
    "delete_in": (delete_in, DELETE_SQL),
    "keep_in": (keep_in, KEEP_SQL),
    "rows_in": (rows_in, ROWS_IN_SQL),
    "distinct_rows": (distinct_rows, DISTINCT_SQL),
    "refresh_filter": (refresh_filter, REFRESH_SQL),
    "lookup_first": (lookup_first, LOOKUP_SQL),
    "link_zip": (link_zip, LINK_ZIP_SQL),
    "first_in_window": (first_in_window, FIRST_IN_WINDOW_SQL),
    "listing_price": (listing_price, LISTING_SQL),
    "attempts": (attempts, ATTEMPTS_SQL),
    "null_counts": (null_counts, NULL_COUNTS_SQL),
    "schema_check": (schema_check, SCHEMA_SQL),
    "ks_drift": (ks_drift, KS_SQL),
    "drift_table": (drift_table, REPORT_SQL),
    "split_counts": (split_counts, SPLIT_SQL),
    "class_distribution": (class_distribution, CLASS_SQL),
    "macro_scores": (macro, MACRO_SQL),
}
