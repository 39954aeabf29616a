"""Day series built from the given tables: squeeze, trim, sort, change, first and last."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from debutline.functions import series
from debutline.functions.dates import date_text
from debutline.operators import reshape
from debutline.operators.features import add_series_features
from debutline.workload.tables import events, exact_sum, lineitem

CLOSE = dt.date(2024, 1, 21)


def daily_purchases(spark: SparkSession, folder: str) -> DataFrame:
    """Per user the sum of purchases of each active day: 0 on days without one, unknown on days that
    saw only errors."""
    spent = F.coalesce(
        F.sum(F.when(F.col("event_type") == "purchase", F.col("value")).cast("decimal(18,2)")).cast("double"), F.lit(0.0)
    )
    price = F.when(F.count_if(F.col("event_type") != "error") > 0, spent)
    return reshape.day_series(events(spark, folder), ["user_id"], "day", price)


DAILY = """
d AS (
  SELECT user_id, CAST(ts AS DATE) AS day,
    CASE WHEN count(*) FILTER (WHERE event_type <> 'error') > 0
      THEN coalesce(CAST(sum(CAST(value AS DECIMAL(18,2))) FILTER (WHERE event_type = 'purchase') AS DOUBLE), 0.0) END AS price
  FROM events GROUP BY ALL),
"""


def squeeze_days(spark: SparkSession, folder: str) -> DataFrame:
    """Each user's series cut to three days."""
    out = daily_purchases(spark, folder).withColumn(
        "three", series.squeeze_days(F.transform("pairs", lambda p: F.when(p["price"] > 0, p["price"])))
    )
    return out.select("user_id", "three.day1", "three.day2", "three.day3")


SQUEEZE_SQL = f"""
WITH {DAILY}
n AS (SELECT user_id, CASE WHEN price > 0 THEN price END AS v, row_number() OVER (PARTITION BY user_id ORDER BY day) AS r FROM d),
k AS (SELECT user_id, v, row_number() OVER (PARTITION BY user_id ORDER BY r DESC) AS back FROM n WHERE r > 1 AND v IS NOT NULL),
p AS (SELECT user_id, max(v) FILTER (WHERE back = 1) AS last, max(v) FILTER (WHERE back = 2) AS before FROM k GROUP BY 1)
SELECT n.user_id, n.v AS day1, coalesce(before, last) AS day2, last AS day3
FROM n LEFT JOIN p ON p.user_id = n.user_id WHERE n.r = 1
"""


def trim_zeros(spark: SparkSession, folder: str) -> DataFrame:
    """Series without their leading zeros, padded at the end, one row per place."""
    out = daily_purchases(spark, folder).withColumn("pairs", series.trim_leading_zeros("pairs"))
    return reshape.long_from_pairs(out, ["user_id"]).select("user_id", "day", date_text("date").alias("date"), "price")


TRIM_SQL = f"""
WITH {DAILY}
n AS (SELECT user_id, day, price, row_number() OVER (PARTITION BY user_id ORDER BY day) AS r FROM d),
f AS (SELECT user_id, min(r) FILTER (WHERE price IS NULL OR price <> 0) AS first FROM n GROUP BY 1),
s AS (SELECT n.user_id, n.r, first FROM n JOIN f ON f.user_id = n.user_id WHERE first IS NOT NULL)
SELECT s.user_id, CAST(s.r AS INTEGER) AS day, strftime(n.day, '%Y-%m-%d') AS date, n.price
FROM s LEFT JOIN n ON n.user_id = s.user_id AND n.r = s.r + s.first - 1
"""


def sort_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Per order the line items as (date, price) in line order, returned lines undated, then sorted by
    date with the undated last."""
    lines = lineitem(spark, folder)
    dated = lines.groupBy("l_orderkey", "l_linenumber").agg(
        F.max("day").alias("day"), exact_sum("l_extendedprice").alias("price"), F.max("l_returnflag").alias("flag")
    )
    dated = dated.withColumn("day", F.when(F.col("flag") != "R", F.col("day")))
    gathered = reshape.gather_pairs(dated, ["l_orderkey"], "l_linenumber", "day", "price")
    sorted_pairs = gathered.withColumn("pairs", series.sort_pairs("pairs"))
    return reshape.long_from_pairs(sorted_pairs, ["l_orderkey"]).select("l_orderkey", "day", date_text("date").alias("date"), "price")


SORT_SQL = """
WITH g AS (
  SELECT l_orderkey, l_linenumber, CASE WHEN max(l_returnflag) <> 'R' THEN max(CAST(l_shipdate AS DATE)) END AS day,
         CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS price
  FROM lineitem GROUP BY 1, 2)
SELECT l_orderkey, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY day NULLS LAST, l_linenumber) AS INTEGER) AS day,
  strftime(day, '%Y-%m-%d') AS date, price
FROM g
"""


def pct_change_sum(spark: SparkSession, folder: str) -> DataFrame:
    """Summed change and last value of each user's mean event value per day, up to the day before closing."""
    mean = (F.sum(F.col("value").cast("decimal(18,2)")).cast("double") / F.count("value")).cast("double")
    daily = reshape.day_series(events(spark, folder), ["user_id"], "day", F.when(F.count_if(F.col("event_type") == "view") > 0, mean))
    out = add_series_features(daily.withColumn("close", F.lit(CLOSE)), "pairs", "close", "sum_roc", "last_value")
    return out.select("user_id", F.round("sum_roc", 4).alias("sum_roc"), F.round("last_value", 6).alias("last_value"))


PCT_SQL = """
WITH d AS (
  SELECT user_id, CAST(ts AS DATE) AS day, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(value) AS price
  FROM events GROUP BY ALL HAVING count(*) FILTER (WHERE event_type = 'view') > 0),
k AS (SELECT * FROM d WHERE day <= DATE '2024-01-20'),
c AS (SELECT user_id, day, price, lag(price) OVER (PARTITION BY user_id ORDER BY day) AS before FROM k),
a AS (SELECT user_id, count(*) AS n, sum((price - before) / before * 100) AS roc, arg_max(price, day) AS last FROM c GROUP BY 1)
SELECT u.user_id, CASE WHEN n >= 2 THEN round(roc, 4) END AS sum_roc, CASE WHEN n >= 2 THEN round(last, 6) END AS last_value
FROM (SELECT DISTINCT user_id FROM events) u LEFT JOIN a ON a.user_id = u.user_id
"""


def first_last_price(spark: SparkSession, folder: str) -> DataFrame:
    out = daily_purchases(spark, folder)
    return out.select(
        "user_id",
        series.first_price("pairs").alias("first_price"),
        series.latest_price("pairs").alias("latest_price"),
        series.last_known(F.transform("pairs", lambda p: p["price"]), 2).alias("before_latest"),
    )


FIRST_LAST_SQL = f"""
WITH {DAILY}
k AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY day DESC) AS back FROM d WHERE price IS NOT NULL),
a AS (SELECT user_id, arg_min(price, day) AS first_price, arg_max(price, day) AS latest_price,
             max(price) FILTER (WHERE back = 2) AS before_latest FROM k GROUP BY 1)
SELECT u.user_id, first_price, latest_price, before_latest
FROM (SELECT DISTINCT user_id FROM d) u LEFT JOIN a ON a.user_id = u.user_id
"""


def wide_days(spark: SparkSession, folder: str) -> DataFrame:
    """Series to 31 day columns and back to long rows, empty places left out."""
    wide = reshape.columns_from_pairs(daily_purchases(spark, folder), days=31)
    trimmed = reshape.trim_zeros(wide, days=31)
    back = reshape.pairs_from_columns(trimmed, days=31)
    return reshape.long_from_pairs(back, ["user_id"]).filter("date IS NOT NULL").select("user_id", "day", date_text("date").alias("date"), "price")


WIDE_SQL = f"""
WITH {DAILY}
n AS (SELECT user_id, day, price, row_number() OVER (PARTITION BY user_id ORDER BY day) AS r FROM d),
f AS (SELECT user_id, min(r) FILTER (WHERE price IS NULL OR price <> 0) AS first FROM n GROUP BY 1)
SELECT n.user_id, CAST(n.r - first + 1 AS INTEGER) AS day, strftime(n.day, '%Y-%m-%d') AS date, n.price
FROM n JOIN f ON f.user_id = n.user_id WHERE n.r >= first
"""


def squeeze_columns(spark: SparkSession, folder: str) -> DataFrame:
    """Long metric rows of any number of days to three day columns, which a second squeeze leaves as they are."""
    rows = events(spark, folder).groupBy("user_id", (F.dayofweek("day")).alias("day"), F.col("event_type")).agg(
        F.max("value").alias("value")
    )
    names = {"view": "qib", "click": "nii", "purchase": "rtl"}
    wide = reshape.subscription_columns(rows, ["user_id"], "day", "event_type", "value", names)
    return reshape.squeeze_subscriptions(wide)


def _squeeze_metric(event: str, name: str) -> str:
    return f"""
  max(v) FILTER (WHERE e = '{event}' AND dow = 1) AS IPO_day1_{name},
  coalesce(max(v) FILTER (WHERE e = '{event}' AND back = 2), max(v) FILTER (WHERE e = '{event}' AND back = 1)) AS IPO_day2_{name},
  max(v) FILTER (WHERE e = '{event}' AND back = 1) AS IPO_day3_{name}"""


SQUEEZE_COLUMNS_SQL = (
    """
WITH m AS (SELECT user_id, dayofweek(ts) + 1 AS dow, event_type AS e, max(value) AS v FROM events
           WHERE event_type IN ('view', 'click', 'purchase') GROUP BY ALL),
r AS (SELECT *, CASE WHEN dow > 1 THEN row_number() OVER (PARTITION BY user_id, e, dow > 1 ORDER BY dow DESC) END AS back FROM m)
SELECT user_id, """
    + ",".join(_squeeze_metric(*pair) for pair in (("view", "qib"), ("click", "nii"), ("purchase", "rtl")))
    + " FROM r GROUP BY user_id"
)

CASES = {
    "squeeze_days": (squeeze_days, SQUEEZE_SQL),
    "trim_zeros": (trim_zeros, TRIM_SQL),
    "sort_pairs": (sort_pairs, SORT_SQL),
    "pct_change_sum": (pct_change_sum, PCT_SQL),
    "first_last_price": (first_last_price, FIRST_LAST_SQL),
    "wide_days": (wide_days, WIDE_SQL),
    "squeeze_columns": (squeeze_columns, SQUEEZE_COLUMNS_SQL),
}
