"""Cleaning, dates, gain and selections on the given tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from debutline.functions import dates, gain, text
from debutline.operators import project, select
from debutline.workload.tables import exact_sum, lineitem, orders, table

AS_OF = dt.date(1998, 6, 15)
JANUARY = dt.date(1998, 1, 10)
ARCHIVE_FROM = dt.date(1997, 9, 1)


def gain_bucket(spark: SparkSession, folder: str) -> DataFrame:
    issue = lineitem(spark, folder).groupBy("l_orderkey").agg(exact_sum("l_extendedprice").alias("issue"))
    priced = orders(spark, folder).join(issue, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    out = priced.select("o_orderkey", gain.listing_gain("o_totalprice", "issue").alias("gain"))
    out = out.withColumn("bucket", gain.gain_bucket("gain"))
    return out.select(
        "o_orderkey",
        "gain",
        "bucket",
        gain.bucket_class("bucket").alias("class"),
        gain.band_text("bucket").alias("band"),
        gain.class_text(gain.bucket_class("bucket")).alias("band_of_class"),
    )


GAIN_SQL = """
WITH issue AS (
  SELECT l_orderkey, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS issue
  FROM lineitem GROUP BY l_orderkey),
g AS (
  SELECT o_orderkey, CASE WHEN o_totalprice = 0 THEN NULL
    ELSE round_even((o_totalprice - issue) / o_totalprice * 100, 2) END AS gain
  FROM orders LEFT JOIN issue ON o_orderkey = l_orderkey),
b AS (
  SELECT o_orderkey, gain,
    CASE WHEN gain BETWEEN -100 AND -20 THEN 1 WHEN gain BETWEEN -20 AND 0 THEN 2
         WHEN gain BETWEEN 0 AND 10 THEN 3 WHEN gain BETWEEN 10 AND 20 THEN 4
         WHEN gain BETWEEN 20 AND 40 THEN 5 WHEN gain BETWEEN 40 AND 100 THEN 6 END AS k
  FROM g)
SELECT o_orderkey, CAST(gain AS DOUBLE) AS gain, 'Cat_' || k AS bucket, CAST(k - 1 AS INTEGER) AS class,
  CASE k WHEN 1 THEN '-100 to -20' WHEN 2 THEN '-20 to 0' WHEN 3 THEN '0 to 10'
         WHEN 4 THEN '10 to 20' WHEN 5 THEN '20 to 40' WHEN 6 THEN '40 to 100' END AS band,
  CASE k WHEN 1 THEN '-100 to -20' WHEN 2 THEN '-20 to 0' WHEN 3 THEN '0 to 10'
         WHEN 4 THEN '10 to 20' WHEN 5 THEN '20 to 40' WHEN 6 THEN '40 to 100' END AS band_of_class
FROM b
"""


def clean_names(spark: SparkSession, folder: str) -> DataFrame:
    """Customer names dressed up with the abbreviations the cleaner expands."""
    suffix = (
        F.when(F.col("c_mktsegment") == "BUILDING", " Corp. IPO")
        .when(F.col("c_mktsegment") == "MACHINERY", " & Co. Ltd. IPO")
        .when(F.col("c_mktsegment") == "HOUSEHOLD", " Ltd.")
        .otherwise(" Co.Ltd. IPO Corp.")
    )
    out = table(spark, folder, "customer").withColumn("raw", F.concat("c_name", suffix))
    return out.select(
        "c_custkey",
        text.clean_name("raw").alias("name"),
        text.search_url("raw").alias("search"),
        text.searched_name(text.search_url("raw")).alias("searched"),
        text.null_sentinels(F.when(F.col("c_nationkey") < 5, "[.]").when(F.col("c_nationkey") < 9, "null").otherwise(F.col("c_name"))).alias("known"),
    )


CLEAN_NAMES_SQL = """
WITH r AS (
  SELECT c_custkey, c_name, c_nationkey, c_name || CASE c_mktsegment
    WHEN 'BUILDING' THEN ' Corp. IPO' WHEN 'MACHINERY' THEN ' & Co. Ltd. IPO'
    WHEN 'HOUSEHOLD' THEN ' Ltd.' ELSE ' Co.Ltd. IPO Corp.' END AS raw
  FROM customer),
s AS (SELECT *, replace(replace(raw, '&', 'and'), ' ', '+') AS term FROM r)
SELECT c_custkey,
  replace(replace(replace(replace(raw, 'Corp.', 'Corporation '), 'Ltd.', 'Limited'), 'Co.', 'Company '), ' IPO', '') AS name,
  'https://www.google.co.in/search?q=screener.in+mainpage+' || term || '&pws=0&hl=en' AS search,
  replace(term, '+', ' ') AS searched,
  CASE WHEN c_nationkey < 9 THEN NULL ELSE c_name END AS known
FROM s
"""


def clean_numbers(spark: SparkSession, folder: str) -> DataFrame:
    """Numbers out of part texts, event properties being too regular for it."""
    out = table(spark, folder, "part").withColumns(
        {
            "band": F.concat(F.lit("₹"), "p_size", F.lit(" to ₹"), F.format_string("%.2f", "p_retailprice"), F.lit(" per share")),
            "cell": F.concat(F.lit("  ₹1,"), "p_size", F.lit(",000.5 Cr (aggregating up to $5) ")),
            "loose": F.when(F.col("p_type") == "SMALL", F.lit("nan")).when(F.col("p_type") == "PROMO", F.col("p_brand")).otherwise(F.col("p_retailprice").cast("string")),
        }
    )
    return out.select(
        "p_partkey",
        text.first_number("p_brand").alias("brand_number"),
        text.first_number("band").alias("low"),
        text.last_number("band").alias("high"),
        text.first_integer("band").alias("low_integer"),
        text.last_number("p_type").alias("no_number"),
        text.clean_cell("cell").alias("cell"),
        text.issue_size(text.clean_cell("cell")).alias("size_crore"),
        text.rupees(F.concat(F.lit("₹"), F.col("p_size"))).alias("rupees"),
        text.to_number("loose").alias("loose_number"),
        text.null_zero(F.when(F.col("p_size") < 10, 0.0).otherwise(F.col("p_retailprice"))).alias("nonzero"),
        text.add_strict("p_size", F.when(F.col("p_size") > 5, F.lit(2))).alias("added"),
    )


CLEAN_NUMBERS_SQL = """
SELECT p_partkey,
  CAST(regexp_extract(p_brand, '\\d+\\.?\\d*') AS DOUBLE) AS brand_number,
  CAST(p_size AS DOUBLE) AS low,
  CAST(printf('%.2f', p_retailprice) AS DOUBLE) AS high,
  CAST(p_size AS BIGINT) AS low_integer,
  CAST(NULL AS DOUBLE) AS no_number,
  '₹1' || p_size || '000.5 Cr (aggregating up to 5)' AS cell,
  CAST('1' || p_size || '000.5' AS DOUBLE) AS size_crore,
  CAST(p_size AS DOUBLE) AS rupees,
  CASE WHEN p_type IN ('SMALL', 'PROMO') THEN NULL ELSE p_retailprice END AS loose_number,
  CASE WHEN p_size < 10 THEN NULL ELSE p_retailprice END AS nonzero,
  CASE WHEN p_size > 5 THEN p_size + 2 END AS added
FROM part
"""


def date_parse(spark: SparkSession, folder: str) -> DataFrame:
    """Order dates written in each page format and read back by the one lenient parser."""
    day = F.col("day")
    form = lambda pattern: F.date_format(day, pattern)
    parsed = lambda pattern: dates.date_text(dates.parse_date(form(pattern)))
    return orders(spark, folder).select(
        "o_orderkey",
        parsed("EEE, MMM dd, yyyy").alias("timeline"),
        parsed("EEE MMM dd yyyy").alias("cell"),
        parsed("dd MMM yyyy").alias("range_part"),
        parsed("MMM dd yyyy").alias("subscription"),
        parsed("dd-MM-yyyy").alias("price_day"),
        dates.date_text(dates.parse_date(F.col("o_orderpriority"))).alias("unreadable"),
        dates.date_text(dates.stored_date(form("yyyy-MM-dd"))).alias("stored"),
        dates.month_name(day).alias("month"),
        dates.month_name(day, -1).alias("month_before"),
        dates.month_year(day, -1).alias("year_before"),
    )


DATE_PARSE_SQL = """
WITH d AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders),
t AS (SELECT *, strftime(day, '%Y-%m-%d') AS s FROM d)
SELECT o_orderkey, s AS timeline, s AS cell, s AS range_part, s AS subscription, s AS price_day,
  CAST(NULL AS VARCHAR) AS unreadable, s AS stored, strftime(day, '%B') AS month,
  strftime(day - INTERVAL 1 MONTH, '%B') AS month_before, strftime(day - INTERVAL 1 MONTH, '%Y') AS year_before
FROM t
"""


def range_dates(spark: SparkSession, folder: str) -> DataFrame:
    """`"A to B Mon YYYY"` built from order dates; the left side names its month only when it differs."""
    end = F.date_add("day", F.length("o_orderpriority"))
    left = F.when(F.trunc("day", "MM") == F.trunc(end, "MM"), F.date_format("day", "d")).otherwise(F.date_format("day", "d MMM"))
    ranged = orders(spark, folder).select("o_orderkey", F.concat_ws(" to ", left, F.date_format(end, "d MMM yyyy")).alias("raw"))
    span = ranged.withColumn("span", dates.range_dates("raw"))
    return span.select("o_orderkey", "raw", dates.date_text("span.open").alias("opened"), dates.date_text("span.close").alias("closed"))


RANGE_DATES_SQL = """
WITH d AS (
  SELECT o_orderkey, CAST(o_orderdate AS DATE) AS a,
         CAST(o_orderdate AS DATE) + CAST(length(o_orderpriority) AS INTEGER) AS b FROM orders)
SELECT o_orderkey,
  CASE WHEN date_trunc('month', a) = date_trunc('month', b) THEN strftime(a, '%-d') ELSE strftime(a, '%-d %b') END
    || ' to ' || strftime(b, '%-d %b %Y') AS raw,
  strftime(a, '%Y-%m-%d') AS opened, strftime(b, '%Y-%m-%d') AS closed
FROM d
"""


def url_symbols(spark: SparkSession, folder: str) -> DataFrame:
    """Symbols out of page addresses, treated as exchange links."""
    pages = table(spark, folder, "pages")
    host = F.split_part("url", F.lit("/"), F.lit(3))
    nse = F.concat(F.lit("https://www.nseindia.com/get-quotes/equity?symbol="), F.split_part("url", F.lit("/"), F.lit(4)))
    bracket = F.concat(F.lit(" ("), host, F.lit(" | "), F.col("page_id"), F.lit(") "))
    return pages.select(
        "page_id",
        text.link_symbol("url").alias("path_symbol"),
        text.query_symbol(nse).alias("query_symbol"),
        text.query_symbol("url").alias("no_query_symbol"),
        text.bracket_symbol(bracket).alias("bracket_symbol"),
        text.preferred_symbol(F.when(F.contains("url", F.lit("blog")), F.lit("")), text.query_symbol(nse)).alias("preferred"),
    )


URL_SYMBOLS_SQL = """
WITH p AS (
  SELECT page_id, url, string_split(rtrim(url, '/'), '/') AS parts FROM pages)
SELECT page_id,
  CASE WHEN contains(parts[-2], '-') THEN parts[-1] ELSE parts[-2] END AS path_symbol,
  split_part(url, '/', 4) AS query_symbol,
  url AS no_query_symbol,
  split_part(url, '/', 3) AS bracket_symbol,
  split_part(url, '/', 4) AS preferred
FROM p
"""


def select_train(spark: SparkSession, folder: str) -> DataFrame:
    """Orders up to day 1 of the month before, with known price and priority."""
    rows = orders(spark, folder).withColumn("price", F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")))
    kept = select.select_train(rows, AS_OF, "day", ("price", "o_orderpriority"))
    return kept.select("o_orderkey", dates.date_text("day").alias("opened"), "price")


SELECT_TRAIN_SQL = """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS opened, o_totalprice AS price FROM orders
WHERE o_orderstatus <> 'P' AND o_orderpriority IS NOT NULL AND CAST(o_orderdate AS DATE) <= DATE '1998-05-01'
"""


def select_month(spark: SparkSession, folder: str) -> DataFrame:
    rows = orders(spark, folder).withColumn("price", F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")))
    latest = select.select_month(rows, AS_OF, "day").select(F.lit("latest").alias("kind"), "o_orderkey", "day")
    ready = select.select_predict(rows, JANUARY, "day", "price").select(F.lit("predict").alias("kind"), "o_orderkey", "day")
    return select.newest_first(project.stack([latest, ready]), "day", "o_orderkey").select(
        "kind", "o_orderkey", dates.date_text("day").alias("opened")
    )


SELECT_MONTH_SQL = """
SELECT 'latest' AS kind, o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS opened FROM orders
WHERE date_trunc('month', o_orderdate) = DATE '1998-06-01'
UNION ALL
SELECT 'predict', o_orderkey, strftime(o_orderdate, '%Y-%m-%d') FROM orders
WHERE date_trunc('month', o_orderdate) = DATE '1998-01-01' AND o_orderstatus <> 'P'
"""


def select_archive(spark: SparkSession, folder: str) -> DataFrame:
    kept = select.select_archive(orders(spark, folder), AS_OF, "day", ARCHIVE_FROM)
    return select.newest_first(kept, "day", "o_orderkey").select("o_orderkey", dates.date_text("day").alias("opened"), "o_totalprice")


SELECT_ARCHIVE_SQL = """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS opened, o_totalprice FROM orders
WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1997-09-01' AND DATE '1998-06-01'
"""


def page_of_20(spark: SparkSession, folder: str) -> DataFrame:
    """Third display page of all orders."""
    return select.page(orders(spark, folder), 3, [F.col("day").desc(), F.col("o_orderkey")]).select(
        "o_orderkey", dates.date_text("day").alias("opened"), "o_totalprice"
    )


PAGE_SQL = """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS opened, o_totalprice FROM orders
ORDER BY o_orderdate DESC, o_orderkey LIMIT 20 OFFSET 40
"""


def page_count(spark: SparkSession, folder: str) -> DataFrame:
    return select.page_count(orders(spark, folder))


PAGE_COUNT_SQL = "SELECT count(*) AS total_rows, CAST(ceil(count(*) / 20.0) AS BIGINT) AS pages FROM orders"


def conform_stack(spark: SparkSession, folder: str) -> DataFrame:
    """Three tables of entities brought to one column list."""
    columns = {"name": T.StringType(), "nation": T.IntegerType(), "balance": T.DoubleType(), "segment": T.StringType(), "note": T.StringType()}
    frames = [
        project.rename(table(spark, folder, "customer"), {"c_name": "name", "c_nationkey": "nation", "c_acctbal": "balance", "c_mktsegment": "segment"}),
        project.rename(table(spark, folder, "supplier"), {"s_name": "name", "s_nationkey": "nation", "s_acctbal": "balance"}),
        project.rename(table(spark, folder, "nation"), {"n_name": "name", "n_nationkey": "nation"}),
    ]
    return project.with_default(project.stack([project.conform(frame, columns) for frame in frames]), "votes", 0)


CONFORM_SQL = """
SELECT c_name AS name, c_nationkey AS nation, c_acctbal AS balance, c_mktsegment AS segment, CAST(NULL AS VARCHAR) AS note, 0 AS votes FROM customer
UNION ALL SELECT s_name, s_nationkey, s_acctbal, NULL, NULL, 0 FROM supplier
UNION ALL SELECT n_name, n_nationkey, NULL, NULL, NULL, 0 FROM nation
"""


def null_filters(spark: SparkSession, folder: str) -> DataFrame:
    """Null-keeping inequality, fallbacks, and row drops on events with nulls by value."""
    rows = table(spark, folder, "events").select(
        "event_id",
        F.when(F.col("value") < 80, F.col("event_type")).alias("kind"),
        F.when(F.col("value") > 5, F.col("value")).alias("reading"),
        "user_id",
    )
    kept = project.drop_value(rows, "kind", "error")
    kept = project.drop_nulls(kept, "all", ["kind", "reading"])
    kept = project.drop_nulls(kept, "any", ["user_id"])
    return project.fallback(kept, "reading", F.col("user_id").cast("double"))


NULL_FILTERS_SQL = """
WITH r AS (
  SELECT event_id, CASE WHEN value < 80 THEN event_type END AS kind, CASE WHEN value > 5 THEN value END AS reading, user_id
  FROM events)
SELECT event_id, kind, coalesce(reading, CAST(user_id AS DOUBLE)) AS reading, user_id FROM r
WHERE kind IS DISTINCT FROM 'error' AND (kind IS NOT NULL OR reading IS NOT NULL) AND user_id IS NOT NULL
"""


def url_grid(spark: SparkSession, folder: str) -> DataFrame:
    """List addresses for each order priority over the years it occurs in."""
    span = orders(spark, folder).groupBy("o_orderpriority").agg(F.min(F.year("day")).alias("low"), F.max(F.year("day")).alias("high"))
    return project.list_urls(span, "https://lists.example.org/%s/?year=%d", "o_orderpriority", "low", "high")


URL_GRID_SQL = """
WITH s AS (SELECT o_orderpriority AS category, min(year(o_orderdate)) AS low, max(year(o_orderdate)) AS high FROM orders GROUP BY 1),
y AS (SELECT category, CAST(unnest(range(low, high + 1)) AS INTEGER) AS year FROM s)
SELECT category, year, 'https://lists.example.org/' || category || '/?year=' || year AS url FROM y
"""


def json_records(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "customer").select("c_custkey", "c_name", F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment")).alias("segment"))
    return project.to_records(rows)


JSON_SQL = """
SELECT '{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '","segment":'
  || CASE WHEN c_acctbal > 0 THEN '"' || c_mktsegment || '"' ELSE 'null' END || '}' AS record
FROM customer
"""

CASES = {
    "gain_bucket": (gain_bucket, GAIN_SQL),
    "clean_names": (clean_names, CLEAN_NAMES_SQL),
    "clean_numbers": (clean_numbers, CLEAN_NUMBERS_SQL),
    "date_parse": (date_parse, DATE_PARSE_SQL),
    "range_dates": (range_dates, RANGE_DATES_SQL),
    "url_symbols": (url_symbols, URL_SYMBOLS_SQL),
    "select_train": (select_train, SELECT_TRAIN_SQL),
    "select_month": (select_month, SELECT_MONTH_SQL),
    "select_archive": (select_archive, SELECT_ARCHIVE_SQL),
    "page_of_20": (page_of_20, PAGE_SQL),
    "page_count": (page_count, PAGE_COUNT_SQL),
    "conform_stack": (conform_stack, CONFORM_SQL),
    "null_filters": (null_filters, NULL_FILTERS_SQL),
    "url_grid": (url_grid, URL_GRID_SQL),
    "json_records": (json_records, JSON_SQL),
}
