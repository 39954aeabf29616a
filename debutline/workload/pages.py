"""Links of the given pages, and tables out of pages that Spark writes from the given tables.

The given pages hold no tables. So that the table rules run over all rows of something, one page per
order (or supplier) is written as HTML and read back; the SQL says what has to come out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from debutline.functions.dates import date_text
from debutline.functions.text import searched_name, search_url
from debutline.operators.reshape import long_from_pairs
from debutline.plans.extract import PAGE_KINDS, SERIES, offer_details, offer_prices, offer_reviews, offer_subscriptions, quarantine
from debutline.session import spread
from debutline.sources import markup
from debutline.workload.tables import orders, table

EXTERNAL = '<p><a href="https://other.example.net/la">la</a><a href="https://other.example.net/second">la</a>'
LINKS = {"the": ("the_link", "internal"), "de": ("de_link", "internal"), "in": ("in_link", "internal"), "la": ("la_link", "external")}


def link_pick(spark: SparkSession, folder: str) -> DataFrame:
    """First link of each page for four anchor texts, one of them wanted on other hosts only; some pages get such a link."""
    more = F.when(F.contains("url", F.lit("/en/")), F.lit(EXTERNAL)).otherwise("")
    pages = table(spark, folder, "pages").withColumn("html", F.concat("html", more))
    return markup.pick_links(pages, kinds=LINKS).select("page_id", *[name for name, _ in LINKS.values()])


LINK_SQL = """
WITH a AS (
  SELECT page_id, url, regexp_extract_all(regexp_replace(html, '<!--.*?-->', '', 'gs'), '(?s)<a href="([^"]*)">([^<]*)</a>', 2) AS texts,
         regexp_extract_all(regexp_replace(html, '<!--.*?-->', '', 'gs'), '(?s)<a href="([^"]*)">([^<]*)</a>', 1) AS hrefs
  FROM pages)
SELECT page_id, hrefs[list_position(texts, 'the')] AS the_link, hrefs[list_position(texts, 'de')] AS de_link,
  hrefs[list_position(texts, 'in')] AS in_link, CASE WHEN contains(url, '/en/') THEN 'https://other.example.net/la' END AS la_link
FROM a
"""


def all_links(spark: SparkSession, folder: str) -> DataFrame:
    """Every link of every page, with the side of the host border it points to."""
    pages = table(spark, folder, "pages")
    links = pages.select("page_id", "url", F.posexplode(markup.page_links("html")).alias("place", "link"))
    return links.select(
        "page_id", "place", "link.text", "link.href", markup.is_internal("url", F.col("link.href")).alias("internal")
    )


ALL_LINKS_SQL = """
WITH a AS (
  SELECT page_id, regexp_extract_all(html, '(?s)<a href="([^"]*)">([^<]*)</a>', 2) AS texts,
         regexp_extract_all(html, '(?s)<a href="([^"]*)">([^<]*)</a>', 1) AS hrefs FROM pages)
SELECT page_id, CAST(unnest(range(len(texts))) AS INTEGER) AS place, unnest(texts) AS text, unnest(hrefs) AS href, true AS internal FROM a
"""


def first_external(spark: SparkSession, folder: str) -> DataFrame:
    """Search pages: the given pages with result links at the end, their address built from a name."""
    host = F.split_part("url", F.lit("/"), F.lit(3))
    company = lambda part: F.concat(F.lit("https://www.screener.in/company/"), part, F.lit("/"))
    a = lambda href: F.concat(F.lit('<p><a class=r href="'), href, F.lit('">hit &amp; run</a>'))
    results = F.when(
        ~F.contains("url", F.lit("blog")),
        F.concat(a(F.concat(F.lit("https://"), host, F.lit("/www.screener.in/company/own"))), a(company(F.col("page_id").cast("string"))), a(company(F.lit("later")))),
    )
    pages = table(spark, folder, "pages").select(
        "page_id", search_url(host).alias("url"), F.concat("html", F.coalesce(results, F.lit("<a href=/none>none</a>"))).alias("html"), host.alias("host")
    )
    found = markup.first_external_link(pages)
    return found.select("page_id", searched_name("url").alias("searched"), "screener_link")


FIRST_EXTERNAL_SQL = """
SELECT page_id, split_part(url, '/', 3) AS searched, CASE WHEN NOT contains(url, 'blog') THEN
  'https://' || split_part(url, '/', 3) || '/www.screener.in/company/own' END AS screener_link
FROM pages
"""


def _html(*parts: str | Column) -> Column:
    """Page text from fixed pieces and columns."""
    return F.concat(*[F.lit(part) if isinstance(part, str) else F.coalesce(part.cast("string"), F.lit("")) for part in parts])


def _order_pages(spark: SparkSession, folder: str, html: Column) -> DataFrame:
    pages = spread(orders(spark, folder)).withColumn("_url", F.concat(F.lit("https://offers.example.org/o/"), "o_orderkey"))
    return pages.select(F.col("_url").alias("url"), html.alias("html"))


def _key(column: str) -> Column:
    return F.element_at(F.split(column, "/"), -1).cast("bigint").alias("o_orderkey")


def detail_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Offer pages: a key-value table with a date range, and a timeline with the listing date."""
    end, listed = F.date_add("day", 3), F.date_add("day", 7)
    row = lambda label, *value: ("<tr><td><span><a href='#'>", label, "</a></span></td><td>", *value, "</td></tr>")
    html = _html(
        "<html><body><p>intro<table><tr><td>no digits here</td></tr></table><table><tbody>",
        *row("IPO Date", F.date_format("day", "d MMM yyyy"), " to ", F.date_format(end, "d MMM yyyy")),
        *row("Face Value", "₹", F.length("o_orderpriority"), " per share"),
        *row("Issue Price", F.when(F.col("o_orderstatus") == "P", F.lit("[.]")).otherwise(F.concat(F.lit("₹"), F.floor(F.col("o_totalprice") / 100), F.lit(" per share")))),
        "<tr><td>Price Band<td>₹95 to ₹", F.col("o_custkey"), ".00 per share",
        *row("Lot Size", F.col("o_orderkey") + 1, " Shares"),
        *row("Total Issue Size", "1,000 shares (aggregating up to ₹1,", F.lpad((F.col("o_custkey") % 1000).cast("string"), 3, "0"), ".25 Cr)"),
        "</tbody></table><div><ul><li><span>IPO Open Date</span> <span>", F.date_format("day", "EEE, MMM d, yyyy"),
        "</span></li><li><span>Tentative Listing Date</span><span>", F.date_format(listed, "EEE, MMM d, yyyy"), "</span></ul></div>",
    )
    out = offer_details(markup.split_errors(markup.parse_pages(_order_pages(spark, folder, html)))[0])
    dates = {name: date_text(name) for name in ("IPO_open_date", "IPO_close_date", "IPO_list_date")}
    return out.withColumns(dates).select(_key("detail_url"), *[name for name in out.columns if name != "detail_url"])


DETAIL_SQL = """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS IPO_open_date,
  strftime(o_orderdate + INTERVAL 3 DAY, '%Y-%m-%d') AS IPO_close_date,
  strftime(o_orderdate + INTERVAL 7 DAY, '%Y-%m-%d') AS IPO_list_date,
  CAST(length(o_orderpriority) AS DOUBLE) AS IPO_face_value,
  CAST(CASE WHEN o_orderstatus = 'P' THEN o_custkey ELSE floor(o_totalprice / 100) END AS DOUBLE) AS IPO_issue_price,
  CAST(o_orderkey + 1 AS DOUBLE) AS IPO_lot_size, 1000.25 + o_custkey % 1000 AS IPO_issue_size
FROM orders
"""


def review_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Review pages: a broker table, and a member table without neutral votes on some pages."""
    names = "<tr><th>Review By</th><th>Apply</th><th>May Apply</th><th>Neutral</th><th>Avoid</th><th>Not Rated</th></tr>"
    short = "<tr><th>Review By</th><th>Apply</th><th>May Apply</th><th>Avoid</th><th>Not Rated</th></tr>"
    cells = lambda *values: ("<tr>", *[p for value in values for p in ("<td> ", value, "</td>")], "</tr>")
    members = F.when(
        F.col("o_orderstatus") == "F",
        _html(short, *cells("All members", F.col("o_custkey"), "2", "1", "0")),
    ).otherwise(_html(names, *cells("All members", F.col("o_custkey"), "2", F.length("o_orderpriority"), "1", "0")))
    html = _html(
        "<table><thead>", names, "</thead><tbody>", *cells("Broker one", F.length("o_orderpriority"), "1,001", "-", F.col("o_orderkey"), "4"),
        *cells("Broker two", "9", "9", "9", "9", "9"), "</tbody></table><table><tbody>", members, "</tbody></table>",
    )
    out = offer_reviews(markup.parse_pages(_order_pages(spark, folder, html)))
    return out.select(_key("review_url"), *[name for name in out.columns if name != "review_url"])


REVIEW_SQL = """
SELECT o_orderkey, length(o_orderpriority) + 1001.0::DOUBLE AS IPO_Broker_apply, CAST(NULL AS DOUBLE) AS IPO_Broker_neutral,
  CAST(o_orderkey AS DOUBLE) AS IPO_Broker_avoid, CAST(o_custkey + 2 AS DOUBLE) AS IPO_Member_apply,
  CASE WHEN o_orderstatus = 'F' THEN 0.0 ELSE CAST(length(o_orderpriority) AS DOUBLE) END AS IPO_Member_neutral,
  CAST(1 AS DOUBLE) AS IPO_Member_avoid
FROM orders
"""


def subscription_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Subscription pages of four days; a second table overwrites the first day, and one label is no day at all."""
    head = "<tr><th>Date</th><th>QIB</th><th>NII*</th><th>Retail</th><th>Total</th></tr>"
    when = lambda number: F.date_format(F.date_add("day", number), "MMM d, yyyy")
    line = lambda number, *values: ("<tr><td>Day ", str(number), " <br>", when(min(number, 11)), "</td>", *[p for v in values for p in ("<td>", v, "</td>")], "<td>1</td></tr>")
    price = F.format_string("%.2f", "o_totalprice")
    html = _html(
        "<table>", head, *line(1, "7", "7", "7"), *line(2, price, "-", F.col("o_custkey")), *line(3, F.col("o_orderkey"), "1,234.5", "0"), *line(11, F.col("o_custkey") + 1, "-", "-"), *line(99999999999, "1", "1", "1"), "</table>",
        "<table>", head, *line(1, F.col("o_custkey"), price, "n/a"), "</table>",
    )
    out = offer_subscriptions(markup.parse_pages(_order_pages(spark, folder, html)))
    names = [f"IPO_day{day}_{metric}" for day in (1, 2, 3) for metric in ("qib", "nii", "rtl")]
    return out.select(_key("sbscrp_url"), *names)


SUBSCRIPTION_SQL = """
SELECT o_orderkey, CAST(o_custkey AS DOUBLE) AS IPO_day1_qib, CAST(printf('%.2f', o_totalprice) AS DOUBLE) AS IPO_day1_nii, CAST(NULL AS DOUBLE) AS IPO_day1_rtl,
  CAST(o_orderkey AS DOUBLE) AS IPO_day2_qib, 1234.5::DOUBLE AS IPO_day2_nii, CAST(o_custkey AS DOUBLE) AS IPO_day2_rtl,
  CAST(o_custkey + 1 AS DOUBLE) AS IPO_day3_qib, 1234.5::DOUBLE AS IPO_day3_nii, 0.0::DOUBLE AS IPO_day3_rtl
FROM orders
"""


def price_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Price pages of 44 days with the newest on top, read into series with the oldest day first."""
    head = "<thead><tr><th>GMP Date</th><th>IPO Price</th><th>GMP</th></tr></thead>"
    when = lambda number: F.date_format(F.date_add("day", number), "d-MM-yyyy")
    line = lambda date, price: ("<tr><td>", date, " open</td><td>100</td><td>₹", price, "</td></tr>")
    html = _html(
        "<table>", head, "<tbody>", *line(when(2), F.col("o_custkey")), *line("soon", "5"), *line(when(1), F.lit("1,005")), *line(when(0), F.lit("--")),
        *[part for back in range(1, 41) for part in line(when(-back), F.lit(str(back)))], "</tbody></table>",
    )
    out = offer_prices(markup.parse_pages(_order_pages(spark, folder, html)))
    pairs = long_from_pairs(out, ["grmkpt_url"], SERIES)
    return pairs.select(_key("grmkpt_url"), "day", date_text("date").alias("date"), "price")


PRICE_SQL = """
WITH d AS (SELECT o_orderkey, o_orderdate AS a, CAST(o_custkey AS DOUBLE) AS p FROM orders)
SELECT o_orderkey, CAST(41 - back AS INTEGER) AS day, strftime(a - to_days(CAST(back AS INTEGER)), '%Y-%m-%d') AS date, CAST(back AS DOUBLE) AS price
FROM d CROSS JOIN (SELECT unnest(range(1, 41)) AS back)
UNION ALL SELECT o_orderkey, 41, strftime(a, '%Y-%m-%d'), NULL FROM d
UNION ALL SELECT o_orderkey, 42, strftime(a + INTERVAL 1 DAY, '%Y-%m-%d'), 1005.0 FROM d
UNION ALL SELECT o_orderkey, 43, strftime(a + INTERVAL 2 DAY, '%Y-%m-%d'), p FROM d
UNION ALL SELECT o_orderkey, 44, NULL, 5.0 FROM d
"""


def list_pages(spark: SparkSession, folder: str) -> DataFrame:
    """List pages, one per customer: two companies, the second struck out when the customer is in debt; headings hold links."""
    link = lambda name, before="", after="": ("<tr><td><div><a href='https://o.example.org/", F.col("c_custkey"), "/", name, "'>", before, F.col("c_name"), " ", name, " Ltd. IPO", after, "</a></div></td><td><a href='/x'>x</a></td></tr>")
    html = F.when(
        F.col("c_acctbal") < 0,
        _html("<div><table><thead><tr><th><a href='/sort'>Company</a></th></tr><tr><td><a href='/all'>All</a></td></tr></thead><tbody>", *link("one"), *link("two", "<del>", "</del>"), "</tbody></table></div>"),
    ).otherwise(_html("<div><table><tbody><tr><th><a href='/sort'>Company</a></th></tr>", *link("one"), *link("two"), "</tbody></table></div>"))
    folder_name = F.when(F.col("c_mktsegment") == "BUILDING", "sme").otherwise("mainboard")
    pages = spread(table(spark, folder, "customer")).select(
        F.concat(F.lit("https://lists.example.org/"), "c_custkey", F.lit("/"), folder_name, F.lit("/?year=2025")).alias("url"), html.alias("html")
    )
    return markup.listed_companies(markup.parse_pages(pages))


LIST_SQL = """
WITH k AS (SELECT 'one' AS w UNION ALL SELECT 'two')
SELECT c_name || ' ' || w || ' Limited' AS Company_name, 'https://o.example.org/' || c_custkey || '/' || w AS Company_info_url,
  CASE WHEN c_mktsegment = 'BUILDING' THEN 'SME' ELSE 'EQ' END AS IPO_category
FROM customer, k WHERE w = 'one' OR c_acctbal >= 0
"""


def page_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """Subscription pages of all orders: pages without text and labels that are no day are named, good ones are not."""
    html = F.when(F.col("o_orderstatus") == "O", F.lit(None).cast("string")).otherwise(
        _html(
            "<table><tr><th>Date</th><th>QIB</th></tr><tr><td>Day ", F.when(F.col("o_orderstatus") == "P", F.lit("99999999999")).otherwise("11"),
            "</td><td>", F.col("o_custkey"), "</td></tr></table><p", F.when(F.col("o_custkey") % 2 == 0, F.lit(">")),
        )
    )
    empty = spark.createDataFrame([], "url string, html string")
    parsed = {kind: markup.parse_pages(empty) for kind in PAGE_KINDS} | {"subscriptions": markup.parse_pages(_order_pages(spark, folder, html))}
    return quarantine(parsed).select(_key("url"), "kind", F.regexp_replace("error", ":.*", "").alias("problem"))


QUARANTINE_SQL = """
SELECT o_orderkey, 'subscriptions' AS kind, CASE WHEN o_orderstatus = 'O' THEN 'TypeError' ELSE 'day label' END AS problem
FROM orders WHERE o_orderstatus IN ('O', 'P')
"""


def profile_pick(spark: SparkSession, folder: str) -> DataFrame:
    """Profile columns from three links per part, whose second link is on either exchange or on none."""
    bse = F.concat(F.lit("https://www.bseindia.com/stock-share-price/"), F.when(F.col("p_size") < 25, "some-part/").otherwise("x/"), F.col("p_brand"), F.lit("/"), F.col("p_partkey"), F.lit("/"))
    nse = F.concat(F.lit("https://www.nseindia.com/get-quotes/equity?symbol=P"), "p_partkey")
    kind = F.col("p_type")
    links = F.array(
        F.when(kind == "LARGE", F.lit("https://www.google.co.in/search")).when(kind != "SMALL", F.concat(F.lit("https://"), "p_brand")),
        F.when(kind == "PROMO", nse).when(kind != "MEDIUM", bse),
        F.when((kind != "PROMO") & (F.col("p_size") > 10), nse),
    )
    parts = table(spark, folder, "part").withColumns({"links": links, "name": F.when(kind != "ECONOMY", F.col("p_name")).otherwise("")})
    return parts.select("p_partkey", *markup.profile_fields(F.col("links"), F.col("name")))


PROFILE_SQL = """
WITH l AS (SELECT *,
  'https://www.bseindia.com/stock-share-price/' || CASE WHEN p_size < 25 THEN 'some-part/' ELSE 'x/' END || p_brand || '/' || p_partkey || '/' AS bse,
  'https://www.nseindia.com/get-quotes/equity?symbol=P' || p_partkey AS nse FROM part)
SELECT p_partkey, CASE WHEN p_type <> 'ECONOMY' THEN p_name END AS company_long_name,
  CASE WHEN p_type NOT IN ('LARGE', 'SMALL') THEN 'https://' || p_brand END AS company_website,
  CASE WHEN p_type NOT IN ('PROMO', 'MEDIUM') THEN bse END AS bse_link,
  CASE WHEN p_type NOT IN ('PROMO', 'MEDIUM') THEN p_brand END AS bse_symbol,
  CASE WHEN p_type = 'PROMO' OR p_size > 10 THEN nse END AS nse_link,
  CASE WHEN p_type = 'PROMO' OR p_size > 10 THEN 'P' || p_partkey END AS nse_symbol
FROM l
"""

CASES = {
    "link_pick": (link_pick, LINK_SQL),
    "all_links": (all_links, ALL_LINKS_SQL),
    "first_external_link": (first_external, FIRST_EXTERNAL_SQL),
    "list_pages": (list_pages, LIST_SQL),
    "detail_pages": (detail_pages, DETAIL_SQL),
    "review_pages": (review_pages, REVIEW_SQL),
    "subscription_pages": (subscription_pages, SUBSCRIPTION_SQL),
    "price_pages": (price_pages, PRICE_SQL),
    "page_quarantine": (page_quarantine, QUARANTINE_SQL),
    "profile_pick": (profile_pick, PROFILE_SQL),
}
