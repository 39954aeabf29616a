"""Landed web pages to links, tables and offering rows.

Parsing is the only Python step: it turns one page into arrays of tables, row links and list spans.
Every rule after that is an expression on those arrays, so a page's rows never leave its row until
they are exploded.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Mapping, Sequence
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from debutline.functions.common import ColumnLike, col, let
from debutline.functions.text import clean_cell, clean_name, link_symbol, query_symbol, to_number
from debutline.schema import LINK_KINDS, TABLE_IDENTIFIERS

# --- fixed values -----------------------------------------------------------------------------
DAY_LABEL_PATTERN = r"(?i).*?(Day \d+).*?"
PRICE_DAY_PATTERN = r"^(\d{1,2}-\d{1,2}-\d{4})"
WEBSITE_EXCLUDED = "www.google.co.in/"
BSE_HOST = "bseindia.com"
NSE_HOST = "nseindia.com"
SCREENER_PART = "www.screener.in/company/"
PAGES_PER_STEP = 256
# --- end of fixed values ----------------------------------------------------------------------

LINK_TYPE = T.StructType(
    [
        T.StructField("table_no", T.IntegerType()),
        T.StructField("row_no", T.IntegerType()),
        T.StructField("col_no", T.IntegerType()),
        T.StructField("text", T.StringType()),
        T.StructField("href", T.StringType()),
        T.StructField("struck", T.BooleanType()),
        T.StructField("in_body", T.BooleanType()),
    ]
)
TABLE_TYPE = T.StructType(
    [
        T.StructField("headers", T.ArrayType(T.StringType())),
        T.StructField("first_links", T.ArrayType(T.StringType())),
        T.StructField("rows", T.ArrayType(T.ArrayType(T.StringType()))),
    ]
)
PARSED_FIELDS = [
    T.StructField("tables", T.ArrayType(TABLE_TYPE)),
    T.StructField("row_links", T.ArrayType(LINK_TYPE)),
    T.StructField("spans", T.ArrayType(T.StringType())),
    T.StructField("error", T.StringType()),
]


ATTRS = r"""[^>"']*+(?:(?:"[^"]*"|'[^']*')[^>"']*+)*+"""
TAGS = (
    r"""(?i:<!--.*?(?:-->|$)|<(?P<raw>script|style)\b.*?(?:</(?P=raw)\s*>|$)|<[!?][^>]*>"""
    rf"""|<(?P<close>/?)(?P<tag>[a-z][a-z0-9]*)(?P<attrs>{ATTRS})>|(?P<text>[^<]+|<))"""
)
WATCHED = {"table", "thead", "tbody", "tr", "td", "th", "li", "span", "a", "del"}
# a row whose cells hold nothing but text and such tags is one token, as most rows of a long table are
END = rf"(?:>|[\s/]{ATTRS}>)"
FORMATTING = rf"(?!</[tT])</?(?i:br|b|i|u|p|em|strong|small|sup|sub|font|div){END}"
CELL = rf"<[tT](%s[dDhH]){END}(%s[^<]*+(?:{FORMATTING}[^<]*+)*+)</[tT][dDhH]\s*+>"
PLAIN_ROW = rf"<[tT][rR]{END}(?P<cells>(?:\s*+{CELL % ('?:', '?:')})++)\s*+</[tT][rR]\s*+>"
TOKENS, ROW_TOKENS = (re.compile(tokens, re.DOTALL) for tokens in (f"{PLAIN_ROW}|{TAGS}", TAGS))
CELL_TEXTS, BETWEEN = re.compile(CELL % ("", "")), re.compile(FORMATTING)
HREF = re.compile(r"""\shref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.IGNORECASE)


class _PageReader:
    """Collects tables, the links inside their rows, and the spans of list items."""

    def __init__(self) -> None:
        self.tables: list[dict] = []
        self.links: list[dict] = []
        self.spans: list[str] = []
        self.open_tables: list[dict] = []
        self.texts: list[list[str]] = []
        self.items = 0
        self.span_at: list[int | None] = []
        self.link: dict | None = None

    def read(self, page: str) -> None:
        for found in TOKENS.finditer(page):
            cells, _, *token = found.groups()
            if cells is None:
                self._read_token(*token)
            elif self.texts or self.span_at or self.link is not None:
                for inner in ROW_TOKENS.finditer(found.group()):
                    self._read_token(*inner.groups()[1:])
            elif self.open_tables:
                # no cell, span or link is open, so the row is all that changes
                table, row = self.open_tables[-1], []
                table["row"] += 1
                table["rows"].append(row)
                for kind, text in CELL_TEXTS.findall(cells):
                    if "<" in text or "&" in text:
                        text = "".join(map(unescape, BETWEEN.split(text)))
                    if kind in "dD":
                        row.append(text)
                    elif table["head"] or table["row"] == 0:
                        table["headers"].append(text.strip())

    def _read_token(self, close: str | None, tag: str | None, attrs: str | None, text: str | None) -> None:
        if text is not None:
            if self.texts or self.span_at or self.link is not None:
                self.handle_data(unescape(text) if "&" in text else text)
        elif tag and (tag := tag.lower()) in WATCHED:
            if close:
                self.handle_endtag(tag)
            else:
                self.handle_starttag(tag, attrs)

    def handle_starttag(self, tag: str, attrs: str) -> None:
        table = self.open_tables[-1] if self.open_tables else None
        if tag in ("td", "th"):
            if table and table["rows"]:
                self._close_cell(table)
                table["cell"] = (tag, [])
                self.texts.append(table["cell"][1])
        elif tag == "tr":
            if table:
                self._close_cell(table)
                table["row"] += 1
                table["rows"].append([])
        elif tag == "table":
            fresh = {"no": len(self.tables), "head": False, "row": -1, "cell": None, "headers": [], "links": [], "rows": []}
            self.tables.append(fresh)
            self.open_tables.append(fresh)
        elif tag == "thead" and table:
            table["head"] = True
        elif tag == "tbody" and table:
            table["head"] = False
        elif tag == "li":
            self.items += 1
        elif tag == "span":
            self.span_at.append(len(self.spans) if self.items else None)
            if self.items:
                self.spans.append("")
        elif tag == "a":
            in_row = table is not None and table["cell"] is not None
            self.link = {
                "table_no": table["no"] if in_row else None,
                "row_no": table["row"] if in_row else None,
                "col_no": len(table["rows"][-1]) if in_row else None,
                "text": "",
                "href": _href(attrs),
                "struck": False,
                "in_body": in_row and not table["head"] and table["cell"][0] == "td",
            }
            if in_row:
                self.links.append(self.link)
        elif tag == "del" and self.link is not None:
            self.link["struck"] = True

    def handle_endtag(self, tag: str) -> None:
        table = self.open_tables[-1] if self.open_tables else None
        if tag in ("td", "th", "tr"):
            if table and table["cell"] is not None:
                self._close_cell(table)
        elif tag == "table" and table:
            self._close_cell(table)
            self.open_tables.pop()
        elif tag == "thead" and table:
            self._close_cell(table)
            table["head"] = False
        elif tag == "li":
            self.items = max(0, self.items - 1)
        elif tag == "span" and self.span_at:
            self.span_at.pop()
        elif tag == "a" and self.link is not None:
            if table and self.link["col_no"] == 0:
                table["links"].append(self.link["text"].strip())
            self.link = None

    def handle_data(self, data: str) -> None:
        for text in self.texts:
            text.append(data)
        for at in self.span_at:
            if at is not None:
                self.spans[at] += data
        if self.link is not None:
            self.link["text"] += data

    def _close_cell(self, table: dict) -> None:
        if table["cell"] is None:
            return
        tag, parts = table["cell"]
        if self.texts[-1] is parts:
            self.texts.pop()
        else:
            self.texts = [text for text in self.texts if text is not parts]
        table["cell"] = None
        if tag == "td":
            table["rows"][-1].append("".join(parts))
        elif table["head"] or table["row"] == 0:
            table["headers"].append("".join(parts).strip())

    def result(self) -> tuple:
        for table in list(self.open_tables):
            self._close_cell(table)
        tables = [
            {"headers": t["headers"], "first_links": t["links"], "rows": [row for row in t["rows"] if row]}
            for t in self.tables
        ]
        links = [{**link, "text": link["text"].strip()} for link in self.links]
        return tables, links, [span.strip() for span in self.spans], None


def _href(attrs: str) -> str | None:
    found = HREF.search(" " + attrs)
    value = next((part for part in found.groups() if part is not None), None) if found else None
    return unescape(value) if value else value


def _read_page(html: str | None) -> tuple:
    """One page parsed. What goes wrong is returned as text, so one bad page fails no task."""
    try:
        reader = _PageReader()
        reader.read(html)
        return reader.result()
    except Exception as problem:  # noqa: BLE001
        return None, None, None, f"{type(problem).__name__}: {problem}"


def parse_pages(pages: DataFrame, html: str = "html") -> DataFrame:
    """Replace the page text by its tables, row links, list spans and an error text."""
    kept = [field for field in pages.schema if field.name != html]
    names = [field.name for field in kept]
    kinds = [(field.name, to_arrow_type(field.dataType)) for field in PARSED_FIELDS]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, PAGES_PER_STEP):
                some = batch.slice(start, PAGES_PER_STEP)
                parsed = [_read_page(text.as_py()) for text in some.column(html)]
                fields = [pa.array(column, kind) for column, (_, kind) in zip(zip(*parsed), kinds)]
                yield pa.RecordBatch.from_arrays([*[some.column(name) for name in names], *fields], [*names, *[name for name, _ in kinds]])

    return pages.select(*names, html).mapInArrow(read, T.StructType(kept + PARSED_FIELDS))


def split_errors(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Readable pages, and the quarantine of pages that could not be parsed."""
    return parsed.filter(F.col("error").isNull()).drop("error"), parsed.filter(F.col("error").isNotNull())


# --- links -------------------------------------------------------------------------------------


def page_links(html: ColumnLike) -> Column:
    """Array of (text, href) of a page's links in page order, by pattern matching alone.

    Comments, scripts and styles are cut out first. Only the five basic entities are decoded.
    """
    bare = F.regexp_replace(col(html), r"(?is)<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>", "")
    chunks = F.regexp_extract_all(bare, F.lit(r"(?is)<a\s[^>]*>.*?</a>"), F.lit(0))

    def decode(text: Column) -> Column:
        for entity, sign in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
            text = F.replace(text, F.lit(entity), F.lit(sign))
        return text

    def link(chunk: Column) -> Column:
        head = F.regexp_extract(chunk, r"(?is)^<a\s[^>]*>", 0)
        value = F.regexp_extract(head, r"(?is)\shref\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", 1)
        href = F.regexp_replace(value, r"^[\"']|[\"']$", "")
        text = F.regexp_replace(F.regexp_replace(chunk, r"(?s)<[^>]*>", ""), r"^\s+|\s+$", "")
        return F.struct(decode(text).alias("text"), decode(href).alias("href"))

    return F.transform(chunks, link)


def bare_host(url: ColumnLike) -> Column:
    """Host without a leading `www.`, null for relative links."""
    return F.regexp_replace(F.lower(F.try_parse_url(col(url), F.lit("HOST"))), r"^www\.", "")


def is_internal(page_url: ColumnLike, href: Column) -> Column:
    """A relative link, or one whose host belongs to the page's host."""
    host = bare_host(href)
    relative = ~href.rlike(r"^(?i)([a-z][a-z0-9+.-]*:|//)")
    return relative | F.coalesce(F.endswith(host, bare_host(page_url)), F.lit(False))


def pick_links(
    pages: DataFrame, url: str = "url", html: str = "html", kinds: Mapping[str, tuple[str, str]] = LINK_KINDS
) -> DataFrame:
    """Per page, the first link for each anchor text on the wanted side of the host border.

    `kinds` maps the exact anchor text to the output column and `internal` or `external`.
    """
    kept = [name for name in pages.columns if name != html]
    with_links = pages.select(
        *kept,
        F.transform(
            page_links(html),
            lambda a: F.struct(a["text"].alias("text"), a["href"].alias("href"), is_internal(url, a["href"]).alias("own")),
        ).alias("_links"),
    )

    def first(text: str, side: str) -> Column:
        hits = F.filter("_links", lambda a: (a["text"] == text) & (a["own"] == F.lit(side == "internal")))
        return F.try_element_at(hits, F.lit(1))["href"]

    return with_links.select(*kept, *[first(text, side).alias(name) for text, (name, side) in kinds.items()])


def first_external_link(
    pages: DataFrame, part: str = SCREENER_PART, url: str = "url", html: str = "html", output: str = "screener_link"
) -> DataFrame:
    """Per page, the first link to another host that contains `part`, else null."""
    kept = [name for name in pages.columns if name != html]
    hits = F.filter(page_links(html), lambda a: F.contains(a["href"], F.lit(part)) & ~is_internal(url, a["href"]))
    return pages.select(*kept, F.try_element_at(hits, F.lit(1))["href"].alias(output))


def listed_companies(parsed: DataFrame, url: str = "url") -> DataFrame:
    """Rows of a list page's table bodies: name, link and category. Rows whose first link is struck out are left out."""
    links = parsed.select(url, F.explode(F.filter("row_links", lambda link: link["in_body"])).alias("link"))
    rows = links.groupBy(url, F.col("link.table_no"), F.col("link.row_no")).agg(
        F.bool_or(F.col("link.struck") & (F.col("link.col_no") == 0)).alias("struck"),
        F.min_by(F.struct("link.text", "link.href"), F.struct("link.col_no", "link.text", "link.href")).alias("first"),
    )
    folder = F.try_element_at(F.split(url, "/"), F.lit(-2))
    return rows.filter(~F.col("struck")).select(
        F.col("first.text").alias("_text"),
        F.col("first.href").alias("Company_info_url"),
        F.when(F.contains(folder, F.lit("sme")), "SME").otherwise("EQ").alias("IPO_category"),
    ).select(clean_name("_text").alias("Company_name"), "Company_info_url", "IPO_category")


def profile_fields(links: Column, name: Column) -> list[Column]:
    """Profile columns from a page's name and its first three links."""
    first, second, third = (F.try_element_at(links, F.lit(at)) for at in (1, 2, 3))
    on_bse = F.contains(second, F.lit(BSE_HOST))
    nse = F.when(F.contains(third, F.lit(NSE_HOST)), third).when(F.contains(second, F.lit(NSE_HOST)), second)
    return [
        F.nullif(name, F.lit("")).alias("company_long_name"),
        F.when(~F.contains(first, F.lit(WEBSITE_EXCLUDED)), F.nullif(first, F.lit(""))).alias("company_website"),
        F.when(on_bse, second).alias("bse_link"),
        F.when(on_bse, link_symbol(second)).alias("bse_symbol"),
        nse.alias("nse_link"),
        query_symbol(nse).alias("nse_symbol"),
    ]


# --- tables ------------------------------------------------------------------------------------


def chosen_tables(tables: ColumnLike, purpose: str, identifiers: Mapping[str, Sequence[str]] = TABLE_IDENTIFIERS) -> Column:
    """The tables that hold a digit and a heading or first-cell link equal to an identifier."""
    wanted = F.array(*[F.lit(name) for name in identifiers[purpose]])
    has_digit = lambda texts: F.exists(texts, lambda text: text.rlike(r"\d"))
    return F.filter(
        col(tables),
        lambda t: F.arrays_overlap(F.concat(t["headers"], t["first_links"]), wanted)
        & (has_digit(t["headers"]) | has_digit(F.flatten(t["rows"]))),
    )


def _entries(tables: Column) -> Column:
    """(key, value) of all two-cell rows, in page order."""
    rows = F.flatten(F.transform(tables, lambda t: t["rows"]))
    pairs = F.filter(rows, lambda row: F.size(row) >= 2)
    return F.transform(
        pairs, lambda row: F.struct(clean_cell(row[0]).alias("key"), clean_cell(row[1]).alias("value"))
    )


def timeline_entries(spans: ColumnLike) -> Column:
    """List spans as (key, value): even places are labels, odd places their values."""
    labels = F.filter(col(spans), lambda text, at: at % 2 == 0)
    values = F.filter(col(spans), lambda text, at: at % 2 == 1)
    whole = F.filter(labels, lambda text, at: at < F.size(values))
    return F.zip_with(whole, values, lambda k, v: F.struct(k.alias("key"), v.alias("value")))


def _value_of(entries: Column, key: str) -> Column:
    """Value of the last entry with the key."""
    return F.try_element_at(F.filter(entries, lambda e: e["key"] == key), F.lit(-1))["value"]


def detail_rows(parsed: DataFrame, keys: Sequence[str], url: str = "url") -> DataFrame:
    """Key-value tables and the timeline as one row per page, one text column per key.

    Values are keyed by the first cell of their row. Later tables win; the timeline wins over tables
    while at most two of those were found.
    """
    tables = chosen_tables("tables", "detail")
    timeline = F.when(F.size(tables) < 3, timeline_entries("spans")).otherwise(F.array().cast("array<struct<key:string,value:string>>"))
    with_entries = parsed.select(url, F.concat(_entries(tables), timeline).alias("_entries"), F.size(tables).alias("_found"))
    return with_entries.filter("_found > 0").select(
        F.col(url).alias("detail_url"), *[_value_of(F.col("_entries"), key).alias(key) for key in keys]
    )


def review_rows(parsed: DataFrame, names: Sequence[str], url: str = "url") -> DataFrame:
    """First rows of the review tables: the first table speaks for brokers, later ones for members."""

    def entries(table: Column, at: Column) -> Column:
        who = F.when(at == 0, F.lit("Broker ")).otherwise(F.lit("Member "))
        row = F.try_element_at(table["rows"], F.lit(1))
        pairs = F.zip_with(
            table["headers"], row, lambda h, c: F.struct(F.concat(who, h).alias("key"), clean_cell(c).alias("value"))
        )
        return F.filter(pairs, lambda p: p["value"].isNotNull())

    tables = chosen_tables("tables", "review")
    found = parsed.select(
        url, F.flatten(F.transform(tables, entries)).alias("_entries"), F.size(tables).alias("_found")
    )
    return found.filter("_found > 0").select(
        F.col(url).alias("review_url"), *[_value_of(F.col("_entries"), name).alias(name) for name in names]
    )


def _cells(parsed: DataFrame, purpose: str, url: str) -> DataFrame:
    """Cells of the chosen tables as rows: url, table_no, row_no, header, text, and the row's cells."""
    tables = parsed.select(url, F.posexplode(chosen_tables("tables", purpose)).alias("table_no", "table"))
    rows = tables.select(url, "table_no", F.col("table.headers").alias("headers"), F.posexplode("table.rows").alias("row_no", "row"))
    cells = F.arrays_zip(F.col("headers").alias("header"), F.col("row").alias("text"))
    return rows.select(url, "table_no", "row_no", "headers", "row", F.explode(cells).alias("cell")).select(
        url, "table_no", "row_no", "headers", "row", F.col("cell.header").alias("header"), clean_cell("cell.text").alias("text")
    )


def _under(header: str) -> Column:
    """The row's cell below a heading."""
    at = F.array_position("headers", F.lit(header)).cast("int")
    return clean_cell(F.try_element_at(F.col("row"), F.nullif(at, F.lit(0))))


def subscription_series(parsed: DataFrame, names: Sequence[str], url: str = "url") -> DataFrame:
    """Subscription tables as one array per page: (day, place of the heading in `names`, table, row, number) of every cell below one of these headings.

    All of it happens in the row; pages are shuffled as short arrays, as the cells of a page landed twice are put together. Labels whose number is
    none that a day can have are left out here and named by `unreadable_days`.
    """
    known = [F.lit(part) for at, name in enumerate(names) for part in (name, at)]

    def cells(table: Column, number: Column) -> Column:
        places = F.transform(table["headers"], lambda header: F.when(header != "Date", F.try_element_at(F.create_map(*known), header)))
        columns = F.filter(F.transform(places, lambda place, at: F.struct(place.alias("place"), (at + 1).alias("column"))), lambda held: held["place"].isNotNull())
        heads = F.struct(F.nullif(F.array_position(table["headers"], F.lit("Date")).cast("int"), F.lit(0)).alias("date"), columns.alias("columns"))
        return let(heads, lambda head: F.flatten(F.transform(table["rows"], lambda row, at: below(head, row, number, at))))

    def below(head: Column, row: Column, number: Column, at: Column) -> Column:
        day = _label_day(F.regexp_extract(clean_cell(F.try_element_at(row, head["date"])), DAY_LABEL_PATTERN, 1))

        def entry(day: Column, held: Column) -> Column:
            value = to_number(clean_cell(F.try_element_at(row, held["column"])))
            return F.struct(day.alias("day"), held["place"].alias("place"), number.alias("table"), at.alias("row"), value.alias("value"))

        return let(day, lambda day: F.transform(F.filter(head["columns"], lambda _: day.isNotNull()), lambda held: entry(day, held)))

    entries = F.flatten(F.transform(chosen_tables("tables", "sbscrp"), cells))
    held = parsed.select(F.col(url).alias("sbscrp_url"), entries.alias("_entries"))
    return held.groupBy("sbscrp_url").agg(F.flatten(F.collect_list("_entries")).alias("entries")).filter(F.size("entries") > 0)


def _label_day(label: ColumnLike) -> Column:
    return F.regexp_extract(col(label), r"(\d+)", 1).try_cast("int")


def unreadable_days(parsed: DataFrame, url: str = "url") -> DataFrame:
    """(url, error) of subscription pages with a day label whose number cannot be read."""
    label = F.nullif(F.regexp_extract(_under("Date"), DAY_LABEL_PATTERN, 1), F.lit(""))
    labels = _cells(parsed, "sbscrp", url).select(url, label.alias("_label")).filter("_label IS NOT NULL")
    odd = labels.filter(_label_day("_label").isNull())
    return odd.groupBy(url).agg(F.concat(F.lit("day label: "), F.min("_label")).alias("error"))


def price_series(parsed: DataFrame, read: Callable[[Column, Column], Column], url: str = "url", metric: str = "GMP") -> DataFrame:
    """Grey-market tables as one array per page: `read(date text, price text)` of every row, in the order of the rows.

    A page's later tables overwrite the same rows of earlier ones. All of it happens in the row; pages are shuffled as short arrays, for those landed twice.
    """

    def rows(table: Column) -> Column:
        places = F.struct(*[F.array_position(table["headers"], F.lit(head)).cast("int").alias(name) for name, head in (("price", metric), ("date", "GMP Date"))])
        return let(places, lambda at: F.when(at["price"] > 0, F.transform(table["rows"], lambda row: one(row, at))).otherwise(nothing))

    def one(row: Column, at: Column) -> Column:
        """A row's texts; its date is bound, as the expressions on it name it more than once."""
        cell = lambda place: F.when(place > 0, F.try_element_at(row, place))
        dated = F.regexp_extract(clean_cell(cell(at["date"])), PRICE_DAY_PATTERN, 1)
        return let(dated, lambda date: read(F.nullif(date, F.lit("")), clean_cell(cell(at["price"]))))

    def rows_of(tables: Column) -> Column:
        """Row by row, what the last table with that row says; the tables are bound once, as every row looks at them."""
        longest = F.array_max(F.transform(tables, F.size))
        last = lambda at: F.element_at(F.element_at(F.filter(tables, lambda table: F.size(table) >= at), -1), at)
        merged = F.when(F.size(tables) == 1, F.element_at(tables, 1)).otherwise(F.transform(F.sequence(F.lit(1), longest), last))
        return F.when(longest > 0, merged)

    nothing = F.filter(F.array(read(F.lit(None).cast("string"), F.lit(None).cast("string"))), lambda _: F.lit(False))
    series = parsed.select(F.col(url).alias("grmkpt_url"), let(F.transform(chosen_tables("tables", "grmkpt"), rows), rows_of).alias("_series"))
    # pages without a series are left out last: a filter on the series itself would have it made twice
    return series.groupBy("grmkpt_url").agg(F.max("_series").alias("series")).filter(F.col("series").isNotNull())


def price_rows(parsed: DataFrame, url: str = "url", metric: str = "GMP") -> DataFrame:
    """Grey-market tables in long form: url, day number (place of the row), date text, price text."""
    held = price_series(parsed, lambda date, price: F.struct(date.alias("date_text"), price.alias("price_text")), url, metric)
    rows = held.select("grmkpt_url", F.posexplode("series").alias("_at", "_row"))
    return rows.select("grmkpt_url", (F.col("_at") + 1).alias("day"), "_row.date_text", "_row.price_text")
