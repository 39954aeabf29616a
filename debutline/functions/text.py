"""Cleaning of names, numbers, links and symbols found in page text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from debutline.functions.common import ColumnLike, col, let
from debutline.schema import SENTINELS

# --- fixed values -----------------------------------------------------------------------------
NAME_REPLACEMENTS = [
    ("Corp.", "Corporation "),
    ("Ltd.", "Limited"),
    ("Co.", "Company "),
    (" IPO", ""),
]
NUMBER_PATTERN = r"\d+\.?\d*"
INTEGER_PATTERN = r"\d+"
ISSUE_SIZE_PATTERN = r"₹([^C]+?)Cr"
CELL_SYMBOLS_PATTERN = r"[$€£¥,]"
SEARCH_NAME_PATTERN = r"mainpage\+(.+?)&[^=]*="
SEARCH_TEMPLATES = {
    "google.com": "https://www.google.com/search?q=screener.in+mainpage+{company}&pws=0&gl=IN&hl=en",
    "google.co.in": "https://www.google.co.in/search?q=screener.in+mainpage+{company}&pws=0&hl=en",
    "duckduckgo.com": "https://duckduckgo.com/?q=screener.in+mainpage+{company}&t=h_&ia=web",
}
# --- end of fixed values ----------------------------------------------------------------------


def clean_name(name: ColumnLike) -> Column:
    """Expand company-name abbreviations, in the listed order."""
    out = col(name)
    for old, new in NAME_REPLACEMENTS:
        out = F.replace(out, F.lit(old), F.lit(new))
    return out


def null_sentinels(text: ColumnLike, sentinels: Sequence[str] = SENTINELS) -> Column:
    """Text that stands for a missing value becomes null."""
    return F.when(~col(text).isin(list(sentinels)), col(text))


def null_nan(number: ColumnLike) -> Column:
    return F.nanvl(col(number), F.lit(None).cast("double"))


def null_zero(number: ColumnLike) -> Column:
    return F.nullif(col(number), F.lit(0))


def clean_cell(text: ColumnLike) -> Column:
    """Trim a table cell and drop currency signs and thousands commas; the rupee sign stays."""
    trimmed = F.btrim(col(text), F.lit(" \t\n\x0b\f\r"))
    return F.regexp_replace(trimmed, CELL_SYMBOLS_PATTERN, "")


def to_number(text: ColumnLike) -> Column:
    """Lenient number; anything unreadable, NaN included, is null."""
    return null_nan(col(text).try_cast("double"))


def rupees(text: ColumnLike) -> Column:
    return to_number(F.replace(col(text), F.lit("₹"), F.lit("")))


def first_number(text: ColumnLike) -> Column:
    return F.regexp_substr(col(text), F.lit(NUMBER_PATTERN)).try_cast("double")


def last_number(text: ColumnLike) -> Column:
    found = F.regexp_extract_all(col(text), F.lit(NUMBER_PATTERN), F.lit(0))
    return F.try_element_at(found, F.lit(-1)).try_cast("double")


def first_integer(text: ColumnLike) -> Column:
    return F.regexp_substr(col(text), F.lit(INTEGER_PATTERN)).try_cast("bigint")


def issue_size(text: ColumnLike) -> Column:
    """The amount in crore; commas were dropped with the cell clean-up."""
    amount = F.regexp_extract(col(text), ISSUE_SIZE_PATTERN, 1)
    return F.trim(amount).try_cast("double")


def link_symbol(link: ColumnLike) -> Column:
    """Symbol from an exchange link: the last path part when the one before it holds a dash,
    else the one before it."""

    def pick(parts: Column) -> Column:
        before = F.try_element_at(parts, F.lit(-2))
        return F.when(F.contains(before, F.lit("-")), F.element_at(parts, -1)).otherwise(before)

    return let(F.split(F.rtrim(col(link), F.lit("/")), "/"), pick)


def query_symbol(link: ColumnLike) -> Column:
    """What follows `?symbol=`, or the whole text when the marker is absent."""
    return F.element_at(F.split(col(link), r"\?symbol="), -1)


def bracket_symbol(text: ColumnLike) -> Column:
    """`"(X | Y)"` to `X`."""
    bare = F.trim(F.trim(col(text)), F.lit("()"))
    return F.trim(F.split_part(bare, F.lit("|"), F.lit(1)))


def preferred_symbol(*symbols: ColumnLike) -> Column:
    """First symbol that is neither null nor empty."""
    return F.coalesce(*[F.nullif(col(symbol), F.lit("")) for symbol in symbols])


def search_url(name: ColumnLike, engine: str = "google.co.in") -> Column:
    before, after = SEARCH_TEMPLATES[engine].split("{company}")
    term = F.replace(F.replace(col(name), F.lit("&"), F.lit("and")), F.lit(" "), F.lit("+"))
    return F.concat(F.lit(before), term, F.lit(after))


def searched_name(url: ColumnLike) -> Column:
    """The company name a search address was built from, null when it holds none."""
    term = F.nullif(F.regexp_extract(col(url), SEARCH_NAME_PATTERN, 1), F.lit(""))
    return F.replace(term, F.lit("+"), F.lit(" "))


def add_strict(*numbers: ColumnLike) -> Column:
    """Sum that is null when any part is null."""
    total = col(numbers[0])
    for number in numbers[1:]:
        total = total + col(number)
    return total
