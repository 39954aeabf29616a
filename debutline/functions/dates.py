"""Lenient date parsing and date text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from debutline.functions.common import ColumnLike, col, let

# --- fixed values -----------------------------------------------------------------------------
# page formats, written as Spark patterns; a leading weekday is cut off before parsing
TIMELINE_FORMAT = "MMM d, yyyy"
CELL_FORMAT = "MMM d yyyy"
RANGE_FORMAT = "d MMM yyyy"
PRICE_DAY_FORMAT = "d-M-yyyy"
STORED_FORMAT = "yyyy-MM-dd"
PAGE_FORMATS = [TIMELINE_FORMAT, CELL_FORMAT, RANGE_FORMAT, PRICE_DAY_FORMAT]
# --- end of fixed values ----------------------------------------------------------------------

# what a text must look like before its format is tried: a failed parse costs far more than a match
SHAPES = {
    TIMELINE_FORMAT: r"^[A-Za-z]{3} \d{1,2}, \d{4}$",
    CELL_FORMAT: r"^[A-Za-z]{3} \d{1,2} \d{4}$",
    RANGE_FORMAT: r"^\d{1,2} [A-Za-z]{3} \d{4}$",
    PRICE_DAY_FORMAT: r"^\d{1,2}-\d{1,2}-\d{4}$",
    STORED_FORMAT: r"^\d{4}-\d{2}-\d{2}$",
}

WEEKDAY_PREFIX = r"^[A-Za-z]{3},? (?=[A-Za-z]{3} )"


def parse_date(text: ColumnLike, formats: Sequence[str] = tuple(PAGE_FORMATS)) -> Column:
    """First format that reads the text; null when none does."""
    bare = F.regexp_replace(F.trim(col(text)), WEEKDAY_PREFIX, "")
    return F.coalesce(*[_dated(bare, fmt) for fmt in formats])


def _dated(text: Column, fmt: str) -> Column:
    return F.when(text.rlike(SHAPES[fmt]), F.try_to_date(text, fmt))


def stored_date(text: ColumnLike) -> Column:
    """Date kept as `yyyy-MM-dd` text in a stored table."""
    return _dated(col(text), STORED_FORMAT)


def date_text(date: ColumnLike) -> Column:
    return F.date_format(col(date), STORED_FORMAT)


def range_dates(text: ColumnLike) -> Column:
    """`"29 to 31 Jul 2025"` to a struct of open and close dates.

    Month and year that the left side leaves out come from the right side. When the left month is
    later in the year than the right one, the range crosses New Year.
    """

    def sides(parts: Column) -> Column:
        left = F.split(F.trim(F.element_at(parts, 1)), r"\s+")
        right = F.split(F.trim(F.try_element_at(parts, F.lit(2))), r"\s+")
        return F.struct(left.alias("left"), right.alias("right"))

    def dates(side: Column) -> Column:
        left, right = side["left"], side["right"]
        month = F.coalesce(F.try_element_at(left, F.lit(2)), F.try_element_at(right, F.lit(2)))
        year = F.coalesce(F.try_element_at(left, F.lit(3)), F.try_element_at(right, F.lit(3)))
        opened = F.try_to_date(F.concat_ws(" ", F.element_at(left, 1), month, year), RANGE_FORMAT)
        closed = F.try_to_date(F.array_join(right, " "), RANGE_FORMAT)
        own_year = F.size(left) > 2
        return F.struct(opened.alias("open"), closed.alias("close"), own_year.alias("own_year"))

    def settle(found: Column) -> Column:
        crosses = ~found["own_year"] & (found["open"] > found["close"])
        opened = F.when(crosses, F.add_months(found["open"], -12)).otherwise(found["open"])
        return F.struct(opened.alias("open"), found["close"].alias("close"))

    parts = F.split(col(text), " to ")
    return let(let(let(parts, sides), dates), settle)


def month_start(date: ColumnLike, months: int = 0) -> Column:
    """First day of the month that lies `months` away."""
    return F.trunc(F.add_months(col(date), months), "MM")


def month_name(date: ColumnLike, months: int = 0) -> Column:
    return F.date_format(F.add_months(col(date), months), "MMMM")


def month_year(date: ColumnLike, months: int = 0) -> Column:
    return F.date_format(F.add_months(col(date), months), "yyyy")
