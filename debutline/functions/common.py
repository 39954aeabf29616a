"""Small helpers shared by the expression modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def col(value: ColumnLike) -> Column:
    return F.col(value) if isinstance(value, str) else value


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind `value` once and use it many times inside `body`."""
    return F.element_at(F.transform(F.array(value), body), 1)


def let2(first: Column, second: Column, body: Callable[[Column, Column], Column]) -> Column:
    """Bind two values that differ in type."""
    return F.element_at(F.zip_with(F.array(first), F.array(second), body), 1)
