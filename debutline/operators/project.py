"""Projections: conforming, renaming, fallbacks and simple row filters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from debutline.functions.text import null_nan, null_sentinels
from debutline.functions.dates import date_text, stored_date
from debutline.schema import OFFERING_TYPES, RENAMES


def conform(df: DataFrame, columns: Mapping[str, T.DataType]) -> DataFrame:
    """Exactly the given columns in the given order: missing ones null, others dropped."""
    present = set(df.columns)
    return df.select(
        [(F.col(name) if name in present else F.lit(None).cast(kind)).alias(name) for name, kind in columns.items()]
    )


def rename(df: DataFrame, names: Mapping[str, str] = RENAMES) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def select_as(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Project and rename at once."""
    return df.select([F.col(old).alias(new) for old, new in names.items()])


def stack(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of all frames; columns a frame lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def with_default(df: DataFrame, column: str, value: object = 0) -> DataFrame:
    """Add a constant column where the frame has none of that name."""
    return df if column in df.columns else df.withColumn(column, F.lit(value))


def fallback(df: DataFrame, column: str, *choices: Column) -> DataFrame:
    """Row by row, the first known value among the column itself and the given choices."""
    own = [F.col(column)] if column in df.columns else []
    return df.withColumn(column, F.coalesce(*own, *choices))


def existing(df: DataFrame, name: str, kind: str = "string") -> Column:
    """The column, or a null of that type when the frame lacks it."""
    return F.col(name) if name in df.columns else F.lit(None).cast(kind)


def drop_value(df: DataFrame, column: str, value: object) -> DataFrame:
    """Drop rows holding the value; rows with a null stay."""
    return df.filter(~F.col(column).eqNullSafe(F.lit(value)))


def drop_nulls(df: DataFrame, how: str = "any", subset: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop(how=how, subset=list(subset) if subset else None)


def split_target(df: DataFrame, target: str) -> tuple[DataFrame, DataFrame]:
    return df.drop(target), df.select(target)


def matching_days(df: DataFrame, metric: str, names: Sequence[str]) -> DataFrame:
    """Long-form rows whose metric is one of the names; a name followed by a bracket is another one."""
    pattern = "^(?:" + "|".join(quoted(name) for name in names) + r")(?!\s*\()"
    return df.filter(F.col(metric).rlike(pattern))


def quoted(text: str) -> str:
    return r"\Q" + text + r"\E"


def clean_stored(df: DataFrame, types: Mapping[str, T.DataType] = OFFERING_TYPES) -> DataFrame:
    """Stored text to typed columns: sentinels to null, dates read leniently, numbers cast."""

    def typed(name: str) -> Column:
        kind = types.get(name)
        held = df.schema[name].dataType
        column = null_sentinels(name) if isinstance(held, T.StringType) else F.col(name)
        if isinstance(kind, T.DateType) and isinstance(held, T.StringType):
            return stored_date(column)
        if isinstance(kind, T.DoubleType):
            return null_nan(column.try_cast("double"))
        return column if kind is None else column.try_cast(kind)

    return df.select([typed(name).alias(name) for name in df.columns])


def stored_text(df: DataFrame) -> DataFrame:
    """Typed columns to the form a stored table keeps: dates as `yyyy-MM-dd` text."""
    dates = [field.name for field in df.schema if isinstance(field.dataType, (T.DateType, T.TimestampType))]
    return df.withColumns({name: date_text(name) for name in dates}) if dates else df


def list_urls(categories: DataFrame, template: str, category: str, first_year: str, last_year: str) -> DataFrame:
    """One row per category and year of its range, with the formatted address."""
    years = F.explode(F.sequence(F.col(first_year), F.col(last_year))).alias("year")
    return categories.select(F.col(category).alias("category"), years).withColumn(
        "url", F.format_string(template, "category", "year")
    )


def to_records(df: DataFrame, column: str = "record") -> DataFrame:
    """One JSON text per row."""
    return df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias(column))
