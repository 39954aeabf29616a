"""Null counts, schema conformance and the routing of checked splits."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _unpivot(one_row: DataFrame, names: Sequence[str], fields: Mapping[str, str]) -> DataFrame:
    """One row of `<field>_<at>` aggregates to one row per name."""
    rows = [
        F.struct(F.lit(name).alias("column"), *[F.col(f"{field}_{at}").cast(kind).alias(field) for field, kind in fields.items()])
        for at, name in enumerate(names)
    ]
    return one_row.select(F.inline(F.array(*rows)))


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows and nulls per column, from one pass."""
    parts = []
    for at, name in enumerate(columns):
        parts += [F.count(F.lit(1)).alias(f"total_{at}"), F.count_if(F.col(name).isNull()).alias(f"nulls_{at}")]
    return _unpivot(df.agg(*parts), columns, {"total": "bigint", "nulls": "bigint"})


def schema_report(df: DataFrame, expected: Mapping[str, T.DataType]) -> DataFrame:
    """Per expected column: is it there, and how many rows, nulls and values that fail the cast."""
    held = set(df.columns)
    total, parts = F.count(F.lit(1)), []
    for at, (name, kind) in enumerate(expected.items()):
        value = F.col(name) if name in held else F.lit(None).cast("string")
        bad = value.isNotNull() & value.try_cast(kind).isNull()
        parts += [
            F.lit(name in held).alias(f"present_{at}"),
            total.alias(f"total_{at}"),
            F.count_if(value.isNull()).alias(f"nulls_{at}"),
            F.count_if(bad).alias(f"bad_casts_{at}"),
        ]
    fields = {"present": "boolean", "total": "bigint", "nulls": "bigint", "bad_casts": "bigint"}
    return _unpivot(df.agg(*parts), list(expected), fields)


def schema_conforms(report: DataFrame, column_count: int, expected_count: int) -> bool:
    """True when the width is right, nothing expected is missing and every value casts."""
    faults = report.agg(F.count_if(~F.col("present") | (F.col("bad_casts") > 0)).alias("faults")).first()
    return column_count == expected_count and faults["faults"] == 0


def route_splits(splits: Mapping[str, DataFrame], passed: bool, path: str) -> str:
    """Write every split below `validated/` or, when a check failed, below `invalid/`."""
    folder = f"{path.rstrip('/')}/{'validated' if passed else 'invalid'}"
    for name, frame in splits.items():
        frame.write.mode("overwrite").parquet(f"{folder}/{name}")
    return folder


@dataclass(frozen=True)
class Counted:
    """Rows that are counted as they pass; `rows` waits until a job has read all of `frame` and needs no job of its own."""

    frame: DataFrame
    observation: Observation

    @property
    def rows(self):
        return self.observation.get["rows"]


def counted(df: DataFrame, name: str, total: Column | None = None) -> Counted:
    """Count rows as they pass, or take another aggregate of them."""
    observation = Observation(f"{name}-{uuid.uuid4().hex}")
    return Counted(df.observe(observation, (total if total is not None else F.count(F.lit(1))).alias("rows")), observation)
