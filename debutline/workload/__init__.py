"""Every operator bound to the given tables, with SQL for the same result where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
Case = tuple[Query, str | None]


def all_cases() -> dict[str, Case]:
    from debutline.workload import jobs, learning, pages, relations, scalars, series, storage

    cases: dict[str, Case] = {}
    for module in (scalars, relations, series, pages, learning, storage, jobs):
        cases.update(module.CASES)
    return cases
