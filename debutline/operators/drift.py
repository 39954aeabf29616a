"""Two-sample Kolmogorov-Smirnov drift test over many columns."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from debutline.schema import DRIFT_THRESHOLD
from debutline.session import cut_lineage

SKIP_NOTE = "Skipped due to NaN values"

REPORT_SCHEMA = T.StructType(
    [
        T.StructField("column", T.StringType()),
        T.StructField("n_base", T.LongType()),
        T.StructField("n_current", T.LongType()),
        T.StructField("statistic", T.DoubleType()),
        T.StructField("p_value", T.DoubleType()),
        T.StructField("drift_status", T.BooleanType()),
        T.StructField("note", T.StringType()),
    ]
)


def ks_probability(distance: float, n1: int, n2: int, exact: bool = False) -> float:
    """Two-sided p-value from the limiting distribution, whatever the sizes.

    With `exact` it is counted on the lattice of both samples, which takes (n1 + n2) * n1 steps on the driver.
    """
    if exact:
        return _exact_probability(distance, n1, n2)
    size = round(n1 * n2 / (n1 + n2))
    root = math.sqrt(size)
    # limiting series with Vrbik's (2018) small-sample shift of its argument
    z = distance * root
    z += 1 / (6 * root) + (z - 1) / (4 * size)
    if z < 0.2:
        return 1.0
    terms = (2 * (-1) ** (k - 1) * math.exp(-2 * (k * z) ** 2) for k in range(1, 101))
    return min(1.0, max(0.0, sum(terms)))


def _exact_probability(distance: float, n1: int, n2: int) -> float:
    """Share of the interleavings of the two samples whose largest gap is at least `distance`.

    Walks the lattice by anti-diagonals; `alive[i]` is the chance that a random walk at (i, k - i) has
    stayed inside the gap so far.
    """
    unit = n1 // math.gcd(n1, n2) * n2
    gap = round(distance * unit)
    if gap == 0:
        return 1.0
    step1, step2 = unit // n1, unit // n2
    at = np.arange(n1 + 1)
    alive = np.zeros(n1 + 1)
    alive[0] = 1.0
    for k in range(1, n1 + n2 + 1):
        moved = alive * (k - at) / k
        moved[1:] += alive[:-1] * at[1:] / k
        other = k - at
        inside = (other >= 0) & (other <= n2) & (np.abs(at * step1 - other * step2) < gap)
        alive = np.where(inside, moved, 0.0)
    return float(min(1.0, max(0.0, 1.0 - alive[n1])))


def ks_statistics(base: DataFrame, current: DataFrame, columns: Sequence[str], slots: int = 128) -> list[dict]:
    """Exact largest gap between the two distribution functions, per column.

    Few passes keep the work small at any size:

    1. row and null counts and approximate quantiles give up to `slots` value ranges per column;
    2. rows are counted per distinct value, once; exact counts per range give the gap at every range end, and the most a gap can reach inside;
    3. ranges that could beat the best range end are cut at quantiles of their own and counted again, until none is left.

    No range is ever sorted or gathered; the driver sees `slots` rows per open range.
    """
    both = base.select(*columns, F.lit(1).alias("_base")).unionByName(current.select(*columns, F.lit(0).alias("_base")))
    is_base, known = F.col("_base") == 1, {}
    steps = F.array(*[F.lit(at / slots) for at in range(1, slots)])
    parts = [F.count_if(is_base).alias("n_base"), F.count_if(~is_base).alias("n_current")]
    for at, name in enumerate(columns):
        value = F.nanvl(F.col(name).cast("double"), F.lit(None).cast("double"))
        parts.append(F.percentile_approx(value, steps, 20 * slots).alias(f"edges_{at}"))
        parts.append(F.count_if(value.isNull()).alias(f"nulls_{at}"))
    first = both.agg(*parts).first()
    n_base, n_current = first["n_base"], first["n_current"]
    out = {}
    for at, name in enumerate(columns):
        clean = first[f"nulls_{at}"] == 0 and n_base > 0 and n_current > 0
        out[name] = {"column": name, "n_base": n_base, "n_current": n_current, "statistic": None}
        if clean:
            known[name] = sorted({edge + 0.0 for edge in first[f"edges_{at}"] if math.isfinite(edge)})
    if not known:
        return list(out.values())

    # a negative zero equals zero but would be put below it
    cells = F.explode(F.array(*[F.struct(F.lit(n).alias("column"), (F.col(n).cast("double") + 0.0).alias("value")) for n in known]))
    long = both.select("_base", cells.alias("cell")).select("_base", "cell.*")
    # rows count by their value alone: written once, every pass goes over distinct values
    long = cut_lineage(long.groupBy("column", "value").agg(F.count_if(is_base).alias("c1"), F.count_if(~is_base).alias("c2")), "values")
    slot = F.lit(None).cast("int")
    for name, edges in known.items():
        slot = F.when(F.col("column") == name, _edges_up_to(F.array(*[F.lit(edge) for edge in edges]).cast("array<double>"), F.col("value"))).otherwise(slot)
    counts = (F.sum("c1").alias("c1"), F.sum("c2").alias("c2"))
    per_slot: dict[str, list] = {name: [] for name in known}
    for row in long.withColumn("slot", slot).groupBy("column", "slot").agg(*counts).collect():
        per_slot[row["column"]].append((row["slot"], row["c1"], row["c2"]))

    best, open_ranges = dict.fromkeys(known, 0.0), []
    for name, rows in per_slot.items():
        ends = [None, *known[name], None]
        ranges = [(ends[int(slot)], ends[int(slot) + 1], c1, c2, True) for slot, c1, c2 in sorted(rows)]
        open_ranges += _could_beat(name, ranges, 0, 0, n_base, n_current, best)
    while open_ranges := [held for held in open_ranges if held[-1] > best[held[0]]]:
        found = _cut_again(long, open_ranges, steps, 20 * slots)
        open_ranges = []
        for (name, before1, before2), ranges in found.items():
            open_ranges += _could_beat(name, ranges, before1, before2, n_base, n_current, best)
    for name in known:
        out[name]["statistic"] = best[name]
    return list(out.values())


def _could_beat(name: str, ranges: list[tuple], before1: int, before2: int, n_base: int, n_current: int, best: dict) -> list[tuple]:
    """Raise `best` by the gaps at the range ends; return the ranges of several values inside which a gap could be larger.

    `ranges` are (low, high, rows of either side, several values) in ascending order, after `before1` and `before2` rows.
    """
    seen, out = [], []
    for low, high, c1, c2, several in ranges:
        seen.append((low, high, before1, before2, c1, c2, several))
        before1, before2 = before1 + c1, before2 + c2
        best[name] = max(best[name], abs(before1 / n_base - before2 / n_current))
    for low, high, at1, at2, c1, c2, several in seen:
        most = max((at1 + c1) / n_base - at2 / n_current, (at2 + c2) / n_current - at1 / n_base)
        if several and most > best[name]:
            out.append((name, low, high, at1, at2, most))
    return out


def _cut_again(long: DataFrame, open_ranges: list[tuple], steps: Column, accuracy: int) -> dict[tuple, list[tuple]]:
    """Each open range cut at its own quantiles: (column, rows before) to ranges as `_could_beat` takes them.

    A range shrinks by the number of steps each time, however its values lie, and ends as a single value at the latest.
    """
    spark = long.sparkSession
    schema = "at int, name string, low double, high double"
    rows = [(at, name, low, high) for at, (name, low, high, *_) in enumerate(open_ranges)]
    todo = F.broadcast(spark.createDataFrame(rows, schema))  # at most as many as there are steps, per column
    value = F.col("value")
    inside = long.join(
        todo, (F.col("column") == F.col("name")) & (F.col("low").isNull() | (value >= F.col("low"))) & (F.col("high").isNull() | (value < F.col("high")))
    )
    spread = inside.groupBy("at").agg(F.percentile_approx(value, steps, accuracy).alias("edges"), F.min(value).alias("least"), F.max(value).alias("most"))
    # the middle and the greatest value part every range that holds two values, however many rows one of them has
    edges = {row["at"]: sorted({*row["edges"], row["least"] / 2 + row["most"] / 2, row["most"]}) for row in spread.collect()}
    cut = F.broadcast(spark.createDataFrame(list(edges.items()), "cut int, edges array<double>"))
    placed = inside.join(cut, F.col("at") == F.col("cut")).withColumn("slot", _edges_up_to(F.col("edges"), value))
    counts = placed.groupBy("at", "slot").agg(F.sum("c1").alias("c1"), F.sum("c2").alias("c2"), (F.min(value) < F.max(value)).alias("several")).collect()
    out: dict[tuple, list[tuple]] = {}
    for row in sorted(counts, key=lambda r: (r["at"], r["slot"])):
        name, low, high, before1, before2, _ = open_ranges[row["at"]]
        ends = [low, *edges[row["at"]], high]
        part = (ends[row["slot"]], ends[row["slot"] + 1], row["c1"], row["c2"], row["several"])
        out.setdefault((name, before1, before2), []).append(part)
    return out


def _edges_up_to(edges: Column, value: Column) -> Column:
    """Number of sorted edges not above the value."""
    return F.size(F.filter(edges, lambda edge: edge <= value))


def edges_below(edges: Sequence[float], value: Column) -> Column:
    """Number of sorted edges smaller than the value, by halving steps."""
    steps = [1 << bit for bit in range(len(edges).bit_length() - 1, -1, -1)]
    held = F.array(*[F.lit(edge) for edge in edges])

    def step(low: Column, width: Column) -> Column:
        fits = F.coalesce(F.try_element_at(held, low + width) < value, F.lit(False))
        return F.when(fits, low + width).otherwise(low)

    return F.aggregate(F.array(*[F.lit(width) for width in steps]), F.lit(0), step)


def drift_report(
    base: DataFrame,
    current: DataFrame,
    columns: Sequence[str],
    threshold: float = DRIFT_THRESHOLD,
    exact: bool = False,
) -> DataFrame:
    """One row per column: sizes, statistic, p-value, verdict. Columns with a null on a side are skipped.

    `exact` chooses the method of `ks_probability`; it never depends on the sizes.
    """
    rows = []
    for found in ks_statistics(base, current, columns):
        if found["statistic"] is None:
            rows.append((found["column"], found["n_base"], found["n_current"], None, None, None, SKIP_NOTE))
            continue
        p_value = ks_probability(found["statistic"], found["n_base"], found["n_current"], exact)
        rows.append(
            (found["column"], found["n_base"], found["n_current"], found["statistic"], p_value, p_value < threshold, None)
        )
    return base.sparkSession.createDataFrame(rows, REPORT_SCHEMA)


def drift_free(report: DataFrame) -> bool:
    """True when no column drifted."""
    return report.filter("drift_status").isEmpty()
