"""Lookups between tables: refresh filter, link joins, first matches, windows in time, attempts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from debutline.functions.text import preferred_symbol
from debutline.operators.project import drop_nulls, drop_value
from debutline.schema import RETRY_LIMIT


def refresh_filter(
    scraped: DataFrame,
    store: DataFrame,
    name: str = "Company_name",
    stored_name: str = "IPO_company_name",
    price: str = "IPO_listing_price",
    category: str | None = "IPO_category",
    dropped: str = "SME",
) -> DataFrame:
    """Scraped rows that are new, or that the store holds with a missing price.

    The complement is easier: a name is finished when it is stored and all its prices are known. The
    store shrinks to finished names before any join, and one anti join does the rest.
    """
    if category:
        scraped = drop_value(scraped, category, dropped)
    finished = (
        store.groupBy(F.col(stored_name).alias("_finished"))
        .agg(F.bool_and(F.col(price).isNotNull()).alias("_done"))
        .filter("_done")
        .select("_finished")
    )
    kept = scraped.join(finished, scraped[name] == F.col("_finished"), "left_anti")
    return drop_nulls(kept)


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The row earliest in `order_by` for each key, by plain aggregation (see `last_per_key`)."""
    rest = [name for name in df.columns if name not in keys]
    row = F.struct(*rest)
    grouped = df.groupBy(*keys).agg(F.min_by(row, F.struct(*order_by, row)).alias("_row"))
    return grouped.select(*keys, *[F.col("_row")[name].alias(name) for name in rest])


def lookup_first(
    df: DataFrame, key: str, dimension: DataFrame, dim_key: str, values: Sequence[str], order_by: Sequence[str]
) -> DataFrame:
    """Add the values of the first dimension row with the same key; null when there is none.

    The dimension is reduced to one row per key first, so the join never adds rows. Whether it is
    broadcast is left to Spark, which knows its size at run time.
    """
    rest = list(dict.fromkeys([dim_key, *values, *order_by]))
    first = first_per_key(dimension.select(*rest).filter(F.col(dim_key).isNotNull()), [dim_key], order_by)
    found = first.select(F.col(dim_key).alias("_dim_key"), *values)
    return df.join(found, df[key] == F.col("_dim_key"), "left").drop("_dim_key")


def attach(df: DataFrame, details: DataFrame, link: str, detail_link: str, order_by: Sequence[str]) -> DataFrame:
    """Add a detail frame by link. Of several detail rows for one link the first in order is used."""
    values = [name for name in details.columns if name not in {detail_link, *order_by}]
    return lookup_first(df, link, details, detail_link, values, order_by)


def replace_by_lookup(
    df: DataFrame, column: str, key: str, dimension: DataFrame, dim_key: str, value: str, order_by: Sequence[str]
) -> DataFrame:
    """Overwrite a column with the looked-up value, with null too when there is none."""
    source = dimension.withColumnRenamed(value, "_found")
    order = ["_found" if name == value else name for name in order_by]
    out = lookup_first(df, key, source, dim_key, ["_found"], order)
    return out.withColumn(column, F.col("_found")).drop("_found")


def listing_prices(
    df: DataFrame,
    instruments: DataFrame,
    candles: DataFrame,
    list_date: str = "IPO_list_date",
    symbols: Sequence[str] = ("nse_symbol", "bse_symbol"),
    opens_at: str = "09:00",
    closes_at: str = "10:00",
    output: str = "IPO_listing_price",
    instrument_order: str = "position",
) -> DataFrame:
    """Opening price of the first candle between the two times on the listing day.

    The window is the same on every day, so candles shrink to one row per instrument and day before
    the join, which then is a plain equi join on (exchange, token, day).
    """
    daytime = F.date_format("ts", "HH:mm:ss")
    first = (
        candles.filter((daytime >= f"{opens_at}:00") & (daytime <= f"{closes_at}:00"))
        .groupBy("exchange", "token", F.to_date("ts").alias("_day"))
        .agg(F.min_by("open", F.struct("ts", "open")).alias(output))
        .withColumnsRenamed({"exchange": "_exchange", "token": "_token"})
    )
    with_symbol = df.withColumn("_symbol", preferred_symbol(*symbols))
    with_token = lookup_first(
        with_symbol,
        "_symbol",
        instruments.withColumnsRenamed({"token": "_of_token", "exch_seg": "_of_exchange"}),
        "symbol",
        ["_of_token", "_of_exchange"],
        [instrument_order],
    )
    on = (
        (F.col("_of_token") == F.col("_token"))
        & (F.col("_of_exchange") == F.col("_exchange"))
        & (F.col(list_date) == F.col("_day"))
    )
    return with_token.join(first, on, "left").drop(
        "_symbol", "_of_token", "_of_exchange", "_token", "_exchange", "_day"
    )


def first_within(
    starts: DataFrame,
    readings: DataFrame,
    keys: Sequence[str],
    start: str,
    ts: str,
    value: str,
    width: dt.timedelta,
    tie: str,
    output: str = "first_value",
) -> DataFrame:
    """For each start, the value of the first reading of its key in [start, start + width].

    No pairs are formed. Time is cut into slots as wide as the window, so a window touches its own
    slot and the next: each reading is placed in two slots, each start in one. Inside (key, slot) a
    single backward running pass carries the nearest later reading to the starts. A busy key is cut
    into as many pieces as it has slots, and readings shrink to one row per key and instant first.
    """
    seconds = int(width.total_seconds())
    slot = lambda at: F.floor(F.unix_micros(at.cast("timestamp")) / (seconds * 1_000_000))
    once = (
        readings.filter(F.col(ts).isNotNull())
        .groupBy(*keys, F.col(ts).alias("_at"))
        .agg(F.min_by(F.col(value), F.col(tie)).alias("_value"))
        .withColumn("_slot", F.explode(F.array(slot(F.col("_at")), slot(F.col("_at")) - 1)))
        .select(*keys, "_slot", "_at", F.struct(F.col("_at").alias("at"), F.col("_value").alias("value")).alias("_hit"))
    )
    asked = starts.select(
        *keys,
        slot(F.col(start)).alias("_slot"),
        F.col(start).alias("_at"),
        F.struct(*starts.columns).alias("_start"),
    )
    both = asked.unionByName(once, allowMissingColumns=True)
    # going back in time, readings at the same instant come before the starts
    backward = (
        Window.partitionBy(*keys, "_slot")
        .orderBy(F.col("_at").desc(), F.col("_start").isNotNull())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    found = both.withColumn("_next", F.last("_hit", ignorenulls=True).over(backward)).filter(
        F.col("_start").isNotNull()
    )
    ends = F.col("_at") + F.expr(f"INTERVAL {seconds} SECONDS")
    return found.select(
        *[F.col("_start")[name].alias(name) for name in starts.columns],
        F.when(F.col("_next")["at"] <= ends, F.col("_next")["value"]).alias(output),
    )


def settle_attempts(
    attempts: DataFrame,
    keys: Sequence[str],
    attempt: str = "attempt_no",
    value: str = "value",
    retries: int = RETRY_LIMIT,
    output: str = "value",
) -> DataFrame:
    """One row per key with the first known value among the first try and the retries, else null."""
    usable = F.when(F.col(value).isNotNull() & (F.col(attempt) <= retries + 1), F.col(attempt))
    return attempts.groupBy(*keys).agg(F.min_by(F.col(value), usable).alias(output))


def in_list(column: str, values: Sequence[object]) -> Column:
    """Membership in a short literal list; use `keep_in` for a list held in a table."""
    return F.col(column).isin(list(values))
