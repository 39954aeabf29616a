"""Readers of the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def orders(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").withColumn("day", F.col("o_orderdate").cast("date"))


def lineitem(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").withColumn("day", F.col("l_shipdate").cast("date"))


def events(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").withColumn("day", F.col("ts").cast("date"))


def exact_sum(column: str):
    """Sum of amounts with two digits that does not depend on the order of the rows."""
    return F.sum(F.col(column).cast("decimal(18,2)")).cast("double")
