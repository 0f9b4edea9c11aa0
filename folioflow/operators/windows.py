"""Operators over the order of rows: caps, rates, gaps, positions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def running_cap(df: DataFrame, who: Sequence[str], order: Sequence[str], limit: int) -> DataFrame:
    """df with allowed: whether fewer than limit requests of the same caller came before."""
    return df.withColumn("allowed", F.row_number().over(Window.partitionBy(*who).orderBy(*order)) <= limit)


def rate_limit(df: DataFrame, who: Sequence[str], ts: str, order: Sequence[str], per_second: int) -> DataFrame:
    w = Window.partitionBy(*who, F.date_trunc("second", ts)).orderBy(*order)
    return df.withColumn("allowed", F.row_number().over(w) <= per_second)


def rolling_mean(df: DataFrame, who: Sequence[str], ts: str, seconds: int = 15) -> DataFrame:
    """Messages a second over the last seconds, at each second with a message; always divided by all of them."""
    at = F.unix_seconds(F.date_trunc("second", ts))
    per = df.groupBy(*who, at.alias("second")).agg(F.count("*").alias("n"))
    w = Window.partitionBy(*who).orderBy("second").rangeBetween(-(seconds - 1), 0)
    return per.select(*who, "second", "n", (F.sum("n").over(w) / seconds).alias("mean"))


def idle_gap(df: DataFrame, who: Sequence[str], ts: str, order: Sequence[str]) -> DataFrame:
    """Whole seconds since the last message of the same key; null for the first."""
    last = F.lag(ts).over(Window.partitionBy(*who).orderBy(*order))
    return df.withColumn("idle", F.unix_seconds(F.col(ts)) - F.unix_seconds(last))


def top_matches(df: DataFrame, group: Sequence[str], order: Sequence[str], limit: int) -> DataFrame:
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= limit).drop("_n")
