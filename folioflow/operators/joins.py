"""Lookups by key as joins."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def multi_getter(titles: DataFrame, lookups: Mapping[str, tuple[DataFrame, bool]], on: str = "title") -> DataFrame:
    """titles joined with each lookup (key and a struct ``value``); a lookup is (rows, whether it may fail).

    A key that only a lookup has is kept too.  ``errors`` names the needed lookups that lack the key, so a
    miss is a value and doesn't end the batch.
    """
    out = titles
    for name, (rows, _) in lookups.items():
        out = out.join(rows.select(on, F.col("value").alias(name)), on, "full")
    needed = [n for n, (_, may_fail) in lookups.items() if not may_fail]
    return out.withColumn("errors", F.array_compact(F.array(*[F.when(F.col(n).isNull(), F.lit(n)) for n in needed])))


def remap(rows: DataFrame, keys: DataFrame, on: str, to: str) -> DataFrame:
    """rows keyed anew: by ``to``, through keys (on, to)."""
    return rows.join(keys.select(on, to), on).drop(on)


def coalesced(rows: DataFrame, lookup: DataFrame, on: str, columns: list[str]) -> DataFrame:
    """Each column from the lookup, else from the row."""
    own = lookup.select(on, *[F.col(c).alias(f"_{c}") for c in columns])
    out = rows.join(own, on, "left")
    return out.select(*[F.coalesce(f"_{c}", c).alias(c) if c in columns else F.col(c) for c in rows.columns])


def supported(rows: DataFrame, dims: DataFrame, project: str, namespace: str) -> DataFrame:
    """Rows whose project and namespace dims (project, namespace) has."""
    own = dims.select(F.col("project").alias("_p"), F.col("namespace").alias("_n"))
    return rows.join(own, (F.col(project) == F.col("_p")) & (F.col(namespace) == F.col("_n")), "left_semi")


def packed_ip(text: Column) -> Column:
    parts = F.split(text, r"\.")
    return F.aggregate(F.transform(parts, lambda p: p.cast("long")), F.lit(0).cast("long"), lambda s, x: s * 256 + x)


def ip_range(rows: DataFrame, ranges: DataFrame, ip: str = "ip", bits: int = 16) -> DataFrame:
    """Rows with the first range (order, first, last, label) that holds their address, else null.

    Ranges are dealt over the blocks of 2 ** bits addresses that they touch, so the join has an equality.
    """
    low, high = packed_ip(F.col("first")), packed_ip(F.col("last"))
    own = ranges.select("order", "label", low.alias("_lo"), high.alias("_hi"))
    own = own.select("*", F.explode(F.sequence(F.shiftright("_lo", bits), F.shiftright("_hi", bits))).alias("_block"))
    at = rows.withColumn("_ip", packed_ip(F.col(ip))).withColumn("_block", F.shiftright("_ip", bits)).withColumn("_row", F.monotonically_increasing_id())
    hit = at.join(own, (at["_block"] == own["_block"]) & (F.col("_ip") >= F.col("_lo")) & (F.col("_ip") <= F.col("_hi")), "left")
    best = hit.groupBy("_row", *rows.columns).agg(F.min_by("label", "order").alias("label"))
    return best.drop("_row")
