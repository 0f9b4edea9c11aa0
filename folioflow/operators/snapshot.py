"""Snapshots: export of compacted logs, chunks, metadata, copies, listings."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioflow.functions.text import size_mb, snapshot_id
from folioflow.operators.aggregates import latest_per_key


def current(log: DataFrame, key: Sequence[str], order: Sequence[str], kind: str = "event_type") -> DataFrame:
    """The document store after the log: the last create, update or delete of a key, unless it deletes."""
    live = log.filter(F.col(kind).isin("create", "update", "delete"))
    return latest_per_key(live, key, order).filter(F.col(kind) != "delete")


def excluded(df: DataFrame, kinds: Sequence[str], kind: Column) -> DataFrame:
    return df.filter(~F.coalesce(kind.isin(*kinds), F.lit(False)))


def metadata(lines: DataFrame, group: Sequence[str], line: str = "line") -> DataFrame:
    """Counts and size of each snapshot."""
    size = F.sum(F.octet_length(line) + 1)
    return lines.groupBy(*group).agg(F.count("*").alias("total"), size_mb(size).alias("size_mb"))


def chunk_of(df: DataFrame, group: Sequence[str], order: Sequence[str], size: Column, limit: int) -> DataFrame:
    """df with chunk: the running size before the row, in units of limit."""
    w = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn("chunk", F.floor(F.coalesce(F.sum(size).over(w), F.lit(0)) / limit).cast("long"))


def greedy_chunks(df: DataFrame, group: str, order: str, size: str, limit: int) -> DataFrame:
    """group, order and the greedy chunk: a row that would pass the limit begins a new one.

    Rows come sorted and are folded in a stream, so no group is held as a whole.
    """

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, held, chunk = None, 0, 0
        for batch in batches:
            out = []
            for g, n in zip(batch[group], batch[size], strict=True):
                if g != at:
                    at, held, chunk = g, 0, 0
                if held and held + n > limit:
                    held, chunk = 0, chunk + 1
                held += n + 1
                out.append(chunk)
            yield batch.assign(chunk=out)[[group, order, "chunk"]]

    own = df.select(group, order, size).repartition(group).sortWithinPartitions(group, order)
    kinds = ", ".join(f"{c} {own.schema[c].dataType.simpleString()}" for c in (group, order))
    return own.mapInPandas(fold, f"{kinds}, chunk long")


def listing(df: DataFrame, group: Sequence[str], order: Sequence[str], per_file: int, prefix: str) -> DataFrame:
    """df with the name of the file of so many rows that each row goes to, numbered within each group."""
    n = F.row_number().over(Window.partitionBy(*group).orderBy(*order)) - 1
    return df.withColumn("file", F.concat_ws("_", F.lit(prefix), *group, F.concat(F.floor(n / per_file).cast("string"), F.lit(".ndjson"))))


def copies(snapshots: DataFrame, group: str) -> DataFrame:
    """Source and target keys of each snapshot and of its chunks."""
    own = F.struct(F.concat("identifier", F.lit(".json")).alias("source"), F.concat("identifier", F.lit(f"_{group}.json")).alias("target"))
    chunk = F.transform("chunks", lambda c: F.struct(F.concat(c, F.lit(".tar.gz")).alias("source"), F.concat(c, F.lit(f"_{group}.tar.gz")).alias("target")))
    return snapshots.select(F.explode(F.concat(F.array(own), chunk)).alias("k")).select("k.*")


def aggregation_copies(projects: DataFrame, namespaces: Sequence[int], group: str) -> DataFrame:
    """The root listing and one for each project and namespace."""
    own = projects.select(F.explode(F.array(*map(F.lit, namespaces))).alias("n"), "project").select(F.concat(F.lit("aggregations/"), snapshot_id(F.col("project"), F.col("n"))).alias("base"))
    return own.select(F.concat("base", F.lit(".ndjson")).alias("source"), F.concat("base", F.lit(f"_{group}.ndjson")).alias("target"))


def hourly(log: DataFrame, ts: str, group: Sequence[str]) -> DataFrame:
    """Rows of each whole hour [h, h + 1)."""
    return log.groupBy(F.date_trunc("hour", ts).alias("hour"), *group).agg(F.count("*").alias("n"))


def members(lines: DataFrame, group: Sequence[str], order: Sequence[str], line: str, limit: int) -> DataFrame:
    """group, member, file, total, size_mb and version (md5 of the content) of each archive member.

    A member holds the lines whose running size begins in its ``limit`` bytes, so it is at most that and one line.
    """
    own = chunk_of(lines, group, order, F.octet_length(line) + 1, limit).withColumnRenamed("chunk", "member")
    content = F.concat(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(*order, F.col(line).alias("_l")))), lambda x: x["_l"]), "\n"), F.lit("\n"))
    made = own.groupBy(*group, "member").agg(F.count("*").alias("total"), content.alias("_c"))
    name = F.concat_ws("_", *group, F.lit("chunk"), F.col("member").cast("string"))
    return made.select(*group, "member", F.concat(name, F.lit(".ndjson")).alias("file"), "total", size_mb(F.octet_length("_c")).alias("size_mb"), F.md5(F.col("_c").cast("binary")).alias("version"))


def stale(existing: DataFrame, current: DataFrame, group: str, per_request: int = 1000) -> DataFrame:
    """key and request of the chunks that an export leaves behind, but for those of the group; existing and current: snapshot, key."""
    old = existing.filter(~F.col("key").endswith(f"_{group}.tar.gz")).join(current.select("key"), "key", "left_anti")
    n = F.row_number().over(Window.partitionBy("snapshot").orderBy("key")) - 1
    return old.select("snapshot", "key", F.floor(n / per_request).cast("long").alias("request"))
