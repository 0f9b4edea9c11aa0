"""What leaves the engine: log envelopes, event frames, JSON lists, files by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.operators.snapshot import current


def envelope(df: DataFrame, topic: str, key: str = "key") -> DataFrame:
    """key, value and topic of each record, as the Kafka sink takes them; ValueError without a topic or key column."""
    if not topic:
        raise ValueError("no topic")
    if key not in df.columns:
        raise ValueError(f"no key column: {key}")
    rest = F.struct(*[F.col(f"`{c}`") for c in df.columns if c != key])
    return df.select(F.to_json(F.col(key)).cast("binary").alias("key"), F.to_json(rest).cast("binary").alias("value"), F.lit(topic).alias("topic"))


def ndjson_line(record: Column) -> Column:
    return F.to_json(record)


def sse_frame(record: Column) -> Column:
    return F.concat(F.lit("event: message\ndata: "), F.to_json(record), F.lit("\n\n"))


def json_array(df: DataFrame, group: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One JSON list a group, in order; a group is one response."""
    rest = [c for c in df.columns if c not in group]
    lines = F.transform(F.sort_array(F.collect_list(F.struct(*order, F.to_json(F.struct(*rest)).alias("_j")))), lambda x: x["_j"])
    return df.groupBy(*group).agg(F.concat(F.lit("["), F.array_join(lines, ","), F.lit("]")).alias("json"))


def write_ndjson(df: DataFrame, path: str, partition: Sequence[str] = ()) -> None:
    writer = df.write.mode("overwrite").option("compression", "gzip")
    (writer.partitionBy(*partition) if partition else writer).json(path)


def upsert(store: DataFrame | None, batch: DataFrame, key: Sequence[str], order: Sequence[str], kind: str = "event_type") -> DataFrame:
    """The store after a batch of events: deletions take effect, the newest event of a key wins."""
    return current(batch if store is None else store.unionByName(batch), key, order, kind)
