"""The message log: options of the Kafka source and sink, and the wire format of registry-encoded records.

The connector is a package of its own; without it Spark raises when a query starts.  All that can be decided
without a broker is decided in these functions.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The first byte of a registry-encoded record and the bytes before its body.
MAGIC, HEADER = 0, 5


def start_options(topic: str, partitions: Sequence[int], since_ms: int | None = None, since_per_partition: Mapping[int, int] | None = None, offsets: Mapping[int, int] | None = None) -> dict[str, str]:
    """Options for explicit partitions: since, else a partition's own since, else its offset, else the latest."""
    per, offs = dict(since_per_partition or {}), dict(offsets or {})
    if since_ms is not None and per:
        raise ValueError("since excludes since_per_partition")
    if both := per.keys() & offs.keys():
        raise ValueError(f"offset and time for one partition: {sorted(both)}")
    out = {"assign": json.dumps({topic: list(partitions)})}
    if since_ms is not None:
        per = {p: since_ms for p in partitions}
    if per and not offs:
        out["startingOffsetsByTimestamp"] = json.dumps({topic: {str(p): per.get(p, -1) for p in partitions}})
        out["startingOffsetsByTimestampStrategy"] = "latest"
    elif offs:
        out["startingOffsets"] = json.dumps({topic: {str(p): offs.get(p, -1) for p in partitions}})
    else:
        out["startingOffsets"] = "latest"
    return out


def read_stream(spark: SparkSession, servers: str, options: Mapping[str, str], per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).options(**options)
    return (reader.option("maxOffsetsPerTrigger", per_trigger) if per_trigger else reader).load()


def read_bounded(spark: SparkSession, servers: str, topic: str, since_ms: int | None = None) -> DataFrame:
    """From the beginning, or a time, to the high watermarks of now."""
    reader = spark.read.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).option("endingOffsets", "latest")
    return (reader.option("startingTimestamp", since_ms) if since_ms is not None else reader.option("startingOffsets", "earliest")).load()


def wire(value: Column) -> Column:
    """Schema id and body of a registry-encoded value; null where the magic byte or the length is wrong."""
    whole = (F.octet_length(value) > HEADER) & (F.hex(F.substring(value, 1, 1)) == f"{MAGIC:02X}")
    identifier = F.conv(F.hex(F.substring(value, 2, 4)), 16, 10).cast("int")
    return F.when(whole, F.struct(identifier.alias("schema_id"), F.substring(value, HEADER + 1, 1 << 30).alias("body")))


def framed(body: Column, schema_id: int) -> Column:
    head = bytes([MAGIC]) + schema_id.to_bytes(4, "big")
    return F.concat(F.lit(head), body)


def write_stream(df: DataFrame, servers: str, checkpoint: str):
    """key, value and topic columns to the log."""
    return df.writeStream.format("kafka").option("kafka.bootstrap.servers", servers).option("checkpointLocation", checkpoint)
