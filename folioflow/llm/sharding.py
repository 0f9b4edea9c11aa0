"""Operator 4, sharding by sampled splitters; DataFrame functions only.  Law ``bytes``: sizes near equal.

Records are ordered by (xxhash64 of the text, a hash of the id), so equal texts stand together.  A sample in
proportion to size (a record is drawn with probability size / step, at most 1) estimates the quantiles of
that order; splitters at the quantiles cut it in ranges.  Where a group of equal texts is lighter than half
a range, the splitter is moved to the group's start, so the group stays whole; a heavier one is cut inside.
Ranges whose true size is over twice the mean are subdivided by splitters drawn from themselves.  Exact
sizes of the ranges then give every record its place in the order and the bytes before it, and the shard is
the eighth of all bytes in which it, or the first record of its light group, begins.  Slots follow the order.

Size is the text's UTF-8 bytes (null: none) plus 1.  Null ids are ids like others; rows that repeat id and
text are ordered arbitrarily among themselves but are alike; very long texts are records like others, and one
heavier than a shard's share fills it; ties in the order go by id and size; an empty table gives an empty result;
other columns, whatever their names, are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioflow.llm.runtime import durable, read

_LEAST = -(1 << 63)


def _range_of(cuts: list[tuple[int, int]]) -> Column:
    """Number of cuts at or below (h, g), by binary search in two constant arrays."""
    if not cuts:
        return F.lit(0)
    hs, gs = (F.split(F.lit(",".join(str(c[i]) for c in cuts)), ",").cast("array<bigint>") for i in (0, 1))

    def step(at: Column, _: Column) -> Column:
        mid = F.floor((at["lo"] + at["hi"]) / 2).cast("int")
        h, g = F.get(hs, mid), F.get(gs, mid)
        below = (h < F.col("h")) | ((h == F.col("h")) & (g <= F.col("g")))
        going = at["lo"] < at["hi"]
        return F.struct(F.when(going & below, mid + 1).otherwise(at["lo"]).alias("lo"), F.when(going & ~below, mid).otherwise(at["hi"]).alias("hi"))

    steps = F.sequence(F.lit(1), F.lit(len(cuts).bit_length() + 1))
    return F.aggregate(steps, F.struct(F.lit(0).alias("lo"), F.lit(len(cuts)).alias("hi")), step, lambda at: at["lo"])


def _splitters(rows: DataFrame, total: int, ranges: int, per_range: int = 24) -> list[tuple[int, int]]:
    """Cuts for about ``ranges`` ranges of equal size, from about ranges * per_range records drawn by size."""
    step = max(1.0, total / (ranges * per_range))
    chance = F.pmod(F.xxhash64("g", F.lit("draw")), F.lit(1 << 30)) / float(1 << 30)
    drawn = rows.filter(chance < F.col("size") / step).select("h", "g", F.greatest("size", F.lit(step)).alias("weight"))
    drawn = sorted((r.h, r.g, r.weight) for r in drawn.limit(4 * ranges * per_range + 64).collect())
    group: dict[int, float] = {}
    for h, _, weight in drawn:
        group[h] = group.get(h, 0.0) + weight
    whole = sum(group.values())
    cuts, done, at = set(), 0.0, 1
    for h, g, weight in drawn:
        done += weight
        while at < ranges and done >= at * whole / ranges:
            cuts.add((h, _LEAST) if group[h] < whole / ranges / 2 else (h, g))
            at += 1
    return sorted(cuts)


def shards(docs: DataFrame, count: int = 8, id_col: str = "doc_id", text_col: str = "text", rows_per_range: int = 1 << 20, least_ranges: int = 128, most_ranges: int = 8192) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot of each row."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    doc = F.col(f"`{id_col}`").cast("long")
    h = F.xxhash64(text)
    rows = durable(docs.select(doc.alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), h.alias("h"), F.xxhash64(doc, h, F.lit("order")).alias("g")))
    n, total = rows.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    ranges = max(least_ranges, min(most_ranges, n // rows_per_range))
    cuts = _splitters(rows, total, ranges) if n else []
    sizes = rows.groupBy(_range_of(cuts).alias("r")).agg(F.sum("size").alias("b"))
    full = [r.r for r in sizes.filter(F.col("b") > 2 * total / ranges).collect()]  # at most half the ranges
    if full:
        inner = rows.filter(_range_of(cuts).isin(full))
        cuts = sorted({*cuts, *_splitters(inner, inner.agg(F.sum("size")).first()[0], 4 * len(full))})
    placed = rows.withColumn("r", _range_of(cuts))
    before = Window.orderBy("r").rowsBetween(Window.unboundedPreceding, -1)
    own = placed.groupBy("r").agg(F.count("*").alias("n"), F.sum("size").alias("b"))  # one row a range
    own = own.select("r", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n0"), F.coalesce(F.sum("b").over(before), F.lit(0)).alias("b0"))
    within = Window.partitionBy("r").orderBy("h", "g", "doc_id", "size")
    group = Window.partitionBy("r", "h")
    inside = placed.select(
        "*",
        F.row_number().over(within).alias("_n"),
        (F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")).alias("_b"),
        F.sum("size").over(group).alias("_group"),
    )
    inside = inside.withColumn("_first", F.min("_b").over(group))
    light = F.col("_group") <= total / count / 100
    begin = F.col("b0") + F.when(light, F.col("_first")).otherwise(F.col("_b"))
    inside = inside.join(F.broadcast(own), "r")  # at most most_ranges + 4 * ranges / 2 rows
    inside = durable(
        inside.select("doc_id", "size", "text_crc32", (F.col("n0") + F.col("_n") - 1).alias("_rank"), F.least(F.lit(count - 1), F.floor(begin * F.lit(count) / F.lit(max(1, total)))).cast("int").alias("shard"))
    )
    start = inside.groupBy("shard").agg(F.min("_rank").alias("_start"))
    return inside.join(F.broadcast(start), "shard").select("doc_id", "size", "text_crc32", "shard", (F.col("_rank") - F.col("_start")).cast("long").alias("slot"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = shards(read(spark, sf_dir, "documents"))
    return done.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
