"""Connected components of a link table, by alternating large-star and small-star steps.

Each step is two shuffles of links; the links are written to the shared folder after each round, so a lost
executor repeats one round.  A hub's links are joined, not gathered, so adaptive execution can split them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.llm.runtime import durable


def _least(links: DataFrame) -> DataFrame:
    return links.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("_u"), F.least("_u", "m").alias("m"))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    to = both.join(_least(both), F.col("u") == F.col("_u")).filter("v > u")
    return to.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v")
    to = down.join(_least(down), F.col("u") == F.col("_u"))
    pairs = to.select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("p"))
    return pairs.select("p.u", "p.v").filter("u <> v").distinct()


def stars(links: DataFrame, rounds: int = 60) -> DataFrame:
    """From links (u, v) to rows (u, v) with v the least node of u's component, for every u that is not it."""
    mark = lambda t: tuple(t.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0))).first())
    links = durable(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct())
    last = mark(links)
    if not last[0]:
        return links
    for _ in range(rounds):
        links = durable(_small_star(_large_star(links)))
        now = mark(links)
        if now == last:
            return links
        last = now
    raise RuntimeError(f"no end of the components' rounds after {rounds}")
