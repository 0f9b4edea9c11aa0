"""Aggregations, top-k and grouping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The newest row of each key, combined before the shuffle."""
    rest = [c for c in df.columns if c not in key]
    newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("_r")
    return df.groupBy(*key).agg(newest).select(*key, *[F.col(f"_r.{c}").alias(c) for c in rest])


def histogram(value: Column, bounds: Sequence[float]) -> list[Column]:
    """Cumulative counts, one column a bound."""
    return [F.count_if(value <= b).alias(f"le_{str(b).replace('.', '_')}") for b in bounds]


def exponential(start: float, factor: float, count: int) -> list[float]:
    return [start * factor**i for i in range(count)]


def frequencies(df: DataFrame, key: Sequence[str], words: str) -> DataFrame:
    return df.select(*key, F.explode(words).alias("token")).groupBy(*key, "token").agg(F.count("*").alias("n"))


def deltas(df: DataFrame, key: Sequence[str], previous: str, current: str) -> DataFrame:
    """increase, decrease, sum and the proportional two, from the words of two revisions in one row.

    All is counted within the row, without a shuffle: both lists are sorted together with a sign (0 before 1), and
    one pass keeps a token's two counts and adds them to the sums where the next token begins.
    """
    signed = lambda c, s: F.transform(F.coalesce(F.col(c), F.array().cast("array<string>")), lambda w: F.struct(w.alias("w"), F.lit(s).alias("s")))
    both = F.array_append(F.sort_array(F.concat(signed(previous, 0), signed(current, 1))), F.struct(F.lit(None).cast("string").alias("w"), F.lit(0).alias("s")))
    start = F.expr("named_struct('w', cast(null as string), 'p', 0L, 'c', 0L, 'up', 0L, 'down', 0L, 'more', 0.0D, 'less', 0.0D)")

    def step(acc: Column, x: Column) -> Column:
        d, same = acc["c"] - acc["p"], acc["w"].eqNullSafe(x["w"])
        keep = lambda old, new, when: F.when(~same & when, old + new).otherwise(old)
        return F.struct(
            x["w"].alias("w"),
            (F.when(same, acc["p"]).otherwise(F.lit(0).cast("long")) + (1 - x["s"])).cast("long").alias("p"),
            (F.when(same, acc["c"]).otherwise(F.lit(0).cast("long")) + x["s"]).cast("long").alias("c"),
            keep(acc["up"], d, d > 0).alias("up"), keep(acc["down"], d, d < 0).alias("down"),
            keep(acc["more"], d / (acc["p"] + 1), d > 0).alias("more"), keep(acc["less"], d / F.greatest(acc["p"], F.lit(1)), d < 0).alias("less"),
        )

    out = df.select(*key, F.aggregate(both, start, step).alias("_d"))
    return out.select(
        *key, F.col("_d.up").alias("increase"), F.col("_d.down").alias("decrease"), (F.col("_d.up") + F.col("_d.down")).alias("sum"),
        F.col("_d.more").alias("proportional_increase"), F.col("_d.less").alias("proportional_decrease"),
    )


def grouped_by_n(df: DataFrame, group: Sequence[str], order: Sequence[str], item: str, n: int) -> DataFrame:
    """Lists of n items in order, within each group; all but the last are full."""
    at = F.floor((F.row_number().over(Window.partitionBy(*group).orderBy(*order)) - 1) / n)
    return df.withColumn("chunk", at).groupBy(*group, "chunk").agg(F.transform(F.sort_array(F.collect_list(F.struct(*order, F.col(item).alias("_i")))), lambda x: x["_i"]).alias("items"))


def binpack(counts: dict[str, int], groups: int) -> list[list[str]]:
    """Names in groups of near equal totals: the largest first, each to the lightest group; one above the mean stands alone."""
    target = sum(counts.values()) / max(1, groups)
    alone = [[k] for k, v in sorted(counts.items()) if v > target]
    rest = sorted((k for k, v in counts.items() if v <= target), key=lambda k: (-counts[k], k))
    bins: list[tuple[int, list[str]]] = [(0, []) for _ in range(max(1, groups - len(alone)))]
    for name in rest:
        i = min(range(len(bins)), key=lambda b: (bins[b][0], b))
        bins[i] = (bins[i][0] + counts[name], [*bins[i][1], name])
    return alone + [b for _, b in bins if b]


def merge_pages(df: DataFrame, key: str, lists: Sequence[str], scalars: Sequence[str], order: str) -> DataFrame:
    """Continuation pages of one title: lists appended in order, the first scalar that isn't null."""
    rows = F.sort_array(F.collect_list(F.struct(order, *lists)))
    first = [F.min_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in scalars]
    out = df.groupBy(key).agg(*first, rows.alias("_rows"))

    def appended(c: str) -> Column:
        return F.flatten(F.transform("_rows", lambda r: F.coalesce(r[c], F.array().cast(df.schema[c].dataType)))).alias(c)

    return out.select(key, *scalars, *map(appended, lists))
