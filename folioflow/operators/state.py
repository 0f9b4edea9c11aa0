"""Integrity signals of an article's recent versions: the batch form of the stateful stream.

versions: page, version, editor, at (and order).  Counting starts at the version asked for and takes those
before it that lie in [start, start + hours].
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioflow.functions.text import between_hours

#: Fixed defaults of the signals.
HOURS_ELIGIBLE, HOURS_COUNTED, LEAST_EDITORS, LEAST_EDITS = 24, 1, 2, 10


def counted(requests: DataFrame, versions: DataFrame, hours: int = HOURS_COUNTED) -> DataFrame:
    """requests (page, version, start) with edits and unique_editors; a version that isn't there counts none."""
    v = versions.select(F.col("page").alias("_page"), F.col("version").alias("_v"), F.col("order").alias("_o"), F.lower("editor").alias("_editor"), F.col("at").alias("_at"))
    asked = v.select("_page", "_v", F.col("_o").alias("_from"))
    own = requests.join(asked, (F.col("page") == F.col("_page")) & (F.col("version") == F.col("_v")), "left").drop("_page", "_v")
    hit = own.join(v, (F.col("page") == F.col("_page")) & (F.col("_o") <= F.col("_from")) & between_hours(F.col("_at"), F.col("start"), hours), "left")
    return hit.groupBy(*requests.columns).agg(F.count("_v").alias("edits"), F.countDistinct("_editor").alias("unique_editors"))


def breaking_news(df: DataFrame, mandatory: Column, allowed: Column) -> DataFrame:
    """df (created, moved, modified, edits, unique_editors) with is_breaking_news; both dates null is an error value (null)."""
    near = lambda d: between_hours(F.col("modified"), F.col(d), HOURS_ELIGIBLE)
    busy = (F.col("unique_editors") >= LEAST_EDITORS) | (F.col("edits") >= LEAST_EDITS)
    flag = (near("created") | near("moved")) & mandatory & (allowed | busy)
    return df.withColumn("is_breaking_news", F.when(F.col("created").isNotNull() | F.col("moved").isNotNull(), flag))


def first_flagged(df: DataFrame, page: str = "page", order: str = "version") -> DataFrame:
    """The first flagged version of each page."""
    w = Window.partitionBy(page).orderBy(order)
    return df.filter("is_breaking_news").withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def equal_fold_any(names: Column, wanted: list[str], ignored: list[str] = ()) -> Column:
    low = F.transform(names, F.lower)
    kept = F.filter(low, lambda n: ~n.isin([i.lower() for i in ignored])) if ignored else low
    return F.coalesce(F.arrays_overlap(kept, F.array(*[F.lit(w.lower()) for w in wanted])), F.lit(False))


def prefix_any(names: Column, prefixes: list[str], ignored: list[str] = ()) -> Column:
    def starts(n: Column) -> Column:
        hit = F.lit(False)
        for p in prefixes:
            hit = hit | n.startswith(p)
        return hit & ~n.isin(list(ignored)) if ignored else hit

    return F.coalesce(F.exists(names, starts), F.lit(False))


def substring_any(names: Column, patterns: list[str]) -> Column:
    def holds(n: Column) -> Column:
        hit = F.lit(False)
        for p in patterns:
            hit = hit | F.contains(F.lower(n), F.lit(p.lower()))
        return hit

    return F.coalesce(F.exists(names, holds), F.lit(False))
