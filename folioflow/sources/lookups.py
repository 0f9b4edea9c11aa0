"""Lookups of a wiki's API: a call for each key (or page of a listing) on the executors, its JSON as typed rows.

Each function takes keys and a fetcher (see ``pages.fetched``) and returns rows with ``error`` where a call failed:
a failed call is a row and doesn't end the batch.  The fetcher of a listing takes ``key`` and a continuation.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.operators.aggregates import merge_pages
from folioflow.sources.pages import fetched

PROBABILITY = "output struct<prediction: boolean, probabilities: struct<`true`: double, `false`: double>>"


def _json(keys: DataFrame, fetch: Callable[[str], str], column: str, ddl: str) -> DataFrame:
    """column, j (the answer by its schema) and error; an answer that is no JSON is an error too."""
    got = fetched(keys, fetch, column)
    got = got.withColumn("j", F.from_json("content", ddl, {"mode": "PERMISSIVE"}))
    bad = F.col("content").isNotNull() & ~F.coalesce(F.trim("content").startswith("{"), F.lit(False))
    return got.select(column, F.when(~bad, F.col("j")).alias("j"), F.when(bad, F.lit("no JSON")).otherwise(F.col("error")).alias("error"))


def continued(keys: DataFrame, fetch: Callable[[str, str | None], tuple[str, str | None]], column: str, enough: Callable[[str], int] | None = None, most: int = 0) -> DataFrame:
    """column, part and content of all parts of each key's listing, in order.

    With ``enough`` a listing stops early: at the part with which the sum of enough(content) reaches most.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for key in batch[column]:
                after, part, found = None, 0, 0
                while True:
                    content, after = fetch(key, after)
                    found += enough(content) if enough else 0
                    full = bool(enough) and found >= most
                    yield pd.DataFrame({column: [key], "part": [part], "content": [content], "complete": [after is None]})
                    part += 1
                    if after is None or full:
                        break

    kind = keys.schema[column].dataType.simpleString()
    return keys.select(column).mapInPandas(run, f"{column} {kind}, part int, content string, complete boolean")


def revisions(keys: DataFrame, fetch: Callable[[str], str]) -> DataFrame:
    """title, rev_id, user_id, timestamp of all revisions of each title, with the newest as number 1."""
    rows = _json(keys, fetch, "title", "revisions array<struct<revid: bigint, userid: bigint, timestamp: timestamp>>")
    own = F.reverse(F.array_sort(F.transform("j.revisions", lambda r: F.struct(r["timestamp"].alias("timestamp"), r["revid"].alias("rev_id"), r["userid"].alias("user_id")))))
    return rows.select("title", F.posexplode_outer(own).alias("n", "r"), "error").select("title", (F.col("n") + 1).alias("number"), "r.rev_id", "r.user_id", "r.timestamp", "error")


def users(keys: DataFrame, fetch: Callable[[str], str], per_call: int = 50) -> DataFrame:
    """user_id, name, edit_count, groups, registered of each id but 0; a call asks for per_call ids."""
    ids = keys.filter("user_id > 0").select("user_id").distinct()
    calls = ids.groupBy(F.floor(F.col("user_id") / per_call).alias("_call")).agg(F.array_sort(F.collect_list("user_id")).alias("_ids"))  # at most per_call ids a row
    asked = calls.select(F.array_join(F.transform("_ids", lambda i: i.cast("string")), "|").alias("ids"))
    rows = _json(asked, fetch, "ids", "users array<struct<userid: bigint, name: string, editcount: bigint, groups: array<string>, registration: timestamp>>")
    return rows.select(F.explode_outer("j.users").alias("u"), "error").select(F.col("u.userid").alias("user_id"), "u.name", F.col("u.editcount").alias("edit_count"), "u.groups", F.col("u.registration").alias("registered"), "error")


def scores(keys: DataFrame, fetch: Callable[[str], str]) -> DataFrame:
    """rev_id, prediction and the probabilities of a revert."""
    rows = _json(keys, fetch, "rev_id", PROBABILITY)
    return rows.select("rev_id", F.col("j.output.prediction").alias("prediction"), F.col("j.output.probabilities.true").alias("probability_true"), F.col("j.output.probabilities.false").alias("probability_false"), "error")


def reference_need(keys: DataFrame, fetch: Callable[[str], str]) -> DataFrame:
    rows = _json(keys, fetch, "rev_id", "reference_need_score double")
    return rows.select("rev_id", F.col("j.reference_need_score").alias("reference_need"), "error")


def reference_risk(keys: DataFrame, fetch: Callable[[str], str]) -> DataFrame:
    rows = _json(keys, fetch, "rev_id", "reference_count int, survival_ratio struct<min: double, mean: double, median: double>, reference_risk_score double")
    return rows.select("rev_id", F.col("j.reference_count").alias("reference_count"), F.col("j.survival_ratio").alias("survival_ratio"), F.col("j.reference_risk_score").alias("reference_risk"), "error")


def contributors(keys: DataFrame, fetch: Callable[[str, str | None], tuple[str, str | None]], most: int) -> DataFrame:
    """title, anonymous (of the last part), registered (names of all parts) and whether all parts were read."""
    import json

    parts = continued(keys, fetch, "title", lambda content: len(json.loads(content).get("contributors", [])), most)
    j = F.from_json("content", "anoncontributors bigint, contributors array<struct<userid: bigint>>")
    own = parts.select("title", "part", "complete", j.alias("j"))
    return own.groupBy("title").agg(F.max_by("j.anoncontributors", "part").alias("anonymous"), F.sum(F.coalesce(F.size("j.contributors"), F.lit(0))).alias("registered"), F.max("complete").alias("complete"))


def pages(keys: DataFrame, fetch: Callable[[str, str | None], tuple[str, str | None]]) -> DataFrame:
    """Pages of titles under the title asked for: parts are merged (lists appended, the first scalar stays), and the
    answer's normalised titles and redirects, which may be chained, lead back to it."""
    ddl = "normalized array<struct<`from`: string, `to`: string>>, redirects array<struct<`from`: string, `to`: string>>, pages array<struct<title: string, pageid: bigint, categories: array<string>, templates: array<string>>>"
    parts = continued(keys, fetch, "title", None).select(F.col("title").alias("asked"), "part", F.from_json("content", ddl).alias("j"))
    pairs = F.concat(F.coalesce("j.normalized", F.array()), F.coalesce("j.redirects", F.array()))
    found = F.aggregate(pairs, F.col("asked"), lambda name, x: F.when(x["from"] == name, x["to"]).otherwise(name))
    rows = parts.select("asked", "part", found.alias("target"), F.explode("j.pages").alias("p")).filter("p.title = target")
    rows = rows.select("asked", "part", F.col("p.title").alias("title"), F.col("p.pageid").alias("page_id"), F.coalesce("p.categories", F.array()).alias("categories"), F.coalesce("p.templates", F.array()).alias("templates"))
    return merge_pages(rows, "asked", ["categories", "templates"], ["title", "page_id"], "part")


def site_matrix(keys: DataFrame, fetch: Callable[[str], str]) -> tuple[DataFrame, DataFrame]:
    """languages (code, name) and projects (language, project, url) of the matrix; keys has one row, the host."""
    rows = _json(keys, fetch, "host", "sitematrix map<string, string>").select(F.explode("j.sitematrix").alias("n", "text")).filter("n <> 'count'")
    j = rows.select(F.from_json("text", "code string, name string, site array<struct<url: string, dbname: string, code: string>>").alias("l"))
    return j.select("l.code", "l.name"), j.select(F.col("l.code").alias("language"), F.explode("l.site").alias("s")).select("language", F.col("s.dbname").alias("project"), "s.url")


def namespaces(keys: DataFrame, fetch: Callable[[str], str], served: tuple[int, ...] = (0, 6, 10, 14)) -> DataFrame:
    rows = _json(keys, fetch, "project", "namespaces map<string, struct<id: int, name: string>>").select("project", F.explode("j.namespaces").alias("_n", "s")).withColumn("n", F.col("_n").cast("int"))
    name = F.when((F.col("n") == 0) & (F.coalesce("s.name", F.lit("")) == ""), "Article").otherwise(F.col("s.name"))
    return rows.filter(F.col("n").isin(*served)).select("project", F.col("n").alias("namespace"), name.alias("name"))


def random_pages(keys: DataFrame, fetch: Callable[[str], str]) -> DataFrame:
    rows = _json(keys, fetch, "project", "random array<struct<id: bigint, ns: int, title: string>>").select("project", F.explode("j.random").alias("r"))
    return rows.select("project", F.col("r.id").alias("page_id"), F.col("r.ns").alias("namespace"), "r.title")


def summaries(keys: DataFrame, fetch: Callable[[str], str]) -> DataFrame:
    rows = _json(keys, fetch, "title", "extract string, description string, originalimage struct<source: string, width: int, height: int>")
    return rows.select("title", F.col("j.extract").alias("extract"), F.col("j.description").alias("description"), F.col("j.originalimage.source").alias("image"), "error")


def files(keys: DataFrame, head: Callable[[str], str]) -> DataFrame:
    """title, size and type of each file, from the answer's head as JSON."""
    rows = _json(keys, head, "title", "`content-length` bigint, `content-type` string, etag string")
    return rows.select("title", F.col("j.content-length").alias("size"), F.col("j.content-type").alias("type"), F.col("j.etag").alias("etag"), "error")
