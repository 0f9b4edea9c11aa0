"""Lookups against a stand-in of the API: its answers are made from the key, so SQL can say what must come back."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.dataset import table
from folioflow.queries.registry import query
from folioflow.sources import lookups


def _number(key: str) -> int:
    return int(key.rpartition(" ")[2])


def _failing(n: int) -> None:
    if n % 10 == 9:
        raise OSError("gone")


def answer_revisions(title: str) -> str:
    n = _number(title)
    _failing(n)
    return json.dumps({"revisions": [{"revid": n * 10 + i, "userid": n % 7, "timestamp": f"2024-01-0{i + 1}T00:00:00Z"} for i in (1, 0, 2)]})


def answer_users(ids: str) -> str:
    return json.dumps({"users": [{"userid": i, "name": f"User{i}", "editcount": i * 3, "groups": ["sysop"] if i % 2 else [], "registration": "2020-02-03T04:05:06Z"} for i in map(int, ids.split("|"))]})


def answer_scores(rev: str) -> str:
    n = int(rev)
    _failing(n)
    if n % 10 == 8:
        return "<html>busy</html>"
    return json.dumps({"output": {"prediction": n % 2 == 0, "probabilities": {"true": n % 4 / 4, "false": 1 - n % 4 / 4}}, "reference_need_score": n % 8 / 8, "reference_count": n % 5, "survival_ratio": {"min": 0.25, "mean": 0.5, "median": n % 2 / 2}, "reference_risk_score": n % 16 / 16})


def answer_contributors(title: str, after: str | None) -> tuple[str, str | None]:
    n, part = _number(title), int(after or 0)
    return json.dumps({"anoncontributors": n % 5 + part, "contributors": [{"userid": i} for i in range(3)]}), str(part + 1) if part < n % 4 else None


def answer_pages(title: str, after: str | None) -> tuple[str, str | None]:
    n, part = _number(title), int(after or 0)
    body = {"normalized": [{"from": title, "to": f"Page {n}"}], "redirects": [{"from": f"Page {n}", "to": f"Target {n}"}] if n % 3 == 0 else []}
    name = f"Target {n}" if n % 3 == 0 else f"Page {n}"
    body["pages"] = [{"title": name, "categories": [f"C{part}"], **({"pageid": n, "templates": ["T"]} if part else {})}, {"title": "Other", "pageid": -1}]
    return json.dumps(body), None if part else "1"


def answer_host(host: str) -> str:
    langs = ["en", "de", "fr"]
    own = {str(i): {"code": c, "name": c.upper(), "site": [{"url": f"https://{c}.host", "dbname": f"{c}wiki", "code": "wiki"}]} for i, c in enumerate(langs)}
    return json.dumps({"sitematrix": {"count": 3, **own}})


def answer_project(project: str) -> str:
    spaces = {str(i): {"id": i, "name": "" if i == 0 else f"{project} {i}"} for i in (0, 1, 6, 10, 14)}
    return json.dumps({"namespaces": spaces, "random": [{"id": len(project) + i, "ns": 0, "title": f"{project} page {i}"} for i in range(2)]})


def answer_summary(title: str) -> str:
    n = _number(title)
    _failing(n)
    return json.dumps({"extract": f"About {n}", "description": "d", "originalimage": {"source": f"https://i/{n}.png", "width": 1, "height": 2}, "content-length": n * 100, "content-type": "image/png", "etag": f"e{n}"})


def _titles(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select(F.concat(F.lit("page "), F.col("user_id").cast("string")).alias("title")).distinct()


def _revs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("rev_id"))


def _projects(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select(F.concat("lang", F.lit("wiki")).alias("project")).distinct()


_T = "t AS (SELECT DISTINCT user_id AS n, 'page ' || user_id AS title FROM events)"
_R = "r AS (SELECT doc_id AS n, CAST(doc_id AS VARCHAR) AS rev_id, doc_id % 10 < 8 AS ok, CASE doc_id % 10 WHEN 9 THEN 'OSError: gone' WHEN 8 THEN 'no JSON' END AS error FROM documents)"
_P = "p AS (SELECT DISTINCT lang || 'wiki' AS project FROM documents)"


@query("src_revisions", """SELECT title, CAST(i AS INTEGER) AS number, CASE WHEN n % 10 < 9 THEN n * 10 + 3 - i END AS rev_id, CASE WHEN n % 10 < 9 THEN n % 7 END AS user_id, CASE WHEN n % 10 = 9 THEN 'OSError: gone' END AS error
  FROM (SELECT *, unnest(CASE WHEN n % 10 < 9 THEN [1, 2, 3] ELSE [NULL] END) AS i FROM t)""", _T)
def src_revisions(spark: SparkSession, d: str) -> DataFrame:
    return lookups.revisions(_titles(spark, d), answer_revisions).select("title", "number", "rev_id", "user_id", "error")


@query("src_users", "SELECT DISTINCT user_id, 'User' || user_id AS name, user_id * 3 AS edit_count, CASE WHEN user_id % 2 = 1 THEN 'sysop' ELSE '' END AS groups, TIMESTAMP '2020-02-03 04:05:06' AS registered FROM events WHERE user_id > 0")
def src_users(spark: SparkSession, d: str) -> DataFrame:
    found = lookups.users(table(spark, d, "events").select("user_id"), answer_users)
    return found.select("user_id", "name", "edit_count", F.array_join("groups", ",").alias("groups"), F.col("registered").cast("timestamp_ntz").alias("registered"))


@query("src_scores", "SELECT rev_id, CASE WHEN ok THEN n % 2 = 0 END AS prediction, CASE WHEN ok THEN n % 4 / 4.0 END AS probability_true, CASE WHEN ok THEN 1 - n % 4 / 4.0 END AS probability_false, error FROM r", _R)
def src_scores(spark: SparkSession, d: str) -> DataFrame:
    return lookups.scores(_revs(spark, d), answer_scores)


@query("src_refneed", "SELECT rev_id, CASE WHEN ok THEN n % 8 / 8.0 END AS reference_need, error FROM r", _R)
def src_refneed(spark: SparkSession, d: str) -> DataFrame:
    return lookups.reference_need(_revs(spark, d), answer_scores)


@query("src_refrisk", "SELECT rev_id, CASE WHEN ok THEN CAST(n % 5 AS INTEGER) END AS reference_count, CASE WHEN ok THEN n % 2 / 2.0 END AS median, CASE WHEN ok THEN n % 16 / 16.0 END AS reference_risk, error FROM r", _R)
def src_refrisk(spark: SparkSession, d: str) -> DataFrame:
    return lookups.reference_risk(_revs(spark, d), answer_scores).select("rev_id", "reference_count", F.col("survival_ratio.median").alias("median"), "reference_risk", "error")


@query("src_contributors", "SELECT title, n % 5 + least(n % 4, 2) AS anonymous, 3 * (least(n % 4, 2) + 1) AS registered, n % 4 <= 2 AS complete FROM t", _T)
def src_contributors(spark: SparkSession, d: str) -> DataFrame:
    return lookups.contributors(_titles(spark, d), answer_contributors, 9)


@query("src_pages", "SELECT title AS asked, CASE WHEN n % 3 = 0 THEN 'Target ' ELSE 'Page ' END || n AS title, n AS page_id, 'C0,C1' AS categories, 'T' AS templates FROM t", _T)
def src_pages(spark: SparkSession, d: str) -> DataFrame:
    found = lookups.pages(_titles(spark, d), answer_pages)
    return found.select("asked", "title", "page_id", F.array_join("categories", ",").alias("categories"), F.array_join("templates", ",").alias("templates"))


@query("src_sitematrix", "SELECT c AS language, c || 'wiki' AS project, 'https://' || c || '.host' AS url, upper(c) AS name FROM (VALUES ('en'), ('de'), ('fr')) v(c)")
def src_sitematrix(spark: SparkSession, d: str) -> DataFrame:
    languages, projects = lookups.site_matrix(spark.createDataFrame([("meta",)], "host string"), answer_host)
    return projects.join(languages.withColumnRenamed("code", "language"), "language")


@query("src_namespaces", "SELECT project, CAST(ns AS INTEGER) AS namespace, CASE ns WHEN 0 THEN 'Article' ELSE project || ' ' || ns END AS name FROM p, (VALUES (0), (6), (10), (14)) v(ns)", _P)
def src_namespaces(spark: SparkSession, d: str) -> DataFrame:
    return lookups.namespaces(_projects(spark, d), answer_project)


@query("src_random", "SELECT project, CAST(length(project) + i AS BIGINT) AS page_id, CAST(0 AS INTEGER) AS namespace, project || ' page ' || i AS title FROM p, (VALUES (0), (1)) v(i)", _P)
def src_random(spark: SparkSession, d: str) -> DataFrame:
    return lookups.random_pages(_projects(spark, d), answer_project)


@query("src_summary", "SELECT title, CASE WHEN n % 10 < 9 THEN 'About ' || n END AS extract, CASE WHEN n % 10 < 9 THEN 'd' END AS description, CASE WHEN n % 10 < 9 THEN 'https://i/' || n || '.png' END AS image, CASE WHEN n % 10 = 9 THEN 'OSError: gone' END AS error FROM t", _T)
def src_summary(spark: SparkSession, d: str) -> DataFrame:
    return lookups.summaries(_titles(spark, d), answer_summary)


@query("src_file", "SELECT title, CASE WHEN n % 10 < 9 THEN n * 100 END AS size, CASE WHEN n % 10 < 9 THEN 'image/png' END AS type, CASE WHEN n % 10 < 9 THEN 'e' || n END AS etag, CASE WHEN n % 10 = 9 THEN 'OSError: gone' END AS error FROM t", _T)
def src_file(spark: SparkSession, d: str) -> DataFrame:
    return lookups.files(_titles(spark, d), answer_summary)
