"""Article-like views of the driver tables, in Spark and (as common table expressions) in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

NAMESPACES = (0, 6, 10, 14)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events with ts as a timestamp of the session's zone (UTC), which the date functions ask for."""
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested articles of documents; the wikitext has maintenance tags put at its end by id."""
    d, doc = table(spark, sf_dir, "documents"), F.col("doc_id")
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("_id"), (F.col("toxic") == 1).alias("_toxic"))
    d = d.join(labels, doc == F.col("_id"), "left")
    relation = lambda kind, n: F.transform(F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<bigint>")), lambda i: F.struct(F.concat(F.lit(kind), i.cast("string")).alias("name"), F.concat(F.lit("https://host/"), (doc % 3).cast("string")).alias("url")))
    when = F.timestamp_seconds(F.lit(1704067200) + doc * 60)
    tag = F.when(doc % 3 == 0, "{{Citation needed|date=2020}} {{POV}}").when(doc % 3 == 1, "{{clarify|reason=x}} {{CLARIFY}} {{Update|}}").otherwise("")
    return d.select(
        F.concat(F.lit("Doc_"), doc.cast("string")).alias("name"),
        doc.alias("identifier"),
        when.alias("date_modified"),
        F.when(doc % 2 == 0, F.timestamp_seconds(F.lit(1704067200) + doc * 30)).alias("date_created"),
        F.struct(
            (doc * 10).alias("identifier"), F.col("_toxic").alias("noindex"), F.char_length("text").cast("long").alias("number_of_characters"),
            F.struct(F.octet_length("text").cast("double").alias("value"), F.lit("B").alias("unit_text")).alias("size"),
            F.when(doc % 7 != 3, F.struct((doc % 50).alias("identifier"), F.concat(F.lit("User"), (doc % 50).cast("string")).alias("name"))).alias("editor"),
        ).alias("version"),
        F.struct(F.element_at(F.array(*map(F.lit, NAMESPACES)), (doc % 4 + 1).cast("int")).alias("identifier")).alias("namespace"),
        F.struct(F.col("lang").alias("identifier")).alias("in_language"),
        F.struct(F.concat("lang", F.lit("wiki")).alias("identifier"), F.concat(F.lit("https://"), "lang", F.lit(".host")).alias("url")).alias("is_part_of"),
        relation("Category:", doc % 4).alias("categories"),
        relation("Template:", doc % 3).alias("templates"),
        F.struct(F.concat("text", tag).alias("wikitext")).alias("article_body"),
        F.struct(
            F.concat(F.lit("e"), doc.cast("string")).alias("identifier"),
            F.element_at(F.array(*map(F.lit, ("create", "update", "delete"))), (doc % 3 + 1).cast("int")).alias("type"),
            when.alias("date_created"), (doc % 11).cast("int").alias("fail_count"),
            F.when(doc % 5 == 0, True).when(doc % 5 == 1, F.lit(None).cast("boolean")).otherwise(False).alias("is_internal_message"),
        ).alias("event"),
    )


#: articles, one column a leaf.
ARTICLES_SQL = """
articles AS (SELECT 'Doc_' || d.doc_id AS name, d.doc_id AS identifier, to_timestamp(1704067200 + d.doc_id * 60) AT TIME ZONE 'UTC' AS date_modified,
  CASE WHEN d.doc_id % 2 = 0 THEN to_timestamp(1704067200 + d.doc_id * 30) AT TIME ZONE 'UTC' END AS date_created,
  d.doc_id * 10 AS version_id, l.toxic = 1 AS noindex, CAST(length(text) AS BIGINT) AS chars, CAST(octet_length(encode(text)) AS DOUBLE) AS size_value,
  CASE WHEN d.doc_id % 7 <> 3 THEN d.doc_id % 50 END AS editor_id, CASE WHEN d.doc_id % 7 <> 3 THEN 'User' || (d.doc_id % 50) END AS editor_name,
  [0, 6, 10, 14][d.doc_id % 4 + 1] AS ns, lang, lang || 'wiki' AS project, 'https://' || lang || '.host' AS project_url,
  d.doc_id % 4 AS n_categories, d.doc_id % 3 AS n_templates, 'https://host/' || (d.doc_id % 3) AS rel_url,
  text || CASE d.doc_id % 3 WHEN 0 THEN '{{Citation needed|date=2020}} {{POV}}' WHEN 1 THEN '{{clarify|reason=x}} {{CLARIFY}} {{Update|}}' ELSE '' END AS wikitext,
  ['create', 'update', 'delete'][d.doc_id % 3 + 1] AS event_type, CAST(d.doc_id % 11 AS INTEGER) AS fail_count,
  CASE d.doc_id % 5 WHEN 0 THEN true WHEN 1 THEN NULL ELSE false END AS internal
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page changes of events."""
    e = events(spark, sf_dir)
    kind = F.create_map(*[F.lit(x) for p in (("signup", "create"), ("view", "edit"), ("click", "move"), ("error", "delete"), ("purchase", "visibility_change")) for x in p])
    spaces, prior = F.array(*map(F.lit, (0, 6, 10, 14, 2))), F.array(*map(F.lit, (0, 6, 1, 14)))
    user = F.col("user_id")
    return e.select(
        F.concat(F.element_at(F.array(*map(F.lit, ("en", "de", "fr", "xx"))), (user % 4 + 1).cast("int")), F.lit("wiki")).alias("database"),
        kind[F.col("event_type")].alias("page_change_kind"),
        F.struct(F.col("ts").alias("dt")).alias("meta"),
        F.struct(
            user.alias("page_id"), F.concat(F.lit("Page "), user.cast("string")).alias("page_title"),
            F.element_at(spaces, (F.col("event_id") % 5 + 1).cast("int")).alias("page_namespace"),
            (F.get_json_object("props", "$.k").cast("long") % 10 == 0).alias("page_is_redirect"),
        ).alias("page"),
        F.struct(user.alias("user_id"), F.concat(F.lit("User"), (user % 40).cast("string")).alias("user_text")).alias("performer"),
        F.struct(F.col("event_id").alias("rev_id"), F.col("ts").alias("rev_dt"), (F.col("event_id") % 2 == 0).alias("is_content_visible"), (F.col("event_id") % 3 == 0).alias("is_editor_visible"), F.lit(True).alias("is_comment_visible")).alias("revision"),
        F.struct(F.struct(F.concat(F.lit("Old "), user.cast("string")).alias("page_title"), F.element_at(prior, (user % 4 + 1).cast("int")).alias("page_namespace")).alias("page")).alias("prior_state"),
    )


CHANGES_SQL = """
changes AS (SELECT ['en', 'de', 'fr', 'xx'][user_id % 4 + 1] || 'wiki' AS db,
  CASE event_type WHEN 'signup' THEN 'create' WHEN 'view' THEN 'edit' WHEN 'click' THEN 'move' WHEN 'error' THEN 'delete' WHEN 'purchase' THEN 'visibility_change' END AS kind,
  ts, user_id AS page_id, 'Page ' || user_id AS title, [0, 6, 10, 14, 2][event_id % 5 + 1] AS ns,
  CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS BIGINT) % 10 = 0 AS redirect, user_id, 'User' || (user_id % 40) AS user_text, event_id AS rev_id,
  'Old ' || user_id AS prior_title, [0, 6, 1, 14][user_id % 4 + 1] AS prior_ns FROM events)"""


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of events with partitions and offsets."""
    part = (F.col("user_id") % 50).cast("int")
    at = F.row_number().over(Window.partitionBy(part).orderBy("ts", "event_id")) - 1
    return events(spark, sf_dir).select(
        F.col("user_id").alias("key"), F.col("event_id").alias("value"), F.col("event_type"), part.alias("partition"), at.cast("long").alias("offset"), F.col("ts").alias("timestamp")
    )


LOG_SQL = """
log AS (SELECT user_id AS key, event_id AS value, event_type, CAST(user_id % 50 AS INTEGER) AS partition,
  row_number() OVER (PARTITION BY user_id % 50 ORDER BY ts, event_id) - 1 AS off, ts FROM events)"""


def diff_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of one language whose ids follow each other: previous and current."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    after = d.select((F.col("doc_id") - 1).alias("doc_id"), F.col("text").alias("current"), "lang")
    return d.withColumnRenamed("text", "previous").join(after, ["doc_id", "lang"])


PAIRS_SQL = """
pairs AS (SELECT a.doc_id, a.lang, a.text AS previous, b.text AS current FROM documents a JOIN documents b ON b.doc_id = a.doc_id + 1 AND a.lang = b.lang)"""


def editor_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = table(spark, sf_dir, "events").select("user_id").distinct()
    rule = lambda n, g: F.when(F.col("user_id") % n == 0, F.lit(g))
    return users.select("user_id", F.array_compact(F.array(rule(7, "sysop"), rule(11, "bot"), rule(5, "patroller"), rule(13, "steward"))).alias("groups"))


GROUPS_SQL = """
editors AS (SELECT user_id, list_filter([CASE WHEN user_id % 7 = 0 THEN 'sysop' END, CASE WHEN user_id % 11 = 0 THEN 'bot' END,
  CASE WHEN user_id % 5 = 0 THEN 'patroller' END, CASE WHEN user_id % 13 = 0 THEN 'steward' END], lambda x: x IS NOT NULL) AS groups FROM (SELECT DISTINCT user_id FROM events))"""
