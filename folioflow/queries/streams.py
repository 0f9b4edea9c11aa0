"""Streams run to their end over the tables; results equal those of the batch forms."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.dataset import CHANGES_SQL, changes
from folioflow.queries.registry import query
from folioflow.queries.relational import _EVENTS
from folioflow.streaming import jobs


def _folder(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        import tempfile

        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")

        root = "file://" + tempfile.mkdtemp(prefix="folioflow-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root}/stream-{uuid.uuid4().hex}"


def _landed(spark: SparkSession, rows: DataFrame, folder: str) -> DataFrame:
    rows.write.parquet(f"{folder}/in")
    return jobs.landed(spark, f"{folder}/in", rows.schema)


@query("stream_articles", "SELECT rev_id AS version, t AS event_type, n AS name FROM e WHERE db <> 'xxwiki'", CHANGES_SQL, _EVENTS)
def stream_articles(spark: SparkSession, d: str) -> DataFrame:
    folder = _folder(spark)
    stream = jobs.article_stream(_landed(spark, changes(spark, d), folder)).filter(F.col("topic").contains(".article-"))
    jobs.run_available(stream.select("version", "event_type", "name"), f"{folder}/out", f"{folder}/at")
    return spark.read.parquet(f"{folder}/out")


@query(
    "stream_hourly",
    "SELECT hour, kind, n FROM (SELECT date_trunc('hour', ts) AS hour, kind, count(*) AS n FROM changes GROUP BY 1, 2) WHERE hour + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 1 HOUR FROM changes)",
    CHANGES_SQL,
)
def stream_hourly(spark: SparkSession, d: str) -> DataFrame:
    folder = _folder(spark)
    rows = changes(spark, d).select(F.col("meta.dt").alias("ts"), F.col("page_change_kind").alias("kind"))
    jobs.run_available(jobs.hourly_counts(_landed(spark, rows, folder), "ts", ["kind"]), f"{folder}/out", f"{folder}/at")
    return spark.read.parquet(f"{folder}/out")


_STATE = """
s AS (SELECT page_id AS page, max_by(ts, (ts, rev_id)) FILTER (kind = 'create' AND ns = 0) AS created, max_by(ts, (ts, rev_id)) FILTER (kind = 'move' AND ns = 0) AS moved,
  min((ts, rev_id)) FILTER (kind IN ('create', 'move') AND ns = 0) AS since FROM changes GROUP BY page_id)"""


@query("st_state_ttl", """SELECT s.page, any_value(created) AS created, any_value(moved) AS moved, count(*) FILTER (kind = 'edit' AND (ts, rev_id) > since) AS edits,
  count(DISTINCT lower(user_text)) FILTER (kind = 'edit' AND (ts, rev_id) > since) AS unique_editors FROM s JOIN changes ON page_id = s.page GROUP BY s.page""", CHANGES_SQL, _STATE)
def state_stream(spark: SparkSession, d: str) -> DataFrame:
    """The keyed state of every page after one pass over the changes."""
    folder = _folder(spark)
    c = changes(spark, d)
    rows = c.select(F.col("page.page_id").alias("page"), F.col("page_change_kind").alias("kind"), F.col("page.page_namespace").alias("namespace"), F.col("revision.rev_id").alias("version"), F.col("performer.user_text").alias("editor"), F.col("revision.rev_dt").alias("at"))
    stream = jobs.integrity_stream(_landed(spark, rows, folder))
    # The state's updates go to files, batch by batch; the last of each page is its state.
    # One batch of all that is there: with time-outs a stream always has another batch to try.
    keep = lambda batch, n: batch.write.mode("overwrite").parquet(f"{folder}/out/batch={n}")
    run = stream.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", f"{folder}/at").trigger(once=True).start()
    run.awaitTermination()
    found = spark.read.parquet(f"{folder}/out")
    return found.groupBy("page").agg(F.max_by(F.struct("created", "moved", "edits", "unique_editors"), "batch").alias("s")).select("page", "s.*")


@query("src_kafka_resume", "SELECT event_id AS rev_id FROM events")
def resume(spark: SparkSession, d: str) -> DataFrame:
    """A stream stopped and started again from its checkpoint reads each message once."""
    folder = _folder(spark)
    rows = changes(spark, d).select(F.col("revision.rev_id").alias("rev_id"))
    stream = _landed(spark, rows, folder)
    for _ in range(2):
        jobs.run_available(stream, f"{folder}/out", f"{folder}/at")
    return spark.read.parquet(f"{folder}/out")


@query("src_commons_list", """SELECT lang, '{"doc_id":' || doc_id || '}' AS line FROM documents""")
def commons_list(spark: SparkSession, d: str) -> DataFrame:
    from folioflow.dataset import table
    from folioflow.sources.files import listing

    folder = f"{_folder(spark)}/pages"
    table(spark, d, "documents").select("lang", "doc_id").repartition("lang").write.partitionBy("lang").json(folder)
    files = listing(spark, folder, "*.json", recursive=True).withColumn("lang", F.regexp_extract("path", "lang=([^/]+)", 1))
    return files.select("lang", F.explode(F.split(F.trim("text"), "\n")).alias("line"))
