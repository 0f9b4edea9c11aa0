"""Whole enrichment pipelines, archive members, clean-up, and streams by name."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.dataset import ARTICLES_SQL, CHANGES_SQL, PAIRS_SQL, articles, changes, table
from folioflow.operators import enrich
from folioflow.operators import snapshot as N
from folioflow.queries.registry import query
from folioflow.queries.relational import _DELTA
from folioflow.queries.streams import _folder, _landed
from folioflow.streaming import jobs

_DIFF = """
diff AS (SELECT pairs.doc_id, CAST(coalesce(sum(c - p) FILTER (c > p), 0) AS BIGINT) AS increase, CAST(coalesce(sum(c - p) FILTER (c < p), 0) AS BIGINT) AS decrease
  FROM pairs LEFT JOIN cnt ON pairs.doc_id = cnt.doc_id GROUP BY pairs.doc_id),
full_page AS (SELECT d.doc_id, d.lang, d.text, p.previous, p.current, increase, decrease FROM documents d LEFT JOIN pairs p ON d.doc_id = p.doc_id LEFT JOIN diff ON d.doc_id = diff.doc_id)"""


@query("st_enrich_update", """SELECT rev_id AS version, 'Doc_' || doc_id AS name, length(coalesce(current, text)) AS chars,
  CASE WHEN doc_id IS NULL OR doc_id % 5 <> 0 THEN user_text END AS editor, CASE WHEN (doc_id IS NULL OR doc_id % 5 <> 0) AND user_id % 3 > 0 THEN user_id * 2 END AS edit_count,
  increase, decrease, octet_length(encode(current)) - octet_length(encode(previous)) AS diff_size,
  CASE WHEN previous IS NOT NULL AND ns = 0 THEN rev_id % 2 = 0 END AS prediction, CASE WHEN doc_id % 4 = 0 THEN doc_id % 8 = 0 END AS is_breaking_news, coalesce(doc_id % 7 = 0, false) AS noindex,
  '/' || db || '/' || rev_id AS version_identifier, '/' || db || '/Doc_' || doc_id AS key
  FROM changes LEFT JOIN full_page ON doc_id = page_id WHERE kind = 'edit'""", CHANGES_SQL, PAIRS_SQL, _DELTA, _DIFF)  # fmt: skip
def enrich_update(spark: SparkSession, d: str) -> DataFrame:
    """Every edit with its page, editor, score, state and the difference of its words."""
    words = lambda c: F.regexp_extract_all(c, F.lit("[a-zA-Z]+"), F.lit(0))
    c = changes(spark, d).filter("page_change_kind = 'edit'")
    events = c.select(F.col("database").alias("project"), F.col("page.page_namespace").alias("namespace"), F.col("page.page_id").alias("page_id"), F.col("revision.rev_id").alias("rev_id"), F.col("performer.user_id").alias("user_id"), F.col("performer.user_text").alias("user_text"))
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("page_id"), "text", "lang")
    after = docs.select((F.col("page_id") - 1).alias("page_id"), F.col("text").alias("_text"), F.col("lang").alias("_lang"))
    # Joined by id alone, as the events are: texts are dealt out once.
    own = docs.join(after, "page_id", "left").withColumn("paired", F.coalesce(F.col("lang") == F.col("_lang"), F.lit(False)))
    own = own.select("page_id", "text", "paired", F.when(F.col("paired"), F.col("text")).alias("previous"), F.when(F.col("paired"), F.col("_text")).alias("current"))
    name = F.concat(F.lit("Doc_"), F.col("page_id").cast("string"))
    templates = F.when(F.col("page_id") % 7 == 0, F.array(F.lit("Template:No Index"))).otherwise(F.array(F.lit("Template:Other")))
    text = F.coalesce("current", "text")
    pages = own.select("page_id", name.alias("title"), "previous", text.alias("wikitext"), F.when(F.col("paired"), F.coalesce(words("previous"), F.array().cast("array<string>"))).alias("previous_words"), words(F.when(F.col("paired"), F.col("current")).otherwise(F.col("text"))).alias("words"), templates.alias("templates"))
    users = events.select("user_id").distinct().filter("user_id % 3 > 0").select("user_id", (F.col("user_id") * 2).alias("edit_count"), F.array().cast("array<string>").alias("groups"))
    scores = events.select("rev_id", (F.col("rev_id") % 2 == 0).alias("prediction"), F.lit(0.5).alias("probability_true"))
    state = docs.filter("page_id % 4 = 0").select("page_id", (F.col("page_id") % 8 == 0).alias("is_breaking_news"))
    protected = docs.filter("page_id % 5 = 0").select(name.alias("title"))
    out = enrich.enriched_updates(events, pages, users, scores, state, protected, ["no index"])
    out = out.withColumn("version", F.col("version").dropFields("maintenance_tags"))  # else they are counted, though nobody reads them
    v = F.col("version")
    return out.select(
        v["identifier"].alias("version"), "name", v["number_of_characters"].alias("chars"), v["editor"]["name"].alias("editor"), v["editor"]["edit_count"].alias("edit_count"),
        v["diff"]["increase"].alias("increase"), v["diff"]["decrease"].alias("decrease"), v["diff"]["size"].alias("diff_size"), v["scores"]["prediction"].alias("prediction"),
        v["is_breaking_news"].alias("is_breaking_news"), v["noindex"].alias("noindex"), "version_identifier", "key",
    )


@query("st_enrich_bulk", """SELECT name, identifier, identifier * 10 AS version, CASE WHEN identifier % 50 % 3 > 0 THEN identifier % 50 * 2 END AS edit_count, octet_length(encode(wikitext)) AS size, '/' || project || '/' || name AS key FROM articles""", ARTICLES_SQL)
def enrich_bulk(spark: SparkSession, d: str) -> DataFrame:
    """Work items of ten titles each, with one more title that no page has."""
    a = articles(spark, d)
    own = a.select(F.col("is_part_of.identifier").alias("project"), F.col("namespace.identifier").alias("namespace"), "name", F.floor(F.col("identifier") / 40).alias("item"))
    names = own.groupBy("project", "namespace", "item").agg(F.concat(F.collect_list("name"), F.array(F.lit("Doc_none"))).alias("titles"))
    pages = a.select(F.col("name").alias("title"), F.col("identifier").alias("page_id"), F.col("version.identifier").alias("rev_id"), (F.col("identifier") % 50).alias("user_id"), F.col("article_body.wikitext").alias("wikitext"))
    users = spark.range(50).filter("id % 3 > 0").select(F.col("id").alias("user_id"), (F.col("id") * 2).alias("edit_count"))
    out = enrich.enriched_bulk(names, pages, users)
    return out.select("name", "identifier", F.col("version.identifier").alias("version"), F.col("version.edit_count").alias("edit_count"), F.col("version.size").alias("size"), "key")


@query("snk_snapshot_members", """SELECT project, ns, member, project || '_' || ns || '_chunk_' || member || '.ndjson' AS file, count(*) AS total, round((sum(octet_length(encode(line)) + 1)) / 1e6, 3) AS size_mb,
  md5(string_agg(line, chr(10) ORDER BY identifier) || chr(10)) AS version FROM
  (SELECT *, CAST(floor(coalesce(sum(octet_length(encode(line)) + 1) OVER (PARTITION BY project, ns ORDER BY identifier ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / 4000) AS BIGINT) AS member FROM
    (SELECT project, CAST(ns AS VARCHAR) AS ns, identifier, '{"name":"' || name || '","identifier":' || identifier || ',"url":"' || project_url || '"}' AS line FROM articles WHERE event_type <> 'delete'))
  GROUP BY project, ns, member""", ARTICLES_SQL)
def snapshot_members(spark: SparkSession, d: str) -> DataFrame:
    """Archive members of each project and namespace with their size and md5."""
    kept = N.excluded(articles(spark, d), ["delete"], F.col("event.type"))
    line = F.to_json(F.struct("name", "identifier", F.col("is_part_of.url").alias("url")))
    lines = kept.select(F.col("is_part_of.identifier").alias("project"), F.col("namespace.identifier").cast("string").alias("ns"), "identifier", line.alias("line")).filter("line <> '{}'")
    return N.members(lines, ["project", "ns"], ["identifier"], "line", 4000)


@query("snk_cleanup", """SELECT lang AS snapshot, lang || '_chunk_' || doc_id || '.tar.gz' AS key, (row_number() OVER (PARTITION BY lang ORDER BY lang || '_chunk_' || doc_id || '.tar.gz') - 1) // 20 AS request
  FROM documents WHERE doc_id % 3 > 0""")
def cleanup(spark: SparkSession, d: str) -> DataFrame:
    """Two chunks of three are old, each with a copy for a group, which stays; 20 keys a request."""
    docs = table(spark, d, "documents")
    base = F.concat("lang", F.lit("_chunk_"), F.col("doc_id").cast("string"))
    existing = docs.select(F.col("lang").alias("snapshot"), F.explode(F.array(F.concat(base, F.lit(".tar.gz")), F.concat(base, F.lit("_group.tar.gz")))).alias("key"))
    current = docs.filter("doc_id % 3 = 0").select(F.col("lang").alias("snapshot"), F.concat(base, F.lit(".tar.gz")).alias("key"))
    return N.stale(existing, current, "group", 20)


@query("src_ksql_push", "SELECT rev_id, title AS name FROM changes WHERE kind = 'edit' AND ns = 0", CHANGES_SQL)
def ksql_push(spark: SparkSession, d: str) -> DataFrame:
    """SQL over a named stream, row by row as they come."""
    folder, name = _folder(spark), f"s_{uuid.uuid4().hex}"
    rows = changes(spark, d).select(F.col("revision.rev_id").alias("rev_id"), F.col("page.page_title").alias("name"), F.col("page_change_kind").alias("kind"), F.col("page.page_namespace").alias("ns"))
    jobs.create_stream(spark, name, _landed(spark, rows, folder))
    jobs.push(spark, f"SELECT rev_id, name FROM {name} WHERE kind = 'edit' AND ns = 0", f"{folder}/out", f"{folder}/at")
    jobs.drop_stream(spark, name)
    return spark.read.parquet(f"{folder}/out")


@query("ddl_stream", "SELECT 'created' AS step, true AS there UNION ALL SELECT 'created again', true UNION ALL SELECT 'dropped', false UNION ALL SELECT 'streaming', true")
def ddl_stream(spark: SparkSession, d: str) -> DataFrame:
    """A named stream is created, created again if there is none, and dropped."""
    folder, name = _folder(spark), f"s_{uuid.uuid4().hex}"
    stream = _landed(spark, table(spark, d, "region"), folder)
    jobs.create_stream(spark, name, stream)
    steps = [("created", spark.catalog.tableExists(name)), ("streaming", spark.table(name).isStreaming)]
    jobs.create_stream(spark, name, stream, if_not_exists=True)
    steps.append(("created again", spark.catalog.tableExists(name)))
    jobs.drop_stream(spark, name)
    steps.append(("dropped", spark.catalog.tableExists(name)))
    return spark.createDataFrame(steps, "step string, there boolean")
