"""Joins, aggregations, windows, events, state and snapshot queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.dataset import ARTICLES_SQL, CHANGES_SQL, LOG_SQL, PAIRS_SQL, articles, changes, diff_pairs, events, log, table
from folioflow.functions.text import hash_path
from folioflow.operators import aggregates as G
from folioflow.operators import events as E
from folioflow.operators import joins as J
from folioflow.operators import snapshot as N
from folioflow.operators import state as I
from folioflow.operators import windows as W
from folioflow.plans import select as S
from folioflow.queries.registry import query

A, C, L = ARTICLES_SQL, CHANGES_SQL, LOG_SQL

# Joins


@query("join_multi_getter", """SELECT d.doc_id, CASE WHEN d.doc_id % 2 = 0 THEN d.n_chars END AS page, l.quality AS score, CASE WHEN d.doc_id % 2 = 0 THEN '' ELSE 'page' END AS errors
  FROM documents d LEFT JOIN (SELECT doc_id, min(quality) AS quality FROM labels GROUP BY doc_id) l ON d.doc_id = l.doc_id""")  # fmt: skip
def join_multi(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    pages = docs.filter("doc_id % 2 = 0").select("doc_id", F.struct("n_chars").alias("value"))
    scores = table(spark, d, "labels").groupBy("doc_id").agg(F.struct(F.min("quality").alias("quality")).alias("value"))
    out = J.multi_getter(docs.select("doc_id"), {"page": (pages, False), "score": (scores, True)}, "doc_id")
    return out.select("doc_id", F.col("page.n_chars").alias("page"), F.col("score.quality").alias("score"), F.array_join("errors", ",").alias("errors"))


@query("join_remap_rev_title", "SELECT 'Doc_' || d.doc_id AS title, CAST(octet_length(encode(text)) AS DOUBLE) AS size FROM documents d")
def join_remap(spark: SparkSession, d: str) -> DataFrame:
    a = articles(spark, d)
    by_rev = a.select(F.col("version.identifier").alias("rev"), F.col("version.size.value").alias("size"))
    keys = a.select(F.col("version.identifier").alias("rev"), F.col("name").alias("title"))
    return J.remap(by_rev, keys, "rev", "title").select("title", "size")


@query("join_user", "SELECT identifier, CASE WHEN editor_id <> 0 THEN n END AS edits FROM articles LEFT JOIN (SELECT user_id, count(*) AS n FROM events GROUP BY user_id) u ON editor_id = user_id", A)
def join_user(spark: SparkSession, d: str) -> DataFrame:
    users = table(spark, d, "events").filter("user_id <> 0").groupBy("user_id").agg(F.count("*").alias("edits"))
    own = articles(spark, d).select("identifier", F.col("version.editor.identifier").alias("user_id"))
    return own.join(users, "user_id", "left").select("identifier", "edits")


@query("join_lang", "SELECT rev_id, CASE db WHEN 'enwiki' THEN 'en' WHEN 'dewiki' THEN 'de' ELSE 'fr' END AS language FROM changes WHERE db IN ('enwiki', 'dewiki', 'frwiki')", C)
def join_lang(spark: SparkSession, d: str) -> DataFrame:
    dims = spark.createDataFrame([("enwiki", "en"), ("dewiki", "de"), ("frwiki", "fr")], "database string, language string")
    return changes(spark, d).join(F.broadcast(dims), "database").select(F.col("revision.rev_id").alias("rev_id"), "language")


@query("join_ns_desc", "SELECT identifier, CASE ns WHEN 0 THEN 'main' WHEN 6 THEN 'media' ELSE '' END AS description FROM articles", A)
def join_ns(spark: SparkSession, d: str) -> DataFrame:
    dims = spark.createDataFrame([(0, "main"), (6, "media")], "ns int, description string")
    own = articles(spark, d).select("identifier", F.col("namespace.identifier").alias("ns"))
    return own.join(F.broadcast(dims), "ns", "left").select("identifier", F.coalesce("description", F.lit("")).alias("description"))


@query("join_integrity", "SELECT identifier, coalesce(n, 0) AS edits FROM articles LEFT JOIN (SELECT page_id, count(*) AS n FROM changes WHERE kind = 'edit' GROUP BY page_id) c ON identifier = page_id", A, C)
def join_integrity(spark: SparkSession, d: str) -> DataFrame:
    state = changes(spark, d).filter("page_change_kind = 'edit'").groupBy(F.col("page.page_id").alias("identifier")).agg(F.count("*").alias("n"))
    return articles(spark, d).select("identifier").join(state, "identifier", "left").select("identifier", F.coalesce("n", F.lit(0)).alias("edits"))


@query("join_coalesce_editor", "SELECT rev_id, coalesce(CASE WHEN user_id % 2 = 0 THEN 'Known' || user_id END, user_text) AS name FROM changes", C)
def join_editor(spark: SparkSession, d: str) -> DataFrame:
    rows = changes(spark, d).select(F.col("revision.rev_id").alias("rev_id"), F.col("performer.user_id").alias("user_id"), F.col("performer.user_text").alias("name"))
    known = rows.select("user_id").distinct().filter("user_id % 2 = 0").select("user_id", F.concat(F.lit("Known"), F.col("user_id").cast("string")).alias("name"))
    return J.coalesced(rows, known, "user_id", ["name"]).select("rev_id", "name")


@query("flt_ip_range", "SELECT event_id, CASE WHEN user_id % 256 BETWEEN 10 AND 99 THEN 'a' WHEN user_id % 256 BETWEEN 50 AND 199 THEN 'b' END AS label FROM events")
def ip_range(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events").select("event_id", F.concat(F.lit("10.0.0."), (F.col("user_id") % 256).cast("string")).alias("ip"))
    ranges = spark.createDataFrame([(1, "10.0.0.10", "10.0.0.99", "a"), (2, "10.0.0.50", "10.0.0.199", "b"), (3, "11.0.0.0", "11.3.0.0", "c")], "order int, first string, last string, label string")
    return J.ip_range(rows, ranges).select("event_id", "label")


@query("fn_redirect_map", "SELECT user_id, 'Final ' || (user_id % 5) AS target FROM (SELECT DISTINCT user_id FROM events)")
def redirect_map(spark: SparkSession, d: str) -> DataFrame:
    asked = table(spark, d, "events").select("user_id").distinct().withColumn("title", F.concat(F.lit("page_"), F.col("user_id").cast("string")))
    normal = asked.select(F.col("title").alias("from"), F.concat(F.lit("Page "), F.col("user_id").cast("string")).alias("to"))
    redirect = asked.select(F.concat(F.lit("Page "), F.col("user_id").cast("string")).alias("from"), F.concat(F.lit("Final "), (F.col("user_id") % 5).cast("string")).alias("to"))
    step = asked.join(normal, F.col("title") == F.col("from"), "left").select("user_id", F.coalesce("to", "title").alias("t"))
    return step.join(redirect, F.col("t") == F.col("from"), "left").select("user_id", F.coalesce("to", "t").alias("target"))


# Aggregations


@query("agg_latest_per_key", "SELECT key, value, event_type FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY ts DESC, value DESC) AS r FROM log) WHERE r = 1", L)
def latest(spark: SparkSession, d: str) -> DataFrame:
    return G.latest_per_key(log(spark, d), ["key"], ["timestamp", "value"]).select("key", "value", "event_type")


@query("agg_count_total_errors", "SELECT project, count(*) AS total, count(*) FILTER (fail_count > 8) AS errors FROM articles GROUP BY project", A)
def total_errors(spark: SparkSession, d: str) -> DataFrame:
    return articles(spark, d).groupBy(F.col("is_part_of.identifier").alias("project")).agg(F.count("*").alias("total"), F.count_if(F.col("event.fail_count") > 8).alias("errors"))


@query("agg_by_labels", "SELECT project, ns, fail_count > 8 AS has_errors, count(*) AS n, CAST(sum(chars) AS BIGINT) AS chars FROM articles GROUP BY ALL", A)
def by_labels(spark: SparkSession, d: str) -> DataFrame:
    return articles(spark, d).groupBy(F.col("is_part_of.identifier").alias("project"), F.col("namespace.identifier").alias("ns"), (F.col("event.fail_count") > 8).alias("has_errors")).agg(F.count("*").alias("n"), F.sum("version.number_of_characters").alias("chars"))


@query("agg_histogram", "SELECT event_type, count(*) FILTER (value <= 5.0) AS le_5_0, count(*) FILTER (value <= 10.0) AS le_10_0, count(*) FILTER (value <= 20.0) AS le_20_0, count(*) FILTER (value <= 40.0) AS le_40_0 FROM events GROUP BY event_type")
def histogram(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").groupBy("event_type").agg(*G.histogram(F.col("value"), G.exponential(5.0, 2.0, 4)))


@query("agg_freq_table", "SELECT token, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS token FROM documents) GROUP BY token")
def freq(spark: SparkSession, d: str) -> DataFrame:
    words = table(spark, d, "documents").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))).alias("token"))
    return words.groupBy("token").agg(F.count("*").alias("n"))


_DELTA = """
tok AS (SELECT doc_id, 0 AS s, unnest(regexp_extract_all(previous, '[a-zA-Z]+')) AS w FROM pairs UNION ALL SELECT doc_id, 1, unnest(regexp_extract_all(current, '[a-zA-Z]+')) FROM pairs),
cnt AS (SELECT doc_id, w, count(*) FILTER (s = 0) AS p, count(*) FILTER (s = 1) AS c FROM tok GROUP BY doc_id, w)"""


@query(
    "agg_delta",
    """SELECT pairs.doc_id, CAST(coalesce(sum(c - p) FILTER (c > p), 0) AS BIGINT) AS increase, CAST(coalesce(sum(c - p) FILTER (c < p), 0) AS BIGINT) AS decrease, CAST(coalesce(sum(c - p), 0) AS BIGINT) AS sum,
    round(coalesce(sum((c - p) / (p + 1)) FILTER (c > p), 0.0), 6) AS proportional_increase, round(coalesce(sum((c - p) / p) FILTER (c < p), 0.0), 6) AS proportional_decrease
    FROM pairs LEFT JOIN cnt ON pairs.doc_id = cnt.doc_id GROUP BY pairs.doc_id""", PAIRS_SQL, _DELTA,
)
def delta(spark: SparkSession, d: str) -> DataFrame:
    words = lambda c: F.regexp_extract_all(c, F.lit("[a-zA-Z]+"), F.lit(0))
    pairs = diff_pairs(spark, d).select("doc_id", words("previous").alias("p"), words("current").alias("c"))
    out = G.deltas(pairs, ["doc_id"], "p", "c")
    return out.withColumns({c: F.round(c, 6) for c in ("proportional_increase", "proportional_decrease")})


@query("agg_distinct_ci", "SELECT page_id, count(DISTINCT lower(user_text)) AS editors FROM changes GROUP BY page_id", C)
def distinct_ci(spark: SparkSession, d: str) -> DataFrame:
    name = F.when(F.col("revision.rev_id") % 2 == 0, F.upper("performer.user_text")).otherwise(F.col("performer.user_text"))
    return changes(spark, d).groupBy(F.col("page.page_id").alias("page_id")).agg(F.countDistinct(F.lower(name)).alias("editors"))


_VERSIONS = "versions AS (SELECT page_id AS page, rev_id AS version, user_text AS editor, ts FROM changes WHERE kind = 'edit')"
_ASKED = "asked AS (SELECT page, max(version) AS version, date_trunc('day', max(ts)) AS start FROM versions GROUP BY page)"


def _integrity(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    edits = changes(spark, d).filter("page_change_kind = 'edit'")
    v = edits.select(F.col("page.page_id").alias("page"), F.col("revision.rev_id").alias("version"), F.col("performer.user_text").alias("editor"), F.col("revision.rev_dt").alias("at"), F.col("revision.rev_id").alias("order"))
    return v.groupBy("page").agg(F.max("version").alias("version"), F.date_trunc("day", F.max("at")).alias("start")), v


@query("agg_count_windowed", "SELECT a.page, count(v.version) AS edits, count(DISTINCT lower(v.editor)) AS unique_editors FROM asked a LEFT JOIN versions v ON a.page = v.page AND v.version <= a.version AND v.ts BETWEEN a.start AND a.start + INTERVAL 24 HOUR GROUP BY a.page", C, _VERSIONS, _ASKED)
def count_windowed(spark: SparkSession, d: str) -> DataFrame:
    return I.counted(*_integrity(spark, d), hours=24).select("page", "edits", "unique_editors")


@query("st_breaking_news", "SELECT page, CASE WHEN page % 5 = 0 THEN NULL ELSE page % 2 = 0 AND (page % 3 = 0 OR editors >= 2 OR edits >= 10) END AS is_breaking_news FROM (SELECT a.page, count(v.version) AS edits, count(DISTINCT lower(v.editor)) AS editors FROM asked a LEFT JOIN versions v ON a.page = v.page AND v.version <= a.version AND v.ts BETWEEN a.start AND a.start + INTERVAL 1 HOUR GROUP BY a.page)", C, _VERSIONS, _ASKED)
def breaking(spark: SparkSession, d: str) -> DataFrame:
    requests, v = _integrity(spark, d)
    counts = I.counted(requests, v)
    own = counts.withColumns({"created": F.when(F.col("page") % 5 != 0, F.col("start")), "moved": F.lit(None).cast("timestamp"), "modified": F.col("start") + F.make_interval(hours=F.lit(3))})
    names = F.array(F.when(F.col("page") % 2 == 0, "Template:CITE news").otherwise("Template:x"), F.when(F.col("page") % 3 == 0, "Template:Current y").otherwise("Template:z"))
    done = I.breaking_news(own.withColumn("names", names), I.equal_fold_any(F.col("names"), ["template:cite news"]), I.prefix_any(F.col("names"), ["Template:Current"]))
    return done.select("page", "is_breaking_news")


@query("st_first_flag", "SELECT page, min(version) AS version FROM versions WHERE version % 3 = 0 GROUP BY page", C, _VERSIONS)
def first_flag(spark: SparkSession, d: str) -> DataFrame:
    _, v = _integrity(spark, d)
    return I.first_flagged(v.withColumn("is_breaking_news", F.col("version") % 3 == 0)).select("page", "version")


@query("st_state_track", "SELECT page_id, min(ts) FILTER (kind = 'create' AND ns = 0) AS created, max(ts) FILTER (kind = 'move' AND ns = 0) AS moved, count(*) FILTER (kind = 'edit') AS edits FROM changes GROUP BY page_id", C)
def state_track(spark: SparkSession, d: str) -> DataFrame:
    main, kind, at = F.col("page.page_namespace") == 0, F.col("page_change_kind"), F.col("revision.rev_dt")
    return changes(spark, d).groupBy(F.col("page.page_id").alias("page_id")).agg(
        F.min(F.when((kind == "create") & main, at)).alias("created"), F.max(F.when((kind == "move") & main, at)).alias("moved"), F.count_if(kind == "edit").alias("edits")
    )


@query("agg_contributors", "SELECT page_id, arg_max(CAST(v AS BIGINT), rev_id) AS anonymous, CAST(sum(n) AS BIGINT) AS registered FROM (SELECT page_id, rev_id, rev_id % 9 AS v, rev_id % 4 AS n FROM changes) GROUP BY page_id", C)
def contributors(spark: SparkSession, d: str) -> DataFrame:
    rev = F.col("revision.rev_id")
    n = (rev % 4).cast("int")
    names = F.slice(F.array(*[F.lit(f"u{i}") for i in range(4)]), 1, n)
    return changes(spark, d).groupBy(F.col("page.page_id").alias("page_id")).agg(F.max_by(rev % 9, rev).alias("anonymous"), F.sum(F.size(names)).alias("registered"))


@query("topk_unordered", "SELECT lang, doc_id FROM (SELECT lang, doc_id, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS r FROM documents) WHERE r <= 3")
def topk(spark: SparkSession, d: str) -> DataFrame:
    return W.top_matches(table(spark, d, "documents").select("lang", "doc_id"), ["lang"], ["doc_id"], 3)


@query("grp_chunk_n", "SELECT lang, c AS chunk, string_agg(doc_id, ',' ORDER BY doc_id) AS ids FROM (SELECT lang, doc_id, (row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1) // 10 AS c FROM documents) GROUP BY lang, c")
def chunk_n(spark: SparkSession, d: str) -> DataFrame:
    made = G.grouped_by_n(table(spark, d, "documents").select("lang", "doc_id"), ["lang"], ["doc_id"], "doc_id", 10)
    return made.select("lang", "chunk", F.array_join(F.transform("items", lambda x: x.cast("string")), ",").alias("ids"))


@query("grp_binpack", """WITH RECURSIVE c AS (SELECT source, count(*) AS n FROM documents GROUP BY source), total AS (SELECT sum(n) / 4 AS mean FROM c),
a AS (SELECT source, row_number() OVER (ORDER BY source) - 1 AS grp FROM c, total WHERE n > mean), o AS (SELECT source, n, row_number() OVER (ORDER BY n DESC, source) AS r FROM c, total WHERE n <= mean),
f AS (SELECT CAST(0 AS BIGINT) AS r, CAST('' AS VARCHAR) AS source, CAST(0 AS BIGINT) AS bin, [CAST(0 AS BIGINT) for x in range(greatest(1, 4 - (SELECT count(*) FROM a)))] AS bins
  UNION ALL SELECT o.r, o.source, CAST(list_position(bins, list_min(bins)) AS BIGINT), [CASE WHEN j = list_position(bins, list_min(bins)) THEN bins[j] + n ELSE bins[j] END for j in range(1, len(bins) + 1)] FROM f JOIN o ON o.r = f.r + 1)
SELECT CAST(grp AS INTEGER) AS grp, source FROM a UNION ALL SELECT CAST((SELECT count(*) FROM a) + bin - 1 AS INTEGER), source FROM f WHERE r > 0""")
def binpack(spark: SparkSession, d: str) -> DataFrame:
    """Sources in four groups of near equal numbers of documents; the sources' counts are one row each."""
    counts = {r.source: r["count"] for r in table(spark, d, "documents").groupBy("source").count().collect()}
    return spark.createDataFrame([(i, s) for i, g in enumerate(G.binpack(counts, 4)) for s in g], "grp int, source string")


@query("part_map_parts", "SELECT value FROM log WHERE partition IN (5, 6, 7, 8, 9, 15, 16, 17, 18, 19)", L)
def map_parts(spark: SparkSession, d: str) -> DataFrame:
    return log(spark, d).filter(F.col("partition").isin(S.parts_to_partitions([1, 3]))).select("value")


@query("part_distribute", "SELECT p AS partition, ntile(7) OVER (ORDER BY p) AS worker FROM (SELECT DISTINCT CAST(user_id % 50 AS INTEGER) AS p FROM events)")
def distribute(spark: SparkSession, d: str) -> DataFrame:
    parts = sorted(r.partition for r in log(spark, d).select("partition").distinct().collect())  # at most 50
    rows = [(p, i + 1) for i, own in enumerate(S.distribute(parts, 7)) for p in own]
    return spark.createDataFrame(rows, "partition int, worker int").select("partition", F.col("worker").cast("long").alias("worker"))


@query("dim_build", "SELECT lang || 'wiki' AS project, lang AS language, ns, CASE ns WHEN 0 THEN 'Article' ELSE 'Space' || ns END AS name FROM (SELECT DISTINCT lang FROM documents), (VALUES (0), (6), (10), (14)) v(ns)")
def dims(spark: SparkSession, d: str) -> DataFrame:
    langs = table(spark, d, "documents").select("lang").distinct().select("lang", F.array(F.concat("lang", F.lit("wiki"))).alias("site"))
    flat = langs.select(F.explode("site").alias("project"), F.col("lang").alias("language")).select("*", F.explode(F.array(*map(F.lit, (0, 1, 6, 10, 14)))).alias("ns"))
    kept = flat.filter(F.col("ns").isin(0, 6, 10, 14))
    return kept.select("project", "language", "ns", F.when(F.col("ns") == 0, "Article").otherwise(F.concat(F.lit("Space"), F.col("ns").cast("string"))).alias("name"))


@query("dim_merge_pages", "SELECT user_id, string_agg(event_id, ',' ORDER BY event_id) AS ids, arg_min(event_type, event_id) FILTER (event_id % 2 = 0) AS first_type FROM events GROUP BY user_id")
def merge_pages(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "events").select("user_id", "event_id", F.array(F.col("event_id").cast("string")).alias("ids"), F.when(F.col("event_id") % 2 == 0, F.col("event_type")).alias("first_type"))
    merged = G.merge_pages(pages, "user_id", ["ids"], ["first_type"], "event_id")
    return merged.select("user_id", F.array_join("ids", ",").alias("ids"), "first_type")


@query("union_all_ndjson", """SELECT 'language' AS kind, '{"identifier":"' || lang || '"}' AS line FROM (SELECT DISTINCT lang FROM documents) UNION ALL SELECT 'project', '{"identifier":"' || source || '"}' FROM (SELECT DISTINCT source FROM documents)""")
def union_lines(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    line = lambda kind, c: docs.select(c).distinct().select(F.lit(kind).alias("kind"), F.to_json(F.struct(F.col(c).alias("identifier"))).alias("line"))
    return line("language", "lang").unionByName(line("project", "source"))


# Windows


@query("win_running_cap", "SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) <= 20 AS allowed FROM events")
def cap(spark: SparkSession, d: str) -> DataFrame:
    return W.running_cap(table(spark, d, "events"), ["user_id"], ["ts", "event_id"], 20).select("event_id", "allowed")


@query("win_rate_limit", "SELECT event_id, row_number() OVER (PARTITION BY event_type, date_trunc('second', ts) ORDER BY ts, event_id) <= 1 AS allowed FROM events")
def rate(spark: SparkSession, d: str) -> DataFrame:
    return W.rate_limit(table(spark, d, "events"), ["event_type"], "ts", ["ts", "event_id"], 1).select("event_id", "allowed")


@query("win_rolling_mean", "SELECT a.event_type, a.s AS second, round(sum(b.n) / 15.0, 6) AS mean FROM per a JOIN per b ON a.event_type = b.event_type AND b.s BETWEEN a.s - 14 AND a.s GROUP BY a.event_type, a.s", "per AS (SELECT event_type, CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS s, count(*) AS n FROM events GROUP BY ALL)")
def rolling(spark: SparkSession, d: str) -> DataFrame:
    return W.rolling_mean(events(spark, d), ["event_type"], "ts").select("event_type", "second", F.round("mean", 6).alias("mean"))


@query("win_idle_gap", "SELECT event_id, CAST(epoch(date_trunc('second', ts)) AS BIGINT) - CAST(epoch(date_trunc('second', lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id))) AS BIGINT) AS idle FROM events")
def idle(spark: SparkSession, d: str) -> DataFrame:
    return W.idle_gap(events(spark, d), ["user_id"], "ts", ["ts", "event_id"]).select("event_id", "idle")


@query("sort_ids", "SELECT event_type, array_to_string(list_sort(list(DISTINCT user_id)), ',') AS ids FROM events GROUP BY event_type")
def sort_ids(spark: SparkSession, d: str) -> DataFrame:
    ids = table(spark, d, "events").groupBy("event_type").agg(F.array_sort(F.collect_set("user_id")).alias("ids"))  # as many as users
    return ids.select("event_type", F.array_join(F.transform("ids", lambda x: x.cast("string")), ",").alias("ids"))


# Sources


@query("src_offset_resolve", "SELECT value FROM log WHERE (partition = 1 AND ts >= TIMESTAMP '2024-01-03') OR (partition = 2 AND off >= 3)", L)
def offsets(spark: SparkSession, d: str) -> DataFrame:
    keep = S.start_positions([1, 2, 3], since_per_partition={1: F.to_timestamp(F.lit("2024-01-03 00:00:00"))}, offsets={2: 3})
    return log(spark, d).filter(keep).select("value")


@query("src_kafka_bounded", "SELECT partition, count(*) AS n, max(off) AS last FROM log WHERE off >= 2 GROUP BY partition", L)
def bounded(spark: SparkSession, d: str) -> DataFrame:
    return log(spark, d).filter("offset >= 2").groupBy("partition").agg(F.count("*").alias("n"), F.max("offset").alias("last"))


@query("src_export_cutoff", "SELECT value FROM log WHERE ts <= TIMESTAMP '2024-01-15'", L)
def cutoff(spark: SparkSession, d: str) -> DataFrame:
    return log(spark, d).filter(F.col("timestamp") <= F.to_timestamp(F.lit("2024-01-15 00:00:00"))).select("value")


@query("src_s3_ndjson", "SELECT identifier, name FROM articles WHERE ns = 6", A)
def ndjson(spark: SparkSession, d: str) -> DataFrame:
    lines = articles(spark, d).select(F.to_json(F.struct("identifier", "name", "namespace")).alias("line"))
    read = lines.select(F.from_json("line", "identifier long, name string, namespace struct<identifier:int>").alias("r"))
    return read.filter("r.namespace.identifier = 6").select("r.identifier", "r.name")


@query("src_s3_json_point", "SELECT identifier, project FROM articles WHERE name = 'Doc_42'", A)
def point(spark: SparkSession, d: str) -> DataFrame:
    return articles(spark, d).filter("name = 'Doc_42'").select("identifier", F.col("is_part_of.identifier").alias("project"))


@query("src_list_prefix", "SELECT DISTINCT project || '_namespace_' || ns || '.json' AS key FROM articles", A)
def prefix(spark: SparkSession, d: str) -> DataFrame:
    base = F.concat(F.lit("snapshots/"), F.col("is_part_of.identifier"), F.lit("_namespace_"), F.col("namespace.identifier").cast("string"))
    keys = articles(spark, d).select(F.explode(F.array(F.concat(base, F.lit(".json")), F.concat(base, F.lit("_group.json")), F.concat(base, F.lit(".tar.gz")), F.concat(base, F.lit("/x.json")))).alias("k")).distinct()
    kept = keys.filter(F.col("k").rlike(r"^snapshots/[^/]+\.json$") & ~F.col("k").endswith("_group.json"))
    return kept.select(F.substring_index("k", "/", -1).alias("key"))


@query("src_static_config", "SELECT n_name AS name, r_name AS region FROM nation JOIN region ON n_regionkey = r_regionkey")
def config(spark: SparkSession, d: str) -> DataFrame:
    regions = F.broadcast(table(spark, d, "region"))  # a fixed list of regions
    return table(spark, d, "nation").join(regions, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_name").alias("name"), F.col("r_name").alias("region"))


@query("src_ksql_pull", "SELECT partition, count(*) AS n FROM log GROUP BY partition", L)
def pull(spark: SparkSession, d: str) -> DataFrame:
    log(spark, d).createOrReplaceTempView("messages_v")
    return spark.sql("SELECT partition, count(*) AS n FROM messages_v GROUP BY partition")


# Events

_SERVED = "(0, 6, 10, 14)"
_EVENTS = f"""
e AS (SELECT *, CASE WHEN redirect THEN 'delete' ELSE 'update' END AS t, title AS n, ns AS s FROM changes WHERE kind = 'edit' AND ns IN {_SERVED}
  UNION ALL SELECT *, kind, title, ns FROM changes WHERE kind IN ('create', 'delete') AND ns IN {_SERVED} AND NOT redirect
  UNION ALL SELECT *, 'visibility-change', title, ns FROM changes WHERE kind = 'visibility_change' AND ns IN {_SERVED} AND NOT redirect
  UNION ALL SELECT *, 'move', title, ns FROM changes WHERE kind = 'move' AND ns IN {_SERVED} AND NOT redirect
  UNION ALL SELECT *, 'delete', prior_title, prior_ns FROM changes WHERE kind = 'move' AND prior_ns IN {_SERVED})"""


@query("st_prefilter", f"SELECT rev_id FROM changes WHERE db IN ('enwiki', 'dewiki', 'frwiki', 'eswiki') AND (ns IN {_SERVED} OR prior_ns IN {_SERVED})", C)
def prefilter(spark: SparkSession, d: str) -> DataFrame:
    return E.prefilter(changes(spark, d)).select(F.col("revision.rev_id").alias("rev_id"))


@query("st_flatmap_pagechange", "SELECT rev_id, t AS type, n AS name, CAST(s AS INTEGER) AS namespace FROM e", C, _EVENTS)
def flatmap(spark: SparkSession, d: str) -> DataFrame:
    return E.article_events(changes(spark, d)).select(F.col("revision.rev_id").alias("rev_id"), "e.*").select("rev_id", "type", "name", "namespace")


for _name, _kinds in {"st_create": ("create", "undelete"), "st_update": ("edit",), "st_delete": ("delete",), "st_visibility": ("visibility_change",), "st_move": ("move",)}.items():

    @query(_name, f"SELECT rev_id, t AS type, n AS name FROM e WHERE kind IN ({', '.join(repr(k) for k in _kinds)})", C, _EVENTS)
    def _one(spark: SparkSession, d: str, kinds: tuple[str, ...] = _kinds) -> DataFrame:
        own = changes(spark, d).filter(F.col("page_change_kind").isin(*kinds))
        return E.article_events(own).select(F.col("revision.rev_id").alias("rev_id"), F.col("e.type").alias("type"), F.col("e.name").alias("name"))


@query("st_transform", "SELECT rev_id AS version, '/' || db || '/' || n AS key, t AS event_type, CASE WHEN t = 'create' THEN ts END AS date_created FROM e", C, _EVENTS)
def transform(spark: SparkSession, d: str) -> DataFrame:
    return E.to_articles(E.article_events(changes(spark, d))).select("version", "key", "event_type", "date_created")


@query("st_route", """SELECT topic, count(*) AS n FROM (SELECT 'local.structured-data.article-' || t || '.v1' AS topic FROM e UNION ALL
  SELECT 'local.structured-data.' || db || '-' || CASE s WHEN 0 THEN 'articles' WHEN 6 THEN 'files' WHEN 10 THEN 'templates' ELSE 'categories' END || '-compacted.v1' FROM e WHERE t <> 'visibility-change') GROUP BY topic""", C, _EVENTS)  # fmt: skip
def route(spark: SparkSession, d: str) -> DataFrame:
    return E.routed(E.to_articles(E.article_events(changes(spark, d)))).groupBy("topic").agg(F.count("*").alias("n"))


@query("st_passthrough_delete", "SELECT version, topics FROM (SELECT rev_id AS version, n, count(*) * 2 AS topics FROM e WHERE t = 'delete' GROUP BY ALL)", C, _EVENTS)
def pass_delete(spark: SparkSession, d: str) -> DataFrame:
    gone = E.to_articles(E.article_events(changes(spark, d))).filter("event_type = 'delete'")
    return E.routed(gone).groupBy("version", "name").agg(F.count("*").alias("topics")).select("version", "topics")


@query("st_passthrough_visibility", "SELECT rev_id AS version, rev_id % 2 = 0 AS text, rev_id % 3 = 0 AS editor, 'local.structured-data.article-visibility-change.v1' AS topic FROM e WHERE t = 'visibility-change'", C, _EVENTS)
def pass_visibility(spark: SparkSession, d: str) -> DataFrame:
    own = E.routed(E.to_articles(E.article_events(changes(spark, d))).filter("event_type = 'visibility-change'"))
    return own.select("version", F.col("visibility.text").alias("text"), F.col("visibility.editor").alias("editor"), "topic")


@query("st_retry_dlq", "SELECT identifier, fail_count + 1 AS fail_count, CASE WHEN fail_count + 1 > 10 THEN 'dead-letter' ELSE 'error' END AS topic FROM articles", A)
def retry(spark: SparkSession, d: str) -> DataFrame:
    return E.retried(articles(spark, d).select("identifier", F.col("event.fail_count").alias("fail_count"))).select("identifier", "fail_count", "topic")


@query("st_hourly_batch", "SELECT date_trunc('hour', ts) AS hour, event_type, count(*) AS n FROM log GROUP BY ALL", L)
def hourly(spark: SparkSession, d: str) -> DataFrame:
    return N.hourly(log(spark, d), "timestamp", ["event_type"])


@query("st_enrich_diff", """, d AS (SELECT pairs.doc_id, CAST(coalesce(sum(c - p) FILTER (c > p), 0) AS BIGINT) AS increase, CAST(coalesce(sum(c - p) FILTER (c < p), 0) AS BIGINT) AS decrease, CAST(coalesce(sum(c - p), 0) AS BIGINT) AS sum
  FROM pairs LEFT JOIN cnt ON pairs.doc_id = cnt.doc_id GROUP BY pairs.doc_id) SELECT rev_id, increase, decrease, sum FROM changes LEFT JOIN d ON doc_id = page_id WHERE kind = 'edit'""", C, PAIRS_SQL, _DELTA)  # fmt: skip
def enrich(spark: SparkSession, d: str) -> DataFrame:
    """Edits joined with their page's text and counts of its words against the page before it."""
    words = lambda c: F.regexp_extract_all(c, F.lit("[a-zA-Z]+"), F.lit(0))
    edits = changes(spark, d).filter("page_change_kind = 'edit'").select(F.col("revision.rev_id").alias("rev_id"), F.col("page.page_id").alias("doc_id"))
    pairs = diff_pairs(spark, d).select("doc_id", words("previous").alias("p"), words("current").alias("c"))
    diff = G.deltas(pairs, ["doc_id"], "p", "c")
    return edits.join(diff, "doc_id", "left").select("rev_id", "increase", "decrease", "sum")


# Sinks


@query("snk_upsert_delete", """SELECT key, event_type FROM (SELECT key, CASE event_type WHEN 'signup' THEN 'create' WHEN 'view' THEN 'update' WHEN 'error' THEN 'delete' END AS event_type, row_number() OVER (PARTITION BY key ORDER BY ts DESC, value DESC) AS r
  FROM log WHERE event_type IN ('signup', 'view', 'error')) WHERE r = 1 AND event_type <> 'delete'""", L)  # fmt: skip
def upsert(spark: SparkSession, d: str) -> DataFrame:
    kind = F.when(F.col("event_type") == "signup", "create").when(F.col("event_type") == "view", "update").when(F.col("event_type") == "error", "delete").otherwise("other")
    return N.current(log(spark, d).withColumn("event_type", kind), ["key"], ["timestamp", "value"]).select("key", "event_type")


@query("snk_hash_path", "SELECT identifier, md5(name)[1:1] || '/' || md5(name)[1:2] || '/' || name AS path FROM articles", A)
def paths(spark: SparkSession, d: str) -> DataFrame:
    return articles(spark, d).select("identifier", hash_path(F.col("name")).alias("path"))


@query("snk_snapshot", "SELECT project, ns, count(*) AS total, CAST(sum(chars) AS BIGINT) AS chars FROM articles WHERE event_type <> 'delete' GROUP BY project, ns", A)
def snapshot(spark: SparkSession, d: str) -> DataFrame:
    kept = N.excluded(articles(spark, d), ["delete"], F.col("event.type"))
    lines = kept.select(F.col("is_part_of.identifier").alias("project"), F.col("namespace.identifier").alias("ns"), F.to_json(F.struct("name", "identifier")).alias("line"), F.col("version.number_of_characters").alias("c")).filter("line <> '{}'")
    return lines.groupBy("project", "ns").agg(F.count("*").alias("total"), F.sum("c").alias("chars"))


@query("snk_chunk", "SELECT doc_id, CAST(floor(coalesce(sum(n) OVER (PARTITION BY lang ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / 100000) AS BIGINT) AS chunk FROM (SELECT lang, doc_id, octet_length(encode(text)) + 1 AS n FROM documents)")
def chunk(spark: SparkSession, d: str) -> DataFrame:
    return N.chunk_of(table(spark, d, "documents"), ["lang"], ["doc_id"], F.octet_length("text") + 1, 100_000).select("doc_id", "chunk")


@query("snk_chunk_greedy", """WITH RECURSIVE own AS (SELECT lang, doc_id, octet_length(encode(text)) AS size, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS r FROM documents),
fold AS (SELECT lang, doc_id, r, size + 1 AS held, 0 AS chunk FROM own WHERE r = 1
  UNION ALL SELECT o.lang, o.doc_id, o.r, CASE WHEN f.held + o.size > 100000 THEN o.size + 1 ELSE f.held + o.size + 1 END, CASE WHEN f.held + o.size > 100000 THEN f.chunk + 1 ELSE f.chunk END
  FROM fold f JOIN own o ON o.lang = f.lang AND o.r = f.r + 1)
SELECT lang, doc_id, CAST(chunk AS BIGINT) AS chunk FROM fold""")
def chunk_greedy(spark: SparkSession, d: str) -> DataFrame:
    own = table(spark, d, "documents").select("lang", "doc_id", F.octet_length("text").alias("size"))
    return N.greedy_chunks(own, "lang", "doc_id", "size", 100_000)


@query("snk_batch_path", "SELECT event_id, 'batches/' || strftime(ts, '%Y-%m-%d') || '/id' AS path FROM events")
def batch_path(spark: SparkSession, d: str) -> DataFrame:
    from folioflow.functions.text import batch_path as path

    return table(spark, d, "events").select("event_id", path(F.col("ts"), F.lit("id"), hourly=False).alias("path"))


@query("snk_metadata_agg", "SELECT lang, count(*) AS total, round(sum(octet_length(encode(text)) + 1) / 1e6, 3) AS size_mb FROM documents GROUP BY lang HAVING sum(octet_length(encode(text))) > 0")
def metadata(spark: SparkSession, d: str) -> DataFrame:
    return N.metadata(table(spark, d, "documents"), ["lang"], "text").filter("size_mb > 0")


@query("snk_copy", "SELECT s || x || y AS source, s || x || '_group' || y AS target FROM (SELECT DISTINCT project || '_namespace_' || ns AS s FROM articles), (VALUES ('', '.json'), ('_chunk_0', '.tar.gz'), ('_chunk_1', '.tar.gz')) v(x, y)", A)
def copy(spark: SparkSession, d: str) -> DataFrame:
    from folioflow.functions.text import chunk_id, snapshot_id

    ids = articles(spark, d).select(snapshot_id(F.col("is_part_of.identifier"), F.col("namespace.identifier")).alias("identifier")).distinct()
    return N.copies(ids.withColumn("chunks", F.array(chunk_id(F.col("identifier"), F.lit(0)), chunk_id(F.col("identifier"), F.lit(1)))), "group")


@query("snk_aggregate_copy", "SELECT 'aggregations/' || p || '_namespace_' || n || '.ndjson' AS source, 'aggregations/' || p || '_namespace_' || n || '_group.ndjson' AS target FROM (SELECT DISTINCT project AS p FROM articles), (VALUES (0), (6), (10), (14)) v(n)", A)
def aggregate_copy(spark: SparkSession, d: str) -> DataFrame:
    projects = articles(spark, d).select(F.col("is_part_of.identifier").alias("project")).distinct()
    return N.aggregation_copies(projects, [0, 6, 10, 14], "group")


@query("snk_commons", "SELECT doc_id, 'pages_' || lang || '_' || ((row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1) // 50) || '.ndjson' AS file FROM documents")
def commons(spark: SparkSession, d: str) -> DataFrame:
    return N.listing(table(spark, d, "documents").select("lang", "doc_id"), ["lang"], ["doc_id"], 50, "pages").select("doc_id", "file")


@query("snk_sse_ndjson", """SELECT identifier, 'event: message' || chr(10) || 'data: {"name":"' || name || '"}' || chr(10) || chr(10) AS frame FROM articles""", A)
def sse(spark: SparkSession, d: str) -> DataFrame:
    from folioflow.sources.sinks import sse_frame

    return articles(spark, d).select("identifier", sse_frame(F.struct("name")).alias("frame"))


@query("snk_json_array", "SELECT lang, doc_id // 500 AS page, '[' || string_agg('{\"d\":' || doc_id || '}', ',' ORDER BY doc_id) || ']' AS json FROM documents GROUP BY lang, doc_id // 500")
def json_array(spark: SparkSession, d: str) -> DataFrame:
    from folioflow.sources.sinks import json_array as joined

    # A list is one response: a language's documents in pages of 500 ids, so no list grows with the table.
    return joined(table(spark, d, "documents").select("lang", F.floor(F.col("doc_id") / 500).alias("page"), F.col("doc_id").alias("d")), ["lang", "page"], ["d"])


@query("snk_produce", """SELECT '{"identifier":"/' || project || '/' || name || '","type":"article"}' AS key, '{"name":"' || name || '","identifier":' || identifier || '}' AS value, 'articles' AS topic FROM articles""", A)
def produce(spark: SparkSession, d: str) -> DataFrame:
    from folioflow.sources.sinks import envelope

    key = F.struct(F.concat(F.lit("/"), F.col("is_part_of.identifier"), F.lit("/"), F.col("name")).alias("identifier"), F.lit("article").alias("type"))
    made = envelope(articles(spark, d).select(key.alias("key"), "name", "identifier"), "articles")
    return made.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"), "topic")
