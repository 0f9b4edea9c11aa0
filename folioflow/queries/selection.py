"""Projection and filter queries over the articles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.dataset import ARTICLES_SQL, GROUPS_SQL, LOG_SQL, articles, editor_groups, log, table
from folioflow.operators.joins import supported
from folioflow.operators.state import equal_fold_any, prefix_any, substring_any
from folioflow.plans import select as S
from folioflow.queries.registry import query

A = ARTICLES_SQL


@query("flagship_projection", "SELECT name, version_id AS version__identifier, size_value AS version__size__value FROM articles WHERE project = 'enwiki' AND ns = 0", A)
def flagship(spark: SparkSession, d: str) -> DataFrame:
    kept = S.query(articles(spark, d), ["name", "version.identifier", "version.size.*"], {"is_part_of.identifier": "enwiki", "namespace.identifier": 0})
    return S.flatten(kept, ["name", "version.identifier", "version.size.value"])


@query("proj_prune", "SELECT name, version_id AS v, editor_name AS e, project AS p FROM articles", A)
def proj_prune(spark: SparkSession, d: str) -> DataFrame:
    kept = S.prune(articles(spark, d), ["name", "version.identifier", "version.editor.name", "is_part_of.identifier"])
    return kept.select("name", F.col("version.identifier").alias("v"), F.col("version.editor.name").alias("e"), F.col("is_part_of.identifier").alias("p"))


@query(
    "proj_prune_array",
    "SELECT identifier, array_to_string([rel_url for x in range(n_categories)], ' ') AS urls, CAST(n_templates AS INTEGER) AS n FROM articles", A,
)
def proj_prune_array(spark: SparkSession, d: str) -> DataFrame:
    kept = S.prune(articles(spark, d), ["identifier", "categories.url", "templates.*"])
    return kept.select("identifier", F.array_join("categories.url", " ").alias("urls"), F.size("templates").alias("n"))


@query("proj_sql", "SELECT name, ns, project, size_value FROM articles", A)
def proj_sql(spark: SparkSession, d: str) -> DataFrame:
    articles(spark, d).createOrReplaceTempView("articles_v")
    made = spark.sql("SELECT name, named_struct('identifier', `namespace`.identifier) AS namespace, named_struct('identifier', is_part_of.identifier) AS is_part_of, version.size.value AS size_value FROM articles_v")
    return made.select("name", F.col("namespace.identifier").alias("ns"), F.col("is_part_of.identifier").alias("project"), "size_value")


@query("proj_sql_omit", "SELECT identifier, lang, project FROM articles", A)
def proj_sql_omit(spark: SparkSession, d: str) -> DataFrame:
    kept = S.prune(articles(spark, d), ["identifier", "in_language.*", "is_part_of.*"], omit=["event", "url"])
    return kept.select("identifier", F.col("in_language.identifier").alias("lang"), F.col("is_part_of.identifier").alias("project"))


@query("proj_flatten_alias", "SELECT identifier, project AS is_part_of__identifier, project_url AS is_part_of__url, chars AS version__number_of_characters FROM articles", A)
def proj_flatten(spark: SparkSession, d: str) -> DataFrame:
    return S.flatten(articles(spark, d), ["identifier", "is_part_of.identifier", "is_part_of.url", "version.number_of_characters"])


@query(
    "proj_json_rebuild",
    """SELECT identifier, '{"name":"' || name || '","version":{"identifier":' || version_id || CASE WHEN editor_id IS NULL THEN '}' ELSE ',"editor":{"name":"' || editor_name || '"}}' END || '}' AS json FROM articles""", A,
)
def proj_json(spark: SparkSession, d: str) -> DataFrame:
    a = articles(spark, d)
    return a.select("identifier", S.rebuild(a, ["name", "version.identifier", "version.editor.name"]).alias("json"))


@query("proj_internal_strip", "SELECT identifier, name FROM articles WHERE NOT coalesce(internal, false)", A)
def proj_internal(spark: SparkSession, d: str) -> DataFrame:
    kept = articles(spark, d).filter(~F.coalesce(F.col("event.is_internal_message"), F.lit(False)))
    return kept.drop("event").select("identifier", "name")


@query("proj_position", "SELECT value AS id, partition AS event_partition, off AS event_offset, ts AS event_published FROM log", LOG_SQL)
def proj_position(spark: SparkSession, d: str) -> DataFrame:
    m = log(spark, d).withColumn("event", F.struct(F.col("event_type").alias("type")))
    at = F.col("event").withField("partition", F.col("partition")).withField("offset", F.col("offset")).withField("date_published", F.col("timestamp"))
    return m.withColumn("event", at).select(F.col("value").alias("id"), F.col("event.partition").alias("event_partition"), F.col("event.offset").alias("event_offset"), F.col("event.date_published").alias("event_published"))


@query("decode_row", "SELECT identifier, lower(name) AS name, date_modified AS at FROM articles", A)
def decode_row(spark: SparkSession, d: str) -> DataFrame:
    raw = articles(spark, d).select(F.col("identifier").cast("string").alias("IDENTIFIER"), F.lower("name").alias("NAME"), F.unix_micros("date_modified").cast("string").alias("MICROS"))
    return raw.select(F.col("identifier").cast("long").alias("identifier"), F.col("name").alias("name"), F.timestamp_micros(F.col("micros").cast("long")).alias("at"))


@query("decode_join_prefix", "SELECT identifier, version_id, chars FROM articles", A)
def decode_join(spark: SparkSession, d: str) -> DataFrame:
    wide = articles(spark, d).select("identifier", F.col("version.identifier").alias("versions_id"), F.col("version.number_of_characters").alias("versions_chars"))
    names = [c for c in wide.columns if c.startswith("versions_")]
    nested = wide.select("identifier", F.struct(*[F.col(c).alias(c.removeprefix("versions_")) for c in names]).alias("versions"))
    return nested.select("identifier", F.col("versions.id").alias("version_id"), F.col("versions.chars").alias("chars"))


@query("recode_json", "SELECT identifier, CAST(n_categories AS INTEGER) AS n, true AS same FROM articles", A)
def recode_json(spark: SparkSession, d: str) -> DataFrame:
    """Categories as JSON text and back: what comes back is what went in."""
    a = articles(spark, d).select("identifier", "categories", F.to_json("categories").alias("has_parts"))
    back = F.from_json("has_parts", a.schema["categories"].dataType)
    return a.select("identifier", F.size(back).alias("n"), (back == F.col("categories")).alias("same"))


@query("flt_eq_nested", "SELECT identifier FROM articles WHERE project = 'enwiki' AND ns = 6 AND editor_name = 'User13'", A)
def flt_eq(spark: SparkSession, d: str) -> DataFrame:
    return S.query(articles(spark, d), ["identifier"], {"is_part_of.identifier": "enwiki", "namespace.identifier": 6, "version.editor.name": "User13"})


@query("flt_null_struct", "SELECT identifier, editor_name FROM articles WHERE editor_id = 7", A)
def flt_null(spark: SparkSession, d: str) -> DataFrame:
    kept = S.where(articles(spark, d), {"version.editor.identifier": 7})
    return kept.select("identifier", F.col("version.editor.name").alias("editor_name"))


@query("flt_forall_array", "SELECT identifier FROM articles WHERE n_categories = 0 OR rel_url = 'https://host/1'", A)
def flt_forall(spark: SparkSession, d: str) -> DataFrame:
    return S.where(articles(spark, d), {"categories.url": "https://host/1"}).select("identifier")


@query("flt_duplicate_field", "SELECT identifier FROM articles WHERE lang = 'fr'", A)
def flt_duplicate(spark: SparkSession, d: str) -> DataFrame:
    pairs = [("in_language.identifier", "en"), ("in_language.identifier", "fr")]
    return S.where(articles(spark, d), dict(pairs)).select("identifier")


@query("flt_sql_where", "SELECT identifier FROM articles WHERE lang = 'es' AND version_id = 420", A)
def flt_sql(spark: SparkSession, d: str) -> DataFrame:
    return articles(spark, d).filter((F.col("in_language.identifier") == "es") & (F.col("version.identifier") == 420)).select("identifier")


@query("flt_partition_case", "SELECT value FROM log WHERE partition IN (1, 2, 3) AND CASE WHEN partition = 1 THEN off >= 5 WHEN partition = 2 THEN ts >= TIMESTAMP '2024-01-05' ELSE true END", LOG_SQL)
def flt_case(spark: SparkSession, d: str) -> DataFrame:
    keep = S.partition_case({1: ("offset", 5), 2: ("time", F.to_timestamp(F.lit("2024-01-05 00:00:00")))}, [1, 2, 3])
    return log(spark, d).filter(keep).select("value")


@query("flt_since", "SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-10'")
def flt_since(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").filter(F.col("ts") >= F.to_timestamp(F.lit("2024-01-10 00:00:00"))).select("event_id")


@query("flt_internal", "SELECT identifier, internal FROM articles WHERE NOT coalesce(internal, false)", A)
def flt_internal(spark: SparkSession, d: str) -> DataFrame:
    internal = F.col("event.is_internal_message")
    return articles(spark, d).filter(~F.coalesce(internal, F.lit(False))).select("identifier", internal.alias("internal"))


@query("flt_s3_select", "SELECT identifier FROM articles WHERE ns = 10 AND size_value > 850.5 AND lang = 'en'", A)
def flt_s3(spark: SparkSession, d: str) -> DataFrame:
    return S.list_filter(articles(spark, d), {"namespace.identifier": 10.0, "version.size.value": 850.5, "in_language.identifier": "en", "version.noindex": True}).select("identifier")


@query("flt_json_ne", "SELECT identifier FROM articles WHERE editor_name IS NOT DISTINCT FROM 'User12'", A)
def flt_json(spark: SparkSession, d: str) -> DataFrame:
    doc = articles(spark, d).select("identifier", F.to_json("version").alias("j"))
    return doc.filter(F.get_json_object("j", "$.editor.name").eqNullSafe(F.lit("User12"))).select("identifier")


@query("flt_project_lang", "SELECT identifier, project FROM articles WHERE lang IN ('fr', 'de') AND project <> 'frwiki'", A)
def flt_project_lang(spark: SparkSession, d: str) -> DataFrame:
    dims = spark.createDataFrame([("enwiki", "en"), ("frwiki", "fr"), ("dewiki", "de"), ("eswiki", "es")], "project string, language string")
    chosen = dims.filter(F.col("language").isin("fr", "de") & (F.col("project") != "frwiki"))
    flat = articles(spark, d).select("identifier", F.col("is_part_of.identifier").alias("project"))
    return flat.join(F.broadcast(chosen.select("project")), "project", "left_semi").select("identifier", "project")


@query("flt_supported", "SELECT identifier FROM articles WHERE (project IN ('enwiki', 'frwiki') AND ns IN (0, 14)) OR (project = 'dewiki' AND ns = 6)", A)
def flt_supported(spark: SparkSession, d: str) -> DataFrame:
    rows = [(p, n) for p in ("enwiki", "frwiki") for n in (0, 14)] + [("dewiki", 6)]
    flat = articles(spark, d).select("identifier", F.col("is_part_of.identifier").alias("p"), F.col("namespace.identifier").alias("n"))
    return supported(flat, spark.createDataFrame(rows, "project string, namespace int"), "p", "n").select("identifier")


@query("flt_abstract_valid", "SELECT identifier FROM articles WHERE ns = 0 AND identifier % 3 <> 2", A)
def flt_abstract(spark: SparkSession, d: str) -> DataFrame:
    model = F.when(F.col("identifier") % 3 != 2, "wikitext").otherwise("json")
    return articles(spark, d).filter((F.col("namespace.identifier") == 0) & (model == "wikitext")).select("identifier")


@query("flt_substring_any", "SELECT identifier FROM articles WHERE n_categories >= 2", A)
def flt_substring(spark: SparkSession, d: str) -> DataFrame:
    return articles(spark, d).filter(substring_any(F.col("categories.name"), ["GORY:2"])).select("identifier")


@query("flt_equalfold_any", "SELECT identifier FROM articles WHERE n_templates >= 1", A)
def flt_equalfold(spark: SparkSession, d: str) -> DataFrame:
    return articles(spark, d).filter(equal_fold_any(F.col("templates.name"), ["template:1", "TEMPLATE:9"], ["Template:3"])).select("identifier")


@query("flt_prefix_any", "SELECT identifier FROM articles WHERE n_templates = 2", A)
def flt_prefix(spark: SparkSession, d: str) -> DataFrame:
    return articles(spark, d).filter(prefix_any(F.col("templates.name"), ["Template:"], ["Template:1"])).select("identifier")


@query("flt_protected_page", "SELECT identifier, CASE WHEN identifier % 10 = 0 THEN NULL ELSE editor_name END AS editor FROM articles", A)
def flt_protected(spark: SparkSession, d: str) -> DataFrame:
    a = articles(spark, d)
    listed = a.filter(F.col("identifier") % 10 == 0).select("name", F.lit(True).alias("protected"))
    out = a.select("identifier", "name", F.col("version.editor.name").alias("editor")).join(listed, "name", "left")
    return out.select("identifier", F.when(F.col("protected").isNull(), F.col("editor")).alias("editor"))


@query("flt_score_eligible", "SELECT identifier FROM articles WHERE ns = 0 AND date_created IS NOT NULL", A)
def flt_score(spark: SparkSession, d: str) -> DataFrame:
    return articles(spark, d).filter((F.col("namespace.identifier") == 0) & F.col("is_part_of.identifier").endswith("wiki") & F.col("date_created").isNotNull()).select("identifier")


@query("flt_exclude_events", "SELECT identifier, event_type FROM articles WHERE event_type NOT IN ('delete')", A)
def flt_exclude(spark: SparkSession, d: str) -> DataFrame:
    from folioflow.operators.snapshot import excluded

    return excluded(articles(spark, d), ["delete"], F.col("event.type")).select("identifier", F.col("event.type").alias("event_type"))


_FLAGS = ("list_contains(groups, 'bot') AS is_bot, list_contains(groups, 'sysop') AS is_admin, "
          "list_contains(groups, 'patroller') AS is_patroller, list_contains(groups, 'steward') AS has_advanced_rights")  # fmt: skip


@query("fn_editor_flags", f"SELECT user_id, {_FLAGS} FROM editors", GROUPS_SQL)
def fn_editor_flags(spark: SparkSession, d: str) -> DataFrame:
    from folioflow.functions.records import editor_flags

    return editor_groups(spark, d).select("user_id", editor_flags(F.col("groups")).alias("f")).select("user_id", "f.*")
