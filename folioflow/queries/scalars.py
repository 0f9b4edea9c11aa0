"""Scalar queries: text, paths, dates, records, HTML."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.dataset import ARTICLES_SQL, PAIRS_SQL, articles, diff_pairs, events, table
from folioflow.functions import records as R
from folioflow.functions import text as X
from folioflow.functions.html import html_parts
from folioflow.functions.wikitext import scan_pattern, tokens
from folioflow.queries.registry import query

A = ARTICLES_SQL


@query("fn_title", "SELECT identifier, 'Doc ' || identifier || CASE WHEN identifier % 2 = 0 THEN ' é' ELSE ' %zz' END AS title FROM articles", A)
def fn_title(spark: SparkSession, d: str) -> DataFrame:
    link = F.concat(F.lit("./"), "name", F.when(F.col("identifier") % 2 == 0, "_%C3%A9").otherwise("_%zz"))
    return articles(spark, d).select("identifier", X.title(link).alias("title"))


@query("fn_full_url", "SELECT identifier, CASE WHEN identifier % 2 = 0 THEN 'https://x/' || name || '_%C3%A9' ELSE '' END AS url FROM articles", A)
def fn_full_url(spark: SparkSession, d: str) -> DataFrame:
    link = F.concat(F.lit("./"), "name", F.when(F.col("identifier") % 2 == 0, "_%C3%A9").otherwise("_%zz"))
    return articles(spark, d).select("identifier", X.full_url(link, F.lit("https://x/")).alias("url"))


@query("fn_key", "SELECT identifier, '/' || project || '/' || name AS key, '/' || project || '/' || version_id AS version_identifier, replace(replace(name, '_', ' '), ' ', '_') AS underscored FROM articles", A)
def fn_key(spark: SparkSession, d: str) -> DataFrame:
    p = F.col("is_part_of.identifier")
    return articles(spark, d).select("identifier", X.key(p, F.col("name")).alias("key"), X.version_identifier(p, F.col("version.identifier")).alias("version_identifier"), X.underscored(F.replace("name", F.lit("_"), F.lit(" "))).alias("underscored"))


@query(
    "fn_topic_name",
    "SELECT identifier, 'local.structured-data.' || project || '-' || CASE ns WHEN 0 THEN 'articles' WHEN 6 THEN 'files' WHEN 10 THEN 'templates' ELSE 'categories' END || '-compacted.v1' AS compacted, "
    "'local.structured-data.article-' || event_type || '.v1' AS by_event FROM articles", A,
)
def fn_topic(spark: SparkSession, d: str) -> DataFrame:
    p = F.col("is_part_of.identifier")
    return articles(spark, d).select("identifier", X.compacted_topic(p, F.col("namespace.identifier")).alias("compacted"), X.event_topic(p, F.col("event.type")).alias("by_event"))


@query("fn_tokenize", f"""SELECT identifier, CAST(len(w) AS INTEGER) AS n, md5(array_to_string(w, ' ')) AS digest FROM (SELECT identifier,
  list_filter(regexp_extract_all(replace(wikitext, '\\n', ' '), '{scan_pattern(java=False).replace("'", "''")}', 1), lambda x: x <> '') AS w FROM articles)""", A)  # fmt: skip
def fn_tokenize(spark: SparkSession, d: str) -> DataFrame:
    words = articles(spark, d).select("identifier", tokens(F.col("article_body.wikitext")).alias("w"))
    return words.select("identifier", F.size("w").alias("n"), F.md5(F.array_join("w", " ").cast("binary")).alias("digest"))


_RUNS = """
chars AS (SELECT doc_id, which, i, lower(t)[i] AS c FROM (SELECT doc_id, which, t, unnest(range(1, length(lower(t)) + 1)) AS i FROM
  (SELECT doc_id, 0 AS which, previous AS t FROM pairs UNION ALL SELECT doc_id, 1, current FROM pairs))),
grp AS (SELECT doc_id, which, c, i - row_number() OVER (PARTITION BY doc_id, which, c ORDER BY i) AS g FROM chars),
runs AS (SELECT doc_id, which, count(*) AS n FROM grp GROUP BY doc_id, which, c, g),
best AS (SELECT doc_id, CAST(coalesce(max(n) FILTER (which = 1 AND n > 1), 0) AS INTEGER) AS cur, CAST(coalesce(max(n) FILTER (which = 0 AND n > 1), 0) AS INTEGER) AS prev FROM runs GROUP BY doc_id)"""


@query("fn_longest_repeat", "SELECT p.doc_id, coalesce(cur, 0) AS longest, CASE WHEN coalesce(cur, 0) > coalesce(prev, 0) THEN cur ELSE 1 END AS longest_new FROM pairs p LEFT JOIN best USING (doc_id)", PAIRS_SQL, _RUNS)
def fn_longest(spark: SparkSession, d: str) -> DataFrame:
    pairs = diff_pairs(spark, d).withColumns({"c": X.longest_repeat(F.col("current")), "p": X.longest_repeat(F.col("previous"))})
    return pairs.select("doc_id", F.col("c").alias("longest"), F.when(F.col("c") > F.col("p"), F.col("c")).otherwise(1).alias("longest_new"))


@query("fn_diff_size", "SELECT doc_id, CAST(octet_length(encode(current)) - octet_length(encode(previous)) AS BIGINT) AS value, 'B' AS unit_text FROM pairs", PAIRS_SQL)
def fn_diff(spark: SparkSession, d: str) -> DataFrame:
    return diff_pairs(spark, d).select("doc_id", X.diff_size(F.col("current"), F.col("previous")).alias("value"), F.lit("B").alias("unit_text"))


@query("fn_size", "SELECT doc_id, CAST(octet_length(encode(text)) AS BIGINT) AS bytes, CAST(length(text) AS BIGINT) AS chars, round(octet_length(encode(text)) / 1e6, 3) AS mb FROM documents")
def fn_size(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.octet_length("text").cast("long").alias("bytes"), F.char_length("text").cast("long").alias("chars"), X.size_mb(F.octet_length("text")).alias("mb"))


def _count(name: str, field: str) -> str:
    return rf"CAST(len(regexp_extract_all(wikitext, '(?i)\{{\{{{name}(\|*).*?\}}\}}')) AS BIGINT) AS {field}"


@query("fn_maintenance", f"SELECT identifier, {', '.join(_count(n, f) for f, n in X.MAINTENANCE.items())} FROM articles", A)
def fn_maintenance(spark: SparkSession, d: str) -> DataFrame:
    return articles(spark, d).select("identifier", X.maintenance_tags(F.col("article_body.wikitext")).alias("m")).select("identifier", "m.*")


_INFORMAL, _UNSAFE = ("the", "of", "and"), ("idiot", "moron", "scum")


@query(
    "fn_word_classes",
    f"""SELECT doc_id, CAST(len(list_filter(w, lambda x: lower(x) IN {_INFORMAL})) AS BIGINT) AS informal, CAST(len(list_filter(w, lambda x: lower(x) IN {_UNSAFE})) AS BIGINT) AS non_safe,
    CAST(len(list_filter(w, lambda x: regexp_matches(x, '^[A-Z][A-Z]+$'))) AS BIGINT) AS uppercase, CAST(len(list_filter(w, lambda x: lower(x) NOT IN {_INFORMAL})) AS BIGINT) AS non_dictionary
    FROM (SELECT doc_id, regexp_extract_all(text, '[A-Za-z]+') AS w FROM documents)""",
)
def fn_word_classes(spark: SparkSession, d: str) -> DataFrame:
    words = table(spark, d, "documents").select("doc_id", F.regexp_extract_all("text", F.lit("[A-Za-z]+"), F.lit(0)).alias("w"))
    count = lambda test: F.size(F.filter("w", test)).cast("long")
    return words.select(
        "doc_id", count(lambda x: F.lower(x).isin(*_INFORMAL)).alias("informal"), count(lambda x: F.lower(x).isin(*_UNSAFE)).alias("non_safe"),
        F.size(X.uppercase_words(F.col("w"))).cast("long").alias("uppercase"), count(lambda x: ~F.lower(x).isin(*_INFORMAL)).alias("non_dictionary"),
    )


@query("fn_bounded_string", "SELECT identifier, CASE WHEN chars > 2000 THEN '>2000' WHEN identifier % 2 = 1 THEN '>' || chars ELSE chars || '' END AS shown FROM articles", A)
def fn_bounded(spark: SparkSession, d: str) -> DataFrame:
    return articles(spark, d).select("identifier", X.bounded(F.col("version.number_of_characters"), 2000, F.col("identifier") % 2 == 0).alias("shown"))


@query("fn_backoff", "SELECT identifier, CAST(pow(2, fail_count + 1) AS DOUBLE) AS seconds FROM articles", A)
def fn_backoff(spark: SparkSession, d: str) -> DataFrame:
    return articles(spark, d).select("identifier", X.backoff(F.col("event.fail_count") + 1).alias("seconds"))


@query("fn_md5", "SELECT doc_id, md5(text) AS version FROM documents")
def fn_md5(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.md5(F.col("text").cast("binary")).alias("version"))


@query("fn_s3_paths", """SELECT identifier, 'snapshots/' || s || '.json' AS meta, 'snapshots/' || s || '_group.tar.gz' AS archive, 'chunks/' || s || '/chunk_' || (identifier % 5) || '.tar.gz' AS chunk,
  'aggregations/snapshots/snapshots.ndjson' AS listing FROM (SELECT identifier, project || '_namespace_' || ns AS s FROM articles)""", A)  # fmt: skip
def fn_paths(spark: SparkSession, d: str) -> DataFrame:
    s = X.snapshot_id(F.col("is_part_of.identifier"), F.col("namespace.identifier"))
    own = articles(spark, d).select("identifier", s.alias("s"), X.chunk_id(s, F.col("identifier") % 5).alias("c"))
    return own.select("identifier", X.entity_path("snapshots", F.col("s"), "metadata").alias("meta"), X.entity_path("snapshots", F.col("s"), group="group").alias("archive"), X.entity_path("snapshots", F.col("c"), "chunk").alias("chunk"), X.entity_path("snapshots", F.col("s"), "aggregation").alias("listing"))


@query("fn_snapshot_id", "SELECT DISTINCT project || '_namespace_' || ns AS id, project || '_namespace_' || ns || '_chunk_0' AS chunk FROM articles", A)
def fn_snapshot(spark: SparkSession, d: str) -> DataFrame:
    s = X.snapshot_id(F.col("is_part_of.identifier"), F.col("namespace.identifier"))
    return articles(spark, d).select(s.alias("id"), X.chunk_id(s, F.lit(0)).alias("chunk")).distinct()


@query("fn_redirect_revision", "SELECT identifier, identifier % 3 <> 1 AND version_id + identifier % 3 = version_id AS same FROM articles", A)
def fn_redirect_revision(spark: SparkSession, d: str) -> DataFrame:
    v = F.col("version.identifier")
    url = F.when(F.col("identifier") % 3 == 1, "https://x/other").otherwise(F.concat(F.lit("https://x/Special:Redirect/revision/"), (v + F.col("identifier") % 3).cast("string")))
    return articles(spark, d).select("identifier", F.coalesce(X.redirect_revision(url, v), F.lit(False)).alias("same"))


@query("fn_last_revised", "SELECT event_id, CASE WHEN event_id % 3 = 0 THEN '01/01' ELSE strftime(ts, '%m/%y') END AS revised FROM events")
def fn_revised(spark: SparkSession, d: str) -> DataFrame:
    text = F.when(F.col("event_id") % 3 == 0, "not a date").otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    return events(spark, d).select("event_id", X.last_revised(text).alias("revised"))


@query("fn_dates", """SELECT event_id, date_trunc('hour', ts) - INTERVAL 1 HOUR AS hour_start, strftime(date_trunc('month', ts) - INTERVAL 1 DAY, '%Y-%m') AS last_month,
  coalesce(ts BETWEEN TIMESTAMP '2024-01-02' AND TIMESTAMP '2024-01-02' + INTERVAL 24 HOUR, false) AS first_day, 'batches/' || strftime(ts, '%Y-%m-%d/%H') || '/x' AS path FROM events""")  # fmt: skip
def fn_dates(spark: SparkSession, d: str) -> DataFrame:
    ts = F.col("ts")
    return events(spark, d).select("event_id", X.last_hour_start(ts).alias("hour_start"), X.previous_month(ts).alias("last_month"), X.between_hours(ts, F.to_timestamp(F.lit("2024-01-02 00:00:00")), 24).alias("first_day"), X.batch_path(ts, F.lit("x")).alias("path"))


@query("fn_latency", "SELECT event_id, (epoch_us(ts) // 1000) % 1000 > 500 AS late FROM events")
def fn_latency(spark: SparkSession, d: str) -> DataFrame:
    return events(spark, d).select("event_id", X.is_late(F.date_trunc("second", "ts"), F.col("ts")).alias("late"))


@query("fn_epoch", "SELECT event_id, epoch_us(ts) AS micros, epoch_us(ts) // 1000 AS millis FROM events")
def fn_epoch(spark: SparkSession, d: str) -> DataFrame:
    return events(spark, d).select("event_id", F.unix_micros("ts").alias("micros"), F.unix_millis("ts").alias("millis"))


@query("fn_anonymous", "SELECT user_id, event_id, user_id = 0 AS anonymous FROM events")
def fn_anonymous(spark: SparkSession, d: str) -> DataFrame:
    return events(spark, d).select("user_id", "event_id", R.is_anonymous(F.col("user_id")).alias("anonymous"))


@query("fn_flagged_stable", "SELECT identifier, identifier % 4 = 0 AS stable FROM articles", A)
def fn_stable(spark: SparkSession, d: str) -> DataFrame:
    v = F.col("version.identifier")
    return articles(spark, d).select("identifier", R.flagged_stable(F.when(F.col("identifier") % 4 == 0, v), v).alias("stable"))


@query("fn_entity", "SELECT identifier, CASE WHEN identifier % 3 > 0 THEN 'https://entity/Q' || identifier END AS url, CASE WHEN identifier % 3 > 0 THEN 'Q' || identifier END AS id FROM articles", A)
def fn_entity(spark: SparkSession, d: str) -> DataFrame:
    q = F.when(F.col("identifier") % 3 > 0, F.concat(F.lit("Q"), F.col("identifier").cast("string"))).otherwise("")
    return articles(spark, d).select("identifier", R.entity(q, "https://entity/").alias("e")).select("identifier", F.col("e.url").alias("url"), F.col("e.identifier").alias("id"))


@query("fn_scores_build", "SELECT identifier, CASE WHEN identifier % 4 > 0 THEN (identifier % 100) / 100.0 > 0.5 END AS prediction, CASE WHEN identifier % 4 > 0 THEN round((identifier % 100) / 100.0, 2) END AS t, CASE WHEN identifier % 4 > 0 THEN round(1 - (identifier % 100) / 100.0, 2) END AS f FROM articles", A)
def fn_scores(spark: SparkSession, d: str) -> DataFrame:
    p = F.when(F.col("identifier") % 4 > 0, (F.col("identifier") % 100) / 100.0)
    own = articles(spark, d).select("identifier", R.probability(p > 0.5, p).alias("s"))
    return own.select("identifier", F.col("s.prediction").alias("prediction"), F.round("s.probability.true", 2).alias("t"), F.round("s.probability.false", 2).alias("f"))


@query("fn_image_build", "SELECT identifier, CASE WHEN identifier % 2 = 0 THEN 'https://img/' || identifier END AS url, CASE WHEN identifier % 2 = 0 THEN CAST(identifier % 300 AS INTEGER) END AS width FROM articles", A)
def fn_image(spark: SparkSession, d: str) -> DataFrame:
    url = F.when(F.col("identifier") % 2 == 0, F.concat(F.lit("https://img/"), F.col("identifier").cast("string")))
    size = (F.col("identifier") % 300).cast("int")
    return articles(spark, d).select("identifier", R.image(url, size, size).alias("i")).select("identifier", F.col("i.content_url").alias("url"), F.col("i.width").alias("width"))


@query("fn_article_build", """SELECT identifier, '{"name":"' || name || '",' || CASE WHEN identifier = 0 THEN '' ELSE '"identifier":' || identifier || ',' END || '"license":"CC-BY-SA-4.0"' || CASE WHEN noindex THEN ',"noindex":true' ELSE '' END || '}' AS json FROM articles""", A)
def fn_article(spark: SparkSession, d: str) -> DataFrame:
    own = articles(spark, d).select("identifier", "name", F.col("version.noindex").alias("noindex"), R.license_row(F.col("in_language.identifier"))[0]["identifier"].alias("license"))
    return own.select("identifier", F.to_json(R.without_zeros(name=F.col("name"), identifier=F.col("identifier"), license=F.col("license"), noindex=F.col("noindex"))).alias("json"))


@query("fn_json_paths", "SELECT event_id, regexp_extract(props, '\"k\": ([0-9]+)', 1) AS k FROM events")
def fn_json(spark: SparkSession, d: str) -> DataFrame:
    parts = F.concat(F.lit('{"parts":['), "props", F.lit("]}"))
    return events(spark, d).select("event_id", F.regexp_extract(F.get_json_object(parts, "$.parts[*].k"), "([0-9]+)", 1).alias("k"))


@query("fn_license_default", "SELECT lang, 'CC-BY-SA-4.0' AS identifier FROM (SELECT DISTINCT lang FROM documents)")
def fn_license(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("lang").distinct().select("lang", R.license_row(F.col("lang"))[0]["identifier"].alias("identifier"))


#: SQL of the plain text of markup without tags: entities of the driver's pages, notes in brackets, white space.
_PLAIN = "replace(replace(regexp_replace(regexp_replace({0}, '&quot;?', '\"', 'g'), '&amp;?', '&', 'g'), '&copy;', '©'), '&middot;', '·')"
_PLAIN = f"regexp_replace(regexp_replace({_PLAIN}, '\\[[^\\]]+\\]|•', '', 'g'), '\\s+', ' ', 'g')"
_PLAIN = f"trim(regexp_replace(regexp_replace({_PLAIN}, '\\s+([:;：；, ，、.!?])', '\\1', 'g'), '(\\()\\s+|\\s+(\\))', '\\1\\2', 'g'))"


@query(
    "html_links",
    f"""SELECT page_id, array_to_string([regexp_extract(a, 'href="([^"]*)"', 1) || '=' || {_PLAIN.format("regexp_extract(a, '>([^<]*)<', 1)")} for a in regexp_extract_all(html, '<a href="[^"]*">[^<]*</a>')], '|') AS links FROM pages""",
)
def html_links(spark: SparkSession, d: str) -> DataFrame:
    """Addresses and texts of all links of a page, in order."""
    made = table(spark, d, "pages").select("page_id", html_parts(F.col("html"), only=("links",)).alias("p"))
    return made.select("page_id", F.array_join(F.transform("p.links", lambda x: F.concat(x["url"], F.lit("="), x["text"])), "|").alias("links"))


@query(
    "html_parts",
    f"""SELECT page_id, '' AS abstract, {_PLAIN.format("regexp_replace(regexp_replace(regexp_replace(html, '<!--.*?-->|<head>.*?</head>', '', 'gs'), '</?(p|br|li|div|td|th|tr|dd|dt|h[a-z0-9]*)(\\s[^>]*)?>', ' ', 'g'), '<[^>]*>', '', 'g')")} AS text,
  len(regexp_extract_all(html, '<img ')) AS images, len(regexp_extract_all(html, '<section')) AS sections FROM pages""",
)
def html_all(spark: SparkSession, d: str) -> DataFrame:
    """Whole text and numbers of parts of the driver's pages."""
    made = table(spark, d, "pages").select("page_id", html_parts(F.col("html"), only=("abstract", "text", "images", "sections")).alias("p"))
    sections = F.coalesce(F.json_array_length("p.sections"), F.lit(0)).cast("long").alias("sections")
    return made.select("page_id", F.col("p.abstract").alias("abstract"), F.col("p.text").alias("text"), F.size("p.images").cast("long").alias("images"), sections)


#: A page with what the driver's pages lack, told apart by its document {n}; a pair is repeated for {i} = 1, 2, ...
#: (two to five times, by document), joined by its first part.
PAGE = (
    '<html><head><base href="//en.host/wiki/"></head><body><section data-mw-section-id="0"><p>Alpha (born {n}) is ',
    (" ", '<a href="./Beta{i}">beta {i}</a>'),
    ' number {n}.</p><table class="infobox"><caption>Box {n}</caption><tr><th>Born</th><td>{n} May</td></tr><tr><th>Works</th><td><ul>',
    ("", "<li>A{i}</li>"),
    "</ul></td></tr></table>",
    ("", '<span data-mw=\'{"parts":[{"template":{"target":{"wt":"T","href":"./Template:T{n}-{i}"}}}]}\'></span>'),
    '</section><section data-mw-section-id="1"><h2 id="Life">Life {n}</h2>',
    ("", "<p>Text {i} of {n}.</p>"),
    "<ul>",
    ("", "<li>One {i}<ul><li>Two {i}</li></ul></li>"),
    "</ul>",
    ("", '<div><figure><img src="//i/x{n}-{i}.png" width="20{i}" height="30{i}" alt="x{i}"><figcaption>Cap {i}</figcaption></figure></div>'),
    '</section><section><h2 id="References">References</h2><ol class="references">',
    ("", '<li id="r{i}">Note {i} <a href="https://a/{n}/{i}">a{i}</a></li>'),
    "</ol></section>",
    ("", '<link rel="mw:PageProp/Category" href="./Category:C{n}-{i}#x">'),
    "</body></html>",
)
_MADE = "made AS (SELECT doc_id, doc_id AS n, range(1, doc_id % 4 + 3) AS r FROM documents)"


def _filled(text: str, **values: Column) -> Column:
    return F.concat(*[values[x].cast("string") if k % 2 else F.lit(x) for k, x in enumerate(re.split(r"\{([ni])\}", text))])


def _pages(spark: SparkSession, d: str, *only: str) -> DataFrame:
    n = F.col("doc_id")
    each = lambda sep, text: F.array_join(F.transform(F.sequence(F.lit(1), (n % 4 + 2).cast("int")), lambda i: _filled(text, n=n, i=i)), sep)
    page = F.concat(*[_filled(x, n=n) if isinstance(x, str) else each(*x) for x in PAGE])
    return table(spark, d, "documents").select("doc_id", html_parts(page, only=only).alias("p"))


def _sql(text: str) -> str:
    """SQL of a text with {n} and {i}."""
    return "'" + re.sub(r"\{([ni])\}", r"' || \1 || '", text.replace("'", "''")) + "'"


def _list(sep: str, text: str) -> str:
    """SQL of a text repeated for each {i}."""
    return f"array_to_string([{_sql(text)} for i in r], '{sep}')"


def _wrapped(*parts: str | tuple[str, str]) -> str:
    """SQL of texts and repeated ones behind each other."""
    return " || ".join(_sql(x) if isinstance(x, str) else _list(*x) for x in parts)


_ABSTRACT = _wrapped("Alpha is ", (" ", "beta {i}"), " number {n}.")
_BOX = _wrapped('[{"type": "infobox", "name": "Box {n}", "has_parts": [{"type": "field", "name": "Born", "value": "{n} May"}, {"type": "list", "name": "Works", "value": "', (" ", "A{i}"), '", "values": [', (", ", '"A{i}"'), "]}]}]")
_SECTIONS = _wrapped(
    '[{"type": "section", "name": "Abstract", "has_parts": [{"type": "paragraph", "value": "Alpha (born {n}) is ', (" ", "beta {i}"), ' number {n}.", "links": [',
    (", ", '{"url": "https://en.host/wiki/Beta{i}", "text": "beta {i}"}'), ']}]}, {"type": "section", "name": "Life {n}", "has_parts": [',
    (", ", '{"type": "paragraph", "value": "Text {i} of {n}."}'), ', {"type": "list", "has_parts": [',
    (", ", '{"type": "list_item", "value": "One {i}", "has_parts": [{"type": "list", "has_parts": [{"type": "list_item", "value": "Two {i}"}]}]}'), "]}]}]",
)


@query("html_article_parts", f"""SELECT doc_id, {_ABSTRACT} AS abstract, len(r) AS templates, len(r) AS categories, len(r) AS images, len(r) AS refs, 2 * len(r) AS links, 'Box ' || n AS box, 'Abstract|Life ' || n AS sections FROM made""", _MADE)
def html_article(spark: SparkSession, d: str) -> DataFrame:
    """All parts of a page in one pass."""
    sizes = {"templates": "templates", "categories": "categories", "images": "images", "refs": "references", "links": "links"}
    names = F.from_json("p.sections", "array<struct<name:string>>")
    return _pages(spark, d, "abstract", "infoboxes", "sections", *sizes.values()).select(
        "doc_id", F.col("p.abstract").alias("abstract"), *[F.size(f"p.{v}").cast("long").alias(k) for k, v in sizes.items()],
        F.get_json_object("p.infoboxes", "$[0].name").alias("box"), F.array_join(F.transform(names, lambda s: s["name"]), "|").alias("sections"),
    )


@query("html_relations_names", "SELECT identifier, array_to_string(['Category:' || x for x in range(1, n_categories + 1)], ',') AS names FROM articles", A)
def html_names(spark: SparkSession, d: str) -> DataFrame:
    return articles(spark, d).select("identifier", F.array_join(F.transform("categories", lambda c: c["name"]), ",").alias("names"))


def _life() -> Column:
    """Parts of the second section."""
    item = "struct<value:string,has_parts:array<struct<has_parts:array<struct<value:string>>>>>"
    return F.from_json(F.get_json_object("p.sections", "$[1].has_parts"), f"array<struct<type:string,value:string,has_parts:array<{item}>>>")


def _paragraphs() -> Column:
    return F.array_join(F.transform(F.filter(_life(), lambda x: x["type"] == "paragraph"), lambda x: x["value"]), "|")


def _items() -> Column:
    items = F.flatten(F.transform(F.filter(_life(), lambda x: x["type"] == "list"), lambda x: x["has_parts"]))
    return F.array_join(F.transform(items, lambda x: F.concat(x["value"], F.lit("/"), x["has_parts"][0]["has_parts"][0]["value"])), "|")


#: For each query the parts it asks for, its column, and the SQL of its value.
_PARTS = {
    "html_base_url": (("base_url", "links"), lambda: F.concat("p.base_url", F.element_at("p.links", -1)["url"]), _sql("https://en.host/wiki/https://a/{n}/") + " || len(r)"),
    "html_templates": (("templates",), lambda: F.to_json("p.templates"), _wrapped("[", (",", '{"name":"Template:T{n}-{i}","url":"https://en.host/wiki/Template:T{n}-{i}"}'), "]")),
    "html_categories": (("categories",), lambda: F.to_json("p.categories"), _wrapped("[", (",", '{"name":"Category:C{n}-{i}","url":"https://en.host/wiki/Category:C{n}-{i}"}'), "]")),
    "html_abstract": (("abstract",), lambda: F.col("p.abstract"), _ABSTRACT),
    "html_images": (("images",), lambda: F.to_json("p.images"), _wrapped("[", (",", '{"content_url":"https://i/x{n}-{i}.png","alternative_text":"x{i}","caption":"Cap {i}","width":20{i},"height":30{i}}'), "]")),
    "html_text": (
        ("text",),lambda: F.col("p.text"),
        _wrapped(
            "Alpha (born {n}) is ", (" ", "beta {i}"), " number {n}. Box {n} Born {n} May Works ", (" ", "A{i}"), " Life {n} ", (" ", "Text {i} of {n}."), " ", (" ", "One {i} Two {i}"),
            " ", (" ", "Cap {i}"), " References ", (" ", "Note {i} a{i}"),
        ),
    ),
    "html_infobox": (
        ("infoboxes",),lambda: F.get_json_object("p.infoboxes", "$[0].has_parts"),
        _wrapped('[{"type":"field","name":"Born","value":"{n} May"},{"type":"list","name":"Works","value":"', (" ", "A{i}"), '","values":[', (",", '"A{i}"'), "]}]"),
    ),
    "html_infoboxes": (("infoboxes",), lambda: F.col("p.infoboxes"), _BOX),
    "html_sections": (("sections",), lambda: F.col("p.sections"), _SECTIONS),
    "html_paragraphs": (("sections",), _paragraphs, _list("|", "Text {i} of {n}.")),
    "html_list_items": (("sections",), _items, _list("|", "One {i}/Two {i}")),
    "html_references": (("references",), lambda: F.to_json("p.references"), _wrapped("[", (",", '{"id":"r{i}","index":{i},"text":"Note {i} a{i}","links":[{"url":"https://a/{n}/{i}","text":"a{i}"}]}'), "]")),
}

for _name, (_only, _column, _value) in _PARTS.items():

    @query(_name, f"SELECT doc_id, {_value} AS part FROM made", _MADE)
    def _part_query(spark: SparkSession, d: str, only=_only, column=_column) -> DataFrame:
        return _pages(spark, d, *only).select("doc_id", column().alias("part"))


@query("fn_underscore", "SELECT doc_id, 'A_b_' || doc_id AS name FROM documents")
def fn_underscore(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", X.underscored(F.concat(F.lit("A b "), F.col("doc_id").cast("string"))).alias("name"))


@query("fn_between_hours", "SELECT event_id, event_id % 4 > 0 AND ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-06' AS inside FROM events")
def fn_between(spark: SparkSession, d: str) -> DataFrame:
    at = F.when(F.col("event_id") % 4 > 0, F.col("ts"))
    return events(spark, d).select("event_id", X.between_hours(at, F.to_timestamp(F.lit("2024-01-05 00:00:00")), 24).alias("inside"))


@query("proj_structured", f"SELECT identifier, name, version_id AS version, {_BOX} AS infoboxes, len(r) AS parsed_references, '02/24' AS last_revised FROM articles JOIN made ON doc_id = identifier", A, _MADE)
def proj_structured(spark: SparkSession, d: str) -> DataFrame:
    """The default fields, and of the computed ones those asked for: their functions run only then."""
    a = articles(spark, d).select("name", "identifier", "version", "in_language", "is_part_of")
    p = _pages(spark, d, "infoboxes", "references").select(F.col("doc_id").alias("identifier"), F.col("p.infoboxes").alias("infoboxes"), F.col("p.references").alias("references"))
    out = a.join(p, "identifier").withColumn("attribution", F.struct(F.size("references").cast("long").alias("parsed_references_count"), X.last_revised(F.lit("2024-02-01T00:00:00Z")).alias("last_revised")))
    return out.select("identifier", "name", F.col("version.identifier").alias("version"), "infoboxes", F.col("attribution.parsed_references_count").alias("parsed_references"), F.col("attribution.last_revised").alias("last_revised"))


@query("agg_rel_dedup", "SELECT identifier, 'Category:' || i AS name, 'https://last/' || i AS url FROM (SELECT identifier, unnest(range(1, n_categories + 1)) AS i FROM articles)", A)
def rel_dedup(spark: SparkSession, d: str) -> DataFrame:
    """Relations unique by name, the last address wins: each is there twice, the second time with another address."""
    again = F.transform("categories", lambda c: F.struct(c["name"].alias("name"), F.concat(F.lit("https://last/"), F.substring_index(c["name"], ":", -1)).alias("url")))
    rel = articles(spark, d).select("identifier", F.posexplode(F.concat("categories", again)).alias("n", "c"))
    return rel.groupBy("identifier", F.col("c.name").alias("name")).agg(F.max_by("c.url", "n").alias("url"))
