"""Operator 9, license scans by diagonal voting; DataFrame functions only.

Texts are lower-cased (A-Z) and words are runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]``.  Templates are word
sequences with a label.  Hashes of all rolling three-word grams of all texts are joined with the templates'
positions; hits vote for a diagonal (text place less template place).  Votes of neighbouring diagonals of one
template (at most ``slack`` apart) are merged, so that a word put in or left out costs little, and a span is
verified if the template places voted for cover at least ``share`` of its grams; a template of at most
``short`` grams, which another license may share but for a word, needs all of them.

A base phrase is a template all of whose grams must vote on one diagonal: that is a place where its words
stand consecutively.  Base labels come from those, labels also from the longer templates.  score is 1 with a
base label, else the best verified share, else 0.  Null and empty texts have no words; rows that repeat id
and text are one document and get one result each; a null id is an id; very long texts are scanned whole; spans that
tie are all reported; an empty table gives an empty result; other columns, whatever their names, are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioflow.llm.runtime import read

_TOKEN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GRAM = 3
SHARE, SLACK, SHORT = 0.7, 4, 8

#: The phrases of the contract and their labels.
PHRASES = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)

#: Sentences from the public texts of common licenses and their usual notices.
TEMPLATES = (
    ("gpl-3", "licensed under the gnu general public license version 3"),
    ("gpl-2", "licensed under the gnu general public license version 2"),
    ("lgpl", "under the terms of the gnu lesser general public license"),
    ("agpl-3", "gnu affero general public license version 3"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license"),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related rights"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)


def _lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _grams(words: str, at: Column) -> Column:
    return F.concat_ws(" ", *[F.get(words, at + i) for i in range(GRAM)])


def template_positions(spark: SparkSession, phrases=PHRASES, templates=TEMPLATES) -> DataFrame:
    """One row a gram of each template: as many as the templates, given above, have words."""
    rows = []
    for n, (label, text, base) in enumerate([(*p, True) for p in phrases] + [(*t, False) for t in templates]):
        words = text.split()
        rows += [(n, label, base, q, len(words) - GRAM + 1, " ".join(words[q : q + GRAM])) for q in range(len(words) - GRAM + 1)]
    return spark.createDataFrame(rows, "template int, label string, base boolean, q int, grams int, _gram string")


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", share: float = SHARE, slack: int = SLACK, short: int = SHORT) -> DataFrame:
    """One row a document with its n_words, and a list of verified spans (label, base, first_word, share).

    _did and _th, the key, come with it; rows that repeat a key make one row, with ``_rows`` of them.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    doc = F.col(f"`{id_col}`").cast("long")
    own = docs.select(doc.alias("doc_id"), F.xxhash64(text).alias("_th"), F.regexp_extract_all(_lower(text), F.lit(_TOKEN), F.lit(0)).alias("_words"))
    # Place -1 stands for the document itself and outlives the join.
    places = own.select("doc_id", "_th", "_words", F.explode(F.sequence(F.lit(-1), F.greatest(F.size("_words") - GRAM, F.lit(-1)))).alias("p"))
    grams = places.select("doc_id", "_th", "p", F.when(F.col("p") < 0, F.size("_words")).alias("n_words"), F.when(F.col("p") >= 0, F.xxhash64(_grams("_words", F.col("p")))).alias("_h"), F.when(F.col("p") >= 0, _grams("_words", F.col("p"))).alias("_g"))
    test = template_positions(spark).withColumn("_h", F.xxhash64("_gram"))
    hits = grams.join(F.broadcast(test), "_h", "left").filter((F.col("p") < 0) | (F.col("_g") == F.col("_gram")))
    hits = hits.select("doc_id", "_th", "p", "n_words", "template", "label", "base", "grams", "q", (F.col("p") - F.col("q")).alias("diagonal"))
    # Votes by diagonal; a document's own row has no template.
    votes = hits.groupBy("doc_id", "_th", "template", "label", "base", "grams", "diagonal").agg(
        F.collect_set("q").alias("qs"), F.max("n_words").alias("n_words"), F.count("*").alias("_rows")
    )
    by = Window.partitionBy("doc_id", "_th", "template").orderBy("diagonal")
    near = (F.col("diagonal") - F.lag("diagonal").over(by)) <= F.when(F.col("base"), 0).otherwise(slack)
    votes = votes.withColumn("_band", F.sum(F.when(F.coalesce(near, F.lit(False)), 0).otherwise(1)).over(by))
    bands = votes.groupBy("doc_id", "_th", "template", "label", "base", "grams", "_band").agg(
        F.min("diagonal").alias("first_word"), F.size(F.array_distinct(F.flatten(F.collect_list("qs")))).alias("_hit"),
        F.max("n_words").alias("n_words"), F.max("_rows").alias("_rows"),
    )
    part = F.col("_hit") / F.col("grams")
    verified = F.col("template").isNotNull() & F.when(F.col("base") | (F.col("grams") <= short), F.col("_hit") == F.col("grams")).otherwise(part >= share)
    span = F.when(verified, F.struct("label", "base", F.col("first_word").cast("long").alias("first_word"), F.least(part, F.lit(1.0)).alias("share")))
    return bands.groupBy("doc_id", "_th").agg(
        F.max("n_words").cast("long").alias("n_words"), F.collect_list(span).alias("spans"),
        F.max(F.when(F.col("template").isNull(), F.col("_rows"))).alias("_rows"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spans(read(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])
    at = F.transform(base, lambda s: s["first_word"])
    names = lambda xs: F.array_join(F.array_sort(F.array_distinct(F.transform(xs, lambda s: s["label"]))), ",")
    score = F.when(F.size(base) > 0, 1.0).otherwise(F.coalesce(F.array_max(F.transform("spans", lambda s: s["share"])), F.lit(0.0)))
    row = F.explode(F.sequence(F.lit(1), F.col("_rows").cast("int")))
    done = found.select("doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(at).alias("first_word"), F.array_max(at).alias("last_word"), names(base).alias("base_labels"), names(F.col("spans")).alias("labels"), score.alias("score"), row.alias("_r"))
    return done.drop("_r")


def _sql() -> str:
    rows = ", ".join(f"({n}, '{label}', {base}, '{text}')" for n, (label, text, base) in enumerate([(*p, "true") for p in PHRASES] + [(*t, "false") for t in TEMPLATES]))
    gram = "ws[{0} + 1] || ' ' || ws[{0} + 2] || ' ' || ws[{0} + 3]"
    return rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_TOKEN}') AS ws FROM documents),
t AS (SELECT *, string_split(text, ' ') AS ws FROM (VALUES {rows}) v(template, label, base, text)),
tg AS (SELECT template, label, base, n, q, {gram.format("q")} AS g FROM (SELECT *, len(ws) - 2 AS n, unnest(range(0, len(ws) - 2)) AS q FROM t)),
dg AS (SELECT doc_id, p, {gram.format("p")} AS g FROM (SELECT *, unnest(range(0, len(ws) - 2)) AS p FROM d WHERE len(ws) >= 3)),
hits AS (SELECT doc_id, template, label, base, n, q, p - q AS diagonal FROM dg JOIN tg USING (g)),
diags AS (SELECT DISTINCT doc_id, template, base, diagonal FROM hits),
marked AS (SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY doc_id, template ORDER BY diagonal) <= CASE WHEN base THEN 0 ELSE {SLACK} END THEN 0 ELSE 1 END AS fresh FROM diags),
banded AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS band FROM marked),
spans AS (SELECT h.doc_id, h.label, h.base, min(h.diagonal) AS start_word, count(DISTINCT q) / CAST(any_value(n) AS DOUBLE) AS share, any_value(n) AS n
          FROM hits h JOIN banded b ON h.doc_id = b.doc_id AND h.template = b.template AND h.diagonal = b.diagonal GROUP BY h.doc_id, h.template, h.label, h.base, band),
good AS (SELECT * FROM spans WHERE CASE WHEN base OR n <= {SHORT} THEN share = 1 ELSE share >= {SHARE} END)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(count(*) FILTER (base) AS BIGINT) AS n_base,
       CAST(min(start_word) FILTER (base) AS BIGINT) AS first_word, CAST(max(start_word) FILTER (base) AS BIGINT) AS last_word,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base), '') AS base_labels,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (label IS NOT NULL), '') AS labels,
       CASE WHEN count(*) FILTER (base) > 0 THEN 1.0 ELSE coalesce(max(share), CAST(0 AS DOUBLE)) END AS score
FROM d LEFT JOIN good ON d.doc_id = good.doc_id GROUP BY d.doc_id, ws
"""


SQL = _sql()
