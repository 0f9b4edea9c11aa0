"""Operator 2, quality rules with risk-controlled thresholds; DataFrame functions only.

Each text gets measures; a rule is a measure and a cutoff, and rejects a text whose measure is above it.  Cutoffs
come from fixed grids.  The labelled texts that pass the base rules are dealt by the hash of their text: half of
them propose, the other half, the holdout, decides.

1. Proposals, by stratum (language): of each measure the cutoff that rejects most bad texts among those that
   reject no more than an even share of ``limit`` of the proposing good ones; the rules so found are put in order,
   those that reject fewest good texts first.
2. Decisions: the first j rules together reject k of the holdout's n good texts.  The exact binomial tail
   P(X <= k | n, limit) must be at most alpha / strata.  j goes up from 1 and stops at the first failure (a fixed
   sequence, so each stratum spends its alpha once; Bonferroni over the strata).  With probability 1 - alpha, no
   stratum's admitted rules together reject more than ``limit`` of its good texts.

A stratum whose holdout has too few good texts for any rule (even k = 0 would fail) joins one rest stratum, for which
the limit holds as a whole.  Strata are counted and pooled by numbers of labels, before any rejection is looked at.
Texts of a stratum without labels meet the base rules only.

Labelled copies count once, as the bound needs independent texts.  The rules are broadcast while they are at most
``most_rules``, else joined by a shuffle; no stratum is left out.  A null text is an empty one; a null stratum is a
stratum; labels without a document, and null labels, are left out; repeated labels of one id count once, as bad if
they disagree; rows that repeat an id are judged each by its text; very long texts are judged whole; equal measures
and ties of proposals go by name; empty tables give an empty result, or no rules.  Other columns, whatever their
names, are carried by ``keep_good`` alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioflow.llm.runtime import durable, read

_WORD = r"[^\x20\x09-\x0D]+"
_SPACES = r"[\x20\x09-\x0D]+"

#: Measures, and the cutoffs that are tried for each: fixed before any label is seen.
GRID = {
    "symbols_per_word": (0.1, 0.2, 0.5, 1.0),
    "duplicate_lines": (0.1, 0.3, 0.5),
    "repeated_words": (0.1, 0.2, 0.35),
    "chars_per_word": (10.0, 12.0, 16.0),
    "loud_letters": (0.2, 0.4, 0.6),
    "shouts_per_word": (0.1, 0.3, 0.6),
}
LIMIT, ALPHA = 0.03, 0.05
#: Rules that are broadcast at most.
MOST_RULES = 100_000
LEAST_WORDS, MOST_REPEATED = 50, 50


def _let(value: Column, use) -> Column:
    """use(value), with value computed once."""
    return F.transform(F.array(value), use)[0]


def window_hashes(words: Column) -> Column:
    """A hash of each three-word window, with its place."""
    places = F.when(F.size(words) >= 3, F.sequence(F.lit(0), F.size(words) - 3)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.struct(F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("i")))


def n_repeat_words(windows: Column, words: Column) -> Column:
    """Words in windows found twice or more; windows: of window_hashes, sorted (by sort_array, whose comparison is compiled).

    A window is repeated if one beside it, among those with its hash, has its words.
    """

    def same(x: Column, y: Column) -> Column:
        at = lambda n: F.get(words, x["i"] + n) == F.get(words, y["i"] + n)
        return F.coalesce((x["h"] == y["h"]) & at(0) & at(1) & at(2), F.lit(False))

    kept = F.filter(windows, lambda x, j: same(x, F.get(windows, j - 1)) | same(x, F.get(windows, j + 1)))

    def cover(at: Column) -> Column:
        steps = F.zip_with(at, F.slice(at, 2, F.greatest(F.size(at), F.lit(1))), lambda a, b: F.least(F.lit(3), F.coalesce(b - a, F.lit(3))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda s, x: s + x)

    return _let(F.sort_array(F.transform(kept, lambda x: x["i"])), cover)


def with_counts(docs: DataFrame, text: str = "_text") -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and the measures of GRID."""
    t = F.col(text)
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(_WORD))
    own = docs.withColumn("_words", F.filter(F.split(t, _SPACES), lambda w: w != ""))
    own = own.withColumn("_windows", F.sort_array(window_hashes(F.col("_words"))))
    out = own.select(
        *docs.columns,
        F.size("_words").cast("long").alias("n_words"),
        F.char_length(F.regexp_replace(t, _SPACES, "")).cast("long").alias("word_chars"),
        (F.char_length(t) - F.char_length(F.translate(t, "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        F.greatest(F.size(lines), F.lit(1)).alias("_lines"),
        n_repeat_words(F.col("_windows"), F.col("_words")).alias("n_repeat_words"),
        (F.char_length(t) - F.char_length(F.translate(t, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))).alias("_loud"),
        (F.char_length(t) - F.char_length(F.translate(t, "!", ""))).alias("_shouts"),
    )
    per = lambda a, b: (F.col(a) / F.greatest(F.col(b).cast("double"), F.lit(1.0)))
    return out.select(
        *docs.columns, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        per("n_symbols", "n_words").alias("symbols_per_word"), per("n_dup_lines", "_lines").alias("duplicate_lines"),
        per("n_repeat_words", "n_words").alias("repeated_words"), per("word_chars", "n_words").alias("chars_per_word"),
        per("_loud", "word_chars").alias("loud_letters"), per("_shouts", "n_words").alias("shouts_per_word"),
    )


def log_tail(k: Column, n: Column, p: float) -> Column:
    """ln P(X <= k) for X binomial(n, p): terms are built one from the other, in logs."""
    q = F.lit(p / (1 - p))
    start = F.struct((n * F.log(F.lit(1 - p))).alias("t"), (n * F.log(F.lit(1 - p))).alias("s"))

    def step(acc: Column, i: Column) -> Column:
        term = acc["t"] + F.log((n - i + 1) / i * q)
        top = F.greatest(acc["s"], term)
        return F.struct(term.alias("t"), (top + F.log(F.exp(acc["s"] - top) + F.exp(term - top))).alias("s"))

    steps = F.when(k > 0, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>"))
    return F.aggregate(steps, start, step, lambda acc: acc["s"])


def holdout(text: Column) -> Column:
    """Half of all texts, by their MD5."""
    return F.md5(text.cast("binary")) < "8"


def _hits(rows: DataFrame, cutoffs: dict[str, tuple[float, ...]]) -> Column:
    """One entry for each rule of the grids: measure, cutoff and whether it rejects."""
    return F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), F.lit(c).alias("cutoff"), (rows[m] > c).alias("hit")) for m, cs in cutoffs.items() for c in cs])).alias("_r")


def _pooled(labelled: DataFrame, limit: float, alpha: float) -> tuple[DataFrame, int]:
    """Strata, with _pool (null for those that join the rest), and how many there are."""
    strata = durable(labelled.groupBy("_stratum").agg(F.count_if(F.col("_good") & F.col("_holdout")).alias("_n")))
    count = strata.count()
    enough = F.col("_n") * F.log(F.lit(1 - limit)) <= F.log(F.lit(alpha / max(1, count)))
    return strata.select("_stratum", (~enough).alias("_rest")), count


def admitted(labelled: DataFrame, limit: float = LIMIT, alpha: float = ALPHA) -> DataFrame:
    """stratum, measure, cutoff, n, k: the rules that apply to each stratum, with the figures of their decision.

    labelled: one row a text, with ``_stratum``, ``_good``, ``_holdout`` and the measures.
    """
    strata, count = _pooled(labelled, limit, alpha)
    rows = labelled.join(strata.withColumnRenamed("_stratum", "_s"), F.col("_stratum").eqNullSafe(F.col("_s")))
    # The rest stratum's name is no language's: a struct of the flag and the name.
    pool = F.struct(F.col("_rest").alias("rest"), F.when(~F.col("_rest"), F.col("_stratum")).alias("name"))
    rows = durable(rows.select(pool.alias("_pool"), "_good", "_holdout", *GRID))
    part = rows.filter("NOT _holdout")
    counts = (
        part.select("_pool", "_good", _hits(part, GRID))
        .groupBy("_pool", "_r.measure", "_r.cutoff")
        .agg(F.count_if("_good").alias("n"), F.count_if(F.col("_good") & F.col("_r.hit")).alias("k"), F.count_if(~F.col("_good") & F.col("_r.hit")).alias("bad"))
    )
    fit = counts.filter((F.col("bad") > 0) & (F.col("k") <= F.lit(limit / len(GRID)) * F.col("n")))
    best = Window.partitionBy("_pool", "measure").orderBy(F.desc("bad"), F.desc("cutoff"))
    fit = fit.withColumn("_b", F.row_number().over(best)).filter("_b = 1")
    rank = F.row_number().over(Window.partitionBy("_pool").orderBy("k", F.desc("bad"), "measure"))
    rules = durable(fit.select("_pool", "measure", "cutoff", rank.alias("rank")))  # at most a rule for each measure and pool
    held = rows.filter("_holdout AND _good")
    value = F.coalesce(*[F.when(F.col("measure") == m, F.col(m)) for m in GRID])
    first = held.withColumn("_id", F.monotonically_increasing_id()).join(F.broadcast(rules) if count <= MOST_RULES // len(GRID) else rules, "_pool", "left")
    first = first.groupBy("_id", "_pool").agg(F.min(F.when(value > F.col("cutoff"), F.col("rank"))).alias("rank"))
    k = first.groupBy("_pool", "rank").agg(F.count("*").alias("c"))
    size = k.groupBy("_pool").agg(F.sum("c").alias("n"))
    upto = Window.partitionBy("_pool").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)  # a row for each measure at most
    tried = rules.join(size, "_pool").join(k, ["_pool", "rank"], "left").withColumn("k", F.sum(F.coalesce("c", F.lit(0))).over(upto))
    failed = F.when(log_tail(F.col("k"), F.col("n"), limit) <= F.log(F.lit(alpha / max(1, count))), 0).otherwise(1)
    passed = tried.withColumn("_failed", F.sum(failed).over(upto)).filter("_failed = 0")
    named = strata.withColumn("_pool", pool)
    return named.join(passed, "_pool").select(F.col("_stratum").alias("stratum"), "measure", "cutoff", "n", "k")


def measured(docs: DataFrame, labels: DataFrame, carried: list[Column], id_col: str, text_col: str, stratum_col: str, limit: float, alpha: float) -> DataFrame:
    """The carried columns with counts, measures, base_failed and kept of each row.

    Texts are measured once and written with what is carried, so the verdict needs no shuffle of texts.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    doc = F.col(f"`{id_col}`").cast("long")
    own = docs.select(*carried, doc.alias("_id"), F.xxhash64(text).alias("_th"), holdout(text).alias("_holdout"), F.col(f"`{stratum_col}`").cast("string").alias("_stratum"), text.alias("_text"))
    base = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    rows = durable(with_counts(own).drop("_text").withColumn("base_failed", base))
    good = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("_id")).agg((F.min("quality") == 1).alias("_good"))
    labelled = rows.filter("NOT base_failed").join(good, "_id").groupBy("_th", "_stratum").agg(F.every("_good").alias("_good"), *[F.first(m).alias(m) for m in ("_holdout", *GRID)])
    rules = admitted(durable(labelled), limit, alpha)
    rules = durable(rules.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("measure", "cutoff"))).alias("_rules")))
    few = rules.count() <= MOST_RULES // len(GRID)
    rows = rows.join(F.broadcast(rules) if few else rules, F.col("_stratum").eqNullSafe(F.col("stratum")), "left")
    hit = F.lit(False)
    for m in GRID:
        hit = hit | F.coalesce(F.col(m) > F.col("_rules")[m], F.lit(False))
    return rows.withColumn("kept", ~F.col("base_failed") & ~hit).drop("stratum", "_rules")


def judged(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang", limit: float = LIMIT, alpha: float = ALPHA) -> DataFrame:
    """doc_id, counts, measures, base_failed and kept of each row."""
    return measured(docs, labels, [F.col(f"`{id_col}`").cast("long").alias("doc_id")], id_col, text_col, stratum_col, limit, alpha)


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang", limit: float = LIMIT, alpha: float = ALPHA) -> DataFrame:
    """docs, all columns, without those that the rules reject."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    done = measured(docs, labels, [row], id_col, text_col, stratum_col, limit, alpha).filter("kept")
    return done.select(*[F.col("_row").getField(c).alias(c) for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = judged(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return done.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _sql() -> str:
    grid = ", ".join(f"('{m}', CAST({c} AS DOUBLE))" for m, cs in GRID.items() for c in cs)
    value = "CASE measure " + " ".join(f"WHEN '{m}' THEN {m}" for m in GRID) + " END"
    return rf"""
WITH w AS (SELECT doc_id, lang, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS ws FROM documents),
grams AS (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g
          FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM grams) WHERE n > 1),
rep AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id),
lines AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS ls FROM w),
c AS (SELECT w.doc_id, lang, text, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
             CAST(length(text) - length(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
             CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, greatest(len(ls), 1) AS n_lines,
             CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
             length(text) - length(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '')) AS loud, length(text) - length(translate(text, '!', '')) AS shouts
      FROM w JOIN lines USING (doc_id) LEFT JOIN rep USING (doc_id)),
m AS (SELECT *, n_symbols / greatest(CAST(n_words AS DOUBLE), 1.0) AS symbols_per_word, n_dup_lines / CAST(n_lines AS DOUBLE) AS duplicate_lines,
             n_repeat_words / greatest(CAST(n_words AS DOUBLE), 1.0) AS repeated_words, word_chars / greatest(CAST(n_words AS DOUBLE), 1.0) AS chars_per_word,
             loud / greatest(CAST(word_chars AS DOUBLE), 1.0) AS loud_letters, shouts / greatest(CAST(n_words AS DOUBLE), 1.0) AS shouts_per_word,
             n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed FROM c),
l AS (SELECT lang, md5(text) < '8' AS held, bool_and(q = 1) AS good, any_value(m) AS m FROM m
      JOIN (SELECT doc_id, min(quality) AS q FROM labels GROUP BY doc_id) USING (doc_id) WHERE NOT base_failed GROUP BY text, lang),
strata AS (SELECT lang, count(*) FILTER (good AND held) * ln(1 - {LIMIT}) > ln({ALPHA!r} / (SELECT count(DISTINCT lang) FROM l)) AS rest FROM l GROUP BY lang),
lm AS (SELECT CASE WHEN rest THEN '' ELSE lang END AS pool, good, held, m.* FROM l JOIN strata USING (lang)),
lr AS (SELECT row_number() OVER () AS i, pool, good, held, {", ".join(GRID)} FROM lm),
tried AS (SELECT pool, measure, cutoff, count(*) FILTER (good) AS n, count(*) FILTER (good AND {value} > cutoff) AS k, count(*) FILTER (NOT good AND {value} > cutoff) AS bad
          FROM lr, (VALUES {grid}) g(measure, cutoff) WHERE NOT held GROUP BY pool, measure, cutoff),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY pool, measure ORDER BY bad DESC, cutoff DESC) AS b FROM tried WHERE bad > 0 AND k <= {LIMIT / len(GRID)!r} * n) WHERE b = 1),
rules AS (SELECT pool, measure, cutoff, row_number() OVER (PARTITION BY pool ORDER BY k, bad DESC, measure) AS rank FROM best),
firsts AS (SELECT i, any_value(lr.pool) AS pool, min(rank) FILTER ({value} > cutoff) AS rank FROM lr LEFT JOIN rules ON lr.pool = rules.pool WHERE held AND good GROUP BY i),
sums AS (SELECT r.pool, measure, cutoff, r.rank, (SELECT count(*) FROM firsts f WHERE f.pool = r.pool) AS n, (SELECT count(*) FROM firsts f WHERE f.pool = r.pool AND f.rank <= r.rank) AS k FROM rules r),
tail AS (SELECT *, list_sum(list_transform(range(0, k + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1.0) - lgamma(n - i + 1.0) + i * ln({LIMIT!r}) + (n - i) * ln(1 - {LIMIT!r})))) AS p FROM sums WHERE n > 0),
passed AS (SELECT * FROM tail t WHERE NOT EXISTS (SELECT 1 FROM tail o WHERE o.pool = t.pool AND o.rank <= t.rank AND o.p > {ALPHA!r} / (SELECT count(*) FROM strata))),
hit AS (SELECT DISTINCT doc_id FROM m JOIN strata USING (lang) JOIN passed ON pool = CASE WHEN rest THEN '' ELSE lang END WHERE {value} > cutoff)
SELECT m.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, (NOT base_failed AND hit.doc_id IS NULL) AS kept
FROM m LEFT JOIN hit ON m.doc_id = hit.doc_id
"""


SQL = _sql()
