"""Operator 7, benchmark decontamination by spaced-seed hashing; DataFrame functions only.

Texts are lower-cased and words are runs of letters and digits.  A mask names positions of a span of words
that count; the others are ignored, so a substitution there is tolerated.  Hashes under each mask of every
place of every test item are joined with those of every place of every text.  At each hit the item is laid
beside the text (start of text place less item place) and the equal words of the item's whole length are noted.

A text is contaminated by an item if at least ``share`` of the item's words are equal on one such diagonal, or
if a span has ``least_equal`` equal words or ``share`` of the item's.  A span joins runs of equal words in order,
of one diagonal or of neighbouring ones (a word put in or left out), as long as ``share`` of its words are equal.
The masks are all ways to have three words of five or fewer, so no item of ten words or more that is equal at
``share`` of 0.6 lacks a seed.  Shorter items match only exactly and as a whole; an item without words never.

A null text or item is empty; items that are equal are reported each; of rows that repeat an id the best place is
reported, and ``clean`` judges each by its text; a null id is an id; very long texts are searched whole; ties go to
the first place; empty tables give an empty result.  Other columns, whatever their names, are carried by ``clean``
alone.

Seeds (32 bytes each) and items' words are broadcast, as two tables, while the seeds are at most ``most_seeds``; an
item has at most nine words a seed, so that bounds both.  Beyond it seeds, documents' keys and places are shuffled,
without words, and the words beside the hits are joined afterwards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.llm.runtime import NULL_ID, durable, read

_TOKEN = r"[\p{L}\p{N}]+"
#: 1: the word counts; 0: it is ignored.  Where 60 % of ten words or more are equal, some five of them have three.
MASKS = ("111", "1101", "1011", "11001", "10101", "10011")
#: Items with fewer words are matched exactly, from their first word on; those of one or two words have masks of their own.
SHORT, SHORT_MASKS = 10, ("1", "11")
#: Equal words from which on part of an item is reported.
LEAST_EQUAL = 13
SHARE = 0.6
MOST_SEEDS = 1_000_000
#: Documents to drop that ``clean`` broadcasts (16 bytes each); beyond it they are joined by a shuffle.
MOST_OUT = 1_000_000


def _words(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(F.lower(F.coalesce(text.cast("string"), F.lit(""))), F.lit(_TOKEN), F.lit(0)), lambda w: F.xxhash64(w))


def _seed(mask: str, words: str, at: str) -> Column:
    hashed = F.xxhash64(F.lit(mask), *[F.get(words, F.col(at) + i) for i, c in enumerate(mask) if c == "1"])
    return F.when(F.col(at) + len(mask) <= F.size(words), hashed)


def _seeds(words: str, at: str, masks: tuple[str, ...]) -> Column:
    return F.explode(F.array(*[_seed(m, words, at) for m in masks]))


def _item_seeds() -> Column:
    """Short items have one seed, of as many words as the masks allow, at their first word."""
    by_size = [F.when((F.size("_item") == len(m)) & (F.col("_q") == 0), _seed(m, "_item", "_q")) for m in SHORT_MASKS]
    short = F.when((F.size("_item") < SHORT) & (F.col("_q") == 0), _seed(MASKS[0], "_item", "_q"))
    long = [F.when(F.size("_item") >= SHORT, _seed(m, "_item", "_q")) for m in MASKS]
    return F.explode(F.array(*by_size, short, *long))


def _places(words: str) -> Column:
    return F.explode(F.when(F.size(words) >= 1, F.sequence(F.lit(0), F.size(words) - 1)))


def _runs(diagonals: Column) -> Column:
    """Runs of equal words (p: first word in the text, q: in the item, n: words), by place in the text."""

    def of(d: Column) -> Column:
        at = lambda i: F.get(d["eq"], i)
        first = F.filter(d["eq"], lambda x, i: F.coalesce(at(i - 1) != x - 1, F.lit(True)))
        last = F.filter(d["eq"], lambda x, i: F.coalesce(at(i + 1) != x + 1, F.lit(True)))
        return F.zip_with(first, last, lambda a, b: F.struct((d["at"] + a).alias("p"), a.alias("q"), (b - a + 1).alias("n")))

    return F.sort_array(F.flatten(F.transform(diagonals, of)))


def _span(runs: Column, n: Column, share: float) -> Column:
    """e, the most equal words of a span, and b, its first diagonal with the sign changed.

    A span's score is (1 - share) for each equal word, less share for each other.  It is below n, so a run that
    ended n words ago can't be joined any more.
    """
    score = lambda e, other: e * F.lit(1.0 - share) - other * F.lit(share)

    def made(s: Column, e: Column, b: Column, r: Column) -> Column:
        return F.struct(s.cast("double").alias("s"), e.cast("int").alias("e"), b.cast("int").alias("b"), (r["p"] + r["n"]).alias("p"), (r["q"] + r["n"]).alias("q"))

    def step(acc: Column, r: Column) -> Column:
        live = F.filter(acc["live"], lambda a: a["p"] > r["p"] - n)

        def joined(a: Column) -> Column:
            twice = F.greatest(F.lit(0), a["p"] - r["p"], a["q"] - r["q"])
            gap = F.greatest(F.lit(0), r["p"] - a["p"], r["q"] - a["q"])
            return F.when(twice < r["n"], made(a["s"] + score(r["n"] - twice, gap), a["e"] + r["n"] - twice, a["b"], r))

        alone = made(score(r["n"], F.lit(0)), r["n"], r["q"] - r["p"], r)
        best = F.array_max(F.concat(F.array(alone), F.transform(live, joined)))
        new = F.transform(F.array(best), lambda x: F.struct(F.concat(live, F.array(x)).alias("live"), F.greatest(acc["top"], F.struct(x["e"].alias("e"), x["b"].alias("b"))).alias("top")))
        return new[0]

    start = F.expr("named_struct('live', cast(array() as array<struct<s: double, e: int, b: int, p: int, q: int>>), 'top', named_struct('e', 0, 'b', 0))")
    return F.aggregate(runs, start, step, lambda acc: acc["top"])


def _hits(text: DataFrame, items: DataFrame, most_seeds: int) -> DataFrame:
    """_did, doc_id, _th, item_id, _doc, _item, _at: an item beside a text, once for each diagonal with a seed or oftener.

    text: _did, doc_id, _th, _doc; items: _ik, item_id, _item.
    """
    sizes = items.agg(*[F.coalesce(F.bool_or(F.size("_item") == len(m)), F.lit(False)) for m in SHORT_MASKS]).first()
    masks = MASKS + tuple(m for m, has in zip(SHORT_MASKS, sizes, strict=True) if has)
    seeds = items.select("_ik", "_item", _places("_item").alias("_q")).select("_ik", "_q", _item_seeds().alias("_seed"))
    seeds = seeds.filter("_seed IS NOT NULL").distinct()
    places = text.select("*", _places("_doc").alias("_p")).select("*", _seeds("_doc", "_p", masks).alias("_seed")).filter("_seed IS NOT NULL")
    at = (F.col("_p") - F.col("_q")).alias("_at")
    if seeds.limit(most_seeds + 1).count() <= most_seeds:
        hits = places.join(F.broadcast(seeds), "_seed").join(F.broadcast(items), "_ik")
        # Of a diagonal's hits those after an equal word are left out: with that word there is a hit further up.
        before = F.coalesce(F.get("_doc", F.col("_p") - 1) == F.get("_item", F.col("_q") - 1), F.lit(False))
        return hits.filter(~before).select("_did", "doc_id", "_th", "item_id", "_doc", "_item", at)
    hits = places.select("_did", "_th", "_p", "_seed").join(seeds, "_seed").select("_did", "_th", "_ik", at).distinct()
    return hits.join(text, ["_did", "_th"]).join(items, "_ik").select("_did", "doc_id", "_th", "item_id", "_doc", "_item", "_at")


def _overlaps(docs: DataFrame, items: DataFrame, share: float, id_col: str, text_col: str, item_col: str, item_text: str, most_seeds: int, least_equal: int) -> DataFrame:
    """_did, doc_id, _th, item_id, _n and m of each contaminated pair of text and item; m orders a pair's places."""
    test = items.select(F.col(f"`{item_col}`").cast("long").alias("item_id"), _words(F.col(f"`{item_text}`")).alias("_item")).distinct()
    test = test.withColumn("_ik", F.xxhash64("item_id", "_item"))
    raw = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    doc = F.col(f"`{id_col}`").cast("long")
    text = docs.select(F.coalesce(doc, F.lit(NULL_ID)).alias("_did"), doc.alias("doc_id"), F.xxhash64(raw).alias("_th"), _words(raw).alias("_doc"))
    hits = _hits(text, test, most_seeds)
    begin = F.greatest(F.col("_at"), F.lit(0))
    beside = F.slice("_doc", begin + 1, F.size("_item") - (begin - F.col("_at")))
    own = F.slice("_item", F.greatest(F.lit(1), 1 - F.col("_at")), F.size("_item"))
    # The generator keeps the lambda below out of the join, which then stays in one piece of generated code with the
    # places' generators: whole texts are read in place, and only the words beside an item leave it.
    pair = F.explode(F.array(F.struct(beside.alias("beside"), own.alias("own"), F.xxhash64("_item").alias("i")))).alias("_x")
    hits = hits.select("_did", "doc_id", "_th", "item_id", "_at", F.size("_item").alias("_n"), pair)
    equal = F.array_compact(F.transform("_x.beside", lambda w, i: F.when(w == F.get("_x.own", i), i + F.greatest(F.lit(0), -F.col("_at")))))
    found = hits.select("_did", "doc_id", "_th", "item_id", "_n", "_x.i", F.struct(F.col("_at").alias("at"), equal.alias("eq")).alias("_g"))
    found = found.groupBy("_did", "doc_id", "_th", "item_id", "_n", "i").agg(F.collect_set("_g").alias("_g"))
    n, need = F.col("_n"), F.when(F.col("_n") < SHORT, F.col("_n").cast("double")).otherwise(F.lit(share) * F.col("_n"))
    all_equal = F.aggregate("_g", F.lit(0), lambda s, g: s + F.size(g["eq"]))
    found = found.filter(all_equal >= F.least(need, F.lit(float(least_equal))))
    whole = F.array_max(F.transform(F.filter("_g", lambda g: F.size(g["eq"]) >= need), lambda g: F.struct(F.size(g["eq"]).alias("e"), (-g["at"]).alias("b"))))
    found = found.withColumn("_w", whole).withColumn("_s", F.when(F.col("_w").isNull() & (n >= SHORT), _span(_runs(F.col("_g")), n, share)))
    part = F.when(F.col("_s.e") >= F.least(need, F.lit(float(least_equal))), F.col("_s"))
    best = F.struct(F.col("_w").isNotNull().alias("w"), F.coalesce("_w", part).alias("x")).alias("m")
    return found.select("_did", "doc_id", "_th", "item_id", "_n", best).filter("m.x IS NOT NULL")


def overlaps(docs: DataFrame, items: DataFrame, share: float = SHARE, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", most_seeds: int = MOST_SEEDS, least_equal: int = LEAST_EQUAL) -> DataFrame:
    """doc_id, item_id, n_equal, n_item_words, first_word of each contaminated pair.

    The pair's best diagonal with the share, the first of equals; or else its best span.
    """
    best = _overlaps(docs, items, share, id_col, text_col, item_col, item_text, most_seeds, least_equal)
    best = best.groupBy("doc_id", "item_id", "_n").agg(F.max("m").getField("x").alias("m"))
    return best.select("doc_id", "item_id", F.col("m.e").cast("long").alias("n_equal"), F.col("_n").cast("long").alias("n_item_words"), (-F.col("m.b")).cast("long").alias("first_word"))


def clean(docs: DataFrame, items: DataFrame, share: float = SHARE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs, all columns, without those whose id and text hold a test item."""
    out = _overlaps(docs, items, share, id_col, text_col, "item_id", "text", MOST_SEEDS, LEAST_EQUAL)
    out = durable(out.select("_did", "_th").distinct())
    raw = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NULL_ID)).alias("_did"), F.xxhash64(raw).alias("_th"))
    few = out.limit(MOST_OUT + 1).count() <= MOST_OUT
    return own.join(F.broadcast(out) if few else out, ["_did", "_th"], "left_anti").select(*[F.col("_row").getField(c).alias(c) for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlaps(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


#: The SQL's seeds: it reports whole items only, and finds those that these masks find.
_SQL_MASKS, _SQL_SPAN = ("1101100111", "1110010111", "1011111001", "11111"), 10


def _sql() -> str:
    def seeds(table: str, key: str) -> str:
        def one(n: int, mask: str) -> str:
            return f"'{n}'" + "".join(f" || ' ' || ws[p + {i + 1}]" for i, c in enumerate(mask) if c == "1")

        listed = ", ".join(one(n, m) for n, m in enumerate(_SQL_MASKS))
        return f"(SELECT {key}, p, unnest([{listed}]) AS seed FROM (SELECT {key}, ws, unnest(range(0, len(ws) - {_SQL_SPAN - 1})) AS p FROM {table} WHERE len(ws) >= {_SQL_SPAN}))"

    return rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '{_TOKEN}') AS ws FROM documents),
b AS (SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '{_TOKEN}') AS ws FROM benchmark),
places AS (SELECT DISTINCT x.doc_id, y.item_id, x.p - y.p AS first_word FROM {seeds("d", "doc_id")} x JOIN {seeds("b", "item_id")} y ON x.seed = y.seed),
words AS (SELECT a.doc_id, a.item_id, a.first_word, len(b.ws) AS n, d.ws AS dw, b.ws AS bw, unnest(range(1, len(b.ws) + 1)) AS i
          FROM places a JOIN d ON a.doc_id = d.doc_id JOIN b ON a.item_id = b.item_id),
counted AS (SELECT doc_id, item_id, first_word, n, count(*) FILTER (first_word + i >= 1 AND dw[greatest(first_word + i, 1)] = bw[i]) AS n_equal FROM words GROUP BY ALL),
best AS (SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY n_equal DESC, first_word) AS r FROM counted WHERE n_equal >= {SHARE} * n)
SELECT doc_id, item_id, CAST(n_equal AS BIGINT) AS n_equal, CAST(n AS BIGINT) AS n_item_words, CAST(first_word AS BIGINT) AS first_word FROM best WHERE r = 1
"""


SQL = _sql()
