"""Each operator against brute force on a small table with nulls, empty and long texts, ties, repeats and clashing columns."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from folioflow.llm import bpe, decontaminate, licenses, quality_classifier, quality_rules, repeats, sharding, simhash, substring_dedup, suffix_dedup, token_counts

WORDS = [w.decode() for w in (b"the of and to in is it that was for on are with as his they at be this from have or by one had not but what all were when we there can an your which their said".split())] + [f"w{i}" for i in range(300)]


def _rows():
    r = random.Random(5)
    say = lambda n: " ".join(r.choice(WORDS) for _ in range(n))
    passage = say(90)
    base = say(130)
    near = base.split()
    near[60] = "changed"
    rows = [
        (0, None), (1, ""), (2, " \t\n\u000b "), (3, "one"), (4, "é ü x y"), (5, base), (6, base), (7, " ".join(near)),
        (8, say(40) + "\n" + passage + "\n" + say(30)), (9, passage + " " + say(25)), (10, say(15) + " " + passage),
        (11, "a b c " * 60), (12, "Und " * 200), (13, "x" * 3000), (14, say(4000)), (None, say(50)), (None, None), (16, passage + passage),
        (17, "Hi!! " * 30 + say(10)), (18, "released under the MIT License. " + say(60)), (19, "Licensed under the Apache License, Version 2.0; " + say(55)),
        (20, "<|endoftext|> can't I'll 123 it's Á <|startoftext|>x Σας ΣΑΣ"), (21, "line\nline\nline\n\nother"), (22, "日本語テキスト" * 90), (23, say(60)),
    ]
    return rows + [(23, rows[-1][1]), (24, say(55)), (25, passage.upper()), (6, base)]


ROWS = _rows()


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en" if n % 3 else None, "src", len(t or ""), n, "x", 1.5, 7) for n, (i, t) in enumerate(ROWS)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, n int, _text string, size double, _did int").repartition(3).cache()


@pytest.fixture(scope="module")
def none(docs):
    return docs.filter("doc_id > 999")


LABELS = [(i, int(i % 2 == 0), 0) for i in range(25)] + [(5, 0, 0), (None, 1, 0), (6, None, 0), (777, 1, 1)]


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")


def raw(text):
    return (text or "").encode()


def order(row):
    return (row[0] is not None, row[0] or 0, 0 if not row[1] else np.int64(np.uint64(xxhash.xxh64_intdigest(raw(row[1]), 42)).astype(np.int64)))


def test_substring(docs, none):
    unique = sorted({(i, t) for i, t in ROWS}, key=lambda r: order((r[0], r[1] or "")))
    seen, want = set(), {}
    for i, t in unique:
        w = raw(t).split()
        off = [False] * len(w)
        for s in range(len(w) - 19):
            win = b" ".join(w[s : s + 20])
            if win in seen:
                off[s : s + 20] = [True] * 20
            seen.add(win)
        want[(i, raw(t))] = (len(w), sum(off), b" ".join(x for x, o in zip(w, off, strict=True) if not o).decode())
    got = substring_dedup.substring_dedup(docs).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got) == Counter((i, *want[(i, raw(t))]) for i, t in ROWS)
    assert substring_dedup.substring_dedup(none).count() == 0
    cut = substring_dedup.dedup_column(docs)
    assert cut.columns == docs.columns and cut.count() == len(ROWS)
    by = {r.n: r for r in cut.collect()}
    assert all(by[n].text is None if t is None else by[n].text.split() == want[(i, raw(t))][2].split() for n, (i, t) in enumerate(ROWS))
    assert by[13].text == ROWS[13][1] and by[13].size == 1.5


@pytest.mark.parametrize("frequent", [5000, 2])
def test_bytes(docs, none, frequent, monkeypatch):
    monkeypatch.setattr(repeats, "FREQUENT", frequent)
    seen = Counter(x[s : s + 400] for _, x in {(i, raw(t)) for i, t in ROWS} for s in range(len(x) - 399))
    want = Counter()
    for i, t in ROWS:
        x = raw(t)
        off = np.zeros(len(x), dtype=bool)
        for s in range(len(x) - 399):
            if seen[x[s : s + 400]] > 1:
                off[s : s + 400] = True
        spans = int(np.count_nonzero(np.diff(np.concatenate([[0], off.astype(int)])) == 1))
        want[(i, len(x), int(off.sum()), spans, np.frombuffer(x, np.uint8)[~off].tobytes())] += 1
    got = suffix_dedup.suffix_dedup(docs).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, len(r.removed), bytes(r.kept)) for r in got) == want
    assert suffix_dedup.suffix_dedup(none).count() == 0


def test_frequent_words(docs, monkeypatch):
    whole = Counter(map(tuple, substring_dedup.substring_dedup(docs).collect()))
    monkeypatch.setattr(repeats, "FREQUENT", 2)
    assert Counter(map(tuple, substring_dedup.substring_dedup(docs).collect())) == whole


def test_multikey():
    r = random.Random(1)
    data = bytes(r.choice(b"ab") for _ in range(3000))
    at = np.arange(0, 2900)
    for length in (8, 11, 16):
        count = Counter(data[i : i + length] for i in at)
        tied = repeats.multikey_ties(data, at, np.zeros(len(at), np.int64), length)
        assert sorted(tied.tolist()) == [i for i in at.tolist() if count[data[i : i + length]] > 1]


def test_simhash(spark, docs, none):
    low = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))

    def mark(t):
        w = raw(t).translate(low).split()
        if not w:
            return 0
        hs = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 3]), 42) for i in range(max(1, len(w) - 2))]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))

    marks = [mark(t) for _, t in ROWS]
    group = list(range(len(ROWS)))
    for a in range(len(ROWS)):
        for b in range(a):
            if (marks[a] ^ marks[b]).bit_count() <= 3:
                group = [group[b] if g == group[a] else g for g in group]
    least = {g: min((ROWS[i][0] for i in range(len(ROWS)) if group[i] == g and ROWS[i][0] is not None), default=None) for g in group}
    got = simhash.simhash_near_dedup(docs).collect()
    assert Counter((r.doc_id, r.fp % (1 << 64), r.component_id) for r in got) == Counter((ROWS[i][0], marks[i], least[group[i]]) for i in range(len(ROWS)))
    kept = simhash.keep_one(docs, width=3)
    assert kept.columns == docs.columns and kept.count() == len(set(group))
    assert simhash.simhash_near_dedup(none).count() == 0 and simhash.keep_one(none).count() == 0


@pytest.mark.parametrize(("segments", "block", "few"), [(8, 2048, 12), (5, 2048, 12), (8, 8, 2)])
def test_links(spark, monkeypatch, segments, block, few):
    monkeypatch.setattr(simhash, "BLOCK", block)
    monkeypatch.setattr(simhash, "FEW", few)
    r = random.Random(3)
    heart = r.getrandbits(64)
    marks = {heart ^ sum(1 << b for b in r.sample(range(64), r.randrange(6))) for _ in range(60)} | {r.getrandbits(64) for _ in range(60)}
    marks = sorted(marks)

    def parts(links):
        top = {m: m for m in marks}
        for a, b in links:
            old, new = top[a], top[b]
            top = {m: new if t == old else t for m, t in top.items()}
        return {frozenset(m for m in marks if top[m] == t) for t in top.values()}

    want = parts((a, b) for a in marks for b in marks if a < b and (a ^ b).bit_count() <= 3)
    df = spark.createDataFrame([(m - (1 << 64) if m >> 63 else m,) for m in marks], "fp long")
    assert parts((x.u % (1 << 64), x.v % (1 << 64)) for x in simhash.linked(df, 3, segments).collect()) == want


def test_rules(docs, labels, none):
    out = {(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in quality_rules.judged(docs, labels).collect()}
    want = set()
    for i, t in ROWS:
        w = [x.decode() for x in raw(t).split()]
        grams = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
        rep = {k + j for k in range(len(w) - 2) if grams[tuple(w[k : k + 3])] > 1 for j in range(3)}
        lines = [x for x in (t or "").split("\n") if x.encode().split()]
        want.add((i, len(w), sum(map(len, w)), sum((t or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(rep), len(w) < 50 or 100 * len(rep) > 50 * len(w)))
    assert out == want
    good = quality_rules.keep_good(docs, labels)
    assert good.columns == docs.columns and good.count() == sum(r.kept for r in quality_rules.judged(docs, labels).collect())
    assert quality_rules.judged(none, labels).count() == 0 and quality_rules.judged(docs, labels.filter("quality > 9")).count() == len(ROWS)


def test_binomial_tail(spark):
    from math import comb, isclose, log

    for k, n, p in ((0, 10, 0.1), (3, 20, 0.05), (7, 300, 0.02)):
        got = spark.range(1).select(quality_rules.log_tail(F.lit(k).cast("long"), F.lit(n).cast("long"), p)).first()[0]
        assert isclose(got, log(sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))), abs_tol=1e-9)


def _labelled(spark, rows):
    """rows: good, stratum, holdout, symbols_per_word, loud_letters, times."""
    names = ", ".join(f"{m} double" for m in quality_rules.GRID)
    made = [(g, s, h, *[x if m == "symbols_per_word" else y if m == "loud_letters" else 0.0 for m in quality_rules.GRID]) for g, s, h, x, y, n in rows for _ in range(n)]
    return spark.createDataFrame(made, f"_good boolean, _stratum string, _holdout boolean, {names}")


def test_thresholds_need_evidence(spark):
    bad = [(False, "en", False, 2.0, 0.0, 20)]
    few = _labelled(spark, [*bad, (True, "en", False, 0.0, 0.0, 90), (True, "en", True, 0.0, 0.0, 90)])
    many = _labelled(spark, [*bad, (True, "en", False, 0.0, 0.0, 100), (True, "en", True, 0.0, 0.0, 100)])
    assert quality_rules.admitted(few).count() == 0  # 0.97 ** 90 is above 0.05, 0.97 ** 100 is not
    (rule,) = quality_rules.admitted(many).collect()
    assert (rule.stratum, rule.measure, rule.cutoff, rule.n, rule.k) == ("en", "symbols_per_word", 1.0, 100, 0)


def test_rules_are_decided_together_and_in_order(spark):
    rows = [(False, "en", False, 2.0, 0.0, 9), (False, "en", False, 0.0, 0.9, 5), (True, "en", False, 0.0, 0.0, 300), (True, "en", True, 0.0, 0.0, 300)]
    assert {(r.measure, r.k) for r in quality_rules.admitted(_labelled(spark, rows)).collect()} == {("symbols_per_word", 0), ("loud_letters", 0)}
    # The second rule rejects so many of the holdout's good texts that it fails, and what comes after it is not tried.
    worse = [*rows, (True, "en", True, 0.0, 0.9, 30)]
    assert [(r.measure, r.k) for r in quality_rules.admitted(_labelled(spark, worse)).collect()] == [("symbols_per_word", 0)]


def test_small_strata_are_pooled(spark):
    rows = [(False, "a", False, 2.0, 0.0, 9), *[(True, s, h, 0.0, 0.0, 90) for s in ("a", None) for h in (True, False)], *[(True, "en", h, 0.0, 0.0, 200) for h in (True, False)], (False, "en", False, 0.0, 0.9, 4)]
    got = {(r.stratum, r.measure, r.n) for r in quality_rules.admitted(_labelled(spark, rows)).collect()}
    assert got == {("a", "symbols_per_word", 180), (None, "symbols_per_word", 180), ("en", "loud_letters", 200)}


def test_false_rejection_keeps_its_limit(spark):
    """Over many draws a rule that rejects 6 % of good texts is admitted in at most alpha of them, for each stratum."""
    r = np.random.default_rng(6)
    rows = []
    for stratum in range(200):
        name = str(stratum)
        rows += [(False, name, False, 2.0, 0.0, 6), (True, name, False, 0.0, 0.0, 40)]
        k = int(r.binomial(400, 0.06))
        rows += [(True, name, True, 2.0, 0.0, k), (True, name, True, 0.0, 0.0, 400 - k)]
    assert quality_rules.admitted(_labelled(spark, rows)).count() == 0


def test_classifier(spark, docs, labels, none):
    r = random.Random(2)
    rows = []
    for i in range(400):
        good = i % 2
        rows.append((i, " ".join(r.choice(WORDS) + ("" if good else r.choice(["***", "$$$"])) for _ in range(60)), good))
    table = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    w = quality_classifier.train(table, table.select("doc_id", "quality"))
    got = {x.doc_id: x for x in quality_classifier.scores(table, w).withColumn("h", quality_classifier.held_out(F.col("doc_id"))).collect()}
    held = [i for i in got if got[i].h]
    assert held and all((got[i].score >= 0.7) == bool(i % 2) for i in held)
    odd = quality_classifier.scores(docs, w).collect()
    assert len(odd) == len(ROWS) and all(0 <= x.score <= 1 for x in odd)
    assert quality_classifier.scores(none, w).count() == 0
    assert not quality_classifier.train(docs, labels.filter("quality > 9")).any()


def test_shards(spark, docs, none):
    got = sharding.shards(docs, 4).collect()
    assert len(got) == len(ROWS) and Counter(r["size"] for r in got) == Counter(len(raw(t)) + 1 for _, t in ROWS)
    for s in {r.shard for r in got}:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    assert sharding.shards(none).count() == 0
    hot = spark.range(6000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "same text of many").otherwise(F.concat(F.lit("text "), F.col("id").cast("string"), F.repeat(F.lit("x"), (F.col("id") % 90).cast("int")))).alias("text"))
    out = sharding.shards(hot).groupBy("shard").agg(F.sum("size").alias("b")).collect()
    total = sum(r.b for r in out)
    assert len(out) == 8 and max(abs(r.b - total / 8) for r in out) < 0.02 * total / 8
    split = sharding.shards(hot).filter("text_crc32 <> crc32(cast('same text of many' as binary))").groupBy("text_crc32").agg(F.countDistinct("shard").alias("n")).filter("n > 1")
    assert split.count() == 0


@pytest.mark.parametrize("rule", ["majority", "start", "end"])
def test_token_counts(docs, none, rule):
    encoding, sizes = token_counts._encoding(token_counts.default_ranks())
    want = Counter()
    for i, t in ROWS:
        x = raw(t)
        starts = [0] + [k + 1 for k, c in enumerate(x) if c == 10]
        ends = starts[1:] + [len(x)]
        n, at = [0] * len(starts), 0
        for token in encoding.encode_ordinary(t or ""):
            a, b = at, at + int(sizes[token])
            held = [max(0, min(b, e) - max(a, s)) for s, e in zip(starts, ends, strict=True)]
            inside = [k for k, h in enumerate(held) if h]
            n[inside[0] if rule == "start" else inside[-1] if rule == "end" else held.index(max(held))] += 1
            at = b
        want.update((i, k, e - s, c) for k, (s, e, c) in enumerate(zip(starts, ends, n, strict=True)))
    got = token_counts.token_counts(docs, rule=rule).collect()
    assert Counter((r.doc_id, r.section, r.n_bytes, r.n_tokens) for r in got) == want
    assert token_counts.token_counts(none).count() == 0
    with pytest.raises(ValueError):
        token_counts.token_counts(docs, rule="no")


@pytest.mark.parametrize("spacing", [2, 256])
@pytest.mark.parametrize("vocabulary", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_bpe(docs, none, vocabulary, spacing):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path(vocabulary)
    whole = Tokenizer.from_file(path)
    want = Counter()
    for i, t in ROWS:
        ids = whole.encode(t or "", add_special_tokens=False).ids
        want[(i, tuple(ids), whole.decode(ids, skip_special_tokens=False))] += 1
    ids = bpe.encode(docs, path, spacing=spacing).withColumn("own", F.col("ids"))
    assert Counter((r.doc_id, tuple(r.own), r.decoded) for r in bpe.decode(ids, path).collect()) == want
    assert bpe.encode(none, path).count() == 0


def test_merges_equal_the_library():
    enc = bpe.Encoder(bpe.default_tokenizer())
    r = random.Random(4)
    parts = ["th", "er", "ing", "ción", "ü", "sch", "eau", "xé", "A", "QU", "z", "ou", "ß", "and", "É"]
    words = {("".join(r.choice(parts) for _ in range(r.randrange(1, 7))) + r.choice(["", ".", ",!", "###", "|"])).encode() for _ in range(3000)}
    fast = dict(enc.fresh(sorted(words)))
    assert enc.merger is not None and all(fast[w] == enc.many([w])[0] for w in words)


def test_decontaminate(spark, docs, none):
    r = random.Random(9)
    item = [r.choice(WORDS) for _ in range(30)]
    changed = list(item)
    changed[9], changed[20] = "odd", "odder"
    say = lambda n: [r.choice(WORDS) for _ in range(n)]
    rows = [(1, " ".join(say(20) + item + say(20))), (2, " ".join(say(9) + changed)), (3, " ".join(say(90))), (4, None), (None, " ".join(item).upper()), (6, " ".join(item[:12] + say(30)))]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(1, " ".join(item)), (2, None), (3, "too short"), (4, " ".join(item))], "item_id long, text string")
    got = {(x.doc_id, x.item_id): (x.n_equal, x.n_item_words) for x in decontaminate.overlaps(table, items).collect()}
    assert got == {(d, i): (n, 30) for d, n in ((1, 30), (2, 28), (None, 30)) for i in (1, 4)}
    assert {x.doc_id for x in decontaminate.clean(table, items).collect()} == {3, 4, 6}
    assert {(x.doc_id, x.item_id) for x in decontaminate.overlaps(table, items, most_seeds=1).collect()} == set(got), "shuffled beyond the broadcast's bound"
    assert decontaminate.clean(docs, items).columns == docs.columns and decontaminate.overlaps(none, items).count() == 0
    assert decontaminate.overlaps(table, items.filter("item_id > 9")).count() == 0


def test_licenses(docs, none):
    got = {r.doc_id: r for r in licenses.spans(docs).filter("doc_id is not null").collect()}
    assert {s.label for s in got[18].spans} == {"mit"} and {s.label for s in got[19].spans} == {"apache-2"} and not got[5].spans
    assert (got[2].n_words, got[20].n_words) == (0, 13) and got[23]._rows == 2
    assert licenses.spans(none).count() == 0


def test_license_places(spark):
    text = "Under THE MIT license; cc-by-nc 4.0. under the mit license cc by nc. " + "This is free and unencumbered new software released into the public domain"
    row = licenses.spans(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    places = sorted((s.label, s.first_word) for s in row.spans if s.base)
    assert places == [("cc-by-nc", 4), ("cc-by-nc", 13), ("mit", 0), ("mit", 9)]
    assert "unlicense" in {s.label for s in row.spans}
