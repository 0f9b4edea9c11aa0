"""Sharding, the classifier and the whole pipeline against versions by brute force; the stages on odd tables."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import corpus_pipeline as P
import numpy as np
from pyspark.sql import functions as F

from folioflow.llm import bpe, quality_classifier, quality_rules, sharding
from folioflow.llm.runtime import read

SF = "/root/testdata/sf0.001"


def test_shards_of_the_table(spark):
    docs = read(spark, SF, "documents")
    rows = {r.doc_id: r.text or "" for r in docs.collect()}
    got = sharding.query(spark, SF).collect()
    assert {r.doc_id for r in got} == set(rows) and len(got) == len(rows)
    for r in got:
        raw = rows[r.doc_id].encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "bytes", None)
    total, shard = sum(r["size"] for r in got), Counter()
    for s in range(8):
        own = [r for r in got if r.shard == s]
        assert sorted(r.slot for r in own) == list(range(len(own)))
        shard[s] = sum(r["size"] for r in own)
    # A shard is off by one record, or one group of equal texts that is kept whole, at each end.
    largest = max(r["size"] for r in got)
    assert all(abs(b - total / 8) <= 2 * (largest + total / 800) for b in shard.values())


def test_scores_are_the_dot_products(spark):
    docs = read(spark, SF, "documents")
    w = quality_classifier.train(docs, read(spark, SF, "labels"))
    got = {r.doc_id: r.score for r in quality_classifier.scores(docs, w).collect()}
    for doc_id, text in [(r.doc_id, r.text or "") for r in docs.collect()]:
        raw = np.frombuffer(text.encode(), dtype=np.uint8)
        dot = w[-1]
        if len(raw):
            feature, live, n = quality_classifier.features(raw, np.array([0, len(raw)]))
            for f, c in Counter(feature[live].tolist()).items():
                dot += w[f] * c * quality_classifier.SCALE / max(1, int(n[0]))
        assert abs(got[doc_id] - 1 / (1 + np.exp(-np.clip(dot, -30, 30)))) < 1e-6


def _words(text):
    return (text or "").encode().split()


def _near(rows):
    """Least (id, text) of each group of rows that are linked at a similarity of 0.8."""
    sets = []
    for _, t in rows:
        w = (t or "").encode().translate(bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))).split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))})
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [rows[i] for i in range(len(rows)) if find(i) == i]


def _without_repeats(rows):
    seen, out = set(), []
    for i, t in rows:
        w = _words(t)
        off = [False] * len(w)
        for s in range(len(w) - 19):
            win = tuple(w[s : s + 20])
            if win in seen:
                off[s : s + 20] = [True] * 20
            seen.add(win)
        out.append((i, [x for x, o in zip(w, off, strict=True) if not o]))
    return out


def test_pipeline_by_brute_force(spark, tmp_path):
    """All five stages on small tables of its own, with ids in order, so that what comes first is plain."""
    from tokenizers import Tokenizer

    r = random.Random(12)
    say = lambda n: [f"v{r.randrange(4000)}" for _ in range(n)]
    passage, item = say(60), [f"b{i}" for i in range(24)]
    rows, labels = [], []
    for i in range(700):
        base = say(r.randrange(70, 110))
        kind = i % 10
        if kind == 1 and rows:
            base = rows[r.randrange(len(rows))][1].split()
            base[r.randrange(len(base))] = "changed" if i % 20 == 1 else base[0]
        elif kind == 2:
            base = base[:30] + passage + base[30:]
        elif kind == 3 and i % 30 == 3:
            base = base[:40] + item + base[40:]
        elif kind == 4:
            base = [w + "##" for w in base]
        elif kind == 5 and i % 20 == 5:
            base = base[:40]
        rows.append((i, " ".join(base), "en", "s", 0))
        if kind != 1:
            labels.append((i, int(kind != 4), 0))
    folder = f"file://{tmp_path}"
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality long, toxic long").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, " ".join(item))], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")

    # Texts here are clean or have two signs a word, and all of the labelled ones do as their label says.
    kept = [(i, t) for i, t, *_ in rows if len(t.split()) >= 50 and t.count("#") <= len(t.split())]
    assert quality_rules.judged(read(spark, folder, "documents"), read(spark, folder, "labels")).filter("kept").count() == len(kept)
    left = _without_repeats(_near(kept))
    left = [(i, w) for i, w in left if sum(x.startswith(b"b") for x in w) < 0.6 * len(item)]
    whole = Tokenizer.from_file(bpe.default_tokenizer())
    want = {i: whole.encode(b" ".join(w).decode(), add_special_tokens=False).ids for i, w in left}
    got = {x.doc_id: list(x.ids) for x in P.run(spark, folder).collect()}
    assert got == want


def test_stages_on_odd_tables(spark):
    """Nulls, empty texts, repeated rows, columns with clashing names, and no labels or items."""
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(None, None, "en", 1), (None, text, None, 2), (1, text, "en", 3), (1, text, "en", 3), (2, "", "de", 4), (3, text + " more", "en", 5), (4, " ".join(f"z{i}" for i in range(70)), "fr", 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, _th long").withColumn("_did", F.lit(1)).withColumn("k", F.lit("x")).withColumn("n_words", F.lit(0))
    labels, items = read(spark, SF, "labels").filter("doc_id < 0"), read(spark, SF, "benchmark").filter("item_id < 0")
    kept = quality_rules.keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.count() == 5
    one = P.near_dedup(spark, kept, SF)
    assert one.columns == docs.columns and sorted((r.doc_id is None, r.doc_id) for r in one.collect()) == [(False, 4), (True, None)]
    cut = P.substring_dedup.dedup_column(one)
    clean = P.decontaminate.clean(cut, items)
    assert clean.columns == docs.columns and clean.count() == 2
    assert P.tokens(spark, clean, SF).count() == 2
