"""Near-dedup by similarity: the wide SimHash ring's chains and trees against brute force."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from folioflow.llm import shingle_dedup
from folioflow.llm.fingerprints import fingerprint, ring


def _roots(n, pairs):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in pairs:
        a, b = find(i), find(j)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_ring_starts_with_the_fingerprint():
    own = np.random.default_rng(3).integers(0, 1 << 64, 600, dtype=np.uint64)
    word = ring(own).view(np.uint64)[0].tobytes()
    assert fingerprint(own.byteswap()) == int.from_bytes(word, "big", signed=True)


def test_trees_join_what_chains_join():
    """Keys with few, some and many texts; pairs by each prefix of the chain, one by one."""
    r, rows = np.random.default_rng(5), []
    for key, n in enumerate([1, 2, 9, 12, 13, 60, 256, 400]):
        base = r.integers(0, 1 << 64, (max(1, n // 6), 2), dtype=np.uint64)
        for _ in range(n):
            flips = (r.random((2, 64)) < 0.12) @ (np.uint64(1) << np.arange(64, dtype=np.uint64))
            rows.append((key, *(base[r.integers(len(base))] ^ flips.astype(np.uint64))))
    key = np.array([x[0] for x in rows], np.int32)
    chain = np.array([x[1:] for x in rows], np.uint64)
    th = r.permutation(len(rows)).astype(np.int64)
    got = shingle_dedup._trees(pa.table({"k": key, "_th": th, "c0": chain[:, 0].view(np.int64), "c1": chain[:, 1].view(np.int64)}))
    pairs = []
    for i in range(len(rows)):
        for j in np.flatnonzero(key[:i] == key[i]).tolist():
            d = np.bitwise_count((chain[i] ^ chain[j]).view(np.uint16)).tolist()
            if all(sum(d[:n]) <= (n + 1) * shingle_dedup.DISTANCE // shingle_dedup.SEGMENTS for n in range(1, 9)):
                pairs.append((i, j))
    assert len(pairs) > 300
    root = _roots(len(rows), pairs)
    trees = {x: [i for i in range(len(rows)) if root[i] == x] for x in root}
    want = {(int(key[i]), int(min(th[own])), int(th[i]), len(own)) for own in trees.values() if len(own) > 1 for i in own}
    assert {tuple(x.values()) for x in got.to_pylist()} == want and got.num_rows == len(want)


def test_components_by_brute_force(spark):
    r = random.Random(8)
    say = lambda n: [f"v{r.randrange(5000)}" for _ in range(n)]
    texts = []
    for i in range(500):
        words = say(r.randrange(52, 200))
        if i % 3 and texts:
            words = list(texts[r.randrange(len(texts))])
            for _ in range(r.randrange(0, 5)):
                words[r.randrange(len(words))] = "changed"
        texts.append(words)
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in texts]
    root = _roots(len(texts), [(i, j) for i in range(len(texts)) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])])
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(texts)], "doc_id long, text string")
    assert sorted(x.doc_id for x in shingle_dedup.keep_one(docs).collect()) == sorted(set(root))


def test_a_repeated_word_parts_no_pair(spark):
    """The similarity is that of sets, so a word that one text repeats hundreds of times changes little."""
    r = random.Random(2)
    words = [f"v{r.randrange(5000)}" for _ in range(200)]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(words + ["again"] * 300))], "doc_id long, text string")
    assert shingle_dedup.keep_one(docs).select(F.min("doc_id"), F.count("*")).first() == (1, 1)
