"""Operator 3, quality classifier: logistic regression on hashed word n-grams, trained by FTRL-proximal.

Tokens are runs of letters and digits, and runs of one other sign.  Features are hashed single tokens and
pairs (lower case), and pairs of shapes: whether a token is in capitals, a sign, long, the same as the token
before or the one before that.  A feature's value is its share of the text's tokens times ``SCALE``.  The
model is a vector of 2 ** BITS weights, so its broadcast has a fixed size; a score is a sparse dot product.

Only rows whose crc32 of the id's decimal digits is not 2 modulo 4 teach.  At most ``most_rows`` of them, those
with the least hashes of their ids, are used (the documented bound; their whole texts are); one task updates the
weights from their sparse rows in a fixed order.  Labels, lang, source and ids are no inputs of a score.
A null id is not held out and teaches nothing; null labels are left out; a null or empty text has only the bias;
with no labels at all every score is 0.5; an empty table gives an empty result.  Rows that repeat an id are scored
each and teach each; repeated labels of an id teach once, as bad if they disagree; ties in the order of teaching go
by id; very long texts are read whole; other columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.llm.hashing import SPACE, Rolling, mix
from folioflow.llm.runtime import longs, pieces, read, small_batches, texts_of

BITS, SCALE = 18, 8.0
MOST_ROWS = 12_000
HELD_OUT = 2

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LETTER = np.zeros(256, dtype=bool)
_LETTER[48:58] = _LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_UPPER = np.zeros(256, dtype=np.int64)
_UPPER[65:91] = 1
_SMALL = np.zeros(256, dtype=np.int64)
_SMALL[97:123] = 1


def features(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed features (three rows: tokens, pairs, shape pairs), a mask of those that count, tokens per text."""
    kind = np.where(_LETTER[buf], np.uint8(1), buf)
    edge = np.zeros(len(buf) + 1, dtype=bool)
    edge[offs] = True
    starts = np.empty(len(buf), dtype=bool)
    starts[:1] = True
    starts[1:] = kind[1:] != kind[:-1]
    start = np.flatnonzero((starts | edge[:-1]) & ~SPACE[buf])
    ends = np.append(np.flatnonzero(starts | edge[:-1]), len(buf))
    stop = ends[np.searchsorted(ends, start, "right")]
    word = Rolling(_LOWER[buf]).spans(start, stop)
    doc = np.searchsorted(offs, start, "right") - 1
    upper = np.concatenate([[0], np.cumsum(_UPPER[buf])])
    small = np.concatenate([[0], np.cumsum(_SMALL[buf])])
    size = stop - start
    caps = (upper[stop] - upper[start] > 1) & (small[stop] == small[start])
    sign = ~_LETTER[buf[start]]
    shape = np.where(sign, 8 + (buf[start].astype(np.int64) << 8), caps * 1 + (size > 14) * 2 + (size > 24) * 4).astype(np.uint64)
    before = np.zeros(len(word), dtype=bool)
    before[1:] = doc[1:] == doc[:-1]
    again = np.zeros(len(word), dtype=bool)
    again[1:] = before[1:] & (word[1:] == word[:-1])
    second = np.zeros(len(word), dtype=bool)
    second[2:] = (doc[2:] == doc[:-2]) & (word[2:] == word[:-2])
    shape |= (again.astype(np.uint64) << np.uint64(16)) | (second.astype(np.uint64) << np.uint64(17))
    last, last_shape = np.roll(word, 1), np.roll(shape, 1)
    three = np.stack([mix(word + np.uint64(1)), mix(word * np.uint64(3) + last), mix(shape * np.uint64(0x10001) + (last_shape << np.uint64(24)) + np.uint64(7))])
    live = np.stack([np.ones(len(word), dtype=bool), before, before])
    return (three & np.uint64((1 << BITS) - 1)).astype(np.int64), live, np.bincount(doc, minlength=len(offs) - 1)


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each labelled text its sparse row: distinct features and their values."""
    for batch in batches:
        buf, offs = texts_of(batch.column("_text"))
        idx, val = [], []
        for a, b in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True):
            feature, live, n = features(buf[a:b], np.array([0, b - a])) if b > a else (np.zeros(0, np.int64), np.zeros(0, bool), [1])
            f, c = np.unique(feature[live], return_counts=True)
            idx.append(f)
            val.append(c * (SCALE / max(1, int(n[0]))))
        lists = [pa.array(x, pa.list_(k)) for x, k in ((idx, pa.int64()), (val, pa.float64()))]
        yield pa.RecordBatch.from_arrays([batch.column("_order"), batch.column("quality"), *lists], ["_order", "quality", "idx", "val"])


def _train(epochs: int, alpha: float, beta: float, l1: float, l2: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            rows += zip(
                longs(batch.column("_order")).tolist(), longs(batch.column("quality")).tolist(),
                (x.values.to_numpy() for x in batch.column("idx")), (x.values.to_numpy() for x in batch.column("val")), strict=True,
            )
        bias = 1 << BITS
        z, n = np.zeros(bias + 1), np.zeros(bias + 1)
        draw = np.random.default_rng(7)
        rows.sort(key=lambda r: r[:2])
        for _ in range(epochs):
            for i in draw.permutation(len(rows)).tolist():
                _, y, f, x = rows[i]
                f, x = np.append(f, bias), np.append(x, 1.0)
                w = _weights(z[f], n[f], alpha, beta, l1, l2)
                g = (1 / (1 + np.exp(-np.clip(w @ x, -30, 30))) - y) * x
                root = np.sqrt(n[f])
                n[f] += g * g
                z[f] += g - (np.sqrt(n[f]) - root) / alpha * w
        w = _weights(z, n, alpha, beta, l1, l2)
        at = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int64)), pa.array(w[at])], ["f", "w"])

    return run


def _weights(z: np.ndarray, n: np.ndarray, alpha: float, beta: float, l1: float, l2: float) -> np.ndarray:
    return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2))


def held_out(doc: Column) -> Column:
    return F.coalesce(F.crc32(doc.cast("string").cast("binary")) % 4 == HELD_OUT, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, most_rows: int = MOST_ROWS, epochs: int = 4, alpha: float = 0.3, beta: float = 1.0, l1: float = 0.02, l2: float = 0.01, id_col: str = "doc_id", text_col: str = "text") -> np.ndarray:
    """The weights, the bias last."""
    small_batches(docs.sparkSession)
    taught = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("_id")).agg(F.min("quality").cast("long").alias("quality"))
    taught = taught.filter(~held_out(F.col("_id"))).withColumn("_order", F.xxhash64("_id", F.lit("teach"))).orderBy("_order", "_id").limit(most_rows)
    text = docs.select(F.col(f"`{id_col}`").cast("long").alias("_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("_text"))
    rows = text.join(F.broadcast(taught), "_id").select("_order", "quality", "_text")  # at most most_rows rows of three longs
    rows = rows.mapInArrow(_sparse, "_order long, quality long, idx array<long>, val array<double>")
    got = rows.repartition(1).mapInArrow(_train(epochs, alpha, beta, l1, l2), "f long, w double").toArrow()
    w = np.zeros((1 << BITS) + 1)
    w[got.column("f").to_numpy()] = got.column("w").to_numpy()
    return w


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        for batch in batches:
            buf, offs = texts_of(batch.column("_text"))
            dots = np.zeros(len(offs) - 1)
            for lo, hi in pieces(offs):
                own = buf[offs[lo] : offs[hi]]
                if len(own):
                    at = offs[lo : hi + 1] - offs[lo]
                    feature, live, n = features(own, at)
                    sums = np.concatenate([[0.0], np.cumsum((w[:-1][feature] * live).sum(axis=0))])
                    bounds = np.concatenate([[0], np.cumsum(n)])
                    dots[lo:hi] = (sums[bounds[1:]] - sums[bounds[:-1]]) * (SCALE / np.maximum(n, 1))
            score = 1 / (1 + np.exp(-np.clip(dots + w[-1], -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score)], ["doc_id", "score"])

    return run


def scores(docs: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score of each row."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(weights)
    own = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("_text"))
    return own.mapInArrow(_score(shared), "doc_id long, score double")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    done = scores(docs, train(docs, read(spark, sf_dir, "labels")))
    return done.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
