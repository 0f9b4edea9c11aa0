"""Operator 10, SimHash near-dedup with pigeonring filtering.

Texts are lower-cased (A-Z), words are runs of ``[^\\x20\\x09-\\x0D]``, shingles are of ``width`` words with
repeats (a shorter text is one shingle, an empty or null one has fingerprint zero).  A bit is 1 if it is set
in over half the shingles' XXH64 (seed 42).  Fingerprints are linked at ``distance`` or fewer differing bits.

Candidates: the 64 bits are cut in a ring of segments.  If two fingerprints differ in at most d bits, some
chain of consecutive segments has, for each of its lengths l, at most floor(l * d / segments) differences.
The first segments of such a chain are equal but for the few that the budget allows, which gives the join
keys; pairs under one key are then held against the chain's budgets before the full count of bits.

Distinct fingerprints are compared, not documents, so copies cost nothing.  Under one key, a tree of links
is returned and not all pairs; keys with very many fingerprints are compared block against block.  A null id
takes no part in the choice of the least id; rows that repeat an id are rows of their own.  An empty table
gives an empty result.  Other columns, whatever their names, are carried by ``keep_one`` alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioflow.llm import shingle_dedup
from folioflow.llm.components import stars
from folioflow.llm.fingerprints import bounds, budgets, fingerprint, shingle_hashes
from folioflow.llm.runtime import durable, keyed, read, small_batches, texts_of, tidy

#: Fingerprints under one key that a task compares at once; more are dealt out in blocks of half as many.
BLOCK = 2048
#: Keys with so few fingerprints are compared pair by pair.
FEW = 12
#: First bit of a key's number; its segments have fewer bits.
NUMBER = 44


def _fingerprints(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, offs = texts_of(batch.column("_text"))
            raw = memoryview(buf)
            made = [fingerprint(shingle_hashes(bytes(raw[a:b]), width)) for a, b in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True)]
            rest = [batch.column(c) for c in ("doc_id", "_did", "_th")]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(made, pa.int64())], ["doc_id", "_did", "_th", "fp"])

    return run


def patterns(segments: int, distance: int) -> list[tuple[int, ...]]:
    """Which segments after a chain's start are equal: for the longest prefix whose budget is one difference."""
    most = budgets(segments, distance)
    prefix = max(n for n in range(1, segments + 1) if most[n] <= 1)
    if not most[prefix]:
        return [tuple(range(prefix))]
    free = [c for c in range(prefix) if most[c + 1] >= 1]
    return [tuple(i for i in range(prefix) if i != c) for c in free]


def _segment_keys(segments: int, distance: int) -> list[tuple[int, Column]]:
    """The start and the key of each chain start and pattern; the key holds its own number from bit NUMBER on."""
    parts, made = bounds(segments), []
    for start in range(segments):
        for pattern in patterns(segments, distance):
            key = F.lit(0).cast("long")
            for i in pattern:
                shift, width = parts[(start + i) % segments]
                key = F.shiftleft(key, width).bitwiseOR(F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit((1 << width) - 1)))
            made.append((start, key.bitwiseOR(F.lit(len(made) << NUMBER).cast("long"))))
    return made


def _near(a: np.ndarray, b: np.ndarray, start: int, segments: int, distance: int) -> np.ndarray:
    """Whether each pair is a link, by the chain's budgets first; a and b are broadcast."""
    diff, most, parts = a ^ b, budgets(segments, distance), bounds(segments)
    live = np.ones(diff.shape, dtype=bool)
    mask = np.uint64(0)
    for n in range(1, segments + 1):
        shift, width = parts[(start + n - 1) % segments]
        mask |= np.uint64(((1 << width) - 1) << shift)
        if n == segments or n >= 3:
            at = np.flatnonzero(live)
            if not len(at):
                break
            live.flat[at] = np.bitwise_count(diff.flat[at] & mask) <= most[n]
    return live


def _tree(fps: np.ndarray, start: int, segments: int, distance: int) -> list[tuple[int, int]]:
    """Links that join what is connected among fps: each row looks once for rows not reached yet."""
    left, links = np.arange(len(fps)), []
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            x = queue.pop()
            hit = _near(fps[left], fps[x], start, segments, distance)
            found = left[hit]
            links += [(x, y) for y in found.tolist()]
            queue += found.tolist()
            left = left[~hit]
    return links


def _link(starts: list[int], segments: int, distance: int):
    def solve(t: pa.Table) -> pa.RecordBatch:
        key, part, fp = (t.column(c).to_numpy() for c in ("k", "part", "fp"))
        fp = fp.view(np.uint64)
        new = np.concatenate([[True], (key[1:] != key[:-1]) | (part[1:] != part[:-1])])
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, len(key)))
        begin = np.array(starts)[np.repeat(key[first] >> NUMBER, size)]
        few = np.repeat(size <= FEW, size)
        group = np.cumsum(new)
        us, vs = [], []
        for d in range(1, FEW):
            i = np.flatnonzero(few[:-d] & (group[:-d] == group[d:])) if len(key) > d else np.zeros(0, np.int64)
            for s in range(segments) if len(i) else ():
                own = i[begin[i] == s]
                own = own[_near(fp[own], fp[own + d], s, segments, distance)]
                us.append(fp[own])
                vs.append(fp[own + d])
        for a, n in zip(first[size > FEW].tolist(), size[size > FEW].tolist(), strict=True):
            own = fp[a : a + n]
            if links := _tree(own, int(begin[a]), segments, distance):
                i, j = np.array(links).T
                us.append(own[i])
                vs.append(own[j])
        u, v = (np.concatenate(x) if x else np.zeros(0, np.uint64) for x in (us, vs))
        pair = np.unique(np.stack([u, v], axis=1), axis=0) if len(u) else np.zeros((0, 2), np.uint64)
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(pair[:, i]).view(np.int64)) for i in (0, 1)], ["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows < 1 << 16:
                continue
            table = pa.Table.from_batches(held)
            key = table.column("k").to_numpy()
            part = table.column("part").to_numpy()
            other = (key != key[-1]) | (part != part[-1])
            if other.any():
                cut = int(np.flatnonzero(other)[-1]) + 1
                yield solve(table.slice(0, cut))
                held = table.slice(cut).combine_chunks().to_batches()
                rows = table.num_rows - cut
        if rows:
            yield solve(pa.Table.from_batches(held))

    return run


def linked(fps: DataFrame, distance: int = 3, segments: int = 8) -> DataFrame:
    """Links (u, v) between distinct fingerprints (column fp); what they connect is what all pairs connect."""
    made = _segment_keys(segments, distance)
    keys = fps.select("fp", F.explode(F.array(*[k for _, k in made])).alias("k"))
    size = keys.groupBy("k").agg(F.count("*").alias("n")).filter("n > 1")
    # Of a key with more than BLOCK fingerprints, each block meets each: a row goes to as many parts as there are blocks.
    blocks = F.ceil(F.col("n") * 2 / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("fp"), blocks).cast("int")
    parts = F.transform(F.sequence(F.lit(0), blocks - 1), lambda j: F.least(j, own) * 65536 + F.greatest(j, own))
    part = F.explode(F.when(F.col("n") <= BLOCK, F.array(F.lit(0))).otherwise(parts)).alias("part")
    dealt = keys.join(size, "k").select("k", "fp", part)
    n = max(int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    dealt = dealt.repartition(n, "k", "part").sortWithinPartitions("k", "part", "fp")
    return dealt.mapInArrow(tidy(_link([s for s, _ in made], segments, distance)), "u long, v long").distinct()


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, distance: int = 3, segments: int = 8) -> DataFrame:
    """doc_id, _did, _th, fp and component of each row: the least fingerprint of its component."""
    small_batches(docs.sparkSession)
    own = keyed(docs, id_col, text_col)
    rows = durable(own.mapInArrow(tidy(_fingerprints(width)), "doc_id long, _did long, _th long, fp long"))
    star = stars(linked(rows.select("fp").distinct(), distance, segments))
    root = star.select(F.col("u").alias("fp"), F.col("v").alias("_root"))
    return rows.join(root, "fp", "left").withColumn("component", F.coalesce("_root", "fp")).drop("_root")


def simhash_near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, distance: int = 3, segments: int = 8) -> DataFrame:
    """doc_id, fp and component_id, the least id of its component, of each row."""
    rows = simhash_groups(docs, id_col, text_col, width, distance, segments)
    # Least ids meet by fingerprint first, so a component of many copies is a few rows.
    marks = rows.groupBy("fp", "component").agg(F.min("doc_id").alias("_least"))
    least = marks.groupBy("component").agg(F.min("_least").alias("component_id"))
    return rows.join(marks.join(least, "component").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, distance: int = 3, segments: int = 8, least: float | None = None) -> DataFrame:
    """docs, all columns, with the first document of each component; of rows that repeat it, one.

    With ``least``, texts are linked from that similarity of their shingles on (see shingle_dedup), and ``distance``
    is of no account.  The first document is the one with the least id, of these the one with the least text hash;
    a null id comes first.
    """
    if least is None:
        rows = simhash_groups(docs, id_col, text_col, width, distance, segments)
    else:
        rows = shingle_dedup.groups(docs, id_col, text_col, width, least)
    first = rows.groupBy("component").agg(F.min(F.struct("_did", "_th")).alias("f")).select("f._did", "f._th")
    key = F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(-(1 << 63)))
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), key.alias("_did"), F.xxhash64(text).alias("_th"))
    kept = own.join(first, ["_did", "_th"], "left_semi")
    kept = kept.withColumn("_n", F.row_number().over(Window.partitionBy("_did", "_th").orderBy("_did"))).filter("_n = 1")
    return kept.select(*[F.col("_row").getField(c).alias(c) for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = simhash_near_dedup(read(spark, sf_dir, "documents"))
    return done.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
