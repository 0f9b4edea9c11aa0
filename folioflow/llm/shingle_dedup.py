"""Operator 10's links by similarity: SimHash with pigeonring filtering, then the Jaccard similarity of shingle sets.

Fingerprints of texts with a similarity of 0.8 differ in some 15 % of their bits.  Within so many of 64 bits the
ring's segments give no selective key, so the fingerprint is wider: WORDS * 64 bits over the text's distinct shingles,
in a ring of 16-bit segments.  Candidates: an equal segment is a join key and the start of a chain; the chain's
segments must keep the ring's budgets for DISTANCE bits (three and a half a segment), and under one key the trees of
what does are returned.  Then pairs must be within DISTANCE over the whole ring, and are linked if their shingle
sets, compared whole by 32 bits of each XXH64, have a similarity of ``least`` or more.  Shingles are of ``width``
words (a shorter text is one).

A chain may start at a segment that isn't equal, so a pair is found with a chance: at 0.8 a segment is equal in 7 %
of all cases, and one of the ring's 112 chains does in some 99.97 %; more above 0.8, less for texts of few shingles.

Each text is held against the centre of its trees first, the text with most neighbours.  What is in one component
then needs no pair more; in each tree all other pairs are held too, block against block within a task, which
returns only links: a pair is compared under its first common chain, and a text once it is linked to a component is
not held against more of it.  So components are those of all candidates.
Texts of one xxhash64 are one text; rows that repeat an id and a text are one document.  Null texts are empty;
empty texts are alike; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.llm.components import stars
from folioflow.llm.fingerprints import WORDS, budgets, chains, keeps, ring, shingle_hashes
from folioflow.llm.runtime import durable, keyed, small_batches, texts_of, tidy

LEAST = 0.8
SEGMENTS = WORDS * 4
#: Bits of the ring that candidates may differ in; the mean at a similarity of 0.8 is 272, over seven deviations below.
DISTANCE = SEGMENTS * 7 // 2
#: Segments after its start that a chain is held against under its key: 128 bits.
CHAIN = 8
MOST = budgets(SEGMENTS, DISTANCE)
#: Under a key, texts are compared pair by pair while there are few, as one matrix up to SOME, by a search beyond.
FEW, SOME = 12, 256
#: Texts of a tree that a task compares at once; more are dealt out in blocks of so many.
BLOCK = 256


def shingles(text: bytes, width: int) -> np.ndarray:
    """Distinct hashes of the text's shingles, sorted; of a text without words that of the empty one."""
    own = shingle_hashes(text, width)
    return np.unique(own) if len(own) else np.array([xxhash.xxh64_intdigest(b"", 42)], dtype=np.uint64)


def packed(own: np.ndarray) -> np.ndarray:
    """The upper half of each hash, which is what travels: two shingles of a pair of n fall together with chance n * n / 2**33."""
    return np.unique((own >> np.uint64(32)).astype(np.uint32))


def _texts(batch: pa.RecordBatch) -> Iterator[bytes]:
    buf, offs = texts_of(batch.column("_text"))
    raw = memoryview(buf)
    for a, b in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True):
        yield bytes(raw[a:b])


def _rings(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = pa.array([ring(shingles(text, width)).tobytes() for text in _texts(batch)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("_did"), batch.column("_th"), made], ["_did", "_th", "_ring"])

    return run


def _segments(column: pa.Array) -> np.ndarray:
    return np.array([np.frombuffer(x.as_buffer(), dtype=np.uint16) for x in column], dtype=np.uint16).reshape(-1, SEGMENTS)


def _chains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each segment with its number as the key of the chain after it."""
    number = np.arange(SEGMENTS, dtype=np.int32) << 16
    for batch in batches:
        own = _segments(batch.column("_ring"))
        chain = np.ascontiguousarray(chains(own, CHAIN)).reshape(-1, CHAIN).view(np.int64)
        th = np.repeat(batch.column("_th").to_numpy(), SEGMENTS)
        parts = [pa.array(x) for x in ((number | own).astype(np.int32).reshape(-1), th, chain[:, 0], chain[:, 1])]
        yield pa.RecordBatch.from_arrays(parts, ["k", "_th", "c0", "c1"])


def _near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which chains keep their budgets, by the last one first; a and b: rows of CHAIN segments as two words."""
    diff = a ^ b
    hit = np.bitwise_count(diff).sum(axis=1) <= MOST[CHAIN + 1]
    at = np.flatnonzero(hit)
    hit[at] = keeps(np.bitwise_count(diff[at].view(np.uint16)), MOST)
    return hit


def _joined(chain: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows that are near under one key; what they connect is what all near pairs connect."""
    group, us, vs = np.repeat(np.arange(len(size)), size), [], []
    few = np.repeat(size <= FEW, size)
    for d in range(1, min(FEW, len(chain))):
        i = np.flatnonzero(few[:-d] & (group[:-d] == group[d:]))
        i = i[_near(chain[i], chain[i + d])]
        us.append(i)
        vs.append(i + d)
    for a, n in zip(first[size > FEW].tolist(), size[size > FEW].tolist(), strict=True):
        own = chain[a : a + n]
        if n <= SOME:
            bits = sum(np.bitwise_count(own[:, None, w] ^ own[:, w]) for w in (0, 1))
            i, j = np.nonzero(np.triu(bits <= MOST[CHAIN + 1], 1))
            hit = _near(own[i], own[j])
            us.append(a + i[hit])
            vs.append(a + j[hit])
            continue
        left = np.arange(n)
        while len(left):
            queue, left = [left[0]], left[1:]
            while queue and len(left):
                x = queue.pop()
                hit = _near(own[left], own[x])
                found, left = left[hit], left[~hit]
                us.append(np.full(len(found), a + x))
                vs.append(a + found)
                queue += found.tolist()
    return tuple(np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64) for x in (us, vs))


def _trees(t: pa.Table) -> pa.RecordBatch:
    """k, least, _th and n: the rows of each tree of two or more, their least hash and their number."""
    key, th = t.column("k").to_numpy(), t.column("_th").to_numpy()
    chain = np.stack([t.column(c).to_numpy().view(np.uint64) for c in ("c0", "c1")], axis=1)
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    u, v = _joined(chain, first, np.diff(np.append(first, len(key))))
    root, last = np.arange(len(key)), None
    while last is None or (root != last).any():
        last = root.copy()
        least = np.minimum(root[u], root[v])
        for x in (u, v, last[u], last[v]):
            np.minimum.at(root, x, least)
        root = root[root]
    n = np.bincount(root, minlength=len(key))
    low = th.copy()
    np.minimum.at(low, root, th)
    at = np.flatnonzero(n[root] > 1)
    parts = [pa.array(x) for x in (key[at], low[root[at]], th[at], n[root[at]].astype(np.int64))]
    return pa.RecordBatch.from_arrays(parts, ["k", "least", "_th", "n"])


def _by_key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []
    rows, full = 0, 1 << 16
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows < full:
            continue
        table = pa.Table.from_batches(held)
        key = table.column("k").to_numpy()
        cut = int(np.searchsorted(key, key[-1]))
        if cut:
            yield _trees(table.slice(0, cut))
        held = table.slice(cut).combine_chunks().to_batches()
        rows -= cut
        full = max(1 << 16, 2 * rows)
    if rows:
        yield _trees(pa.Table.from_batches(held))


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [shingles(text, width) for text in _texts(batch)]
            made = [pa.array(x, pa.binary()) for x in ([packed(x).tobytes() for x in own], [ring(x).tobytes() for x in own])]
            yield pa.RecordBatch.from_arrays([batch.column("_th"), *made], ["_th", "_set", "_ring"])

    return run


def _within(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(axis=-1) <= DISTANCE


def _verified(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = _within(_segments(batch.column("_ra")), _segments(batch.column("_rb")))
            for i in np.flatnonzero(hit).tolist():
                hit[i] = _alike(*(np.frombuffer(batch.column(c)[i].as_buffer(), dtype=np.uint32) for c in ("_a", "_b")), least)
            yield batch.select(["u", "v"]).filter(pa.array(hit, pa.bool_()))

    held = pairs.join(sets.select(F.col("_th").alias("v"), F.col("_set").alias("_b"), F.col("_ring").alias("_rb")), "v")
    held = held.join(sets.select(F.col("_th").alias("u"), F.col("_set").alias("_a"), F.col("_ring").alias("_ra")), "u")
    return held.select("u", "v", "_a", "_b", "_ra", "_rb").mapInArrow(tidy(run), "u long, v long")


def _alike(x: np.ndarray, y: np.ndarray, least: float) -> bool:
    if min(len(x), len(y)) < least * max(len(x), len(y)):
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both >= least * (len(x) + len(y) - both)


def _first_chain(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The first segment that is equal and starts a chain within the budgets, of each row of a against b; -1 without."""
    diff = np.bitwise_count(a ^ b)
    live = (diff == 0) & keeps(chains(diff, CHAIN), MOST)
    return np.where(live.any(axis=1), live.argmax(axis=1), -1)


def _linked(t: pa.Table, least: float) -> list[tuple[int, int]]:
    """Links between rows of different roots, of a pair of blocks of one tree, with at least one row of the rest."""
    th, root, block, band = (t.column(c).to_numpy() for c in ("_th", "root", "block", "band"))
    rest = t.column("rest").to_numpy(zero_copy_only=False)
    rings = _segments(t.column("_ring").combine_chunks())
    sets = [np.frombuffer(s.as_buffer(), dtype=np.uint32) for s in t.column("_set")]
    size = np.array([len(s) for s in sets])
    at, two = np.arange(len(th)), block.min() != block.max()
    links = []
    for i in np.flatnonzero(rest).tolist():
        live = (root != root[i]) & (~rest | (at > i)) & ((block != block[i]) if two else True)
        live &= np.minimum(size, size[i]) >= least * np.maximum(size, size[i])
        js = np.flatnonzero(live)
        js = js[_within(rings[js], rings[i])]
        js = js[_first_chain(rings[js], rings[i]) == band[i]]
        met: set[int] = set()
        for j in js.tolist():
            if root[j] not in met and _alike(sets[i], sets[j], least):
                met.add(root[j])
                links.append((min(th[i], th[j]), max(th[i], th[j])))
    return links


def _blocks(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(t: pa.Table) -> pa.RecordBatch:
            pairs = sorted(set(_linked(t, least)))
            return pa.RecordBatch.from_arrays([pa.array([int(p[i]) for p in pairs], pa.int64()) for i in (0, 1)], ["u", "v"])

        held: list[pa.RecordBatch] = []
        at = None
        for batch in batches:
            k, part = batch.column("k").to_numpy(), batch.column("part").to_numpy()
            cuts = np.flatnonzero((k[1:] != k[:-1]) | (part[1:] != part[:-1])) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(k)], strict=True):
                if b > a:
                    if held and at != (k[a], part[a]):
                        yield made(pa.Table.from_batches(held))
                        held = []
                    at = (k[a], part[a])
                    held.append(batch.slice(a, b - a))
        if held:
            yield made(pa.Table.from_batches(held))

    return run


def _more(labelled: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Links (u, v) between texts of different roots in one tree; labelled: k, band, _th, root."""
    most = labelled.groupBy("k", "root").count().groupBy("k").agg(F.max(F.struct("count", "root")).alias("m"), F.count("*").alias("n"), F.sum("count").alias("size"))
    own = labelled.join(most.filter("n > 1").select("k", F.col("m.root").alias("most"), "size"), "k")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    block = F.when(F.col("size") <= 2 * BLOCK, 0).otherwise(F.pmod(F.xxhash64("_th"), blocks)).cast("int")
    own = own.select("k", "band", "_th", "root", (F.col("root") != F.col("most")).alias("rest"), block.alias("block"), F.when(F.col("size") <= 2 * BLOCK, 1).otherwise(blocks).alias("blocks"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    own = own.select("*", other).withColumn("part", F.least("block", "other") * 65536 + F.greatest("block", "other"))
    dealt = own.join(sets, "_th").select("k", "part", "band", "_th", "root", "rest", "block", "_set", "_ring")
    n = max(int(labelled.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    dealt = dealt.repartition(n, "k", "part").sortWithinPartitions("k", "part")
    return dealt.mapInArrow(tidy(_blocks(least)), "u long, v long").distinct()


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, least: float = LEAST) -> DataFrame:
    """_did, _th and component of each row: the least text hash of its component."""
    small_batches(docs.sparkSession)
    own = keyed(docs, id_col, text_col)
    rows = durable(own.select("_did", "_th", "_text").mapInArrow(tidy(_rings(width)), "_did long, _th long, _ring binary"))
    dealt = rows.select("_th", "_ring").dropDuplicates(["_th"]).mapInArrow(tidy(_chains), "k int, _th long, c0 long, c1 long")
    n = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    dealt = dealt.repartition(n, "k").sortWithinPartitions("k").mapInArrow(tidy(_by_key), "k int, least long, _th long, n long")
    shared = durable(dealt.select(F.xxhash64("k", "least").alias("k"), F.shiftright("k", 16).alias("band"), "_th", "n"))
    near = shared.groupBy("_th").agg(F.sum("n").alias("near"))
    members = durable(shared.join(near, "_th").select("k", "band", "_th", "near"))
    texts = own.select("_th", "_text").join(near.select("_th"), "_th", "left_semi")
    sets = durable(texts.mapInArrow(tidy(_sets(width)), "_th long, _set binary, _ring binary").groupBy("_th").agg(F.first("_set").alias("_set"), F.first("_ring").alias("_ring")))
    centre = members.groupBy("k").agg(F.max(F.struct("near", "_th")).alias("m")).select("k", F.col("m._th").alias("b"))
    first = members.join(centre, "k").filter("_th <> b").select(F.least("_th", "b").alias("u"), F.greatest("_th", "b").alias("v"))
    first = durable(first.distinct())
    star = stars(durable(_verified(first, sets, least)))
    root = star.select(F.col("u").alias("_th"), F.col("v").alias("_root"))
    labelled = durable(members.join(root, "_th", "left").select("k", "band", "_th", F.coalesce("_root", "_th").alias("root")))
    more = durable(_more(labelled, sets, least))
    if not more.isEmpty():
        root = stars(star.unionByName(more)).select(F.col("u").alias("_th"), F.col("v").alias("_root"))
    return rows.select("_did", "_th").join(root, "_th", "left").select("_did", "_th", F.coalesce("_root", "_th").alias("component"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, least: float = LEAST) -> DataFrame:
    """``simhash.keep_one`` with links by similarity."""
    from folioflow.llm import simhash

    return simhash.keep_one(docs, id_col, text_col, width, least=least)
