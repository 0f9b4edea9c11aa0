"""Exact search for windows that occur more than once, shared by the two substring operators.

A window (20 words, or 400 bytes) has an anchor: the place with the least hash among the first places of
the window whose core (7 words, or 200 bytes) lies inside it.  Equal windows have equal anchors at equal
distances, so consecutive windows with one anchor travel as one packed string.

1. Cores are counted over all documents.  A window whose core occurs once cannot repeat.  Cores that occur
   twice or more are marked in a bit set of bounded size; a false mark costs time only.
2. Packed strings with a marked core go to a bucket.  Equal strings within one task meet there already: one
   of them travels, so a passage that a third of all documents share makes one string a task.  Cores that
   are very frequent with different surroundings are marked too; their windows travel one by one under
   their own hash, so no bucket grows with one passage.
3. A bucket sorts its strings and compares bytes.  It returns ranges of repeated window starts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.llm.hashing import Rolling, anchors, word_spans
from folioflow.llm.runtime import durable, longs, pieces, small_batches, texts_of, tidy

#: Bytes of packed strings that a bucket batch holds before it is sorted.
BATCH_BYTES = 1 << 20
#: Occurrences from which a core's windows travel one by one.
FREQUENT = 5000
#: So frequent cores that travel to the workers as an array.
MOST_FREQUENT = 1_000_000
#: The bit sets' size: eight bits for each repeated core, within these bounds.
LEAST_BITS, MOST_BITS = 1 << 16, 1 << 30
#: Digests that a task remembers; beyond it forgets them, and the buckets find what it missed.
REMEMBERED = 400_000

CORES = "core long, n long, lead long"
STRINGS = "core long, lead long, did long, th long, start long, run int, shift int, kind int, body binary"
RANGES = "_did long, _th long, start long, stop long"
_PACKED, _RANGE, _DIGEST, _SINGLE = 0, 1, 2, 3


class View:
    """One piece of the corpus in units: bounds of documents, a sort hash per place, hashes of cores, strings."""

    def __init__(self, bounds: np.ndarray, order: np.ndarray):
        self.bounds, self.order = bounds, order


class Words:
    """Windows of words; strings are words joined by one space; a repeat is a start after the first one."""

    window, core, first_stays = 20, 7, True
    choices = window - core + 1

    @staticmethod
    def view(buf: np.ndarray, offs: np.ndarray) -> View:
        raw = buf[offs[0] : offs[-1]].tobytes()
        at = (offs - offs[0]).tolist()
        texts = [b" ".join(raw[a:b].split()) for a, b in zip(at[:-1], at[1:], strict=True)]
        data = b" ".join(texts)
        ends = np.cumsum([len(t) + 1 for t in texts])
        joined = np.frombuffer(data, dtype=np.uint8)
        start, stop = word_spans(joined, np.array([0, len(joined)]))
        bounds = np.searchsorted(start, np.concatenate([[0], ends]))
        view = View(bounds, Rolling(Rolling(joined).spans(start, stop)).fixed(Words.core))
        view.cut = lambda a, b: data[start[a] : stop[b - 1]]
        view.cores = lambda places: view.order[places]
        view.lead = lambda places: np.zeros(len(places), dtype=np.int64)
        return view

    @staticmethod
    def single(text: bytes) -> tuple[int, bytes]:
        return _PACKED, text


class Bytes:
    """Windows of UTF-8 bytes; strings are bytes; every start of a string that occurs twice is a repeat."""

    window, core, first_stays = 400, 200, False
    gram, choices = 16, window - core + 1

    @staticmethod
    def view(buf: np.ndarray, offs: np.ndarray) -> View:
        own = buf[offs[0] : offs[-1]]
        rolling = Rolling(own)
        view = View(offs - offs[0], rolling.fixed(Bytes.gram))
        data = own.tobytes()
        view.cut = lambda a, b: data[a:b]
        view.cores = lambda places: rolling.spans(places, places + Bytes.core)
        eight = np.ndarray(max(0, len(own) - 7), dtype=">u8", buffer=data, strides=(1,))
        view.lead = lambda places: (eight[places].astype(np.uint64) >> np.uint64(1)).astype(np.int64)
        return view

    @staticmethod
    def single(text: bytes) -> tuple[int, bytes]:
        return _DIGEST, hashlib.blake2b(text, digest_size=16).digest()


def _views(batch: pa.RecordBatch, kind: type):
    buf, offs = texts_of(batch.column("_text"))
    for lo, hi in pieces(offs):
        view = kind.view(buf, offs[lo : hi + 1])
        yield lo, view, anchors(view.order, view.bounds, kind.window, kind.choices)


def _count_cores(kind: type):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cores, leads = [], []
            for _, view, (_, _, place) in _views(batch, kind):
                cores.append(view.cores(place))
                leads.append(view.lead(place))
            if cores:
                core, first, n = np.unique(np.concatenate(cores), return_index=True, return_counts=True)
                lead = np.concatenate(leads)[first]
                yield pa.RecordBatch.from_arrays([pa.array(core.view(np.int64)), pa.array(n.astype(np.int64)), pa.array(lead)], ["core", "n", "lead"])

    return run


class _Few:
    """A set of core hashes as a sorted array."""

    def __init__(self, cores: np.ndarray):
        self.cores = np.sort(cores)

    def has(self, cores: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.cores, cores)
        return self.cores[np.minimum(at, len(self.cores) - 1)] == cores if len(self.cores) else np.zeros(len(cores), dtype=bool)


class _Marks:
    """A set of core hashes as bits."""

    def __init__(self, words: np.ndarray):
        self.words, self.mask = words, np.uint64(len(words) * 64 - 1)

    def has(self, cores: np.ndarray) -> np.ndarray:
        at = cores & self.mask
        return (self.words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) != 0


def _marks(cores: DataFrame, bits: int) -> _Marks:
    """Bits are gathered by word on the executors; the driver gets at most bits / 64 longs."""
    at = F.col("core").bitwiseAND(F.lit(bits - 1))
    one = F.expr("shiftleft(1L, CAST(_at & 63 AS INT))")
    got = cores.select(at.alias("_at")).select(F.shiftright("_at", 6).alias("word"), one.alias("bit"))
    got = got.groupBy("word").agg(F.bit_or("bit").alias("bit")).toArrow()
    words = np.zeros(bits // 64, dtype=np.uint64)
    words[got.column("word").to_numpy()] = got.column("bit").to_numpy().view(np.uint64)
    return _Marks(words)


def _frequent(cores: DataFrame, bits: int) -> _Few | _Marks:
    """Cores that are very frequent: an array of MOST_FREQUENT hashes at most (8 MB), beyond it a bit set."""
    own = cores.filter(F.col("n") >= FREQUENT)
    if own.limit(MOST_FREQUENT + 1).count() > MOST_FREQUENT:
        return _marks(own, bits)
    return _Few(own.select("core").toArrow().column("core").to_numpy().astype(np.int64).view(np.uint64))


def _strings(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [[] for _ in range(9)]
    kinds = [pa.int64()] * 5 + [pa.int32()] * 3 + [pa.binary()]
    names = ["core", "lead", "did", "th", "start", "run", "shift", "kind", "body"]
    return pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(cols, kinds, strict=True)], names)


def _dealt(did: int, th: int) -> int:
    """Where a found range goes: by its document, as copies have one text hash."""
    return ((did * 0x9E3779B97F4A7C15) ^ th) & (1 << 62) - 1


def _pack(kind: type, shared, frequent):
    """Packed strings of marked cores; equal ones of one task meet here."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks, often = shared.value, frequent.value
        seen: dict[bytes, tuple | None] = {}
        rows: list[tuple] = []

        def met(body: bytes, what: int, did: int, th: int, start: int, n: int) -> bool:
            """Whether this task has seen the string; then its range is sent, and the first one's with it."""
            digest = hashlib.blake2b(body, digest_size=16, key=b"%d" % what).digest()
            spot = (did, th, start)
            if digest not in seen:
                if len(seen) >= REMEMBERED:
                    seen.clear()
                seen[digest] = spot
                return False
            other = seen[digest]
            if spot == other:  # the row of a document that is there twice
                return True
            if kind.first_stays and spot < other:
                seen[digest] = spot
                return False
            rows.append((_dealt(did, th), 0, did, th, start, n, 0, _RANGE, b""))
            if not kind.first_stays and other is not None:
                rows.append((_dealt(*other[:2]), 0, *other, n, 0, _RANGE, b""))
                seen[digest] = None
            return True

        for batch in batches:
            dids, ths = longs(batch.column("_did")).tolist(), longs(batch.column("_th")).tolist()
            for lo, view, (first, last, place) in _views(batch, kind):
                cores = view.cores(place)
                keep = np.flatnonzero(marks.has(cores))
                first, last, place, cores = first[keep], last[keep], place[keep], cores[keep]
                doc = np.searchsorted(view.bounds, first, "right") - 1
                single = often.has(cores)
                for a, b, p, core, lead, d, base, one in zip(
                    first.tolist(), last.tolist(), place.tolist(), cores.view(np.int64).tolist(), view.lead(place).tolist(),
                    (doc + lo).tolist(), view.bounds[doc].tolist(), single.tolist(), strict=True,
                ):
                    did, th = dids[d], ths[d]
                    body = view.cut(a, b + kind.window)
                    if met(body, _PACKED, did, th, a - base, b - a + 1):
                        continue
                    if not one:
                        rows.append((core, lead, did, th, a - base, b - a + 1, p - a, _PACKED, body))
                        continue
                    for s in range(a, b + 1):
                        text = view.cut(s, s + kind.window)
                        what, single_body = kind.single(text)
                        if not met(single_body, _SINGLE, did, th, s - base, 1):
                            own = int.from_bytes(hashlib.blake2b(text, digest_size=8).digest(), "big", signed=True)
                            rows.append((own, int.from_bytes(text[:8], "big") >> 1, did, th, s - base, 1, 0, what, single_body))
            yield _strings(rows)
            rows.clear()

    return run


def _ranges(found: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    cols = [np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.int64) for i in range(4)]
    return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in cols], ["_did", "_th", "start", "stop"])


def _later_words(bodies: list[bytes], runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows (row, number in the row) that equal one of an earlier row, by sorted hashes and compared bytes."""
    data = b" ".join(bodies)
    buf = np.frombuffer(data, dtype=np.uint8)
    start, stop = word_spans(buf, np.array([0, len(buf)]))
    hashes = Rolling(Rolling(buf).spans(start, stop)).fixed(Words.window)
    base = np.concatenate([[0], np.cumsum(runs + Words.window - 1)])[:-1]
    row = np.repeat(np.arange(len(runs)), runs)
    number = np.arange(len(row)) - np.repeat(np.cumsum(runs) - runs, runs)
    at = base[row] + number
    key = hashes[at]
    order = np.argsort(key, kind="stable")
    new = np.empty(len(order), dtype=bool)
    new[:1] = True
    new[1:] = key[order[1:]] != key[order[:-1]]
    leader = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    later, first = order[~new], leader[~new]
    by = np.argsort(later)
    later, first = later[by], first[by]
    a, b = at[later], at[first]
    same = np.zeros(len(later), dtype=bool)
    breaks = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1] + 1) | (b[1:] != b[:-1] + 1)])) if len(a) else np.zeros(0, np.int64)
    for i, j in zip(breaks.tolist(), [*(breaks[1:] - 1).tolist(), len(a) - 1], strict=False):
        k = Words.window - 1
        if data[start[a[i]] : stop[a[j] + k]] == data[start[b[i]] : stop[b[j] + k]]:
            same[i : j + 1] = True
    if not same.all():  # two windows with one hash: settle all windows of such hashes by their bytes
        same[:] = True
        odd, first_of = np.isin(key, key[later]), {}
        wrong = np.zeros(len(at), dtype=bool)
        for i in np.flatnonzero(odd).tolist():
            text = data[start[at[i]] : stop[at[i] + Words.window - 1]]
            wrong[i] = first_of.setdefault(text, i) != i
        later = np.flatnonzero(wrong)
        return row[later], number[later]
    return row[later[same]], number[later[same]]


def multikey_ties(data: bytes, at: np.ndarray, group: np.ndarray, length: int) -> np.ndarray:
    """Indexes of the strings (data at each place, ``length`` bytes) that equal another of their group.

    Multikey quicksort with characters of eight bytes: strings tied so far are sorted by the next character,
    and those left alone drop out.  Characters are taken from both ends, where strings of one anchor differ.
    """
    eight = np.ndarray(max(0, len(data) - 7), dtype=">u8", buffer=data, strides=(1,))
    steps = list(range(0, length - 7, 8)) + ([length - 8] if length % 8 else [])
    steps = [s for pair in zip(steps, reversed(steps), strict=True) for s in pair][: len(steps)]
    live = np.arange(len(at))
    key = group
    for step in [None, *steps]:
        if step is not None:
            char = eight[at[live] + step].astype(np.uint64)
            order = np.lexsort((char, key))
            char, key = char[order], key[order]
            new = (key[1:] != key[:-1]) | (char[1:] != char[:-1])
        else:
            order = np.argsort(key, kind="stable")
            key = key[order]
            new = key[1:] != key[:-1]
        live = live[order]
        rank = np.concatenate([[0], np.cumsum(new)]) if len(live) else np.zeros(0, np.int64)
        tied = np.bincount(rank)[rank] > 1 if len(live) else np.zeros(0, bool)
        live, key = live[tied], rank[tied]
        if not len(live):
            break
    return live


def _equal_bytes(bodies: list[bytes], runs: np.ndarray, shifts: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    data = b"".join(bodies)
    base = np.concatenate([[0], np.cumsum(runs + Bytes.window - 1)])[:-1]
    row = np.repeat(np.arange(len(runs)), runs)
    number = np.arange(len(row)) - np.repeat(np.cumsum(runs) - runs, runs)
    tied = multikey_ties(data, base[row] + number, groups[row] * 1024 + shifts[row] - number, Bytes.window)
    tied.sort()
    return row[tied], number[tied]


def _bucket(kind: type):
    def solve(t: pa.Table) -> pa.RecordBatch:
        t = t.combine_chunks()
        what, core, did, th, start, run, shift = (longs(t.column(c)) for c in ("kind", "core", "did", "th", "start", "run", "shift"))
        bodies = t.column("body").to_pylist()
        done = what == _RANGE
        found = [(did[done], th[done], start[done], start[done] + run[done])]
        first: dict[tuple, int] = {}
        repeated, alone = [], []
        for i in np.flatnonzero(~done).tolist():
            j = first.setdefault((core[i], what[i], bodies[i]), i)
            if j == i:
                alone.append(i)
            elif (did[i], th[i], start[i]) != (did[j], th[j], start[j]):
                repeated.append(i)
                if not kind.first_stays:
                    repeated.append(j)
        rep = np.unique(np.array(repeated, dtype=np.int64))
        found.append((did[rep], th[rep], start[rep], start[rep] + run[rep]))
        rows = np.array([i for i in alone if what[i] == _PACKED], dtype=np.int64)
        if len(rows):
            _, group, size = np.unique(core[rows], return_inverse=True, return_counts=True)
            rows, group = rows[size[group] > 1], group[size[group] > 1]
        if len(rows):
            own = [bodies[i] for i in rows.tolist()]
            row, number = _later_words(own, run[rows]) if kind is Words else _equal_bytes(own, run[rows], shift[rows], group)
            if len(row):
                new = np.concatenate([[True], (row[1:] != row[:-1]) | (number[1:] != number[:-1] + 1)])
                a = np.flatnonzero(new)
                b = np.append(a[1:], len(row)) - 1
                src = rows[row[a]]
                found.append((did[src], th[src], start[src] + number[a], start[src] + number[b] + 1))
        return _ranges(found)

    def solver(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            size += batch.column("body").nbytes
            if size < BATCH_BYTES:
                continue
            table = pa.Table.from_batches(held)
            core = table.column("core").to_numpy()
            cut = int(np.argmax(core[::-1] != core[-1]))
            if core[0] != core[-1]:
                yield solve(table.slice(0, table.num_rows - cut))
                held = table.slice(table.num_rows - cut).combine_chunks().to_batches()
                size = sum(b.column("body").nbytes for b in held)
        if held:
            yield solve(pa.Table.from_batches(held))

    return solver


def repeated_ranges(docs: DataFrame, kind: type) -> DataFrame:
    """Ranges [start, stop) of window starts to remove, by ``_did`` and ``_th``; docs as ``runtime.keyed`` makes them."""
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select("_did", "_th", "_text").filter(F.length("_text") >= (kind.window * 2 - 1 if kind is Words else kind.window // 4))
    cores = docs.select("_text").mapInArrow(tidy(_count_cores(kind)), CORES)
    cores = durable(cores.groupBy("core").agg(F.sum("n").alias("n"), F.min("lead").alias("lead")).filter("n > 1"))
    total, weight = cores.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << (8 * total).bit_length()))
    shared = spark.sparkContext.broadcast(_marks(cores, bits))
    often = spark.sparkContext.broadcast(_frequent(cores, bits))
    strings = docs.mapInArrow(tidy(_pack(kind, shared, often)), STRINGS)
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(1 << 16, weight * 600 // (64 << 20)))
    if kind is Bytes:
        ranged = F.when(F.col("kind") == _RANGE, F.pmod("core", F.lit(buckets)).cast("int")).otherwise(_range_of(cores, total, buckets))
        strings = strings.repartition(buckets, F.get(F.lit(_places(spark, buckets)), ranged))
    else:
        strings = strings.repartition(buckets, "core")
    strings = strings.sortWithinPartitions("core", "did", "th", "start")
    return strings.mapInArrow(tidy(_bucket(kind)), RANGES)


def _range_of(cores: DataFrame, total: int, buckets: int, sample: int = 8192):
    """Sampled splitters over (leading eight bytes of the suffix, core hash): the number of the range as a Column.

    About ``sample`` repeated cores are drawn by hash, each as often as it occurs (at most FREQUENT times, as
    beyond that its windows travel one by one).  Ranges are cut between whole keys, so equal strings never
    stand on two sides of a boundary.
    """
    part = F.pmod(F.xxhash64("core"), F.lit(max(1, total // sample))) == 0
    drawn = sorted((r.lead, r.core, min(r.n, FREQUENT)) for r in cores.filter(part).limit(4 * sample).collect())
    if not drawn:
        return F.lit(0)
    sums, ranges = np.cumsum([n for _, _, n in drawn]), min(buckets, 1024)
    want = np.searchsorted(sums, np.arange(1, ranges) * (sums[-1] / ranges))
    cuts = sorted({drawn[min(int(i), len(drawn) - 1)][:2] for i in want})

    def at(lo: int, hi: int):
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        lead, core = cuts[mid]
        below = (F.col("lead") < lead) | ((F.col("lead") == lead) & (F.col("core") < core))
        return F.when(below, at(lo, mid)).otherwise(at(mid + 1, hi))

    each = max(1, buckets // ranges)  # beyond 1024 ranges each is dealt on by the core's hash
    return (at(0, len(cuts)) * each + F.pmod("core", F.lit(each))).cast("int")


def _places(spark, tasks: int) -> list[int]:
    """For each task a number whose hash Spark's partitioner deals to it, so that ranges stand in the tasks in order."""
    own = spark.range(0, 24 * tasks + 64, numPartitions=1).select(F.col("id").cast("int").alias("x"))
    found = dict(own.select("x", F.pmod(F.hash("x"), F.lit(tasks)).alias("t")).groupBy("t").agg(F.min("x").alias("x")).collect())  # tasks rows
    return [found.get(t, t) for t in range(tasks)]


def covered(ranges: pa.ListScalar | None, n: int, window: int) -> np.ndarray | None:
    """Marks the units covered by windows that start in the ranges."""
    if ranges is None or not len(ranges):
        return None
    a, b = (ranges.values.field(i).to_numpy(zero_copy_only=False) for i in ("start", "stop"))
    step = np.zeros(n + 1, dtype=np.int64)
    np.add.at(step, a, 1)
    np.add.at(step, b - 1 + window, -1)
    return np.cumsum(step[:-1]) > 0


def with_ranges(docs: DataFrame, ranges: DataFrame) -> DataFrame:
    """docs with a column ``_ranges``; each document's ranges are at most as many as its windows."""
    own = ranges.groupBy("_did", "_th").agg(F.collect_list(F.struct("start", "stop")).alias("_ranges"))
    return docs.join(own, ["_did", "_th"], "left")
