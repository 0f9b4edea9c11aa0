"""Operator 6, BPE encoding and decoding with content-defined chunk reuse.

A text is cut at word starts where a rolling hash of the 32 bytes before is a multiple of ``spacing``, so a
passage that documents share is cut alike in each.  A cut stands only if encoding the words on both sides
together gives the same ids as encoding them apart; otherwise the two chunks are joined and encoded as one,
and this goes on until all joins agree.  Then the chunks go to a bucket by their hash, where each distinct
text is encoded once for all documents, and the ids come back to the documents' group and are put together.

A group is about 4 MB of documents of one task.  It sends each distinct chunk once and gets its ids
once, so a chunk that a third of all documents hold costs one row a group.  Texts and ids travel compressed.

Null and empty texts have no tokens; rows that repeat an id each have a row; an empty table gives an empty
result; other columns, whatever their names, are not read; very long texts make groups of their own.  The result is that of the tokenizers library on the whole text, with
truncation and padding unused.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioflow.llm.hashing import Rolling, mix, word_spans
from folioflow.llm.runtime import pieces, read, small_batches, texts_of, tidy

#: Word starts between two cuts, on average; bytes that the rolling hash sees.
SPACING, SEEN = 256, 32
#: Bytes of a group's documents; zstd level of what travels (more of either makes it smaller).
GROUP, LEVEL = 4 << 20, 6
#: Words whose ids a Python worker remembers; beyond it starts again.
WORDS = 200_000
_PARTS = "to int, grp long, kind int, idx binary, lens binary, body binary"
_NAMES = ["to", "grp", "kind", "idx", "lens", "body"]


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


#: Words that the normaliser only lower-cases and the splitter cuts in letters and signs; no part of a special token.
_SIMPLE = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]*)([#*$%&|.,!?;:]*)")


def _plain(spec: dict) -> bool:
    """Whether a tokenizer is of the kind that _Merger and _SIMPLE are made for."""
    model, normalizer = spec["model"], spec.get("normalizer") or {}
    steps = [s.get("type") for s in normalizer.get("normalizers", [])]
    specials = [t["content"] for t in spec.get("added_tokens", [])]
    return model.get("type") == "BPE" and model.get("end_of_word_suffix") == "</w>" and not model.get("dropout") and steps == ["NFC", "Replace", "Lowercase"] and all("<" in t for t in specials)


def _bytes_of_signs() -> dict[str, int]:
    """Byte-level vocabularies write each byte as a sign: itself if it prints, else the next code point from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class _Merger:
    """The vocabulary's merges over bytes, with a zero byte as the end of a word.

    A word's last byte takes its end before anything else merges (those pairs have the first ranks); then
    the merges follow in their order.  Tests hold this against the library.
    """

    def __init__(self, spec: dict):
        import tiktoken

        signs, vocab = _bytes_of_signs(), spec["model"]["vocab"]

        def raw(token: str) -> bytes:
            ended = token.endswith("</w>")
            return bytes(signs[c] for c in (token[:-4] if ended else token)) + (b"\0" if ended else b"")

        ranks = {bytes([b]): b for b in range(256)}
        ranks |= {bytes([b, 0]): 255 + b for b in range(1, 256)}
        for merge in spec["model"]["merges"]:
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            ranks.setdefault(raw(left) + raw(right), len(ranks))
        self.ids = np.zeros(len(ranks), dtype=np.int64)
        special = {t["content"] for t in spec.get("added_tokens", [])}
        for token, i in vocab.items():
            if token not in special and (at := ranks.get(raw(token))) is not None:
                self.ids[at] = i
        self.ends = np.zeros(len(ranks), dtype=bool)
        self.ends[[r for t, r in ranks.items() if t.endswith(b"\0")]] = True
        self.merges = tiktoken.Encoding("merges", pat_str=r"[^\x00]+\x00", mergeable_ranks=ranks, special_tokens={})

    def encode(self, words: list[tuple[str, str]], kind: np.dtype) -> Iterator[bytes]:
        """Ids of words of (letters, signs)."""
        text = "".join(f"{p}\0" for w in words for p in w if p).lower()
        found = np.array(self.merges.encode_ordinary(text), dtype=np.int64)
        data, size = self.ids[found].astype(kind).tobytes(), kind.itemsize
        stops = np.concatenate([[0], np.flatnonzero(self.ends[found]) + 1])
        parts = np.cumsum([0] + [bool(a) + bool(b) for a, b in words])
        at = (stops[parts] * size).tolist()
        return (data[a:b] for a, b in zip(at, at[1:], strict=False))


class Encoder:
    """A tokenizer, and for those that drop white space before they merge, a memory of words' ids."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.kind = np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [spec.get("pre_tokenizer") or {}]
        first = steps[0]
        #: True if only what matches the pattern is kept, and no match holds white space: words then encode alone.
        self.by_word = bool(first.get("type") == "Split" and first.get("invert") and first.get("behavior") == "Removed" and r"[^\s" in first.get("pattern", {}).get("Regex", ""))
        self.words: dict[bytes, bytes] = {}
        self.merger = _Merger(spec) if self.by_word and _plain(spec) else None

    def many(self, texts: list[bytes]) -> list[bytes]:
        made = self.tokenizer.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)
        return [np.array(e.ids, dtype=self.kind).tobytes() for e in made]

    def fresh(self, words: list[bytes]) -> Iterator[tuple[bytes, bytes]]:
        """Ids of words: of letters and a few signs by merges alone, of all others by the library."""
        parts = {w: m.groups() for w in words if self.merger and (m := _SIMPLE.fullmatch(w.decode()))}
        if parts:
            yield from zip(parts, self.merger.encode(list(parts.values()), self.kind), strict=True)
        if rest := [w for w in words if w not in parts]:
            yield from zip(rest, self.many(rest), strict=True)

    def chunk(self, text: bytes) -> bytes:
        if not self.by_word:
            return self.many([text])[0]
        words, have = text.split(), self.words
        try:
            return b"".join(map(have.__getitem__, words))
        except KeyError:
            new = list({w for w in words if w not in have})
            if len(have) + len(new) > WORDS:
                have.clear()
                new = list(set(words))
            have.update(self.fresh(new))
            return b"".join(map(have.__getitem__, words))


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def cuts(buf: np.ndarray, offs: np.ndarray, spacing: int = SPACING) -> np.ndarray:
    """Places where chunks of the texts begin, text starts included."""
    found = [offs[:-1]]
    for lo, hi in pieces(offs):
        own, at = buf[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]
        start, _ = word_spans(own, at)
        doc = np.searchsorted(at, start, "right") - 1
        start, doc = start[start > at[doc]], doc[start > at[doc]]
        seen = Rolling(own).spans(np.maximum(start - SEEN, at[doc]), start)
        found.append(start[seen % np.uint64(spacing) == 0] + offs[lo])
    return np.unique(np.concatenate(found))


def agreed(raw: bytes, places: np.ndarray, offs: np.ndarray, enc: Encoder) -> np.ndarray:
    """The places at which encoding the neighbouring words together and apart agrees; text starts always do."""
    inner = places[~np.isin(places, offs)]
    sides = []
    for p in inner.tolist():
        lo = int(offs[np.searchsorted(offs, p, "right") - 1])
        hi = int(offs[np.searchsorted(offs, p, "right")])
        left = raw[max(lo, p - 64) : p]
        if len(left.split()) < 2:
            left = raw[lo:p]
        right = raw[p : min(hi, p + 64)]
        if len(right.split(None, 1)) < 2:
            right = raw[p:hi]
        a, b = left.rstrip().rfind(b" ") + 1, right.find(b" ")
        sides.append((left[a:] if a else b" ".join(left.split()[-1:]) + b" ", right[:b] if b > 0 else right.split()[0]))
    together = enc.many([a + b for a, b in sides])
    apart = enc.many([x for s in sides for x in s])
    wrong = [t != a + b for t, a, b in zip(together, apart[::2], apart[1::2], strict=True)]
    return np.setdiff1d(places, inner[np.array(wrong, dtype=bool)]) if any(wrong) else places


def _larger(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches put together until they hold a group's bytes."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.column("_text").nbytes for b in held) >= GROUP:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held = []
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _split(path: str, buckets: int, spacing: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, pack = encoder(path), zstandard.ZstdCompressor(level=LEVEL)
        number = 0
        for batch in _larger(batches):
            buf, offs = texts_of(batch.column("_text"))
            ids = batch.column("doc_id")
            lo = 0
            while lo < len(ids):
                hi = min(len(ids), max(lo + 1, int(np.searchsorted(offs, offs[lo] + GROUP, "right")) - 1))
                own, at = buf[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]
                raw = own.tobytes()
                place = cuts(own, at, spacing)
                place = agreed(raw, place[place < len(raw)], at, enc)
                end = np.append(place[1:], len(raw))
                known: dict[bytes, int] = {}
                texts: list[bytes] = []
                homes: list[int] = []
                order = []
                for a, b in zip(place.tolist(), end.tolist(), strict=True):
                    text = raw[a:b]
                    i = known.setdefault(text, len(texts))
                    if i == len(texts):
                        texts.append(text)
                        homes.append(xxhash.xxh64_intdigest(text) % buckets)
                    order.append(i)
                number += 1
                group = int(mix(np.array([TaskContext.get().partitionId() * (1 << 32) + number], dtype=np.uint64)).view(np.int64)[0])
                per_doc = np.diff(np.searchsorted(place, at))
                row = pa.RecordBatch.from_arrays([ids.slice(lo, hi - lo)], ["doc_id"])
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, row.schema) as writer:
                    writer.write_batch(row)
                rows = [(group % buckets, group, 1, np.array(order, "<i4").tobytes(), per_doc.astype("<i4").tobytes(), sink.getvalue().to_pybytes())]
                home = np.array(homes, dtype=np.int64)
                by = np.argsort(home, kind="stable")
                for part in np.split(by, np.flatnonzero(np.diff(home[by])) + 1) if len(by) else []:
                    own_texts = [texts[i] for i in part.tolist()]
                    lens = np.array([len(x) for x in own_texts], "<i4").tobytes()
                    rows.append((int(home[part[0]]), group, 0, part.astype("<i4").tobytes(), lens, pack.compress(b"".join(own_texts))))
                yield _rows(rows)
                lo = hi

    return run


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], _NAMES)


def _parts(body: bytes, lens: bytes, unpack: zstandard.ZstdDecompressor, size: int = 1):
    data, at = unpack.decompress(body), 0
    for n in np.frombuffer(lens, "<i4").tolist():
        yield data[at : at + n * size]
        at += n * size


def _encode(path: str):
    """Each distinct text of a bucket once; layouts pass through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        pack, unpack = zstandard.ZstdCompressor(level=LEVEL), zstandard.ZstdDecompressor()
        done: dict[bytes, bytes] = {}
        bucket = None
        for batch in batches:
            rows = []
            for to, group, kind, idx, lens, body in zip(*(batch.column(c).to_pylist() for c in _NAMES), strict=True):
                if to != bucket:
                    bucket = to
                    done.clear()
                if kind:
                    rows.append((to, group, kind, idx, lens, body))
                    continue
                made = []
                for text in _parts(body, lens, unpack):
                    if (ids := done.get(text)) is None:
                        ids = done[text] = enc.chunk(text)
                    made.append(ids)
                counts = np.array([len(m) // enc.kind.itemsize for m in made], "<i4").tobytes()
                rows.append((to, group, kind, idx, counts, pack.compress(b"".join(made))))
            if rows:
                yield _rows(rows)

    return run


def _assemble(kind: np.dtype):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        group, layout, have = None, None, {}

        def made() -> pa.RecordBatch:
            order, per_doc, docs = layout
            data = b"".join([have[i] for i in order])
            size = np.array([len(have[i]) // kind.itemsize for i in order], dtype=np.int64)
            ends = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(per_doc)])]
            values = pa.array(np.frombuffer(data, kind).astype(np.int32))
            ids = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), values)
            return pa.RecordBatch.from_arrays([docs, ids], ["doc_id", "ids"])

        for batch in batches:
            for _, own, what, idx, lens, body in zip(*(batch.column(c).to_pylist() for c in _NAMES), strict=True):
                if own != group:
                    if layout is not None:
                        yield made()
                    group, layout, have = own, None, {}
                if what:
                    with pa.ipc.open_stream(body) as reader:
                        docs = reader.read_all().column("doc_id").combine_chunks()
                    layout = (np.frombuffer(idx, "<i4").tolist(), np.frombuffer(lens, "<i4"), docs)
                else:
                    have |= zip(np.frombuffer(idx, "<i4").tolist(), _parts(body, lens, unpack, kind.itemsize), strict=True)
        if layout is not None:
            yield made()

    return run


def _chain(*steps):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in steps:
            batches = step(batches)
        yield from batches

    return run


_IDS = "doc_id long, ids array<int>"


def _encoded(docs: DataFrame, path: str, id_col: str, text_col: str, spacing: int, schema: str, *then) -> DataFrame:
    """Rows of ids as the steps in ``then`` leave them, which run in the worker that puts the ids together."""
    spark = docs.sparkSession
    small_batches(spark, 64)  # a row may hold a bucket's part of a group
    own = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("_text"))
    total = docs.select(F.sum(F.octet_length(F.col(f"`{text_col}`").cast("string")))).first()[0] or 0
    homes = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // (16 << 20))  # a worker holds one home's texts
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(1 << 16, homes))
    parts = own.mapInArrow(tidy(_split(path, homes, spacing)), _PARTS)
    parts = parts.repartition(tasks, "to").sortWithinPartitions("to").mapInArrow(tidy(_encode(path)), _PARTS)
    back = parts.repartition(tasks, "grp").sortWithinPartitions("grp", F.desc("kind"))
    return back.mapInArrow(tidy(_chain(_assemble(encoder(path).kind), *then)), schema)


def encode(docs: DataFrame, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text", spacing: int = SPACING) -> DataFrame:
    """doc_id and ids (array of int) of each row."""
    return _encoded(docs, tokenizer or default_tokenizer(), id_col, text_col, spacing, _IDS)


def encode_decode(docs: DataFrame, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text", spacing: int = SPACING) -> DataFrame:
    """doc_id, ids and decoded (the text of the ids) of each row."""
    path = tokenizer or default_tokenizer()
    return _encoded(docs, path, id_col, text_col, spacing, f"{_IDS}, decoded string", _texts(path, ["doc_id", "ids"]))


def _texts(path: str, keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = encoder(path).tokenizer
        for batch in batches:
            texts = [tokenizer.decode(x.values.to_pylist() if x.is_valid else [], skip_special_tokens=False) for x in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(texts, pa.string())], [*keep, "decoded"])

    return run


def decode(encoded: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """encoded with the column ids replaced by decoded, the tokenizer's text of them; null ids give the empty text."""
    keep = [c for c in encoded.columns if c not in ("ids", "decoded")]
    schema = T.StructType([*[encoded.schema[c] for c in keep], T.StructField("decoded", T.StringType())])
    return encoded.select(*keep, "ids").mapInArrow(tidy(_texts(tokenizer or default_tokenizer(), keep)), schema)


def _digest(path: str):
    """Of each row's ids: their number, the hashes of their decimals joined by one space and of the decoded text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = encoder(path).tokenizer
        names = [b"%d" % i for i in range(tokenizer.get_vocab_size())]
        for batch in batches:
            n, ids_sha, text_sha = [], [], []
            for x in batch.column("ids"):
                ids = x.values.to_numpy(zero_copy_only=False).tolist()
                n.append(len(ids))
                ids_sha.append(hashlib.sha256(b" ".join(map(names.__getitem__, ids))).hexdigest())
                text_sha.append(hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids_sha), pa.array(text_sha)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return run


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, schema = default_tokenizer(), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return _encoded(read(spark, sf_dir, "documents"), path, "doc_id", "text", SPACING, schema, _digest(path))
