"""Operator 5, token counts by offset mapping.

A whole text is encoded once with a byte-level BPE vocabulary.  Each token's byte length gives its span; the
spans are joined with the sections' spans, both sorted.  Sections are the lines of the text, each with the
line feed that ends it (after a last line feed there is one more, empty, section).  A token that lies in
several sections goes, by ``rule``, to

    majority  the one that holds most of its bytes, of equals the first (the default),
    start     the one where it begins,
    end       the one where it ends.

The counts of a text's sections add up to its tokens.  A null text is an empty one: one empty section with
no tokens.  Rows that repeat an id each have their sections; a null id is carried; very long texts are encoded
whole; an empty table gives an empty result; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.llm.runtime import read, small_batches, texts_of


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@lru_cache(maxsize=2)
def _encoding(path: str):
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    sizes = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
    for token, i in ranks.items():
        sizes[i] = len(token)
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}), sizes


def attribute(ends: np.ndarray, starts: np.ndarray, rule: str = "majority") -> tuple[np.ndarray, np.ndarray]:
    """Tokens, and tokens that cross a boundary, of each section; tokens have no gaps, and nor have sections."""
    begin = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    first = np.searchsorted(starts, begin, "right") - 1
    last = np.searchsorted(starts, ends - 1, "right") - 1
    home = last.copy() if rule == "end" else first.copy()
    across = np.flatnonzero(first != last)
    if rule == "majority":
        for i in across.tolist():
            own = np.minimum(np.append(starts[first[i] + 1 : last[i] + 1], ends[i]), ends[i]) - np.maximum(starts[first[i] : last[i] + 1], begin[i])
            home[i] = first[i] + int(np.argmax(own))
    return np.bincount(home, minlength=len(starts)), np.bincount(home[across], minlength=len(starts))


def _count(path: str, rule: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, sizes = _encoding(path)
        for batch in batches:
            buf, offs = texts_of(batch.column("_text"))
            doc, section, size, tokens, crossing = [], [], [], [], []
            for i, (a, b) in enumerate(zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True)):
                own = buf[a:b]
                starts = np.concatenate([[0], np.flatnonzero(own == 0x0A) + 1])
                ids = encoding.encode_ordinary(own.tobytes().decode())
                n, over = attribute(np.cumsum(sizes[np.array(ids, dtype=np.int64)]), starts, rule)
                doc.append(np.full(len(starts), i))
                section.append(np.arange(len(starts)))
                size.append(np.diff(np.append(starts, b - a)))
                tokens.append(n)
                crossing.append(over)
            if doc:
                cols = [pa.array(np.concatenate(c).astype(np.int64)) for c in (section, size, tokens, crossing)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(np.concatenate(doc))), *cols], ["doc_id", "section", "n_bytes", "n_tokens", "n_crossing"])

    return run


def token_counts(docs: DataFrame, ranks: str | None = None, rule: str = "majority", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, section, n_bytes, n_tokens, n_crossing: a row for each section of each row."""
    if rule not in ("majority", "start", "end"):
        raise ValueError(f"no such rule: {rule}")
    small_batches(docs.sparkSession)
    own = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("_text"))
    return own.mapInArrow(_count(ranks or default_ranks(), rule), "doc_id long, section long, n_bytes long, n_tokens long, n_crossing long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(read(spark, sf_dir, "documents"))
