"""Operator 8, suffix-array dedup: sampled splitters range-partition suffixes by their leading bytes.

Texts are UTF-8 bytes.  A byte is removed if a string of 400 bytes that covers it also starts anywhere else,
in the same document or another.  Suffixes that share an anchor travel packed to the range of the anchored
suffix, ranges and tasks in one order; a range sorts the starts by multikey quicksort.  Ranges are cut between
whole keys (the leading eight bytes and the hash of the 200 from the anchor on), so suffixes on two sides of a
boundary differ before their 200th byte, and a comparison across it has nothing left to find.  Rows that repeat id and text are one document with one result
(their strings are not counted twice by that alone).  A null id is an id; null and empty texts have no bytes; very
long texts are searched whole; of equal strings all go; an empty table gives an empty result; other columns,
whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.llm.repeats import Bytes, covered, repeated_ranges, with_ranges
from folioflow.llm.runtime import keyed, read, texts_of, tidy


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        buf, offs = texts_of(batch.column("_text"))
        kept, gone, spans = [], [], []
        for i, ranges in enumerate(batch.column("_ranges")):
            text = buf[offs[i] : offs[i + 1]]
            off = covered(ranges if ranges.is_valid else None, len(text), Bytes.window)
            if off is None:
                kept.append(text.tobytes())
                gone.append(0)
                spans.append([])
                continue
            step = np.diff(np.concatenate([[0], off.astype(np.int8), [0]]))
            a, b = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
            kept.append(text[~off].tobytes())
            gone.append(int(off.sum()))
            spans.append([{"start": x, "stop": y} for x, y in zip(a.tolist(), b.tolist(), strict=True)])
        span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        made = [pa.array(np.diff(offs)), pa.array(gone, pa.int64()), pa.array(spans, span), pa.array(kept, pa.binary())]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *made], ["doc_id", "n_bytes", "n_removed", "removed", "kept"])


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, the removed spans and the bytes that stay, of each row."""
    own = keyed(docs, id_col, text_col)
    found = with_ranges(own, repeated_ranges(own, Bytes)).select("doc_id", "_text", "_ranges")
    return found.mapInArrow(tidy(_cut), "doc_id long, n_bytes long, n_removed long, removed array<struct<start:long,stop:long>>, kept binary")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = suffix_dedup(read(spark, sf_dir, "documents"))
    n_spans = F.size("removed").cast("long").alias("n_spans")
    return done.select("doc_id", "n_bytes", "n_removed", n_spans, F.sha2("kept", 256).alias("kept_sha256"))
