"""Operator 1, substring dedup: super-k-mer partitioning of word windows.

Words are runs of ``[^\\x20\\x09-\\x0D]``.  A word is removed if a window of 20 consecutive words that covers
it has the same words as a window that starts earlier: in a document with a smaller id, or earlier in the
same document.  Documents with one id are ordered by the hash of their text; rows that repeat both id and
text are one document and get one result.  A null id sorts first.  Null and empty texts have no words; an
empty table gives an empty result; other columns are carried only by ``dedup_column``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioflow.llm.hashing import word_spans
from folioflow.llm.repeats import Words, covered, repeated_ranges, with_ranges
from folioflow.llm.runtime import keyed, read, texts_of, tidy


def _cut(spaced: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, offs = texts_of(batch.column("_text"))
            raw = buf[offs[0] : offs[-1]].tobytes() if len(offs) else b""
            texts, totals, gone = [], [], []
            for i, ranges in enumerate(batch.column("_ranges")):
                text = raw[offs[i] - offs[0] : offs[i + 1] - offs[0]]
                words = text.split()
                off = covered(ranges if ranges.is_valid else None, len(words), Words.window)
                totals.append(len(words))
                gone.append(int(off.sum()) if off is not None else 0)
                if spaced:
                    texts.append(_without(text, off) if off is not None else text)
                else:
                    texts.append(b" ".join(words if off is None else compress(words, (~off).tolist())))
            rest = [batch.column(c) for c in batch.schema.names if c not in ("_text", "_ranges")]
            names = [c for c in batch.schema.names if c not in ("_text", "_ranges")]
            made = [pa.array(totals, pa.int64()), pa.array(gone, pa.int64()), pa.array(texts, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(rest + made, [*names, "n_words", "n_removed", "kept_text"])

    return run


def _without(text: bytes, off: np.ndarray) -> bytes:
    """text less the removed words and the white space after them; what stays keeps its own white space."""
    start, _ = word_spans(np.frombuffer(text, dtype=np.uint8), np.array([0, len(text)]))
    stay = np.ones(len(text), dtype=bool)
    for i in np.flatnonzero(off).tolist():
        stay[start[i] : start[i + 1] if i + 1 < len(start) else len(text)] = False
    return np.frombuffer(text, dtype=np.uint8)[stay].tobytes()


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed and kept_text (the words that stay, joined by one space) of each row."""
    own = keyed(docs, id_col, text_col)
    found = with_ranges(own, repeated_ranges(own, Words)).select("doc_id", "_text", "_ranges")
    return found.mapInArrow(tidy(_cut(False)), "doc_id long, n_words long, n_removed long, kept_text string")


def dedup_column(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs, all columns, with repeated passages cut from the text; a null text without words stays null."""
    quoted = {c: F.col(f"`{c}`") for c in docs.columns}
    own = keyed(docs, id_col, text_col)
    rest = F.struct(*[quoted[c] for c in docs.columns if c != text_col], quoted[text_col].isNull().alias("_null"))
    text = F.coalesce(quoted[text_col].cast("string"), F.lit(""))
    rows = docs.select(rest.alias("_rest"), F.coalesce(quoted[id_col].cast("long"), F.lit(-(1 << 63))).alias("_did"), F.xxhash64(text).alias("_th"), text.alias("_text"))
    found = with_ranges(rows, repeated_ranges(own, Words)).select("_rest", "_text", "_ranges")
    schema = T.StructType([found.schema["_rest"], *T._parse_datatype_string("n_words long, n_removed long, kept_text string").fields])
    cut = found.mapInArrow(tidy(_cut(True)), schema)
    kept = F.when(F.col("_rest._null"), F.lit(None).cast("string")).otherwise(F.col("kept_text"))
    return cut.select(*[(kept if c == text_col else F.col("_rest").getField(c)).alias(c) for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = substring_dedup(read(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
starts AS (SELECT doc_id, unnest(range(1, len(ws) - 18)) AS s, ws FROM w WHERE len(ws) >= 20),
wins AS (SELECT doc_id, s, array_to_string(ws[s:s + 19], ' ') AS win FROM starts),
later AS (SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY win ORDER BY doc_id, s) AS r FROM wins) WHERE r > 1),
gone AS (SELECT DISTINCT doc_id, s + k.k AS i FROM later, (SELECT unnest(range(0, 20)) AS k) k),
lists AS (SELECT doc_id, list(i) AS gone FROM gone GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
       sha256(array_to_string(CASE WHEN gone IS NULL THEN ws ELSE list_filter(ws, lambda x, i: NOT list_contains(gone, i)) END, ' ')) AS kept_sha256
FROM w LEFT JOIN lists ON w.doc_id = lists.doc_id
"""
