"""What the operators share on the Spark side: keys of documents, durable tables, Arrow batches.

A document is identified inside the operators by ``_did`` (its id, or the smallest long where the id
is null) and ``_th`` (xxhash64 of its text).  Rows that repeat both are the same document: each such
row gets the same result.  A null text is an empty one.
"""

from __future__ import annotations

import atexit
import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NULL_ID = -(1 << 63)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; where it is unset and all runs on one machine, one is made and set."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="folioflow-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


_written: list[tuple[SparkSession, str]] = []


def clear(since: int = 0, keep: tuple[str, ...] = ()) -> None:
    """Deletes the durable tables written after the first ``since``, but for the paths to keep."""
    own, _written[since:] = _written[since:], [x for x in _written[since:] if x[1] in keep]
    for spark, path in own:
        if path in keep:
            continue
        try:
            hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)
        except Exception:  # the session has ended: the folder belongs to the cluster then
            return


atexit.register(clear)


def durable(df: DataFrame) -> DataFrame:
    """Writes df as a table in the shared folder and reads it again: lineage ends, lost executors don't matter."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/folioflow-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    _written.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def written() -> list[str]:
    """Paths of the durable tables that stand."""
    return [path for _, path in _written]


def tidy(run: Callable) -> Callable:
    """run, for mapInArrow; at its end the worker gives free memory back, as idle workers live on beside those at work."""

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc alone has it
                trim(0)

    return own


def small_batches(spark: SparkSession, rows: int = 500) -> None:
    """Long texts come in Arrow batches of few rows, so that a Python worker holds a few MB of them."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > rows:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the key and the text, whatever else the table has."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    doc = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("_text"))
    return doc.select("doc_id", F.coalesce("doc_id", F.lit(NULL_ID)).alias("_did"), F.xxhash64("_text").alias("_th"), "_text")


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a column of strings without nulls, without a copy."""
    column = column.cast(pa.large_string()) if pa.types.is_large_string(column.type) else column.cast(pa.string())
    _, offsets, data = column.buffers()
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offs = np.frombuffer(offsets, dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return (np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), offs


def pieces(offs: np.ndarray, target: int = 1 << 19):
    """Index ranges of rows of about target bytes each; a longer row stands alone."""
    lo, n = 0, len(offs) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + target, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def longs(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64)
