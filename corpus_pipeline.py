"""The corpus pipeline: quality rules, near-dedup, substring dedup, decontamination, BPE.

Each stage takes (spark, docs, sf_dir) and works on all its predecessor kept.  All but the last return the
columns of ``documents``; the last returns the tokens and the text that they decode to.

In every stage a null text is an empty one (the quality rules reject it), documents are told apart by id and
text together, so rows that repeat an id are judged each, a null id is an id like others, columns beyond those
of ``documents`` are carried along whatever their names, and an empty table gives an empty result.  Of rows that
repeat id and text near-dedup keeps one; of a group's ids the least stays, a null before all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.llm import bpe, decontaminate, quality_rules, simhash, substring_dedup
from folioflow.llm.runtime import clear, durable, read, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go; without labels only the base rules reject."""
    return quality_rules.keep_good(docs, read(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: shingles of five words, Jaccard similarity of 0.8 or more."""
    return simhash.keep_one(docs, width=5, least=0.8)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 20 words or more that came earlier are cut from the text; n_chars follows it."""
    done = substring_dedup.dedup_column(docs)
    return done.withColumn("n_chars", F.char_length("text").cast("long"))


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go; without items none."""
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_tokens and decoded, the text of the ids."""
    return bpe.encode_decode(docs).withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("quality rules", quality),
    ("SimHash near-dedup", near_dedup),
    ("substring dedup", repeated_passages),
    ("benchmark decontamination", benchmark),
    ("BPE encoding and decoding", tokens),
]

#: Tokenizing and near-dedup have no SQL; tests hold run() against a brute-force version of all stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents; a stage's own tables and its predecessor's result go when its result is written."""
    docs, since = read(spark, sf_dir, "documents"), len(written())
    for _, stage in STAGES:
        docs = durable(stage(spark, docs, sf_dir))
        clear(since, keep=(written()[-1],))
    return docs
