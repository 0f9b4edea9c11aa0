from __future__ import annotations

import corpus_pipeline as P
import pytest
from pyspark.sql import functions as F

from folioflow.llm import bpe, decontaminate, quality_rules, simhash, substring_dedup
from folioflow.llm.queries import ORACLE_SQL, QUERIES
from folioflow.llm.runtime import read

SF = "/root/testdata/sf0.001"


def test_stages_work_on_what_is_kept(spark):
    docs = read(spark, SF, "documents")
    columns, last = docs.columns, docs.count()
    for n, (_, stage) in enumerate(P.STAGES):
        docs = stage(spark, docs, SF).cache()
        assert docs.count() <= last
        last = docs.count()
        assert docs.columns == columns or n + 1 == len(P.STAGES)
    assert {"doc_id", "ids", "n_tokens", "decoded"} == set(docs.columns)
    assert P.run(spark, SF).agg(F.count("*"), F.bit_xor(F.xxhash64("doc_id", "ids"))).first() == docs.agg(F.count("*"), F.bit_xor(F.xxhash64("doc_id", "ids"))).first()


def test_empty_tables(spark):
    docs = read(spark, SF, "documents").filter("doc_id < 0")
    for _, stage in P.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "labels", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    want = con.sql(ORACLE_SQL[name])
    at = [want.columns.index(c) for c in columns]
    assert sorted(repr([r[c] for c in columns]) for r in df.collect()) == sorted(repr([r[i] for i in at]) for r in want.fetchall())


def test_all_operators_are_registered():
    assert [int(n[2:].split("_")[0]) for n in QUERIES] == list(range(1, 11))
    assert all(callable(f) for f in (quality_rules.keep_good, simhash.keep_one, substring_dedup.dedup_column, decontaminate.clean, bpe.encode))
