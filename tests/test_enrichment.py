from __future__ import annotations

import duckdb
import pytest

from folioflow.operators.enrich import enriched_updates
from folioflow.queries import ORACLE_SQL, QUERIES


@pytest.fixture
def shuffled(spark):
    """Bytes that a collected frame's exchanges were given; no side is broadcast."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")

    def below(node):
        if node.nodeName() == "AdaptiveSparkPlan":
            return below(node.executedPlan())
        if node.nodeName().endswith("QueryStage"):
            return below(node.plan())
        own = node.metrics().apply("dataSize").value() if node.nodeName() == "Exchange" else 0
        return own + sum(below(node.children().apply(i)) for i in range(node.children().size()))

    yield lambda df: below(df._jdf.queryExecution().executedPlan())
    spark.conf.set(key, old)


def compared(spark, folder, docs, edits):
    """The query's frame, once its rows were found equal to the SQL's."""
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1).write.parquet(f"{folder}/documents.parquet")
    events = spark.range(edits).selectExpr("id AS event_id", "timestamp '2024-01-01 00:00:00' AS ts", "id % 25 AS user_id", "'view' AS event_type", "1.0D AS value", "'{\"k\": 1}' AS props")
    events.coalesce(1).write.parquet(f"{folder}/events.parquet")
    df = QUERIES["st_enrich_update"](spark, str(folder))
    got = df.collect()
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for name in ("documents", "events"):
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet/*.parquet'")
    want = con.sql(ORACLE_SQL["st_enrich_update"])
    at = [want.columns.index(c) for c in df.columns]
    assert sorted(map(repr, map(tuple, got))) == sorted(repr(tuple(r[i] for i in at)) for r in want.fetchall())
    return df


def test_texts_do_not_travel_with_events(spark, tmp_path, shuffled):
    text, edits = "lorem ipsum dolor " * 1000, 1000
    docs = [(i, f"{i} {text}", "en" if i < 15 else "de", "s", 1) for i in range(20)]
    df = compared(spark, tmp_path, docs, edits)
    assert 2 * 20 * len(text) < shuffled(df) < 3 * 20 * len(text) + 1000 * edits


def test_revisions_without_a_text(spark, tmp_path):
    texts = ["a b", None, "b c c", None, None, "", "d", None]
    compared(spark, tmp_path, [(i, t, None if i == 6 else "en", "s", 1) for i, t in enumerate(texts)], 50)


def test_page_facts(spark):
    """Counts and tags of pages, also of one without a text before, one without a text, and one that isn't there."""
    events = spark.createDataFrame([("enwiki", 0, i, 10 + i, 1, "U") for i in (1, 1, 2, 3, 4)], "project string, namespace int, page_id long, rev_id long, user_id long, user_text string")
    rows = [
        (1, "A b", "x y", "x {{POV}} y y {{Citation needed}}", ["x", "y"], ["x", "POV", "y", "y"], ["No Index"]),
        (2, "B", None, "x", None, ["x"], []),
        (3, "C", "x", None, ["x"], None, None),
        (9, "D", "x", "y", ["x"], ["y"], []),
    ]
    pages = spark.createDataFrame(rows, "page_id long, title string, previous string, wikitext string, previous_words array<string>, words array<string>, templates array<string>")
    users = spark.createDataFrame([(1, 7, ["sysop"])], "user_id long, edit_count long, groups array<string>")
    scores = spark.createDataFrame([(11, True, 0.5), (12, True, 0.5)], "rev_id long, prediction boolean, probability_true double")
    state = spark.createDataFrame([(1, True)], "page_id long, is_breaking_news boolean")
    protected = spark.createDataFrame([("B",)], "title string")
    out = {r["identifier"]: r["version"] for r in enriched_updates(events, pages, users, scores, state, protected, ["no index"]).collect()}
    assert set(out) == {1, 2, 3, 4}
    a, b, c, d = (out[i] for i in (1, 2, 3, 4))
    assert tuple(a["diff"]) == (2, 0, 2, 30) and (a["number_of_characters"], a["size"], a["noindex"]) == (33, 33, True)
    assert tuple(a["maintenance_tags"]) == (1, 1, 0, 0) and a["scores"]["prediction"] and a["is_breaking_news"] and a["editor"]["is_admin"]
    assert (b["diff"], b["scores"], b["editor"]) == (None, None, None) and tuple(b["maintenance_tags"]) == (0, 0, 0, 0)
    assert tuple(c["diff"]) == (0, -1, -1, None) and c["editor"]["edit_count"] == 7 and tuple(c["maintenance_tags"]) == (0, 0, 0, 0) and c["noindex"] is False
    assert (d["diff"], d["number_of_characters"], d["noindex"]) == (None, None, False) and tuple(d["maintenance_tags"]) == (0, 0, 0, 0)
