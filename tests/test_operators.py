from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from folioflow import schemas
from folioflow.operators import aggregates as G
from folioflow.operators import events as E
from folioflow.operators import joins as J
from folioflow.operators import snapshot as N
from folioflow.operators import state as I
from folioflow.operators import windows as W
from folioflow.sources import kafka, pages, sinks
from folioflow.streaming import jobs

T0 = datetime.datetime(2024, 1, 1)


def change(kind, title="New", ns=0, prior_ns=0, redirect=False, db="enwiki"):
    page = (1, title, ns, redirect)
    return (db, kind, ("u", "d", T0), page, None, (5, T0, "", False, 1, True, False, True), (("Old", prior_ns), (4,)))


@pytest.mark.parametrize(
    ("row", "out"),
    [
        (change("create"), [("create", "New")]),
        (change("undelete"), [("create", "New")]),
        (change("create", redirect=True), []),
        (change("edit"), [("update", "New")]),
        (change("edit", redirect=True), [("delete", "New")]),
        (change("edit", ns=3), []),
        (change("delete"), [("delete", "New")]),
        (change("visibility_change"), [("visibility-change", "New")]),
        (change("move", ns=3, prior_ns=3), []),
        (change("move", ns=0, prior_ns=3, redirect=True), []),
        (change("move", ns=0, prior_ns=14, redirect=True), [("delete", "Old")]),
        (change("move", ns=6, prior_ns=14), [("delete", "Old"), ("move", "New")]),
        (change("move", ns=6, prior_ns=3), [("move", "New")]),
        (change("other"), []),
    ],
)
def test_changes(spark, row, out):
    df = E.article_events(spark.createDataFrame([row], schemas.CHANGE))
    assert sorted((r.e.type, r.e.name) for r in df.collect()) == out


def test_routes(spark):
    df = spark.createDataFrame([change("move", ns=6, prior_ns=6, db="commonswiki"), change("visibility_change")], schemas.CHANGE)
    topics = sorted(r.topic for r in E.routed(E.to_articles(E.article_events(df))).collect())
    assert topics == sorted(["local.structured-data.commons-move.v1", "local.structured-data.commons-delete.v1", *["local.structured-data.commonswiki-files-compacted.v1"] * 2, "local.structured-data.article-visibility-change.v1"])


def test_retry(spark):
    rows = E.retried(spark.createDataFrame([(9,), (10,), (None,)], "fail_count int")).collect()
    assert [(r.fail_count, r.topic) for r in rows] == [(10, "error"), (11, "dead-letter"), (1, "error")]


def test_latest_and_store(spark):
    log = spark.createDataFrame([("a", 1, "create"), ("a", 2, "update"), ("b", 1, "create"), ("b", 2, "delete"), ("c", 1, "create"), ("c", 2, "move")], "k string, o int, event_type string")
    assert sorted((r.k, r.event_type) for r in N.current(log, ["k"], ["o"]).collect()) == [("a", "update"), ("c", "create")]
    later = spark.createDataFrame([("a", 3, "delete")], log.schema)
    assert [r.k for r in sinks.upsert(log, later, ["k"], ["o"]).collect()] == ["c"]


def test_greedy_chunks(spark):
    df = spark.createDataFrame([("g", i, n) for i, n in enumerate([40, 50, 20, 100, 5])], "g string, i int, n int")
    assert [r.chunk for r in N.greedy_chunks(df, "g", "i", "n", 100).orderBy("i").collect()] == [0, 0, 1, 2, 3]


def test_joins(spark):
    titles = spark.createDataFrame([("a",), ("b",)], "title string")
    need = spark.createDataFrame([("a", 1), ("z", 2)], "title string, value int")
    may = spark.createDataFrame([("b", 3)], "title string, value int")
    out = {r.title: (r.need, r.may, r.errors) for r in J.multi_getter(titles, {"need": (need, False), "may": (may, True)}).collect()}
    assert out == {"a": (1, None, []), "b": (None, 3, ["need"]), "z": (2, None, [])}
    ranges = spark.createDataFrame([(1, "10.0.0.0", "10.0.255.255", "a"), (0, "10.0.1.0", "10.0.1.9", "b")], "order int, first string, last string, label string")
    rows = spark.createDataFrame([("10.0.1.5",), ("10.0.2.0",), ("11.0.0.0",), (None,)], "ip string")
    assert {r.ip: r.label for r in J.ip_range(rows, ranges).collect()} == {"10.0.1.5": "b", "10.0.2.0": "a", "11.0.0.0": None, None: None}


def test_groups():
    packed = G.binpack({"a": 100, "b": 10, "c": 9, "d": 1, "e": 2}, 3)
    assert packed[0] == ["a"] and sorted(sum(packed, [])) == list("abcde")
    assert G.binpack({}, 2) == []


def test_windows(spark):
    df = spark.createDataFrame([("u", T0 + datetime.timedelta(seconds=s), i) for i, s in enumerate([0, 0, 5, 30])], "u string, ts timestamp, i int")
    assert [r.mean for r in W.rolling_mean(df, ["u"], "ts").orderBy("second").collect()] == [2 / 15, 3 / 15, 1 / 15]
    assert [r.idle for r in W.idle_gap(df, ["u"], "ts", ["ts", "i"]).orderBy("i").collect()] == [None, 0, 5, 25]
    assert [r.allowed for r in W.running_cap(df, ["u"], ["ts", "i"], 3).orderBy("i").collect()] == [True, True, True, False]


def test_breaking_news(spark):
    hour = datetime.timedelta(hours=1)
    rows = [(1, T0, None, T0, 0, 0, ["Template:Cite news", "Template:Current Test1"]), (2, None, None, T0, 0, 9, ["Template:Cite news"]), (3, None, T0, T0 + hour, 3, 2, ["template:cite NEWS"]), (4, T0, None, T0 + 25 * hour, 50, 9, ["Template:Cite news"]), (5, T0, None, T0, 9, 1, ["Template:Cite news"])]
    df = spark.createDataFrame(rows, "page int, created timestamp, moved timestamp, modified timestamp, edits long, unique_editors long, names array<string>")
    done = I.breaking_news(df, I.equal_fold_any(F.col("names"), ["Template:Cite news"]), I.prefix_any(F.col("names"), ["Template:Current"]))
    assert {r.page: r.is_breaking_news for r in done.collect()} == {1: True, 2: None, 3: True, 4: False, 5: False}


def test_counting_starts_at_the_version(spark):
    v = spark.createDataFrame([(1, n, e, T0 + datetime.timedelta(minutes=10 * n), n) for n, e in enumerate(["Ann", "ann", "Bob", "Cy"])], "page int, version int, editor string, at timestamp, order int")
    asked = spark.createDataFrame([(1, 2, T0), (1, 9, T0)], "page int, version int, start timestamp")
    assert {r.version: (r.edits, r.unique_editors) for r in I.counted(asked, v).collect()} == {2: (3, 2), 9: (0, 0)}


def test_integrity_stream(spark, tmp_path):
    rows = [(1, "create", 0, 1, "x", T0), (1, "edit", 0, 2, "Ann", T0), (1, "edit", 0, 3, "ANN", T0), (2, "edit", 0, 4, "Bob", T0), (3, "move", 0, 5, "x", T0), (3, "edit", 0, 6, "Cy", T0)]
    df = spark.createDataFrame(rows, "page long, kind string, namespace int, version long, editor string, at timestamp")
    df.write.parquet(str(tmp_path / "in"))
    stream = jobs.integrity_stream(jobs.landed(spark, str(tmp_path / "in"), df.schema))
    query = stream.writeStream.outputMode("update").format("memory").queryName("integrity").option("checkpointLocation", str(tmp_path / "at")).trigger(once=True).start()
    query.awaitTermination(120)
    got = spark.table("integrity").collect()
    assert {r.page: (r.edits, r.unique_editors, r.created is not None, r.moved is not None) for r in got} == {1: (2, 1, True, False), 2: (0, 0, False, False), 3: (1, 1, False, True)}


def test_integrity_stream_over_split_groups(spark, tmp_path):
    """Pages of more rows than an Arrow batch holds, landed newest first: their order is that of the whole page."""
    kinds = ["edit", "create", "edit", "edit", "move", "edit", "delete"] * 3
    rows = [(p, k, 0, 100 * p + n, f"e{n % 4}", T0 + datetime.timedelta(minutes=n)) for p in (1, 2, 3) for n, k in enumerate(kinds)]
    df = spark.createDataFrame(rows[::-1], "page long, kind string, namespace int, version long, editor string, at timestamp").coalesce(1)
    df.write.parquet(str(tmp_path / "in"))
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        stream = jobs.integrity_stream(jobs.landed(spark, str(tmp_path / "in"), df.schema))
        query = stream.writeStream.outputMode("update").format("memory").queryName("split").option("checkpointLocation", str(tmp_path / "at")).trigger(once=True).start()
        query.awaitTermination(120)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    got = {r.page: (r.created, r.moved, r.edits, r.unique_editors) for r in spark.table("split").collect()}
    want = (T0 + datetime.timedelta(minutes=15), T0 + datetime.timedelta(minutes=18), 11, 4)
    assert got == dict.fromkeys((1, 2, 3), want)


def test_stream_equals_batch(spark, tmp_path):
    df = spark.createDataFrame([change("move", ns=6, prior_ns=14), change("edit"), change("create", db="nowiki")], schemas.CHANGE)
    df.write.parquet(str(tmp_path / "in"))
    jobs.run_available(jobs.article_stream(jobs.landed(spark, str(tmp_path / "in"), schemas.CHANGE)).select("key", "topic"), str(tmp_path / "out"), str(tmp_path / "at"))
    batch = jobs.article_stream(df).select("key", "topic")
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect())) == sorted(map(tuple, batch.collect()))


def test_log_options(spark):
    o = kafka.start_options("t", [1, 2], since_per_partition={1: 5})
    assert '"1": 5' in o["startingOffsetsByTimestamp"] and '"2": -1' in o["startingOffsetsByTimestamp"]
    assert kafka.start_options("t", [1])["startingOffsets"] == "latest"
    with pytest.raises(ValueError):
        kafka.start_options("t", [1], since_ms=3, since_per_partition={1: 5})
    df = spark.createDataFrame([(bytearray(b"\x00\x00\x00\x00\x07body"),), (bytearray(b"\x01\x00\x00\x00\x07body"),), (bytearray(b"\x00"),)], "value binary")
    a, b, c = (r[0] for r in df.select(kafka.wire(F.col("value"))).collect())
    assert a.schema_id == 7 and bytes(a.body) == b"body" and b is None and c is None
    assert bytes(df.select(kafka.framed(F.lit(b"x"), 7)).first()[0]) == b"\x00\x00\x00\x00\x07x"


def lister(project, namespace, after):
    return ([f"{project}{namespace}a"], "more") if after is None else ([f"{project}{namespace}b"], None)


def test_pages(spark):
    def fetch(key):
        if key == "bad":
            raise OSError("gone")
        return key.upper()

    rows = pages.fetched(spark.createDataFrame([("a",), ("bad",)], "title string"), fetch).collect()
    assert sorted((r.title, r.content, r.error) for r in rows) == [("a", "A", None), ("bad", None, "OSError: gone")]
    assert pages.retry_after(503, None) == 300 and pages.retry_after(429, "7") == 7 and pages.retry_after(429, "Wed, 21 Oct") == 1


def test_sinks(spark):
    df = spark.createDataFrame([("g", 1), ("g", 2)], "g string, d int")
    assert sinks.json_array(df, ["g"], ["d"]).first().json == '[{"d":1},{"d":2}]'
    with pytest.raises(ValueError):
        sinks.envelope(df, "t")
