from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from folioflow.plans import select as S

SCHEMA = (
    "name string, identifier long, is_part_of struct<identifier:string,url:string>, namespace struct<identifier:int>, "
    "version struct<identifier:long,noindex:boolean,editor:struct<identifier:long,name:string>>, categories array<struct<name:string,url:string>>"
)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


FULL = ("Earth", 1, ("enwiki", "u"), (0,), (7, True, (3, "Ann")), [("a", "x"), ("b", "x")])
BARE = (None, 2, None, None, None, None)


def kept(df):
    return sorted(r.identifier for r in df.collect())


def test_fields_are_checked(spark):
    schema = frame(spark, FULL).schema
    for bad in (["nope"], ["version"], ["categories"], ["name.*"], ["version.editor"]):
        with pytest.raises(ValueError):
            S.validate_fields(schema, bad)
    assert S.validate_fields(schema, ["name", "version.*", "categories.url"])
    with pytest.raises(ValueError):
        S.validate_fields(schema, ["name"] * 256)
    assert S.has_field(schema, "version.editor.name") and S.has_struct(schema, "version") and S.has_slice(schema, "categories")


def test_prune(spark):
    df = frame(spark, FULL, BARE)
    out = S.prune(df, ["name", "version.editor.identifier", "is_part_of.*", "categories.url"])
    assert out.columns == ["name", "is_part_of", "version", "categories"]
    a, b = out.orderBy(out.name.isNull()).collect()
    assert a.version.asDict(True) == {"editor": {"identifier": 3}} and a.is_part_of.url == "u"
    assert [c.asDict() for c in a.categories] == [{"url": "x"}, {"url": "x"}] and b.version is None and b.categories is None
    assert S.prune(df, []).columns == []


def test_arrays_prune_the_scan(spark, tmp_path):
    frame(spark, FULL).write.parquet(str(tmp_path / "t"))
    out = S.prune(spark.read.parquet(str(tmp_path / "t")), ["categories.url", "version.identifier"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    read = plan[plan.index("ReadSchema") :]
    assert "categories:array<struct<url:string>>" in read and "noindex" not in read


def test_filters(spark):
    df = frame(spark, FULL, BARE)
    ok = {"name": "Earth", "is_part_of.identifier": "enwiki", "namespace.identifier": 0, "version.noindex": True}
    assert kept(S.where(df, ok)) == [1]
    assert kept(S.where(df, {**ok, "version.identifier": 8})) == []
    assert kept(S.where(df, {})) == [1, 2]
    assert kept(S.where(df, {"version.editor.name": "Ann"})) == [1]
    assert kept(S.where(df, {"categories.url": "x"})) == [1, 2], "a null array passes"
    assert kept(S.where(df, {"categories.name": "a"})) == [2], "every element must match"
    assert kept(S.where(df, {"version.identifier": 7.0})) == [1], "a whole float is an integer"
    assert kept(S.where(df, {"version.identifier": "7"})) == [], "kinds that don't fit are false"
    with pytest.raises(ValueError):
        S.validate_filters(df.schema, {"version": 1})
    with pytest.raises(ValueError):
        S.validate_filters(df.schema, {"name": 1})


def test_a_null_element_fails(spark):
    df = spark.createDataFrame([(1, [None]), (2, []), (3, [("x",)])], "identifier long, a array<struct<f:string>>")
    assert kept(S.where(df, {"a.f": "x"})) == [2, 3]


def test_list_dialect(spark):
    df = spark.createDataFrame([(1, 8.0, (10,)), (2, 9.0, (10,)), (3, 9.0, (0,))], "identifier long, score double, namespace struct<identifier:int>")
    assert kept(S.list_filter(df, {"namespace.identifier": 10.0, "score": 8.5})) == [2]
    assert kept(S.list_filter(df, {"score": True})) == [1, 2, 3]


def test_flatten_and_rebuild(spark):
    df = frame(spark, FULL)
    assert S.flatten(df, ["name", "version.editor.name"]).columns == ["name", "version__editor__name"]
    assert S.flatten(df, ["*"]).columns == df.columns
    assert df.select(S.rebuild(df, ["version.identifier", "name"])).first()[0] == '{"name":"Earth","version":{"identifier":7}}'


def test_parts_and_positions():
    assert S.parts_to_partitions([0, 9]) == [0, 1, 2, 3, 4, 45, 46, 47, 48, 49]
    with pytest.raises(ValueError):
        S.parts_to_partitions([10])
    assert S.distribute(list(range(5)), 3) == [[0, 1], [2, 3], [4]]
    with pytest.raises(ValueError):
        S.start_positions([1], since=1, since_per_partition={1: 2})
    with pytest.raises(ValueError):
        S.start_positions([1], since_per_partition={1: 2}, offsets={1: 3})


_ROWS = st.lists(st.tuples(st.integers(0, 99), st.one_of(st.none(), st.lists(st.one_of(st.none(), st.sampled_from("xy")), max_size=3))), min_size=1, max_size=12)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(_ROWS)
def test_forall_against_python(spark, rows):
    df = spark.createDataFrame([(i, None if a is None else [None if x is None else (x,) for x in a]) for i, a in rows], "identifier long, a array<struct<f:string>>")
    want = sorted(i for i, a in rows if not a or all(x == "x" for x in a))
    assert kept(S.where(df, {"a.f": "x"})) == want
