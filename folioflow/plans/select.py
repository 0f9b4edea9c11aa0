"""Projection and filters over nested records, by dotted paths.

A path leads through structs and arrays of structs; ``a.b.*`` takes all below b.  Requests are checked
against the schema before any plan is made; the plans are plain columns, so pruning and pushdown apply.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MOST_FIELDS = 255


def _inner(kind: T.DataType) -> T.DataType:
    while isinstance(kind, T.ArrayType):
        kind = kind.elementType
    return kind


def resolve(schema: T.StructType, prefix: str = "") -> dict[str, T.DataType]:
    """All dotted paths of a schema: structs, arrays of structs, and leaves."""
    found: dict[str, T.DataType] = {}
    for f in schema.fields:
        path = f"{prefix}{f.name}"
        found[path] = f.dataType
        if isinstance(inner := _inner(f.dataType), T.StructType):
            found |= resolve(inner, f"{path}.")
    return found


def has_field(schema: T.StructType, path: str) -> bool:
    kind = resolve(schema).get(path)
    return kind is not None and not isinstance(_inner(kind), T.StructType)


def has_struct(schema: T.StructType, path: str) -> bool:
    return isinstance(resolve(schema).get(path), T.StructType)


def has_slice(schema: T.StructType, path: str) -> bool:
    kind = resolve(schema).get(path)
    return isinstance(kind, T.ArrayType) and isinstance(_inner(kind), T.StructType)


def validate_fields(schema: T.StructType, fields: Iterable[str]) -> list[str]:
    """The fields, or ValueError for one that is unknown or names a record without a wildcard."""
    fields = list(fields)
    if len(fields) > MOST_FIELDS:
        raise ValueError(f"more than {MOST_FIELDS} fields")
    known = resolve(schema)
    for field in fields:
        path = field.removesuffix(".*")
        if path not in known:
            raise ValueError(f"no such field: {path}")
        record = isinstance(_inner(known[path]), T.StructType)
        if record and path == field:
            raise ValueError(f"{field} is a record, use wildcard {field}.*")
        if not record and path != field:
            raise ValueError(f"{path} has no fields")
    return fields


def _tree(fields: Iterable[str]) -> dict:
    root: dict = {}
    for field in fields:
        node, parts = root, field.split(".")
        for i, part in enumerate(parts):
            if part == "*":
                node["*"] = {}
            else:
                node = node.setdefault(part, {})
                if i == len(parts) - 1:
                    node["*"] = {}
    return root


def _pick(value: Column, kind: T.DataType, node: dict, skip: frozenset[str]) -> Column:
    if "*" in node and not skip:
        return value
    if isinstance(kind, T.StructType):
        names = [f for f in kind.fields if ("*" in node or f.name in node) and f.name not in skip]
        made = F.struct(*[_pick(value.getField(f.name), f.dataType, {"*": {}} if "*" in node else node[f.name], skip).alias(f.name) for f in names])
        return F.when(value.isNotNull(), made)
    if isinstance(kind, T.ArrayType) and isinstance(_inner(kind), T.StructType):
        inner = kind.elementType
        if isinstance(inner, T.StructType) and "*" not in node and all(not isinstance(_inner(inner[n].dataType), T.StructType) for n in node):
            # arrays_zip of the leaves' arrays, unlike transform, lets the scan read those leaves only
            return F.arrays_zip(*[value.getField(f.name).alias(f.name) for f in inner.fields if f.name in node])
        return F.transform(value, lambda x: _pick(x, inner, node, skip))
    return value


def prune(df: DataFrame, fields: Iterable[str], omit: Iterable[str] = ()) -> DataFrame:
    """Only the requested paths, in the schema's order and shape; omit: names left out below the root."""
    tree = _tree(validate_fields(df.schema, fields))
    skip = frozenset(omit)
    return df.select(*[_pick(F.col(f"`{f.name}`"), f.dataType, tree[f.name], skip).alias(f.name) for f in df.schema.fields if f.name in tree])


def flatten(df: DataFrame, fields: Iterable[str]) -> DataFrame:
    """a.b as a__b; no fields, or ``*``, takes all."""
    fields = list(fields)
    if not fields or fields == ["*"]:
        return df
    return df.select(*[F.col(f).alias(f.replace(".", "__")) for f in validate_fields(df.schema, fields)])


def rebuild(df: DataFrame, fields: Iterable[str]) -> Column:
    """The requested leaves as one JSON text of nested objects; null leaves are left out."""
    tree = _tree(validate_fields(df.schema, fields))
    return F.to_json(F.struct(*[_pick(F.col(f.name), f.dataType, tree[f.name], frozenset()).alias(f.name) for f in df.schema.fields if f.name in tree]))


def _kind_of(value: object) -> type[T.DataType] | tuple[type[T.DataType], ...] | None:
    if isinstance(value, bool):
        return T.BooleanType
    if isinstance(value, int):
        return T.IntegralType
    if isinstance(value, str):
        return T.StringType
    return None


def validate_filters(schema: T.StructType, filters: Mapping[str, object]) -> None:
    known = resolve(schema)
    for path, value in filters.items():
        kind = known.get(path)
        if kind is None:
            raise ValueError(f"no such field: {path}")
        if isinstance(_inner(kind), T.StructType):
            raise ValueError(f"{path} is a record and can't be compared")
        want = _kind_of(int(value) if isinstance(value, float) and value.is_integer() else value)
        if want is None or not isinstance(kind, want):
            raise ValueError(f"{value!r} doesn't fit {path}")


def equal(schema: T.StructType, path: str, value: object) -> Column:
    """Whether the leaf equals value; through arrays every element must; what has no struct on the way fails.

    An empty or null array passes; a null element fails; only strings, integers and booleans compare.
    """
    if isinstance(value, float) and value.is_integer():
        value = int(value)

    def walk(at: Column, kind: T.DataType, rest: list[str]) -> Column:
        if isinstance(kind, T.ArrayType):
            return F.coalesce(F.forall(at, lambda x: F.coalesce(walk(x, kind.elementType, rest), F.lit(False))), F.lit(True))
        if rest:
            return walk(at.getField(rest[0]), kind[rest[0]].dataType, rest[1:])
        want = _kind_of(value)
        return F.coalesce(at == F.lit(value), F.lit(False)) if want and isinstance(kind, want) else F.lit(False)

    first, *rest = path.split(".")
    return walk(F.col(f"`{first}`"), schema[first].dataType, rest)


def where(df: DataFrame, filters: Mapping[str, object]) -> DataFrame:
    """Rows for which all equalities hold; of two on one path a mapping keeps the last."""
    keep = F.lit(True)
    for path, value in filters.items():
        keep = keep & equal(df.schema, path, value)
    return df.filter(keep)


def query(df: DataFrame, fields: Iterable[str], filters: Mapping[str, object]) -> DataFrame:
    """Filters apply to the whole record, so they may use what is not selected."""
    validate_filters(df.schema, filters)
    return prune(where(df, filters), fields)


def list_filter(df: DataFrame, filters: Mapping[str, object]) -> DataFrame:
    """The listing dialect: strings are equal, numbers are greater than, the namespace's id is equal as an integer; others are ignored."""
    for path, value in filters.items():
        if isinstance(value, bool) or value is None:
            continue
        if path == "namespace.identifier" and isinstance(value, (int, float)):
            df = df.filter(F.col(path).cast("int") == int(value))
        elif isinstance(value, int):
            df = df.filter(F.col(path) == value)
        elif isinstance(value, float):
            df = df.filter(F.col(path) > value)
        elif isinstance(value, str):
            df = df.filter(F.col(path) == value)
    return df


def parts_to_partitions(parts: Iterable[int], partitions: int = 50, most_parts: int = 10) -> list[int]:
    """Part p stands for the partitions from p * k to (p + 1) * k - 1."""
    each = partitions // most_parts
    out: list[int] = []
    for p in parts:
        if not 0 <= p < most_parts:
            raise ValueError(f"part {p} of {most_parts}")
        out += range(p * each, (p + 1) * each)
    return out


def distribute(items: list, n: int) -> list[list]:
    """Runs of near equal length, the longer ones first."""
    size, more = divmod(len(items), n)
    cuts = [i * size + min(i, more) for i in range(n + 1)]
    return [items[a:b] for a, b in zip(cuts, cuts[1:], strict=False) if b > a]


def start_positions(partitions: list[int], since=None, since_per_partition: Mapping[int, object] | None = None, offsets: Mapping[int, int] | None = None) -> Column:
    """Whether a message is at or after its partition's start: since, then the partition's since, then its offset, else latest (none)."""
    per, offs = since_per_partition or {}, offsets or {}
    if since is not None:
        if per:
            raise ValueError("since excludes since_per_partition")
        return F.col("partition").isin(partitions) & (F.col("timestamp") >= F.lit(since))
    if both := per.keys() & offs.keys():
        raise ValueError(f"offset and time for one partition: {sorted(both)}")
    keep = F.lit(False)
    for p in partitions:
        if p in per:
            keep = keep | ((F.col("partition") == p) & (F.col("timestamp") >= F.lit(per[p])))
        elif p in offs:
            keep = keep | ((F.col("partition") == p) & (F.col("offset") >= offs[p]))
    return keep


def partition_case(parts: Mapping[int, tuple[str, object]], partitions: list[int]) -> Column:
    """Rows of the partitions, from an offset or a time where one is given."""
    case = F.lit(True)
    if parts:
        case = None
        for p, (kind, start) in parts.items():
            test = F.col("offset") >= start if kind == "offset" else F.col("timestamp") >= F.lit(start)
            case = (F if case is None else case).when(F.col("partition") == p, test)
        case = case.otherwise(F.lit(True))
    return F.col("partition").isin(partitions) & case
