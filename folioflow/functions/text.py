"""Text, key, path and date columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def title(link: Column) -> Column:
    """Link to title: without ``./``, underscores as spaces, unescaped where the escapes are well formed."""
    bare = F.replace(F.regexp_replace(link, r"^\./", ""), F.lit("_"), F.lit(" "))
    return F.coalesce(F.try_url_decode(bare), bare)


def full_url(link: Column, base: Column) -> Column:
    """base and link, not unescaped; empty where an escape is malformed."""
    url = F.concat(base, F.regexp_replace(link, r"^\./", ""))
    return F.when(F.try_url_decode(url).isNull(), F.lit("")).otherwise(url)


def underscored(name: Column) -> Column:
    return F.replace(name, F.lit(" "), F.lit("_"))


def key(project: Column, name: Column) -> Column:
    return F.concat(F.lit("/"), project, F.lit("/"), name)


def version_identifier(project: Column, revision: Column) -> Column:
    return F.concat(F.lit("/"), project, F.lit("/"), revision.cast("string"))


def namespace_word(namespace: Column) -> Column:
    return F.when(namespace == 0, "articles").when(namespace == 6, "files").when(namespace == 10, "templates").when(namespace == 14, "categories")


def compacted_topic(project: Column, namespace: Column, version: str = "v1", location: str = "local", service: str = "structured-data") -> Column:
    """Name of the compacted topic; null where the namespace has none."""
    return F.concat(F.lit(f"{location}.{service}."), project, F.lit("-"), namespace_word(namespace), F.lit(f"-compacted.{version}"))


def event_topic(project: Column, event: Column, version: str = "v1", location: str = "local", service: str = "structured-data") -> Column:
    kind = F.when(project == "commonswiki", "commons").otherwise("article")
    return F.concat(F.lit(f"{location}.{service}."), kind, F.lit("-"), event, F.lit(f".{version}"))


def longest_repeat(text: Column) -> Column:
    """Length of the longest run of one character, case ignored; 0 if none repeats."""
    runs = F.transform(F.regexp_extract_all(F.lower(text), F.lit(r"(?s)((.)\2+)"), F.lit(1)), lambda r: F.char_length(r))
    return F.coalesce(F.array_max(runs), F.lit(0))


def longest_new_repeat(current: Column, previous: Column) -> Column:
    return F.when(longest_repeat(current) > longest_repeat(previous), longest_repeat(current)).otherwise(F.lit(1))


def diff_size(current: Column, previous: Column) -> Column:
    return (F.octet_length(current) - F.octet_length(previous)).cast("long")


#: Names of the maintenance templates that are counted.
MAINTENANCE = {"citation_needed_count": "Citation needed", "pov_count": "POV", "clarification_needed_count": "clarify", "update_count": "update"}


def maintenance_tags(wikitext: Column) -> Column:
    count = lambda name: F.regexp_count(wikitext, F.lit(r"(?i)\{\{" + name + r"(\|*).*?\}\}")).cast("long")
    return F.struct(*[count(name).alias(field) for field, name in MAINTENANCE.items()])


def uppercase_words(words: Column) -> Column:
    """Words of two letters or more without a small one."""
    return F.filter(words, lambda w: (F.char_length(w) >= 2) & (w == F.upper(w)) & (w != F.lower(w)))


def bounded(count: Column, most: int, complete: Column) -> Column:
    """Count as text: ``>most`` above the bound, ``>count`` if counting had to stop, else the count."""
    text = count.cast("string")
    return F.when(count > most, F.lit(f">{most}")).when(~complete, F.concat(F.lit(">"), text)).otherwise(text)


def backoff(failures: Column, base: int = 2) -> Column:
    """Seconds to wait before trying again after so many failures."""
    return F.pow(F.lit(float(base)), failures.cast("double"))


def size_mb(size: Column) -> Column:
    return F.round(size.cast("double") / 1e6, 3)


def snapshot_id(project: Column, namespace: Column) -> Column:
    return F.concat(project, F.lit("_namespace_"), namespace.cast("string"))


def chunk_id(snapshot: Column, number: Column) -> Column:
    return F.concat(snapshot, F.lit("_chunk_"), number.cast("string"))


def hash_path(name: Column) -> Column:
    """Two levels of folders from the name's md5, then the name."""
    digest = F.md5(name.cast("binary"))
    return F.concat_ws("/", F.substring(digest, 1, 1), F.substring(digest, 1, 2), name)


def entity_path(entity: str, identifier: Column, kind: str = "archive", group: str | None = None) -> Column:
    """Object keys: kind is metadata, archive, chunk or aggregation; group adds a suffix to what a group may see."""
    suffix = f"_{group}" if group else ""
    if kind == "aggregation":
        return F.lit(f"aggregations/{entity}/{entity}{suffix}.ndjson")
    if kind == "chunk":
        chunk = F.element_at(F.split(identifier, "_"), -1)
        owner = F.regexp_replace(identifier, r"_chunk_\d+$", "")
        return F.concat(F.lit("chunks/"), owner, F.lit("/chunk_"), chunk, F.lit(f"{suffix}.tar.gz"))
    return F.concat(F.lit(f"{entity}/"), identifier, F.lit(f"{suffix}." + ("json" if kind == "metadata" else "tar.gz")))


def redirect_revision(url: Column, expected: Column) -> Column:
    found = F.regexp_extract(url, r"Special:Redirect/revision/(\d+)", 1)
    return (found != "") & (found.try_cast("long") == expected)


# Dates


def last_revised(text: Column) -> Column:
    """``MM/yy`` of an ISO second; a text that isn't one gives 01/01."""
    at = F.try_to_timestamp(F.when(text.rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ$"), text), F.lit("yyyy-MM-dd'T'HH:mm:ss'Z'"))
    return F.coalesce(F.date_format(at, "MM/yy"), F.lit("01/01"))


def between_hours(at: Column, start: Column, hours: int) -> Column:
    """Whether start <= at <= start + hours; false if either is null."""
    return F.coalesce((at >= start) & (at <= start + F.make_interval(hours=F.lit(hours))), F.lit(False))


def last_hour_start(now: Column) -> Column:
    return F.date_trunc("hour", now) - F.make_interval(hours=F.lit(1))


def previous_month(now: Column) -> Column:
    return F.date_format(F.add_months(now.cast("date"), -1), "yyyy-MM")


def is_late(created: Column, published: Column, threshold_ms: int = 500) -> Column:
    return F.unix_millis(published) - F.unix_millis(created) > threshold_ms


def batch_path(since: Column, identifier: Column, hourly: bool = True) -> Column:
    return F.concat(F.lit("batches/"), F.date_format(since, "yyyy-MM-dd/HH" if hourly else "yyyy-MM-dd"), F.lit("/"), identifier)
