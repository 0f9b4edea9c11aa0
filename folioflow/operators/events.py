"""Page changes to article events: flat-map, transform, route, retry.  The same columns serve batch and stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.functions.text import compacted_topic, event_topic, key

#: Projects and namespaces that are served, unless a caller gives others.
PROJECTS = ("enwiki", "dewiki", "frwiki", "eswiki")
SERVED = (0, 6, 10, 14)
KINDS = ("create", "undelete", "edit", "delete", "move", "visibility_change")


def _served(namespace: Column, namespaces=SERVED) -> Column:
    return F.coalesce(namespace.isin(*namespaces), F.lit(False))


def prefilter(changes: DataFrame, projects=PROJECTS, namespaces=SERVED) -> DataFrame:
    """Changes of a known project with a served namespace, before or after."""
    either = _served(F.col("page.page_namespace"), namespaces) | _served(F.col("prior_state.page.page_namespace"), namespaces)
    return changes.filter(F.col("database").isin(*projects) & either)


def article_events(changes: DataFrame, namespaces=SERVED) -> DataFrame:
    """No, one or two events a change, each with its article's name; a redirect's edit is a deletion, a move also deletes the old name."""
    ok, redirect = _served(F.col("page.page_namespace"), namespaces), F.coalesce(F.col("page.page_is_redirect"), F.lit(False))
    kind = F.col("page_change_kind")

    def event(what: Column | str, name: str, space: str, when: Column) -> Column:
        what = F.lit(what) if isinstance(what, str) else what
        return F.when(when, F.struct(what.alias("type"), F.col(name).alias("name"), F.col(space).cast("int").alias("namespace")))

    own = lambda what, when: event(what, "page.page_title", "page.page_namespace", when)
    made = F.array(
        own("create", kind.isin("create", "undelete") & ok & ~redirect),
        own(F.when(redirect, "delete").otherwise("update"), (kind == "edit") & ok),
        own("delete", (kind == "delete") & ok & ~redirect),
        own("visibility-change", (kind == "visibility_change") & ok & ~redirect),
        own("move", (kind == "move") & ok & ~redirect),
        event("delete", "prior_state.page.page_title", "prior_state.page.page_namespace", (kind == "move") & _served(F.col("prior_state.page.page_namespace"), namespaces)),
    )
    return changes.select("*", F.explode(F.array_compact(made)).alias("e"))


def to_articles(events: DataFrame) -> DataFrame:
    """Flat article records of article_events."""
    shown = F.when(F.col("e.type") == "visibility-change", F.struct(F.col("revision.is_content_visible").alias("text"), F.col("revision.is_editor_visible").alias("editor"), F.col("revision.is_comment_visible").alias("comment")))
    return events.select(
        F.col("e.name").alias("name"), F.col("page.page_id").alias("identifier"), F.col("e.namespace").alias("namespace"),
        F.col("database").alias("project"), F.col("e.type").alias("event_type"), F.col("revision.rev_id").alias("version"),
        F.col("revision.rev_dt").alias("date_modified"), F.when(F.col("e.type") == "create", F.col("revision.rev_dt")).alias("date_created"),
        shown.alias("visibility"), key(F.col("database"), F.col("e.name")).alias("key"),
    )


def routed(articles: DataFrame, versions=("v1",)) -> DataFrame:
    """A row for each topic: the event's, and the compacted one of project and namespace (visibility changes have none)."""
    names = [event_topic(F.col("project"), F.col("event_type"), v) for v in versions]
    names += [F.when(F.col("event_type") != "visibility-change", compacted_topic(F.col("project"), F.col("namespace"), v)) for v in versions]
    return articles.select("*", F.explode(F.array_compact(F.array(*names))).alias("topic"))


def retried(failed: DataFrame, most: int = 10, error_topic: str = "error", dead_topic: str = "dead-letter") -> DataFrame:
    """Failed rows with their count raised, for the error topic or, beyond the most, the dead-letter topic."""
    n = F.coalesce(F.col("fail_count"), F.lit(0)) + 1
    return failed.withColumns({"fail_count": n, "topic": F.when(n > most, dead_topic).otherwise(error_topic)})
