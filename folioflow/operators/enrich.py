"""Enrichment: article events joined with what the lookups know, to article records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.functions import text as X
from folioflow.operators.aggregates import deltas
from folioflow.operators.state import substring_any


def _joined(rows: DataFrame, lookups: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """rows with a struct (null on a miss) of each lookup: its rows and the column that both have."""
    for name, (own, on) in lookups.items():
        rest = [c for c in own.columns if c != on]
        rows = rows.join(own.select(on, F.struct(*rest).alias(name)), on, "left")
    return rows


def enriched_updates(events: DataFrame, pages: DataFrame, users: DataFrame, scores: DataFrame, integrity: DataFrame, protected: DataFrame, noindex: Sequence[str]) -> DataFrame:
    """One article a change event.

    events: project, namespace, page_id, rev_id, user_id, user_text.  pages: page_id, title, previous, wikitext,
    words and previous_words (arrays; words are null if the revision's own text is missing, previous_words if no
    revision was before), templates (names).  users: user_id, edit_count, groups.  scores: rev_id,
    prediction, probability_true; only pages of namespace 0 of a wiki, with a text before, have a score.
    integrity: page_id, is_breaking_news.  protected: title, a page whose editor isn't told.
    Editor fields come from the lookup, else from the event; a lookup's miss leaves null and ends nothing.
    What a page's texts tell is drawn once for each page with an event, before the events join, so no text travels
    with an event; events meet the lookups of their own keys first, as they are narrow then.
    """
    had = F.col("previous").isNotNull()
    changed = had | F.col("previous_words").isNotNull()
    facts = {
        "has_before": had, "has_diff": changed, "characters": F.char_length("wikitext").cast("long"), "size": F.octet_length("wikitext").cast("long"),
        "diff_size": F.when(F.col("words").isNotNull(), X.diff_size(F.col("wikitext"), F.col("previous"))), "tags": X.maintenance_tags(F.coalesce("wikitext", F.lit(""))),
        "noindex": substring_any(F.coalesce("templates", F.array().cast("array<string>")), list(noindex)),
    }
    told = pages.join(events.select("page_id").distinct(), "page_id", "left_semi")
    told = told.select("page_id", "title", *[c.alias(n) for n, c in facts.items()], F.when(changed, F.col("previous_words")).alias("_p"), F.when(changed, F.col("words")).alias("_c"))
    told = deltas(told, ["page_id", "title", *facts], "_p", "_c").drop("proportional_increase", "proportional_decrease")
    told = told.join(protected.select("title", F.lit(True).alias("hidden")), "title", "left")
    told = told.select("page_id", *[F.col(c).alias(f"_{c}") for c in told.columns if c != "page_id"])  # no struct, so that what nobody reads is pruned
    rows = _joined(events, {"score": (scores, "rev_id"), "user": (users, "user_id"), "state": (integrity, "page_id")}).join(told, "page_id", "left")
    has_before = F.coalesce("_has_before", F.lit(False))
    eligible = (F.col("namespace") == 0) & F.col("project").endswith("wiki") & has_before
    editor = F.struct(
        F.col("user_id").alias("identifier"), F.col("user_text").alias("name"), F.col("user.edit_count").alias("edit_count"),
        (F.col("user_id") == 0).alias("is_anonymous"), F.coalesce(F.array_contains("user.groups", "sysop"), F.lit(False)).alias("is_admin"),
    )
    delta = F.struct(*[F.col(f"_{c}").alias(n) for c, n in (("increase", "increase"), ("decrease", "decrease"), ("sum", "sum"), ("diff_size", "size"))])
    version = F.struct(
        F.col("rev_id").alias("identifier"), F.when(~F.coalesce("_hidden", F.lit(False)), editor).alias("editor"),
        F.col("_characters").alias("number_of_characters"), F.col("_size").alias("size"),
        F.when(eligible, F.col("score")).alias("scores"), F.when(F.coalesce("_has_diff", F.lit(False)), delta).alias("diff"),
        F.col("state.is_breaking_news").alias("is_breaking_news"), F.coalesce("_noindex", F.lit(False)).alias("noindex"), F.coalesce("_tags", X.maintenance_tags(F.lit(""))).alias("maintenance_tags"),
    )
    return rows.select(
        F.col("_title").alias("name"), F.col("page_id").alias("identifier"), "project", "namespace", version.alias("version"),
        X.version_identifier(F.col("project"), F.col("rev_id")).alias("version_identifier"), X.key(F.col("project"), X.underscored(F.col("_title"))).alias("key"),
        X.compacted_topic(F.col("project"), F.col("namespace")).alias("topic"),
    )


def enriched_bulk(names: DataFrame, pages: DataFrame, users: DataFrame) -> DataFrame:
    """Articles of work items (project, namespace, titles): no diff and no score, as there is no change.

    pages: title, page_id, rev_id, user_id, wikitext.  A title without a page gives no article.
    """
    rows = names.select("project", "namespace", F.explode("titles").alias("title")).join(pages, "title")
    rows = _joined(rows, {"user": (users.filter("user_id > 0"), "user_id")})
    version = F.struct(F.col("rev_id").alias("identifier"), F.col("user.edit_count").alias("edit_count"), F.octet_length("wikitext").cast("long").alias("size"))
    return rows.select(F.col("title").alias("name"), F.col("page_id").alias("identifier"), version.alias("version"), X.key(F.col("project"), X.underscored(F.col("title"))).alias("key"), X.compacted_topic(F.col("project"), F.col("namespace")).alias("topic"))
