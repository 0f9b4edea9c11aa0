"""Struct columns: editors, entities, scores, images, whole versions and articles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Roles that make a patroller, and roles with advanced rights.
PATROLLERS = ("rollback", "abusefilter", "patroller", "reviewer", "autoreview", "autoreviewer", "editor", "autoeditor", "eliminator")
ADVANCED = ("checkuser", "bureaucrat", "oversight", "steward")

#: The license of all articles.
LICENSE = {"name": "Creative Commons Attribution-ShareAlike License 4.0", "identifier": "CC-BY-SA-4.0", "url": "https://creativecommons.org/licenses/by-sa/4.0/"}


def editor_flags(groups: Column) -> Column:
    any_of = lambda roles: F.coalesce(F.arrays_overlap(groups, F.array(*map(F.lit, roles))), F.lit(False))
    return F.struct(any_of(("bot",)).alias("is_bot"), any_of(("sysop",)).alias("is_admin"), any_of(PATROLLERS).alias("is_patroller"), any_of(ADVANCED).alias("has_advanced_rights"))


def is_anonymous(user: Column) -> Column:
    return user == 0


def entity(identifier: Column, base: str) -> Column:
    return F.when(identifier != "", F.struct(identifier.alias("identifier"), F.concat(F.lit(base), identifier).alias("url")))


def entities(usage: Column, base: str) -> Column:
    """Map from id to aspects as a list of entities, by id."""
    made = F.transform(F.map_entries(usage), lambda e: F.struct(e["key"].alias("identifier"), F.concat(F.lit(base), e["key"]).alias("url"), e["value"].alias("aspects")))
    return F.array_sort(made)


def probability(prediction: Column, true: Column) -> Column:
    """Prediction with the probabilities of both outcomes; null without a score."""
    return F.when(true.isNotNull(), F.struct(prediction.alias("prediction"), F.struct(true.alias("true"), (1 - true).alias("false")).alias("probability")))


def reference_risk(count: Column, score: Column, low: Column, mean: Column, median: Column) -> Column:
    survival = F.struct(low.alias("min"), mean.alias("mean"), median.alias("median"))
    return F.when(score.isNotNull(), F.struct(count.alias("reference_count"), score.alias("reference_risk_score"), survival.alias("survival_ratio")))


def image(url: Column, width: Column, height: Column, thumbnail: Column | None = None) -> Column:
    own = [url.alias("content_url"), width.alias("width"), height.alias("height")]
    return F.when(url.isNotNull(), F.struct(*own, *([thumbnail.alias("thumbnail")] if thumbnail is not None else [])))


def license_row(language: Column) -> Column:
    return F.array(F.struct(*[F.lit(v).alias(k) for k, v in LICENSE.items()], language.alias("in_language")))


def flagged_stable(stable: Column, last: Column) -> Column:
    return F.coalesce(stable == last, F.lit(False))


def without_zeros(**fields: Column) -> Column:
    """A struct whose zero values are null, so that to_json leaves them out."""
    zero = lambda c: F.when((c.cast("string") != "") & (c.cast("string") != "0") & (c.cast("string") != "0.0") & (c.cast("string") != "false"), c)
    return F.struct(*[zero(c).alias(n) for n, c in fields.items()])
