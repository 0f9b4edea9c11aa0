"""The streaming forms: normalise changes, serve articles, keep integrity state, upsert, batch by the hour."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState

from folioflow.operators import events as E
from folioflow.plans import select as S

#: Hours that state is kept.
HOURS_KEPT = 48


def landed(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int = 100) -> DataFrame:
    """A folder of Parquet files as a stream; files_per_trigger bounds a batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def article_stream(changes: DataFrame) -> DataFrame:
    """Changes to routed article events; all of it is row by row, so it is the batch plan on a stream."""
    return E.routed(E.to_articles(E.article_events(E.prefilter(changes))))


def served(articles: DataFrame, fields: Sequence[str], filters: Mapping[str, object]) -> DataFrame:
    """The live query: internal messages go, filters see the whole record, then fields are picked."""
    if S.has_field(articles.schema, "event.is_internal_message"):
        articles = articles.filter(~F.coalesce(F.col("event.is_internal_message"), F.lit(False)))
    return S.query(articles, fields, filters)


def hourly_counts(stream: DataFrame, ts: str, group: Sequence[str], late: str = "1 hour") -> DataFrame:
    """Whole hours [h, h + 1), closed when the watermark has passed them."""
    w = F.window(ts, "1 hour")
    return stream.withWatermark(ts, late).groupBy(w, *group).agg(F.count("*").alias("n")).select(F.col("window.start").alias("hour"), *group, "n")


def upsert_into(stream: DataFrame, merge: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Each batch goes to merge, which takes the batch's number, so that a repeated batch can be told."""
    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def run_available(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """All that is there now, to a folder of Parquet files, exactly once."""
    query = stream.writeStream.outputMode(mode).format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def create_stream(spark: SparkSession, name: str, stream: DataFrame, if_not_exists: bool = False) -> None:
    """A stream under a name for ``spark.sql``; ValueError if there is one and if_not_exists isn't given."""
    if spark.catalog.tableExists(name):
        if not if_not_exists:
            raise ValueError(f"there is a stream {name}")
        return
    stream.createTempView(name)


def drop_stream(spark: SparkSession, name: str, if_exists: bool = True) -> None:
    if not spark.catalog.dropTempView(name) and not if_exists:
        raise ValueError(f"no stream {name}")


def push(spark: SparkSession, sql: str, path: str, checkpoint: str) -> None:
    """Rows of a SQL query over a named stream, as they come; ends when all that is there has been read."""
    run_available(spark.sql(sql), path, checkpoint)


INTEGRITY = "page long, created timestamp, moved timestamp, edits long, unique_editors long"
_STATE = "created long, created_set long, moved long, moved_set long, first_push long, editors array<string>, versions array<long>"
#: Kinds of changes that the state depends on.
_FOLDED = ("create", "move", "edit")


def _micros(at: pd.Timestamp) -> int:
    return at.value // 1000


def _integrity(hours: int):
    """State of a page: when it was created and moved, each kept for some hours from its last write, and its
    versions while it is tracked, kept for as long from the first of them.  One page's rows of a batch are held at once."""
    kept = hours * 3_600_000

    def run(key: tuple, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = state.getCurrentProcessingTimeMs()
        created, created_set, moved, moved_set, first, editors, versions = state.get if state.exists else (None, 0, None, 0, 0, [], [])
        editors, versions = list(editors), list(versions)
        created = created if now - created_set < kept else None
        moved = moved if now - moved_set < kept else None
        if versions and now - first >= kept:
            editors, versions = [], []
        if state.hasTimedOut and created is None and moved is None and not versions:
            state.remove()
            return
        # A page's rows are split wherever an Arrow batch is full, so they are put in order all together.
        parts = [] if state.hasTimedOut else [batch[batch.kind.isin(_FOLDED)] for batch in rows]
        for r in pd.concat(parts).sort_values(["at", "version"]).itertuples(index=False) if parts else ():
            if r.kind == "create" and r.namespace == 0:
                created, created_set = _micros(r.at), now
            elif r.kind == "move" and r.namespace == 0:
                moved, moved_set = _micros(r.at), now
            elif r.kind == "edit" and (created is not None or moved is not None):
                first = first if versions else now
                editors.append(r.editor)
                versions.append(int(r.version))
        state.update((created, created_set, moved, moved_set, first, editors, versions))
        state.setTimeoutDuration(kept)
        stamp = lambda x: pd.to_datetime([x], unit="us")
        yield pd.DataFrame({"page": [key[0]], "created": stamp(created), "moved": stamp(moved), "edits": [len(versions)], "unique_editors": [len({e.lower() for e in editors})]})

    return run


def integrity_stream(changes: DataFrame, hours: int = HOURS_KEPT) -> DataFrame:
    """changes (page, kind, namespace, version, editor, at) to the state of each page after each batch."""
    return changes.groupBy("page").applyInPandasWithState(_integrity(hours), INTEGRITY, _STATE, "update", "ProcessingTimeTimeout")
