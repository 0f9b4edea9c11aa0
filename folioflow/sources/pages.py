"""Remote page lookups: a call for each key inside the executors, its error kept in the row.

A fetcher takes a key and returns text; it is given by the caller (an HTTP client, or a stub in tests).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

RETRY_AFTER, GATEWAY_WAIT = 1, 300


def retry_after(status: int, header: str | None, default: int = RETRY_AFTER) -> int:
    """Seconds to wait: the header's number, a fixed time for gateway errors, else the default (dates are passed over)."""
    if header and header.strip().isdigit():
        return int(header)
    return GATEWAY_WAIT if 502 <= status <= 504 else default


def fetched(keys: DataFrame, fetch: Callable[[str], str], column: str = "title", workers: int = 8) -> DataFrame:
    """column, content and error of each key."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def one(key: str) -> tuple[str, str | None, str | None]:
            try:
                return key, fetch(key), None
            except Exception as e:  # the row's own result
                return key, None, f"{type(e).__name__}: {e}"

        with ThreadPoolExecutor(workers) as pool:
            for batch in batches:
                yield pd.DataFrame(list(pool.map(one, batch[column])), columns=[column, "content", "error"])

    return keys.select(column).mapInPandas(run, f"{column} string, content string, error string")


class _Namespace(InputPartition):
    def __init__(self, project: str, namespace: int):
        super().__init__((project, namespace))


class AllPages(DataSource):
    """Titles of each (project, namespace), one partition each; ``lister`` is ``module:function``, called with both
    and a continuation (None first) and returning (titles, next continuation or None)."""

    @classmethod
    def name(cls) -> str:
        return "all_pages"

    def schema(self) -> str:
        return "project string, namespace int, title string"

    def reader(self, schema) -> DataSourceReader:
        return _AllPagesReader(self.options)


class _AllPagesReader(DataSourceReader):
    def __init__(self, options):
        self.lister = options["lister"]
        self.projects = options["projects"].split(",")
        self.namespaces = [int(n) for n in options.get("namespaces", "0").split(",")]

    def partitions(self) -> list[InputPartition]:
        return [_Namespace(p, n) for p in self.projects for n in self.namespaces]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        import importlib

        module, _, function = self.lister.partition(":")
        lister = getattr(importlib.import_module(module), function)
        project, namespace = partition.value
        after = None
        while True:
            titles, after = lister(project, namespace, after)
            yield from ((project, namespace, t) for t in titles)
            if after is None:
                return


def register(spark: SparkSession) -> None:
    spark.dataSource.register(AllPages)
