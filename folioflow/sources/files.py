"""Readers of landed files: line JSON, listings, static dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def ndjson(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def listing(spark: SparkSession, path: str, pattern: str = "*.json", recursive: bool = False) -> DataFrame:
    """path and text of each file whose name fits the pattern."""
    lines = spark.read.option("wholetext", "true").option("pathGlobFilter", pattern).option("recursiveFileLookup", str(recursive).lower()).text(path)
    return lines.select(F.input_file_name().alias("path"), F.col("value").alias("text"))


def metadata_lines(spark: SparkSession, path: str) -> DataFrame:
    """Snapshot metadata with a size, one JSON text a row, and which files could not be read as JSON."""
    own = listing(spark, path, recursive=True).withColumn("size", F.get_json_object("text", "$.size.value").cast("double"))
    return own.select("path", "text", F.col("size").isNull().alias("failed")).filter("failed OR size > 0").filter(F.col("failed") | (F.get_json_object("text", "$.size.value").cast("double") > 0))


def static_config(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """projects, languages, namespaces (JSON lines) and partitions (CSV with a header) of a folder."""
    kinds = {"projects": "identifier string, code string, language string, url string", "languages": "identifier string, name string, direction string", "namespaces": "identifier int, name string, description string"}
    out = {name: spark.read.schema(ddl).json(f"{path}/{name}.json") for name, ddl in kinds.items()}
    out["partitions"] = spark.read.schema("project string, namespace int, partitions int").option("header", "true").csv(f"{path}/partitions.csv")
    return out
