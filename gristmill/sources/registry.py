"""The catalogue of sources, and the connector interface for captured payloads."""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

VERTICALS = ["research", "startups", "products", "news", "jobs"]
DISCOVERY = ["official_api", "rss", "sitemap", "json_ld", "public_page"]
#: Files of a captured folder that are read in one task.
FILES = 64
REGISTRY_SCHEMA = "name string, vertical string, base_url string, discovery_mechanism string, enabled boolean"


def enabled_sources(registry: DataFrame, vertical: str | None = None) -> DataFrame:
    found = registry.filter("enabled")
    return found.filter(F.col("vertical") == vertical) if vertical else found


def only_enabled(rows: DataFrame, registry: DataFrame, source: str = "source_name") -> DataFrame:
    """Rows of sources that the registry enables."""
    names = enabled_sources(registry).select(F.col("name").alias(source))
    return rows.join(names, source, "left_semi")


class _Files(InputPartition):
    def __init__(self, first: int, paths: list[str]):
        super().__init__(first)
        self.first, self.paths = first, paths


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.folder, self.source = Path(options["path"]), options.get("source", "captured")
        self.files = int(options.get("filesPerPartition", FILES))

    def partitions(self):
        paths = [str(p) for p in sorted(self.folder.rglob("*")) if p.is_file()]
        return [_Files(i, paths[i : i + self.files]) for i in range(0, len(paths), self.files)]

    def read(self, partition: _Files) -> Iterator[tuple]:
        for ord_, path in enumerate(partition.paths, partition.first):
            yield (self.source, path, 200, Path(path).read_bytes().decode("utf-8", "replace"), ord_)


class CapturedPayloads(DataSource):
    """``spark.read.format("captured").option("path", folder)``: one row per file of a folder that every worker sees.

    Rows: source_name, url, status_code, text, ord. A subclass with its own reader fetches live. The driver lists the
    folder: for millions of files or another file system take ``captured_pages``.
    """

    @classmethod
    def name(cls) -> str:
        return "captured"

    def schema(self) -> str:
        return "source_name string, url string, status_code int, text string, ord int"

    def reader(self, schema):
        return _Reader(self.options)


def captured_pages(spark: SparkSession, folder: str, source: str = "captured") -> DataFrame:
    """Like the connector's rows, of any file system that Spark reads, listed and packed into partitions by Spark; ``ord`` is
    the path, which sorts as the connector's number does."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return files.select(F.lit(source).alias("source_name"), F.col("path").alias("url"), F.lit(200).alias("status_code"), F.col("content").cast("string").alias("text"), F.col("path").alias("ord"))


def register_sources(spark: SparkSession) -> None:
    spark.dataSource.register(CapturedPayloads)
