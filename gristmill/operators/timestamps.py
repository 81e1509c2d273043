"""Mixed timestamp strings to UTC instants through a persisted dictionary (problem 4).

The distinct (raw string, zone, date order) triples of all rows are parsed once each and kept
in a dictionary below a folder; a later update parses only triples that the folder lacks and
appends them as one more increment. Rows get their instants by an equi-join with it.

Cases: null, blank, incomplete, ambiguous or impossible values have a null instant; repeated
rows are kept; an empty table adds nothing; a failed write leaves no readable increment; triples
that two writers added at once count once.
"""

from __future__ import annotations

import hashlib
import inspect
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from gristmill.functions import instants
from gristmill.functions.instants import parse
from gristmill.operators.shapes import page_hits
from gristmill.session import new_path, shared_dir

KEY = ["raw", "zone", "date_order"]
SCHEMA = "raw string, zone string, date_order string, utc_us bigint, ago_us bigint"


def _parse_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found = [parse(raw, zone or None, order or None) for raw, zone, order in zip(batch["raw"], batch["zone"], batch["date_order"], strict=True)]
        batch["utc_us"] = pd.array([a for a, _ in found], dtype="Int64")
        batch["ago_us"] = pd.array([b for _, b in found], dtype="Int64")
        yield batch


def dictionary_path(spark: SparkSession, data: str) -> str:
    """Where the dictionary of a data folder lies in the shared folder. Another version of the parser has another one."""
    key = hashlib.sha256(f"{data}\0{inspect.getsource(instants)}".encode()).hexdigest()[:24]
    return f"{shared_dir(spark).rstrip('/')}/gristmill/instants-of-{key}"


class InstantDictionary:
    """Distinct raw values and what they parse to, below ``path``: one parquet folder per increment."""

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark, self.path = spark, path or new_path(spark, "instants")

    def read(self) -> DataFrame:
        try:
            return self.spark.read.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(self.path)
        except AnalysisException:
            return self.spark.createDataFrame([], SCHEMA)

    def update(self, values: DataFrame) -> None:
        """values: raw, zone, date_order; parses and appends the triples not yet kept, in one more increment."""
        keys = values.filter(F.col("raw").isNotNull()).select("raw", *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in KEY[1:]]).distinct()
        known = self.read()
        if known.inputFiles():
            keys = keys.join(known.select(*KEY), KEY, "left_anti")
        keys.mapInPandas(_parse_batches, SCHEMA).write.parquet(f"{self.path}/increment-{uuid.uuid4().hex}")

    def normalise(self, rows: DataFrame) -> DataFrame:
        """Adds ``utc_us`` to rows that have raw, zone, date_order and collected_us; rows without an instant keep null."""
        keyed = rows.withColumns({c: F.coalesce(F.col(c), F.lit("")) for c in KEY[1:]})
        named = self.read().filter("utc_us is not null or ago_us is not null").groupBy(*KEY).agg(F.first("utc_us").alias("utc_us"), F.first("ago_us").alias("ago_us"))
        joined = keyed.join(named.withColumnRenamed("utc_us", "at_us"), KEY, "left")
        return joined.withColumn("utc_us", F.coalesce("at_us", F.col("collected_us") - F.col("ago_us"))).drop("at_us", "ago_us")


def timestamp_rows(news: DataFrame, jobs: DataFrame, works: DataFrame, pages: DataFrame, sources: DataFrame) -> DataFrame:
    """(tbl, row_id, raw, zone, date_order, collected_us) of the four timestamp fields."""
    us = F.unix_micros
    hits = page_hits(pages, "retrieved_at").select(
        F.lit("api_pages").alias("tbl"),
        F.expr("try_variant_get(hit, '$.objectID', 'string')").alias("row_id"),
        F.expr("try_variant_get(hit, '$.created_at', 'string')").alias("raw"),
        F.lit("hackernews_ai").alias("source_name"),
        us("retrieved_at").alias("collected_us"),
    )
    rows = (
        news.select(F.lit("news").alias("tbl"), F.col("id").alias("row_id"), F.col("published_at").alias("raw"), "source_name", us("collected_at").alias("collected_us"))
        .unionByName(jobs.select(F.lit("jobs").alias("tbl"), F.col("id").alias("row_id"), F.col("posted_at").alias("raw"), "source_name", us("collected_at").alias("collected_us")))
        .unionByName(
            works.select(
                F.lit("openalex_works").alias("tbl"),
                F.col("id").alias("row_id"),
                F.col("publication_date").alias("raw"),
                F.lit("openalex").alias("source_name"),
                us("retrieved_at").alias("collected_us"),
            )
        )
        .unionByName(hits.filter("row_id is not null"))
        .filter("raw is not null")
    )
    zones = sources.select("name", F.col("time_zone").alias("zone"), "date_order").dropDuplicates(["name"])
    return rows.join(zones, rows.source_name == zones.name, "left").select("tbl", "row_id", "raw", "zone", "date_order", "collected_us")


def found_instants(rows: DataFrame, dictionary: InstantDictionary) -> DataFrame:
    """(tbl, row_id, utc_us) of every value that names an instant."""
    dictionary.update(rows)
    return dictionary.normalise(rows).filter("utc_us is not null").select("tbl", "row_id", "utc_us")
