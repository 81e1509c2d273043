"""Run counters in one pass, per source and overall."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STATUSES = ["extraction_failed", "invalid", "stale", "future_dated", "duplicate", "inserted"]


def run_metrics(routed: DataFrame, *by: str) -> DataFrame:
    """discovered, one counter per status and rejected, per group or overall."""
    counters = [F.count_if(F.col("status") == s).alias(s) for s in STATUSES]
    rejected = F.count_if(F.col("status").isin("invalid", "stale", "future_dated", "extraction_failed")).alias("rejected")
    return routed.groupBy(*by).agg(F.count("*").alias("discovered"), *counters, rejected)


def by_source_with_zero(registry: DataFrame, rows: DataFrame, source: str = "source_name") -> DataFrame:
    """(name, n) of every registered source, those without rows with 0."""
    counts = rows.groupBy(F.col(source).alias("name")).agg(F.count("*").alias("n"))
    return registry.select("name").join(counts, "name", "left").select("name", F.coalesce("n", F.lit(0)).alias("n"))


def rejection_reasons(routed: DataFrame) -> DataFrame:
    """(source_name, reason, n): why rows were turned away."""
    reason = F.when(F.col("status") == "invalid", F.array_join("errors", "; ")).otherwise(F.col("status"))
    return routed.filter("status not in ('inserted', 'duplicate')").groupBy("source_name", reason.alias("reason")).agg(F.count("*").alias("n"))


def method_histogram(log: DataFrame) -> DataFrame:
    return log.groupBy("method").agg(F.count("*").alias("n"))


def facet_counts(df: DataFrame, facet: str) -> DataFrame:
    """(facet, n) of values that occur; null is no facet."""
    return df.filter(F.col(facet).isNotNull()).groupBy(facet).agg(F.count("*").alias("n"))
