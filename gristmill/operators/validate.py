"""Record rules, quarantine and routing: one status per row, one pass for valid rows, errors and counters."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.functions.dates import freshness, freshness_reason, strict_timestamp
from gristmill.functions.text import non_blank
from gristmill.functions.urls import github_repo, is_http_url


@dataclass(frozen=True)
class Rule:
    """A row must meet ``holds`` (null counts as not met); else it is quarantined with ``message``."""

    message: str
    holds: Column


def required(name: str) -> Rule:
    return Rule(f"{name}: must not be blank", non_blank(F.col(name)))


def http_url(name: str) -> Rule:
    return Rule(f"{name}: must be an http(s) URL", is_http_url(F.col(name)))


def not_negative(name: str) -> Rule:
    return Rule(f"{name}: must not be negative", F.col(name).isNull() | (F.col(name) >= 0))


def one_of(name: str, values: list[str]) -> Rule:
    return Rule(f"{name}: unknown value", F.col(name).isNull() | F.upper(F.col(name)).isin(values))


def research_rules() -> list[Rule]:
    repo = F.col("github_url").isNull() | github_repo(F.col("github_url")).isNotNull()
    return [required("title"), http_url("paper_url"), Rule("github_url: must be a repository", repo), not_negative("github_stars"), required("source_name")]


def news_rules(moment: str | None = None) -> list[Rule]:
    """moment: a column that holds the strict timestamp already."""
    read = F.col(moment) if moment else strict_timestamp(F.col("published_at"))
    strict = Rule("published_at: must be a complete timestamp with zone", read.isNotNull())
    return [required("title"), required("source_name"), required("full_text_location"), http_url("url"), strict]


def job_rules(posted: str = "posted_ts") -> list[Rule]:
    return [required("title"), required("company"), required("source_name"), http_url("url"), Rule("posted_at: must be a timestamp", F.col(posted).isNotNull())]


def startup_rules() -> list[Rule]:
    return [required("entity_name"), http_url("source_url"), not_negative("employee_count")]


def product_rules() -> list[Rule]:
    return [required("startup_name"), http_url("source_url")]


def errors_of(rules: list[Rule]) -> Column:
    """Messages of the rules that a row breaks."""
    return F.array_compact(F.array(*[F.when(~F.coalesce(r.holds, F.lit(False)), F.lit(r.message)) for r in rules]))


def validate(df: DataFrame, rules: list[Rule]) -> DataFrame:
    return df.withColumn("errors", errors_of(rules))


def split_valid(df: DataFrame, rules: list[Rule]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantined rows with their errors)."""
    checked = validate(df, rules)
    return checked.filter(F.size("errors") == 0).drop("errors"), checked.filter(F.size("errors") > 0)


def processing_errors(quarantined: DataFrame, category: str, url: str = "url") -> DataFrame:
    """Rows of the error table: source, address, category, message, context."""
    context = F.map_from_arrays(F.array(F.lit("n_errors")), F.array(F.size("errors").cast("string")))
    return quarantined.select("source_name", F.col(url).alias("url"), F.lit(category).alias("error_category"), F.array_join("errors", "; ").alias("message"), context.alias("context"))


def route(df: DataFrame, rules: list[Rule], moment: Column, reference: datetime, window_hours: float, skew_seconds: float, first: str = "is_first", failed: Column | None = None) -> DataFrame:
    """Adds status: extraction_failed, invalid, stale, future_dated, duplicate or inserted, in the order of the gates.

    ``first`` flags rows that win their natural key among the rows that pass the earlier gates.
    """
    state = freshness(moment, reference, window_hours, skew_seconds)
    checked = validate(df, rules).withColumn("reason", freshness_reason(moment, reference, window_hours, skew_seconds))
    status = F.when(F.lit(False) if failed is None else failed, "extraction_failed").when(F.size("errors") > 0, "invalid")
    status = status.when(state == "stale", "stale").when(state == "future", "future_dated").when(F.col(first), "inserted").otherwise("duplicate")
    return checked.withColumn("status", status)


def passes_gates(rules: list[Rule], moment: Column, reference: datetime, window_hours: float, skew_seconds: float) -> Column:
    """Whether a row reaches the sink: valid and fresh."""
    return (F.size(errors_of(rules)) == 0) & (freshness(moment, reference, window_hours, skew_seconds) == "fresh")
