"""Left joins with dimensions, and the one update: overwriting metadata of rows that exist."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.functions.urls import github_repo


def repo_key(url: str):
    repo = github_repo(F.col(url))
    return F.lower(F.concat(repo["owner"], F.lit("/"), repo["repo"]))


def with_repo_metadata(papers: DataFrame, repos: DataFrame) -> DataFrame:
    """Adds github_stars; an address whose repository is known to be gone becomes null. repos: repo, found, stars; each once."""
    keyed = papers.drop("github_stars").withColumn("repo", repo_key("github_url"))
    joined = keyed.join(repos.select("repo", "found", "stars"), "repo", "left")
    gone = F.col("found").isNotNull() & ~F.col("found")
    return joined.withColumn("github_url", F.when(~gone, F.col("github_url"))).withColumn("github_stars", F.when(~gone, F.col("stars"))).drop("repo", "found", "stars")


def overwrite(rows: DataFrame, updates: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Rows with the updates' values where there is one; updates without a row change nothing."""
    new = updates.select(key, F.lit(True).alias("_hit"), *[F.col(c).alias(f"_new_{c}") for c in columns])
    joined = rows.join(new, key, "left")
    return joined.select(*[F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in rows.columns])


def _without_keys_of(left, right):
    return F.map_filter(left, lambda k, _: ~F.map_contains_key(right, k))


def merged_metadata(*maps: str):
    """One map of several, later ones winning; null maps count as empty."""
    empty = F.expr("cast(map() as map<string,string>)")
    out = empty
    for m in maps:
        right = F.coalesce(F.col(m), empty)
        out = F.map_concat(_without_keys_of(out, right), right)
    return out


def without_nulls(fields):
    """A map without entries whose value is null."""
    return F.map_filter(fields, lambda _, v: v.isNotNull())
