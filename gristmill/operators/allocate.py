"""Target allocation over ordered sources. Only counts per source reach the driver."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gristmill.operators.dedup import capped_per_group


def fill_forward(available: list[tuple[str, int]], target: int) -> dict[str, int]:
    """What each source gives: an equal share of what is still missing, unused shares going to later sources."""
    taken, left = {}, target
    for i, (name, n) in enumerate(available):
        share = max(1, math.ceil(left / (len(available) - i))) if left > 0 else 0
        taken[name] = min(share, n)
        left -= taken[name]
    return taken


def fill_in_passes(available: list[tuple[str, int]], target: int, passes: int) -> dict[str, int]:
    """Like ``fill_forward``, then sources with more to give are asked again for the shortfall, for so many passes in all."""
    taken = dict.fromkeys((name for name, _ in available), 0)
    for _ in range(passes):
        left = target - sum(taken.values())
        open_sources = [(name, n - taken[name]) for name, n in available if n > taken[name]]
        if left <= 0 or not open_sources:
            break
        more = fill_forward(open_sources, left)
        if not sum(more.values()):
            break
        for name, n in more.items():
            taken[name] += n
    return taken


def even_split(target: int, sources: int) -> int:
    return max(1, target // sources)


def take_counts(df: DataFrame, source: str, order: list[str | Column], taken: dict[str, int]) -> DataFrame:
    """The first rows of each source, as many as it gives."""
    quota = df.sparkSession.createDataFrame(list(taken.items()) or [("", 0)], f"{source} string, _take bigint")
    # the quota has one row per source, as many as the driver counted
    return capped_per_group(df.join(F.broadcast(quota), source), [source], order, F.col("_take")).drop("_take")


def counts_of(df: DataFrame, source: str, order: list[str]) -> list[tuple[str, int]]:
    """(source, rows) in the given order of sources; sources beyond it are left out."""
    found = {r[source]: r["n"] for r in df.filter(F.col(source).isin(order)).groupBy(source).agg(F.count("*").alias("n")).collect()}
    return [(name, found.get(name, 0)) for name in order]


def facet_take(facets: DataFrame, facet: str, wanted: int, cap: int = 1000) -> DataFrame:
    """facets: facet, n. Adds taken: facets by count, then name, each up to cap, until ``wanted`` is reached."""
    order = Window.orderBy(F.desc("n"), F.asc(facet)).rowsBetween(Window.unboundedPreceding, -1)  # one row per facet value
    capped = facets.withColumn("_n", F.least("n", F.lit(cap)))
    before = F.coalesce(F.sum("_n").over(order), F.lit(0))
    return capped.withColumn("taken", F.greatest(F.lit(0), F.least("_n", F.lit(wanted) - before))).drop("_n")
