"""First-writer-wins deduplication, insert-if-absent and set differences.

The order is always explicit: without one, which row wins would be left to chance.
Null keys never collide where a key is optional; equal orders go to the smaller tie column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gristmill.session import stage


def first_wins(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """The first row of each key; a partial top 1 runs before the shuffle, so hot keys shrink first."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def mark_first(df: DataFrame, keys: list[str], order: list[str | Column], flag: str = "is_first") -> DataFrame:
    """Keeps all rows and flags the first of each key.

    The first of each key comes from a partial aggregate and is joined back, so that a key with a
    third of all rows is not sorted in one task.
    """
    best = df.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(F.min(F.struct(*order)).alias("_best"))
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return df.join(best, same).withColumn(flag, F.struct(*order) == F.col("_best")).drop("_best", *[f"_k{i}" for i in range(len(keys))])


def insert_if_absent(new: DataFrame, existing: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """Rows to append: the first of each new key that the table lacks."""
    return first_wins(new.join(existing.select(*keys).distinct(), keys, "left_anti"), keys, order)


def two_key_dedup(df: DataFrame, url: str, key: str, order: list[str | Column]) -> DataFrame:
    """Adds outcome: kept, duplicate_url or duplicate_key, as if the rows were inserted one after the other in a table where
    both are unique. A row that is dropped claims neither; null urls and keys never collide.

    In each round the rows that come first in both of their groups are kept and those that share one with them dropped; what
    is left shares none with a kept row and goes into the next round. Of rows with equal order any comes first.
    """
    rows = stage(df.withColumn("_at", F.struct(*order, F.monotonically_increasing_id().alias("_row"))), "two-keys")
    open_rows, kept = rows.select("_at", F.col(url).alias("_u"), F.col(key).alias("_v")), None
    while kept is None or not open_rows.isEmpty():
        leads = open_rows
        for c in ("_u", "_v"):
            best = open_rows.filter(F.col(c).isNotNull()).groupBy(c).agg(F.min("_at").alias(f"_best{c}"))
            leads = leads.join(best, c, "left")
        leads = leads.filter(F.coalesce(F.col("_at") == F.col("_best_u"), F.lit(True)) & F.coalesce(F.col("_at") == F.col("_best_v"), F.lit(True)))
        leads = stage(leads.select("_at", "_u", "_v"), "two-keys-kept")
        kept = leads if kept is None else kept.unionByName(leads)
        free = open_rows.filter("_u is not null or _v is not null").join(leads.select("_u").filter("_u is not null"), "_u", "left_anti")
        open_rows = stage(free.join(leads.select("_v").filter("_v is not null"), "_v", "left_anti").select("_at", "_u", "_v"), "two-keys-open")
    claimed = kept.filter("_u is not null").select(F.col("_u"), F.col("_at").alias("_claim"))
    marked = rows.join(kept.select("_at", F.lit(True).alias("_kept")), "_at", "left").join(claimed, F.col(url) == F.col("_u"), "left")
    outcome = F.when(F.col("_kept"), "kept").when(F.col("_claim") < F.col("_at"), "duplicate_url").otherwise("duplicate_key")
    return marked.withColumn("outcome", outcome).drop("_at", "_kept", "_u", "_claim")


def minus_seen(new: DataFrame, seen: DataFrame, keys: list[str]) -> DataFrame:
    return new.join(seen.select(*keys).distinct(), keys, "left_anti")


def union_sources(*frames: DataFrame) -> DataFrame:
    """All rows of all adapters; a column that one lacks is null there."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def capped_per_group(df: DataFrame, group: list[str], order: list[str | Column], limit: int | Column) -> DataFrame:
    """At most ``limit`` first rows of each group (a report of the first k, by order)."""
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= limit).drop("_rank")


def discovered(df: DataFrame, source: str, unit: str, order: list[str | Column], max_items: int) -> DataFrame:
    """The units that a run of each source discovers, flagged ``first`` where they are new.

    Repeats count towards ``max_items``, but a run ends only at a new unit: the first one from there on. The unit at that
    number comes from a top k that is cut before the shuffle, the end from partial aggregates.
    """
    flagged = mark_first(df, [source, unit], order, "first").withColumn("_at", F.struct(*order))
    top = capped_per_group(flagged.select(source, "_at"), [source], ["_at"], max_items).groupBy(F.col(source).alias("_s")).agg(F.max("_at").alias("_reached"), F.count("*").alias("_n"))
    reached = top.filter(F.col("_n") >= max_items)
    ends = flagged.filter("first").join(reached, F.col(source).eqNullSafe(F.col("_s"))).filter(F.col("_at") >= F.col("_reached")).groupBy("_s").agg(F.min("_at").alias("_end"))
    joined = flagged.join(ends, F.col(source).eqNullSafe(F.col("_s")), "left")
    return joined.filter(F.col("_end").isNull() | (F.col("_at") <= F.col("_end"))).drop("_at", "_s", "_end")


def latest(df: DataFrame, group: list[str], order: list[Column], value: Column, name: str) -> DataFrame:
    """The value of each group's last row, by a partial aggregate."""
    return df.groupBy(*group).agg(F.max_by(value, F.struct(*order)).alias(name))
