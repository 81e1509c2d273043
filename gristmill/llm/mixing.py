"""Documents of several sources mixed to target shares by Pfair scheduling (problem 8).

A mix is cut into blocks of ``BLOCK`` tokens, one per slot of time. A source with target
weight w may start its j-th block at slot floor(j / w) and must have it by ceil((j + 1) / w);
among started blocks the earliest deadline goes first, so that at any slot no source is a
whole block away from its share. After as many slots as the weights' common denominator has,
every source is exactly on its share and the schedule repeats: one such frame is scheduled on
the driver, and each block finds its slot by its number alone, however long the mix is. Weights
without a common denominator of at most ``FRAME`` are rounded to that many slots, at least one each.

A mix has a size in tokens: what all of its sources hold, if none is given. A source's
documents follow each other in hash order, again and again up to max_repeats, until it has its
share of the size; a document belongs to the block in which it begins. A source that runs out
before leaves its later slots empty and is reported as capped; the others go on to their own
shares of the size. The report gives the tokens wanted and drawn, and the actual shares.

Cases: null and empty texts have no tokens and are never drawn; shares or repeats that are
null or not positive ask for nothing; repeated targets of one source count once, by the
largest share; of a source with documents at least one is drawn; a mix without usable sources
is empty; ties in deadlines go to the smaller source name; running sums are taken over hash
ranges, so one large source is many tasks.
"""

from __future__ import annotations

import heapq
import math
from fractions import Fraction

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gristmill.llm.tokens import VOCABULARY, token_count
from gristmill.session import stage

#: Tokens of a block, slots of a frame at most, documents of a hash range.
BLOCK, FRAME, RANGE_DOCS = 1024, 100_000, 50_000


def weights_of(shares: dict[str, float]) -> dict[str, Fraction]:
    """Shares as exact parts of their sum; a share is read as the decimal number that it is written as."""
    exact = {name: Fraction(repr(float(s))) for name, s in shares.items()}
    total = sum(exact.values())
    return {name: x / total for name, x in exact.items()}


def frame_slots(shares: dict[str, float], most: int = FRAME) -> int:
    """Slots after which every source is exactly on its share: the weights' common denominator, or ``most`` if that is larger."""
    return min(most, math.lcm(*(w.denominator for w in weights_of(shares).values()))) if shares else 0


def frame_blocks(shares: dict[str, float], frame: int = FRAME) -> dict[str, int]:
    """Blocks of each source in a frame: its part of the slots, if need be rounded so that they add up (largest remainders,
    at least one block each)."""
    exact = {name: w * frame for name, w in weights_of(shares).items()}
    blocks = {name: max(1, int(x)) for name, x in exact.items()}
    order = sorted(exact, key=lambda n: (blocks[n] - exact[n], n))
    left = frame - sum(blocks.values())
    for i in range(left):
        blocks[order[i % len(order)]] += 1
    if left < 0:  # what sources of less than a slot took comes from the largest
        blocks[max(exact, key=lambda n: (exact[n], n))] += left
    return blocks


def pfair_frame(blocks: dict[str, int]) -> list[tuple[str, int]]:
    """(source, block number) for each slot of one frame, by earliest deadline among started blocks."""
    frame = sum(blocks.values())
    starts: list[list[tuple[int, str, int]]] = [[] for _ in range(frame + 1)]
    for name, n in blocks.items():
        for j in range(n):
            starts[j * frame // n].append((-(-(j + 1) * frame // n), name, j))
    ready: list[tuple[int, str, int]] = []
    slots = []
    for slot in range(frame):
        for block in starts[slot]:
            heapq.heappush(ready, block)
        _, name, j = heapq.heappop(ready)
        slots.append((name, j))
    return slots


def offsets(sized: DataFrame) -> DataFrame:
    """sized: source, doc_id, n. Adds before: tokens of the source's earlier documents in hash order.

    Sums are taken within hash ranges of a source and then over the ranges: no window holds a whole source.
    """
    counts = sized.groupBy("source").agg(F.count("*").alias("docs"))
    ranges = F.greatest(F.lit(1), F.ceil(F.col("docs") / RANGE_DOCS))
    width = F.floor(F.lit(2**32) / ranges)
    order = F.shiftrightunsigned(F.xxhash64("doc_id"), 32)
    rows = sized.join(counts, "source").withColumn("h", order).withColumn("part", F.least(F.floor(F.col("h") / width), ranges - 1)).drop("docs")
    sums = rows.groupBy("source", "part").agg(F.sum("n").alias("part_tokens"))
    earlier = F.sum("part_tokens").over(Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sums.withColumn("start", F.coalesce(earlier, F.lit(0))).drop("part_tokens")  # one row per 50,000 documents
    inside = F.sum("n").over(Window.partitionBy("source", "part").orderBy("h", "doc_id", "row").rowsBetween(Window.unboundedPreceding, -1))
    return rows.withColumn("inside", F.coalesce(inside, F.lit(0))).join(starts, ["source", "part"]).select("source", "doc_id", "n", (F.col("start") + F.col("inside")).alias("before"))


def mix(docs: DataFrame, targets: DataFrame, vocabulary: str = VOCABULARY, block: int = BLOCK, frame: int = FRAME, size: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(drawn, report). drawn: mix_id, slot, source, doc_id, use_no, tokens, in the order of slot and use;
    report: mix_id, source, target_share, actual_share, wanted_tokens, tokens, n_draws, n_docs, max_uses, capped, met.

    size: tokens of every mix. capped: the source has no more documents to draw; met: within 1 % of the size of what is wanted.
    """
    spark = docs.sparkSession
    wanted = targets.filter("source is not null and target_share > 0 and max_repeats > 0").groupBy("mix_id", "source")
    wanted = wanted.agg(F.max("target_share").cast("double").alias("share"), F.max("max_repeats").alias("repeats"))
    used = wanted.select("source").distinct()
    sized = docs.filter("text is not null and text <> ''").join(F.broadcast(used), "source", "left_semi")
    sized = sized.select("source", "doc_id", token_count(F.col("text"), vocabulary).cast("bigint").alias("n"), F.xxhash64("text").alias("row"))
    sized = stage(sized.filter("n > 0"), "mix-sizes")
    have = {r.source: int(r.total) for r in sized.groupBy("source").agg(F.sum("n").alias("total")).collect()}  # a row for each source of a target
    plan = wanted.collect()  # targets are a small, fixed table
    slots, quotas = [], []
    for mix_id in sorted({r.mix_id for r in plan}):
        rows = {r.source: r for r in plan if r.mix_id == mix_id}
        weights = weights_of({name: r.share for name, r in rows.items()})
        tokens = sum(have.get(name, 0) for name in rows) if size is None else size
        there = {name: r for name, r in rows.items() if name in have}
        shares = {name: r.share for name, r in there.items()}
        blocks = frame_blocks(shares, frame_slots(shares, frame))
        for slot, (name, j) in enumerate(pfair_frame(blocks)):
            slots.append((mix_id, name, j, slot))
        slots_in_frame = sum(blocks.values())
        for name, r in rows.items():
            quotas.append((mix_id, name, blocks.get(name, 0), slots_in_frame, int(tokens * weights[name]), int(r.repeats), have.get(name, 0)))
    schedule = spark.createDataFrame(pd.DataFrame(slots, columns=["mix_id", "source", "block_no", "slot_in_frame"]), "mix_id int, source string, block_no int, slot_in_frame int")
    quota = spark.createDataFrame(quotas, "mix_id int, source string, per_frame int, slots int, quota bigint, repeats int, total bigint")
    placed = offsets(sized).join(F.broadcast(quota.filter("total > 0")), "source")
    uses = F.greatest(F.lit(1), F.least(F.col("repeats"), F.ceil(F.col("quota") / F.col("total")))).cast("int")
    each = placed.withColumn("use_no", F.explode(F.sequence(F.lit(1), uses)))
    each = each.withColumn("at", F.col("before") + (F.col("use_no") - 1) * F.col("total"))
    # a document is drawn if more of it lies within the quota than beyond it, and the first one always
    drawn = each.filter((F.col("at") == 0) | (F.col("at") + F.col("n") / 2 <= F.col("quota"))).withColumn("nth", F.floor(F.col("at") / block))
    drawn = drawn.withColumn("block_no", F.pmod(F.col("nth"), F.col("per_frame")).cast("int"))
    drawn = drawn.join(F.broadcast(schedule), ["mix_id", "source", "block_no"])  # FRAME rows per mix
    slot = F.floor(F.col("nth") / F.col("per_frame")) * F.col("slots") + F.col("slot_in_frame")
    drawn = stage(drawn.select("mix_id", slot.alias("slot"), "source", "doc_id", "use_no", F.col("n").alias("tokens")), "mix-drawn")
    per_doc = drawn.groupBy("mix_id", "source", "doc_id").agg(F.max("use_no").alias("uses"), F.count("*").alias("draws"), F.sum("tokens").alias("tokens"))
    got = per_doc.groupBy("mix_id", "source").agg(F.sum("tokens").alias("tokens"), F.sum("draws").alias("n_draws"), F.count("*").alias("n_docs"), F.max("uses").alias("max_uses"))
    wholes = got.groupBy("mix_id").agg(F.sum("tokens").alias("mix_tokens"))
    listed = targets.groupBy("mix_id", "source").agg(F.max("target_share").cast("double").alias("target_share"))
    sizes = quota.groupBy("mix_id").agg(F.sum("quota").alias("mix_wanted"))
    report = listed.join(got, ["mix_id", "source"], "left").join(wholes, "mix_id", "left").fillna(0, ["tokens", "n_draws", "n_docs", "max_uses"])
    report = report.join(F.broadcast(quota), ["mix_id", "source"], "left").join(F.broadcast(sizes), "mix_id", "left").fillna(0, ["quota", "mix_wanted"])
    actual = F.when(F.col("mix_tokens") > 0, F.round(F.col("tokens") / F.col("mix_tokens"), 6)).otherwise(F.lit(0.0))
    report = report.withColumns({
        "actual_share": actual,
        "wanted_tokens": F.col("quota"),
        "capped": F.coalesce(F.col("quota") > F.col("total") * F.col("repeats"), F.lit(False)),
        "met": (F.col("quota") > 0) & (F.abs(F.col("tokens") - F.col("quota")) <= 0.01 * F.col("mix_wanted")),
    })
    return drawn, report.select("mix_id", "source", "target_share", "actual_share", "wanted_tokens", "tokens", "n_draws", "n_docs", "max_uses", "capped", "met")
