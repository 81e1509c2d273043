"""Documents into containers of fixed capacity by a grouping genetic algorithm (problem 7).

A text larger than the capacity fills containers of its own and leaves its rest; rests and
smaller texts are items. Items are dealt by hash to demes of about ``DEME`` items, so that a
deme is bounded however many documents there are. Several islands evolve each deme's packing
side by side: crossover injects whole well-filled bins of one parent into the other, removes
the bins that hold the same documents, and best-fits the displaced ones. Between epochs each
island's elite migrates to the next. An island stops at the lower bound of bins, which knows
that items of more than half a bin never share one. The first packings are best fits in
slightly different orders, and one whose bins are filled up by the items that fit exactly. What
the demes leave in badly filled bins is dealt again to fewer demes and packed once more.

Cases: null and empty texts have no tokens and share a container with others; a text of
exactly the capacity has its own; repeated rows are items each; equal fitness goes to the
earlier island; the same rows give the same containers however they are partitioned; an empty
table or no capacities give an empty result.
"""

from __future__ import annotations

import bisect
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.llm.tokens import VOCABULARY, token_count
from gristmill.session import spread, stage

#: Items of a deme, islands per deme, epochs, packings per island, children per epoch.
DEME, ISLANDS, EPOCHS, POPULATION, CHILDREN = 2000, 2, 3, 6, 30
#: Bins filled below this share are packed again.
WELL_FILLED = 0.97


def best_fit(items: list[int], sizes: list[int], capacity: int, bins: list[list[int]], fills: list[int]) -> None:
    """Puts items, in their order, each into the fullest bin that has room, or a new one."""
    room = sorted((capacity - f, b) for b, f in enumerate(fills))
    for item in items:
        size = sizes[item]
        at = bisect.bisect_left(room, (size, -1))
        if at < len(room):
            left, b = room.pop(at)
            bins[b].append(item)
            fills[b] += size
        else:
            left, b = capacity, len(bins)
            bins.append([item])
            fills.append(size)
        if left > size:
            bisect.insort(room, (left - size, b))


def exact_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Bins that begin with the largest item left and are filled up by the largest one, two or three that fit exactly, else by the largest that fits."""
    waiting: dict[int, list[int]] = defaultdict(list)
    for item in range(len(sizes) - 1, -1, -1):
        waiting[sizes[item]].append(item)
    nothing = waiting.pop(0, [])
    left = np.zeros(capacity + 1, dtype=np.int64)
    for size, items in waiting.items():
        left[size] = len(items)

    def pair(room: int, largest: int) -> tuple[int, int] | None:
        """The most unlike two sizes that fill the room together."""
        top = min(room - 1, largest)
        first = left[top : room // 2 : -1]  # sizes above half the room, falling; what they leave rises
        ok = (first > 0) & (left[room - top : room - top + len(first)] > 0)
        if len(ok) and ok[at := int(ok.argmax())]:
            return top - at, room - top + at
        return (room // 2, room // 2) if room % 2 == 0 and left[room // 2] > 1 else None

    def fitting(room: int, largest: int) -> tuple[int, ...]:
        """The sizes that come next into a bin with this room."""
        if room <= largest and left[room]:
            return (room,)
        there = np.flatnonzero(left[1 : min(room, largest) + 1]) + 1
        if not len(there):
            return ()
        largest = int(there[-1])
        if room <= 2 * largest and (found := pair(room, largest)):
            return found
        for a in there[-1:-9:-1].tolist() if room <= 3 * largest else ():
            left[a] -= 1
            rest = pair(room - a, largest) if 1 < room - a <= 2 * largest else None
            left[a] += 1
            if rest:
                return (a, *rest)
        return (largest,)

    bins: list[list[int]] = []
    for size in sorted(waiting, reverse=True):
        while left[size]:
            took, room, fits = [], capacity, (size,)
            while fits:
                for a in fits:
                    left[a] -= 1
                    room -= a
                took += fits
                fits = fitting(room, size) if room else ()
            bins.append([waiting[s].pop() for s in took])
    if nothing:
        bins = bins or [[]]
        bins[0] += nothing
    return bins


def least_bins(sizes: list[int], capacity: int) -> int:
    """A lower bound of the bins: for every k, items above capacity - k are alone, those above half a bin apart, and what of
    the items from k on does not fit beside them needs bins of its own."""
    ordered = np.sort(np.asarray(sizes, dtype=np.int64))[::-1]
    ordered = ordered[ordered > 0]
    if not len(ordered):
        return 1
    sums = np.concatenate(([0], np.cumsum(ordered)))
    above = lambda limit: np.searchsorted(-ordered, -limit, side="left")  # noqa: E731 - how many items are larger
    k = np.unique(np.concatenate(([0], ordered[2 * ordered <= capacity])))
    alone, halves, counted = above(capacity - k), above(capacity // 2), above(np.maximum(k - 1, 0))
    beside = (halves - alone) * capacity - (sums[halves] - sums[alone])
    rest = np.maximum(0, -(-(sums[counted] - sums[halves] - beside) // capacity))
    return int((halves + rest).max())


def fitness(fills: list[int], capacity: int) -> float:
    """Mean square of the bins' shares of fill: few and full bins win."""
    return float(np.mean((np.array(fills) / capacity) ** 2)) if fills else 1.0


class Packing:
    def __init__(self, bins: list[list[int]], fills: list[int], capacity: int):
        self.bins, self.fills = bins, fills
        self.score = fitness(fills, capacity)

    def assignment(self, n: int) -> list[int]:
        out = np.zeros(n, dtype=np.int32)
        for b, items in enumerate(self.bins):
            out[items] = b
        return out.tolist()


def from_assignment(assignment: list[int], sizes: list[int], capacity: int) -> Packing:
    bins: list[list[int]] = [[] for _ in range(max(assignment, default=-1) + 1)]
    fills = [0] * len(bins)
    for item, b in enumerate(assignment):
        bins[b].append(item)
        fills[b] += sizes[item]
    return Packing(bins, fills, capacity)


def crossover(into: Packing, donor: Packing, sizes: list[int], capacity: int, rng: np.random.Generator) -> Packing:
    """``into`` with a share of ``donor``'s best-filled bins; what they displace is placed by best fit."""
    ranked = np.argsort(-np.array(donor.fills) + rng.random(len(donor.fills)) * 0.02 * capacity)
    chosen = [donor.bins[i] for i in ranked[: max(1, int(len(ranked) * rng.uniform(0.2, 0.6)))]]
    taken = {item for b in chosen for item in b}
    bins, fills, free = [list(b) for b in chosen], [sum(sizes[i] for i in b) for b in chosen], []
    worst = np.quantile(into.fills, 0.05)
    for items, fill in zip(into.bins, into.fills, strict=True):
        if fill > worst and taken.isdisjoint(items):
            bins.append(list(items))
            fills.append(fill)
        else:
            free += [i for i in items if i not in taken]
    free.sort(key=lambda i: -sizes[i])
    best_fit(free, sizes, capacity, bins, fills)
    return Packing(bins, fills, capacity)


def evolve(sizes: list[int], capacity: int, seeds: list[list[int]], seed: int) -> Packing:
    """One epoch of one island, from earlier elites or from scratch."""
    rng = np.random.default_rng(seed)
    least = least_bins(sizes, capacity)
    people = [from_assignment(s, sizes, capacity) for s in seeds]
    if not people:
        bins = exact_fit(sizes, capacity)
        people.append(Packing(bins, [sum(sizes[i] for i in b) for b in bins], capacity))
    order = np.array(sizes, dtype=float)
    while len(people) < POPULATION:
        if people and min(len(p.bins) for p in people) <= least:
            break
        noise = 0.0 if len(people) == 1 else 0.02 * (len(people) - 1)
        items = np.argsort(-order * (1 + noise * rng.standard_normal(len(sizes))), kind="stable").tolist()
        bins: list[list[int]] = []
        fills: list[int] = []
        best_fit(items, sizes, capacity, bins, fills)
        people.append(Packing(bins, fills, capacity))
    for _ in range(CHILDREN):
        people.sort(key=lambda p: (len(p.bins), -p.score))
        if len(people[0].bins) <= least or len(people) < 2:
            break
        a, b = rng.choice(len(people), size=2, replace=False)
        child = crossover(people[max(a, b)], people[min(a, b)], sizes, capacity, rng)
        if (len(child.bins), -child.score) < (len(people[-1].bins), -people[-1].score):
            people[-1] = child
    return min(people, key=lambda p: (len(p.bins), -p.score))


def _epoch_batches(epoch: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                sizes = [int(s) for s in row.sizes]
                seed = zlib.crc32(f"{row.capacity_id}/{row.deme}/{row.island}/{epoch}".encode())
                found = evolve(sizes, int(row.capacity_tokens), [list(s) for s in row.seeds], seed)
                least = least_bins(sizes, int(row.capacity_tokens))
                out.append((row.capacity_id, row.capacity_tokens, row.deme, row.island, len(found.bins), least, found.score, found.assignment(len(sizes))))
            yield pd.DataFrame(out, columns=["capacity_id", "capacity_tokens", "deme", "island", "n_bins", "least", "score", "bins"])

    return run


def _pack_demes(demes: DataFrame) -> DataFrame:
    """demes: capacity_id, capacity_tokens, deme, ids, sizes. Adds bins: each item's bin, by the best island."""
    keys = ["capacity_id", "capacity_tokens", "deme"]
    spark = demes.sparkSession  # few rows that take long: the optimizer would leave them to few tasks
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    none = F.lit(None).cast("array<array<int>>")
    islands = demes.withColumn("island", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1)))).withColumn("seeds", F.coalesce(none, F.array()))
    schema = "capacity_id int, capacity_tokens int, deme bigint, island int, n_bins int, least int, score double, bins array<int>"
    for epoch in range(EPOCHS):
        ran = stage(islands.select(*keys, "island", "sizes", "seeds").repartition(tasks, "deme", "island", "capacity_id").mapInPandas(_epoch_batches(epoch), schema), "pack-epoch")
        # rings: an island's own elite, and the elite of the one before it
        elites = ran.select(*keys, "island", "bins").unionByName(ran.select(*keys, F.pmod(F.col("island") + 1, F.lit(ISLANDS)).alias("island"), "bins"))
        seeds = elites.groupBy(*keys, "island").agg(F.collect_list("bins").alias("seeds"))
        best = ran.groupBy(*keys).agg(F.min("n_bins").alias("n_bins"), F.min("least").alias("least"))
        still = demes.join(best, keys).filter("n_bins > least").drop("n_bins", "least")  # the others are as good as can be
        islands = still.join(seeds, keys)
        done = ran if epoch == 0 else done.unionByName(ran)
    winner = done.groupBy(*keys).agg(F.min_by("bins", F.struct("n_bins", (-F.col("score")).alias("s"), "island")).alias("bins"))
    return demes.join(winner, keys)


def _deal(items: DataFrame, n_demes: DataFrame) -> DataFrame:
    """items: capacity_id, capacity_tokens, doc_id, part, copy, size; dealt to n_demes demes of each capacity."""
    dealt = items.join(F.broadcast(n_demes), "capacity_id").withColumn("deme", F.pmod(F.xxhash64("doc_id", "part", "copy"), F.col("demes")))
    packed = F.collect_list(F.struct("size", "doc_id", "part"))
    groups = dealt.groupBy("capacity_id", "capacity_tokens", "deme").agg(F.sort_array(packed, asc=False).alias("items"))
    return groups.select("capacity_id", "capacity_tokens", "deme", "items", F.col("items.size").alias("sizes"))


def _demes_for(items: DataFrame) -> DataFrame:
    return items.groupBy("capacity_id").agg(F.greatest(F.lit(1), F.ceil(F.count("*") / DEME)).cast("bigint").alias("demes"))


def pack(docs: DataFrame, capacities: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(capacity_id, doc_id, part, container_id, tokens): each document, or each part of one larger than the capacity."""
    wanted = capacities.select("capacity_id", "capacity_tokens").filter("capacity_tokens > 0").distinct().collect()  # a small, fixed table
    each_capacity = [F.struct(F.lit(c.capacity_id).alias("capacity_id"), F.lit(c.capacity_tokens).alias("capacity_tokens")) for c in wanted]
    none = F.lit(None).cast("array<struct<capacity_id:int,capacity_tokens:int>>")
    sized = stage(spread(docs.select("doc_id", "text")).select("doc_id", token_count(F.col("text"), vocabulary).alias("n")), "sizes")
    # rows of one id and size are told apart by their number, whichever partition each comes from
    copies = sized.groupBy("doc_id", "n").agg(F.count("*").cast("int").alias("copies"))
    numbered = copies.select("doc_id", "n", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    each = numbered.select("*", F.inline(F.array(*each_capacity) if each_capacity else none))
    full = F.floor(F.col("n") / F.col("capacity_tokens")).cast("int")
    rest = F.col("n") - full * F.col("capacity_tokens")
    whole = each.filter(full > 0).withColumn("part", F.explode(F.sequence(F.lit(0), full - 1)))
    whole = whole.select(
        "capacity_id", "doc_id", "part", F.concat_ws("-", "capacity_id", F.lit("full"), "doc_id", "n", "copy", "part").alias("container_id"), F.col("capacity_tokens").alias("tokens")
    )
    items = each.filter((rest > 0) | (F.col("n") == 0)).select("capacity_id", "capacity_tokens", "doc_id", full.alias("part"), "copy", rest.cast("int").alias("size"))
    first = stage(_pack_demes(stage(_deal(items, _demes_for(items)), "demes")), "packed")
    placed = _placed(first)
    poor = F.col("fill") < WELL_FILLED * F.col("capacity_tokens")
    again = placed.filter(poor).withColumn("copy", F.lit(1))
    again = stage(again.select("capacity_id", "capacity_tokens", "doc_id", "part", "copy", "size"), "left-over")
    second = _placed(_pack_demes(stage(_deal(again, _demes_for(again)), "demes")))
    name = lambda df, tag: df.select("capacity_id", "doc_id", "part", F.concat_ws("-", "capacity_id", F.lit(tag), "deme", "bin").alias("container_id"), F.col("size").alias("tokens"))
    return whole.unionByName(name(placed.filter(~poor), "a")).unionByName(name(second, "b"))


def _placed(packed: DataFrame) -> DataFrame:
    """One row per item with its bin and the bin's fill."""
    each = packed.select("capacity_id", "capacity_tokens", "deme", F.explode(F.arrays_zip("items", "bins")).alias("x"))
    each = each.select("capacity_id", "capacity_tokens", "deme", "x.items.doc_id", "x.items.part", "x.items.size", F.col("x.bins").alias("bin"))
    totals = each.groupBy("capacity_id", "deme", "bin").agg(F.sum("size").alias("fill"))
    return each.join(totals, ["capacity_id", "deme", "bin"])


def _best_fit_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        counts = []
        for capacity, sizes in zip(batch["capacity_tokens"], batch["sizes"], strict=True):
            bins: list[list[int]] = []
            best_fit(list(range(len(sizes))), [int(s) for s in sizes], int(capacity), bins, [])
            counts.append(len(bins))
        yield pd.DataFrame({"capacity_id": batch["capacity_id"], "n_bins": counts})


def packing_report(packed: DataFrame, capacities: DataFrame) -> DataFrame:
    """(capacity_id, n_parts, n_tokens, n_containers, n_best_fit, least, fill): containers used, those of best fit by falling
    size in as large demes, the lower bound by the sum of sizes, and the mean fill."""
    packed = stage(packed.join(F.broadcast(capacities.select("capacity_id", "capacity_tokens").distinct()), "capacity_id"), "packed-parts")
    used = packed.groupBy("capacity_id", "capacity_tokens").agg(
        F.count("*").alias("n_parts"), F.sum("tokens").cast("bigint").alias("n_tokens"), F.countDistinct("container_id").alias("n_containers"), F.count_if(F.col("tokens") == F.col("capacity_tokens")).alias("n_full")
    )
    items = packed.filter("tokens < capacity_tokens").select("capacity_id", "capacity_tokens", "doc_id", "part", F.xxhash64("container_id").alias("copy"), F.col("tokens").alias("size"))
    plain = _deal(items, _demes_for(items)).mapInPandas(_best_fit_batches, "capacity_id int, n_bins bigint").groupBy("capacity_id").agg(F.sum("n_bins").alias("n_bins"))
    return used.join(plain, "capacity_id", "left").select(
        "capacity_id",
        "n_parts",
        "n_tokens",
        "n_containers",
        (F.col("n_full") + F.coalesce("n_bins", F.lit(0))).alias("n_best_fit"),
        F.ceil(F.col("n_tokens") / F.col("capacity_tokens")).alias("least"),
        F.round(F.col("n_tokens") / (F.col("n_containers") * F.col("capacity_tokens")), 6).alias("fill"),
    )
