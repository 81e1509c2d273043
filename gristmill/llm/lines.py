"""Lines that one source repeats across its documents, and texts without them (problem 6).

Each source's documents are one sequence of line identifiers (hashes of normalised lines),
every document ending with a mark that nothing equals. Its suffix array is built by prefix
doubling: a suffix's rank for 2h lines is the pair of ranks for h lines at its start and h
lines on, so that after log rounds any length has been compared. Each round sorts the
suffixes by (source, pair of ranks, url) and reads common prefixes off neighbours: a run of
equal pairs is a block, and its different urls are counted along the run. The sort is
range-partitioned and ends with the url, so that neither a hot source nor a hot line is one
task's work. Only suffixes whose two halves are both repeated enough go into the next round.

When no block of twice the length is left, the same rounds run back with halved steps and
give every position the length of the longest repeated block that starts there, of any
length. The lines of these blocks are the repeated ones; a line alone is a block of one.

Ranks are 64-bit names of their lines and not numbers in alphabetical order: equal prefixes
lie side by side, which is all that common prefixes need, in no order that means anything.

Cases: null or blank texts and rows without a source have no lines; rows without a url keep
their lines but count as no document; lines without letters and digits never count and do not
part a block; ties and repeated rows count by url, not by row; an empty table gives an empty
result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.session import spread, stage

MIN_URLS = 4
MIN_SHARE_PERCENT = 5
_DIGITS = re.compile(r"\d+")
_UNSEEN = dict.fromkeys((0x200B, 0xFEFF))  # zero-width space and no-break space
_STATE = "doc bigint, s bigint, u bigint, ids array<bigint>, reach array<int>"
_SUFFIX = "s bigint, head bigint, tail bigint, u bigint"
_RUN = "s bigint, head bigint, tail bigint, inner_urls bigint, first_u bigint, last_u bigint"


def line_key(line: str) -> str:
    """What equal lines share: no case, no spacing, one digit per number, no outer punctuation; '' if nothing is left."""
    key = "".join(_DIGITS.sub("0", line.lower()).split()).translate(_UNSEEN)
    start, end = 0, len(key)
    while start < end and not key[start].isalnum():
        start += 1
    while end > start and not key[end - 1].isalnum():
        end -= 1
    return key[start:end]


def line_id(line: str) -> int | None:
    """A 64-bit identifier of the line's key, never 0; None for a line without letters and digits."""
    key = line_key(line)
    return (xxhash.xxh64_intdigest(key.encode("utf-8", "surrogatepass")) - (1 << 63)) or 1 if key else None


def _ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        seen: dict[str, int | None] = {}
        out = []
        for text in texts:
            lines = text.split("\n")
            for line in lines:
                if line not in seen:
                    seen[line] = line_id(line)
            out.append([seen[line] for line in lines])
        yield pd.Series(out, dtype=object)


def line_ids(docs: DataFrame, *keep: str) -> DataFrame:
    """docs: row_id, source, url, text. Gives doc (unique), row_id, s, u, kept columns and ``ids``: an identifier or null
    for each line, null for a row without text or source; u is 0 without a url; staged."""
    udf = F.pandas_udf(_ids, "array<bigint>")
    url = F.when(F.col("url").isNull(), F.lit(0)).otherwise(F.xxhash64("url"))  # 0 and not null, so that pandas keeps whole numbers
    usable = F.col("source").isNotNull() & F.col("text").isNotNull()
    ids = F.when(usable, udf(F.coalesce("text", F.lit(""))))
    rows = spread(docs).select(F.monotonically_increasing_id().alias("doc"), "row_id", F.xxhash64("source").alias("s"), url.alias("u"), *keep, ids.alias("ids"))
    return stage(rows, "line-ids")


def mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One 64-bit name of a pair of names."""
    with np.errstate(over="ignore"):
        x = a * np.uint64(0x9E3779B97F4A7C15) + (b ^ (b >> np.uint64(31))) * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(1)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class Sequence:
    """The line identifiers of a batch of documents one after the other, and the ranks of their prefixes."""

    def __init__(self, batch: pd.DataFrame):
        sizes = batch["ids"].map(len).to_numpy(dtype=np.int64)
        self.batch, self.sizes = batch, sizes
        flat = lambda column, kind: np.concatenate([np.asarray(x, dtype=kind) for x in batch[column]]) if sizes.sum() else np.zeros(0, kind)
        self.ids, self.reach = flat("ids", np.int64).view(np.uint64), flat("reach", np.int64)
        self.owner = np.repeat(np.arange(len(sizes)), sizes)
        self.end = np.repeat(np.cumsum(sizes), sizes)
        self.at = np.arange(len(self.ids))
        self._ranks = [self.ids]

    def rank(self, power: int) -> np.ndarray:
        """Names of the blocks of 2**power lines from each position; of no use where the document ends before."""
        while len(self._ranks) <= power:
            last, h = self._ranks[-1], 1 << (len(self._ranks) - 1)
            self._ranks.append(mix(last, np.concatenate((last[h:], np.zeros(min(h, len(last)), np.uint64)))[: len(last)]))
        return self._ranks[power]

    def name(self, at: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Names of the blocks of these lengths from these positions, from their parts of 2**k lines, the largest first."""
        found, place, fresh = np.zeros(len(at), np.uint64), at.copy(), np.ones(len(at), bool)
        for power in range(int(length.max(initial=0)).bit_length() - 1, -1, -1):
            has = (length >> power) & 1 == 1
            part = self.rank(power)[place[has]]
            found[has] = np.where(fresh[has], part, mix(found[has], part))
            fresh[has] = False
            place[has] += 1 << power
        return found

    def tops(self) -> np.ndarray:
        """The largest power of two within each position's reach; 0 for none."""
        top = self.reach.copy()
        for shift in (1, 2, 4, 8, 16):
            top |= top >> shift
        return top - (top >> 1)

    def probe(self, step: int, forward: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(positions, head, tail): blocks that may be repeated and are ``step`` lines longer than known ones, as pairs of ranks.

        Both halves of a repeated block are repeated, and so is what lies between its head and its end.
        """
        if not step:
            return self.at, self.ids, np.zeros(len(self.ids), np.uint64)
        tops = self.tops()
        live = (self.reach == step) if forward else (tops > step)
        beyond = self.at + self.reach
        live &= beyond < self.end
        live[live] = tops[beyond[live]] >= step
        found = np.flatnonzero(live)
        return found, self.name(found, self.reach[found]), self.rank(step.bit_length() - 1)[beyond[found]]


def _signed(names: np.ndarray) -> np.ndarray:
    return names.view(np.int64)


def suffixes(state: DataFrame, step: int, forward: bool) -> DataFrame:
    """(s, head, tail, u): the suffixes that take part in a round, by the two ranks of their beginning.

    On the way back, a block that may grow is also the beginning of longer ones that are known: for each length at
    which some block may grow (``open_at``, at most the longest block's number of lines), those count with it.
    """
    open_at = []
    if not forward:
        lengths = state.select(F.explode(F.array_distinct("reach")).alias("n")).filter(F.col("n") > step).distinct()
        open_at = sorted(int(r.n) for r in lengths.collect())

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seq = Sequence(batch)
            at, head, tail = seq.probe(step, forward)
            parts = [(at, head, tail)]
            for n in open_at:
                at = np.flatnonzero(seq.reach >= n + step)
                parts.append((at, seq.name(at, np.full(len(at), n)), seq.rank(step.bit_length() - 1)[at + n]))
            at, head, tail = map(np.concatenate, zip(*parts, strict=True))
            rows = seq.owner[at]
            yield pd.DataFrame({"s": batch["s"].to_numpy()[rows], "head": _signed(head), "tail": _signed(tail), "u": batch["u"].to_numpy()[rows]})

    return state.filter("u <> 0").mapInPandas(cut, _SUFFIX)


def _runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Runs of sorted suffixes with a common prefix. A run's first and last url are kept, as it may go on in the next batch."""
    for batch in batches:
        if not len(batch):
            continue
        rows = batch[["s", "head", "tail", "u"]].to_numpy(dtype=np.int64)
        differs = np.concatenate(([True], (rows[1:, :3] != rows[:-1, :3]).any(axis=1)))
        new_url = differs | np.concatenate(([True], rows[1:, 3] != rows[:-1, 3]))
        starts = np.flatnonzero(differs)
        ends = np.append(starts[1:], len(rows)) - 1
        urls = np.add.reduceat(new_url.astype(np.int64), starts)
        keep = urls >= MIN_URLS
        keep[0] = keep[-1] = True
        first, last = rows[starts, 3], rows[ends, 3]
        inner = urls - np.where(first == last, 1, 2)
        out = pd.DataFrame(rows[starts, :3], columns=["s", "head", "tail"]).assign(inner_urls=inner, first_u=first, last_u=last)
        yield out[keep]


def repeated(suffix_rows: DataFrame, totals: DataFrame) -> DataFrame:
    """(s, head, tail, n_urls) of the blocks in enough of their source's urls, from a sorted round's common prefixes."""
    order = ["s", "head", "tail", "u"]
    runs = suffix_rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInPandas(_runs, _RUN)
    # within a run urls ascend, so a url that is neither first nor last in its part of the run is in no other part
    edges = F.size(F.array_distinct(F.flatten(F.collect_list(F.array("first_u", "last_u")))))
    counted = runs.groupBy("s", "head", "tail").agg((F.sum("inner_urls") + edges).alias("n_urls"))
    enough = (F.col("n_urls") >= MIN_URLS) & (F.col("n_urls") * 100 >= F.col("total") * MIN_SHARE_PERCENT)
    return counted.join(totals, "s").filter(enough).drop("total")


def extended(state: DataFrame, found: DataFrame, step: int, forward: bool) -> DataFrame:
    """The state with the reach of positions whose block is in ``found``; documents without any repeated line are left out.

    A line in 5 % of a source's urls leaves room for at most 20 times the lines of an average document, so a
    source's blocks of one round are few however many documents it has.
    """
    blocks = found.groupBy("s").agg(F.collect_list("head").alias("heads"), F.collect_list("tail").alias("tails"))

    def grow(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seq = Sequence(batch)
            at, head, tail = seq.probe(step, forward)
            pairs, source = mix(head, tail), batch["s"].to_numpy()[seq.owner[at]]
            reach = seq.reach
            for s, rows in batch.groupby("s").indices.items():
                known = batch.iloc[rows[0]]
                wanted = mix(np.asarray(known["heads"], dtype=np.int64).view(np.uint64), np.asarray(known["tails"], dtype=np.int64).view(np.uint64))
                mine = np.flatnonzero(source == s)
                reach[at[mine[np.isin(pairs[mine], wanted)]]] += max(step, 1)
            out = batch[["doc", "s", "u", "ids"]].assign(reach=np.split(reach.astype(np.int32), np.cumsum(seq.sizes)[:-1]))
            yield out[[bool(r.any()) for r in out["reach"]]]

    return state.join(blocks, "s", "inner" if not step else "left").transform(_no_blocks).mapInPandas(grow, _STATE)


def _no_blocks(joined: DataFrame) -> DataFrame:
    none = F.array().cast("array<bigint>")
    return joined.withColumns({"heads": F.coalesce("heads", none), "tails": F.coalesce("tails", none)})


def reaches(ids: DataFrame, docs: DataFrame) -> DataFrame:
    """(doc, s, u, ids, reach): for each content line the length of the longest repeated block that starts there.

    Only documents with repeated lines; ids without the lines that have no letters or digits.
    """
    totals = stage(docs.filter("source is not null").groupBy(F.xxhash64("source").alias("s")).agg(F.countDistinct("url").alias("total")), "source-urls")
    content = F.array_compact("ids")
    state = ids.filter("ids is not null").select("doc", "s", "u", content.alias("ids"), F.transform(content, lambda _: F.lit(0)).alias("reach"))
    state = state.filter("size(ids) > 0")

    def round_of(state: DataFrame, step: int, forward: bool) -> tuple[DataFrame, bool]:
        found = stage(repeated(suffixes(state, step, forward), totals), "line-blocks")
        if found.isEmpty():
            return state if step else state.limit(0), False
        return stage(extended(state, found, step, forward), "line-reach"), True

    state, more = round_of(state, 0, True)
    step = 0
    while more:
        step = max(1, 2 * step)
        state, more = round_of(state, step, True)
    while step := step // 2:  # no block is twice as long as the last step: back with halved ones
        state, _ = round_of(state, step, False)
    return state


def _covered(reach: np.ndarray) -> np.ndarray:
    """Whether each position lies in a block that starts there or before."""
    return np.maximum.accumulate(np.arange(len(reach)) + reach) > np.arange(len(reach))


def marked_lines(ids: DataFrame, docs: DataFrame) -> DataFrame:
    """(doc, gone): for each line of a document with repeated blocks whether it lies in one."""
    content = reaches(ids, docs).select("doc", "reach").join(ids.select("doc", "ids"), "doc")

    def mark(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for reach, all_ids in zip(batch["reach"], batch["ids"], strict=True):
                gone = np.zeros(len(all_ids), bool)
                gone[[x is not None and x == x for x in all_ids]] = _covered(np.asarray(reach, dtype=np.int64))
                out.append(gone)
            yield pd.DataFrame({"doc": batch["doc"], "gone": out})

    return content.mapInPandas(mark, "doc bigint, gone array<boolean>")


def repeated_lines(docs: DataFrame) -> DataFrame:
    """(row_id, line_no) of each line in a block that its source repeats. docs: row_id, source, url, text."""
    ids = line_ids(docs)
    each = ids.select("doc", "row_id").join(marked_lines(ids, docs), "doc").select("row_id", F.posexplode("gone").alias("line_no", "g"))
    return each.filter("g").select("row_id", "line_no")


def without_repeated_lines(docs: DataFrame) -> DataFrame:
    """(row_id, text, n_removed): every text without its source's repeated blocks; a null text stays null."""
    ids = line_ids(docs, "text")
    rows = ids.join(marked_lines(ids, docs), "doc", "left").select("row_id", "text", "gone", F.split("text", "\n").alias("lines"))
    kept = F.expr("transform(filter(arrays_zip(lines, gone), x -> not x.gone), x -> x.lines)")
    return rows.select(
        "row_id",
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text"),
        F.when(F.col("text").isNotNull(), F.coalesce(F.expr("size(filter(gone, x -> x))"), F.lit(0))).alias("n_removed"),
    )


def block_report(docs: DataFrame) -> DataFrame:
    """(source, len, n_blocks, max_urls): how many repeated blocks of each length a source has, parts of longer ones included."""

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seq = Sequence(batch)
            for length in range(1, int(seq.reach.max(initial=0)) + 1):
                at = np.flatnonzero(seq.reach >= length)
                rows = seq.owner[at]
                name = _signed(seq.name(at, np.full(len(at), length)))
                yield pd.DataFrame({"s": batch["s"].to_numpy()[rows], "len": length, "block": name, "u": batch["u"].to_numpy()[rows]}).drop_duplicates()

    found = reaches(line_ids(docs), docs).filter("u <> 0").mapInPandas(blocks, "s bigint, len int, block bigint, u bigint")
    counted = found.distinct().groupBy("s", "len", "block").agg(F.count("*").alias("n_urls"))
    names = docs.select("source", F.xxhash64("source").alias("s")).distinct()
    return counted.join(names, "s").groupBy("source", "len").agg(F.count("*").alias("n_blocks"), F.max("n_urls").alias("max_urls"))


def news_docs(news: DataFrame) -> DataFrame:
    return news.select(F.col("id").alias("row_id"), F.col("source_name").alias("source"), "url", F.col("full_text_location").alias("text"))
