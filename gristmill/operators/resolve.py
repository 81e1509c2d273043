"""Entity resolution: exact key, alias, similar key, or a new entity, with a log row per occurrence.

A name's candidates are the index and all usable keys that came earlier, whatever was decided
about them; so each distinct key finds its best earlier key on its own, and entities are the
roots of these links. Similar keys are found by an exact filter: of the few letters in which
keys differ whose longest common subsequence ratio reaches the floor, at most half lie in their
first halves or at most half in their last ones; without these letters the halves are equal.
What meets so is thinned out by length and edit distance in the JVM before it is scored.

Cases: null, blank and one-letter keys are unresolved with confidence 0; equal scores go to
the earlier key; repeated names log each; an empty index and an empty input are fine.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.functions.text import deterministic_id, normalize_entity_name, usable_name
from gristmill.session import stage

LINK, REVIEW, ALIAS_CONFIDENCE = 92.0, 85.0, 0.99


def common_subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence; a row of its table is one integer (bit-parallel, Hyyrö)."""
    at: dict[str, int] = {}
    for i, x in enumerate(a):
        at[x] = at.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for y in b:
        met = row & at.get(y, 0)
        row = (row + met | row - met) & full
    return len(a) - row.bit_count()


def token_sort_ratio(a: str, b: str) -> float:
    """100 * 2 * LCS / (len a + len b) of the keys with their tokens sorted."""
    a, b = " ".join(sorted(a.split())), " ".join(sorted(b.split()))
    return 100.0 * 2 * common_subsequence(a, b) / (len(a) + len(b)) if a or b else 100.0


#: Letters at either end of a key that are compared, at most.
END = 10


def longest_partner(length: int, floor: float) -> int:
    """Letters of the longest key whose ratio with a key of this length can reach the floor."""
    return math.floor(length * (2 - floor) / floor + 1e-9)


def ends_of(text: str, floor: float) -> dict[str, int]:
    """The ends of a text by which others with this ratio may know it, and how many letters each may lose.

    Let the shorter of two have n letters. Both lose e letters at most in all, so at most e // 2 of these in their first h
    letters or in their last h, for any h up to n / 2. The first h letters of both, without as many letters as the one that
    loses more of them does, have what they share in common. Each text has ends for every n that it can meet.
    """
    found: dict[str, int] = {}
    for n in range(max(1, math.ceil(len(text) * floor / (2 - floor) - 1e-9)), len(text) + 1):
        h = min(END, n // 2)
        e = math.floor((1 - floor) * (n + longest_partner(n, floor)) + 1e-9) // 2
        for end in (f"<{h}/{text[:h]}", f">{h}/{text[len(text) - h :][::-1]}"):
            found[end] = max(found.get(end, 0), min(e, h))
    return found


def variants(end: str, lost: int) -> set[int]:
    """Hashes of an end without so many letters or fewer."""
    kind, _, letters = end.partition("/")
    found, last = set(), {letters}
    for n in range(lost + 1):
        found |= {crc32(f"{kind}/{t}".encode()) for t in last}
        last = {t[:i] + t[i + 1 :] for t in last for i in range(len(t))} if n < lost else last
    return found


def similar_keys(keys: DataFrame, floor: float = REVIEW) -> DataFrame:
    """(key, other, score) for pairs of different keys with a ratio of at least ``floor``, both ways."""
    share = floor / 100

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(key, text, end, lost) for key, text in zip(batch["key"], batch["text"], strict=True) for end, lost in ends_of(text, share).items()]
            yield pd.DataFrame(rows, columns=["key", "text", "end", "lost"])

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(end, sig) for end, lost in zip(batch["end"], batch["lost"], strict=True) for sig in variants(end, lost)]
            yield pd.DataFrame(rows, columns=["end", "sig"])

    text = F.array_join(F.array_sort(F.filter(F.split("key", " "), lambda t: t != "")), " ")
    cuts = stage(keys.select("key", text.alias("text")).mapInPandas(cut, "key string, text string, end string, lost int"), "key-ends")
    # many keys have an end in common: ends are compared once each, and keys met through the pairs of them
    signed = stage(cuts.groupBy("end").agg(F.max("lost").alias("lost")).mapInPandas(sign, "end string, sig bigint"), "end-signatures")
    near = signed.withColumnRenamed("end", "end_a").join(signed.withColumnRenamed("end", "end_b").hint("merge"), "sig").select("end_a", "end_b").distinct()
    one = cuts.select("key", F.col("text").alias("a"), F.col("end").alias("end_a"))
    two = cuts.select(F.col("key").alias("other"), F.col("text").alias("b"), F.col("end").alias("end_b"))
    letters, shorter = F.length("a") + F.length("b"), F.least(F.length("a"), F.length("b"))
    # a subsequence is no longer than the shorter text, and whoever inserts and deletes n letters edits n times at most
    close = (2 * shorter >= share * letters - 1e-6) & (F.levenshtein("a", "b") <= (1 - share) * letters + 1e-6)
    met = one.join(near.hint("merge"), "end_a").join(two.hint("merge"), "end_b").filter("key < other").filter(close).select("key", "other").distinct()

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["score"] = [token_sort_ratio(a, b) for a, b in zip(batch["key"], batch["other"], strict=True)]
            yield batch[batch["score"] >= floor]

    found = stage(met.mapInPandas(score, "key string, other string, score double"), "similar-keys")
    return found.unionByName(found.select(F.col("other").alias("key"), F.col("key").alias("other"), "score"))


def resolve(names: DataFrame, entities: DataFrame | None = None, aliases: DataFrame | None = None, link: float = LINK, create_if_missing: bool = True) -> DataFrame:
    """names: raw_name, ord (unique). The log: raw_name, ord, normalized_name, canonical_id, method, confidence, review_candidate.

    entities: id, normalized_name. aliases: canonical_entity_id, normalized_alias; an entity's own key wins over an alias.
    """
    spark = names.sparkSession
    keyed = stage(names.withColumn("normalized_name", F.coalesce(normalize_entity_name(F.col("raw_name")), F.lit(""))), "resolve-keys")
    firsts = keyed.filter(usable_name(F.col("normalized_name"))).groupBy(F.col("normalized_name").alias("key")).agg(F.min("ord").alias("first_ord"))
    if entities is None:
        entities = spark.createDataFrame([], "id string, normalized_name string")
    if aliases is None:
        aliases = spark.createDataFrame([], "canonical_entity_id string, normalized_alias string")
    known = entities.select(F.col("normalized_name").alias("key"), F.col("id").alias("known_id"), F.lit(True).alias("is_entity"))
    known = known.unionByName(aliases.select(F.col("normalized_alias").alias("key"), F.col("canonical_entity_id").alias("known_id"), F.lit(False).alias("is_entity")))
    known = known.groupBy("key").agg(F.max_by("known_id", F.struct("is_entity", "known_id")).alias("known_id"), F.max("is_entity").alias("is_entity"))
    every = stage(firsts.join(known, "key", "full").withColumn("rank", F.coalesce(F.when(F.col("known_id").isNotNull(), F.lit(-1)), F.col("first_ord"))), "resolve-index")
    fresh = every.filter("known_id is null")
    pairs = similar_keys(every)
    ranks = every.select(F.col("key").alias("other"), F.col("rank").alias("other_rank"))
    if not create_if_missing:  # names that are not found do not join the index
        ranks = ranks.filter("other_rank < 0")
    earlier = pairs.join(fresh.select("key", "rank"), "key").join(ranks, "other").filter("other_rank < rank")
    best = earlier.groupBy("key").agg(F.max_by(F.struct("other", "score"), F.struct("score", (-F.col("other_rank")).alias("r"))).alias("b"))
    linked = every.join(best, "key", "left").select(
        "key",
        "first_ord",
        "known_id",
        "is_entity",
        F.when(F.col("b.score") >= link, F.col("b.other")).otherwise(F.col("key")).alias("parent"),
        F.col("b.score").alias("score"),
        F.when(F.col("b.score") < link, F.format_string("%s (%.1f)", F.col("b.other"), F.col("b.score"))).alias("review_candidate"),
    )
    linked = stage(linked, "resolve-links")
    roots = stage(linked.select("key", F.col("parent").alias("root")), "resolve-roots")
    while True:  # pointer jumping: paths halve in every round
        up = roots.select(F.col("key").alias("root"), F.col("root").alias("above"))
        jumped = stage(roots.join(up, "root").select("key", F.col("above").alias("root"), (F.col("above") != F.col("root")).alias("moved")), "resolve-roots")
        roots = jumped.select("key", "root")
        if jumped.filter("moved").isEmpty():
            break
    ids = linked.select(F.col("key").alias("root"), F.coalesce("known_id", deterministic_id(F.lit("entity"), F.col("key"))).alias("canonical_id"))
    settled = linked.join(roots, "key").join(ids, "root").withColumnRenamed("key", "normalized_name")
    log = keyed.join(settled, "normalized_name", "left")
    usable, is_first = usable_name(F.col("normalized_name")), F.col("ord") == F.col("first_ord")
    is_fuzzy, is_new = F.col("parent") != F.col("normalized_name"), F.col("known_id").isNull()
    created = F.lit(create_if_missing)
    method = (
        F.when(~usable, "unresolved")
        .when(~is_new, F.when(F.col("is_entity"), "normalized_exact").otherwise("alias"))
        .when(is_fuzzy, F.when(is_first, "fuzzy").otherwise("alias"))
        .when(~created, "unresolved")
        .otherwise(F.when(is_first, "created").otherwise("normalized_exact"))
    )
    log = log.withColumn("method", method)
    confidence = F.when(F.col("method") == "unresolved", 0.0).when(F.col("method") == "alias", ALIAS_CONFIDENCE).when(F.col("method") == "fuzzy", F.bround(F.col("score") / 100, 4)).otherwise(1.0)
    shown = F.when(F.trim("raw_name") == "", "(empty)").otherwise(F.substring(F.coalesce("raw_name", F.lit("(empty)")), 1, 250))
    return log.select(
        shown.alias("raw_name"),
        "ord",
        "normalized_name",
        F.when(F.col("method") != "unresolved", F.col("canonical_id")).alias("canonical_id"),
        "method",
        confidence.alias("confidence"),
        F.when(F.col("method") == "created", F.col("review_candidate")).alias("review_candidate"),
    )


def alias_priority(entities: DataFrame, aliases: DataFrame) -> DataFrame:
    """(key, id, is_entity): one meaning per key, an entity's own key before an alias, then the smaller id."""
    own = entities.select(F.col("normalized_name").alias("key"), "id", F.lit(0).alias("priority"))
    other = aliases.select(F.col("normalized_alias").alias("key"), F.col("canonical_entity_id").alias("id"), F.lit(1).alias("priority"))
    best = own.unionByName(other).groupBy("key").agg(F.min(F.struct("priority", "id")).alias("b"))
    return best.select("key", F.col("b.id").alias("id"), (F.col("b.priority") == 0).alias("is_entity"))
