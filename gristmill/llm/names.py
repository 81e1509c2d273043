"""Variant spellings of names typed by people (problem 2).

Distinct strings are read into forms: a core (the distinctive part of a firm's name, a
person's surname), the common words beside it (what a firm does, given names and initials),
without legal suffixes, titles, case and accents. Which words are common is learned from the
strings: those that a share of them have, mostly behind another word, and beside many different
ones. Cores with similar padded q-grams meet in MinHash bands, whose number follows from the
collision curve and the recall asked for; what the bands miss of what the verifier accepts
meets in a shared deletion neighbour, without loss.
Pairs of forms are verified by Monge-Elkan similarity, whose token similarity knows typing
errors, abbreviations, initials and nicknames, and clustered by star clustering: the most
complete and most frequent form of a neighbourhood is its centre, and takes the forms that
are similar to itself.

Cases: null, blank and placeholder strings name nobody; equal strings are one; a form that
fits no centre stays alone; ties go to the smaller form; forms of one core meet only if
their common words begin alike, but for a typing error, or are missing, so a core that many
people share is no cross product; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from zlib import crc32

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.session import stage

#: Letters of a gram, rows of a band, and the similarity of cores from which they meet in a band with this probability.
#: Pairs below it are found by their deletion neighbours alone.
Q, ROWS, MIN_JACCARD, RECALL = 2, 4, 0.5, 0.9
MIN_SIMILARITY = 0.84
#: Letters of a core whose deletions are its neighbours.
PREFIX = 16
#: A word is common if at least this share of a kind's strings have it, and no other word stands first beside it in
#: more than this share of them; a firm's common words mostly have a word before them, a person's mostly have none.
COMMON_SHARE, ONE_HEAD = 0.004, 0.5

# Legal forms, states and other words that do not tell firms apart.
NOISE = set(
    "inc incorporated llc llp lp ltd limited gmbh ag sa sas sarl bv nv plc corp corporation co company pbc oy ab pty kg ug srl spa"
    " holding holdings group the yc ai hiring remote careers jobs team and of for".split()
)
# Strings in place of a name.
PLACEHOLDERS = set(
    "na n/a none null nil unknown undisclosed confidential confidentialclient confidentialcompany stealth stealthstartup stealthmode stealthcompany"
    " anonymous private notavailable notdisclosed notspecified tbd tba test various self selfemployed freelance company client employer hidden"
    " companyname companyconfidential ourclient etal author authors anon".split()
)
TITLES = set("dr prof professor mr mrs ms miss sir phd md msc bsc jr sr ii iii dipl ing".split())
# Given names and their usual short forms.
NICKNAMES = {
    "alexander": "alex sasha sandy xander al lex", "anastasia": "stacy nastya ana stasia tasia", "andrew": "andy drew", "anthony": "tony",
    "benjamin": "ben benji benny", "charles": "charlie chuck", "christopher": "chris kit topher", "daniel": "dan danny", "david": "dave",
    "dolores": "lola lolita", "edward": "ed eddie ned ted teddy", "elizabeth": "liz beth betty lizzy eliza lisa", "francisco": "paco pancho cisco frank",
    "frederick": "fred freddie freddy rick", "giuseppe": "beppe peppe pino", "guadalupe": "lupe lupita", "henrietta": "hattie etta hetty", "henry": "hank harry",
    "isabella": "bella izzy isa", "james": "jim jimmy jamie", "jennifer": "jen jenny jenn", "johannes": "jan hannes johann hans", "john": "jack johnny",
    "joseph": "joe joey", "katherine": "kate kathy kit katie kat", "margaret": "maggie peggy meg greta", "matthew": "matt", "michael": "mike mick mickey",
    "nathaniel": "nat nate nathan", "nicholas": "nick", "oluwaseun": "seun olu", "patricia": "patty trish pat tricia", "peter": "pete",
    "rajendra": "raj raju", "richard": "rick dick rich ricky", "robert": "rob bob bobby robbie bert", "samantha": "sam sammy", "samuel": "sam sammy",
    "stephen": "steve", "susanne": "susi sanne sue susan suzy", "theodore": "ted theo teddy", "thomas": "tom tommy", "vladimir": "vova volodya vlad",
    "william": "will bill billy liam willy", "yevgenia": "zhenya yeva jenya genya",
}
GIVEN = {short: {name for name, shorts in NICKNAMES.items() if short in shorts.split()} for shorts in NICKNAMES.values() for short in shorts.split()}
for _name in NICKNAMES:
    GIVEN.setdefault(_name, set()).add(_name)

_SPLIT = re.compile(r"[^0-9a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


def fold(text: str) -> str:
    """Without accents and case; letters that do not decompose get their usual spelling."""
    text = text.translate({0xF8: "o", 0xD8: "O", 0xE6: "ae", 0xC6: "AE", 0x153: "oe", 0x142: "l", 0x141: "L", 0x111: "d", 0x131: "i"})
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c)).casefold()


@lru_cache(maxsize=200_000)
def distance(a: str, b: str, limit: int = 3) -> int:
    """Edits between two short strings, a swap of neighbours being one; limit + 1 if there are more than ``limit``."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > limit:
        return limit + 1
    far = limit + 1
    before, last = None, [min(j, far) for j in range(len(b) + 1)]
    for i, x in enumerate(a, 1):
        row = [far] * (len(b) + 1)
        row[0] = min(i, far)
        for j in range(max(1, i - limit), min(len(b), i + limit) + 1):  # further off the diagonal there are too many edits
            y = b[j - 1]
            n = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y))
            if before and i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                n = min(n, before[j - 2] + 1)
            row[j] = n
        if min(row[max(0, i - limit) : i + limit + 1]) > limit:
            return far
        before, last = last, row
    return min(last[-1], far)


def allowed(a: str, b: str) -> int:
    """Typing errors that two tokens of these lengths may have."""
    n = min(len(a), len(b))
    return 0 if n < 4 else 1 if n < 6 else 2


def squeezed(short: str, long: str) -> bool:
    """Whether ``short`` is ``long``'s first letter and consonants of it in order."""
    if len(short) < 2 or short[0] != long[0] or any(c in "aeiou" for c in short[1:]):
        return False
    rest = iter(long)
    return all(c in rest for c in short)


@lru_cache(maxsize=100_000)
def token_similarity(a: str, b: str) -> float:
    """1 equal, 0.95 nickname, beginning, initial or abbreviation, else by typing errors."""
    if a == b:
        return 1.0
    if GIVEN.get(a, {a}) & GIVEN.get(b, {b}):
        return 0.95
    short, long = sorted((a, b), key=lambda t: (len(t), t))
    if len(short) == 1:
        return 0.95 if any(name[0] == short for name in GIVEN.get(long, {long})) else 0.0
    if len(short) >= 3 and long.startswith(short[: max(3, len(short) - 1)]) and (long.startswith(short) or len(short) >= 6):
        return 0.95
    if len(short) >= 4 and short[-1] == "s" and long.startswith(short[:-1]):
        return 0.95
    if len(short) <= 0.6 * len(long) and squeezed(short, long):
        return 0.95
    best = max((1 - distance(x, y) / max(len(x), len(y)) for x in GIVEN.get(a, {a}) for y in GIVEN.get(b, {b}) if distance(x, y) <= allowed(x, y)), default=0.0)
    return best


def monge_elkan(a: list[str], b: list[str]) -> float:
    """Mean over the shorter list's tokens of the best similarity with a token of the other, never used twice."""
    a, b = sorted((a, b), key=len)
    left, total = list(b), 0.0
    for x in a:
        sims = [token_similarity(x, y) for y in left]
        at = int(np.argmax(sims))
        total += sims[at]
        left.pop(at)
    return total / len(a) if a else 1.0


@dataclass(frozen=True)
class Form:
    core: str
    common: tuple[str, ...] = ()
    rest: str = ""


def _typed(token: str, word: str) -> float:
    """Similarity by typing errors, with one more in a long word: common words are few and far apart."""
    ours, theirs = set(token), set(word)
    if abs(len(token) - len(word)) > 3 or len(theirs - ours) > 3 or len(ours - theirs) > 3:  # each error takes or brings one letter at most
        return 0.0
    errors = distance(token, word)
    known = errors <= allowed(token, word) + (min(len(token), len(word)) >= 9)
    return 1 - errors / max(len(token), len(word)) if known else 0.0


def misspelt(token: str, word: str) -> bool:
    """Whether a token is a long word with one error and another ending, or with one error and a few letters more."""
    if len(word) >= 5 and 0 < len(token) - len(word) <= 5 and len(set(word) - set(token)) <= 1:
        if any(distance(token[:n], word) <= 1 for n in range(len(word) - 1, len(word) + 2)):
            return True
    stem = token[:-1]
    if len(stem) < max(6, 0.6 * len(word)) or len(set(stem) - set(word)) > 1:
        return False
    return any(distance(stem, word[:n]) <= 1 for n in range(len(stem) - 1, len(stem) + 2))


def stands_for(token: str, word: str) -> bool:
    """Whether a token is a beginning, a squeezed spelling, another ending or a compound of a common word."""
    if len(token) >= 3 and word.startswith(token) or len(token) >= 4 and token[-1] == "s" and word.startswith(token[:-1]):
        return True
    if len(word) >= 5 and token.startswith(word) and len(token) - len(word) <= 4:
        return True
    if len(token) >= 2 and len(token) <= 0.6 * len(word) and squeezed(token, word):
        return True
    alike = next((i for i, (x, y) in enumerate(zip(token, word, strict=False)) if x != y), min(len(token), len(word)))
    return alike >= 5 and alike >= 0.6 * max(len(token), len(word))


@dataclass(eq=False)
class Vocabulary:
    """A kind's common words with the number of strings that have each, by their initials the pairs that many have, and
    the words that begin the names of many records."""

    words: dict[str, int] = field(default_factory=dict)
    pairs: dict[str, tuple[str, str]] = field(default_factory=dict)
    heads: frozenset[str] = frozenset()

    def __post_init__(self) -> None:
        self._read: dict[str, str | None] = {}
        self.long = sorted((w for w in self.words if len(w) > 5), key=lambda w: (-len(w), w))

    def read(self, token: str) -> str | None:
        """The common word that a token stands for; its own if it stands for several; None if it is distinctive."""
        if token not in self._read:
            if len(self._read) > 200_000:
                self._read.clear()
            self._read[token] = self._find(token)
        return self._read[token]

    def _find(self, token: str) -> str | None:
        often = self.words.get(token, 0)
        meant = [w for w, n in self.words.items() if n > often and w != token and stands_for(token, w)]
        meant = [w for w in meant if not any(self.words[v] > self.words[w] and stands_for(w, v) for v in meant if v != w)]  # short forms may be common too
        if meant or often:
            return meant[0] if len(meant) == 1 else token
        if len(token) < 5 or not self.words:
            return None
        alike = {w: max(_typed(token, w), 0.75 if misspelt(token, w) else 0.0) for w in self.words}
        best = max(alike, key=lambda w: (alike[w], self.words[w], w))
        return (self.read(best) or best) if alike[best] >= 0.75 else None


NO_WORDS = Vocabulary()


def _in_two(token: str, after: str, word: str | None, common: Vocabulary) -> str | None:
    """The common word that two tokens make together, the first standing for ``word`` alone."""
    last = common.read(after)
    if word is not None and last not in (None, word) or word is None and last is not None and not (last.startswith(token) or last.endswith(after)):
        return None
    joined = common.read(token + after)
    whole = joined == word or word is None and joined is not None and (joined.startswith(token) or joined.endswith(after) and joined != after)
    return joined if joined in common.words and whole and last in (None, joined) else None


def company_form(name: str, common: Vocabulary = NO_WORDS) -> Form | None:
    """The form of a firm's name; None for blanks and placeholders."""
    plain = " ".join(w for w in unicodedata.normalize("NFC", name).split() if fold(w).strip(".,()") not in NOISE) or name
    text = fold(_CAMEL.sub(" ", plain)).replace("'", "").replace("’", "")
    if re.sub(r"[^a-z/]", "", text).strip("/") in PLACEHOLDERS:
        return None
    first, _, last = text.partition(",")
    if any(t not in NOISE for t in _SPLIT.split(last) if t):  # "what it does, name"
        text = f"{last} {first}"
    tokens = [t for t in _SPLIT.split(re.sub(r"\b([a-z])\.(?=[a-z]\b)", r"\1", text)) if t]
    kept = [t for t in tokens if t not in NOISE] or tokens
    core, trades, i = [], [], 0
    while i < len(kept):
        token, after = kept[i], kept[i + 1] if i + 1 < len(kept) else ""
        initials = token[0] + after if len(token) == len(after) == 1 else token[0] + token[2] if len(token) == 3 and token[1] == "n" else ""
        if core and initials in common.pairs:
            trades += common.pairs[initials]
            i += 1 + (len(token) == 1)
            continue
        word = common.read(token) if len(kept) > 1 else None
        if after and core and (joined := _in_two(token, after, word, common)):
            trades.append(joined)
            i += 2
            continue
        (core if word is None else trades).append(token if word is None else word)
        i += 1
    if not core:
        core, trades = ([kept[0]], trades[1:]) if kept else ([], [])
    if at := next((i for i, t in enumerate(core) if t in common.heads), 0):  # a well-known name in another order
        core = core[at:] + core[:at]
    joined = "".join(core)
    for word in common.long:  # written together
        if joined.endswith(word) and len(joined) - len(word) >= 4:
            joined, trades = joined[: -len(word)], [common.read(word) or word, *trades]
            break
    if len(joined) < 2:
        return None
    return Form(joined, tuple(sorted(dict.fromkeys(trades))))


@lru_cache(maxsize=200_000)
def _like_given(token: str) -> float:
    near = [n for n in NICKNAMES if len(set(n) - set(token)) <= 2]  # each of two errors takes away one letter at most
    return max((s for n in near if (s := token_similarity(token, n)) < 0.95), default=0.0) if len(token) > 3 else 0.0


def _is_given(token: str, common: Vocabulary) -> float:
    return 1.0 if token in GIVEN or token in common.words else _like_given(token)


def person_form(name: str, common: Vocabulary = NO_WORDS) -> Form | None:
    """The form of a person's name: surname, given name or initial, further initials; None for blanks."""
    plain = unicodedata.normalize("NFC", name).replace("’", "'")
    if re.sub(r"[^a-z/]", "", fold(plain)).strip("/") in PLACEHOLDERS:
        return None
    parts = [[t for t in re.split(r"[\s.]+", p) if t.strip(" -_'")] for p in plain.split(",")]
    mixed = any(c.islower() for c in plain)
    parts = [[t for t in p if fold(t).strip(".") not in TITLES or (mixed and t.isupper())] for p in parts]
    parts = [p for p in parts if p]
    if not parts:
        return None

    def spread(tokens: list[str]) -> list[str]:
        out = []
        for t in tokens:
            if mixed and t.isupper() and 2 <= len(t) <= 3:
                out += list(fold(t))
            elif clean := re.sub(r"[^a-z]", "", fold(t)):
                out.append(clean)
        return out

    if len(parts) > 1:
        surname, given = spread(parts[0]), spread([t for p in parts[1:] for t in p])
    else:
        tokens = spread(parts[0])
        if len(tokens) < 2:
            surname, given = tokens, []
        elif len(tokens[-1]) == 1 and len(tokens[0]) > 1 and _is_given(tokens[0], common) < 0.7:
            surname, given = tokens[:1], tokens[1:]
        elif _is_given(tokens[-1], common) > _is_given(tokens[0], common) and len(tokens[0]) > 1:
            surname, given = tokens[:-1], tokens[-1:]
            if len(tokens) > 2 and all(len(t) == 1 for t in tokens[1:-1]):
                surname, given = tokens[:1], [tokens[-1], *tokens[1:-1]]
        else:
            middle = len([t for t in tokens[1:] if len(t) == 1])
            at = 1 + middle if middle < len(tokens) - 1 else 1
            surname, given = tokens[at:], tokens[:at]
    core = "".join(surname)
    if len(core) < 2:
        return None
    first = given[:1]
    return Form(core, tuple(first), "".join(t[0] for t in given[1:]))


def initials_of(common: tuple[str, ...]) -> set[str]:
    """First letters that a form's common words may have written out."""
    return {name[0] for t in common for name in GIVEN.get(t, {t})}


def meeting_keys(common: tuple[str, ...]) -> list[str]:
    """What forms of one core meet by: first letters, and three letters near the beginning, which one typing error there leaves."""
    near = {f"~{t[i : i + 3]}" for t in common if len(t) >= 4 for i in range(3) if len(t) >= i + 3}
    return sorted(initials_of(common) | near) or [""]


def form_similarity(kind: str, a: Form, b: Form) -> float:
    """Monge-Elkan similarity of two forms, cores and common words alike; 0 where one part contradicts the other."""
    errors = distance(a.core, b.core)
    if errors > allowed(a.core, b.core):
        return 0.0
    core = 1 - errors / (2 * max(len(a.core), len(b.core)))
    if kind == "author" and a.rest and b.rest and a.rest[0] != b.rest[0]:
        return 0.0
    if not a.common or not b.common:
        return 0.97 * core if kind == "company" else 0.0
    common = monge_elkan(list(a.common), list(b.common))
    return 0.5 * core + 0.5 * common if common >= 0.7 else 0.0


def bands_for(jaccard: float, recall: float, rows: int) -> int:
    """Bands needed for pairs of this Jaccard similarity to meet with this probability: 1 - (1 - j^rows)^bands >= recall."""
    return math.ceil(math.log(1 - recall) / math.log(1 - jaccard**rows))


def min_hashes(core: str, seeds: np.ndarray) -> np.ndarray:
    padded = f"{'^' * (Q - 1)}{core}{'$' * (Q - 1)}"
    grams = np.array([crc32(padded[i : i + Q].encode()) for i in range(len(padded) - Q + 1)], dtype=np.uint64)
    mixed = grams[:, None] * seeds[0] + seeds[1]
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (mixed ^ (mixed >> np.uint64(32))).min(axis=0)


def _band_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    bands = bands_for(MIN_JACCARD, RECALL, ROWS)
    rng = np.random.default_rng(7)
    seeds = rng.integers(1, 1 << 62, size=(2, bands * ROWS), dtype=np.uint64) | np.uint64(1)
    mult = rng.integers(1, 1 << 62, size=ROWS, dtype=np.uint64) | np.uint64(1)
    for batch in batches:
        if not len(batch):
            continue
        with np.errstate(over="ignore"):
            keys = np.stack([(min_hashes(c, seeds).reshape(bands, ROWS) * mult).sum(axis=1) + np.arange(bands, dtype=np.uint64) for c in batch["core"]])
        yield pd.DataFrame({"kind": np.repeat(batch["kind"].to_numpy(), bands), "core": np.repeat(batch["core"].to_numpy(), bands), "bucket": keys.astype(np.int64).ravel()})


def deletion_neighbours(core: str) -> set[str]:
    """What is left of a core's first PREFIX letters without as many of them as it may have typing errors, or fewer.

    Two cores that ``allowed`` lets pass have one in common: what they share after their errors is left of both, a swap
    costing each a letter; where one prefix lost more letters than the other, the other can also do without its last ones.
    """
    found = last = {core[:PREFIX]}
    for _ in range(allowed(core, core)):
        last = {t[:i] + t[i + 1 :] for t in last for i in range(len(t))}
        found = found | last
    return found


def _neighbour_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = [(kind, core, xxhash.xxh64_intdigest(t.encode()) - (1 << 63)) for kind, core in zip(batch["kind"], batch["core"], strict=True) for t in deletion_neighbours(core)]
        yield pd.DataFrame(rows, columns=["kind", "core", "bucket"]).astype({"bucket": "int64"})


def candidate_cores(cores: DataFrame) -> DataFrame:
    """(kind, core_a, core_b) of cores that meet in a band or share a deletion neighbour and are at most four edits
    apart, a swap being two; each with itself too. The bands' misses are all found by the neighbours."""
    schema = "kind string, core string, bucket bigint"
    banded = cores.mapInPandas(_band_batches, schema).unionByName(cores.mapInPandas(_neighbour_batches, schema))
    a, b = banded.withColumnRenamed("core", "core_a"), banded.withColumnRenamed("core", "core_b")
    close = F.levenshtein("core_a", "core_b", 4)
    # merge joins: the optimizer takes what Python made of a small table for small, and would broadcast it unchecked
    pairs = a.join(b.hint("merge"), ["kind", "bucket"]).filter("core_a < core_b").filter((close >= 0) & (close <= 4)).select("kind", "core_a", "core_b").distinct()
    return pairs.unionByName(cores.select("kind", F.col("core").alias("core_a"), F.col("core").alias("core_b")))


def common_words(strings: DataFrame) -> dict[str, Vocabulary]:
    """Each kind's common words, pairs and heads: at most 1/COMMON_SHARE times the words of a string of each."""
    totals = {r.kind: (r.total, r.rows) for r in strings.groupBy("kind").agg(F.count("*").alias("total"), F.sum("n").alias("rows")).collect()}  # a row for each kind

    def of_kind(i: int) -> Column:
        found = F.lit(None).cast("bigint")
        for kind, counts in totals.items():
            found = F.when(F.col("kind") == kind, F.lit(counts[i])).otherwise(found)
        return found

    split = F.filter(F.split(F.lower("name"), r"[^\p{L}]+"), lambda w: (F.length(w) > 2) & ~w.isin(*sorted(NOISE)))
    words = strings.select("kind", "n", F.array_distinct(split).alias("ws")).filter("size(ws) > 0")
    each = words.select("kind", "n", "ws", F.posexplode("ws").alias("i", "w"))
    head = F.coalesce(F.get(F.filter("ws", lambda x: x != F.col("w")), F.lit(0)), F.lit(""))
    sums = [F.count("*").alias("df"), F.count_if(F.col("i") > 0).alias("behind"), F.sum("n").alias("uses"), F.sum(F.when(F.col("i") == 0, F.col("n")).otherwise(0)).alias("ahead")]
    heads = each.groupBy("kind", "w", head.alias("head")).agg(*sums)
    often = heads.groupBy("kind", "w").agg(*[F.sum(c).alias(c) for c in ("df", "behind", "uses", "ahead")], F.max("df").alias("one")).withColumns({"total": of_kind(0), "rows": of_kind(1)})
    wide = (F.col("df") >= F.col("total") * COMMON_SHARE) & (F.col("one") <= F.col("df") * ONE_HEAD) & F.when(F.col("kind") == "company", F.col("behind") * 2 > F.col("df")).otherwise(F.col("behind") * 2 < F.col("df"))
    known_head = (F.col("kind") == "company") & (F.col("uses") >= F.col("rows") * COMMON_SHARE) & (F.col("ahead") * 2 > F.col("uses"))
    found: dict[str, dict[str, int]] = {}
    first: set[str] = set()
    for row in often.select("kind", "w", "df", wide.alias("wide")).filter(wide | known_head).collect():
        if row.wide:
            found.setdefault(row.kind, {})[fold(row.w)] = int(row.df)
        else:
            first.add(fold(row.w))
    known = F.array(*[F.lit(w) for w in sorted(found.get("company", {}))]) if found.get("company") else F.array().cast("array<string>")
    two = F.transform(F.sequence(F.lit(0), F.size("ws") - 2), lambda i: F.struct(F.get("ws", i).alias("a"), F.get("ws", i + 1).alias("b")))
    pairs = words.filter("kind = 'company' and size(ws) > 1").select(F.explode(two).alias("p")).select("p.a", "p.b")
    pairs = pairs.filter(F.array_contains(known, F.col("a")) & F.array_contains(known, F.col("b"))).groupBy("a", "b").agg(F.count("*").alias("n"))
    total = totals.get("company", (0, 0))[0]
    by_initials: dict[str, tuple[str, str]] = {}
    for row in sorted(pairs.filter(F.col("n") >= total * COMMON_SHARE).select("n", "a", "b").collect()):
        by_initials[row.a[0] + row.b[0]] = (row.a, row.b)  # the most frequent one last
    return {kind: Vocabulary(found.get(kind, {}), *((by_initials, frozenset(first)) if kind == "company" else ())) for kind in {"company", *found}}


def parse_forms(strings: DataFrame) -> DataFrame:
    """strings: kind, name, n. Adds core, common, rest, letters; strings that name nobody are left out."""
    common = common_words(strings)
    readers = {"company": company_form, "author": person_form}

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for kind, name, n in zip(batch["kind"], batch["name"], batch["n"], strict=True):
                if form := readers[kind](name, common.get(kind, NO_WORDS)):
                    rows.append((kind, name, n, form.core, list(form.common), form.rest, meeting_keys(form.common)))
            yield pd.DataFrame(rows, columns=["kind", "name", "n", "core", "common", "rest", "letters"])

    spark = strings.sparkSession  # few rows that take long to read: the optimizer would leave them to few tasks
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return strings.repartition(tasks).mapInPandas(read, "kind string, name string, n bigint, core string, common array<string>, rest string, letters array<string>")


def similar_forms(forms: DataFrame) -> DataFrame:
    """(kind, a, b, similarity): verified pairs of forms a < b. forms: kind, form, core, common, rest, letters."""
    pairs = candidate_cores(forms.select("kind", "core").distinct())
    side = lambda s: forms.select("kind", *[F.col(c).alias(f"{c}_{s}") for c in ("form", "core", "common", "rest", "letters")])
    left, right, pairs = side("a"), side("b").hint("merge"), pairs.hint("merge")
    lettered = lambda df, s: df.withColumn("letter", F.explode(f"letters_{s}"))
    same = lettered(left, "a").join(pairs, ["kind", "core_a"]).join(lettered(right, "b").hint("merge"), ["kind", "core_b", "letter"])
    bare_a = left.filter(F.col("letters_a")[0] == "").join(pairs, ["kind", "core_a"]).join(right, ["kind", "core_b"])
    bare_b = left.filter(F.col("letters_a")[0] != "").join(pairs, ["kind", "core_a"]).join(right.filter(F.col("letters_b")[0] == "").hint("merge"), ["kind", "core_b"])
    columns = ["kind", "form_a", "core_a", "common_a", "rest_a", "form_b", "core_b", "common_b", "rest_b"]
    met = same.select(*columns).unionByName(bare_a.select(*columns)).unionByName(bare_b.select(*columns)).filter("form_a <> form_b").distinct()

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sims = [
                form_similarity(r.kind, Form(r.core_a, tuple(r.common_a), r.rest_a), Form(r.core_b, tuple(r.common_b), r.rest_b)) for r in batch.itertuples(index=False)
            ]
            batch["similarity"] = sims
            batch = batch[batch["similarity"] >= MIN_SIMILARITY]
            yield pd.DataFrame({"kind": batch["kind"], "a": batch[["form_a", "form_b"]].min(axis=1), "b": batch[["form_a", "form_b"]].max(axis=1), "similarity": batch["similarity"]})

    return met.mapInPandas(verify, "kind string, a bigint, b bigint, similarity double").distinct()


def star_clusters(forms: DataFrame, edges: DataFrame) -> DataFrame:
    """(form, centre). In each round a free form that ranks above all free neighbours becomes a centre, and free
    neighbours of centres go to their most similar one. forms: form, rank (smaller is better, ties to the smaller
    form, so that some form ranks first in every round); edges: a, b, similarity."""
    both = edges.select("a", "b", "similarity").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"), "similarity"))
    order = lambda s: forms.select(F.col("form").alias(s), F.struct("rank", "form").alias(f"rank_{s}"))
    open_edges = stage(both.join(order("a"), "a").join(order("b"), "b"), "star-edges")
    centre_of = None
    while not open_edges.isEmpty():
        best = open_edges.groupBy("a").agg(F.min("rank_b").alias("best"), F.first("rank_a").alias("rank_a"))
        centres = best.filter(F.col("rank_a") < F.col("best")).select(F.col("a").alias("centre"))
        nearest = F.min_by("centre", F.struct((-F.col("similarity")).alias("s"), F.col("rank_b").alias("r")))
        taken = open_edges.join(centres, F.col("b") == F.col("centre")).groupBy(F.col("a").alias("form")).agg(nearest.alias("centre"))
        settled = stage(taken.unionByName(centres.select(F.col("centre").alias("form"), "centre")), "star-settled")
        centre_of = settled if centre_of is None else centre_of.unionByName(settled)
        gone = settled.select(F.col("form").alias("gone")).hint("merge")
        rest = open_edges.join(gone, F.col("a") == F.col("gone"), "left_anti").join(gone, F.col("b") == F.col("gone"), "left_anti")
        open_edges = stage(rest, "star-edges")
    alone = forms.select("form")
    if centre_of is None:
        return alone.select("form", F.col("form").alias("centre"))
    return alone.join(centre_of, "form", "left").select("form", F.coalesce("centre", "form").alias("centre"))


def name_clusters(strings: DataFrame) -> DataFrame:
    """(kind, name, n, form, entity) of every string that names somebody. strings: kind, name, n; each string once."""
    parsed = stage(parse_forms(strings).withColumn("form", F.xxhash64("kind", "core", "common", "rest")), "name-forms")
    forms = parsed.groupBy("kind", "form", "core", "common", "rest", "letters").agg(F.sum("n").alias("n"))
    longest = F.coalesce(F.aggregate("common", F.lit(0), lambda m, t: m + F.length(t)), F.lit(0))
    complete = F.when(F.aggregate("common", F.lit(False), lambda m, t: m | (F.length(t) > 2)), 1).otherwise(0)
    # complete forms first, then frequent, then long ones
    rank = F.struct((-complete).alias("c"), (-F.col("n")).alias("n"), (-longest).alias("l"))
    forms = stage(forms.withColumn("rank", rank), "forms")
    stars = star_clusters(forms.select("form", "rank"), stage(similar_forms(forms), "form-edges"))
    return parsed.join(stars, "form").select("kind", "name", "n", "form", F.col("centre").alias("entity"))


def typed_names(jobs: DataFrame, startups: DataFrame, works: DataFrame) -> DataFrame:
    """(kind, name, n): the distinct strings of the three fields, with how often they stand there."""
    company = jobs.select(F.lit("company").alias("kind"), F.col("company").alias("name")).unionByName(startups.select(F.lit("company").alias("kind"), F.col("entity_name").alias("name")))
    author = works.select(F.explode("authorships").alias("a")).select(F.lit("author").alias("kind"), F.col("a.author.display_name").alias("name"))
    return company.unionByName(author).filter(F.col("name").rlike(r"(?U)\S")).groupBy("kind", "name").agg(F.count("*").alias("n"))


def linked_names(jobs: DataFrame, startups: DataFrame, works: DataFrame) -> DataFrame:
    """(kind, name_a, name_b): each pair of different strings of one entity; only a entity's own spellings meet."""
    clusters = name_clusters(typed_names(jobs, startups, works)).select("kind", "entity", "name")
    a, b = clusters.withColumnRenamed("name", "name_a"), clusters.withColumnRenamed("name", "name_b")
    return a.join(b, ["kind", "entity"]).filter("name_a < name_b").select("kind", "name_a", "name_b")


def band_report(spark: SparkSession) -> DataFrame:
    """(jaccard, bands, rows, collision): the collision curve at the chosen parameters."""
    bands = bands_for(MIN_JACCARD, RECALL, ROWS)
    return spark.createDataFrame([(j / 20, bands, ROWS, round(1 - (1 - (j / 20) ** ROWS) ** bands, 6)) for j in range(1, 21)], "jaccard double, bands int, rows int, collision double")
