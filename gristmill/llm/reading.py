"""Reading level of each document from classic readability formulas (problem 9).

A text is cut into sentences, and where punctuation is lost into runs of words. Each piece
gets the grades of five formulas from its length in words, its syllables by
hyphenation-style rules and its letters; their median is the piece's grade. A document's
grade is the word-weighted median over its pieces, read on the raters' scale, its level the
one that most of its words have. The cut points between levels are fitted on raters' grades of
a bounded sample, with a few imagined documents beside the default cut points as a prior: few
labels move them a little, many decide alone, and without any the defaults hold.

Cases: null and wordless texts have no grade and no level; texts of any length are read
whole; repeated documents are graded alike; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.session import spread

#: Grades at which levels 2, 3 and 4 begin, by the raters' scale.
GRADE_LEVELS = (6, 11, 16)
#: Cut points on the formulas' scale before any label is seen, and how far from them the imagined documents lie
#: on either side, each with this weight.
DEFAULT_CUTS, PRIOR_REACH, PRIOR_WEIGHT = (5.0, 13.5, 25.25), 1.0, 0.5
#: Labelled documents that the cut points are fitted on: all, or about so many drawn by a hash.
FIT_DOCS = 4000
#: Grades between which the cut points are sought, on the formulas' scale.
GRID = np.arange(-2, 40, 0.25)
#: Words below which a sentence is joined with the next, as stops may be stray ones; words above which
#: it is cut into runs, as stops may be lost; words of a run.
SHORT_PIECE, LONG_PIECE, RUN = 8, 24, 12

_WORD = re.compile(r"[^\W\d_]+(?:['’-][^\W\d_]+)*")
_ENDS = re.compile(r"(?<=[.!?…])[\"'”’)\]]*\s+|\n+|(?<=;)\s+")
_VOWELS = re.compile(r"[aeiouyàâäáéèêëíîïóôöúùûüæœ]+")
# Letter groups within a run of vowels that begin a syllable of their own.
_BREAKS = re.compile(r"(?<![tscg])ia(?!n$)|(?<![tscgx])io(?!us)|eo(?!u)|ua(?!r)|uo|iu|eu(?=m)|ie(?=t|n[ct])|ei(?=ng)|yi(?=ng)|ya(?=ble)|ui(?=ng)|oi(?=ng)|ea(?=te|tion|l$|lit)")
_SILENT = re.compile(r"(?:[^aeiouy]e|[^aeiouytd]ed|[^aeiouyszxcghl]es|[aeiouy][^aeiouy]ely|[aeiouy][^aeiouy]eful|[aeiouy][^aeiouy]ement|[aeiouy][^aeiouy]eless)$")
_SOUNDED = re.compile(r"[^aeiouyl]l(?:e|es)$|[^aeiouy]re$(?<=[cgt]re)")


@lru_cache(maxsize=200_000)
def syllables(word: str) -> int:
    """Syllables of a lower-case word: vowel runs, runs that break in two, less silent endings."""
    total = 0
    for part in word.replace("’", "'").split("'")[0].split("-"):
        n = len(_VOWELS.findall(part)) + len(_BREAKS.findall(part))
        if _SILENT.search(part) and not _SOUNDED.search(part):
            n -= 1
        total += max(1, n)
    return total


@lru_cache(maxsize=200_000)
def _word_facts(word: str) -> tuple[int, int, int]:
    """(syllables, whether it has three or more, letters)."""
    n = syllables(word.lower())
    return n, int(n >= 3), len(word)


def pieces(text: str) -> list[tuple[int, int, int, int]]:
    """(words, syllables, words of three or more syllables, letters) of each piece."""
    found, held = [], []
    for sentence in [*_ENDS.split(text), None]:
        if sentence is not None:
            held += _WORD.findall(sentence)
            if len(held) < SHORT_PIECE:
                continue
        step = len(held) if len(held) <= LONG_PIECE else RUN
        for i in range(0, len(held), step or 1):
            facts = [_word_facts(w) for w in held[i : i + step]]
            syl, hard, letters = map(sum, zip(*facts, strict=True))
            found.append((len(facts), syl, hard, letters))
        held = []
    return found


def grades(counts: np.ndarray) -> np.ndarray:
    """Median over five formulas' grades of pieces: columns words, syllables, hard words, letters."""
    w, syl, hard, letters = counts.astype(float).T
    estimates = [
        0.39 * w + 11.8 * syl / w - 15.59,
        0.4 * (w + 100 * hard / w),
        1.043 * np.sqrt(30 * hard) + 3.1291,
        5.88 * letters / w - 29.6 / w - 15.8,
        4.71 * letters / w + 0.5 * w - 21.43,
    ]
    return np.median(estimates, axis=0)


def weighted_median(values: np.ndarray, weights: np.ndarray) -> float:
    order = np.argsort(values, kind="stable")
    total = np.cumsum(weights[order])
    return float(values[order][np.searchsorted(total, total[-1] / 2)])


def level_of(piece_grades: np.ndarray, words: np.ndarray, cuts: tuple[float, ...]) -> int:
    """The level that most words have; of equal ones the lower."""
    return int(np.argmax(np.bincount(np.searchsorted(cuts, piece_grades, side="right"), weights=words, minlength=4))) + 1


def histogram(counts: np.ndarray) -> np.ndarray:
    """Words of a document's pieces between each two grades of the grid: all that a fit on the grid can tell apart."""
    return np.bincount(np.searchsorted(GRID, grades(counts), side="right"), weights=counts[:, 0], minlength=len(GRID) + 1)


def levels_of(histograms: np.ndarray, cuts: tuple[float, ...]) -> np.ndarray:
    """The level that most words of each document have (rows of histograms); of equal ones the lower."""
    below = np.cumsum(histograms, axis=1)[:, np.searchsorted(GRID, cuts)]
    total = histograms.sum(axis=1, keepdims=True)
    return np.diff(np.hstack((np.zeros_like(total), below, total)), axis=1).argmax(axis=1) + 1


def fit_cuts(docs: list[tuple[np.ndarray, float]]) -> tuple[float, ...]:
    """Cut points that agree best with the raters. docs: (histogram, mean grade); coordinate descent over the grid."""
    step = float(GRID[1] - GRID[0])  # a document at a cut point lies above it, so the upper one is a step nearer
    prior = [at for k, cut in enumerate(DEFAULT_CUTS) for at in ((cut - PRIOR_REACH, k + 1), (cut + PRIOR_REACH - step, k + 2))]
    imagined = np.zeros((len(prior), len(GRID) + 1))
    for row, (at, _) in zip(imagined, prior, strict=True):
        row[np.searchsorted(GRID, at, side="right")] = 1.0
    words = np.vstack([imagined, *[h for h, _ in docs]])
    rated = np.concatenate(([level for _, level in prior], np.searchsorted(np.array(GRADE_LEVELS) - 0.5, [g for _, g in docs], side="right") + 1))
    weight = np.concatenate((np.full(len(prior), PRIOR_WEIGHT), np.ones(len(docs))))

    def cost(cuts: list[float]) -> float:
        return float((np.abs(levels_of(words, tuple(cuts)) - rated) * weight).sum())

    cuts = list(DEFAULT_CUTS)
    for _ in range(3):
        before = list(cuts)
        for i in range(3):
            low, high = ([-9.0, *cuts, 99.0])[i], ([-9.0, *cuts, 99.0])[i + 2]
            options = [float(x) for x in GRID if low < x < high]
            costs = np.array([cost([*cuts[:i], x, *cuts[i + 1 :]]) for x in options])
            best = np.flatnonzero(costs <= costs.min() + 1e-9)
            cuts[i] = options[int(best[len(best) // 2])]  # the middle of the best ones
        if cuts == before:
            break
    return tuple(cuts)


def rater_scale(grade: np.ndarray, cuts: tuple[float, ...]) -> np.ndarray:
    """Formula grades on the raters' scale from 1 to 20: straight lines through the cut points and the levels' beginnings."""
    begins = np.array(GRADE_LEVELS) - 0.5
    ends = (cuts[0] - (cuts[1] - cuts[0]), *cuts, cuts[2] + (cuts[2] - cuts[1]))
    return np.interp(grade, ends, (1.0, *begins, 20.0))


def labelled_histograms(docs: DataFrame, labels: DataFrame, limit: int = FIT_DOCS) -> list[tuple[np.ndarray, float]]:
    """(histogram, mean grade) of the labelled English documents: of all, or of about ``limit`` drawn by a hash of their ids."""
    mean = labels.filter("grade is not null").groupBy("doc_id").agg(F.avg("grade").alias("grade"))
    english = docs.filter("lang = 'en' and text is not null").select("doc_id", "text")
    rated = mean.join(english.select("doc_id").distinct(), "doc_id", "left_semi")
    share = min(1.0, limit / max(1, rated.count()))
    drawn = rated.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    # about ``limit`` identifiers are broadcast; the texts stay where they are read
    drawn = english.join(F.broadcast(drawn), "doc_id")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [(g, np.array(p)) for g, t in zip(batch["grade"], batch["text"], strict=True) if (p := pieces(t))]
            yield pd.DataFrame({"grade": [g for g, _ in found], "words": [histogram(p) for _, p in found]})

    rows = drawn.select("grade", "text").mapInPandas(count, "grade double, words array<double>").collect()  # GRID numbers a document
    return [(np.array(r.words), r.grade) for r in sorted(rows)]


def reading_levels(docs: DataFrame, cuts: tuple[float, ...] = DEFAULT_CUTS) -> DataFrame:
    """(doc_id, n_words, grade, level) of each document; n_words are split by white space, grade is on the raters' scale."""

    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text in batch:
                counts = np.array(pieces(text or ""))
                n = len((text or "").split())
                if not len(counts):
                    out.append((n, None, None))
                    continue
                grade = grades(counts)
                out.append((n, float(rater_scale(weighted_median(grade, counts[:, 0]), cuts)), level_of(grade, counts[:, 0], cuts)))
            frame = pd.DataFrame(out, columns=["n_words", "grade", "level"])
            yield frame.astype({"grade": "float64", "level": "Int32", "n_words": "int32"})

    # marked so that a filter on its result is not pushed below it and makes it run twice
    read = F.pandas_udf(score, "n_words int, grade double, level int").asNondeterministic()
    return spread(docs.select("doc_id", "text")).select("doc_id", read("text").alias("r")).select("doc_id", "r.n_words", F.when(~F.isnan("r.grade"), F.col("r.grade")).alias("grade"), "r.level")


def found_levels(docs: DataFrame, labels: DataFrame, min_words: int = 20) -> DataFrame:
    """(doc_id, level) of English documents of at least ``min_words`` words."""
    cuts = fit_cuts(labelled_histograms(docs, labels))
    return reading_levels(docs.filter("lang = 'en'"), cuts).filter((F.col("n_words") >= min_words) & F.col("level").isNotNull()).select("doc_id", "level")


def level_profile(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_kind, level, n_docs, n_words, mean_grade): the corpus by how demanding its English texts are."""
    cuts = fit_cuts(labelled_histograms(docs, labels))
    scored = reading_levels(docs.filter("lang = 'en'"), cuts).join(docs.select("doc_id", "doc_kind"), "doc_id")
    return scored.groupBy("doc_kind", "level").agg(F.count("*").alias("n_docs"), F.sum("n_words").alias("n_words"), F.round(F.avg("grade"), 2).alias("mean_grade"))
