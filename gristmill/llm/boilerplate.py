"""Main content of web pages by consensus host paths (problem 1).

1. Every page is parsed once and cut into containers: the elements that stay open over a
   line's end. A page votes for the generalised tag-class path of its best container (most
   running text, least linked text, the headline). Votes are counted per host in Spark over
   all pages. A path wins or loses its host by its share of votes with one vote for and one
   against added, so that a path that few pages have decides nothing; none is left out.
2. Winning paths label the lines of a bounded sample of pages. From these a hashed line model
   (log-odds of words, word pairs, shapes and whole lines) is counted. It judges what paths
   cannot tell apart: layouts whose containers all look the same, promoted lines inside the
   article, and lines of plain texts that no page has.
3. Every page is extracted again: containers by their host's winning paths and the line
   model together, then lines within the chosen containers.
4. A plain text that was taken from a page goes through that page's paths: each of its lines
   that stands in the page is judged as it was there. Other lines, and texts without a page,
   are judged by the line model alone, as they have no containers.

Cases: null and blank texts give no lines; lines without visible text never count; pages of
a host without clear votes fall back on the line model; a page whose best container is too
small (a notice in place of the article) has no main content; repeated pages vote each; of
pages with one id any stands for it; a text whose page is missing is judged by the model; a
line that stands in a page more than once is content if it is so once; very long pages are
read whole and nested ones to any depth; an empty table gives an empty result.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from zlib import crc32

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.session import spread, stage

#: Pages the line model is counted on (all, or about so many drawn by a hash), and its number of hashed features.
MODEL_PAGES, FEATURES = 8000, 1 << 18
#: Share of votes, one for and one against added, from which a path is a main path of its host, and up to which it is none.
WIN_RATIO, LOSE_RATIO = 0.7, 0.1
#: Score of a line below which it is no content within a content container, and below which a second
#: count of the model takes a line of the main path for furniture.
DROP, RELABEL = -1.2, -0.4
#: Characters of a line that may announce a list of lines below it.
SHORT_LINE = 32
#: Elements of a path that are written out; deeper ones are told apart by a hash of theirs.
WRITTEN = 40
#: Words of running text below which a container without the headline is no main container.
MIN_WORDS = 25

_DIGITS = re.compile(r"\d+")
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([A-Za-z][\w:-]*)([^<>]*)>|([^<]+|<)", re.S)
_WHOLE = re.compile(r"\s*<([A-Za-z][A-Za-z0-9]*)\b[^<>/]*(?:/[^<>/]*)*>(?:([^<>]*)|<a\b[^<>]*>([^<>]*)</a>)</\1>\s*$", re.I)
_CLASS = re.compile(r"""\b(?:class|role)\s*=\s*["']?([^"'>]*)""", re.I)
_TITLE = re.compile(r"<title[^>]*>(.*?)</title>", re.I | re.S)
_SENTENCE = re.compile(r"[.!?…][\"'”’»)\]]*$")
_STOPS = re.compile(r"[.!?…](?=[\s\x22'”’»]|$)")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_HIDDEN = frozenset("head script style noscript template svg title".split())
_PART = frozenset("nav footer aside button form".split())
# Elements of a head; elements that end an open paragraph; by open element, those that end it.
_HEAD = frozenset("title meta link script style base noscript template head html".split())
_BLOCKS = frozenset("p div section article main header footer aside nav table ul ol dl h1 h2 h3 h4 h5 h6 form pre blockquote hr fieldset figure address".split())
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "tr": {"tr"}, "option": {"option"}}
_OUTSIDE = ("", "", 0, False)
# Words of class names and tags that mark page furniture, and that mark the article.
_FURNITURE = re.compile(r"nav|menu|foot|side|aside|promo|share|social|consent|cookie|banner|related|comment|subscribe|newsletter|crumb|header|toolbar", re.I)
_ARTICLE = re.compile(r"article|story|content|main|post|entry|text|body", re.I)


@dataclass
class Line:
    """A line with visible text: its number, container, the container's path, whether all of it is linked, its leaf tag."""

    no: int
    box: int
    path: str
    text: str
    linked: bool
    leaf: str


def squeeze(text: str) -> str:
    return " ".join(text.split())


def _implied(tag: str, open_tag: str) -> bool:
    """Whether an open element ends where this tag opens, as its end tag may be left out."""
    if open_tag == "head":
        return tag not in _HEAD
    if open_tag == "p":
        return tag in _BLOCKS
    return tag in _CLOSES.get(open_tag, ())


def _below(path: str, name: str, depth: int) -> str:
    """The path of an element within one of this path: names joined, beyond WRITTEN elements a hash of them and its own name."""
    if not path:
        return name
    if depth < WRITTEN:
        return f"{path}/{name}"
    top, _, rest = path.partition("/~")
    return f"{top}/~{xxhash.xxh64_hexdigest(f'{rest}/{name}')}/{name}"


def page_lines(source: str) -> tuple[list[Line], str]:
    """Lines with visible body text and the page's title."""
    found: list[Line] = []
    stack: list[tuple[str, str, int, bool]] = []  # tag, path, number, whether within a link
    hidden, boxes, open_comment = 0, 0, False
    title = _TITLE.search(source)
    for no, raw in enumerate(source.split("\n")):
        if open_comment:
            end = raw.find("-->")
            if end < 0:
                continue
            raw, open_comment = raw[end + 3 :], False
        if not hidden and (whole := _WHOLE.match(raw)):  # one element on its line, by far the most frequent line
            tag, text, inner = whole.group(1).lower(), whole.group(2), whole.group(3)
            if tag in _HIDDEN:
                continue
            while stack and _implied(tag, stack[-1][0]):
                stack.pop()
            if visible := squeeze(html.unescape(text if inner is None else inner)):
                _, path, box, in_link = stack[-1] if stack else _OUTSIDE
                found.append(Line(no, box, path, visible, inner is not None or tag == "a" or in_link, tag))
            continue
        depth = len(stack)
        _, path, box, _ = stack[-1] if stack else _OUTSIDE
        text, linked, leaf = [], 0, ""
        for hit in _TOKEN.finditer(raw):
            close, tag, attrs, chars = hit.groups()
            if chars is not None:
                if not hidden:
                    text.append(chars)
                    if not chars.isspace():
                        if not leaf and len(stack) > depth:
                            leaf = stack[-1][0]
                        linked += len(chars) if stack and stack[-1][3] else 0
                continue
            if tag is None:
                open_comment = hit.group().startswith("<!--") and not hit.group().endswith("-->")
                continue
            tag = tag.lower()
            if tag in _VOID or attrs.endswith("/"):
                continue
            if close:
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == tag:
                        hidden -= sum(gone[0] in _HIDDEN for gone in stack[i:])
                        del stack[i:]
                        break
            while not close and stack and _implied(tag, stack[-1][0]):
                hidden -= stack.pop()[0] in _HIDDEN
            if len(stack) < depth and not linked and not any(map(str.strip, text)):  # what ends before any text does not hold the line
                depth = len(stack)
                _, path, box, _ = stack[-1] if stack else _OUTSIDE
            if close:
                continue
            boxes += 1
            label = _CLASS.search(attrs)
            name = f"{tag}.{_DIGITS.sub('0', label.group(1).strip().lower())}" if label else tag
            above, in_link = (stack[-1][1], stack[-1][3]) if stack else ("", False)
            stack.append((tag, _below(above, name, len(stack)), boxes, in_link or tag == "a"))
            hidden += tag in _HIDDEN
            if len(stack) > depth and tag in _PART:
                leaf = tag
        if visible := squeeze(html.unescape("".join(text))):
            found.append(Line(no, box, path, visible, linked > 0.8 * sum(len(x) for x in text if not x.isspace()), leaf))
    return found, squeeze(html.unescape(title.group(1))) if title else ""


def text_lines(source: str) -> list[Line]:
    """Lines of a plain text, in one container."""
    return [Line(no, 0, "", visible, False, "") for no, raw in enumerate(source.split("\n")) if (visible := squeeze(raw))]


def running_words(line: Line) -> int:
    """Words of a line that reads like part of a text."""
    n = len(line.text.split())
    return n if not line.linked and line.leaf not in _PART and (n >= 20 or (n >= 6 and _SENTENCE.search(line.text))) else 0


def box_scores(lines: list[Line], title: str) -> dict[int, float]:
    """Each container's running words, less its links, more for the headline and by what its own name says."""
    scores: dict[int, float] = {}
    first: dict[int, Line] = {}
    for line in lines:
        first.setdefault(line.box, line)
        scores[line.box] = scores.get(line.box, 0.0) + running_words(line) - (3 if line.linked else 0) + (60 if title and line.text.casefold() == title.casefold() else 0)
    for box, line in first.items():
        own = line.path.rsplit("/", 1)[-1]
        if scores[box] > 0:
            scores[box] *= 0.25 if _FURNITURE.search(own) else 1.5 if _ARTICLE.search(own.removeprefix("body")) else 1.0
    return scores


def best_box(lines: list[Line], title: str) -> Line | None:
    """A line of the page's best container, if one is large enough."""
    scores = box_scores(lines, title)
    top = max(scores, key=lambda b: (scores[b], -b), default=None)
    return next(line for line in lines if line.box == top) if top is not None and scores[top] >= MIN_WORDS else None


@lru_cache(maxsize=200_000)
def _hash(key: str) -> int:
    return crc32(key.encode()) % FEATURES


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hashed features, where each line's begin): words, pairs, the start, the shape and the whole of each line."""
    hashes: list[int] = []
    n_words, n_extra = [], []
    for raw in texts:
        text = _DIGITS.sub("0", raw.lower())
        words = text.split()
        n = len(words)
        shape = f"#{n if n < 6 else 10 if n < 12 else 20 if n < 24 else 40}{_SENTENCE.search(raw) is not None}"
        extra = [f"^{' '.join(words[:2])}", shape, f"{shape}{text.count('|') + text.count('·') + text.count('>') + text.count('/') > 1}"]
        if n <= 40:
            extra.append(_key(text))
        hashes += map(_hash, words)
        hashes += map(_hash, extra)
        n_words.append(n)
        n_extra.append(len(extra))
    flat, words = np.array(hashes, dtype=np.int64), np.array(n_words, dtype=np.int64)
    own = words + np.array(n_extra, dtype=np.int64)
    paired = np.maximum(words - 1, 0)
    starts = np.concatenate(([0], np.cumsum(own + paired)[:-1])) if len(own) else np.zeros(0, np.int64)
    before = np.concatenate(([0], np.cumsum(own)[:-1])) if len(own) else starts
    out = np.empty(int((own + paired).sum()), dtype=np.int64)
    inside = np.arange(len(flat)) - np.repeat(before, own)
    out[np.repeat(starts, own) + inside] = flat
    first = np.flatnonzero(inside < np.repeat(paired, own))  # a word that another one follows
    pairs = (flat[first] * 1_000_003 + flat[first + 1] * 7919 + 1) % FEATURES
    out[np.repeat(starts + own, paired) + inside[first]] = pairs
    return out, starts


def _key(text: str) -> str:
    """A line as a whole: its letters and digits only."""
    return f"={''.join(filter(str.isalnum, text))}"


def key_feature(text: str) -> int:
    """The hashed feature of a short line as a whole."""
    return _hash(_key(_DIGITS.sub("0", text.lower())))


class LineModel:
    """Log-odds of content against furniture for each hashed feature, and how many lines each short line announces."""

    def __init__(self, counts: np.ndarray):
        """counts: rows content, furniture, announcing lines, lines announced."""
        content, furniture, leads, led = counts
        total_c, total_f = max(content.sum(), 1.0), max(furniture.sum(), 1.0)
        rate = np.log((content + 0.3) / (total_c + 0.3 * FEATURES)) - np.log((furniture + 0.3) / (total_f + 0.3 * FEATURES))
        self.weights = np.where(content + furniture > 0, rate, 0.0).astype(np.float32)
        often = (leads >= 3) & (led >= 1.5 * leads) & (furniture > 3 * content)
        self.leads = np.where(often, np.ceil(led / np.maximum(leads, 1)) + 1, 0).astype(np.int16)
        self._seen: dict[str, float] = {}
        self._leads: dict[str, int] = {}

    def line_scores(self, texts: list[str]) -> np.ndarray:
        """Each line's score on its own."""
        seen = self._seen
        if new := [t for t in dict.fromkeys(texts) if t not in seen]:
            hashed, starts = features(new)
            sums = np.add.reduceat(self.weights[hashed], starts)
            sizes = np.diff(np.append(starts, len(hashed)))
            found = dict(zip(new, np.clip(sums / np.sqrt(sizes), -9.0, 9.0).tolist(), strict=True))
            if len(seen) > 200_000:
                seen.clear()
                return self.line_scores(texts)
            seen.update((t, x) for t, x in found.items() if len(t) < 200)  # furniture comes back, paragraphs do not
            return np.array([found[t] if t in found else seen[t] for t in texts])
        return np.array([seen[t] for t in texts])

    def lead(self, text: str) -> int:
        if (found := self._leads.get(text)) is None:
            if len(self._leads) > 200_000:
                self._leads.clear()
            found = self._leads[text] = int(self.leads[key_feature(text)])
        return found

    def scores(self, page: Page, known: np.ndarray | None = None) -> np.ndarray:
        """Each line's score; single sentences that follow an announcing line are held for announced. Lines that are
        known (1 content, -1 furniture, 0 not known) are not scored but take part in announcing."""
        if known is None:
            found = self.line_scores(page.text)
        else:
            found = known * 4.0
            open_at = np.flatnonzero(known == 0)
            found[open_at] = self.line_scores([page.text[i] for i in open_at])
        left = 0
        for i, text in enumerate(page.text):
            if i and (page.box[i] != page.box[i - 1] or page.no[i] > page.no[i - 1] + 1):
                left = 0
            lead = self.lead(text) if len(text) <= SHORT_LINE and found[i] < 0 else 0
            if lead:
                left = lead
            elif left and len(_STOPS.findall(text)) <= 1:
                found[i] = min(found[i], -2.5)
                left -= 1
            else:
                left = 0
        return found if known is None else np.where(known != 0, known * 4.0, found)


@dataclass
class Page:
    """The lines of a page or a text as they are kept: line numbers, containers, what their host's votes say of their path
    (1 main, -1 none, 0 open), whether they are linked, part of an element for furniture, running text (words of it)."""

    title: str
    no: np.ndarray
    box: np.ndarray
    path: np.ndarray
    prior: np.ndarray
    loose: np.ndarray
    running: np.ndarray
    text: list[str]
    score: dict[int, float]


def text_page(source: str, title: str) -> Page:
    """The lines of a plain text, in one container."""
    lines = text_lines(source)
    zeros = np.zeros(len(lines), dtype=np.int64)
    return Page(title, np.array([x.no for x in lines]), zeros, zeros, zeros, zeros.astype(bool), np.array([running_words(x) for x in lines]), [x.text for x in lines], {})


def _count_features(pages: list[tuple[Page, np.ndarray]], model: LineModel | None = None) -> np.ndarray:
    """The model's counts. With an earlier model, short content lines that it holds for furniture count as such."""
    counts = np.zeros((4, FEATURES))
    for page, labels in pages:
        good = labels.copy()
        if model is not None and good.any():
            short = np.array([4 <= len(t.split()) < 24 for t in page.text])
            good &= ~(short & (model.line_scores(page.text) < RELABEL))
        hashed, starts = features(page.text)
        owner = np.repeat(np.arange(len(page.text)), np.diff(np.append(starts, len(hashed))))
        once = np.unique(owner * FEATURES + hashed)
        owner, hashed = once // FEATURES, once % FEATURES
        np.add.at(counts[0], hashed[good[owner]], 1)
        np.add.at(counts[1], hashed[~good[owner]], 1)
        followers = 0
        for i in range(len(page.text) - 1, -1, -1):
            if good[i] or (i + 1 < len(page.text) and page.box[i + 1] != page.box[i]):
                followers = 0
            if not good[i] and len(page.text[i]) <= SHORT_LINE:
                if followers:
                    counts[2:, key_feature(page.text[i])] += 1, followers
                followers = 0
            elif not good[i]:
                followers += 1
    return counts


def sample_labels(page: Page) -> np.ndarray | None:
    """Labels of a page's lines by its host's main path; None where paths do not tell containers apart."""
    main = set(page.box[page.prior > 0].tolist())
    if len(main) != 1:
        return None
    if page.score.get(next(iter(main)), 0.0) < MIN_WORDS:
        return np.zeros(len(page.text), bool)
    return (page.prior > 0) & ~page.loose


def judge(page: Page, model: LineModel, known: np.ndarray | None = None) -> np.ndarray:
    """For each line whether it belongs to the main content. known: for a plain text, what its lines were in its page
    (1 content, -1 furniture, 0 not there); None for a page."""
    if not page.text:
        return np.zeros(0, bool)
    scores = model.scores(page, known)
    title = page.title.casefold()
    head = np.array([bool(title) and text.casefold() == title for text in page.text])
    if known is not None:
        good = scores > DROP
        if not head.any() and page.running[good].sum() < MIN_WORDS:
            return np.zeros(len(good), bool)
    else:
        boxes: dict[int, list[int]] = {}
        for i, box in enumerate(page.box.tolist()):
            boxes.setdefault(box, []).append(i)
        good = np.zeros(len(page.text), bool)
        alike = Counter(int(page.path[at[0]]) for at in boxes.values())
        root = 1 + np.sqrt([len(text.split()) for text in page.text])
        for at in boxes.values():
            prior = 4.0 * page.prior[at[0]] if alike[int(page.path[at[0]])] == 1 else 0.0
            mean = float((np.clip(scores[at], -4, 4) * root[at]).sum() / root[at].sum())
            has_head = head[at].any()
            big = has_head or page.running[at].sum() >= MIN_WORDS
            if mean + prior + (3.0 if has_head else 0.0) > 0 and (big or mean > 1.0):
                good[at] = ~page.loose[at] & (scores[at] > DROP)
    return good | (head & (np.cumsum(head) == 1))


def host_of(url: Column, source: Column) -> Column:
    return F.coalesce(F.nullif(F.lower(F.regexp_extract(url, r"^[A-Za-z][\w+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit("")), source, F.lit(""))


_PARSED = "row_id string, host string, title string, paths array<string>, best int, no array<int>, box array<int>, path array<int>, loose array<boolean>, running array<int>, score array<double>, text array<string>"


def parsed_pages(pages: DataFrame) -> DataFrame:
    """pages: row_id, host, page. Each page's lines with visible text as parallel arrays, its paths, and which of them
    holds its best container (-1: none); staged, so that no page is parsed twice."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row_id, host, page in zip(batch["row_id"], batch["host"], batch["page"], strict=True):
                lines, title = page_lines(page)
                paths = {path: i for i, path in enumerate(dict.fromkeys(line.path for line in lines))}
                best, scores = best_box(lines, title), box_scores(lines, title)
                loose = [line.linked or line.leaf in _PART for line in lines]
                out.append((
                    row_id, host, title, list(paths), paths[best.path] if best else -1, [x.no for x in lines], [x.box for x in lines], [paths[x.path] for x in lines],
                    loose, [running_words(x) for x in lines], [scores[x.box] for x in lines], [x.text for x in lines],
                ))
            yield pd.DataFrame(out, columns=_PARSED.replace(",", " ").split()[::2])

    return stage(pages.filter("page is not null").mapInPandas(read, _PARSED), "parsed-pages")


def count_votes(parsed: DataFrame) -> DataFrame:
    """(host, path, won, seen): pages with the path, and those among them whose best container has it; staged."""
    each = parsed.select("host", "best", F.posexplode("paths").alias("i", "path"))
    return stage(each.groupBy("host", "path").agg(F.sum((F.col("i") == F.col("best")).cast("int")).alias("won"), F.count("*").alias("seen")), "path-votes")


def with_priors(parsed: DataFrame, votes: DataFrame) -> DataFrame:
    """Adds prior: for each of a page's paths 1 if it is a main path of its host, -1 if it is none, 0 if that is open."""
    share = (F.col("won") + 1) / (F.col("seen") + 2)
    sign = F.when(share >= WIN_RATIO, 1).when(share <= LOSE_RATIO, -1)
    decided = votes.select("host", "path", sign.alias("sign")).filter("sign is not null")
    # grows with a host's established layouts, not with its pages: one page decides nothing
    signs = decided.groupBy("host").agg(F.map_from_entries(F.collect_list(F.struct("path", "sign"))).alias("signs"))
    prior = F.transform("paths", lambda p: F.coalesce(F.try_element_at("signs", p), F.lit(0)))
    return parsed.join(signs, "host", "left").withColumn("prior", F.when(F.col("signs").isNull(), F.transform("paths", lambda _: F.lit(0))).otherwise(prior)).drop("paths", "signs", "host", "best")


def _pages_of(batch: pd.DataFrame) -> Iterator[Page]:
    for r in batch.itertuples(index=False):
        path = np.asarray(r.path, dtype=np.int64)
        prior = np.asarray(r.prior, dtype=np.int64)[path] if len(path) else path
        yield Page(r.title, np.asarray(r.no), np.asarray(r.box), path, prior, np.asarray(r.loose, dtype=bool), np.asarray(r.running), list(r.text), dict(zip(r.box, r.score, strict=True)))


def fit_model(pages: DataFrame) -> LineModel:
    """The line model, counted twice, from all pages with decided paths or about MODEL_PAGES of them drawn by a hash."""
    usable = pages.filter(F.exists("prior", lambda p: p != 0))
    share = min(1.0, MODEL_PAGES / max(1, usable.count()))
    drawn = usable.filter(F.pmod(F.xxhash64("row_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    drawn = stage(drawn, "model-pages")
    model = None
    for _ in range(2):
        earlier = pages.sparkSession.sparkContext.broadcast(model)

        def count(batches: Iterator[pd.DataFrame], earlier=earlier) -> Iterator[pd.DataFrame]:
            for batch in batches:
                labelled = [(page, labels) for page in _pages_of(batch) if page.text and (labels := sample_labels(page)) is not None]
                counts = _count_features(labelled, earlier.value)
                at = np.flatnonzero(counts.sum(axis=0))
                yield pd.DataFrame({"f": at.astype("int32")} | {f"c{k}": counts[k, at] for k in range(4)})

        each = drawn.mapInPandas(count, "f int, c0 double, c1 double, c2 double, c3 double")
        rows = each.groupBy("f").agg(*[F.sum(f"c{k}").alias(f"c{k}") for k in range(4)]).toPandas()  # FEATURES rows at most
        counts = np.zeros((4, FEATURES))
        for k in range(4):
            counts[k, rows["f"]] = rows[f"c{k}"]
        model = LineModel(counts)
    return model


def line_hash(text: str) -> int:
    """A 64-bit identifier of a line's visible text."""
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


_JUDGED = "row_id string, no array<int>, good array<boolean>, hashes array<bigint>"


def content_lines(pages: DataFrame, texts: DataFrame) -> DataFrame:
    """(tbl, row_id, line_no, furniture) of every line with visible text.

    pages: row_id, host, page (HTML). texts: row_id, title, page (plain text), page_id (the page it was taken from).
    """
    parsed = parsed_pages(pages)
    voted = with_priors(parsed, count_votes(parsed))
    model = pages.sparkSession.sparkContext.broadcast(fit_model(voted))  # FEATURES floats

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [(page.no, judge(page, model.value), [line_hash(t) for t in page.text]) for page in _pages_of(batch)]
            yield pd.DataFrame({"row_id": batch["row_id"], "no": [a for a, _, _ in found], "good": [b for _, b, _ in found], "hashes": [c for _, _, c in found]})

    judged = stage(voted.mapInPandas(extract, _JUDGED), "judged-pages")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row_id, title, text, good, hashes in zip(batch["row_id"], batch["title"], batch["page"], batch["good"], batch["hashes"], strict=True):
                page = text_page(text, squeeze(title or ""))
                known = np.zeros(len(page.text), dtype=np.int64)
                if hashes is not None:
                    there: dict[int, int] = {}
                    for h, ok in zip(hashes, good, strict=True):
                        there[h] = max(there.get(h, -1), 1 if ok else -1)
                    known = np.array([there.get(line_hash(t), 0) for t in page.text], dtype=np.int64)
                out.append((row_id, page.no, judge(page, model.value, known)))
            yield pd.DataFrame(out, columns=["row_id", "no", "good"])

    texts = texts.filter("page is not null")
    seen = judged.select(F.col("row_id").alias("page_id"), "good", "hashes").filter("page_id is not null").dropDuplicates(["page_id"])
    taken = texts.filter("page_id is not null").join(seen, "page_id", "left").drop("page_id")  # texts without a page need no shuffle
    none = [F.lit(None).cast("array<boolean>").alias("good"), F.lit(None).cast("array<bigint>").alias("hashes")]
    rows = taken.unionByName(texts.filter("page_id is null").drop("page_id").select("*", *none))
    plain = rows.mapInPandas(read, "row_id string, no array<int>, good array<boolean>")
    every = judged.select(F.lit("raw_documents").alias("tbl"), "row_id", "no", "good").unionByName(plain.select(F.lit("news").alias("tbl"), "row_id", "no", "good"))
    lines = every.select("tbl", "row_id", F.explode(F.arrays_zip("no", "good")).alias("x"))
    return lines.select("tbl", "row_id", F.col("x.no").alias("line_no"), (~F.col("x.good")).alias("furniture"))


def pages_of(raw: DataFrame) -> DataFrame:
    return spread(raw.select(F.col("id").alias("row_id"), host_of(F.col("source_url"), F.col("source_name")).alias("host"), F.col("raw_content_location").alias("page")))


def texts_of(news: DataFrame) -> DataFrame:
    page_id = F.col("raw_document_id") if "raw_document_id" in news.columns else F.lit(None).cast("string")
    return spread(news.select(F.col("id").alias("row_id"), "title", F.col("full_text_location").alias("page"), page_id.alias("page_id")))


def furniture_lines(news: DataFrame, raw: DataFrame) -> DataFrame:
    """(tbl, row_id, line_no) of each furniture line."""
    return content_lines(pages_of(raw), texts_of(news)).filter("furniture").select("tbl", "row_id", "line_no")


def main_text_sizes(news: DataFrame, raw: DataFrame) -> DataFrame:
    """(tbl, row_id, n_lines, n_content): lines with visible text of each row, and how many the article keeps."""
    lines = content_lines(pages_of(raw), texts_of(news))
    return lines.groupBy("tbl", "row_id").agg(F.count("*").alias("n_lines"), F.count_if(~F.col("furniture")).alias("n_content"))


def host_paths(raw: DataFrame) -> DataFrame:
    """(host, path, share) of each path of each host, with the share of the pages with it on which it won."""
    pages = pages_of(raw.select(F.lit("").alias("id"), "source_url", "source_name", "raw_content_location"))
    return count_votes(parsed_pages(pages)).select("host", "path", (F.col("won") / F.col("seen")).alias("share"))
