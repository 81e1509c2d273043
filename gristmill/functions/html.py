"""What single HTML pages say about themselves: structured data, dates, titles, text. Arrow-batched UDFs."""

from __future__ import annotations

import html as entities
import json
import re
from collections.abc import Iterator
from functools import partial
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Meta tags that hold a publication date, in order of preference.
META_DATES = [
    ("property", "article:published_time"),
    ("property", "og:updated_time"),
    ("name", "date"),
    ("name", "dc.date"),
    ("name", "dc.date.issued"),
    ("name", "sailthru.date"),
    ("name", "parsely-pub-date"),
]
# Fields that state when a page was published: label, where it stands, its key there.
PUBLICATION_FIELDS = [
    ("json_ld.datePublished", "article", "datePublished"),
    ("article:published_time", "property", "article:published_time"),
    ("parsely-pub-date", "name", "parsely-pub-date"),
    ("datePublished", "itemprop", "datePublished"),
]
# Keys of structured data that hold a date, in order of preference.
JSON_LD_DATES = ["datePublished", "dateCreated"]
# Types of articles in structured data.
ARTICLE_TYPES = {"Article", "NewsArticle", "BlogPosting", "ReportageNewsArticle"}
#: Characters below which a page has no article.
MIN_TEXT = 100

_SKIPPED = {"script", "style", "noscript", "template", "nav", "header", "footer", "aside", "form", "head", "button", "svg"}
_BLOCKS = {"p", "div", "section", "article", "li", "h1", "h2", "h3", "h4", "h5", "h6", "tr", "blockquote", "pre", "br", "main"}


class _Page(HTMLParser):
    """One pass over a page: meta tags, times, JSON-LD scripts, title and text outside of page furniture."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.meta: list[dict[str, str]] = []
        self.times: list[tuple[str | None, str]] = []
        self.scripts: list[str] = []
        self.dated: list[str | None] = []
        self.title, self.text = "", []
        self._skip, self._open, self._script, self._in_title = 0, None, None, False

    def handle_starttag(self, tag, attrs):
        named = {k: v or "" for k, v in attrs}
        if tag == "meta":
            self.meta.append(named)
        elif tag == "time":
            self._open = [named.get("datetime"), ""]
        elif tag == "script":
            self._script = [] if named.get("type", "").strip().lower() == "application/ld+json" else None
        elif tag == "title" and not self.title:
            self._in_title = True
        if named.get("itemprop") == "datePublished":
            self.dated.append(named.get("content") or named.get("datetime"))
        if tag in _SKIPPED:
            self._skip += 1
        if tag in _BLOCKS:
            self.text.append("\n")

    def handle_endtag(self, tag):
        if tag == "time" and self._open:
            self.times.append((self._open[0], self._open[1]))
            self._open = None
        elif tag == "script" and self._script is not None:
            self.scripts.append("".join(self._script))
            self._script = None
        elif tag == "title":
            self._in_title = False
        if tag in _SKIPPED and self._skip:
            self._skip -= 1
        if tag in _BLOCKS:
            self.text.append("\n")

    def handle_data(self, data):
        if self._open:
            self._open[1] += data
        if self._script is not None:
            self._script.append(data)
        if self._in_title:
            self.title += data
        if not self._skip:
            self.text.append(data)


def read_page(source: str) -> _Page:
    page = _Page()
    try:
        page.feed(source)
        page.close()
    except Exception:  # noqa: BLE001  a broken page gives what was read before the break
        pass
    return page


def json_objects(scripts: list[str], graphs: bool = True) -> Iterator[dict]:
    """Objects of JSON-LD scripts, lists and (if wanted) ``@graph`` members included; broken scripts are skipped."""
    for text in scripts:
        try:
            data = json.loads(text)
        except ValueError:
            continue
        queue = list(data) if isinstance(data, list) else [data]
        while queue:
            node = queue.pop(0)
            if isinstance(node, dict):
                yield node
                if graphs and isinstance(node.get("@graph"), list):
                    queue += node["@graph"]


def job_posting(source: str | None) -> dict | None:
    """The first JobPosting of a page's structured data."""
    for node in json_objects(read_page(source).scripts) if source else ():
        if node.get("@type") == "JobPosting":
            firm = node.get("hiringOrganization")
            text = lambda v: v if isinstance(v, str) else None
            return {"title": text(node.get("title")), "company": text(firm.get("name")) if isinstance(firm, dict) else None, "posted_at": text(node.get("datePosted")), "url": text(node.get("url"))}
    return None


def _is_article(node: dict) -> bool:
    kind = node.get("@type")
    return bool(ARTICLE_TYPES.intersection([kind] if isinstance(kind, str) else (k for k in kind if isinstance(k, str)) if isinstance(kind, list) else ()))


def _stated(page: _Page, where: str, key: str) -> list:
    """What a page states under a key: in an article's structured data, a meta tag's content or a microdata property."""
    if where == "article":
        return [node.get(key) for node in json_objects(page.scripts) if _is_article(node)]
    if where == "itemprop":
        return page.dated
    return [tag.get("content") for tag in page.meta if tag.get(where) == key]


def page_dates(source: str | None) -> dict:
    """Raw date strings of a page: JSON-LD (top level), first known meta tag, first time tag."""
    page = read_page(source or "")
    in_data = [str(node[key]) for node in json_objects(page.scripts, graphs=False) for key in JSON_LD_DATES if node.get(key)]
    in_meta = [value for where, key in META_DATES for value in _stated(page, where, key)[:1] if value]
    in_time = [at or shown.strip() for at, shown in page.times[:1]]
    return {name: next(iter(values), None) or None for name, values in (("json_ld", in_data), ("meta", in_meta), ("time_tag", in_time))}


def publication_candidates(source: str | None) -> list[dict]:
    """(field, value) of explicit publication fields in order; never modification or update times."""
    page = read_page(source or "")
    return [{"field": label, "value": value} for label, where, key in PUBLICATION_FIELDS for value in _stated(page, where, key) if isinstance(value, str)]


def main_text(source: str | None, most: int | None = None) -> dict | None:
    """struct(text, truncated) of a page outside navigation; null below MIN_TEXT characters, never an error.

    most: characters after which the text is cut; by default it stays whole.
    """
    if not source:
        return None
    lines = (" ".join(line.split()) for line in "".join(read_page(source).text).split("\n"))
    text = "\n".join(line for line in lines if line)
    if len(text) < MIN_TEXT:
        text = re.sub(r"\s+", " ", entities.unescape(re.sub(r"<[^>]+>", " ", re.sub(r"(?is)<(script|style|head)\b.*?</\1>", " ", source)))).strip()
    return {"text": text[:most], "truncated": most is not None and len(text) > most} if len(text) >= MIN_TEXT else None


def _frame(rows: list[dict | None], fields: list[str]) -> pd.DataFrame:
    return pd.DataFrame([{f: (r or {}).get(f) for f in fields} for r in rows], columns=fields)


def _struct_udf(function, schema: str):
    fields = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield _frame([function(v) for v in batch], fields)

    return F.pandas_udf(run, schema)


def job_posting_of(page: Column) -> Column:
    return _struct_udf(job_posting, "title string, company string, posted_at string, url string")(page)


def page_dates_of(page: Column) -> Column:
    return _struct_udf(page_dates, "json_ld string, meta string, time_tag string")(page)


def main_text_of(page: Column, most: int | None = None) -> Column:
    return _struct_udf(partial(main_text, most=most), "text string, truncated boolean")(page)


def publication_candidates_of(page: Column) -> Column:
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([publication_candidates(v) for v in batch], dtype=object)

    return F.pandas_udf(run, "array<struct<field string, value string>>")(page)
