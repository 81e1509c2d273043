"""Payloads of each wire format to typed records, one row per item. Input: source_name, url, text and ord.

A body without its container is an error, not an empty page: such rows go to ``broken``.
Items without their required fields are left out; positions keep the first of repeats apart.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.functions import text as tx
from gristmill.functions import urls
from gristmill.functions.html import job_posting_of, main_text_of, publication_candidates_of
from gristmill.functions.dates import strict_timestamp
from gristmill.operators.dedup import first_wins

def _null() -> Column:
    return F.lit(None).cast("string")


_ENTRY = "array<struct<id string, title string, link string, published string, description string, about string, authors array<string>>>"


def _entries(source: str | None) -> list[dict] | None:
    """Items of an RSS or Atom document in any namespace; None for one that does not parse."""
    try:
        root = ElementTree.fromstring((source or "").strip())
    except ElementTree.ParseError:
        return None
    local = lambda e: e.tag.rpartition("}")[2] if isinstance(e.tag, str) else ""
    found = []
    for item in root.iter():
        if local(item) not in ("item", "entry"):
            continue
        first: dict[str, str] = {}
        for child in item:
            text = "".join(child.itertext()).strip()
            if local(child) == "link":
                text = text or child.get("href", "")
            if text:
                first.setdefault(local(child), text)
        names = ["".join(n.itertext()) for a in item if local(a) == "author" for n in a if local(n) == "name"]
        found.append(
            {
                "id": first.get("id"),
                "title": first.get("title"),
                "link": first.get("link"),
                "published": first.get("pubDate") or first.get("published"),
                "description": first.get("description") or first.get("summary"),
                "about": " ".join(filter(None, (first.get("summary"), first.get("comment")))),
                "authors": names,
            }
        )
    return found


def xml_entries(text: Column) -> Column:
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([_entries(t) for t in batch], dtype=object)

    return F.pandas_udf(run, _ENTRY)(text)


def _list(path: str) -> Column:
    return F.expr(f"try_variant_get(doc, '{path}', 'array<variant>')")


def _get(path: str, kind: str = "string", of: str = "item") -> Column:
    return F.expr(f"try_variant_get({of}, '{path}', '{kind}')")


def json_items(pages: DataFrame, container: str) -> DataFrame:
    """(source_name, url, ord, pos, item): objects of a container, ``$`` for a bare list."""
    docs = pages.select("source_name", "url", "ord", F.try_parse_json("text").alias("doc"))
    items = docs.select("source_name", "url", "ord", F.posexplode(_list(container)).alias("pos", "item"))
    return items.filter(F.expr("schema_of_variant(item) like 'OBJECT<%'"))


def broken(pages: DataFrame, container: str) -> DataFrame:
    """(source_name, url, error_category, message) of bodies without the container."""
    docs = pages.withColumn("doc", F.try_parse_json("text")).withColumn("found", _list(container))
    message = F.when(F.col("doc").isNull(), "body is not JSON").otherwise(F.coalesce(F.expr("try_variant_get(doc, '$.message', 'string')"), F.lit(f"no list at {container}")))
    return docs.filter("found is null").select("source_name", "url", F.lit("ParsingError").alias("error_category"), message.alias("message"))


def arxiv_papers(pages: DataFrame) -> DataFrame:
    """Atom entries as papers; a repository counts only if the summary or comment names one."""
    at = pages.select("source_name", "ord", F.posexplode(xml_entries(F.col("text"))).alias("pos", "e"))
    rows = at.select(
        "source_name",
        "ord",
        "pos",
        tx.squash_spaces(F.col("e.title")).alias("title"),
        F.filter(F.transform("e.authors", tx.squash_spaces), lambda a: a != "").alias("authors"),
        F.trim("e.id").alias("paper_url"),
        urls.arxiv_id(F.col("e.id")).alias("paper_external_id"),
        urls.github_url_in(F.col("e.about")).alias("github_url"),
        F.lit(None).cast("int").alias("github_stars"),
        strict_timestamp(F.col("e.published")).alias("published_date"),
    )
    return rows.filter(tx.non_blank(F.col("title")) & tx.non_blank(F.col("paper_url")))


def author_names(authorships: Column) -> Column:
    """Names of an authorships array in order, white space collapsed, blanks left out."""
    names = F.transform(authorships, lambda a: tx.squash_spaces(a["author"]["display_name"]))
    return F.filter(names, lambda n: n.isNotNull() & (n != ""))


_WORK = (
    "id string, doi string, title string, display_name string, publication_date string, "
    "authorships array<struct<author struct<id string, display_name string, orcid string>>>, primary_location struct<landing_page_url string>"
)


def work_bodies(pages: DataFrame) -> DataFrame:
    """Typed works of captured bodies, for ``openalex_papers``; elements that are no objects are left out. Bodies without a list
    are ``broken(pages, "$.results")``."""
    items = json_items(pages, "$.results")
    return items.select("source_name", "url", "ord", "pos", F.from_json(F.expr("to_json(item)"), _WORK).alias("w")).select("source_name", "url", "ord", "pos", "w.*")


def status_errors(pages: DataFrame) -> DataFrame:
    """(source_name, url, error_category, message) of pages whose status_code is not 200; a missing one counts as such."""
    message = F.concat(F.lit("HTTP "), F.coalesce(F.col("status_code").cast("string"), F.lit("none")), F.lit(" from "), F.col("url"))
    return pages.filter(~F.col("status_code").eqNullSafe(F.lit(200))).select("source_name", "url", F.lit("ParsingError").alias("error_category"), message.alias("message"))


def batch_of(hit: str) -> Column:
    return F.expr(f"case when schema_of_variant(try_variant_get({hit}, '$.batch', 'variant')) = 'STRING' then try_variant_get({hit}, '$.batch', 'string') end")


def tagged_in(hits: DataFrame, tags: list[str], in_batch: Callable[[Column], Column]) -> DataFrame:
    """Hits with any of the tags and a batch that meets a condition; hits without a list of tags or a batch have none."""
    theirs = F.expr("try_variant_get(hit, '$.tags', 'array<string>')")
    return hits.filter(F.coalesce(F.arrays_overlap(theirs, F.array(*[F.lit(t) for t in tags])), F.lit(False)) & F.coalesce(in_batch(batch_of("hit")), F.lit(False)))


def openalex_papers(works: DataFrame) -> DataFrame:
    """works: typed rows as delivered, other columns are kept. The address is the DOI, else the landing page, else the identifier."""
    url = urls.first_http(F.col("doi"), F.col("primary_location.landing_page_url"), F.col("id"))
    own = {"id", "doi", "title", "display_name", "authorships", "primary_location", "publication_date"}
    rows = works.select(
        *[c for c in works.columns if c not in own],
        tx.squash_spaces(F.coalesce(tx.blank_to_null(F.col("title")), F.col("display_name"))).alias("title"),
        author_names(F.col("authorships")).alias("authors"),
        url.alias("paper_url"),
        urls.work_id(F.col("id")).alias("paper_external_id"),
        _null().alias("github_url"),
        F.lit(None).cast("int").alias("github_stars"),
        "publication_date",
    )
    return rows.filter(tx.non_blank(F.col("title")) & F.col("paper_url").isNotNull())


def listed_papers(pages: DataFrame) -> DataFrame:
    """Papers of a results list whose repository is an object or a plain address."""
    items = json_items(pages, "$.results")
    repo = F.coalesce(_get("$.repository.url"), F.when(F.expr("schema_of_variant(try_variant_get(item, '$.repository', 'variant'))") == "STRING", _get("$.repository")))
    rows = items.select(
        "source_name",
        "ord",
        "pos",
        tx.squash_spaces(_get("$.title")).alias("title"),
        F.transform(F.expr("try_variant_get(item, '$.authors', 'array<string>')"), tx.squash_spaces).alias("authors"),
        F.trim(_get("$.url_abs")).alias("paper_url"),
        repo.alias("github_url"),
        _get("$.published").alias("published"),
    )
    return rows.filter(tx.non_blank(F.col("title")) & tx.non_blank(F.col("paper_url")))


def listing_stories(pages: DataFrame, since: int | None = None, until: int | None = None) -> DataFrame:
    """Listing hits about the subject with an address; ``since``/``until`` bound created_at_i in whole seconds."""
    items = json_items(pages, "$.hits")
    rows = items.select("source_name", "ord", "pos", _get("$.objectID").alias("object_id"), _get("$.title").alias("title"), _get("$.url").alias("story_url"), _get("$.created_at_i", "bigint").alias("created_s"))
    if since is not None:
        rows = rows.filter(F.col("created_s").between(since, until))
    return rows.filter(tx.ai_title(F.col("title")) & urls.is_http_url(F.col("story_url")))


def feed_items(pages: DataFrame) -> DataFrame:
    """RSS items and Atom entries: link, title, published, description. An update time is no publication."""
    at = pages.select("source_name", "ord", F.posexplode(xml_entries(F.col("text"))).alias("pos", "e"))
    rows = at.select("source_name", "ord", "pos", F.trim("e.link").alias("link"), tx.squash_spaces(F.col("e.title")).alias("title"), F.col("e.published").alias("published"), F.col("e.description").alias("description"))
    return rows.filter(tx.non_blank(F.col("title")) & urls.is_http_url(F.col("link")))


def broken_feeds(pages: DataFrame) -> DataFrame:
    """(source_name, url, error_category, message) of feeds that do not parse."""
    bad = pages.filter(xml_entries(F.col("text")).isNull())
    return bad.select("source_name", "url", F.lit("ParsingError").alias("error_category"), F.lit("invalid feed").alias("message"))


def article_records(articles: DataFrame) -> DataFrame:
    """articles: source_name, link, title, feed_date, page. News records with their text and dated evidence."""
    rows = articles.withColumn("body", main_text_of(F.col("page"))).withColumn("found", publication_candidates_of(F.col("page")))
    options = F.concat(F.array(F.struct(F.lit("rss_pubDate").alias("field"), F.col("feed_date").alias("value"))), F.col("found"))
    dated = F.get(F.filter(options, lambda o: strict_timestamp(o["value"]).isNotNull()), F.lit(0))
    return rows.withColumn("dated", dated).select(
        "title",
        F.col("link").alias("url"),
        "source_name",
        strict_timestamp(F.col("dated.value")).alias("published_at"),
        F.col("body.text").alias("full_text_location"),
        F.col("body.text").isNull().alias("extraction_failed"),
        F.struct(F.col("feed_date").alias("rss_pubDate"), F.col("dated.field").alias("selected"), F.col("dated.value").alias("value")).alias("publication_date_candidates"),
    )


def _jobs(items: DataFrame, title: Column, company: Column, url: Column, posted: Column) -> DataFrame:
    rows = items.select("source_name", "ord", "pos", F.trim(title).alias("title"), F.trim(company).alias("company"), F.trim(url).alias("url"), posted.alias("posted_at"), F.lit(True).alias("is_remote"), _null().alias("role_family"))
    return rows.filter(tx.non_blank(F.col("title")) & tx.non_blank(F.col("company")) & tx.non_blank(F.col("url")))


def tagged_jobs(pages: DataFrame) -> DataFrame:
    """A bare list of jobs; an element with a ``legal`` key is a notice, no job."""
    items = json_items(pages, "$").filter(~F.expr("schema_of_variant(item) rlike '[<,] ?legal: '"))
    return _jobs(items, _get("$.position"), _get("$.company"), _get("$.url"), _get("$.date"))


def category_jobs(pages: DataFrame) -> DataFrame:
    return _jobs(json_items(pages, "$"), _get("$.title"), _get("$.company_name"), _get("$.url"), _get("$.pub_date"))


def hiring_comments(pages: DataFrame) -> DataFrame:
    """Comments of a thread: ``Company | Title | ...`` in the first paragraph, and the first link."""
    items = json_items(pages, "$.children").withColumn("html", _get("$.text"))
    fields = items.withColumn("fields", tx.pipe_fields(tx.first_paragraph(F.col("html")))).filter(F.size("fields") >= 2)
    rows = fields.select("source_name", "ord", "pos", F.get("fields", F.lit(0)).alias("company"), F.get("fields", F.lit(1)).alias("title"), tx.first_href(F.col("html")).alias("url"), _get("$.created_at").alias("posted_at"))
    whole = tx.non_blank(F.col("company")) & tx.non_blank(F.col("title")) & (F.col("url") != "") & strict_timestamp(F.col("posted_at")).isNotNull()
    return rows.filter(whole)


def sitemap_urls(pages: DataFrame) -> DataFrame:
    """(source_name, ord, pos, loc): every address of a sitemap, each once, in order; a broken one has none."""
    locs = F.transform(F.regexp_extract_all("text", F.lit(r"<(?:[\w-]+:)?loc>\s*([^<]*?)\s*</(?:[\w-]+:)?loc>"), 1), lambda u: tx.unescape(u))
    whole = pages.filter(F.col("text").rlike(r"(?s)<(?:[\w-]+:)?urlset[\s>].*</(?:[\w-]+:)?urlset>\s*$"))
    rows = whole.select("source_name", "ord", F.posexplode(locs).alias("pos", "loc")).filter("loc <> ''")
    return first_wins(rows, ["source_name", "loc"], ["ord", "pos"])


def posting_pages(pages: DataFrame) -> DataFrame:
    """Jobs of pages with a JobPosting in their structured data; the page's own address stands in for a missing one."""
    rows = pages.withColumn("job", job_posting_of(F.col("text"))).filter("job is not null")
    out = rows.select("source_name", "ord", F.lit(0).alias("pos"), F.col("job.title").alias("title"), F.col("job.company").alias("company"), F.coalesce(F.col("job.url"), F.col("url")).alias("url"), F.col("job.posted_at").alias("posted_at"))
    return out.filter(tx.non_blank(F.col("title")) & tx.non_blank(F.col("company")))


def employee_count(hit: str) -> Column:
    """A team size that is a whole number or digits; flags, negatives and words are unknown."""
    shape = F.expr(f"schema_of_variant(try_variant_get({hit}, '$.team_size', 'variant'))")
    number = F.expr(f"try_variant_get({hit}, '$.team_size', 'int')")
    return F.when((shape == "BIGINT") & (number >= 0), number).when(shape == "STRING", tx.digits_to_int(F.trim(F.expr(f"try_variant_get({hit}, '$.team_size', 'string')"))))


def directory_companies(hits: DataFrame, prefix: str) -> DataFrame:
    """hits: page_id, pos1, hit. (page_id, pos1, entity_name, source_url, employee_count), the first of each address."""
    name = tx.squash_spaces(F.expr("try_variant_get(hit, '$.name', 'string')"))
    rows = hits.select("page_id", "pos1", name.alias("entity_name"), urls.template_url(prefix, F.expr("try_variant_get(hit, '$.slug', 'string')")).alias("source_url"), employee_count("hit").alias("employee_count"))
    rows = rows.filter(tx.non_blank(F.col("entity_name")) & F.col("source_url").isNotNull())
    return first_wins(rows, ["page_id", "source_url"], ["pos1"])


def facet_map(pages: DataFrame, facet: str) -> DataFrame:
    """(facet, n) of a facets object; counts that are no positive whole numbers are left out."""
    counts = F.expr(f"try_variant_get(try_parse_json(text), '$.facets.{facet}', 'map<string,variant>')")
    rows = pages.select(F.explode(counts).alias(facet, "v"))
    n = F.expr("case when schema_of_variant(v) = 'BIGINT' then try_variant_get(v, '$', 'bigint') end")
    return rows.select(facet, n.alias("n")).filter("n > 0")


def hub_products(pages: DataFrame, site: str, extra: list[str]) -> DataFrame:
    """Listings of ``owner/name`` repositories; metadata keeps only what is there."""
    items = json_items(pages, "$").withColumn("repo", F.trim(F.coalesce(tx.blank_to_null(_get("$.id")), _get("$.modelId"))))
    vendor = F.coalesce(tx.blank_to_null(_get("$.author")), F.when(F.instr("repo", "/") > 0, F.split_part("repo", F.lit("/"), F.lit(1))))
    metadata = F.map_filter(F.map_from_arrays(F.array(*[F.lit(k) for k in extra]), F.array(*[_get(f"$.{k}") for k in extra])), lambda _, v: v.isNotNull())
    rows = items.select(
        "source_name", "ord", "pos", tx.repo_title(_get("$.cardData.title"), F.col("repo")).alias("product_name"), F.trim(vendor).alias("startup_name"),
        F.concat(F.lit(site), F.col("repo")).alias("source_url"), F.col("repo").alias("source_external_id"), F.lower("repo").alias("dedup_key"), metadata.alias("metadata_json"),
    )
    rows = rows.filter(tx.non_blank(F.col("source_external_id")) & tx.non_blank(F.col("startup_name")))
    return first_wins(rows, ["ord", "source_url"], ["pos"])


def router_products(pages: DataFrame, site: str) -> DataFrame:
    """Models of a data list; the vendor stands before the colon of the name, or before the slash of the id."""
    items = json_items(pages, "$.data")
    fields = {"modality": "$.architecture.modality", "context_length": "$.context_length", "created": "$.created"}
    metadata = F.map_filter(F.map_from_arrays(F.array(*[F.lit(k) for k in fields]), F.array(*[_get(p) for p in fields.values()])), lambda _, v: v.isNotNull())
    rows = items.select(
        "source_name", "ord", "pos", F.trim(_get("$.name")).alias("product_name"), tx.vendor_of(_get("$.name"), _get("$.id")).alias("startup_name"),
        F.concat(F.lit(site), _get("$.id")).alias("source_url"), _get("$.id").alias("source_external_id"), F.lower(tx.blank_to_null(_get("$.hugging_face_id"))).alias("dedup_key"), metadata.alias("metadata_json"),
    )
    rows = rows.filter(tx.non_blank(F.col("source_external_id")) & tx.non_blank(F.col("product_name")) & F.col("startup_name").isNotNull())
    return first_wins(rows, ["ord", "source_url"], ["pos"])
