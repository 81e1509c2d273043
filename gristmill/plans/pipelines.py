"""The five record pipelines as lazy plans: scan, parse, validate, gate, deduplicate, resolve, count."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.functions import dates
from gristmill.functions.text import normalize_entity_name, usable_name
from gristmill.functions.urls import normalize_url
from gristmill.operators import allocate, dedup, metrics, resolve, shapes, validate
from gristmill.session import stage, table
from gristmill.sources import payloads, registry

NEWS_REFERENCE, JOBS_REFERENCE = datetime(2026, 6, 1), datetime(2026, 6, 1)
NEWS_HOURS, JOBS_HOURS, JOBS_SKEW = 24 * 30, 24 * 30, 60
TARGET = 100
PRODUCT_ORDER = ["vendorpages", "launchfolio", "orbit_index"]


def route_news(news: DataFrame, sources: DataFrame, reference: datetime = NEWS_REFERENCE, hours: float = NEWS_HOURS) -> DataFrame:
    """Rows of enabled sources with their status; the first of each (source, url) that passes the gates is inserted."""
    rows = registry.only_enabled(news, sources).withColumn("moment", dates.strict_timestamp(F.col("published_at")))
    rules, moment = validate.news_rules("moment"), F.col("moment")
    passing = validate.passes_gates(rules, moment, reference, hours, 0)
    flagged = dedup.mark_first(rows.withColumn("_late", (~F.coalesce(passing, F.lit(False))).cast("int")), ["source_name", "url"], ["_late", "collected_at", "id"])
    return validate.route(flagged, rules, moment, reference, hours, 0).drop("_late")


def pipeline_news(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = route_news(table(spark, sf_dir, "news"), table(spark, sf_dir, "sources"))
    return routed.select("id", "source_name", "url", F.col("moment").alias("published_at"), "status", "reason")


def pipeline_news_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.run_metrics(route_news(table(spark, sf_dir, "news"), table(spark, sf_dir, "sources")), "source_name")


def route_jobs(jobs: DataFrame, reference: datetime = JOBS_REFERENCE, hours: float = JOBS_HOURS, skew: float = JOBS_SKEW) -> DataFrame:
    posted = dates.full_iso(F.col("posted_at"))
    rows = jobs.withColumn("posted_ts", posted)
    rules, moment = validate.job_rules(), F.col("posted_ts")
    passing = validate.passes_gates(rules, moment, reference, hours, skew)
    flagged = dedup.mark_first(rows.withColumn("_late", (~F.coalesce(passing, F.lit(False))).cast("int")), ["source_name", "url"], ["_late", "collected_at", "id"])
    return validate.route(flagged, rules, moment, reference, hours, skew).drop("_late")


def pipeline_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = route_jobs(table(spark, sf_dir, "jobs"))
    key = normalize_entity_name(F.col("company"))
    linked = F.col("status").isin("inserted", "duplicate") & usable_name(key)
    return routed.select("id", "source_name", "status", F.col("posted_ts").alias("posted_at"), F.when(linked, key).alias("entity_key"))


def pipeline_jobs_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.run_metrics(route_jobs(table(spark, sf_dir, "jobs")))


def pipeline_startups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Directory pages to startup rows, each address once over all pages, the first page and position first."""
    hits = shapes.page_hits(table(spark, sf_dir, "api_pages").filter("source_name = 'yc_directory'"))
    rows = payloads.directory_companies(hits, "https://yc.example/companies/")
    return dedup.first_wins(rows, ["source_url"], ["page_id", "pos1"]).select("page_id", "pos1", "entity_name", "source_url", "employee_count")


def product_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    doc = F.try_parse_json("data")
    rows = table(spark, sf_dir, "parsed_records").filter("record_type = 'product'").withColumn("doc", doc)
    get = lambda p: F.expr(f"try_variant_get(doc, '$.{p}', 'string')")
    return rows.select("id", "source_name", "source_url", "ord", F.trim(get("product_name")).alias("product_name"), F.trim(get("startup_name")).alias("startup_name"), F.lower(F.trim(get("product_name"))).alias("dedup_key"))


def pipeline_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products with their outcome: invalid, kept, duplicate_url or duplicate_key."""
    checked = validate.validate(product_rows(spark, sf_dir), validate.product_rules())
    valid = checked.filter(F.size("errors") == 0).drop("errors")
    outcome = dedup.two_key_dedup(valid, "source_url", "dedup_key", ["ord", "id"]).select("id", "startup_name", "product_name", "outcome")
    return outcome.unionByName(checked.filter(F.size("errors") > 0).select("id", "startup_name", "product_name", F.lit("invalid").alias("outcome")))


def company_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vertical, id, raw_name, ord of the company names that reach a resolver: startups and products that are kept, jobs that
    pass the gates. ``ord`` follows the runs: startups, products, jobs, each in its own order."""
    def order(run: int, when: str = "null", number: str = "null", text: str = "null", position: str = "null") -> Column:
        return F.expr(f"struct({run} as run, cast({when} as timestamp) as t, cast({number} as bigint) as n, cast({text} as string) as s, cast({position} as bigint) as p)").alias("at")

    name = lambda vertical, row_id, raw: [F.lit(vertical).alias("vertical"), F.col(row_id).alias("id"), F.col(raw).alias("raw_name")]
    startups = pipeline_startups(spark, sf_dir).select(*name("startups", "source_url", "entity_name"), order(0, text="page_id", position="pos1"))
    kept = pipeline_products(spark, sf_dir).filter("outcome = 'kept'").join(table(spark, sf_dir, "parsed_records").select("id", "ord"), "id")
    products = kept.select(*name("products", "id", "startup_name"), order(1, number="ord", text="id"))
    passed = route_jobs(table(spark, sf_dir, "jobs")).filter("status in ('inserted', 'duplicate')")
    jobs = passed.select(*name("jobs", "id", "company"), order(2, when="collected_at", text="id"))
    every = startups.unionByName(products).unionByName(jobs)
    return stage(every.orderBy("at").select("vertical", "id", "raw_name", F.monotonically_increasing_id().alias("ord")), "company-names")


def pipeline_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mapping log of the three pipelines that name companies, over one index as in the reference's database."""
    names = company_names(spark, sf_dir)
    log = resolve.resolve(names.select("raw_name", "ord")).drop("raw_name")
    return names.join(log, "ord").select("vertical", "id", "raw_name", "normalized_name", "canonical_id", "method", "confidence", "review_candidate")


def pipeline_entity_methods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(vertical, method, n): how each pipeline's names were settled."""
    return pipeline_entities(spark, sf_dir).groupBy("vertical", "method").agg(F.count("*").alias("n"))


def pipeline_research(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Works as papers, each address once over all sources, the earliest retrieved first."""
    works = table(spark, sf_dir, "openalex_works")
    papers = payloads.openalex_papers(works).withColumn("published", dates.absolute_date(F.col("publication_date")))
    first = dedup.first_wins(papers, ["paper_url"], ["retrieved_at", "paper_external_id", "title"])
    return first.select("paper_url", "paper_external_id", "title", "authors", F.to_date("published").alias("published_on"))


def fill_forward_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A target number of news rows from sources in name order, each giving its share of what is missing."""
    news, sources = table(spark, sf_dir, "news"), table(spark, sf_dir, "sources")
    names = [r.name for r in sources.filter("vertical = 'news' and enabled").select("name").orderBy("name").collect()]
    counts = allocate.counts_of(news, "source_name", names)
    return allocate.take_counts(news, "source_name", ["collected_at", "id"], allocate.fill_forward(counts, TARGET)).select("id", "source_name")


def pipeline_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Discovered addresses with their normal form, content hash and whether they are the first of it."""
    rows = table(spark, sf_dir, "raw_documents").withColumn("normalized_url", normalize_url(F.col("source_url")))
    return dedup.mark_first(rows, ["normalized_url"], ["retrieved_at", "id"]).select("id", "source_name", "normalized_url", "is_first")


QUERIES = {
    f.__name__: f
    for f in (pipeline_news, pipeline_news_metrics, pipeline_jobs, pipeline_jobs_metrics, pipeline_startups, pipeline_products, pipeline_entities, pipeline_entity_methods, pipeline_research, fill_forward_documents, pipeline_urls)
}
__all__ = ["QUERIES", "ORACLES", "stage"]

_HTTP = r"'(?i)^https?://[^\s/?#:@]+(:\d+)?([/?#]\S*)?$'"
_BLANK = r"regexp_matches(coalesce({}, ''), '[^\s\p{{Z}}]')"
_STRIP = r"regexp_replace({}, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')"
STRICT_TS = r"""case when regexp_full_match(v, '\d{4}-\d{2}-\d{2}[Tt ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?([Zz]|[+-]\d{2}:?\d{2})') then
    try_cast(substr(v, 1, 10) || ' ' || substr(v, 12, 5) || case when regexp_matches(substr(v, 17), '^:\d{2}') then regexp_extract(substr(v, 17), '^:\d{2}(\.\d{1,6})?') else ':00' end
      || case when regexp_matches(v, '[Zz]$') then '+00:00' else regexp_replace(regexp_extract(v, '[+-]\d{2}:?\d{2}$'), '^([+-]\d{2}):?(\d{2})$', '\1:\2') end as timestamptz)
  when regexp_full_match(v, '([A-Za-z]{3},?\s+)?\d{1,2}\s+[A-Za-z]{3}\s+\d{4}\s+\d{2}:\d{2}(:\d{2})?\s+([+-]\d{4}|GMT|UTC)') then
    try_strptime(regexp_extract(v, '\d{1,2}\s+[A-Za-z]{3}\s+\d{4}') || ' ' || regexp_extract(v, '\d{2}:\d{2}') || coalesce(nullif(regexp_extract(v, '\d{2}:\d{2}(:\d{2})', 1), ''), ':00') || ' '
      || case when regexp_matches(v, '(GMT|UTC)$') then '+0000' else regexp_extract(v, '[+-]\d{4}$') end, '%d %b %Y %H:%M:%S %z')
  end"""


def _routed(rows: str, valid: str, moment: str, hours: int, skew: int, reference: str) -> str:
    """SQL of a route: gates, then the first of each natural key among rows that pass."""
    low, high = -hours * 3_600_000_000, skew * 1_000_000
    return f"""r0 as ({rows}),
r1 as (select *, {valid} as is_valid, epoch_us({moment}) - epoch_us(timestamptz '{reference}+00') as age from r0),
r2 as (select *, case when not is_valid then 'invalid' when age < {low} then 'stale' when age > {high} then 'future_dated' else 'ok' end as gate from r1),
r3 as (select *, row_number() over (partition by source_name, url order by (gate <> 'ok')::int, collected_at, id) as rn from r2),
routed as (select *, case when gate <> 'ok' then gate when rn = 1 then 'inserted' else 'duplicate' end as status from r3)"""


_NEWS_VALID = f"""{_BLANK.format('title')} and {_BLANK.format('source_name')} and {_BLANK.format('full_text_location')}
  and regexp_matches(coalesce(trim(url), ''), {_HTTP}) and moment is not null"""
_NEWS = f"with n as (select *, {_STRIP.format('published_at')} as v from news semi join (select name from sources where enabled) s on s.name = news.source_name),\n" + _routed(
    f"select *, {STRICT_TS} as moment from n", _NEWS_VALID, "moment", NEWS_HOURS, 0, "2026-06-01 00:00:00"
)
_JOBS_VALID = f"{_BLANK.format('title')} and {_BLANK.format('company')} and {_BLANK.format('source_name')} and regexp_matches(coalesce(trim(url), ''), {_HTTP}) and moment is not null"
_JOBS = "with " + _routed(
    rf"select *, case when regexp_full_match({_STRIP.format('posted_at')}, '\d{{4}}-\d{{2}}-\d{{2}}[T ]([01]\d|2[0-3]):\d{{2}}:\d{{2}}(\.\d{{1,6}})?(Z|[+-]\d{{2}}:\d{{2}})?') then try_cast({_STRIP.format('posted_at')} as timestamptz) end as moment from jobs",
    _JOBS_VALID,
    "moment",
    JOBS_HOURS,
    JOBS_SKEW,
    "2026-06-01 00:00:00",
)
JOBS_SQL, NEWS_SQL = _JOBS, _NEWS
_COUNTERS = ", ".join(f"count(*) filter (status = '{s}') as {s}" for s in metrics.STATUSES) + ", count(*) filter (status in ('invalid', 'stale', 'future_dated', 'extraction_failed')) as rejected"

ORACLES = {
    "pipeline_news": f"""{_NEWS} select id, source_name, url, moment as published_at, status,
  case when gate = 'stale' then printf('stale_record: published %.1fh before reference_time', round_even(-age / 3600000000.0, 1))
    when gate = 'future_dated' then printf('future_dated: published %.0fs ahead of reference_time (exceeds 0s tolerance)', round_even(age / 1000000.0, 0))
    when gate = 'invalid' and age < {-NEWS_HOURS * 3_600_000_000} then printf('stale_record: published %.1fh before reference_time', round_even(-age / 3600000000.0, 1))
    when gate = 'invalid' and age > 0 then printf('future_dated: published %.0fs ahead of reference_time (exceeds 0s tolerance)', round_even(age / 1000000.0, 0)) end as reason from routed""",
    "pipeline_news_metrics": f"{_NEWS} select source_name, count(*) as discovered, {_COUNTERS} from routed group by 1",
    "pipeline_jobs_metrics": f"{_JOBS} select count(*) as discovered, {_COUNTERS} from routed",
    "fill_forward_documents": f"""with recursive c as (select name, row_number() over (order by name) as i, count(*) over () as m,
    (select count(*) from news where source_name = name) as n from sources where vertical = 'news' and enabled),
f as (select 0::bigint as i, {TARGET}::bigint as remain, 0::bigint as take
  union all select c.i, remain - t, t from (select c.i, f.remain, least(c.n, case when f.remain > 0 then greatest(1, ceil(f.remain / (c.m - c.i + 1))::bigint) else 0 end) as t from f join c on c.i = f.i + 1) c),
r as (select id, source_name, row_number() over (partition by source_name order by collected_at, id) as rn from news)
select id, source_name from r join c on c.name = r.source_name join f using (i) where rn <= take""",
}
