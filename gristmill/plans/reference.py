"""One query per operator of the record engine, with the SQL that gives the same rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.functions import dates, html, http, urls
from gristmill.functions import text as tx
from gristmill.operators import allocate, chunks, dedup, enrich, metrics, provenance, requests, resolve, shapes, validate
from gristmill.plans import pipelines
from gristmill.session import new_path, table
from gristmill.sources import payloads, registry
from gristmill.streaming import fresh

EVENT_REFERENCE = datetime(2024, 1, 15, 12)
BUDGET = 400
QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


_STRIP = r"regexp_replace({}, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')"
_SQUASH = r"trim(regexp_replace({}, '[\s\p{{Z}}]+', ' ', 'g'))"

# --- URLs -------------------------------------------------------------------------------------

_NORMAL = r"""lower(coalesce(nullif(regexp_extract(trim(source_url), '^([A-Za-z][A-Za-z0-9+.-]*):', 1), ''), 'https')) || '://'
  || lower(regexp_extract(trim(source_url), '^[^:/?#]+://([^/?#]*)', 1))
  || case when length(regexp_extract(trim(source_url), '^[^:/?#]+://[^/?#]*([^?#]*)', 1)) > 1
       then regexp_replace(regexp_extract(trim(source_url), '^[^:/?#]+://[^/?#]*([^?#]*)', 1), '/+$', '') else regexp_extract(trim(source_url), '^[^:/?#]+://[^/?#]*([^?#]*)', 1) end
  || coalesce('?' || nullif(array_to_string(list_sort(list_filter(string_split(regexp_extract(trim(source_url), '\?([^#]*)', 1), '&'),
       lambda p: p <> '' and not regexp_matches(p, '(?i)^(utm_|ga_|mc_|icid|fbclid|gclid|ref|igshid|spm)'))), '&'), ''), '')"""


@query(f"select id, {_NORMAL} as normalized_url from raw_documents")
def url_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "raw_documents").select("id", urls.normalize_url(F.col("source_url")).alias("normalized_url"))


@query(f"""select id, normalized_url from (select id, {_NORMAL} as normalized_url,
  row_number() over (partition by {_NORMAL} order by retrieved_at, id) as rn from raw_documents) where rn = 1""")
def url_dedup_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "raw_documents").withColumn("normalized_url", urls.normalize_url(F.col("source_url")))
    return dedup.first_wins(rows, ["normalized_url"], ["retrieved_at", "id"]).select("id", "normalized_url")


@query(f"""select source_name, count(*) as discovered, count(distinct {_NORMAL}) as distinct_urls, count(*) - count(distinct {_NORMAL}) as skipped_duplicate
  from raw_documents group by 1""")
def discovery_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.countDistinct(urls.normalize_url(F.col("source_url")))
    return table(spark, sf_dir, "raw_documents").groupBy("source_name").agg(F.count("*").alias("discovered"), n.alias("distinct_urls"), (F.count("*") - n).alias("skipped_duplicate"))


@query("""select id, case when regexp_matches(trim(doi), '^https?://') then trim(doi)
    when regexp_matches(trim(primary_location.landing_page_url), '^https?://') then trim(primary_location.landing_page_url)
    when regexp_matches(trim(id), '^https?://') then trim(id) end as paper_url,
  nullif(regexp_extract(id, '/(W\\d+)\\s*$', 1), '') as work_id from openalex_works""")
def coalesce_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = urls.first_http(F.col("doi"), F.col("primary_location.landing_page_url"), F.col("id"))
    return table(spark, sf_dir, "openalex_works").select("id", url.alias("paper_url"), urls.work_id(F.col("id")).alias("work_id"))


_REPO_TEXT = "'Code (see https://github.com/' || replace(p_brand, '#', '-') || '/' || replace(p_name, ' ', '-') || '.git). More at https://github.com/x.'"


@query(f"""select p_partkey, 'https://github.com/' || replace(p_brand, '#', '-') || '/' || replace(p_name, ' ', '-') || '.git' as github_url,
  replace(p_brand, '#', '-') as owner, replace(p_name, ' ', '-') as repo from part""")
def github_url_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.expr(_REPO_TEXT)
    found = table(spark, sf_dir, "part").select("p_partkey", urls.github_url_in(text).alias("github_url"))
    repo = urls.github_repo(F.col("github_url"))
    return found.select("p_partkey", "github_url", repo["owner"].alias("owner"), repo["repo"].alias("repo"))


@query("""select p_partkey, 'https://hub.example/next?cursor=' || p_partkey as next_url from part""")
def next_page_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.concat(F.lit('<https://hub.example/first>; rel="first", <https://hub.example/next?cursor='), F.col("p_partkey"), F.lit('>; rel="next"'))
    headers = F.create_map(F.lit("Content-Type"), F.lit("json"), F.lit("LINK"), value)
    return table(spark, sf_dir, "part").select("p_partkey", urls.next_link(headers).alias("next_url"))


# --- provenance, dedup, sets ------------------------------------------------------------------


@query("select id, sha256(raw_content_location) as computed_hash, sha256(raw_content_location) = content_hash as same from raw_documents")
def content_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = tx.content_hash(F.col("raw_content_location"))
    return table(spark, sf_dir, "raw_documents").select("id", h.alias("computed_hash"), (h == F.col("content_hash")).alias("same"))


@query("""select doc_id, case when text is null then null else min(doc_id) over (partition by text) end as winner_id,
  text is not null and doc_id = min(doc_id) over (partition by text) as created from documents""")
def raw_doc_get_or_create(spark: SparkSession, sf_dir: str) -> DataFrame:
    return provenance.get_or_create(table(spark, sf_dir, "documents"), "text", "doc_id").select("doc_id", "winner_id", "created")


@query("""with old as (select source_name, url from news where collected_at < timestamptz '2026-04-01 00:00:00+00')
select id, source_name, url from (select id, source_name, url, row_number() over (partition by source_name, url order by collected_at, id) as rn from news n
  where collected_at >= timestamptz '2026-04-01 00:00:00+00' and not exists (select 1 from old where old.source_name = n.source_name and old.url = n.url)) where rn = 1""")
def insert_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    news = table(spark, sf_dir, "news")
    old, new = news.filter("collected_at < timestamp '2026-04-01'"), news.filter("collected_at >= timestamp '2026-04-01'")
    return dedup.insert_if_absent(new, old, ["source_name", "url"], ["collected_at", "id"]).select("id", "source_name", "url")


@query("select 1 as run, count(*) as inserted from (select distinct source_name, url from jobs) union all select 2, 0")
def idempotent_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    jobs = table(spark, sf_dir, "jobs").select("source_name", "url", "collected_at", "id")
    nothing = jobs.limit(0)
    first = dedup.insert_if_absent(jobs, nothing, ["source_name", "url"], ["collected_at", "id"])
    second = dedup.insert_if_absent(jobs, first, ["source_name", "url"], ["collected_at", "id"])
    return first.agg(F.lit(1).alias("run"), F.count("*").alias("inserted")).unionByName(second.agg(F.lit(2).alias("run"), F.count("*").alias("inserted")))


def _in_turn(rows: str) -> str:
    """CTEs o (i, u, k, the rows') and turn (i, outcome): rows inserted one after the other where u and k are unique."""
    return f"""o as ({rows}),
turn as (select 0::bigint as i, []::varchar[] as us, []::varchar[] as ks, '' as outcome
  union all select i, case x when 'kept' then list_append(us, u) else us end, case when x = 'kept' and k is not null then list_append(ks, k) else ks end, x from (
    select o.i, o.u, o.k, us, ks, case when list_contains(us, o.u) then 'duplicate_url' when o.k is not null and list_contains(ks, o.k) then 'duplicate_key' else 'kept' end as x from turn join o on o.i = turn.i + 1))"""


@query(f"""with recursive {_in_turn("select doc_id, row_number() over (order by doc_id) as i, md5(coalesce(url, 'doc:' || doc_id)) as u, md5(nullif(lower(trim(text)), '')) as k from documents")}
select doc_id, outcome from o join turn using (i)""")
def two_key_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.nullif(F.lower(F.trim("text")), F.lit(""))
    rows = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("url", F.concat(F.lit("doc:"), "doc_id")).alias("url_key"), key.alias("dedup_key"))
    return dedup.two_key_dedup(rows, "url_key", "dedup_key", ["doc_id"]).select("doc_id", "outcome")


@query("select 'customer' as tbl, c_name as party, c_nationkey as nation, c_mktsegment as segment from customer union all select 'supplier', s_name, s_nationkey, null from supplier")
def union_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "customer").select(F.lit("customer").alias("tbl"), F.col("c_name").alias("party"), F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment"))
    b = table(spark, sf_dir, "supplier").select(F.lit("supplier").alias("tbl"), F.col("s_name").alias("party"), F.col("s_nationkey").alias("nation"))
    return dedup.union_sources(a, b)


@query("select c_custkey as custkey from customer except select o_custkey from orders where o_orderpriority like '1%'")
def new_minus_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    new = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("custkey"))
    seen = table(spark, sf_dir, "orders").filter("o_orderpriority like '1%'").select(F.col("o_custkey").alias("custkey"))
    return dedup.minus_seen(new, seen, ["custkey"])


@query("""select n.id, n.raw_document_id, r.content_hash, r.http_status from news n left join raw_documents r on r.id = n.raw_document_id""")
def provenance_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "raw_documents").select(F.col("id").alias("raw_document_id"), "content_hash", "http_status")
    return table(spark, sf_dir, "news").select("id", "raw_document_id").join(raw, "raw_document_id", "left")


@query("""with r as (select s_suppkey, 'o' || s_nationkey || '/s' || s_suppkey as repo from supplier)
select s_suppkey, case when s_suppkey % 5 = 0 then null else 'https://github.com/O' || split_part(repo, '/', 1)[2:] || '/S' || s_suppkey end as github_url,
  case when s_suppkey % 5 in (0, 1) then null else (s_suppkey * 7)::int end as github_stars from r""")
def enrich_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    papers = s.select("s_suppkey", F.concat(F.lit("https://github.com/O"), "s_nationkey", F.lit("/S"), "s_suppkey").alias("github_url"), F.lit(0).alias("github_stars"))
    repo = F.concat(F.lit("o"), "s_nationkey", F.lit("/s"), "s_suppkey")
    repos = s.filter("s_suppkey % 5 <> 1").select(repo.alias("repo"), (F.col("s_suppkey") % 5 != 0).alias("found"), (F.col("s_suppkey") * 7).cast("int").alias("stars"))
    return enrich.with_repo_metadata(papers, repos).select("s_suppkey", "github_url", "github_stars")


@query("select o_orderkey, case when o_orderkey % 3 = 0 then 'done' else o_orderstatus end as o_orderstatus from orders")
def update_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    updates = orders.filter("o_orderkey % 3 = 0").select("o_orderkey", F.lit("done").alias("o_orderstatus"))
    return enrich.overwrite(orders, updates, "o_orderkey", ["o_orderstatus"])


@query("select count(*) as n from news where source_name in (select name from sources where enabled and vertical = 'news')")
def enabled_semi_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = table(spark, sf_dir, "sources").filter("vertical = 'news'")
    return registry.only_enabled(table(spark, sf_dir, "news"), sources).agg(F.count("*").alias("n"))


# --- validation, freshness, metrics -----------------------------------------------------------

_NON_BLANK = r"regexp_matches(coalesce({}, ''), '[^\s\p{{Z}}]')"
_HTTP = r"regexp_matches(coalesce(trim({}), ''), '(?i)^https?://[^\s/?#:@]+(:\d+)?([/?#]\S*)?$')"


@query(f"""select id, list_filter([case when not {_NON_BLANK.format('entity_name')} then 'entity_name: must not be blank' end,
  case when not {_HTTP.format('source_url')} then 'source_url: must be an http(s) URL' end,
  case when employee_count < 0 then 'employee_count: must not be negative' end], lambda m: m is not null) as errors from startups""")
def validate_startups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.validate(table(spark, sf_dir, "startups"), validate.startup_rules()).select("id", "errors")


@query(f"""select source_name, url, 'validation_error' as error_category, 'company: must not be blank' as message from jobs where not {_NON_BLANK.format('company')}""")
def quarantine_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, bad = validate.split_valid(table(spark, sf_dir, "jobs"), [validate.required("company")])
    return validate.processing_errors(bad, "validation_error").select("source_name", "url", "error_category", "message")


_AGE = "(epoch_us(ts) - epoch_us(timestamp '2024-01-15 12:00:00'))"


def _gate(skew: int) -> str:
    return f"case when {_AGE} < -86400000000 then 'stale' when {_AGE} > {skew}000000 then 'future' else 'fresh' end"


@query(f"select event_id, {_gate(60)} as state from events")
def freshness_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", dates.freshness(F.col("ts"), EVENT_REFERENCE).alias("state"))


@query(f"select event_id, {_gate(0)} as state from events")
def freshness_strict_zero_skew(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", dates.freshness(F.col("ts"), EVENT_REFERENCE, 24, 0).alias("state"))


@query(f"""select event_id, case {_gate(60)} when 'stale' then printf('stale_record: published %.1fh before reference_time', round_even(-{_AGE} / 3600000000.0, 1))
  when 'future' then printf('future_dated: published %.0fs ahead of reference_time (exceeds 60s tolerance)', round_even({_AGE} / 1000000.0, 0)) end as reason from events""")
def freshness_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", dates.freshness_reason(F.col("ts"), EVENT_REFERENCE).alias("reason"))


@query(r"""select id, collected_at - to_microseconds(regexp_extract(posted_at, '(?i)^\s*(\d+)\s+', 1)::bigint * 1000000 * case lower(regexp_extract(posted_at, '(?i)\d+\s+(second|minute|hour|day|week|month|year)', 1))
    when 'second' then 1 when 'minute' then 60 when 'hour' then 3600 when 'day' then 86400 when 'week' then 604800 when 'month' then 2592000 else 31536000 end) as posted
  from jobs where regexp_matches(posted_at, '(?i)^\s*\d+\s+(second|minute|hour|day|week|month|year)s?\s+ago\s*$')""")
def relative_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "jobs").select("id", dates.relative_date(F.col("posted_at"), F.col("collected_at")).alias("posted")).filter("posted is not null")


@query("select name, (select count(*) from news n where n.source_name = s.name) as n from sources s where vertical = 'news'")
def by_source_counts_with_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.by_source_with_zero(table(spark, sf_dir, "sources").filter("vertical = 'news'"), table(spark, sf_dir, "news"))


@query("select lang, count(*) as n from documents where lang is not null group by 1")
def facet_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.facet_counts(table(spark, sf_dir, "documents"), "lang")


@query("""with f as (select lang, count(*) as n from documents where lang is not null group by 1),
c as (select lang, n, least(n, 500) as k, coalesce(sum(least(n, 500)) over (order by n desc, lang rows between unbounded preceding and 1 preceding), 0) as before from f)
select lang, n, greatest(0, least(k, 700 - before))::bigint as taken from c""")
def facet_partition_take(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = allocate.facet_take(metrics.facet_counts(table(spark, sf_dir, "documents"), "lang"), "lang", 700, 500)
    return taken.select("lang", "n", F.col("taken").cast("bigint").alias("taken"))


@query("""select doc_id, source from (select doc_id, source, row_number() over (partition by source order by doc_id) as rn from documents)
  where rn <= greatest(1, 100 // (select count(distinct source) from documents))""")
def even_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    n = docs.select("source").distinct().count()
    return dedup.capped_per_group(docs, ["source"], ["doc_id"], allocate.even_split(100, n)).select("doc_id", "source")


@query("""select event_type, arg_max(event_id, (ts, event_id)) as latest_event from events group by 1""")
def top1_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.latest(table(spark, sf_dir, "events"), ["event_type"], [F.col("ts"), F.col("event_id")], F.col("event_id"), "latest_event")


@query("""with b as (select page_id, body::json j from api_pages where source_name = 'hackernews_ai' and json_valid(body)),
h as (select page_id, unnest(json_extract(j, '$.hits[*]')) hit, unnest(range(len(json_extract(j, '$.hits[*]')))) pos1 from b)
select page_id, pos1::int as pos1, hit->>'$.objectID' as object_id from h where pos1 < 5 and hit->>'$.objectID' is not null""")
def max_records_per_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = shapes.page_hits(table(spark, sf_dir, "api_pages").filter("source_name = 'hackernews_ai'"))
    rows = dedup.capped_per_group(hits.select("page_id", "pos1", F.expr("try_variant_get(hit, '$.objectID', 'string')").alias("object_id")), ["page_id"], ["pos1"], 5)
    return rows.filter("object_id is not null")


# --- strings and extraction -------------------------------------------------------------------

_KEY0 = r"trim(regexp_replace(regexp_replace(replace(replace(lower(strip_accents({})), 'ß', 'ss'), '&', ' and '), '[^0-9a-z ]+', ' ', 'g'), ' +', ' ', 'g'))"
_SUFFIX = "|".join(tx.LEGAL_SUFFIXES)
_KEY = rf"regexp_replace(regexp_replace(regexp_replace({_KEY0}, '^(.+?)(?: (?:{_SUFFIX}))+$', '\1'), '^the (.)', '\1'), '^(.+?)(?: (?:{'|'.join(tx.TRAILING_NOISE)}))+$', '\1')"


@query(f"select distinct company, {_KEY.format('company')} as entity_key from jobs where company is not null")
def entity_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "jobs").filter("company is not null").select("company").distinct()
    return names.select("company", tx.normalize_entity_name(F.col("company")).alias("entity_key"))


@query(rf"""select doc_id, regexp_matches(coalesce(text, ''), '{tx.AI_TITLE}') as about_ai from documents""")
def ai_title_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", tx.ai_title(F.col("text")).alias("about_ai"))


@query("select p_partkey, p_name as company, p_brand as title from part")
def pipe_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.concat(F.col("p_name"), F.lit(" | <b>"), F.col("p_brand"), F.lit("</b> |"), F.col("p_type"), F.lit("<p>More | text"))
    fields = tx.pipe_fields(tx.first_paragraph(line))
    return table(spark, sf_dir, "part").select("p_partkey", F.get(fields, F.lit(0)).alias("company"), F.get(fields, F.lit(1)).alias("title"))


@query("""select p_partkey, case when p_partkey % 2 = 0 then trim(p_brand) else split_part(p_type, ' ', 1) end as vendor from part""")
def vendor_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.when(F.col("p_partkey") % 2 == 0, F.concat(F.col("p_brand"), F.lit(": "), F.col("p_name"))).otherwise(F.col("p_name"))
    return table(spark, sf_dir, "part").select("p_partkey", tx.vendor_of(name, F.concat(F.split_part("p_type", F.lit(" "), F.lit(1)), F.lit("/m"))).alias("vendor"))


@query(r"""with b as (select page_id, body::json j from api_pages where source_name = 'yc_directory' and json_valid(body)),
h as (select page_id, unnest(hits) hit, unnest(range(len(hits))) pos1 from (select page_id, case when json_type(j, '$.hits') = 'ARRAY' then json_extract(j, '$.hits[*]')
    when json_type(j, '$.results') = 'ARRAY' then json_extract(j, '$.results[*].hits[*]') else [] end hits from b))
select page_id, pos1::int as pos1, case when json_type(hit, '$.team_size') in ('BIGINT', 'UBIGINT') and (hit->>'$.team_size')::bigint >= 0 then (hit->>'$.team_size')::int
  when json_type(hit, '$.team_size') = 'VARCHAR' and regexp_full_match(trim(hit->>'$.team_size'), '\d{1,10}') then try_cast(trim(hit->>'$.team_size') as int) end as employee_count from h""")
def digits_to_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = shapes.page_hits(table(spark, sf_dir, "api_pages").filter("source_name = 'yc_directory'"))
    return hits.select("page_id", "pos1", payloads.employee_count("hit").alias("employee_count"))


@query("select doc_id, ceil(length(text) / 4.0)::bigint as tokens from documents")
def estimate_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", tx.estimate_tokens(F.col("text")).alias("tokens"))


@query(f"""with l as (select doc_id, text, case when length(text) <= {BUDGET} then [text] else regexp_extract_all(text, '[^\\n]*\\n|[^\\n]+$') end as lines from documents where text <> ''),
p as (select doc_id, text, lines, list_reduce([[0, 0]] || list_transform(lines, lambda x: [length(x), 0]), lambda a, b:
  case when b[1] > {BUDGET} then [a[1] + (a[2] > 0)::int + ceil(b[1] / {BUDGET}.0)::int, 0]
       when a[2] + b[1] > {BUDGET} then [a[1] + 1, b[1]] else [a[1], a[2] + b[1]] end) as s from l)
select doc_id, (s[1] + (s[2] > 0)::int)::int as n_chunks, true as lossless from p""")
def chunk_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").filter("text <> ''").withColumn("chunks", chunks.chunks_of(F.col("text"), BUDGET))
    fits = F.forall("chunks", lambda c: F.length(c) <= BUDGET) & (F.array_join("chunks", "") == F.col("text"))
    return docs.select("doc_id", F.size("chunks").alias("n_chunks"), fits.alias("lossless"))


@query("select event_id, (props->>'$.k')::bigint as k from events")
def json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


@query(f"""with a as (select id, unnest(authorships) x, unnest(range(len(authorships))) p from openalex_works),
n as (select id, p, {_SQUASH.format('x.author.display_name')} as name from a)
select id, string_agg(name, '; ' order by p) as authors from n where name <> '' group by 1""")
def nested_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    works = table(spark, sf_dir, "openalex_works").select("id", payloads.author_names(F.col("authorships")).alias("names"))
    return works.filter("size(names) > 0").select("id", F.array_join("names", "; ").alias("authors"))


@query(r"""select id, nullif(regexp_extract(raw_content_location, '<title>([^<]*)</title>', 1), '') as raw_title,
  nullif(regexp_extract(raw_content_location, '<meta property="article:published_time" content="([^"]*)"', 1), '') as meta from raw_documents where raw_content_location is not null""")
def html_title_meta_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    page = F.col("raw_content_location")
    title = F.nullif(F.regexp_extract(page, "<title>([^<]*)</title>", 1), F.lit(""))
    return table(spark, sf_dir, "raw_documents").filter("raw_content_location is not null").select("id", title.alias("raw_title"), html.page_dates_of(page)["meta"].alias("meta"))


@query()
def html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = html.main_text_of(F.col("raw_content_location"))
    return table(spark, sf_dir, "raw_documents").select("id", F.length(got["text"]).alias("n_chars"), got["truncated"].alias("truncated"))


@query("""select p_partkey, p_name as title, p_brand as company, '2026-01-02' as posted_at from part""")
def jsonld_jobposting(spark: SparkSession, sf_dir: str) -> DataFrame:
    job = F.to_json(F.create_map(F.lit("@type"), F.lit("JobPosting"), F.lit("title"), F.col("p_name"), F.lit("datePosted"), F.lit("2026-01-02")))
    job = F.concat(F.regexp_replace(job, r"\}$", ""), F.lit(',"hiringOrganization":{"name":"'), F.col("p_brand"), F.lit('"}}'))
    page = F.concat(F.lit('<html><script type="application/ld+json">{"@type":"Thing"}</script><script type="application/ld+json">{"@graph":['), job, F.lit("]}</script></html>"))
    found = html.job_posting_of(page)
    return table(spark, sf_dir, "part").select("p_partkey", found["title"].alias("title"), found["company"].alias("company"), found["posted_at"].alias("posted_at"))


@query("""select event_id, '***redacted***' as api_key, props as kept from events""")
def log_redaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = tx.redact(F.create_map(F.lit("API_Key"), F.col("event_type"), F.lit("props"), F.col("props")))
    return table(spark, sf_dir, "events").select("event_id", fields["API_Key"].alias("api_key"), fields["props"].alias("kept"))


# --- entities ---------------------------------------------------------------------------------


@query(f"""with k as (select p_partkey, {_KEY.format('p_name')} as key from part)
select p_partkey, key, min(p_partkey) over (partition by key) as first_partkey from k where length(key) >= 2""")
def entity_resolve_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = table(spark, sf_dir, "part").select("p_partkey", tx.normalize_entity_name(F.col("p_name")).alias("key")).filter(tx.usable_name(F.col("key")))
    first = keyed.groupBy("key").agg(F.min("p_partkey").alias("first_partkey"))
    return keyed.join(first, "key").select("p_partkey", "key", "first_partkey")


@query()
def entity_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    startups = table(spark, sf_dir, "startups")
    return resolve.resolve(startups.select(F.col("entity_name").alias("raw_name"), F.col("id").substr(3, 20).cast("bigint").alias("ord")))


# Pairs of keys (of a CTE n: ord, key) with the share of their common subsequence, from a table of its lengths with a row for each letter.
_PAIRS = """t as (select key, min(ord) as first_ord, string_split(array_to_string(list_sort(string_split(key, ' ')), ' '), '') as x from n where length(key) >= 2 group by 1),
p as (select a.key, b.key as other, a.first_ord, b.first_ord as other_ord, a.x, b.x as y from t a join t b on a.key <> b.key and 2 * least(len(a.x), len(b.x)) >= 0.85 * (len(a.x) + len(b.x))),
w as (select *, list_reduce([list_transform(range(len(y) + 1), lambda j: 0)] || list_transform(x, lambda c: [0] || list_transform(y, lambda d: (c = d)::int)),
    lambda above, same: list_reduce([[0]] || list_transform(range(1, len(same)), lambda j: [j::int]),
      lambda row, j: row || [case when same[j[1] + 1] = 1 then above[j[1]] + 1 else greatest(above[j[1] + 1], row[j[1]]) end])) as lengths from p),
scored as (select key, other, first_ord, other_ord, 100.0 * 2 * lengths[len(y) + 1] / (len(x) + len(y)) as score from w where 200.0 * lengths[len(y) + 1] / (len(x) + len(y)) >= 85)"""
_SCORED = f"n as (select id[3:]::bigint as ord, {_KEY.format('entity_name')} as key from startups),\n{_PAIRS}"
# The root of every key's links to earlier similar keys, and its identifier; to be used with ``with recursive``.
_ROOTS = f"""{_PAIRS}, best as (select key, arg_max(other, (score, -other_ord)) as parent, max(score) as score from scored where other_ord < first_ord group by 1),
link as (select t.key, case when b.score >= 92 then b.parent else t.key end as parent from t left join best b using (key)),
walk as (select key, parent as root from link union select walk.key, l.parent from walk join link l on l.key = walk.root),
roots as (select walk.key, root, sha256('entity' || root) as h from walk join link l on l.key = walk.root where l.parent = l.key),
entity as (select key, root, h[1:8] || '-' || h[9:12] || '-' || h[13:16] || '-' || h[17:20] || '-' || h[21:32] as canonical_entity_id from roots)"""


@query(f"""with {_SCORED}, best as (select key, max(score) as score from scored where other_ord < first_ord group by 1),
m as (select case when length(n.key) < 2 then 'unresolved' when coalesce(b.score, 0) >= 92 then case when n.ord = t.first_ord then 'fuzzy' else 'alias' end
    else case when n.ord = t.first_ord then 'created' else 'normalized_exact' end end as method from n left join t using (key) left join best b using (key))
select method, count(*) as n from m group by 1""")
def entity_method_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.method_histogram(entity_resolve(spark, sf_dir))


@query(f"with {_SCORED} select key, other, round(score, 4) as score from scored where key < other")
def entity_fuzzy_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = table(spark, sf_dir, "startups").select(tx.normalize_entity_name(F.col("entity_name")).alias("key")).filter(tx.usable_name(F.col("key"))).distinct()
    return resolve.similar_keys(keys).filter("key < other").select("key", "other", F.round("score", 4).alias("score"))


@query("""with u as (select lower(n_name) as key, 'e' || n_nationkey as id, 0 as p from nation
  union all select lower(r_name), 'a' || r_regionkey, 1 from region union all select lower(n_name), 'a' || n_nationkey, 1 from nation where n_nationkey % 2 = 0)
select key, arg_min(id, (p, id)) as id, min(p) = 0 as is_entity from u group by 1""")
def entity_alias_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    entities = nation.select(F.lower("n_name").alias("normalized_name"), F.concat(F.lit("e"), "n_nationkey").alias("id"))
    aliases = region.select(F.lower("r_name").alias("normalized_alias"), F.concat(F.lit("a"), "r_regionkey").alias("canonical_entity_id"))
    aliases = aliases.unionByName(nation.filter("n_nationkey % 2 = 0").select(F.lower("n_name").alias("normalized_alias"), F.concat(F.lit("a"), "n_nationkey").alias("canonical_entity_id")))
    return resolve.alias_priority(entities, aliases)


# --- requests, streams, sources ---------------------------------------------------------------


@query("""select id, http_status, case when http_status is null then 'NetworkError' when http_status = 429 then 'RateLimitError' when http_status = 413 then 'PayloadTooLargeError'
  when http_status in (401, 403) then 'BlockedSourceError' when http_status >= 500 then 'NetworkError' else 'ok' end as outcome from raw_documents""")
def http_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    headers = F.create_map(F.lit("content-type"), F.lit("text/html"))
    return table(spark, sf_dir, "raw_documents").select("id", "http_status", http.classify_response(F.col("http_status"), headers).alias("outcome"))


@query("select n_nationkey as attempt, least(60.0, 1.0 * pow(2.0, n_nationkey - 1)) as ceiling from nation where n_nationkey > 0")
def backoff_ceiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").filter("n_nationkey > 0").select(F.col("n_nationkey").alias("attempt"), http.backoff_ceiling(F.col("n_nationkey")).alias("ceiling"))


def _sim_providers():
    first = requests.echo_provider("first", lambda p: requests.RateLimited() if int(p) % 3 == 0 else requests.NotAuthenticated() if int(p) % 3 == 1 else None)
    second = requests.echo_provider("second", lambda p: requests.NetworkFailed() if int(p) % 7 == 0 else None)
    return [first, None, second]


@query("""select doc_id::varchar as row_id, case when doc_id % 3 = 1 then 'NotAuthenticated' when doc_id % 3 = 0 and doc_id % 7 = 0 then 'AllProvidersFailed' end as failed,
  (case when doc_id % 3 > 0 then 1 when doc_id % 7 = 0 then 6 else 4 end)::int as n_attempts from documents""")
def llm_fallback_sim(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("doc_id").cast("string").alias("payload"))
    ran = requests.run_requests(docs, "doc_id", "payload", _sim_providers)
    return ran.select("row_id", "failed", F.size("attempts").alias("n_attempts"))


@query("""with d as (select doc_id::varchar as request_id, doc_id % 3 as a, doc_id % 7 = 0 as b from documents),
e as (select *, unnest(range(case when a > 0 then 1 when b then 6 else 4 end)) as k from d)
select request_id, k::int as attempt_no, case when k < 3 then 'first' else 'second' end as provider, case when a = 2 or k = 3 and not b then 'success' else 'error' end as status, (k % 3)::int as retry_count, k >= 3 as fallback_used,
  case when a = 1 then 'NotAuthenticated' when a = 0 and k < 3 then 'RateLimited' when a = 0 and b then 'NetworkFailed' end as error_type, length(request_id)::int as input_size_chars,
  ceil(length(request_id) / 4.0)::int as estimated_tokens, case when a = 2 or k = 3 and not b then length('{"chars": ' || length(request_id) || '}')::int end as output_size_chars from e""")
def llm_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("doc_id").cast("string").alias("payload"))
    return requests.attempt_rows(requests.run_requests(docs, "doc_id", "payload", _sim_providers)).drop("model", "latency_ms")


# --- sources: bodies, statuses, bounds --------------------------------------------------------


@query(f"""select id, {_SQUASH.format("coalesce(nullif(title, ''), display_name)")} as title, case when regexp_matches(trim(doi), '^https?://') then trim(doi)
    when regexp_matches(trim(primary_location.landing_page_url), '^https?://') then trim(primary_location.landing_page_url) else trim(id) end as paper_url
  from openalex_works where {_NON_BLANK.format("coalesce(nullif(title, ''), display_name)")} and regexp_matches(trim(id), '^https?://')""")
def openalex_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each work written as a captured body of one result beside things that are no works, and read again."""
    works = table(spark, sf_dir, "openalex_works").drop("retrieved_at")
    body = F.concat(F.lit('{"meta": {"count": 1}, "results": [3, null, "x", '), F.to_json(F.struct("*")), F.lit("]}"))
    pages = works.select(F.col("id").alias("source_name"), F.lit("").alias("url"), F.lit(0).alias("ord"), body.alias("text"))
    return payloads.openalex_papers(payloads.work_bodies(pages)).select(F.col("source_name").alias("id"), "title", "paper_url")


@query("""select source_name, source_url as url, 'ParsingError' as error_category, 'HTTP ' || coalesce(http_status::varchar, 'none') || ' from ' || source_url as message
  from raw_documents where http_status is distinct from 200""")
def status_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "raw_documents").select("source_name", F.col("source_url").alias("url"), F.col("http_status").alias("status_code"))
    return payloads.status_errors(rows)


@query(f"""with u as (select id, source_name, {_NORMAL} as n, row_number() over (partition by source_name order by retrieved_at, id) as k from raw_documents),
d as (select *, row_number() over (partition by source_name, n order by k) = 1 as first from u),
s as (select source_name, min(k) as stop from d where first and k >= 7 group by 1)
select id, source_name, first from d left join s using (source_name) where k <= coalesce(stop, k)""")
def discovery_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At most 7 discovered units of each source, repeats counted; a run stops at a unit that is new."""
    rows = table(spark, sf_dir, "raw_documents").withColumn("unit", urls.normalize_url(F.col("source_url")))
    return dedup.discovered(rows, "source_name", "unit", ["retrieved_at", "id"], 7).select("id", "source_name", "first")


@query("""with b as (select page_id, body::json j from api_pages where source_name = 'yc_directory' and json_valid(body)),
h as (select page_id, unnest(hits) hit, unnest(range(len(hits))) pos1 from (select page_id, case when json_type(j, '$.hits') = 'ARRAY' then json_extract(j, '$.hits[*]')
    when json_type(j, '$.results') = 'ARRAY' then json_extract(j, '$.results[*].hits[*]') else [] end hits from b))
select page_id, pos1::int as pos1, hit->>'$.batch' as batch from h where json_type(hit, '$.tags') = 'ARRAY' and json_type(hit, '$.batch') = 'VARCHAR'
  and list_has_any(json_extract_string(hit, '$.tags[*]'), ['Artificial Intelligence', 'Robotics']) and hit->>'$.batch' like 'Spring %'""")
def tag_and_batch_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = shapes.page_hits(table(spark, sf_dir, "api_pages").filter("source_name = 'yc_directory'"))
    kept = payloads.tagged_in(hits, ["Artificial Intelligence", "Robotics"], lambda batch: batch.like("Spring %"))
    return kept.select("page_id", "pos1", payloads.batch_of("hit").alias("batch"))


@query(f"select event_id, user_id, event_type from (select *, row_number() over (partition by user_id, event_type order by ts, event_id) as rn from events where {_gate(60)} = 'fresh') where rn = 1")
def stream_freshness_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = table(spark, sf_dir, "events").schema
    stream = fresh.table_stream(spark, sf_dir, "events", schema)
    path = new_path(spark, "fresh-events")
    out = fresh.run_available(spark, fresh.fresh_stream(stream, "ts", EVENT_REFERENCE), path, new_path(spark, "fresh-offsets"), ["user_id", "event_type"], ["ts", "event_id"])
    return out.select("event_id", "user_id", "event_type")


@query("select source_name, count(*) as n from api_pages where not coalesce(json_valid(body), false) or (json_type(body, '$.hits') is distinct from 'ARRAY') group by 1")
def broken_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "api_pages").select("source_name", F.col("source_url").alias("url"), F.col("body").alias("text"), F.col("page_id").alias("ord"))
    return payloads.broken(pages, "$.hits").groupBy("source_name").agg(F.count("*").alias("n"))


@query(f"""select id, {_SQUASH.format('title')} as title, trim(url) as link from news where {_NON_BLANK.format('title')} and {_HTTP.format('url')}""")
def feed_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each news row written as a feed of one item and read again."""
    safe = lambda c: F.replace(F.replace(F.coalesce(F.col(c), F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    xml = F.concat(F.lit("<rss><channel><title>t</title><item><title>"), safe("title"), F.lit("</title><link>"), safe("url"), F.lit("</link></item></channel></rss>"))
    feeds = table(spark, sf_dir, "news").select(F.col("id").alias("source_name"), xml.alias("text"), F.lit(0).alias("ord"))
    return payloads.feed_items(feeds).select(F.col("source_name").alias("id"), "title", "link")


@query("select id, company, title, url from (select id, trim(company) as company, trim(title) as title, trim(url) as url from jobs) where " + " and ".join(_NON_BLANK.format(c) for c in ("company", "title", "url")))
def json_job_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each posting written as a list with a notice and one job, and read again."""
    job = F.to_json(F.struct(F.col("title").alias("position"), "company", "url", F.col("posted_at").alias("date")))
    body = F.concat(F.lit('[{"legal": "terms"}, 3, '), job, F.lit("]"))
    pages = table(spark, sf_dir, "jobs").select(F.col("id").alias("source_name"), F.lit("").alias("url"), F.lit(0).alias("ord"), body.alias("text"))
    return payloads.tagged_jobs(pages).select(F.col("source_name").alias("id"), "company", "title", "url")


@query("select source_name, url as loc from (select distinct source_name, trim(url) as url from jobs where url is not null and trim(url) <> '')")
def sitemap_locs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each posting's address in a sitemap of its own, the source's addresses once each."""
    safe = F.replace(F.col("url"), F.lit("&"), F.lit("&amp;"))
    xml = F.concat(F.lit("<urlset xmlns='x'><url><loc> "), safe, F.lit(" </loc></url><url><loc/></url></urlset>"))
    pages = table(spark, sf_dir, "jobs").filter("url is not null").select("source_name", F.lit(0).alias("ord"), xml.alias("text"))
    return payloads.sitemap_urls(pages).select("source_name", "loc")


@query(f"select id, {_SQUASH.format('coalesce(title, display_name)')} as title, id as paper_url from openalex_works where {_NON_BLANK.format('coalesce(title, display_name)')}")
def atom_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each work written as an Atom feed of one entry and read again."""
    name = F.coalesce("title", "display_name")
    safe = F.replace(F.replace(F.coalesce(name, F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    xml = F.concat(F.lit("<feed xmlns='http://www.w3.org/2005/Atom'><entry><id>"), F.col("id"), F.lit("</id><title>"), safe, F.lit("</title><author><name>A  B</name></author></entry></feed>"))
    pages = table(spark, sf_dir, "openalex_works").select(F.col("id").alias("source_name"), F.lit("").alias("url"), F.lit(0).alias("ord"), xml.alias("text"))
    return payloads.arxiv_papers(pages).select(F.col("source_name").alias("id"), "title", "paper_url")


# --- SQL of pipelines that are registered elsewhere -------------------------------------------

ORACLES["pipeline_urls"] = f"""select id, source_name, {_NORMAL} as normalized_url,
  row_number() over (partition by {_NORMAL} order by retrieved_at, id) = 1 as is_first from raw_documents"""

ORACLES["pipeline_jobs"] = f"""{pipelines.JOBS_SQL}, k as (select *, {_KEY.format('company')} as key from routed)
select id, source_name, status, moment as posted_at, case when status in ('inserted', 'duplicate') and length(key) >= 2 then key end as entity_key from k"""

def _products(order: str) -> str:
    """CTEs of the checked products (v) and, by order, what becomes of the valid ones (o, turn)."""
    return f"""p as (select id, source_name, source_url, ord, coalesce(list_position({pipelines.PRODUCT_ORDER}, source_name), {len(pipelines.PRODUCT_ORDER) + 1}) as source_rank,
    trim(data->>'$.product_name') as product_name, trim(data->>'$.startup_name') as startup_name, lower(trim(data->>'$.product_name')) as dedup_key
  from parsed_records where record_type = 'product' and json_valid(data)),
v as (select *, {_NON_BLANK.format('startup_name')} and {_HTTP.format('source_url')} as ok from p),
{_in_turn(f"select *, row_number() over (order by {order}) as i, source_url as u, dedup_key as k from v where ok")}"""


ORACLES["pipeline_products"] = f"""with recursive {_products('ord, id')}
select v.id, v.startup_name, v.product_name, coalesce(outcome, 'invalid') as outcome from v left join o using (id) left join turn on turn.i = o.i"""

ORACLES["pipeline_startups"] = rf"""with b as (select page_id, body::json j from api_pages where source_name = 'yc_directory' and json_valid(body)),
h as (select page_id, unnest(hits) hit, unnest(range(len(hits))) pos1 from (select page_id, case when json_type(j, '$.hits') = 'ARRAY' then json_extract(j, '$.hits[*]')
    when json_type(j, '$.results') = 'ARRAY' then json_extract(j, '$.results[*].hits[*]') else [] end hits from b)),
r as (select page_id, pos1::int as pos1, {_SQUASH.format("hit->>'$.name'")} as entity_name, regexp_replace(trim(hit->>'$.slug'), '^/+|/+$', '', 'g') as slug,
  case when json_type(hit, '$.team_size') in ('BIGINT', 'UBIGINT') and (hit->>'$.team_size')::bigint >= 0 then (hit->>'$.team_size')::int
    when json_type(hit, '$.team_size') = 'VARCHAR' and regexp_full_match(trim(hit->>'$.team_size'), '\d{{1,10}}') then try_cast(trim(hit->>'$.team_size') as int) end as employee_count from h)
select page_id, pos1, entity_name, 'https://yc.example/companies/' || slug as source_url, employee_count from (
  select *, row_number() over (partition by slug order by page_id, pos1) as rn from r where entity_name <> '' and slug <> '' and not contains(slug, '/')) where rn = 1"""

ORACLES["entity_resolve"] = f"""with recursive n as (select id[3:]::bigint as ord, coalesce({_KEY.format('entity_name')}, '') as key, entity_name from startups), {_ROOTS},
m as (select n.*, entity.canonical_entity_id, best.parent, best.score, case when length(key) < 2 then 'unresolved' when coalesce(best.score, 0) >= 92 then case when n.ord = t.first_ord then 'fuzzy' else 'alias' end
    else case when n.ord = t.first_ord then 'created' else 'normalized_exact' end end as method from n left join t using (key) left join best using (key) left join entity using (key))
select case when trim(coalesce(entity_name, '')) = '' then '(empty)' else entity_name[:250] end as raw_name, ord, key as normalized_name, canonical_entity_id as canonical_id, method,
  case method when 'unresolved' then 0.0 when 'alias' then 0.99 when 'fuzzy' then round_even(score / 100, 4) else 1.0 end::double as confidence,
  case when method = 'created' and score < 92 then printf('%s (%.1f)', parent, score) end as review_candidate from m"""

_JOB_NAMES = f"""{pipelines.JOBS_SQL.replace('with ', 'with recursive ', 1)},
n as (select id, row_number() over (order by collected_at, id) as ord, {_KEY.format('company')} as key from routed where status in ('inserted', 'duplicate')), {_ROOTS}"""

ORACLES["pipeline_jobs_entities"] = f"""{_JOB_NAMES}
select source_name, url, company, moment as posted_at, entity.canonical_entity_id from routed join n using (id) left join entity using (key) where status = 'inserted'"""

ORACLES["pipeline_products_entities"] = f"""with recursive {_products('source_rank, ord, id').replace('p as (', 'pr as (', 1).replace(' from p)', ' from pr)')},
kept as (select o.* from o join turn using (i) where outcome = 'kept'),
n as (select id, i as ord, {_KEY.format('startup_name')} as key from kept), {_ROOTS}
select source_name, source_url, product_name, startup_name, canonical_entity_id from kept join n using (id) left join entity using (key)"""

ORACLES["pipeline_news_provenance"] = f"""{pipelines.NEWS_SQL}, i as (select *, sha256(full_text_location) as content_hash from routed where status = 'inserted')
select source_name, url, moment as published_at, content_hash, first_value(url) over (partition by content_hash order by collected_at, id) as first_url from i"""


def _messages(*rules: tuple[str, str]) -> str:
    """The messages of broken rules, joined. rules: (condition, message)."""
    each = ", ".join(f"case when not coalesce({condition}, false) then '{message}' end" for condition, message in rules)
    return f"array_to_string(list_filter([{each}], lambda m: m is not null), '; ')"


def _filled(*names: str) -> list[tuple[str, str]]:
    return [(_NON_BLANK.format(n), f"{n}: must not be blank") for n in names]


_URL_RULE = (_HTTP.format("url"), "url: must be an http(s) URL")
_NEWS_ERRORS = _messages(*_filled("title", "source_name", "full_text_location"), _URL_RULE, ("moment is not null", "published_at: must be a complete timestamp with zone"))
_JOB_ERRORS = _messages(*_filled("title", "company", "source_name"), _URL_RULE, ("moment is not null", "posted_at: must be a timestamp"))
_PRODUCT_ERRORS = _messages(*_filled("startup_name"), (_HTTP.format("source_url"), "source_url: must be an http(s) URL"))
ORACLES["pipeline_errors"] = f"""select 'news-1' as crawl_run_id, source_name, url, 'validation_error' as error_category, {_NEWS_ERRORS} as message from ({pipelines.NEWS_SQL} select * from routed where status = 'invalid')
union all select 'jobs-1', source_name, url, 'validation_error', {_JOB_ERRORS} from ({pipelines.JOBS_SQL} select * from routed where status = 'invalid')
union all select 'products-1', source_name, source_url, 'ValidationError', {_PRODUCT_ERRORS} from (with recursive {_products('id')} select * from v where not ok)"""

ORACLES["pipeline_rerun"] = f"""{_JOB_NAMES},
news_routed as ({pipelines.NEWS_SQL} select * from routed),
c as (select 'jobs' as tbl, count(*) as n from routed where status = 'inserted' union all select 'news', count(*) from news_routed where status = 'inserted'
  union all select 'raw_documents', count(distinct full_text_location) from news_routed where status = 'inserted' union all select 'canonical_entities', count(*) from link where key = parent
  union all select 'entity_aliases', count(*) from link where key <> parent union all select 'entity_mapping_log', count(*) from n
  union all select 'processing_errors', (select count(*) from routed where status = 'invalid') + (select count(*) from news_routed where status = 'invalid'))
select run::int as run, tbl, n from c, range(1, 3) r(run)"""

_ALL_NAMES = f"""{pipelines.JOBS_SQL.replace('with ', 'with recursive ', 1)},
{_products('ord, id').replace('p as (', 'pr as (', 1).replace(' from p)', ' from pr)')},
every as (select 'startups' as vertical, source_url as id, entity_name as raw_name, 0 as run, null::timestamptz as seen_at, null::bigint as num, page_id::varchar as txt, pos1::bigint as pos from ({ORACLES['pipeline_startups']})
  union all select 'products', id, startup_name, 1, null, o.ord, id, null from o join turn using (i) where outcome = 'kept'
  union all select 'jobs', id, company, 2, collected_at, null, id, null from routed where status in ('inserted', 'duplicate')),
n as (select *, row_number() over (order by run, seen_at nulls first, num nulls first, txt, pos nulls first) as ord, coalesce({_KEY.format('raw_name')}, '') as key from every), {_ROOTS},
m as (select n.*, entity.canonical_entity_id, best.parent, best.score, case when length(key) < 2 then 'unresolved' when coalesce(best.score, 0) >= 92 then case when n.ord = t.first_ord then 'fuzzy' else 'alias' end
    else case when n.ord = t.first_ord then 'created' else 'normalized_exact' end end as method from n left join t using (key) left join best using (key) left join entity using (key))"""

ORACLES["pipeline_entity_methods"] = f"{_ALL_NAMES} select vertical, method, count(*) as n from m group by 1, 2"

ORACLES["pipeline_entities"] = f"""{_ALL_NAMES} select vertical, id, raw_name, key as normalized_name, canonical_entity_id as canonical_id, method,
  case method when 'unresolved' then 0.0 when 'alias' then 0.99 when 'fuzzy' then round_even(score / 100, 4) else 1.0 end::double as confidence,
  case when method = 'created' and score < 92 then printf('%s (%.1f)', parent, score) end as review_candidate from m"""

_NAME = _SQUASH.format("a.author.display_name")
ORACLES["pipeline_research"] = rf"""with w as (select *, {_STRIP.format('publication_date')} as v, {_SQUASH.format("coalesce(case when " + _NON_BLANK.format("title") + " then title end, display_name)")} as name,
    coalesce({", ".join(f"case when {_HTTP.format(c)} then trim({c}) end" for c in ("doi", "primary_location.landing_page_url", "id"))}) as paper_url from openalex_works),
x as (select *, regexp_replace(regexp_replace(v, '^[A-Za-z]{{3}},\s*', ''), '(GMT|UTC)$', '+0000') as plain from w where {_NON_BLANK.format('name')} and paper_url is not null),
d as (select *, nullif(regexp_extract(id, '/(W\d+)\s*$', 1), '') as paper_external_id, coalesce({pipelines.STRICT_TS},
    case when regexp_full_match(v, '\d{{4}}-\d{{2}}-\d{{2}}([T ].*)?') then try_cast(v as timestamptz) end,
    try_strptime(plain, ['%d %b %Y', '%d %B %Y', '%b %d, %Y', '%B %d, %Y', '%Y/%m/%d', '%Y%m%d'])::timestamptz, try_strptime(plain, '%d %b %Y %H:%M:%S %z')) as published from x)
select paper_url, paper_external_id, name as title, list_filter(list_transform(authorships, lambda a: {_NAME}), lambda n: n is not null and n <> '') as authors, published::date as published_on from d
qualify row_number() over (partition by paper_url order by retrieved_at nulls first, paper_external_id nulls first, name nulls first) = 1"""
