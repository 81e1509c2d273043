"""Queries of problems 3 and 4, with SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gristmill.operators import shapes, timestamps
from gristmill.session import table


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shapes.named_children(table(spark, sf_dir, "openalex_works"), table(spark, sf_dir, "api_pages"))


def p3_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shapes.variant_counts(table(spark, sf_dir, "openalex_works"), table(spark, sf_dir, "api_pages"))


def p3_registered_authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shapes.author_tables(table(spark, sf_dir, "openalex_works")).subtype("registered")


def p3_identified_authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shapes.author_tables(table(spark, sf_dir, "openalex_works")).subtype("identified")


def p3_registered_institutions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shapes.institution_tables(table(spark, sf_dir, "openalex_works")).subtype("registered")


def p3_identified_industries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shapes.industry_tables(table(spark, sf_dir, "api_pages")).subtype("identified")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("news", "jobs", "openalex_works", "api_pages", "sources")
    rows = timestamps.timestamp_rows(*[table(spark, sf_dir, name) for name in names])
    return timestamps.found_instants(rows, timestamps.InstantDictionary(spark, timestamps.dictionary_path(spark, sf_dir)))


QUERIES = {f.__name__: f for f in (p3_found, p3_variants, p3_registered_authors, p3_identified_authors, p3_registered_institutions, p3_identified_industries, p4_found)}

_AUTHORSHIPS = """a as (select id, unnest(authorships) x, unnest(range(len(authorships))) pos1 from openalex_works),
i as (select id, pos1, unnest(x.institutions) y, unnest(range(len(x.institutions))) pos2 from a)"""
_INDUSTRIES = """b as (select page_id, body::json j from api_pages where json_valid(body)),
h as (select page_id, unnest(hits) hit, unnest(range(len(hits))) pos1 from (
  select page_id, case when json_type(j, '$.hits') = 'ARRAY' then json_extract(j, '$.hits[*]')
    when json_type(j, '$.results') = 'ARRAY' then json_extract(j, '$.results[*].hits[*]') else [] end hits from b)),
k as (select page_id, pos1, unnest(many) v, unnest(range(len(many))) pos2 from (
  select page_id, pos1, case json_type(hit, '$.industries') when 'ARRAY' then json_extract(hit, '$.industries[*]')
    when 'NULL' then [] when 'VARCHAR' then [json_extract(hit, '$.industries')] when 'OBJECT' then [json_extract(hit, '$.industries')] else [] end many from h)),
d as (select *, case json_type(v) when 'VARCHAR' then v->>'$' when 'OBJECT' then v->>'$.name' end as name from k)"""

ORACLES = {
    "p3_found": f"""with {_AUTHORSHIPS}, {_INDUSTRIES}
select 'author' as kind, id as parent_id, pos1::int as pos1, -1 as pos2 from a where regexp_matches(x.author.display_name, '[^\\s\\p{{Z}}]')
union all select 'institution', id, pos1::int, pos2::int from i where regexp_matches(y.display_name, '[^\\s\\p{{Z}}]')
union all select 'industry', page_id::varchar, pos1::int, pos2::int from d where regexp_matches(name, '[^\\s\\p{{Z}}]')""",
    "p3_registered_authors": f"""with {_AUTHORSHIPS}
select id as parent_id, pos1::int as pos1, -1 as pos2, x.author.display_name as name, x.author.id as child_id, x.author.orcid as child_orcid,
  x.author.display_name as child_display_name from a where x.author.id is not null and x.author.orcid is not null and x.author.display_name is not null""",
    "p3_identified_authors": f"""with {_AUTHORSHIPS}
select id as parent_id, pos1::int as pos1, -1 as pos2, x.author.display_name as name, x.author.id as child_id, x.author.display_name as child_display_name
  from a where x.author.id is not null and x.author.orcid is null and x.author.display_name is not null""",
    "p3_variants": f"""with {_AUTHORSHIPS}, {_INDUSTRIES},
s as (select 'author' as kind, x.author.display_name as name, case when x.author is null then 'void' when x.author.display_name is null then 'unnamed'
    when x.author.id is null then 'named' when x.author.orcid is null then 'identified' else 'registered' end as state from a
  union all select 'institution', y.display_name, case when y is null then 'void' when y.display_name is null then 'unnamed'
    when y.ror is not null then 'registered' when y.id is not null then 'identified' else 'named' end from i
  union all select 'industry', name, case json_type(v) when 'VARCHAR' then 'text' when 'NULL' then 'void' when 'BOOLEAN' then 'flag' when 'ARRAY' then 'list'
    when 'OBJECT' then case when json_type(v, '$.name') is distinct from 'VARCHAR' then 'unnamed'
      when json_type(v, '$.id') in ('VARCHAR', 'BIGINT', 'UBIGINT', 'DOUBLE') then 'identified' else 'labelled' end else 'number' end from d)
select kind, state, count(*) as n, count(*) filter (where regexp_matches(name, '[^\\s\\p{{Z}}]')) as n_named from s group by kind, state""",
    "p3_registered_institutions": f"""with {_AUTHORSHIPS}
select id as parent_id, pos1::int as pos1, pos2::int as pos2, y.display_name as name, y.id as child_id, y.ror as child_ror,
  y.display_name as child_display_name, y.country_code as child_country_code, y.type as child_type from i
  where y.ror is not null and y.display_name is not null""",
    "p3_identified_industries": f"""with {_INDUSTRIES}
select page_id::varchar as parent_id, pos1::int as pos1, pos2::int as pos2, name, v->>'$.id' as child_id, name as child_name from d
  where json_type(v) = 'OBJECT' and v->>'$.id' is not null and json_type(v, '$.name') = 'VARCHAR'""",
}
