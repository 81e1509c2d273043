"""The queries of the subpackage and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gristmill.llm import boilerplate, lines, matching, mixing, names, packing, reading
from gristmill.session import table


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return boilerplate.furniture_lines(table(spark, sf_dir, "news"), table(spark, sf_dir, "raw_documents"))


def p1_kept_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return boilerplate.main_text_sizes(table(spark, sf_dir, "news"), table(spark, sf_dir, "raw_documents"))


def p1_host_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return boilerplate.host_paths(table(spark, sf_dir, "raw_documents"))


def _name_tables(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    return [table(spark, sf_dir, name) for name in ("jobs", "startups", "openalex_works")]


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return names.linked_names(*_name_tables(spark, sf_dir))


def p2_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return names.name_clusters(names.typed_names(*_name_tables(spark, sf_dir))).select("kind", "name", "n", "entity")


def _firm_tables(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    return [table(spark, sf_dir, name) for name in ("startups", "parsed_records", "jobs")]


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.matched_records(*_firm_tables(spark, sf_dir)).select("startup_id", "other_tbl", "other_id")


def p5_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.matched_records(*_firm_tables(spark, sf_dir))


def p5_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.rule_report(*_firm_tables(spark, sf_dir))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.repeated_lines(lines.news_docs(table(spark, sf_dir, "news")))


def p6_clean_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.without_repeated_lines(lines.news_docs(table(spark, sf_dir, "news")))


def p6_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.block_report(lines.news_docs(table(spark, sf_dir, "news")))


def p7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), table(spark, sf_dir, "pack_capacities"))


def p7_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packing_report(p7_packing(spark, sf_dir), table(spark, sf_dir, "pack_capacities"))


def p8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))[0]


def p8_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))[1]


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reading.found_levels(table(spark, sf_dir, "documents"), table(spark, sf_dir, "reading_labels"))


def p9_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reading.level_profile(table(spark, sf_dir, "documents"), table(spark, sf_dir, "reading_labels"))


QUERIES = {f.__name__: f for f in (p1_found, p1_kept_lines, p1_host_paths, p2_found, p2_clusters, p5_found, p5_matches, p5_rules, p6_found, p6_clean_texts, p6_blocks, p7_packing, p7_report, p8_mix, p8_shares, p9_found, p9_profile)}

_SPACE = r"[\s\x{00a0}\x{1680}\x{2000}-\x{200b}\x{202f}\x{205f}\x{3000}\x{feff}]+"
_KEYED = rf"""with l as (select id as row_id, source_name, url, unnest(string_split(full_text_location, chr(10))) as line,
    unnest(range(len(string_split(full_text_location, chr(10))))) as line_no
  from news where source_name is not null and full_text_location is not null),
k as (select *, regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(line),
    '\p{{Nd}}+', '0', 'g'), '{_SPACE}', '', 'g'), '^[^\p{{L}}\p{{N}}]+', ''), '[^\p{{L}}\p{{N}}]+$', '') as key from l),
t as (select source_name, count(distinct url) as total from news group by 1),
r as (select source_name, key from k join t using (source_name) where key <> '' group by source_name, key, total
  having count(distinct url) >= 4 and count(distinct url) * 100 >= total * 5)"""

ORACLES = {
    "p6_found": f"""{_KEYED} select row_id, line_no::int as line_no from k join r using (source_name, key)""",
    "p6_clean_texts": f"""{_KEYED}, g as (select row_id, line_no, line, source_name in (select source_name from r) and (source_name, key) in (select (source_name, key) from r) as gone from k),
    p as (select row_id, coalesce(string_agg(line, chr(10) order by line_no) filter (not gone), '') as text, count(*) filter (gone) as n_removed from g group by 1)
    select id as row_id, case when full_text_location is null then null else coalesce(p.text, full_text_location) end as text,
      case when full_text_location is null then null else coalesce(p.n_removed, 0)::int end as n_removed
    from news left join p on news.id = p.row_id""",
    "p6_blocks": f"""{_KEYED}, c as (select k.*, r.key is not null as often from k left join r using (source_name, key) where k.key <> ''),
g as (select *, sum((not often)::int) over (partition by row_id order by line_no) as run from c),
q as (select row_id, source_name, url, run, list(key order by line_no) as keys from g where often and url is not null group by row_id, source_name, url, run),
w as (select source_name, url, unnest(flatten(list_transform(range(1, len(keys) + 1), lambda i: list_transform(range(i, len(keys) + 1), lambda j: keys[i:j])))) as block from q),
b as (select source_name, block, len(block) as n, count(distinct url) as n_urls from w join t using (source_name) group by source_name, block, n, total
  having count(distinct url) >= 4 and count(distinct url) * 100 >= total * 5)
select source_name as source, n::int as len, count(*) as n_blocks, max(n_urls) as max_urls from b group by source_name, n""",
}
