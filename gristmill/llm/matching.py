"""Records of three sources about the same firms, matched without keys (problem 5).

A deterministic cascade of rules: each is an exact join on a weaker combination of
attributes, over the records that no earlier rule resolved. The attributes are the site, the
form of the name, the name's cluster of spellings, and the place; the firms are those of the
directory rows. A rule's confidence is its precision on labelled pairs, smoothed: those of the
pairs it decides itself where both sides state an attribute that the rule does not use, so
that it can tell right from wrong (the site for rules on names, the name for rules on sites).
A record's own votes do not count for its label, which is what the directory states.

Postings are reduced to distinct (name, site, place) profiles before any join and expanded
at the end, so that a firm with a third of all postings costs no more than any other.

Cases: a record without usable attributes, or with placeholders only, matches nothing; a
profile that fits several firms by one rule goes to the firm that the most rows state, ties
to the smaller identifier; repeated rows count each; broken JSON has no attributes; empty
tables give an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.llm import names
from gristmill.session import stage

#: Smoothing of a rule's precision: as if so many labelled pairs had been right, and so many wrong.
PRIOR_RIGHT, PRIOR_WRONG = 1.0, 1.0
# Names of a host that do not belong to the firm, and words of a place that name none.
HOST_WORDS = "www careers career jobs job apply hiring work about"
NO_PLACE = set("remote anywhere worldwide multiple locations location various hybrid global ok the and".split())


def site_of(url: Column) -> Column:
    """The firm's host in a loosely written address; null if there is none."""
    host = F.regexp_extract(F.lower(F.trim(url)), r"^(?:[a-z][a-z0-9+.-]*://)?(?:[^/?#@\s]*@)?([a-z0-9.-]+\.[a-z]{2,})(?=[/:?#]|$)", 1)
    return F.nullif(F.regexp_replace(host, rf"^(?:(?:{'|'.join(HOST_WORDS.split())})\.)+", ""), F.lit(""))


def place_key(text: str | None) -> str:
    """The words of a place, without case, accents and order; '' for none."""
    if not text:
        return ""
    words = [w for w in re.split(r"[^a-z]+", names.fold(text)) if len(w) > 1 and w not in NO_PLACE]
    return " ".join(sorted(set(words)))


def _first(*paths: str) -> Column:
    """The first path of ``data`` with a non-blank string."""
    return F.coalesce(*[F.nullif(F.trim(F.expr(f"try_variant_get(doc, '{p}', 'string')")), F.lit("")) for p in paths])


def parsed_firms(parsed: DataFrame) -> DataFrame:
    """(row_id, name, site, place) of records of type startup, whatever their source calls the fields."""
    docs = parsed.filter("record_type = 'startup'").select("id", F.try_parse_json("data").alias("doc"))
    return docs.select(
        F.col("id").alias("row_id"),
        _first("$.org", "$.company_name", "$.profile.title", "$.name", "$.startup_name", "$.title", "$.entity_name").alias("name"),
        site_of(_first("$.site", "$.url", "$.profile.links[0].href", "$.website", "$.homepage")).alias("site"),
        _first("$.hq", "$.location", "$.profile.place.city", "$.city").alias("place"),
    )


def directory_firms(startups: DataFrame) -> DataFrame:
    return startups.select(F.col("id").alias("row_id"), F.col("entity_name").alias("name"), site_of(F.col("website")).alias("site"), F.col("location").alias("place"))


def job_firms(jobs: DataFrame) -> DataFrame:
    return jobs.select(
        F.col("id").alias("row_id"),
        F.col("company").alias("name"),
        site_of(F.col("metadata_json")["apply_url"]).alias("site"),
        F.col("metadata_json")["location"].alias("place"),
    )


def profiles_of(tables: dict[str, DataFrame]) -> DataFrame:
    """(profile, tbl, name, site, place, n): the distinct attributes of each table's records."""
    rows = None
    for tbl, df in tables.items():
        each = df.groupBy("name", "site", "place").agg(F.count("*").alias("n")).withColumn("tbl", F.lit(tbl))
        rows = each if rows is None else rows.unionByName(each)
    key = F.xxhash64("tbl", *[F.coalesce(F.col(c), F.lit("\0")) for c in ("name", "site", "place")])
    return rows.withColumn("profile", key)


def with_names(profiles: DataFrame) -> DataFrame:
    """Adds form (an identifier of the name's form), core, and entity (the name's cluster of spellings)."""
    strings = profiles.filter(F.col("name").rlike(r"(?U)\S")).groupBy(F.lit("company").alias("kind"), "name").agg(F.sum("n").alias("n"))
    clusters = names.name_clusters(strings)
    return profiles.join(stage(clusters.select("name", "form", "entity"), "firm-names"), "name", "left")


def _place_batches(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in batches:
        yield batch.map(place_key)


#: The cascade: name, attributes joined on, attribute that labels its pairs.
RULES = [
    ("site and name", ["site", "form"], "entity"),
    ("site", ["site"], "entity"),
    ("name and place", ["form", "place_key"], "site"),
    ("name", ["form"], "site"),
    ("spelling and place", ["entity", "place_key"], "site"),
    ("spelling", ["entity"], "site"),
]


def firm_of_rows(named: DataFrame) -> DataFrame:
    """Adds firm: the entity that most records of the row's site name, else the row's own entity.

    A site's records agree on a firm even where one of their names is hard to read.
    """
    votes = named.filter("site is not null and entity is not null").groupBy("site", "entity").agg(F.sum("n").alias("votes"))
    best = votes.groupBy("site").agg(F.max_by("entity", F.struct("votes", F.bitwise_not("entity"))).alias("site_firm"))
    return named.join(best, "site", "left").withColumn("firm", F.coalesce("site_firm", "entity")).drop("site_firm")


def resolve_profiles(named: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(links, rules). links: profile, firm, rule, confidence for every profile that a rule resolves;
    rules: rule, right, wrong, confidence. named: profile, tbl, form, entity, site, place_key, firm, n; staged."""
    known = named.filter("tbl = 'startups' and firm is not null")
    others = named.filter("tbl <> 'startups'")
    links = None
    for rule, keys, label in RULES:
        usable = " and ".join(f"{k} is not null" + (f" and {k} <> ''" if k == "place_key" else "") for k in keys)
        stated = known.filter(usable).groupBy(*keys, "firm").agg(F.sum("n").alias("votes"), F.max_by(label, F.struct("n", label)).alias("label"))
        best = stated.groupBy(*keys).agg(F.max_by(F.struct("firm", "label"), F.struct("votes", F.bitwise_not("firm"))).alias("best"))
        open_rows = others.filter(usable).select("profile", "n", F.col(label).alias("own"), *[k for k in keys])
        if links is not None:
            open_rows = open_rows.join(links.select("profile"), "profile", "left_anti")
        found = open_rows.join(best, keys).select("profile", F.col("best.firm").alias("firm"), F.lit(rule).alias("rule"), "n", (F.col("own") == F.col("best.label")).alias("agrees"))
        found = stage(found, "rule-links")
        links = found if links is None else links.unionByName(found)
    sides = (F.coalesce(F.sum(F.when(F.col("agrees") == side, F.col("n"))), F.lit(0)) for side in (True, False))
    counts = {r[0]: (int(r[1]), int(r[2])) for r in links.groupBy("rule").agg(*sides).collect()}  # one row a rule
    rates = []
    for rule, *_ in RULES:
        right, wrong = counts.get(rule, (0, 0))
        rates.append((rule, right, wrong, (right + PRIOR_RIGHT) / (right + wrong + PRIOR_RIGHT + PRIOR_WRONG)))
    confidence = F.lit(None).cast("double")
    for rule, _, _, rate in rates:
        confidence = F.when(F.col("rule") == rule, F.lit(rate)).otherwise(confidence)
    rules = named.sparkSession.createDataFrame(rates, "rule string, right bigint, wrong bigint, confidence double")
    return links.select("profile", "firm", "rule", confidence.alias("confidence")), rules


def prepared(tables: dict[str, DataFrame]) -> DataFrame:
    """The tables' profiles with names, places and firms; staged."""
    named = firm_of_rows(stage(with_names(profiles_of(tables)), "profiles"))
    return stage(named.withColumn("place_key", F.pandas_udf(_place_batches, "string")(F.coalesce("place", F.lit("")))), "firm-profiles")


def firm_tables(startups: DataFrame, parsed: DataFrame, jobs: DataFrame) -> dict[str, DataFrame]:
    return {"startups": directory_firms(startups), "parsed_records": parsed_firms(parsed), "jobs": job_firms(jobs)}


def matched_records(startups: DataFrame, parsed: DataFrame, jobs: DataFrame) -> DataFrame:
    """(startup_id, other_tbl, other_id, rule, confidence) of each directory row and each record about the same firm."""
    tables = firm_tables(startups, parsed, jobs)
    named = prepared(tables)
    links, _ = resolve_profiles(named)
    keyed = None
    for tbl, df in tables.items():
        key = F.xxhash64(F.lit(tbl), *[F.coalesce(F.col(c), F.lit("\0")) for c in ("name", "site", "place")])
        each = df.select("row_id", F.lit(tbl).alias("tbl"), key.alias("profile"))
        keyed = each if keyed is None else keyed.unionByName(each)
    rows_of_firm = keyed.filter("tbl = 'startups'").join(named.filter("tbl = 'startups' and firm is not null").select("profile", "firm"), "profile").select(F.col("row_id").alias("startup_id"), "firm")
    others = keyed.filter("tbl <> 'startups'").join(links, "profile")
    return others.join(rows_of_firm, "firm").select("startup_id", F.col("tbl").alias("other_tbl"), F.col("row_id").alias("other_id"), "rule", "confidence")


def rule_report(startups: DataFrame, parsed: DataFrame, jobs: DataFrame) -> DataFrame:
    """(rule, right, wrong, confidence): each rule's labelled pairs and smoothed precision."""
    return resolve_profiles(prepared(firm_tables(startups, parsed, jobs)))[1]
