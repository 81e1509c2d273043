"""URL functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Beginnings of query keys that only track visitors.
TRACKING_PREFIXES = ["utm_", "ga_", "mc_", "icid", "fbclid", "gclid", "ref", "ref_src", "igshid", "spm"]
_TRACKING = f"(?i)^(?:{'|'.join(TRACKING_PREFIXES)})"
_PARTS = r"^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#.*)?$"
_GITHUB = r"^https?://github\.com/([\w.-]+)/([\w.-]+?)(?:\.git)?/?$"


def _part(url: Column, group: int) -> Column:
    return F.regexp_extract(url, _PARTS, group)


def is_tracking_param(key: Column) -> Column:
    return key.rlike(_TRACKING)


def _encode(value: Column) -> Column:
    """Form encoding; unlike the built-in one it keeps ``~`` and encodes ``*``."""
    return F.replace(F.replace(F.url_encode(value), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def normalize_url(url: Column) -> Column:
    """Lower-case scheme and host, no fragment, no tracking keys, sorted query, no trailing slashes; null for null."""
    u = F.trim(url)
    scheme = F.coalesce(F.nullif(F.lower(_part(u, 1)), F.lit("")), F.lit("https"))
    path = _part(u, 3)
    path = F.when(F.length(path) > 1, F.regexp_replace(path, "/+$", "")).otherwise(path)

    def pair(p: Column) -> Column:
        plain = lambda x: F.coalesce(F.try_url_decode(x), x)
        return F.struct(plain(F.substring_index(p, "=", 1)).alias("k"), plain(F.when(F.instr(p, "=") > 0, F.substring(p, F.instr(p, "=") + 1, F.length(p))).otherwise("")).alias("v"))

    pairs = F.transform(F.filter(F.split(_part(u, 4), "&"), lambda p: p != ""), pair)
    kept = F.array_sort(F.filter(pairs, lambda p: ~is_tracking_param(p["k"])))
    query = F.array_join(F.transform(kept, lambda p: F.concat(_encode(p["k"]), F.lit("="), _encode(p["v"]))), "&")
    return F.concat(scheme, F.lit("://"), F.lower(_part(u, 2)), path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))


def is_http_url(url: Column) -> Column:
    """An absolute http or https URL with a host; false for null."""
    return F.coalesce(F.trim(url).rlike(r"(?i)^https?://[^\s/?#:@]+(?::\d+)?(?:[/?#]\S*)?$"), F.lit(False))


def host_of(url: Column) -> Column:
    return F.lower(_part(F.trim(url), 2))


def github_repo(url: Column) -> Column:
    """struct(owner, repo) of a repository address, else null."""
    hit = F.trim(url).rlike(_GITHUB)
    return F.when(hit, F.struct(F.regexp_extract(F.trim(url), _GITHUB, 1).alias("owner"), F.regexp_extract(F.trim(url), _GITHUB, 2).alias("repo")))


def github_url_in(text: Column) -> Column:
    """The first repository address within a text, without trailing punctuation; null if there is none."""
    found = F.regexp_extract_all(text, F.lit(r"(https?://github\.com/[\w.-]+/[^\s<>\"]+)"), 1)
    clean = F.transform(found, lambda u: F.regexp_replace(u, r"[).,;:'\"]+$", ""))
    return F.get(F.filter(clean, lambda u: u.rlike(_GITHUB)), F.lit(0))


def first_http(*columns: Column) -> Column:
    """The first column that holds an http(s) address once stripped."""
    return F.coalesce(*[F.when(F.trim(c).rlike("^https?://"), F.trim(c)) for c in columns])


def work_id(url: Column) -> Column:
    return F.nullif(F.regexp_extract(url, r"/(W\d+)\s*$", 1), F.lit(""))


def arxiv_id(url: Column) -> Column:
    return F.nullif(F.regexp_extract(url, r"abs/([\w.]+)", 1), F.lit(""))


def template_url(prefix: str, slug: Column) -> Column:
    """``prefix`` and a record's own slug; null for a blank slug or one with a slash inside."""
    clean = F.regexp_replace(F.trim(slug), "^/+|/+$", "")
    return F.when((clean != "") & (F.instr(clean, "/") == 0), F.concat(F.lit(prefix), clean))


def next_link(headers: Column) -> Column:
    """The rel="next" address of a Link header in a map of headers, whatever the case of its name."""
    value = F.get(F.map_values(F.map_filter(headers, lambda k, _: F.lower(k) == "link")), F.lit(0))
    return F.nullif(F.regexp_extract(value, r'<([^>]*)>\s*;[^,]*rel="?next"?', 1), F.lit(""))


def query_string(pairs: dict[str, Column]) -> Column:
    """k=v joined by &, values form-encoded, in the given order; null values are left out."""
    parts = [F.when(v.isNotNull(), F.concat(F.lit(f"{k}="), _encode(v.cast("string")))) for k, v in pairs.items()]
    return F.concat_ws("&", *parts)
