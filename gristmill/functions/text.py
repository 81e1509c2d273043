"""String functions as column expressions, and the few that need Python."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Legal forms at the end of a firm's name, and words that job boards add.
LEGAL_SUFFIXES = (
    "inc incorporated llc ltd limited plc corp corporation co company gmbh ag sa sas sarl bv nv ab as oy kk pte pty srl spa kft ug llp lp pbc"
).split()
TRAILING_NOISE = "the group holdings holding".split()
AI_TITLE = r"(?i)\b(?:AI|LLMs?|GPT|artificial intelligence|machine learning|deep learning|neural network)\b"
# Names of fields that hold secrets.
SECRET_FIELDS = "api_key apikey authorization password secret token access_token refresh_token".split()


def squash_spaces(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def strip(text: Column) -> Column:
    """Without white space at both ends, no-break spaces included."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def non_blank(text: Column) -> Column:
    """Whether a text has anything but white space; false for null."""
    return F.coalesce(text.rlike(r"(?U)\S"), F.lit(False))


def blank_to_null(text: Column) -> Column:
    return F.when(non_blank(text), text)


def _fold_batches(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in batches:
        yield batch.map(lambda s: None if s is None else "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c)))


def strip_accents(text: Column) -> Column:
    """Without combining marks; ASCII texts never leave the JVM's own expression."""
    udf = F.pandas_udf(_fold_batches, "string")
    return F.when(text.rlike(r"^[\x00-\x7F]*$"), text).otherwise(udf(text))


def normalize_entity_name(name: Column) -> Column:
    """The comparison key of a name: no accents, case, punctuation, legal suffixes, leading ``the``, trailing noise."""
    key = F.replace(F.lower(strip_accents(name)), F.lit("ß"), F.lit("ss"))
    key = F.regexp_replace(F.replace(key, F.lit("&"), F.lit(" and ")), "[^0-9a-z ]+", " ")
    key = F.trim(F.regexp_replace(key, " +", " "))
    key = F.regexp_replace(key, f"^(.+?)(?: (?:{'|'.join(LEGAL_SUFFIXES)}))+$", "$1")
    key = F.regexp_replace(key, "^the (?=.)", "")
    return F.regexp_replace(key, f"^(.+?)(?: (?:{'|'.join(TRAILING_NOISE)}))+$", "$1")


def usable_name(key: Column) -> Column:
    return F.coalesce(F.length(key) >= 2, F.lit(False))


def pipe_fields(text: Column) -> Column:
    """Trimmed fields of a ``Company | Title | ...`` line."""
    return F.transform(F.split(text, r"\|"), lambda p: F.trim(p))


def first_paragraph(html: Column) -> Column:
    """The text before the second paragraph of a comment, without tags."""
    return squash_spaces(strip_tags(F.get(F.split(html, "<p>"), F.lit(0))))


def strip_tags(html: Column) -> Column:
    return unescape(F.regexp_replace(html, "<[^>]+>", " "))


def unescape(text: Column) -> Column:
    """The entities that plain texts need."""
    out = text
    for entity, char in (("&#x27;", "'"), ("&#39;", "'"), ("&quot;", '"'), ("&#x2F;", "/"), ("&lt;", "<"), ("&gt;", ">"), ("&nbsp;", " "), ("&amp;", "&")):
        out = F.replace(out, F.lit(entity), F.lit(char))
    return out


def first_href(html: Column) -> Column:
    """The address of the first link; '' if there is none."""
    return unescape(F.regexp_extract(html, r"""(?i)<a\s[^>]*?href\s*=\s*["']([^"']*)""", 1))


def vendor_of(model_name: Column, model_id: Column) -> Column:
    """The vendor of ``Vendor: Model``, else the owner of ``vendor/model``; null if neither is there."""
    named = F.when(F.instr(model_name, ":") > 0, F.trim(F.split_part(model_name, F.lit(":"), F.lit(1))))
    owner = F.when(F.instr(model_id, "/") > 0, F.trim(F.split_part(model_id, F.lit("/"), F.lit(1))))
    return F.coalesce(blank_to_null(named), blank_to_null(owner))


def repo_title(title: Column, repo_id: Column) -> Column:
    """A card's title, else the last segment of ``owner/repo``."""
    return F.coalesce(blank_to_null(squash_spaces(title)), blank_to_null(F.element_at(F.split(repo_id, "/"), -1)))


def digits_to_int(text: Column) -> Column:
    """Only digits become a number: no signs, no decimals, no flags, nothing beyond an int."""
    return F.when(text.rlike(r"^\d{1,10}$"), text.try_cast("int"))


def estimate_tokens(text: Column) -> Column:
    return F.ceil(F.length(text) / 4)


def ai_title(title: Column) -> Column:
    return F.coalesce(title.rlike(AI_TITLE), F.lit(False))


# What stands in place of a secret, and after a prompt that is cut.
REDACTED, CUT_MARK = "***redacted***", "...(truncated)"


def redact(fields: Column) -> Column:
    """Values of a map's secret fields replaced, prompts cut to 200 characters."""
    secret = lambda k: F.lower(k).isin(SECRET_FIELDS)
    return F.transform_values(fields, lambda k, v: F.when(secret(k), F.lit(REDACTED)).when((F.lower(k) == "prompt") & (F.length(v) > 200), F.concat(F.substring(v, 1, 200), F.lit(CUT_MARK))).otherwise(v))


def content_hash(text: Column) -> Column:
    return F.sha2(text, 256)


def deterministic_id(*parts: Column) -> Column:
    """A stable identifier of a natural key, in the shape of a UUID."""
    h = F.sha2(F.concat_ws("", *[F.coalesce(p.cast("string"), F.lit("\0")) for p in parts]), 256)
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4), F.substring(h, 17, 4), F.substring(h, 21, 12))
