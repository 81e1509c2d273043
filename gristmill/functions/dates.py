"""Publication dates, relative dates and the freshness window as column expressions."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

from gristmill.functions.text import strip

# Days of the longer units of a relative date.
UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 7 * 86400, "month": 30 * 86400, "year": 365 * 86400}
# The two forms of a complete timestamp, and of a relative date.
_ISO = r"^(\d{4}-\d{2}-\d{2})[Tt ](\d{2}:\d{2})(:\d{2}(?:\.\d+)?)?([Zz]|[+-]\d{2}:?\d{2})$"
_RFC = r"^(?:[A-Za-z]{3},?\s+)?(\d{1,2})\s+([A-Za-z]{3})\s+(\d{4})\s+(\d{2}:\d{2})(:\d{2})?\s+([+-]\d{4}|GMT|UTC)$"
_AGO = rf"(?i)^\s*(\d+)\s+({'|'.join(UNIT_SECONDS)})s?\s+ago\s*$"


def to_utc(value: Column) -> Column:
    """A timestamp without zone is taken for UTC (the session's zone)."""
    return value.cast("timestamp")


def strict_timestamp(text: Column) -> Column:
    """Only complete timestamps with an explicit zone, ISO or RFC 822; anything else is null."""
    t = strip(text)
    zone = F.when(F.regexp_extract(t, _ISO, 4).rlike("^[Zz]$"), F.lit("+00:00")).otherwise(F.regexp_replace(F.regexp_extract(t, _ISO, 4), r"^([+-]\d{2}):?(\d{2})$", "$1:$2"))
    seconds = F.coalesce(F.nullif(F.regexp_extract(t, _ISO, 3), F.lit("")), F.lit(":00"))
    iso = F.concat(F.regexp_extract(t, _ISO, 1), F.lit("T"), F.regexp_extract(t, _ISO, 2), F.regexp_replace(seconds, r"^(:\d{2}\.\d{6})\d+$", "$1"), zone).try_cast("timestamp")
    offset = F.when(F.regexp_extract(t, _RFC, 6).isin("GMT", "UTC"), F.lit("+0000")).otherwise(F.regexp_extract(t, _RFC, 6))
    month = F.initcap(F.regexp_extract(t, _RFC, 2))
    rfc = F.concat_ws(" ", F.regexp_extract(t, _RFC, 1), month, F.regexp_extract(t, _RFC, 3), F.concat(F.regexp_extract(t, _RFC, 4), F.coalesce(F.nullif(F.regexp_extract(t, _RFC, 5), F.lit("")), F.lit(":00"))), offset)
    return F.when(t.rlike(_ISO), iso).when(t.rlike(_RFC), F.try_to_timestamp(rfc, F.lit("d MMM yyyy HH:mm:ss xx")))


def full_iso(text: Column) -> Column:
    """ISO dates with a full time of day, with or without zone (then UTC); anything else is null."""
    t = strip(text)
    return F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}[T ](?:[01]\d|2[0-3]):\d{2}:\d{2}(?:\.\d{1,6})?(?:Z|[+-]\d{2}:\d{2})?$"), t.try_cast("timestamp"))


def absolute_date(text: Column) -> Column:
    """ISO first, then usual written forms. A value without a full date is null, never filled in from today."""
    t = strip(text)
    iso = F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}(?:[T ].*)?$"), t.try_cast("timestamp"))
    formats = ["d MMM yyyy", "d MMMM yyyy", "MMM d, yyyy", "MMMM d, yyyy", "yyyy/MM/dd", "yyyyMMdd", "d MMM yyyy HH:mm:ss xx"]
    plain = F.regexp_replace(F.regexp_replace(t, r"^[A-Za-z]{3},\s*", ""), r"(?:GMT|UTC)$", "+0000")
    return F.coalesce(strict_timestamp(t), iso, *[F.try_to_timestamp(plain, F.lit(f)) for f in formats])


def relative_date(text: Column, reference: Column) -> Column:
    """today, yesterday and ``N units ago`` before ``reference``; a month has 30 days and a year 365; null otherwise."""
    unit, seconds = F.lower(F.regexp_extract(text, _AGO, 2)), F.lit(None).cast("bigint")
    for name, n in UNIT_SECONDS.items():
        seconds = F.when(unit == name, F.lit(n).cast("bigint")).otherwise(seconds)
    back = F.regexp_extract(text, _AGO, 1).try_cast("bigint") * seconds
    ago = F.timestamp_micros(F.unix_micros(reference) - back * 1_000_000)
    word = F.lower(F.trim(text))
    return F.when(word == "today", reference).when(word == "yesterday", F.timestamp_micros(F.unix_micros(reference) - F.lit(86_400_000_000))).when(text.rlike(_AGO), ago)


def publication_date(structured: Column, json_ld: Column, meta: Column, time_tag: Column, visible: Column, reference: Column, heuristic: Column | None = None) -> Column:
    """The first that parses: structured, JSON-LD, meta, time tag, visible text, then a caller's own guess."""
    steps = [absolute_date(structured), relative_date(structured, reference), absolute_date(json_ld), absolute_date(meta), absolute_date(time_tag), absolute_date(visible), relative_date(visible, reference)]
    return F.coalesce(*steps, *([heuristic] if heuristic is not None else []))


def utc_micros(reference: datetime) -> int:
    """Microseconds since 1970 of a reference time: an aware one in its own zone, a naive one in UTC."""
    aware = reference.replace(tzinfo=timezone.utc) if reference.tzinfo is None else reference
    return (aware - datetime(1970, 1, 1, tzinfo=timezone.utc)) // timedelta(microseconds=1)


def micros_after(value: Column, reference: datetime) -> Column:
    """Microseconds from ``reference`` to a timestamp."""
    base = utc_micros(reference)
    return F.unix_micros(value.cast("timestamp")) - F.lit(base)


def freshness(value: Column, reference: datetime, window_hours: float = 24, skew_seconds: float = 60) -> Column:
    """'fresh', 'stale' or 'future', both bounds inclusive to the microsecond; null for null."""
    age = micros_after(value, reference)
    low, high = -int(window_hours * 3_600_000_000), int(skew_seconds * 1_000_000)
    return F.when(age < low, "stale").when(age > high, "future").when(age.isNotNull(), "fresh")


def freshness_reason(value: Column, reference: datetime, window_hours: float = 24, skew_seconds: float = 60) -> Column:
    """Why a record is not fresh; null where it is."""
    age, state = micros_after(value, reference), freshness(value, reference, window_hours, skew_seconds)
    # fixed values: the two reasons
    hours = F.format_string("stale_record: published %.1fh before reference_time", F.bround(-age / 3_600_000_000.0, 1))
    ahead = F.format_string("future_dated: published %.0fs ahead of reference_time (exceeds %ss tolerance)", F.bround(age / 1_000_000.0, 0), F.lit(str(int(skew_seconds))))
    return F.when(state == "stale", hours).when(state == "future", ahead)


def age_hours(value: Column, reference: datetime) -> Column:
    return F.bround(-micros_after(value, reference) / 3_600_000_000.0, 1)


def epoch_window(reference: datetime, hours: int = 24) -> tuple[int, int]:
    """First and last whole second of the window before ``reference``."""
    end = utc_micros(reference) // 1_000_000
    return end - hours * 3600, end
