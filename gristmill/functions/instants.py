"""Parser for one raw timestamp string: every format, precision and zone the sources write.

``parse(raw, zone, order)`` gives ``(utc_us, ago_us)``: an instant, or a distance back from
the time of collection, or neither where the value names no single instant.
"""

from __future__ import annotations

import re
from datetime import date, datetime, timedelta, timezone
from functools import lru_cache
from zoneinfo import ZoneInfo

# Month names of the languages the sources write, by month number.
MONTH_NAMES = {
    1: "january jan januar jänner janvier janv enero ene gennaio janeiro",
    2: "february feb februar février févr fév febrero febbraio fevereiro",
    3: "march mar märz mrz mars marzo março",
    4: "april apr avril avr abril abr aprile",
    5: "may mai mayo maggio maio",
    6: "june jun juni juin junio giugno junho",
    7: "july jul juli juillet juil julio luglio julho",
    8: "august aug août aout agosto ago",
    9: "september sep sept septembre septiembre settembre setembro",
    10: "october oct oktober okt octobre octubre ottobre outubro",
    11: "november nov novembre noviembre novembro",
    12: "december dec dezember dez décembre déc diciembre dic dicembre dezembro",
}
MONTHS = {name: number for number, names in MONTH_NAMES.items() for name in names.split()}

# Usual offsets of zone abbreviations, in minutes.
ABBREVIATIONS = {
    "Z": 0, "UT": 0, "UTC": 0, "GMT": 0, "WET": 0, "WEST": 60, "BST": 60, "CET": 60, "MEZ": 60,
    "CEST": 120, "MESZ": 120, "EET": 120, "EEST": 180, "MSK": 180, "IST": 330, "ICT": 420,
    "SGT": 480, "HKT": 480, "AWST": 480, "JST": 540, "KST": 540, "ACST": 570, "ACDT": 630,
    "AEST": 600, "AEDT": 660, "NZST": 720, "NZDT": 780, "NST": -210, "NDT": -150, "AST": -240,
    "ADT": -180, "EST": -300, "EDT": -240, "CST": -360, "CDT": -300, "MST": -420, "MDT": -360,
    "PST": -480, "PDT": -420, "AKST": -540, "AKDT": -480, "HST": -600,
}
# Abbreviations that mean the local time of a zone.
LOCAL_TIMES = {"ET": "America/New_York", "CT": "America/Chicago", "MT": "America/Denver", "PT": "America/Los_Angeles"}
# Seconds of each unit of a relative time.
UNITS = {"second": 1, "sec": 1, "minute": 60, "min": 60, "hour": 3600, "hr": 3600, "day": 86400, "week": 604800}

DAY_US = 86_400_000_000
EPOCH = datetime(1970, 1, 1)
_SPACES = re.compile(r"[\s\u00a0\u1680\u2000-\u200b\u202f\u205f\u3000\ufeff]+")
_MONTH = r"(?P<month>[^\W\d_]{3,10})\.?"
_CLOCK = r"(?P<h>\d{1,2})(?::|h)(?P<mi>\d{2})(?::(?P<s>\d{2})(?:[.,](?P<f>\d{1,12}))?)?"
_HALF = r"(?:\s?(?P<half>[ap]\.?m\.?))?"
_ZONE = r"(?:\s?(?P<off>[+-]\d{2}:?\d{2}(?::\d{2})?|[+-]\d{2}|[A-Za-z]{1,5}))?(?:\s?\((?P<note>[A-Za-z]{1,5})\))?(?:\[(?P<region>[A-Za-z_+\-/0-9]+)\])?"
_WEEKDAY = r"(?:[^\W\d_]{2,10}\.?,?\s)?"
_PATTERNS = [
    re.compile(p + r"\Z", re.I)
    for p in (
        rf"(?P<y>\d{{4}})-(?P<m>\d{{1,2}})-(?P<d>\d{{1,2}})(?:(?:t|\s|,\s?){_CLOCK}{_HALF}{_ZONE})?",
        rf"(?P<y>\d{{4}})(?P<m>\d{{2}})(?P<d>\d{{2}})(?:t(?P<h>\d{{2}})(?P<mi>\d{{2}})(?:(?P<s>\d{{2}})(?:[.,](?P<f>\d{{1,12}}))?)?{_ZONE})?",
        rf"(?P<y>\d{{4}})/(?P<m>\d{{1,2}})/(?P<d>\d{{1,2}})(?:(?:t|\s){_CLOCK}{_HALF}{_ZONE})?",
        rf"(?P<y>\d{{4}})-W(?P<week>\d{{2}})-(?P<wd>\d)(?:t{_CLOCK}{_ZONE})?",
        rf"(?P<y>\d{{4}})-(?P<doy>\d{{3}})(?:t{_CLOCK}{_ZONE})?",
        rf"(?P<d>\d{{1,2}})\.(?P<m>\d{{1,2}})\.(?P<y>\d{{4}}|\d{{2}})(?:,?\s{_CLOCK}(?:\suhr)?{_HALF}{_ZONE})?",
        rf"(?P<a>\d{{1,2}})/(?P<b>\d{{1,2}})/(?P<y>\d{{4}}|\d{{2}})(?:,?\s{_CLOCK}{_HALF}{_ZONE})?",
        rf"{_WEEKDAY}(?P<d>\d{{1,2}})(?:\.|st|nd|rd|th|er)?(?:\s|-)(?:de\s)?{_MONTH}(?:\s|-)(?:de\s|del\s)?(?P<y>\d{{4}}|\d{{2}})(?:(?:,\s?|\s)(?:(?:at|à|a las|um|at)\s)?{_CLOCK}(?:\s(?:uhr|h))?{_HALF}{_ZONE})?",
        rf"{_WEEKDAY}{_MONTH}\s(?P<d>\d{{1,2}})(?:st|nd|rd|th)?,?\s(?P<y>\d{{4}})(?:(?:,\s?|\s)(?:at\s)?{_CLOCK}{_HALF}{_ZONE})?",
        rf"{_WEEKDAY}{_MONTH}\s(?P<d>\d{{1,2}})\s{_CLOCK}{_HALF}(?:\s(?P<off>[+-]\d{{2}}:?\d{{2}}|[A-Za-z]{{1,5}}))?\s(?P<y>\d{{4}})",
    )
]
_AGO = re.compile(r"(?P<n>\d+|an?|one)\s(?P<unit>second|sec|minute|min|hour|hr|day|week)s?\sago\Z", re.I)
_EPOCH = re.compile(r"-?\d{9,20}(?:\.\d+)?\Z")


@lru_cache(maxsize=512)
def _zone(name: str) -> ZoneInfo | None:
    try:
        return ZoneInfo(name)
    except (KeyError, ValueError, OSError):
        return None


def _local_us(us: int, zone: ZoneInfo | None) -> int | None:
    """UTC of a wall-clock time; None where the zone skips it or has it twice."""
    if zone is None:
        return None
    try:
        wall = (EPOCH + timedelta(microseconds=us)).replace(tzinfo=zone)
        first, second = wall.utcoffset(), wall.replace(fold=1).utcoffset()
    except OverflowError:
        return None
    return us - first // timedelta(microseconds=1) if first == second else None


def _epoch_us(text: str) -> int | None:
    whole, _, rest = text.partition(".")
    digits, n = len(whole.lstrip("-")), int(whole)
    if rest and digits > 10:
        return None
    if digits <= 10:
        return n * 1_000_000 + int((rest + "000000")[:6]) if not rest or n >= 0 else None
    if digits in (12, 13):
        return n * 1_000
    if digits in (15, 16):
        return n
    return n // 1_000 if digits in (18, 19) else None


def _day(g: dict[str, str | None], order: str | None) -> date | None:
    year = int(g["y"]) + (2000 if len(g["y"]) == 2 else 0)
    if g.get("week"):
        return date.fromisocalendar(year, int(g["week"]), int(g["wd"]))
    if g.get("doy"):
        found = date(year, 1, 1) + timedelta(days=int(g["doy"]) - 1)
        return found if found.year == year and int(g["doy"]) else None
    if g.get("a"):
        a, b = int(g["a"]), int(g["b"])
        if order == "mdy":
            return date(year, a, b)
        if order == "dmy":
            return date(year, b, a)
        if a == b:
            return date(year, a, b)
        if (a > 12) != (b > 12):
            return date(year, min(a, b), max(a, b))
        return None
    month = MONTHS.get(g["month"].lower()) if g.get("month") else int(g["m"])
    return date(year, month, int(g["d"])) if month else None


def parse(raw: str | None, zone: str | None = None, order: str | None = None) -> tuple[int | None, int | None]:
    """(instant in microseconds, None), (None, microseconds ago), or (None, None).

    Null, blank, incomplete, ambiguous and impossible values give (None, None).
    """
    if raw is None:
        return None, None
    text = _SPACES.sub(" ", raw).strip()
    if not text:
        return None, None
    if _EPOCH.match(text):
        return _epoch_us(text), None
    if hit := _AGO.match(text):
        n = int(hit["n"]) if hit["n"].isdigit() else 1
        return None, n * UNITS[hit["unit"].lower()] * 1_000_000
    for pattern in _PATTERNS:
        if hit := pattern.match(text):
            return _from_groups(hit.groupdict(), zone, order), None
    return None, None


def _from_groups(g: dict[str, str | None], zone: str | None, order: str | None) -> int | None:
    try:
        day = _day(g, order)
    except ValueError:
        return None
    if day is None:
        return None
    us = (day.toordinal() - EPOCH.toordinal()) * DAY_US
    if g.get("h") is None:
        return us
    hour, minute, second = int(g["h"]), int(g["mi"]), int(g["s"] or 0)
    part = int(((g.get("f") or "") + "000000")[:6])
    if half := g.get("half"):
        if not 1 <= hour <= 12:
            return None
        hour = hour % 12 + (12 if half[0] in "pP" else 0)
    if minute > 59 or second > 59 or hour > 24 or (hour == 24 and (minute or second or part)):
        return None
    us += ((hour * 60 + minute) * 60 + second) * 1_000_000 + part
    return _to_utc(us, g.get("off"), g.get("region"), zone)


def _to_utc(us: int, off: str | None, region: str | None, zone: str | None) -> int | None:
    if off and off[0] in "+-":
        digits = off[1:].replace(":", "").ljust(6, "0")
        h, m, s = int(digits[:2]), int(digits[2:4]), int(digits[4:6])
        if h > 18 or m > 59 or s > 59:
            return None
        shift = (h * 3600 + m * 60 + s) * 1_000_000
        return us + shift if off[0] == "-" else us - shift
    if off:
        name = off.upper()
        if name in LOCAL_TIMES:
            return _local_us(us, _zone(LOCAL_TIMES[name]))
        if name not in ABBREVIATIONS:
            return None
        return us - ABBREVIATIONS[name] * 60_000_000
    return _local_us(us, _zone(region or zone or "UTC"))
