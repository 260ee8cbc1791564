"""Reading one timestamp text: every valid reading of it, as UTC instants.

A text has one reading where its form fixes the order of day, month and year (ISO forms, month
names with a full year, Unix times), and up to three where it does not (``03/04/2025``,
``18-Sep-25``). Which of them holds is decided by :mod:`quillgrid.operators.timestamps`.
"""

from __future__ import annotations

import re
import unicodedata
from datetime import datetime, timedelta, timezone
from functools import lru_cache
from zoneinfo import ZoneInfo

# Names of months in English, German, French and Spanish, without accents.
_MONTHS = [
    "january januar janvier enero",
    "february februar fevrier febrero",
    "march marz maerz mars marzo",
    "april avril abril",
    "may mai mayo",
    "june juni juin junio",
    "july juli juillet julio",
    "august aout agosto",
    "september septembre septiembre setiembre",
    "october oktober octobre octubre",
    "november novembre noviembre",
    "december dezember decembre diciembre",
]
# Zone abbreviations, in minutes from UTC.
_ABBREVIATIONS = {
    "z": 0, "utc": 0, "gmt": 0, "ut": 0, "wet": 0, "west": 60, "bst": 60, "cet": 60, "mez": 60, "cest": 120, "mesz": 120, "eet": 120, "eest": 180, "msk": 180, "ist": 330, "sgt": 480, "hkt": 480, "awst": 480,
    "jst": 540, "kst": 540, "acst": 570, "aest": 600, "acdt": 630, "aedt": 660, "nzst": 720, "nzdt": 780, "nst": -210, "ndt": -150, "ast": -240, "adt": -180, "est": -300, "edt": -240, "cst": -360, "cdt": -300,
    "mst": -420, "mdt": -360, "pst": -480, "pdt": -420, "akst": -540, "akdt": -480, "hst": -600,
}
# Abbreviations that follow the clock of a region.
_REGIONS = {"et": "America/New_York", "ct": "America/Chicago", "mt": "America/Denver", "pt": "America/Los_Angeles"}

ORDERS = ("dmy", "mdy", "ymd")
_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def _month_table() -> dict[str, int]:
    table: dict[str, int] = {}
    for n, names in enumerate(_MONTHS, 1):
        for name in names.split():
            for k in range(3, len(name) + 1):
                table[name[:k]] = n if table.get(name[:k], n) == n else 0
    for n, names in enumerate(_MONTHS, 1):
        for name in names.split():
            table[name] = n
    return {k: v for k, v in table.items() if v}


_MONTH = _month_table()
_ZONE = r"(?P<zone>z\b|(?:utc|gmt)?\s*[+-]\d{1,2}(?::?\d{2})?|[a-z]+(?:/[a-z_+\-0-9]+)+|[a-z]{1,5}\.?)?\s*(?:\[(?P<region>[a-z_/+\-0-9]+)\]|\([a-z ]+\))?"
_TIME = re.compile(
    r"^(?:[\s,]*(?:t|at|um|a las|a|kl\.?|-)?\s*(?P<h>\d{1,2})\s*[:h.]\s*(?P<m>\d{2})(?:[:.](?P<s>\d{2})(?:[.,](?P<f>\d{1,12}))?)?\s*(?P<half>[ap]\.?m\b\.?)?\s*(?:(?:uhr|hrs?|h)\b)?)?[\s,]*" + _ZONE + r"\s*$"
)
_WEEKDAY = re.compile(r"^(?:mon|tue|wed|thu|fri|sat|sun|mo|di|mi|do|fr|sa|so|lun|mar|mer|jeu|ven|sam|dim|mie|jue|vie|sab|dom)[a-z]*\.?,\s*")
_NUMBER = re.compile(r"^[+-]?\d+(?:\.\d+)?$")
_COMPACT = re.compile(r"^(\d{4})(\d{2})(\d{2})t(\d{2})(\d{2})(?:(\d{2})(?:[.,](\d{1,12}))?)?\s*(z|[+-]\d{2}(?::?\d{2})?)?$")
_DIGITS = re.compile(r"^(\d{4}|\d{1,2})([/.\-])(\d{1,2})\2(\d{4}|\d{1,2})(?=$|[\st,])")
_DAY_FIRST = re.compile(r"^(\d{1,2})(?:st|nd|rd|th|er|\.)?([\s\-]+|\.\s*)(?:de |of )?([a-z]{3,12})\.?,?[\s\-]+(?:de |del |of )?(\d{4}|\d{2})(?=$|[\st,])")
_MONTH_FIRST = re.compile(r"^([a-z]{3,12})\.?[\s\-]+(\d{1,2})(?:st|nd|rd|th)?,?[\s\-]+(\d{4})(?=$|[\st,])")
_YEAR_FIRST = re.compile(r"^(\d{4})[\s\-]+([a-z]{3,12})\.?[\s\-]+(\d{1,2})(?=$|[\st,])")


@lru_cache(maxsize=1000)
def _zone(name: str) -> ZoneInfo | None:
    try:
        return ZoneInfo("/".join("_".join(w.capitalize() for w in part.split("_")) for part in name.split("/")) if "/" in name and name.islower() else name)
    except Exception:  # noqa: BLE001 - an unknown zone is no zone
        return None


def _micros(local: datetime, micro: int, zone) -> int | None:
    """zone: minutes from UTC or a region. A local time that occurs twice is the earlier instant; a skipped one keeps the offset before the change."""
    try:
        if isinstance(zone, int):
            at = local.replace(tzinfo=timezone.utc) - timedelta(minutes=zone)
        else:
            at = local.replace(tzinfo=zone, fold=0).astimezone(timezone.utc)
    except (OverflowError, ValueError):
        return None
    gap = at - _EPOCH
    return (gap.days * 86_400 + gap.seconds) * 1_000_000 + micro


def _year(text: str) -> int:
    n = int(text)
    return n if len(text) > 2 else n + (2000 if n < 69 else 1900)


def _unix(text: str) -> int | None:
    """Unix times in seconds, milli-, micro- or nanoseconds, told apart by their size."""
    whole, _, part = text.lstrip("+").partition(".")
    n, size = int(whole), len(whole.lstrip("+-"))
    if size > 19:
        return None
    if size <= 11:
        sign = -1 if whole.startswith("-") else 1
        return n * 1_000_000 + sign * int((part + "000000")[:6] or 0)
    return n * 1000 if size <= 14 else n if size <= 17 else n // 1000


def readings(text: str | None, home: str | None) -> tuple[str, dict[str, tuple[int, int]]]:
    """(layout, {order: (UTC microseconds, year)}) of a text; home: the zone of its source, null for UTC.

    The layout is empty for a text with one possible order, which is then called 'x'; no reading
    means that the text names no existing date.
    """
    if text is None:
        return "", {}
    low = unicodedata.normalize("NFKD", text.strip().lower())
    low = " ".join("".join(c for c in low if not unicodedata.combining(c)).split())
    if not low or not any(c.isdigit() for c in low):
        return "", {}
    if _NUMBER.match(low):
        at = _unix(low)
        year = 1970 + round((at or 0) / 3.15576e13 - 0.5)
        return "", {} if at is None or not 1 <= year <= 9999 else {"x": (at, year)}
    low = _WEEKDAY.sub("", low)
    layout, dates, rest = "", [], ""
    if m := _COMPACT.match(low):
        y, mo, d, h, mi, s, f, z = m.groups()
        dates, rest = [("x", int(y), int(mo), int(d))], f"t{h}:{mi}:{s or '00'}" + (f".{f}" if f else "") + (z or "")
    elif m := _DIGITS.match(low):
        a, sep, b, c = m.groups()
        rest = low[m.end() :]
        if len(a) == 4:
            dates = [("x", int(a), int(b), int(c))] if len(c) <= 2 else []
        else:
            layout = sep + ("y" if len(c) == 4 else "n")
            dates = [("dmy", _year(c), int(b), int(a)), ("mdy", _year(c), int(a), int(b))]
            if len(c) <= 2:
                dates.append(("ymd", _year(a), int(b), int(c)))
    elif m := _DAY_FIRST.match(low):
        d, _, name, y = m.groups()
        rest, n = low[m.end() :], _MONTH.get(name, 0)
        if len(y) == 4:
            dates = [("x", int(y), n, int(d))]
        else:
            layout = "m"
            dates = [("dmy", _year(y), n, int(d)), ("ymd", _year(d), n, int(y))]
    elif m := _MONTH_FIRST.match(low):
        name, d, y = m.groups()
        dates, rest = [("x", int(y), _MONTH.get(name, 0), int(d))], low[m.end() :]
    elif m := _YEAR_FIRST.match(low):
        y, name, d = m.groups()
        dates, rest = [("x", int(y), _MONTH.get(name, 0), int(d))], low[m.end() :]
    t = _TIME.match(rest)
    if not dates or not t:
        return "", {}
    hour, minute, second = int(t["h"] or 0), int(t["m"] or 0), int(t["s"] or 0)
    if t["half"]:
        if not 1 <= hour <= 12:
            return "", {}
        hour = hour % 12 + 12 * t["half"].startswith("p")
    micro = int((t["f"] or "0").ljust(6, "0")[:6])
    zone = _zone(home or "UTC") or 0
    word = (t["zone"] or "").rstrip(".").strip()
    if word and not t["h"]:
        return "", {}
    if word:
        m = re.match(r"^(?:utc|gmt)?\s*([+-])(\d{1,2}):?(\d{2})?$", word)
        if m:
            zone = (int(m[2]) * 60 + int(m[3] or 0)) * (-1 if m[1] == "-" else 1)
        elif word in _ABBREVIATIONS:
            zone = _ABBREVIATIONS[word]
        elif word in _REGIONS:
            zone = _zone(_REGIONS[word])
        else:
            zone = _zone(word) if "/" in word else None
    elif t["region"]:
        zone = _zone(t["region"])
    if zone is None:
        return "", {}
    found = {}
    for order, y, mo, d in dates:
        try:
            at = _micros(datetime(y, mo, d, hour, minute, second), micro, zone)
        except ValueError:
            continue
        if at is not None:
            found[order] = (at, y)
    return layout, found
