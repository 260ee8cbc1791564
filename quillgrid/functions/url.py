"""Address functions: Column to Column, no UDF but for dot segments."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Query parameters that only track.
TRACKING = ("utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "utm_id", "fbclid", "gclid", "mc_cid", "mc_eid", "ref", "source")
_SPLIT = r"^([A-Za-z][A-Za-z0-9+.\-]*)://([^/?#]*)([^?#]*)(?:\?([^#]*))?(?:#.*)?$"


def normalize_url(url: Column) -> Column:
    """Lower-case scheme and host, without user, default port, fragment and tracking parameters; text without scheme or host only trimmed; null gives ''."""
    s = F.trim(F.coalesce(url, F.lit("")))
    scheme = F.lower(F.regexp_extract(s, _SPLIT, 1))
    authority = F.regexp_replace(F.lower(F.regexp_extract(s, _SPLIT, 2)), "^.*@", "")
    host = F.regexp_replace(authority, r":\d*$", "")
    port = F.regexp_extract(authority, r":(\d+)$", 1)
    path = F.regexp_extract(s, _SPLIT, 3)
    parts = F.filter(F.split(F.regexp_extract(s, _SPLIT, 4), "&"), lambda p: p != "")
    pairs = F.transform(parts, lambda p: F.struct(_form(F.substring_index(p, "=", 1)).alias("k"), _form(F.when(F.contains(p, F.lit("=")), F.regexp_replace(p, "^[^=]*=", "")).otherwise("")).alias("v")))
    kept = F.filter(pairs, lambda p: ~F.lower(p["k"]).isin(*TRACKING))
    query = F.array_join(F.transform(kept, lambda p: F.concat(p["k"], F.lit("="), p["v"])), "&")
    default = (port == "") | (port == "0") | ((scheme == "http") & (port == "80")) | ((scheme == "https") & (port == "443"))
    full = F.concat(
        scheme, F.lit("://"), host, F.when(default, "").otherwise(F.concat(F.lit(":"), port)), F.when(path == "", "/").otherwise(path), F.when(query == "", "").otherwise(F.concat(F.lit("?"), query))
    )
    return F.when((scheme == "") | (host == ""), s).otherwise(full)


def _form(part: Column) -> Column:
    """Decode and encode again, as forms do; '~' stays."""
    return F.replace(F.url_encode(F.coalesce(F.try_url_decode(part), part)), F.lit("%7E"), F.lit("~"))


def host_of(url: Column) -> Column:
    """The host in lower case without one leading 'www.'; port and user are kept."""
    return F.regexp_replace(F.lower(F.regexp_extract(F.trim(url), _SPLIT, 2)), r"^www\.", "")


def same_domain(candidate: Column, site: Column) -> Column:
    """Equal hosts, or a subdomain of the site's host."""
    return (candidate == site) | F.endswith(candidate, F.concat(F.lit("."), site))


def _resolved(base: Column, href: Column) -> Column:
    from urllib.parse import urljoin

    def one(b, h):
        try:
            return urljoin(b or "", h or "")
        except ValueError:
            return None

    # made when used: a UDF needs a session, which workers that import this module lack
    @F.pandas_udf("string")
    def resolve(base: pd.Series, href: pd.Series) -> pd.Series:
        return pd.Series([one(b, h) for b, h in zip(base, href)], dtype=object)

    return resolve(base, href)


def join_url(base: Column, href: Column, dots: bool = False) -> Column:
    """An anchor's address resolved against its page and normalized. ``dots``: resolve '.' and '..' segments too (in Python)."""
    if dots:
        return normalize_url(_resolved(base, href))
    h = F.trim(href)
    scheme = F.regexp_extract(base, r"^([A-Za-z][\w+.\-]*):", 1)
    root = F.regexp_extract(base, r"^([A-Za-z][\w+.\-]*://[^/?#]*)", 1)
    page = F.regexp_extract(base, r"^([^?#]*)", 1)
    folder = F.when(page == root, F.concat(root, F.lit("/"))).otherwise(F.regexp_replace(page, "[^/]*$", ""))
    joined = (
        F.when(h.rlike(r"^[A-Za-z][\w+.\-]*:"), h)
        .when(F.startswith(h, F.lit("//")), F.concat(scheme, F.lit(":"), h))
        .when(F.startswith(h, F.lit("/")), F.concat(root, h))
        .when(F.startswith(h, F.lit("?")), F.concat(page, h))
        .when(F.startswith(h, F.lit("#")) | (h == ""), F.concat(F.regexp_extract(base, "^([^#]*)", 1), h))
        .otherwise(F.concat(folder, h))
    )
    return normalize_url(joined)


def recency_key(url: Column) -> Column:
    """struct(y, m, d) of the first /20YY/MM(/DD)/ of an address, zeros where there is none; the day is 0 where it is missing."""
    part = lambda n: F.coalesce(F.regexp_extract(url, _DATED, n).try_cast("int"), F.lit(0))
    return F.struct(part(1).alias("y"), part(2).alias("m"), part(3).alias("d"))


_DATED = r"/(20\d{2})/(\d{2})(?:/(\d{2}))?/"


def published_from_url(url: Column) -> Column:
    """The UTC day that an address names; day 1 where it is missing, null where there is none or it does not exist."""
    y, m, d = (F.regexp_extract(url, _DATED, n) for n in (1, 2, 3))
    return F.when(y != "", F.try_make_timestamp(y.cast("int"), m.cast("int"), F.when(d == "", F.lit(1)).otherwise(d.try_cast("int")), F.lit(0), F.lit(0), F.lit(0)))


def any_match(text: Column, patterns: Column, pattern: bool = True) -> Column:
    """Does some element of an array of patterns (or of plain words) occur in the text? Null or empty arrays: no."""
    test = (lambda p: F.rlike(text, F.concat(F.lit("(?i)"), p))) if pattern else (lambda p: F.contains(text, F.lower(p)))
    return F.coalesce(F.exists(patterns, test), F.lit(False))


def first_true(*pairs: tuple[Column, str]) -> Column:
    """The label of the first condition that holds."""
    return reduce(lambda acc, p: acc.when(p[0], p[1]), pairs[1:], F.when(pairs[0][0], pairs[0][1]))
