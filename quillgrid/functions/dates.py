"""Dates of feeds and sitemaps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_datetime(text: Column) -> Column:
    """ISO-8601 or RFC-822 text as a UTC timestamp; null for anything else."""
    t = F.trim(text)
    iso = F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}"), F.try_to_timestamp(t))
    bare = F.regexp_replace(t, r"^[A-Za-z]{3},\s*", "")
    bare = F.regexp_replace(bare, r"\b(?:UT|GMT|UTC|Z)$", "+0000")
    rfc = F.coalesce(*[F.try_to_timestamp(bare, F.lit(f)) for f in ("d MMM yyyy HH:mm:ss Z", "d MMM yyyy HH:mm:ss z", "d MMM yyyy HH:mm Z", "d MMM yyyy HH:mm:ss")])
    return F.coalesce(iso, F.when(bare.rlike(r"^\d{1,2} [A-Za-z]{3} \d{4}"), rfc))


def iso_datetime(at: Column) -> Column:
    return F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def hours(n: Column) -> Column:
    return F.make_dt_interval(F.lit(0), n)


def cooldown_until(now: Column, n: int = 6) -> Column:
    return now + F.make_dt_interval(F.lit(0), F.lit(n))
