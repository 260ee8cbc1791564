"""Entity names, types and tags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillgrid.functions.text import strip

# Name endings, stripped once each in this order; those in DOTTED may end in a point.
SUFFIXES = ("inc", "corp", "corporation", "ltd", "limited", "llc", "plc", "company", "co", "incorporated", "ag", "sa", "gmbh", "kk")
DOTTED = frozenset({"inc", "corp", "ltd", "co", "llc", "plc"})
ENTITY_TYPES = ("company", "person", "drug", "technology", "deal")
PRIORITY_RANK = {"high": 3, "medium": 2, "low": 1}


def canonical_name(name: Column) -> Column:
    """Lower-cased name without endings; not word-bounded and single-pass, so 'cisco' gives 'cis'."""
    s = F.lower(strip(F.coalesce(name, F.lit(""))))
    for suffix in SUFFIXES:
        s = F.regexp_replace(s, r",?\s*" + suffix + (r"\.?" if suffix in DOTTED else "") + "$", "")
    return F.trim(F.regexp_replace(F.regexp_replace(s, r"[.,;: ]+$", ""), r"(?U)\s+", " "))


def backfilled_name(name: Column) -> Column:
    """The simpler form that a migration fills in."""
    return F.lower(F.trim(name))


def sanitize_entities(entities: Column, keep_unknown: bool = False) -> Column:
    """array<struct<name,entity_type>>: names trimmed, blank ones dropped, unknown types 'company' unless kept; order kept."""
    kind = lambda e: F.lower(F.trim(F.coalesce(e["entity_type"], F.lit(""))))
    made = F.transform(
        entities,
        lambda e: F.struct(strip(e["name"]).alias("name"), (kind(e) if keep_unknown else F.when(kind(e).isin(*ENTITY_TYPES), kind(e)).otherwise("company")).alias("entity_type")),
    )
    return F.coalesce(F.filter(made, lambda e: e["name"].isNotNull() & (e["name"] != "")), F.array().cast("array<struct<name:string,entity_type:string>>"))


def tags_of(text: Column) -> Column:
    """A JSON list of tags, or one tag that is no list; null and blank give an empty list."""
    t = strip(text)
    return F.when(t.isNull() | (t == ""), F.array().cast("array<string>")).when(F.startswith(t, F.lit("[")), F.coalesce(F.from_json(t, "array<string>"), F.array(t))).otherwise(F.array(t))


def priority_rank(priority: Column) -> Column:
    return F.when(priority == "high", 3).when(priority == "low", 1).otherwise(2)


def fingerprint(version: str, model: Column, content_hash: Column, analysis_type: str = "standard", temperature: float = 0.3) -> Column:
    return F.struct(
        F.lit(version).alias("prompt_template_version"), model.alias("model"), F.lit(temperature).alias("temperature"), content_hash.alias("content_hash"), F.lit(analysis_type).alias("analysis_type")
    )


def invalidation(old: Column, new: Column) -> Column:
    """'must' when the content changed, 'may' when prompt or model changed, else 'no'."""
    differs = lambda f: ~old[f].eqNullSafe(new[f])
    return F.when(differs("content_hash"), "must").when(differs("prompt_template_version") | differs("model"), "may").otherwise("no")
