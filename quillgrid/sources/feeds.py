"""Feeds and sitemaps as rows: payload text to entries, with the XML parser of the JVM (``from_xml``).

Elements are told by local name, whatever their namespace prefix and case. A payload that is not
well-formed, a truncated one for example, or has another root, gives no rows. Character references
and CDATA are resolved by the parser.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillgrid.functions.dates import parse_datetime

_TEXTS = "array<string>"
_ITEM = f"array<struct<link:array<struct<_VALUE:string,_href:string,_rel:string>>,title:{_TEXTS},description:{_TEXTS},summary:{_TEXTS},content:{_TEXTS},encoded:{_TEXTS},when:{_TEXTS},text:{_TEXTS}>>"
_FEED = f"struct<channel:array<struct<item:{_ITEM}>>,item:{_ITEM},entry:{_ITEM},_corrupt_record:string>"
_PLACE = f"array<struct<loc:{_TEXTS},lastmod:{_TEXTS}>>"
_SITEMAP = f"struct<url:{_PLACE},sitemap:{_PLACE},_corrupt_record:string>"
_OPTIONS = {"ignoreNamespace": "true", "mode": "PERMISSIVE"}
_PROLOG = r"(?s)^\s*(?:<\?.*?\?>\s*|<!--.*?-->\s*|<!DOCTYPE[^>]*>\s*)*"
#: By root: the elements that may hold the description and the date of an entry.
_DESCRIPTIONS = {"feed": "summary|content", "rdf": "description|encoded", "rss": "description|summary"}
_DATES = {"feed": "updated|published", "rdf": "pubDate|updated|date", "rss": "pubDate|updated|date"}


def root_of(xml: Column) -> Column:
    """The local name of the root element in lower case."""
    return F.lower(F.regexp_extract(xml, _PROLOG + r"<(?:[\w.\-]+:)?([\w.\-]+)", 1))


def _renamed(xml: Column, tags: str, name: str) -> Column:
    """Elements of several names under one name, so that the parser keeps their order."""
    return F.regexp_replace(xml, rf"(?i)<(/?)(?:[\w.\-]+:)?(?:{tags})(?=[\s/>])", f"<$1{name}")


def _first(values: Column) -> Column:
    """The text of the first of some elements, '' where there is none."""
    return F.trim(F.coalesce(F.get(values, F.lit(0)), F.lit("")))


def _link(links: Column) -> Column:
    """Of the links of an Atom entry the first with an address and no other relation than 'alternate', or with a text."""
    told = F.transform(links, lambda x: F.when((F.coalesce(x["_href"], F.lit("")) != "") & F.coalesce(x["_rel"], F.lit("")).isin("", "alternate"), F.trim(x["_href"])).otherwise(F.trim(F.coalesce(x["_VALUE"], F.lit("")))))
    return F.coalesce(F.get(F.filter(told, lambda x: x != ""), F.lit(0)), F.lit(""))


def feed_entries(payloads: DataFrame, body: str = "body") -> DataFrame:
    """The payload's columns with (kind, pos, url, title, description, published_at) for each entry of an RSS 2.0, Atom or RSS 1.0 feed.

    url, title, description and date are each the text of the first element, in document order, of
    those that may hold it; so an item whose first link has no text has no address. A date that cannot
    be read is null. Entries without an address are dropped. Descriptions that quote in CDATA an
    element of the other name are looked up by name instead of by order.
    """
    root = F.col("__root")
    known = payloads.withColumn("__root", root_of(F.col(body))).where(root.isin(*_DATES))
    xml, quoted = F.col(body), rf"(?is)<!\[CDATA\[(?:(?!\]\]>).)*<(?:{'|'.join(sorted(set('|'.join(_DESCRIPTIONS.values()).split('|'))))})[\s/>]"
    one = F.when(root == "feed", _renamed(_renamed(xml, _DATES["feed"], "when"), _DESCRIPTIONS["feed"], "text"))
    one = one.when(root == "rdf", _renamed(_renamed(xml, _DATES["rdf"], "when"), _DESCRIPTIONS["rdf"], "text")).otherwise(_renamed(_renamed(xml, _DATES["rss"], "when"), _DESCRIPTIONS["rss"], "text"))
    plain = _renamed(xml, "|".join(sorted({*_DATES["feed"].split("|"), *_DATES["rss"].split("|")})), "when")
    parsed = known.withColumn("__x", F.from_xml(F.when(xml.rlike(quoted), plain).otherwise(one), _FEED, _OPTIONS)).where("__x._corrupt_record is null")
    items = F.when(root == "feed", F.col("__x.entry")).when(root == "rdf", F.col("__x.item")).otherwise(F.get(F.col("__x.channel"), F.lit(0))["item"])
    rows = parsed.select(*payloads.columns, F.replace(root, F.lit("feed"), F.lit("atom")).alias("kind"), F.posexplode(items).alias("pos", "__e"))
    e, atom = F.col("__e"), F.col("kind") == "atom"
    url = F.when(atom, _link(e["link"])).otherwise(F.trim(F.coalesce(F.get(e["link"], F.lit(0))["_VALUE"], F.lit(""))))
    named = F.when(atom, F.coalesce(e["summary"], e["content"])).when(F.col("kind") == "rdf", F.coalesce(e["description"], e["encoded"])).otherwise(F.coalesce(e["description"], e["summary"]))
    made = rows.select(*payloads.columns, "kind", "pos", url.alias("url"), _first(e["title"]).alias("title"), _first(F.coalesce(e["text"], named)).alias("description"), parse_datetime(_first(e["when"])).alias("published_at"))
    return made.where("url <> ''")


def sitemap_entries(payloads: DataFrame, body: str = "body") -> DataFrame:
    """The payload's columns with (pos, url, published_at, is_sitemap) for each entry of a urlset or sitemapindex; entries without loc are dropped."""
    index = root_of(F.col(body)) == "sitemapindex"
    parsed = payloads.select("*", index.alias("is_sitemap"), F.from_xml(body, _SITEMAP, _OPTIONS).alias("__x")).where("__x._corrupt_record is null")
    rows = parsed.select(*payloads.columns, "is_sitemap", F.posexplode(F.when(F.col("is_sitemap"), F.col("__x.sitemap")).otherwise(F.col("__x.url"))).alias("pos", "__e"))
    e = F.col("__e")
    made = rows.select(*payloads.columns, "pos", _first(e["loc"]).alias("url"), parse_datetime(_first(e["lastmod"])).alias("published_at"), "is_sitemap")
    return made.where("url <> ''")


def expand_sitemaps(payloads: DataFrame, url: str = "request_url", body: str = "body") -> DataFrame:
    """Entries of all sitemaps; an index is followed to the payloads of its children, one level deep."""
    entries = sitemap_entries(payloads, body)
    leaves = entries.where("not is_sitemap")
    children = entries.where("is_sitemap").select(F.col("url").alias("__child")).distinct()
    nested = payloads.join(children, F.col(url) == F.col("__child")).drop("__child")
    again = sitemap_entries(nested, body).where("not is_sitemap")
    return leaves.unionByName(again).dropDuplicates([url, "pos", "url"])


def monthly_sitemaps(sources: DataFrame, pattern: str, day: Column, months: int = 4) -> DataFrame:
    """A row for each of the last months (the current one last): pattern has '{y}' and '{m}'."""
    first = F.trunc(day, "MM")
    span = F.sequence(F.add_months(first, -(max(1, months) - 1)), first, F.expr("interval 1 month"))
    month = F.col("month")
    return sources.select("*", F.explode(span).alias("month")).withColumn("sitemap_url", F.replace(F.replace(F.lit(pattern), F.lit("{y}"), F.date_format(month, "yyyy")), F.lit("{m}"), F.date_format(month, "MM")))
