"""Anchors of listing pages, and the walk through their pages."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quillgrid.functions.score import is_next_link
from quillgrid.functions.url import host_of, join_url, same_domain

_MARKDOWN_LINK = r"\[([^\[\]]*)\]\(([^()\s]+)\)"


class _Anchors(HTMLParser):
    """Closed anchors in order; a new start drops an open one."""

    def __init__(self, most: int):
        super().__init__(convert_charrefs=True)
        self.most, self.found, self.open, self.text = most, [], None, []

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            a = dict(attrs)
            self.open, self.text = (a.get("href") or "", a.get("rel") or ""), []

    def handle_data(self, data):
        if self.open is not None:
            self.text.append(data)

    def handle_endtag(self, tag):
        if tag == "a" and self.open is not None:
            if len(self.found) < self.most:
                self.found.append((self.open[0], "".join(self.text).strip(), self.open[1]))
            self.open = None


def html_anchors(pages: DataFrame, key: str, html: str, most: int = 250) -> DataFrame:
    """(key, pos, href, text, rel) of each anchor, with a real parser in Arrow batches. Null pages have none."""
    base = pages.select(F.col(key).alias("key"), F.col(html).alias("html")).where("html is not null")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for k, text in zip(batch["key"], batch["html"]):
                parser = _Anchors(most)
                parser.feed(text)
                rows += [(k, n, *a) for n, a in enumerate(parser.found)]
            yield pd.DataFrame(rows, columns=["key", "pos", "href", "text", "rel"])

    kind = base.schema["key"].dataType.simpleString()
    return base.mapInPandas(run, f"key {kind}, pos int, href string, text string, rel string").withColumnRenamed("key", key)


def markdown_anchors(pages: DataFrame, key: str, text: str, most: int = 250, carry: tuple[str, ...] = ()) -> DataFrame:
    """(key, carried columns, pos, href, text) of each link of a markdown page, JVM-side."""
    found = F.slice(F.regexp_extract_all(F.col(text), F.lit(_MARKDOWN_LINK), F.lit(0)), 1, most)
    rows = pages.select(key, *carry, F.posexplode(found).alias("pos", "__a"))
    return rows.select(key, *carry, "pos", F.regexp_extract("__a", _MARKDOWN_LINK, 2).alias("href"), F.trim(F.regexp_extract("__a", _MARKDOWN_LINK, 1)).alias("text"))


def site_links(anchors: DataFrame, base_url: str, href: str = "href", dots: bool = False) -> DataFrame:
    """Anchors of a site itself: with ``url`` resolved against the page, those on the page's domain or below it."""
    joined = anchors.withColumn("url", join_url(F.col(base_url), F.col(href), dots))
    return joined.where(same_domain(host_of(F.col("url")), host_of(F.col(base_url))))


def next_pages(anchors: DataFrame, base_url: str) -> DataFrame:
    """(page_url, next_url): the first anchor of each page, known by its address, that leads to the next one. anchors: (base_url, pos, href, text[, rel])."""
    hit = anchors.where(is_next_link(F.col("text"), F.col("rel") if "rel" in anchors.columns else F.lit("")))
    first = hit.groupBy(F.col(base_url).alias("page_url")).agg(F.min_by("href", "pos").alias("href"))
    return first.select("page_url", join_url(F.col("page_url"), F.col("href")).alias("next_url"))


def walk_pages(start: DataFrame, pages: DataFrame, following: DataFrame, most: int = 3) -> DataFrame:
    """(target, page_url, step) from a first address over at most ``most`` pages. start: (target, page_url); pages: (page_url); following: (page_url, next_url)."""
    now = start.join(pages.select("page_url").distinct(), "page_url", "left_semi").select("target", "page_url", F.lit(1).alias("step"))
    found = now
    for step in range(2, most + 1):
        now = now.join(following, "page_url").select("target", F.col("next_url").alias("page_url"), F.lit(step).alias("step"))
        now = now.join(pages.select("page_url").distinct(), "page_url", "left_semi")
        found = found.unionByName(now)
    return found


def before_last_seen(anchors: DataFrame, target: str, url: str, pos: str, last_seen: str, least: int = 10, limit: int = 15, disabled: str | None = None) -> DataFrame:
    """Anchors in document order until the one last seen, at most max(least, 3 * limit) for each target.

    The cut is one aggregate and one ranking over the target; no page is walked on the driver. With
    ``disabled`` (a boolean column) a source never stops there.
    """
    w = Window.partitionBy(target)
    hit = F.min(F.when(F.col(url) == F.col(last_seen), F.col(pos))).over(w)
    stop = F.when(F.col(disabled), F.lit(None)).otherwise(hit) if disabled else hit
    kept = anchors.withColumn("__stop", stop).where(F.col("__stop").isNull() | (F.col(pos) < F.col("__stop"))).drop("__stop")
    return kept.withColumn("rank", F.row_number().over(w.orderBy(pos))).where(F.col("rank") <= max(least, 3 * limit))
