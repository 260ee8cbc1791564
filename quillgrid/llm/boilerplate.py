"""Problem 6: main content of pages, by removal of site templates.

Method: *site template removal*. A page is an element tree: its blocks are lines (headings, labels,
paragraphs, items), and a line that is followed by list items owns them. Each element is hashed with
its *slots* left out: what a template fills anew on every page, that is runs of digits, links within
the site, hash tags and the tail of a breadcrumb; and a list below a label is a slot of the label's
subtree. The hashes are counted per host in Spark. An element whose hash recurs on ``MIN_PAGES``
pages of its host is deleted; where nine in ten of a recurring element's pages show it with a list
below, the whole subtree is deleted, whatever the items say. The threshold is a number of pages
and the same for hosts of any size; versions of one story within a host stay under it. Pages that are
nothing but a message (no title, and a line that is one) are not counted.

Free text that the page wraps around the story and words anew each time (reader comments,
advertisements, event notes) has no recurring hash of any kind; such elements are recognised by
their form (:mod:`quillgrid.llm.furniture`), which ``forms=False`` switches off.

Plan: one scan hashes the elements and adds up (host, hash) first within each batch, then in one
aggregation; the hashes above the threshold are written as one small row per host, since what a site
repeats is its template, which is small. A second scan joins that row to the pages by host: Catalyst
broadcasts the table when its file size is under the session's threshold and shuffles otherwise,
where AQE splits a hot host. Hashing the elements anew in this scan is cheaper than moving hashes.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillgrid.llm.furniture import elements, is_response, page_flags, squeeze
from quillgrid.runtime import as_table

#: A template is on at least this many pages of its host.
MIN_PAGES = 8
#: The share of the pages with an element that must show it with a list below, for the list to belong to it.
OWNS = 0.9
#: Hosts whose templates a worker keeps at hand.
MAX_SITES = 1_000

def _count_elements(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows (tpl_host, h, n, with_list): the pages of a batch with an element, and with a list below it; already added up by batch."""
    for batch in batches:
        n, with_list = defaultdict(Counter), defaultdict(Counter)
        for host, value in zip(batch["tpl_host"], batch["text"]):
            lines = [squeeze(x) for x in value.split("\n")]
            if is_response(lines):
                continue
            hashes, owning = elements(lines, [x.lower() for x in lines])
            n[host].update(set(hashes))
            with_list[host].update({h for h, o in zip(hashes, owning) if o})
        rows = [(host, h, k, with_list[host][h]) for host, counts in n.items() for h, k in counts.items() if h]
        yield pd.DataFrame(rows, columns=["tpl_host", "h", "n", "with_list"])


def site_templates(pages: DataFrame, host: str = "host", text: str = "text", min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, templates array<long>, owners array<long>): the element hashes that recur on a host, and those of them that own a list. A null host is one host of its own."""
    usable = pages.where(F.col(text).isNotNull()).select(F.coalesce(F.col(host), F.lit("")).alias("tpl_host"), F.col(text).alias("text"))
    each = usable.mapInPandas(_count_elements, "tpl_host string, h long, n long, with_list long")
    counts = each.groupBy("tpl_host", "h").agg(F.sum("n").alias("n"), F.sum("with_list").alias("with_list")).where(F.col("n") >= min_pages)
    return counts.groupBy("tpl_host").agg(F.collect_list("h").alias("templates"), F.collect_list(F.when(F.col("with_list") >= OWNS * F.col("n"), F.col("h"))).alias("owners"))


def annotate(pages: DataFrame, row: Callable[..., tuple], schema: T.StructType, key: str, host: str, text: str, extra: tuple[str, ...] = (), suspects: bool = False, forms: bool = True) -> DataFrame:
    """For each page, the key as ``page_id`` and what ``row(lines, flags, *extra)`` makes of its lines, furniture flags and extra columns.

    Null texts give ``row([], [], ...)``. With ``suspects`` the row function also gets, before the
    extra columns, the lines of the story that may be messages. ``row`` runs in Python workers on Arrow batches.
    """
    more = [f"extra_{i}" for i in range(len(extra))]
    base = pages.select(F.col(key).alias("page_id"), F.coalesce(F.col(host), F.lit("")).alias("tpl_host"), F.col(text).alias("text"), *[F.col(x).alias(y) for x, y in zip(extra, more)])
    templates = as_table(site_templates(base, "tpl_host", "text"), "templates")
    ready = base.join(templates, "tpl_host", "left").select("page_id", "tpl_host", "text", *more, "templates", "owners")
    names = schema.fieldNames()
    out = T.StructType([base.schema["page_id"], *schema.fields])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sites: dict[str, tuple] = {}
        for batch in batches:
            made = []
            for at, (site, value, *rest) in enumerate(zip(batch["tpl_host"], batch["text"], *[batch[x] for x in more])):
                known = sites.get(site)
                if known is None:
                    if len(sites) > MAX_SITES:
                        sites.clear()
                    known = sites[site] = tuple(frozenset(() if x is None else x.tolist()) for x in (batch["templates"].iat[at], batch["owners"].iat[at]))
                lines = [] if value is None else value.split("\n")
                flags, told = page_flags(lines, *known, forms)
                made.append(row(lines, flags, told, *rest) if suspects else row(lines, flags, *rest))
            result = pd.DataFrame(made, columns=names, dtype=object)
            result.insert(0, "page_id", batch["page_id"].to_numpy())
            yield result

    return ready.mapInPandas(run, out)


def _body(lines: list[str], flags: list[bool]) -> tuple:
    kept = [x for x, bad in zip(lines, flags) if not bad]
    return "\n".join(kept) if lines else None, [i + 1 for i, bad in enumerate(flags) if bad]


def main_content(pages: DataFrame, key: str = "id", host: str = "source_id", text: str = "raw_markdown") -> DataFrame:
    """(page_id, body, removed): the page without furniture, and the numbers (from 1) of the lines removed.

    Null text: null body, nothing removed. Empty text: empty body. Repeated keys give a row each;
    blank lines stay. Other columns of ``pages`` are not read.
    """
    schema = T.StructType([T.StructField("body", T.StringType()), T.StructField("removed", T.ArrayType(T.IntegerType()))])
    return annotate(pages, _body, schema, key, host, text)


def furniture_lines(pages: DataFrame, key: str = "id", host: str = "source_id", text: str = "raw_markdown", forms: bool = True) -> DataFrame:
    """(article_id, line_no): each non-blank line that is furniture."""
    schema = T.StructType([T.StructField("removed", T.ArrayType(T.IntegerType()))])
    found = annotate(pages, lambda lines, flags: ([i + 1 for i, bad in enumerate(flags) if bad],), schema, key, host, text, forms=forms)
    return found.select(F.col("page_id").alias("article_id"), F.explode("removed").alias("line_no"))
