"""Problem 5: template residue and error-page text.

The operator compares the terms of each page's address slug, title, heading and body.

* A page is *matched* when its heading shares half of the terms of slug and title, or its body a
  fifth; what stands in quotation marks or brackets does not count as body, because messages quote
  the title of the page that they could not show. All other pages are candidates: a response that was
  given in place of the page looks like this, and so do some stories with a fanciful title.
* The two kinds of pages are compared over the whole corpus: each word gets the odds of standing in a
  candidate rather than in a matched page. A response is low in information: its words are few, are
  the same on every page that got it, and stand in hardly any story. A candidate is flagged when the
  evidence of its words, as far as *other* candidates have them, together with the prior odds of a
  candidate at its host, is over even odds. No list of messages and no bound on lengths or copies
  takes part.
* Detectors find what stands inside a field that is otherwise fine: unfilled placeholders, notices
  that scripts are needed, pseudo-Latin and, with ``messages``, lines that are well-known messages.
  They alone judge the notes, which have no address to compare with.

Plan: one scan in Python gives each page its words as hashes; counting them is one aggregation with
a map-side combine; only the candidates' words are joined to the counts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillgrid.llm.boilerplate import annotate
from quillgrid.llm.furniture import has_message
from quillgrid.llm.near_duplicates import word_hash
from quillgrid.llm.residue import has_placeholder, is_filler, is_message, is_script_notice
from quillgrid.runtime import as_table

#: Shares of the terms of slug and title that the heading or the body of a matched page holds.
HEADING_MATCH, BODY_MATCH = 0.5, 0.2
#: Pseudo-count of a word in either kind of pages.
FLAT = 0.5

_WORD = re.compile(r"[^\W\d_]+")
_QUOTED = re.compile(r'"[^"]*"|“[^”]*”|„[^“]*“|«[^»]*»|\([^()]*\)')


def terms(text: str | None) -> set[str]:
    return {w for w in _WORD.findall((text or "").lower()) if len(w) > 3}


def slug(url: str | None) -> str:
    """The words of the last part of an address."""
    path = re.sub(r"^[a-z]+://[^/]*", "", (url or "").split("?")[0].split("#")[0].lower())
    parts = [x for x in path.split("/") if x]
    return re.sub(r"\.[a-z]{2,5}$", "", parts[-1]).replace("-", " ").replace("_", " ") if parts else ""


def is_residue(text: str | None, messages: bool = True) -> bool:
    """The detectors alone, over each line of a field; null, empty and blank fields are no case."""
    if not text or not text.strip():
        return False
    lines = text.split("\n")
    return has_placeholder(text) or (has_message(lines) if messages else any(is_script_notice(x) or is_filler(x) for x in lines))


def compare(story: list[str], title: str | None, url: str | None) -> tuple[bool, set[str]]:
    """(is the page a candidate, the words to judge it by) from the lines of its story, its title and its address."""
    headings = [x for x in map(str.strip, story) if x.startswith("# ")]
    known = terms(title) | terms(slug(url))
    body = set(_WORD.findall(_QUOTED.sub(" ", "\n".join(x for x in story if not x.strip().startswith("# "))).lower()))
    head = set(_WORD.findall("\n".join(headings).lower()))
    named = bool(known) and len(known & head) >= HEADING_MATCH * len(known)
    spoken = bool(known) and len(known & body) >= BODY_MATCH * len(known)
    return not (named or spoken), body if named else body | head


def _hashes(words: set[str]) -> np.ndarray:
    return np.fromiter(map(word_hash.__getitem__, words), np.uint64, len(words)).view(np.int64)


def _judge(messages: bool):
    def judge(lines: list[str], flags: list[bool], suspects: list[str], host: str | None, title: str | None, url: str | None) -> tuple:
        """(host, flagged by a detector, candidate, hashes of the words)."""
        story = [x for x, bad in zip(lines, flags) if not bad and x.strip()]
        if not story:
            return host, False, False, None
        found = has_placeholder("\n".join(lines)) or any(is_message(x) if messages else is_script_notice(x) or is_filler(x) for x in suspects)
        candidate, words = compare(story, title, url)
        return host, found, candidate, _hashes(words)

    return judge


def judged_pages(articles: DataFrame, key: str = "id", host: str = "source_id", text: str = "raw_markdown", title: str = "title", url: str = "url", messages: bool = True) -> DataFrame:
    """(page_id, host, detected, candidate, words) of the pages that have a story, as a table."""
    schema = T.StructType([T.StructField("host", T.StringType()), T.StructField("detected", T.BooleanType()), T.StructField("candidate", T.BooleanType()), T.StructField("words", T.ArrayType(T.LongType()))])
    return as_table(annotate(articles, _judge(messages), schema, key, host, text, (host, title, url), suspects=True).where("words is not null"), "judged")


def low_information(judged: DataFrame) -> DataFrame:
    """(page_id, odds): each candidate with the logarithm of its odds of being a response given in place of a page."""
    kinds = F.count_if("candidate").alias("c"), F.count_if(~F.col("candidate")).alias("m")
    pages = judged.agg(F.count_if("candidate").alias("all_c"), F.count_if(~F.col("candidate")).alias("all_m"))
    words = judged.select("candidate", F.explode("words").alias("word")).groupBy("word").agg(*kinds).where("c > 1")  # a word of one candidate says nothing about others
    # the page itself does not count as evidence for itself
    weight = F.log((F.col("c") - 1 + FLAT) / (F.col("all_c") + 1)) - F.log((F.col("m") + FLAT) / (F.col("all_m") + 1))
    known = as_table(words.join(pages).select("word", weight.alias("weight")), "evidence")
    prior = judged.groupBy(F.coalesce("host", F.lit("")).alias("host")).agg(*kinds).select("host", F.log((F.col("c") + FLAT) / (F.col("m") + FLAT)).alias("prior"))
    candidates = judged.where("candidate").select("page_id", F.coalesce("host", F.lit("")).alias("host"), "words")
    each = candidates.select("page_id", "host", F.explode("words").alias("word")).join(known, "word")
    told = each.groupBy("page_id", "host").agg(F.sum("weight").alias("told"))
    return told.join(prior, "host").select("page_id", (F.col("told") + F.col("prior")).alias("odds"))


def _notes(messages: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch[[is_residue(x, messages) for x in batch["notes"]]][["article_id"]]

    return run


def residue_fields(
    articles: DataFrame, key: str = "id", host: str = "source_id", text: str = "raw_markdown", notes: str = "analysis_notes", title: str = "title", url: str = "url", messages: bool = True
) -> DataFrame:
    """(article_id, field_name): the fields to exclude. Null, empty and blank fields, and pages of nothing but furniture, are no case.

    Pages without a title and with an address that says nothing are candidates, to be judged by their
    words alone. Repeated keys with the same text count as often as they come and are reported once.
    """
    judged = judged_pages(articles, key, host, text, title, url, messages)
    odd = low_information(judged).where("odds > 0").select(F.col("page_id").alias("article_id"))
    pages = judged.where("detected").select(F.col("page_id").alias("article_id")).unionByName(odd)
    id_type = articles.select(F.col(key).alias("article_id")).schema["article_id"].dataType.simpleString()
    noted = articles.select(F.col(key).alias("article_id"), F.col(notes).alias("notes")).where("notes is not null").mapInPandas(_notes(messages), f"article_id {id_type}")
    return pages.withColumn("field_name", F.lit("raw_markdown")).unionByName(noted.withColumn("field_name", F.lit("analysis_notes"))).distinct()
