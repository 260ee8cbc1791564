"""Scores of links and the predicates behind them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillgrid.functions.url import any_match

# Parts of addresses that articles have.
ARTICLE_WORDS = ("/article/", "/articles/", "/news/", "/story/", "/stories/", "/post/", "/posts/", "/read/", "/abs/")
# Parts of addresses of pages that are no articles.
NON_ARTICLE = (
    r"/about(?:/|$)",
    r"/author(?:/|$)",
    r"/authors(?:/|$)",
    r"/staff(?:/|$)",
    r"/tag(?:/|$)",
    r"/category(?:/|$)",
    r"/categories(?:/|$)",
    r"/topics?(?:/|$)",
    r"/events?(?:/|$)",
    r"/jobs?(?:/|$)",
    r"/careers?(?:/|$)",
    r"/contact(?:/|$)",
    r"/privacy(?:/|$)",
    r"/terms(?:/|$)",
    r"/newsletter(?:/|$)",
    r"/subscribe(?:/|$)",
    r"/login(?:/|$)",
    r"/search(?:/|$)",
    r"/sitemap",
    r"/wp-json",
    r"/content/early/",
    r"\.xml$",
)
# Dated addresses, labels of links to the next page, words of feed addresses; the points and bonuses of the score below are fixed too.
DATED = r"/20\d{2}/\d{2}/(?:\d{2}/)?"
NEXT_LABELS = ("next", "next page", ">", ">>", "›", "→", "older", "older posts")


def is_non_article(url: Column, exceptions: Column, excludes: Column) -> Column:
    """No article: a general or a rule's exclusion matches, and none of the rule's exceptions."""
    general = url.rlike("(?i)" + "|".join(f"(?:{p})" for p in NON_ARTICLE))
    return ~any_match(url, exceptions) & (general | any_match(url, excludes))


def link_score(url: Column, title: Column, description: Column, mode: Column, keywords: Column, regexes: Column, excludes: Column, exceptions: Column, date_bonus: int = 4, feed_bonus: int = 6) -> Column:
    """The additive score of a link under its source's rule; null texts count as ''."""
    low = F.lower(url)
    t, d = F.trim(F.coalesce(title, F.lit(""))), F.trim(F.coalesce(description, F.lit("")))
    # the points of each sign
    has = lambda words: F.lit(False) if not words else _any(low, words)
    word, pattern = any_match(low, keywords, pattern=False), any_match(url, regexes)
    points = [
        (url.rlike(DATED), date_bonus),
        (has(ARTICLE_WORDS), 5),
        (word, 5),
        (pattern, 7),
        ((mode == "article_listing") & F.contains(low, F.lit("/articles/")), 4),
        ((mode == "rss_feed") & has(("/abs/", "/doi/", "/content/10.1101/")), feed_bonus),
        ((mode == "rss_feed") & ~(word | pattern), -20),
        (F.length(F.coalesce(title, F.lit(""))) >= 25, 2),
        (F.length(F.coalesce(description, F.lit(""))) >= 25, 1),
        (is_non_article(url, exceptions, excludes), -20),
        ((t == "") & (d == ""), -1),
    ]
    score = F.lit(0)
    for condition, value in points:
        score = score + F.when(condition, value).otherwise(0)
    return score


def _any(text: Column, words: tuple[str, ...]) -> Column:
    out = F.contains(text, F.lit(words[0]))
    for w in words[1:]:
        out = out | F.contains(text, F.lit(w))
    return out


def surface_bonus(surface: Column) -> Column:
    return F.when(surface == "rss", 4).when(surface == "category_page", 2).otherwise(0)


def is_next_link(text: Column, rel: Column) -> Column:
    """Does an anchor lead to the next page of a listing?"""
    t = F.lower(F.trim(F.coalesce(text, F.lit(""))))
    return t.isin(*NEXT_LABELS) | F.startswith(t, F.lit("next")) | F.contains(F.lower(F.coalesce(rel, F.lit(""))), F.lit("next"))
