"""Rules of known sources, as rows of a small dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillgrid.schemas import schema_of

# The rules of known sources; a source without one has an empty rule.
SOURCE_RULES = {
    "STAT News": {"include_regexes": [r"/20\d{2}/\d{2}/\d{2}/", r"/pharmalot/20\d{2}/\d{2}/\d{2}/"]},
    "BioPharma Dive": {"include_regexes": [r"/news/.+?/\d+/"]},
    "Nature Biotechnology": {"include_keywords": ["/articles/"], "include_regexes": [r"/articles/s\d{5}-\d{3}-\d{5}-[\w-]+$"]},
    "Fierce Biotech": {"include_keywords": ["/biotech/", "/research/"]},
    "GEN – Genetic Engineering & Biotechnology News": {
        "include_keywords": ["/news/"],
        "include_regexes": [r"/topics/[^/]+/.+"],
        "exclude_regexes": [r"/topics/[^/]+/$"],
        "non_article_exceptions": [r"/topics/[^/]+/.+"],
    },
    "Endpoints News": {
        "include_keywords": ["/202", "/news/", "/biotech/", "/pharma/"],
        "include_regexes": [r"^https?://(?:www\.)?endpoints\.news/(?:sp/)?[a-z0-9][^?#]+$"],
        "exclude_regexes": [r"endpoints\.news/(?:news|rss|feed|channel|about|events?|author|tag|category)(?:/|$)", r"endpoints\.news/topic-hub/", r"endpoints\.news/.+/page/\d+(?:/|$)"],
    },
    "BioCentury": {"include_keywords": ["/article/", "/biopharma/", "/business/"]},
    "SynBioBeta": {"include_keywords": ["/read/", "/article/"], "exclude_regexes": [r"^https?://(?:www\.)?synbiobeta\.com/?$"]},
    "arXiv Quantitative Biology": {"discovery_url": "https://arxiv.org/list/q-bio/new", "map_search": "abs", "sitemap": "skip", "include_keywords": ["/abs/"], "exclude_regexes": [r"/archive/", r"/list/"], "coarse_feed_timestamps": True},
    "bioRxiv": {"discovery_url": "https://www.biorxiv.org/content/early/recent", "map_search": "content/10.", "sitemap": "skip", "include_regexes": [r"/content/10\.\d{4,9}/"], "disable_stop_on_last_seen": True},
    "Science": {"discovery_url": "https://www.science.org/toc/science/current", "map_search": "doi", "sitemap": "skip", "include_keywords": ["/doi/"]},
}
# Refresh policy by class of source: enabled, window in days, cadence in hours, priority.
REFRESH_POLICY = {"preprint": (True, 30, 168, "high"), "journal": (True, 30, 720, "medium"), "news": (True, 7, 72, "medium")}


def rules_table(spark: SparkSession, rules: dict[str, dict] = SOURCE_RULES) -> DataFrame:
    """The rules as a table; lists that a rule lacks are empty, flags false."""
    schema = schema_of("source_rules")
    empty = {f.name: [] if f.dataType.simpleString().startswith("array") else False if f.dataType.simpleString() == "boolean" else None for f in schema.fields}
    return spark.createDataFrame([tuple((empty | rule | {"name": name})[f.name] for f in schema.fields) for name, rule in rules.items()], schema)


def with_rules(df: DataFrame, rules: DataFrame, name: str) -> DataFrame:
    """Rows with their source's rule columns; the empty rule where there is none."""
    lists = ["include_keywords", "include_regexes", "exclude_regexes", "non_article_exceptions"]
    joined = df.join(rules.withColumnRenamed("name", "__rule"), F.col(name) == F.col("__rule"), "left").drop("__rule")
    return joined.withColumns({c: F.coalesce(c, F.array().cast("array<string>")) for c in lists} | {c: F.coalesce(c, F.lit(False)) for c in ("disable_stop_on_last_seen", "coarse_feed_timestamps")})
