"""Source manifests: reading and validation."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillgrid.schemas import schema_of

REQUIRED = ("name", "url", "domain", "source_type", "enabled", "crawl_frequency")
SURFACES = ("map", "rss", "sitemap")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a YAML manifest; a missing file is empty, rows without a name go, the last of a name stays. A manifest is configuration and read on the driver."""
    import yaml

    items: dict[str, dict] = {}
    if Path(path).exists():
        loaded = yaml.safe_load(Path(path).read_text()) or []
        rows = loaded.get("sources", []) if isinstance(loaded, dict) else loaded
        for item in rows:
            if isinstance(item, dict) and item.get("name"):
                items[str(item["name"])] = item
    schema = schema_of("manifest")
    return spark.createDataFrame([tuple(item.get(f.name) for f in schema.fields) for item in items.values()], schema)


def _absolute(url: Column) -> Column:
    return F.coalesce(url.rlike(r"^https?://[^/\s]+"), F.lit(False))


def manifest_errors(manifest: DataFrame, surfaces: tuple[str, ...] = SURFACES) -> DataFrame:
    """The manifest with ``errors``: one text for each rule that a row breaks, in rule order; a null counts as missing."""
    missing = F.filter(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in REQUIRED]), lambda x: x.isNotNull())
    surface = lambda c: F.when(F.col(c).isNotNull() & ~F.col(c).isin(*surfaces), F.concat(F.lit(f"{c} unknown: "), F.col(c)))
    repeated = manifest.groupBy("url").agg(F.count(F.lit(1)).alias("__n")).where("url is not null and __n > 1").select(F.col("url").alias("__url"))
    with_repeats = manifest.join(repeated, F.col("url") == F.col("__url"), "left")
    checks = F.array(
        F.when(F.size(missing) > 0, F.concat(F.lit("missing: "), F.array_join(missing, ","))),
        F.when(F.col("__url").isNotNull(), F.lit("url repeated")),
        surface("primary_discovery_surface"),
        surface("fallback_discovery_surface"),
        F.when(F.col("feed_url").isNotNull() & ~_absolute(F.col("feed_url")), F.lit("feed_url not absolute")),
        F.when((F.col("primary_discovery_surface") == "rss") & (F.coalesce("feed_url", F.lit("")) == ""), F.lit("rss without feed_url")),
        F.when(F.exists("sitemap_urls", lambda u: ~_absolute(u)), F.lit("sitemap_urls not absolute")),
    )
    return with_repeats.withColumn("errors", F.filter(checks, lambda x: x.isNotNull())).drop("__url")
