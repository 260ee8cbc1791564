"""The steps of the incremental loop end to end, over tables: discover, write, merge. The command line runs them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillgrid.functions.entity import canonical_name
from quillgrid.functions.score import link_score, surface_bonus
from quillgrid.functions.url import normalize_url
from quillgrid.operators.discovery import first_by_url, rank_final
from quillgrid.operators.warehouse import add_links, dispositions, duplicate_groups, merge_entities, merge_summary, write_articles, write_entities
from quillgrid.rules import rules_table, with_rules
from quillgrid.schemas import conform
from quillgrid.sources.feeds import expand_sitemaps, feed_entries
from quillgrid.sources.html import html_anchors, site_links
from quillgrid.sources.jsonl import assign_entities
from quillgrid.sources.payloads import map_links

_ROW = ("source", "discovery_method", "url", "title", "description", "published_at")


def surface_rows(payloads: DataFrame) -> DataFrame:
    """(source, discovery_method, url, title, description, published_at) of fetched payloads (source, surface, request_url, body); failed ones have none."""
    good = payloads.where("error is null and body is not null").select("source", "surface", "request_url", "body")
    of = lambda s: good.where(F.col("surface") == s).withColumnRenamed("surface", "discovery_method")
    none = F.lit(None).cast("timestamp").alias("published_at")
    rss = feed_entries(of("rss")).select(*_ROW)
    sitemap = expand_sitemaps(of("sitemap")).select("source", "discovery_method", "url", F.lit("").alias("title"), F.lit("").alias("description"), "published_at")
    mapped = map_links(of("map")).select("source", "discovery_method", "url", "title", "description", none)
    pages = of("category_page").withColumn("page", F.concat_ws("\u0001", "source", "request_url"))
    anchors = html_anchors(pages, "page", "body").withColumns({"source": F.split("page", "\u0001", 2)[0], "base": F.split("page", "\u0001", 2)[1]})
    listed = site_links(anchors, "base", dots=True).select("source", F.lit("category_page").alias("discovery_method"), "url", F.col("text").alias("title"), F.lit("").alias("description"), none)
    return rss.unionByName(sitemap).unionByName(mapped).unionByName(listed)


def discover(payloads: DataFrame, sources: DataFrame, limit: int = 15, least: int = 4, rules: DataFrame | None = None) -> DataFrame:
    """The best candidates of each source (name, url, title, description, score, published_at, discovery_method, final_rank) from its payloads."""
    spark = payloads.sparkSession
    modes = sources.select(F.col("name").alias("source"), "extraction_mode")
    rows = surface_rows(payloads).withColumn("url", normalize_url(F.col("url"))).where("url <> ''").join(modes, "source")
    ruled = with_rules(rows, rules_table(spark) if rules is None else rules, "source")
    points = link_score(*[F.col(c) for c in ("url", "title", "description", "extraction_mode", "include_keywords", "include_regexes", "exclude_regexes", "non_article_exceptions")])
    scored = ruled.withColumn("score", points + surface_bonus(F.col("discovery_method"))).where(F.col("score") >= least)
    unique = first_by_url(scored, "source", "url", F.desc("score"), F.col("published_at").asc_nulls_last(), F.col("discovery_method"), F.col("title"), F.col("description"))
    return rank_final(unique, "source", limit).select(F.col("source").alias("name"), "url", "title", "description", "score", "published_at", "discovery_method", "final_rank")


def write(lines: DataFrame, tables: dict[str, DataFrame], source_id: str, run_id: str, now: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """(the new tables articles, entities and article_entities, a row of counts) from hand-off lines (file, line_no, line).

    Ids are derived from what they name, so that a repeated write changes nothing.
    """
    articles, entities, errors = assign_entities(lines, "title string, url string, summary string, priority_level string, lane string, content_hash string", "name string, entity_type string, role_in_article string, mention_count int")
    at, key = F.lit(now).cast("timestamp"), ["file", "article_no"]
    flat = articles.select(*key, "article.*").withColumn("normalized_url", normalize_url(F.col("url")))
    made = flat.withColumns({"id": F.substring(F.sha2("normalized_url", 256), 1, 32), "source_id": F.lit(source_id), "crawl_run_id": F.lit(run_id), "created_at": at, "updated_at": at, "priority_level": F.coalesce("priority_level", F.lit("medium")), "status": F.lit("analyzed")})
    base = conform(tables["articles"], "articles")
    order = [F.col("file"), F.col("article_no")]
    judged = dispositions(made.withColumn("lane", F.coalesce("lane", F.lit("new"))), base, order)
    new_articles = write_articles(judged, base, order, ["content_hash"], ["title", "summary"])
    own = judged.select(*key, F.coalesce("existing_id", "id").alias("article_id"), "disposition")
    named = entities.select(*key, "entity.*").where("coalesce(trim(name), '') <> ''").withColumn("entity_type", F.coalesce("entity_type", F.lit("company")))
    named = named.withColumns({"canonical_name": canonical_name(F.col("name")), "created_at": at, "updated_at": at}).withColumn("id", F.substring(F.sha2(F.concat_ws("\u0001", "name", "entity_type"), 256), 1, 32))
    new_entities, resolved = write_entities(named, conform(tables["entities"], "entities"), [F.col("name"), F.col("file"), F.col("article_no")])
    links = resolved.join(own, key).select("article_id", "entity_id", F.coalesce("role_in_article", F.lit("mentioned")).alias("role_in_article"), F.coalesce("mention_count", F.lit(1)).alias("mention_count"))
    links = links.withColumn("id", F.substring(F.sha2(F.concat_ws("\u0001", "article_id", "entity_id"), 256), 1, 32))
    cleared = own.where("disposition = 'refreshed_changed'").select("article_id")
    new_links = add_links(conform(tables["article_entities"], "article_entities"), links, cleared)
    kinds = ("inserted", "duplicate", "refreshed_changed", "refreshed_unchanged")
    counts = judged.agg(*[F.count_if(F.col("disposition") == k).alias(f"articles_{k}") for k in kinds])
    lost = errors.agg(F.coalesce(F.sum("article_errors"), F.lit(0)).alias("articles_errors"), F.coalesce(F.sum("entity_errors"), F.lit(0)).alias("entity_links_errors"))
    done = links.agg(F.count(F.lit(1)).alias("entity_links_success"))
    return {"articles": new_articles, "entities": new_entities, "article_entities": new_links}, counts.join(lost).join(done)


def merge(entities: DataFrame, links: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(entities without duplicates, their links, a row of counts, the sorted groups) by canonical name and type."""
    groups = duplicate_groups(entities, F.col("canonical_name"), F.col("entity_type"))
    left = entities.join(groups.where("id <> master_id").select("id"), "id", "left_anti")
    listed = groups.groupBy("canonical", "kind", "master_id").agg(F.array_sort(F.collect_list(F.when(F.col("id") != F.col("master_id"), F.col("id")))).alias("duplicate_ids"))
    return left, merge_entities(links, groups), merge_summary(links, groups), listed.orderBy("canonical", "kind")


def tables_of(spark: SparkSession, folder: str, *names: str) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{folder}/{n}.parquet") for n in names}
