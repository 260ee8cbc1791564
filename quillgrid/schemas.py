"""Schemas of tables and payloads. Nothing is inferred."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FINGERPRINT = "struct<prompt_template_version:string,model:string,temperature:double,content_hash:string,analysis_type:string>"

_DDL = {
    "sources": "id string, name string, url string, domain string, source_type string, enabled boolean, crawl_frequency string, extraction_mode string, created_at timestamp, updated_at timestamp, refresh_enabled boolean, refresh_window_days int, refresh_cadence_hours int, refresh_priority string",
    "crawl_runs": "id string, run_type string, started_at timestamp, completed_at timestamp, status string, source_count int, article_count int, error_count int, notes string",
    "articles": f"id string, source_id string, crawl_run_id string, url string, title string, published_at string, raw_markdown string, summary string, topic_tags array<string>, priority_level string, confidence_score decimal(4,3), status string, analysis_notes string, created_at timestamp, updated_at timestamp, normalized_url string, content_hash string, discovery_method string, last_scraped_at timestamp, analysis_version string, analysis_fingerprint {_FINGERPRINT}, last_analyzed_at timestamp, last_content_changed_at timestamp",
    "entities": "id string, name string, entity_type string, canonical_name string, created_at timestamp, updated_at timestamp",
    "article_entities": "id string, article_id string, entity_id string, role_in_article string, mention_count int, confidence_score decimal(4,3)",
    "delivery_logs": "id string, crawl_run_id string, channel_type string, destination string, delivered_at timestamp, status string, message_preview string",
    "source_discovery_state": "source_id string, cursor_type string, last_discovery_at timestamp, last_cursor_published_at timestamp, last_cursor_url string, last_map_at timestamp, last_sitemap_checkpoint map<string,string>, last_successful_discovery_at timestamp, cooldown_until timestamp, error_count int, last_error string, created_at timestamp, updated_at timestamp",
    "source_category_targets": "id string, source_id string, name string, url string, priority string, enabled boolean, check_frequency_hours int, last_seen_url string, last_seen_published_at string, last_checked_at timestamp, last_error string, error_type string, detected_at timestamp, created_at timestamp, updated_at timestamp",
    "manifest": "name string, url string, domain string, source_type string, enabled boolean, crawl_frequency string, extraction_mode string, primary_discovery_surface string, fallback_discovery_surface string, feed_url string, sitemap_urls array<string>",
    "source_rules": "name string, discovery_url string, map_search string, sitemap string, include_keywords array<string>, include_regexes array<string>, exclude_regexes array<string>, non_article_exceptions array<string>, disable_stop_on_last_seen boolean, coarse_feed_timestamps boolean",
    "payloads": "source string, surface string, ordinal int, request_url string, body string, status int, error string",
    "candidates": "url string, title string, description string, score int, published_at timestamp, discovery_method string, processing_lane string, existing_article_id string, existing_content_hash string",
    "scrapes": "success boolean, markdown string, word_count int, content_hash string, paywall_detected boolean, paywall_signal string",
    "model_response": "title string, url string, summary string, topic_tags string, priority_level string, entities array<struct<name:string,entity_type:string>>, analysis_notes string",
    "writer_article": "title string, url string, summary string, priority_level string",
    "writer_entity": "name string, entity_type string, role_in_article string, mention_count int",
}


@lru_cache(maxsize=None)
def schema_of(name: str) -> T.StructType:
    """The schema of a table or payload; read when used, since the reader of DDL needs a session."""
    return T.StructType.fromDDL(_DDL[name])


#: Unique keys and references, for the integrity assertions.
UNIQUE = {"sources": [("url",)], "articles": [("url",), ("normalized_url",)], "entities": [("name", "entity_type")], "source_category_targets": [("source_id", "url")]}
REFERENCES = [("articles", "source_id", "sources"), ("articles", "crawl_run_id", "crawl_runs"), ("article_entities", "article_id", "articles"), ("article_entities", "entity_id", "entities"), ("source_category_targets", "source_id", "sources")]


def conform(df: DataFrame, name: str) -> DataFrame:
    """The columns of a table in order and type: missing ones null, others dropped (rows from before a migration)."""
    have = set(df.columns)
    return df.select(*[(F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema_of(name).fields])
