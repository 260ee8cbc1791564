"""Queries of the incremental loop: scans, cursors, lanes, writes, guards, feeds, manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillgrid.functions.entity import priority_rank
from quillgrid.functions.url import normalize_url
from quillgrid.operators.discovery import after_feed_cursor, after_sitemap_checkpoint, due_for_refresh, failure_runs, find_existing, first_working, in_cooldown, lane, latest_cursor, surface_plan, target_due
from quillgrid.operators.warehouse import backfill, dispositions, insert_missing, patch, policy, upsert_state, violations
from quillgrid.plans.registry import NOW, NOW_MICROS, query
from quillgrid.plans.urls import _normal_sql
from quillgrid.rules import REFRESH_POLICY
from quillgrid.runtime import table
from quillgrid.schemas import REFERENCES, UNIQUE
from quillgrid.sources.feeds import expand_sitemaps, feed_entries, monthly_sitemaps
from quillgrid.sources.manifest import manifest_errors
from quillgrid.sources.html import next_pages, walk_pages


def _now() -> F.Column:
    return F.lit(NOW).cast("timestamp")


@query("select id, name, source_type, extraction_mode from sources where enabled")
def enabled_sources(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "sources").where("enabled").select("id", "name", "source_type", "extraction_mode")


@query("select id, source_id, name, priority from source_category_targets where enabled")
def category_targets(spark: SparkSession, d: str) -> DataFrame:
    """Of each source, high priority first, then by name: one range-partitioned sort for all sources."""
    t = table(spark, d, "source_category_targets").where("enabled")
    return t.orderBy("source_id", priority_rank(F.col("priority")).desc(), "name", "id").select("id", "source_id", "name", "priority")


_REFRESH = f"""f as (select a.id, a.url, a.normalized_url, s.id as source_id, s.refresh_enabled, s.refresh_window_days as win, s.refresh_cadence_hours as cad, epoch_us(a.created_at) as born, epoch_us(a.last_scraped_at) as sc from articles a join sources s on s.id = a.source_id),
 x as (select *, id >= '3' as known, coalesce(refresh_enabled, false) and coalesce(win, 0) > 0 and born is not null and {NOW_MICROS} - born <= win::bigint * 86400000000 and (sc is null or {NOW_MICROS} - sc >= greatest(coalesce(cad, 24), 1)::bigint * 3600000000) as due from f)"""


@query(f"with {_REFRESH} select id, case when not known then 'new' when due then 'refresh' else 'skip' end as lane from x")
def refresh_lane(spark: SparkSession, d: str) -> DataFrame:
    """Candidates against the stored articles (those from '3' on), joined by normalized address, then by address."""
    a = table(spark, d, "articles")
    s = table(spark, d, "sources").select(F.col("id").alias("source_id"), "refresh_enabled", "refresh_window_days", "refresh_cadence_hours")
    candidates = a.select("id", "source_id", "url", normalize_url(F.col("url")).alias("normalized_url"), F.col("created_at").alias("published_at"), "last_scraped_at").join(s, "source_id")
    found = find_existing(candidates, a.where("id >= '3'").select("id", "content_hash", "normalized_url", "url"))
    due = due_for_refresh(_now(), *[F.col(c) for c in ("refresh_enabled", "refresh_window_days", "refresh_cadence_hours", "published_at", "last_scraped_at")])
    return found.select("id", lane(F.col("existing_id"), due).alias("lane"))


@query(
    "with s as (select source_id, epoch_us(last_cursor_published_at) - 30 * 86400000000 as cur, arg_min(url, url) as u from (select st.*, a.url from source_discovery_state st left join articles a on a.source_id = st.source_id) group by all)"
    " select a.id from articles a left join s on s.source_id = a.source_id where epoch_us(a.created_at) is null or s.cur is null or epoch_us(a.created_at) > s.cur or (epoch_us(a.created_at) = s.cur and a.source_id < '8' and a.url <> s.u)"
)
def cursor_filter(spark: SparkSession, d: str) -> DataFrame:
    """Articles past their source's cursor (set back by 30 days, so that some are)."""
    a = table(spark, d, "articles").select("id", "source_id", "url", "created_at")
    first = a.groupBy("source_id").agg(F.min("url").alias("cursor_url"))
    state = table(spark, d, "source_discovery_state").select("source_id", (F.col("last_cursor_published_at") - F.expr("interval 30 days")).alias("cursor")).join(first, "source_id", "left")
    joined = a.join(state, "source_id", "left")
    return joined.where(after_feed_cursor(F.col("created_at"), F.col("cursor"), F.col("url"), F.col("cursor_url"), F.col("source_id") < "8")).select("id")


@query(
    "with s as (select source_id, list_max(list_transform(map_values(last_sitemap_checkpoint), lambda v: epoch_us(v::timestamp))) as c from source_discovery_state) select a.id from articles a left join s on s.source_id = a.source_id where s.c is null or epoch_us(a.created_at) > s.c"
)
def sitemap_checkpoint_filter(spark: SparkSession, d: str) -> DataFrame:
    state = table(spark, d, "source_discovery_state").select("source_id", "last_sitemap_checkpoint")
    return table(spark, d, "articles").join(state, "source_id", "left").where(after_sitemap_checkpoint(F.col("created_at"), F.col("last_sitemap_checkpoint"))).select("id")


@query("select source_id, max(epoch_us(created_at)) as at, arg_max(url, (epoch_us(created_at), url)) as url from articles group by 1")
def cursor_advance(spark: SparkSession, d: str) -> DataFrame:
    return latest_cursor(table(spark, d, "articles"), "source_id", "created_at", "url").select("source_id", F.unix_micros("last_cursor_published_at").alias("at"), F.col("last_cursor_url").alias("url"))


@query(f"select id, last_checked_at is null or {NOW_MICROS} - epoch_us(last_checked_at) >= (case when coalesce(check_frequency_hours, 0) = 0 then 24 else check_frequency_hours end)::bigint * 3600000000 as due from source_category_targets")
def targets_due(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "source_category_targets").select("id", target_due(_now(), F.col("last_checked_at"), F.col("check_frequency_hours")).alias("due"))


@query("with e as (select *, sum(case when event_type = 'error' then 0 else 1 end) over (partition by user_id order by ts, event_id) as island from events), r as (select user_id, event_id, case when event_type = 'error' then count(*) filter (where event_type = 'error') over (partition by user_id, island order by ts, event_id) else 0 end as run_length from e) select event_id, run_length, run_length >= 3 as tripped from r")
def circuit_breaker(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").withColumn("failed", F.col("event_type") == "error")
    return failure_runs(e, "user_id", ["ts", "event_id"], "failed").select("event_id", "run_length", "tripped")


@query(f"select s.source_id, coalesce(s.cursor_type = 'rss' and epoch_us(s.cooldown_until) > {NOW_MICROS} - 30 * 86400000000, false) as resting from source_discovery_state s")
def sources_in_cooldown(spark: SparkSession, d: str) -> DataFrame:
    now = _now() - F.expr("interval 30 days")
    return table(spark, d, "source_discovery_state").select("source_id", in_cooldown(now, F.lit("rss"), F.col("cursor_type"), F.col("cooldown_until")).alias("resting"))


@query(
    "with t as (select crawl_run_id, discovery_method, case discovery_method when 'rss' then 1 when 'sitemap' then 2 when 'category_page' then 3 else 4 end as ord, count(*) filter (where status = 'error') > 0 as failed from articles where discovery_method is not null group by all)"
    " select crawl_run_id, arg_min(discovery_method, ord) filter (where not failed) as surface, count(*) filter (where failed) as failures from t group by 1"
)
def surface_failover(spark: SparkSession, d: str) -> DataFrame:
    order = F.when(F.col("discovery_method") == "rss", 1).when(F.col("discovery_method") == "sitemap", 2).when(F.col("discovery_method") == "category_page", 3).otherwise(4)
    attempts = table(spark, d, "articles").where("discovery_method is not null").groupBy("crawl_run_id", "discovery_method").agg((F.count_if(F.col("status") == "error") > 0).alias("failed")).withColumn("ord", order)
    return first_working(attempts, "crawl_run_id", "ord", "failed", "discovery_method")


@query("select id, array_to_string(list_filter(list_transform(range(1, 4), lambda i: case i when 1 then a when 2 then (case when b <> a then b end) else (case when a <> 'map' and coalesce(b, '') <> 'map' then 'map' end) end), lambda x: x is not null), '>') as surfaces from (select s.id, case when extraction_mode = 'rss_feed' then 'rss' else 'category_page' end as a, st.cursor_type as b from sources s left join source_discovery_state st on st.source_id = s.id)")
def surface_order(spark: SparkSession, d: str) -> DataFrame:
    state = table(spark, d, "source_discovery_state").select("source_id", "cursor_type")
    joined = table(spark, d, "sources").join(state, F.col("id") == F.col("source_id"), "left")
    primary = F.when(F.col("extraction_mode") == "rss_feed", "rss").otherwise("category_page")
    return joined.select("id", F.array_join(surface_plan(primary, F.col("cursor_type")), ">").alias("surfaces"))


_BATCH = f"i as (select id, url || case when id < '5' then '#x' else '' end as url, {_normal_sql('url')} as n from articles where id >= '2' union all select id || 'b', url, {_normal_sql('url')} from articles where id < '1'), b as (select * from articles where id >= '4')"


@query(f"with {_BATCH}, j as (select i.*, coalesce(p.id, q.id) as existing_id, row_number() over (partition by i.n order by i.id) as k from i left join b p on p.normalized_url = i.n left join b q on q.url = i.url) select id, existing_id, case when existing_id is null and k = 1 then 'inserted' else 'duplicate' end as disposition from j")
def upsert_articles(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "articles")
    one = a.where("id >= '2'").select("id", F.concat("url", F.when(F.col("id") < "5", "#x").otherwise("")).alias("url"), normalize_url(F.col("url")).alias("normalized_url"))
    two = a.where("id < '1'").select(F.concat("id", F.lit("b")).alias("id"), "url", normalize_url(F.col("url")).alias("normalized_url"))
    base = a.where("id >= '4'").select(F.col("id"), "url", "normalized_url")
    return dispositions(one.unionByName(two), base, [F.col("id")]).select("id", "existing_id", "disposition")


@query(
    f"with {_BATCH}, j as (select i.*, coalesce(p.id, q.id) as existing_id, row_number() over (partition by i.n order by i.id) as k from i left join b p on p.normalized_url = i.n left join b q on q.url = i.url)"
    " select case when existing_id is null and k = 1 then 'inserted' else 'duplicate' end as disposition, count(*) as articles from j group by 1"
)
def write_summary(spark: SparkSession, d: str) -> DataFrame:
    return upsert_articles(spark, d).groupBy("disposition").agg(F.count(F.lit(1)).alias("articles"))


@query(
    "with u as (select id as k, case when id < '4' then 'NEW ' || coalesce(title, '') else title end as t, 'S ' || coalesce(summary, '') as s, case when id < '2' then 'ffff' when id < '3' then '' else content_hash end as h from articles where id < '8')"
    " select a.id, case when k is not null then t else title end as title, case when k is not null and not (coalesce(h, '') <> '' and coalesce(h = content_hash, false)) then s else summary end as summary, case when k is null then null else not (coalesce(h, '') <> '' and coalesce(h = content_hash, false)) end as changed from articles a left join u on u.k = a.id"
)
def patch_changed(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "articles").select("id", "title", "summary", "content_hash")
    u = a.where("id < '8'").select(
        "id",
        F.when(F.col("id") < "4", F.concat(F.lit("NEW "), F.coalesce("title", F.lit("")))).otherwise(F.col("title")).alias("title"),
        F.concat(F.lit("S "), F.coalesce("summary", F.lit(""))).alias("summary"),
        F.when(F.col("id") < "2", "ffff").when(F.col("id") < "3", "").otherwise(F.col("content_hash")).alias("content_hash"),
    )
    return patch(a, u, "id", ["title", "content_hash"], ["summary"]).select("id", "title", "summary", "changed")


@query("select url, count(*) as n from (select url from sources where source_type = 'news' union all select url from sources where source_type <> 'news') group by 1")
def seed_insert_guard(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "sources")
    return insert_missing(s.where("source_type = 'news'"), s, ["url"]).groupBy("url").agg(F.count(F.lit(1)).alias("n"))


@query("select id, name from source_category_targets where source_id in (select id from sources where source_type = 'preprint' or refresh_enabled)")
def semi_policy_scope(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "sources").where("source_type = 'preprint' or refresh_enabled").select(F.col("id").alias("source_id"))
    return table(spark, d, "source_category_targets").join(s, "source_id", "left_semi").select("id", "name")


@query(
    "select id, case when name = 'Zellkurier' then false when source_type in ('preprint', 'journal', 'news') then true else refresh_enabled end as enabled, case when name = 'Zellkurier' then null when source_type in ('preprint', 'journal') then 30 when source_type = 'news' then 7 else refresh_window_days end as win,"
    " case when name = 'Zellkurier' then null when source_type = 'preprint' then 168 when source_type = 'journal' then 720 when source_type = 'news' then 72 else refresh_cadence_hours end as cad from sources"
)
def refresh_policy(spark: SparkSession, d: str) -> DataFrame:
    p = policy(table(spark, d, "sources"), "source_type", REFRESH_POLICY, F.col("name") == "Zellkurier", (False, None, None, "low"))
    return p.select("id", F.col("refresh_enabled").alias("enabled"), F.col("refresh_window_days").alias("win"), F.col("refresh_cadence_hours").alias("cad"))


@query("select id, epoch_us(coalesce(last_content_changed_at, last_analyzed_at, created_at)) as changed_at from articles")
def backfill_coalesce(spark: SparkSession, d: str) -> DataFrame:
    return backfill(table(spark, d, "articles"), "last_content_changed_at", "last_analyzed_at", "created_at").select("id", F.unix_micros("last_content_changed_at").alias("changed_at"))


@query("with u as (select id as source_id, 'sitemap' as cursor_type, 0 as error_count from sources where id < '8') select coalesce(s.source_id, u.source_id) as source_id, coalesce(u.cursor_type, s.cursor_type) as cursor_type, coalesce(u.error_count, s.error_count) as error_count, s.last_error from source_discovery_state s full join u on u.source_id = s.source_id")
def state_upsert(spark: SparkSession, d: str) -> DataFrame:
    state = table(spark, d, "source_discovery_state").select("source_id", "cursor_type", "error_count", "last_error")
    updates = table(spark, d, "sources").where("id < '8'").select(F.col("id").alias("source_id"), F.lit("sitemap").alias("cursor_type"), F.lit(0).alias("error_count"))
    return upsert_state(state, updates, "source_id")


_CHECKS = [
    *[f"select 'unique {t}({','.join(k)})' as check_name, coalesce(sum(n - 1), 0)::bigint as violations from (select count(*) as n from {t} group by {', '.join(k)} having count(*) > 1)" for t, ks in UNIQUE.items() for k in ks],
    *[f"select 'reference {c}.{k}', count(*)::bigint from {c} x where x.{k} is not null and not exists (select 1 from {p} y where y.id = x.{k})" for c, k, p in REFERENCES],
]


@query(" union all ".join(_CHECKS))
def integrity_asserts(spark: SparkSession, d: str) -> DataFrame:
    names = {*UNIQUE, *[x for c, _, p in REFERENCES for x in (c, p)]}
    return violations({n: table(spark, d, n) for n in names}, UNIQUE, REFERENCES)


def _rendered(spark: SparkSession, d: str, kind: str) -> DataFrame:
    """One feed payload for each article, of one kind."""
    a = table(spark, d, "articles").select("id", "url", F.coalesce("title", F.lit("")).alias("title"), F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("iso"), F.date_format("created_at", "dd MMM yyyy HH:mm:ss").alias("rfc"))
    esc = lambda c: F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    url, title = esc(F.col("url")), esc(F.col("title"))
    forms = {
        "rss": ('<?xml version="1.0"?><rss version="2.0"><channel><title>x</title><item><title>%s</title><link>%s</link><description><![CDATA[%s]]></description><pubDate>Mon, %s GMT</pubDate></item></channel></rss>', (title, url, F.col("title"), F.col("rfc"))),
        "atom": ('<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>%s</title><link rel="self" href="https://x.example/s"/><link rel="alternate" href="%s"/><summary>%s</summary><updated>%s</updated></entry></feed>', (title, url, title, F.col("iso"))),
        "rdf": ('<rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns="http://purl.org/rss/1.0/" xmlns:dc="http://purl.org/dc/elements/1.1/"><item rdf:about="%s"><title>%s</title><link>%s</link><description>%s</description><dc:date>%s</dc:date></item></rdf:RDF>', (url, title, url, title, F.col("iso"))),
    }
    form, values = forms[kind]
    return a.select("id", F.format_string(form, *values).alias("body"))


_FEED = "select id, url, trim(coalesce(title, '')) as title, trim(coalesce(title, '')) as description, (epoch_us(created_at) // 1000000) as at from articles"


def _feed(spark: SparkSession, d: str, kind: str) -> DataFrame:
    return feed_entries(_rendered(spark, d, kind)).select("id", "url", "title", "description", F.unix_seconds("published_at").alias("at"))


@query(_FEED)
def feed_parse_rss(spark: SparkSession, d: str) -> DataFrame:
    return _feed(spark, d, "rss")


@query(_FEED)
def feed_parse_atom(spark: SparkSession, d: str) -> DataFrame:
    return _feed(spark, d, "atom")


@query(_FEED)
def feed_parse_rdf(spark: SparkSession, d: str) -> DataFrame:
    return _feed(spark, d, "rdf")


@query("select s.url || 'map.xml' as request_url, a.url, epoch_us(date_trunc('day', make_timestamp(epoch_us(a.created_at)))) // 1000000 as at from articles a join sources s on s.id = a.source_id")
def feed_parse_sitemap(spark: SparkSession, d: str) -> DataFrame:
    """An index for each source with one child that lists its articles; the index is followed one level deep."""
    a = table(spark, d, "articles").select("id", "source_id", "url", F.date_format("created_at", "yyyy-MM-dd").alias("day"))
    s = table(spark, d, "sources").select(F.col("id").alias("source_id"), F.concat("url", F.lit("map.xml")).alias("child"), F.concat("url", F.lit("index.xml")).alias("index"))
    item = F.format_string("<url><loc>%s</loc><lastmod>%s</lastmod></url>", F.replace("url", F.lit("&"), F.lit("&amp;")), F.col("day"))
    # one payload is one file of a site, bounded by the sitemap format to 50,000 addresses; here each article is a file of its own
    children = a.join(s, "source_id").select(F.col("child").alias("request_url"), F.concat(F.lit('<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'), item, F.lit("</urlset>")).alias("body"), F.col("id").alias("file"))
    index = s.select(F.col("index").alias("request_url"), F.format_string("<sitemapindex><sitemap><loc>%s</loc></sitemap></sitemapindex>", F.col("child")).alias("body"), F.lit("").alias("file"))
    return expand_sitemaps(children.unionByName(index)).select("request_url", "url", F.unix_seconds("published_at").alias("at"))


@query("select id, to_char_month as month, url || 'map-' || to_char_month || '.xml' as sitemap_url from (select id, url, strftime(unnest(generate_series(date '2026-04-01', date '2026-07-01', interval 1 month)), '%Y-%m') as to_char_month from sources)")
def generated_sitemaps(spark: SparkSession, d: str) -> DataFrame:
    s = monthly_sitemaps(table(spark, d, "sources").select("id", "url"), "map-{y}-{m}.xml", F.lit(NOW[:10]).cast("date"), 4)
    return s.select("id", F.date_format("month", "yyyy-MM").alias("month"), F.concat("url", "sitemap_url").alias("sitemap_url"))


@query(
    "with m as (select id, case when id < '2' then null else name end as name, case when id < '4' then 'https://same.example/' else url end as url, case when extraction_mode = 'rss_feed' then 'rss' when extraction_mode = 'article_listing' then 'category_page' else 'map' end as surface, case when extraction_mode = 'rss_feed' and id < '8' then 'feed.xml' when extraction_mode = 'rss_feed' and id < 'c' then null else url || 'feed' end as feed_url from sources),"
    " r as (select url from m group by 1 having count(*) > 1) select m.id, array_to_string(list_filter([case when name is null then 'missing: name' end, case when url in (select url from r) then 'url repeated' end, case when surface = 'category_page' then 'primary_discovery_surface unknown: category_page' end, case when feed_url is not null and not regexp_matches(feed_url, '^https?://[^/\\s]+') then 'feed_url not absolute' end, case when surface = 'rss' and coalesce(feed_url, '') = '' then 'rss without feed_url' end], lambda x: x is not null), '; ') as errors from m"
)
def manifest_validate(spark: SparkSession, d: str) -> DataFrame:
    s, i = table(spark, d, "sources"), F.col("id")
    rss = F.col("extraction_mode") == "rss_feed"
    m = s.select(
        "id",
        F.when(i >= "2", F.col("name")).alias("name"),
        F.when(i < "4", "https://same.example/").otherwise(F.col("url")).alias("url"),
        "domain",
        "source_type",
        "enabled",
        "crawl_frequency",
        F.when(rss, "rss").when(F.col("extraction_mode") == "article_listing", "category_page").otherwise("map").alias("primary_discovery_surface"),
        F.lit("map").alias("fallback_discovery_surface"),
        F.when(rss & (i < "8"), "feed.xml").when(rss & (i < "c"), F.lit(None)).otherwise(F.concat("url", F.lit("feed"))).alias("feed_url"),
        F.array().cast("array<string>").alias("sitemap_urls"),
    )
    return manifest_errors(m).select("id", F.array_join("errors", "; ").alias("errors"))


@query("select s.id as target, s.url || case step when 1 then '' else 'page-' || step end as page_url, step::int as step from sources s, range(1, 4) t(step) where step <= 2 or s.id < '8'")
def paged_listing(spark: SparkSession, d: str) -> DataFrame:
    """Listings of two or more pages, followed over their next links for at most three."""
    s = table(spark, d, "sources").select("id", "url")
    pages = s.select("id", "url", F.explode(F.array(*[F.lit(n) for n in range(1, 6)])).alias("n")).where("n <= 2 or id < '8'")
    page = lambda n: F.concat("url", F.when(n == 1, "").otherwise(F.concat(F.lit("page-"), n.cast("string"))))
    known = pages.select(page(F.col("n")).alias("page_url"), "url", "n")
    anchors = known.select("page_url", F.concat(F.lit("/page-"), (F.col("n") + 1).cast("string")).alias("href"), F.lit("Older posts").alias("text"), F.lit(7).alias("pos"))
    following = next_pages(anchors, "page_url")
    return walk_pages(s.select(F.col("id").alias("target"), F.col("url").alias("page_url")), known, following, 3)
