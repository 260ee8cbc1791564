"""Queries on addresses and links: normal form, deduplication, anchors, scores, ranks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillgrid.functions.score import link_score, surface_bonus
from quillgrid.functions.url import host_of, normalize_url, published_from_url, recency_key
from quillgrid.operators.discovery import first_by_url, rank_final, rank_surface
from quillgrid.plans.registry import query
from quillgrid.rules import rules_table, with_rules
from quillgrid.runtime import table
from quillgrid.sources.html import before_last_seen, html_anchors, markdown_anchors, site_links

_TRACKING = "['utm_source','utm_medium','utm_campaign','utm_term','utm_content','utm_id','fbclid','gclid','mc_cid','mc_eid','ref','source']"


def _normal_sql(u: str) -> str:
    """The normal form of an address in SQL; for addresses without characters that forms encode."""
    auth = rf"regexp_replace(lower(regexp_extract({u}, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)), '^.*@', '')"
    path = rf"regexp_extract({u}, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1)"
    query = (
        rf"array_to_string(list_transform(list_filter(string_split(regexp_extract({u}, '^[^?#]*\?([^#]*)', 1), '&'), lambda p: p <> '' and not list_contains({_TRACKING}, lower(split_part(p, '=', 1)))),"
        r" lambda p: case when contains(p, '=') then p else p || '=' end), '&')"
    )
    return (
        rf"lower(regexp_extract({u}, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1)) || '://' || regexp_replace({auth}, ':(80|443|0)?$', '')"
        rf" || case when {path} = '' then '/' else {path} end || case when {query} = '' then '' else '?' || {query} end"
    )


def _host_sql(u: str) -> str:
    return rf"regexp_replace(lower(regexp_extract({u}, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)), '^www\.', '')"


@query(f"select id, {_normal_sql('url')} as normalized, {_host_sql('url')} as host from articles")
def url_normalize(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "articles").select("id", normalize_url(F.col("url")).alias("normalized"), host_of(F.col("url")).alias("host"))


_VARIANTS = """v as (select id, 0 as ord, url as u from articles
 union all select id, 1, regexp_replace(url, '#.*$', '') || case when contains(url, '?') then '&' else '?' end || 'utm_campaign=mail' from articles
 union all select id, 2, upper(substr(url, 1, 5)) || substr(url, 6) from articles)"""


@query(
    f"with {_VARIANTS}, n as (select *, {_normal_sql('u')} as normalized from v)"
    " select normalized, count(*) as variants, arg_min(id, id || ord) as first_id, min(ord) as first_ord from n group by normalized"
)
def url_dedupe_variants(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "articles").select("id", "url")
    bare = F.regexp_replace("url", "#.*$", "")
    variants = (
        a.select("id", F.lit(0).alias("ord"), F.col("url").alias("u"))
        .unionByName(a.select("id", F.lit(1).alias("ord"), F.concat(bare, F.when(F.contains("url", F.lit("?")), "&").otherwise("?"), F.lit("utm_campaign=mail")).alias("u")))
        .unionByName(a.select("id", F.lit(2).alias("ord"), F.concat(F.upper(F.substring("url", 1, 5)), F.expr("substr(url, 6)")).alias("u")))
    )
    n = variants.withColumn("normalized", normalize_url(F.col("u")))
    return n.groupBy("normalized").agg(F.count(F.lit(1)).alias("variants"), F.min_by("id", F.concat("id", "ord")).alias("first_id"), F.min("ord").alias("first_ord"))


_LINKS = r"""l as (select a.id as article_id, s.url as base, unnest(range(least(len(m), 250))) as pos, unnest(m[1:250]) as a
 from (select *, regexp_extract_all(raw_markdown, '\[([^\[\]]*)\]\(([^()\s]+)\)') as m from articles where raw_markdown is not null) a join sources s on s.id = a.source_id),
 h as (select article_id, base, pos, trim(regexp_extract(a, '\[([^\[\]]*)\]\(([^()\s]+)\)', 1)) as text, regexp_extract(a, '\[([^\[\]]*)\]\(([^()\s]+)\)', 2) as href from l),
 j as (select *, case when regexp_matches(href, '^[A-Za-z][\w+.-]*:') then href when href like '//%' then regexp_extract(base, '^([A-Za-z]+):', 1) || ':' || href
   when href like '/%' then regexp_extract(base, '^([A-Za-z]+://[^/?#]*)', 1) || href when href like '?%' then regexp_extract(base, '^([^?#]*)', 1) || href
   when href like '#%' then base || href else regexp_replace(regexp_extract(base, '^([^?#]*)', 1), '[^/]*$', '') || href end as full_url from h)"""


def _anchors(spark: SparkSession, d: str) -> DataFrame:
    sites = table(spark, d, "sources").select(F.col("id").alias("source_id"), F.col("url").alias("base"))
    pages = table(spark, d, "articles").where("raw_markdown is not null").select(F.col("id").alias("article_id"), "source_id", "raw_markdown")
    return markdown_anchors(pages, "article_id", "raw_markdown", carry=("source_id",)).join(sites, "source_id").drop("source_id")


@query(
    f"with {_LINKS}, n as (select article_id, pos, text, base, {_normal_sql('full_url')} as url from j where regexp_matches(full_url, '^[A-Za-z][A-Za-z0-9+.-]*://'))"
    f" select article_id, pos, text, url from n where {_host_sql('url')} = {_host_sql('base')} or {_host_sql('url')} like '%.' || {_host_sql('base')}"
)
def same_domain_links(spark: SparkSession, d: str) -> DataFrame:
    return site_links(_anchors(spark, d), "base").select("article_id", "pos", "text", "url")


@query(
    r"with b as (select id, regexp_extract_all(raw_markdown, '\[([^\[\]]*)\]\(([^()\s]+)\)') as m from articles where raw_markdown is not null), l as (select id, unnest(range(least(len(m), 250)))::int as pos, unnest(m[1:250]) as a from b)"
    r" select id, pos, regexp_extract(a, '\[([^\[\]]*)\]\(([^()\s]+)\)', 2) as href, trim(regexp_extract(a, '\[([^\[\]]*)\]\(([^()\s]+)\)', 1)) as text, '' as rel from l"
)
def anchor_scan_exact(spark: SparkSession, d: str) -> DataFrame:
    """Pages rendered to HTML, read with a real parser."""
    body = F.regexp_replace("raw_markdown", r"\[([^\[\]]*)\]\(([^()\s]+)\)", '<a href="$2"><b>$1</b></a>')
    pages = table(spark, d, "articles").where("raw_markdown is not null").select("id", F.concat(F.lit("<html><body>"), body, F.lit("</body></html>")).alias("html"))
    return html_anchors(pages, "id", "html")


_ARTICLE_WORDS = "['/article/','/articles/','/news/','/story/','/stories/','/post/','/posts/','/read/','/abs/']"
_NON = r"(?i)/about(?:/|$)|/author(?:/|$)|/authors(?:/|$)|/staff(?:/|$)|/tag(?:/|$)|/category(?:/|$)|/categories(?:/|$)|/topics?(?:/|$)|/events?(?:/|$)|/jobs?(?:/|$)|/careers?(?:/|$)|/contact(?:/|$)|/privacy(?:/|$)|/terms(?:/|$)|/newsletter(?:/|$)|/subscribe(?:/|$)|/login(?:/|$)|/search(?:/|$)|/sitemap|/wp-json|/content/early/|\.xml$"
_SCORED = rf"""c as (select a.id, a.source_id, a.url, coalesce(a.title, '') as t, coalesce(a.summary, '') as b, s.extraction_mode as m, a.discovery_method as dm, epoch_us(a.created_at) as born from articles a join sources s on s.id = a.source_id),
 k as (select *, case when m = 'rss_feed' then ['/news/'] else []::varchar[] end as kw from c),
 x as (select *, (case when regexp_matches(url, '/20\d\d/\d\d/(?:\d\d/)?') then 4 else 0 end) + (case when len(list_filter({_ARTICLE_WORDS}, lambda w: contains(lower(url), w))) > 0 then 5 else 0 end)
  + (case when len(list_filter(kw, lambda w: contains(lower(url), w))) > 0 then 5 else 0 end) + (case when regexp_matches(url, '(?i)-0\d+/?$') then 7 else 0 end)
  + (case when m = 'article_listing' and contains(lower(url), '/articles/') then 4 else 0 end) + (case when m = 'rss_feed' and regexp_matches(lower(url), '/abs/|/doi/|/content/10\.1101/') then 6 else 0 end)
  - (case when m = 'rss_feed' and not (len(list_filter(kw, lambda w: contains(lower(url), w))) > 0 or regexp_matches(url, '(?i)-0\d+/?$')) then 20 else 0 end)
  + (case when length(t) >= 25 then 2 else 0 end) + (case when length(b) >= 25 then 1 else 0 end) - (case when not regexp_matches(url, '(?i)/amp/') and (regexp_matches(url, '{_NON}') or regexp_matches(url, '(?i)#top$')) then 20 else 0 end)
  - (case when trim(t) = '' and trim(b) = '' then 1 else 0 end) as link_score from k),
 y as (select id, source_id, url, link_score, link_score + case dm when 'rss' then 4 when 'category_page' then 2 else 0 end as score, born from x)"""


def scored(spark: SparkSession, d: str) -> DataFrame:
    """Articles as candidates, scored under a rule for each source: listings by form of address, feeds by section."""
    articles = table(spark, d, "articles").select("id", "source_id", "url", "title", "summary", "discovery_method", F.col("created_at").alias("published_at"))
    modes = table(spark, d, "sources").select(F.col("id").alias("source_id"), "extraction_mode")
    rules = rules_table(spark, {"site": {"include_regexes": [r"-0\d+/?$"], "exclude_regexes": ["#top$"], "non_article_exceptions": ["/amp/"]}, "feed": {"include_keywords": ["/news/"], "include_regexes": [r"-0\d+/?$"], "exclude_regexes": ["#top$"], "non_article_exceptions": ["/amp/"]}})
    named = articles.join(modes, "source_id").withColumn("rule", F.when(F.col("extraction_mode") == "rss_feed", "feed").otherwise("site"))
    ruled = with_rules(named, rules, "rule")
    s = link_score(*[F.col(c) for c in ("url", "title", "summary", "extraction_mode", "include_keywords", "include_regexes", "exclude_regexes", "non_article_exceptions")])
    return ruled.select("id", "source_id", "url", s.alias("link_score"), (s + surface_bonus(F.col("discovery_method"))).alias("score"), "published_at")


@query(f"with {_SCORED} select id, link_score, score from y")
def score_links(spark: SparkSession, d: str) -> DataFrame:
    return scored(spark, d).select("id", "link_score", "score")


@query(f"with {_SCORED} select id, source_id, score, surface_rank from (select *, row_number() over (partition by source_id order by score asc, born desc, url desc) as surface_rank from y where score >= 4) where surface_rank <= 15")
def rank_candidates_compat(spark: SparkSession, d: str) -> DataFrame:
    return rank_surface(scored(spark, d).where("score >= 4"), "source_id", 15).select("id", "source_id", "score", "surface_rank")


_DAY = r"/(20\d\d)/(\d\d)(?:/(\d\d))?/"
_YMD = ", ".join(f"coalesce(try_cast(regexp_extract(url, '{_DAY}', {n}) as int), 0) as {c}" for n, c in ((1, "y"), (2, "m"), (3, "d")))


@query(
    f"with {_SCORED}, z as (select *, {_YMD} from y where score >= 4) select id, source_id, score, final_rank from"
    " (select *, row_number() over (partition by source_id order by score desc, born asc, y desc, m desc, d desc, url asc) as final_rank from z) where final_rank <= 15"
)
def rank_candidates_final(spark: SparkSession, d: str) -> DataFrame:
    unique = first_by_url(scored(spark, d).where("score >= 4"), "source_id", "url", F.col("id"))
    return rank_final(unique, "source_id", 15).select("id", "source_id", "score", "final_rank")


@query(f"select id, {_YMD}, case when y > 0 then try_cast(y || '-' || lpad(m::varchar, 2, '0') || '-' || lpad((case when d = 0 then 1 else d end)::varchar, 2, '0') as date)::varchar end as day from (select id, url, {_YMD} from articles)".replace(f"select id, {_YMD}, case", "select id, y, m, d, case"))
def url_recency(spark: SparkSession, d: str) -> DataFrame:
    key = recency_key(F.col("url"))
    return table(spark, d, "articles").select("id", key["y"].alias("y"), key["m"].alias("m"), key["d"].alias("d"), F.date_format(published_from_url(F.col("url")), "yyyy-MM-dd").alias("day"))


@query(
    f"with {_LINKS}, t as (select *, case when article_id < '8' then arg_min(href, pos) filter (where pos = 3) over (partition by article_id) end as last_seen from j),"
    " s as (select *, min(case when href = last_seen then pos end) over (partition by article_id) as stop from t),"
    " r as (select article_id, pos, href, row_number() over (partition by article_id order by pos) as rank from s where stop is null or pos < stop) select * from r where rank <= 45"
)
def stop_at_last_seen(spark: SparkSession, d: str) -> DataFrame:
    a = _anchors(spark, d).select("article_id", "pos", "href")
    seen = a.where("pos = 3 and article_id < '8'").select("article_id", F.col("href").alias("last_seen"))
    return before_last_seen(a.join(seen, "article_id", "left"), "article_id", "href", "pos", "last_seen").select("article_id", "pos", "href", "rank")
