"""Queries of writes, states and payloads: new tables after upserts, breakers and cursors, service answers, pages of reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillgrid.functions.score import link_score
from quillgrid.functions.text import prompt, with_defaults
from quillgrid.functions.url import normalize_url
from quillgrid.operators.discovery import after_feed_cursor, checkpoint_after, first_in_order, newest_of_target, surface_state
from quillgrid.operators.warehouse import dispositions, duplicate_groups, insert_missing, not_null, upsert_state, write_articles, write_counts, write_entities
from quillgrid.plans.registry import query
from quillgrid.plans.urls import _normal_sql
from quillgrid.rules import SOURCE_RULES, rules_table, with_rules
from quillgrid.runtime import table
from quillgrid.sources.feeds import feed_entries
from quillgrid.sources.payloads import credit_usage, map_links, scraped_pages

# ---- writes

#: Articles play the store and the incoming batch: from '4' on they are stored; all from '2' on come in again, some of them changed.
_JUDGED = f"""i as (select id, source_id, url || case when id < '5' then '#x' else '' end as url, {_normal_sql('url')} as n, case when id < '6' then 'new' else 'refresh' end as lane,
   case when id >= 'c' then 'changed' else content_hash end as h, case when id >= 'c' then 'again: ' || coalesce(title, '') else title end as title from articles where id >= '2'
   union all select id || 'b', source_id, url, {_normal_sql('url')}, 'new', content_hash, title from articles where id < '3'),
 b as (select id, url, normalized_url, title, content_hash from articles where id >= '4'),
 j as (select i.*, coalesce(p.id, q.id) as existing_id, coalesce(p.content_hash, q.content_hash) as old, row_number() over (partition by i.n order by i.id) as k from i left join b p on p.normalized_url = i.n left join b q on q.url = i.url and p.id is null),
 k as (select *, case when existing_id is null and k = 1 then 'inserted' when existing_id is not null and lane = 'refresh' then case when coalesce(old, '') <> '' and coalesce(old = h, false) then 'refreshed_unchanged' else 'refreshed_changed' end else 'duplicate' end as disposition from j)"""


def _judged(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    a = table(spark, d, "articles").select("id", "source_id", "url", "normalized_url", "title", "content_hash")
    changed, i = F.col("id") >= "c", F.col("id")
    one = a.where(i >= "2").select(
        "id",
        "source_id",
        F.concat("url", F.when(i < "5", "#x").otherwise("")).alias("url"),
        normalize_url(F.col("url")).alias("normalized_url"),
        F.when(i < "6", "new").otherwise("refresh").alias("lane"),
        F.when(changed, "changed").otherwise(F.col("content_hash")).alias("content_hash"),
        F.when(changed, F.concat(F.lit("again: "), F.coalesce("title", F.lit("")))).otherwise(F.col("title")).alias("title"),
    )
    two = a.where(i < "3").select(F.concat("id", F.lit("b")).alias("id"), "source_id", "url", normalize_url(F.col("url")).alias("normalized_url"), F.lit("new").alias("lane"), "content_hash", "title")
    base = a.where(i >= "4").select("id", "url", "normalized_url", "title", "content_hash")
    return dispositions(one.unionByName(two), base, [F.col("id")]), base


@query(
    f"with {_JUDGED} select b.id, b.url, case when k.id is null then b.title else k.title end as title, case when k.id is null then b.content_hash else k.h end as content_hash from b left join k on k.existing_id = b.id and k.disposition like 'refreshed%'"
    " union all select id, url, title, h from k where disposition = 'inserted'"
)
def articles_written(spark: SparkSession, d: str) -> DataFrame:
    """The table of articles after a batch: inserted rows added, refreshed ones patched, duplicates left alone."""
    judged, base = _judged(spark, d)
    return write_articles(judged, base, [F.col("id")], ["content_hash"], ["title"]).select("id", "url", "title", "content_hash")


@query(
    f"with {_JUDGED}, f as (select *, id like '%7' as failed from k),"
    " l as (select x.entity_id, a.source_id, case when a.id like '%7' then null else a.id end as article_id, case when x.id < '1' then ' ' else n.name end as name from article_entities x join articles a on a.id = x.article_id left join entities n on n.id = x.entity_id),"
    " c as (select source_id, count(*) filter (where article_id is not null and trim(coalesce(name, '')) <> '') as good, count(*) filter (where article_id is null or trim(coalesce(name, '')) = '') as lost from l group by 1),"
    " w as (select source_id, count(*) filter (where not failed and disposition = 'inserted') as a, count(*) filter (where not failed and disposition = 'duplicate') as b, count(*) filter (where not failed and disposition = 'refreshed_changed') as c, count(*) filter (where not failed and disposition = 'refreshed_unchanged') as u, count(*) filter (where failed) as e from f group by 1)"
    " select coalesce(w.source_id, c.source_id) as source_id, coalesce(a, 0) as articles_inserted, coalesce(b, 0) as articles_duplicate, coalesce(w.c, 0) as articles_refreshed_changed, coalesce(u, 0) as articles_refreshed_unchanged, coalesce(e, 0) as articles_errors, coalesce(good, 0) as entity_links_success, coalesce(lost, 0) as entity_links_errors from w full join c on c.source_id = w.source_id"
)
def write_report(spark: SparkSession, d: str) -> DataFrame:
    """The summary of a write, a row for each source; articles whose id ends in 7 play the failed ones."""
    judged, _ = _judged(spark, d)
    failed = F.col("id").endswith("7")
    articles = table(spark, d, "articles").select(F.col("id").alias("article_id"), "source_id")
    links = table(spark, d, "article_entities").join(articles, "article_id").join(table(spark, d, "entities").select(F.col("id").alias("entity_id"), "name"), "entity_id", "left")
    lost = links.select("source_id", F.when(~F.col("article_id").endswith("7"), F.col("article_id")).alias("article_id"), F.when(F.col("id") < "1", " ").otherwise(F.col("name")).alias("name"))
    return write_counts(judged.withColumn("failed", failed), lost)


@query(
    "with i as (select id || 'n' as id, name, canonical_name, entity_type from entities where id >= '8' union all select id || 'm', name || ' (again)', canonical_name, entity_type from entities where id >= 'c'), b as (select * from entities where id < 'a'),"
    " c as (select canonical_name, entity_type, arg_min(id, (created_at, id)) as c_id from b where trim(coalesce(canonical_name, '')) <> '' group by all), n as (select name, entity_type, arg_min(id, (created_at, id)) as n_id from b where trim(coalesce(name, '')) <> '' group by all),"
    " h as (select i.*, coalesce(c_id, n_id) as hit, case when trim(coalesce(i.canonical_name, '')) = '' then 'n:' || i.name else 'c:' || i.canonical_name end as g from i left join c on c.canonical_name = i.canonical_name and c.entity_type = i.entity_type left join n on n.name = i.name and n.entity_type = i.entity_type),"
    " r as (select *, coalesce(hit, min(id) filter (where hit is null) over (partition by g, entity_type)) as entity_id from h)"
    " select entity_id, count(*) filter (where src = 0) as stored, count(*) filter (where src = 1) as named from (select id as entity_id, 0 as src from b union all select entity_id, 0 from r where entity_id = id union all select entity_id, 1 from r) group by 1"
)
def entities_written(spark: SparkSession, d: str) -> DataFrame:
    """Entities after a batch of names: each new one once, each name of the batch with its entity."""
    e = table(spark, d, "entities")
    one = e.where("id >= '8'").select(F.concat("id", F.lit("n")).alias("id"), "name", "canonical_name", "entity_type")
    two = e.where("id >= 'c'").select(F.concat("id", F.lit("m")).alias("id"), F.concat("name", F.lit(" (again)")).alias("name"), "canonical_name", "entity_type")
    new, resolved = write_entities(one.unionByName(two), e.where("id < 'a'"), [F.col("id")])
    both = new.select(F.col("id").alias("entity_id"), F.lit(0).alias("src")).unionByName(resolved.select("entity_id", F.lit(1).alias("src")))
    return both.groupBy("entity_id").agg(F.count_if(F.col("src") == 0).alias("stored"), F.count_if(F.col("src") == 1).alias("named"))


_SEEDS = [("Morning Wire", "https://seed-one.example/", "news"), ("Deep Journal", "https://seed-two.example/", "journal"), ("Early Prints", "https://seed-three.example/", "preprint")]


@query("select name, url, source_type from sources union all select * from (values " + ", ".join(f"('{n}', '{u}', '{t}')" for n, u, t in _SEEDS) + ") s(name, url, source_type) where s.url not in (select url from sources)")
def seeded_sources(spark: SparkSession, d: str) -> DataFrame:
    """Seed rows, a constant relation, added where their address is not there yet; adding them twice changes nothing."""
    s = table(spark, d, "sources").select("name", "url", "source_type")
    seeds = spark.createDataFrame(_SEEDS, "name string, url string, source_type string")
    once = insert_missing(s, seeds, ["url"])
    return insert_missing(once, seeds, ["url"])


# ---- state


@query(
    "with e as (select *, sum(case when event_type = 'error' then 0 else 1 end) over (partition by user_id order by ts, event_id) as island from events), r as (select *, case when event_type = 'error' then count(*) filter (where event_type = 'error') over (partition by user_id, island order by ts, event_id) else 0 end as run from e),"
    " l as (select user_id, arg_max(run, (ts, event_id)) as run, arg_max(event_type, (ts, event_id)) as kind, arg_max(event_id, (ts, event_id)) as event_id, max(ts) filter (where event_type <> 'error') as good, max(ts) as ended from r group by 1)"
    " select user_id, run::int as error_count, case when kind = 'error' then 'failed ' || event_id end as last_error, case when run >= 3 then epoch_us(ended) + 6 * 3600000000 end as cooldown_until, epoch_us(good) as succeeded from l"
)
def breaker_state(spark: SparkSession, d: str) -> DataFrame:
    """The state of each circuit breaker after all events: the third failure in a row and each further one set the cooldown, a success clears it."""
    e = table(spark, d, "events").select("user_id", "event_id", F.col("ts").cast("timestamp").alias("ts"), (F.col("event_type") == "error").alias("failed"), F.concat(F.lit("failed "), F.col("event_id").cast("string")).alias("error"))
    s = surface_state(e, "user_id", ["ts", "event_id"], "failed", "ts", "error")
    return s.select("user_id", "error_count", "last_error", F.unix_micros("cooldown_until").alias("cooldown_until"), F.unix_micros("last_successful_discovery_at").alias("succeeded"))


@query(
    "with u as (select id as source_id from sources where id < '8') select coalesce(s.source_id, u.source_id) as source_id, case when u.source_id is null then s.error_count else 0 end as error_count, case when u.source_id is null then s.last_error end as last_error, case when u.source_id is null then epoch_us(s.cooldown_until) end as cooldown_until, s.cursor_type from source_discovery_state s full join u on u.source_id = s.source_id"
)
def state_success(spark: SparkSession, d: str) -> DataFrame:
    """A success resets the errors and sets last_error and cooldown to null; what the update does not give stays."""
    state = table(spark, d, "source_discovery_state").select("source_id", "error_count", "last_error", "cooldown_until", "cursor_type")
    done = table(spark, d, "sources").where("id < '8'").select(F.col("id").alias("source_id"), F.lit(0).alias("error_count"), F.lit(None).cast("string").alias("last_error"), F.lit(None).cast("timestamp").alias("cooldown_until"))
    return upsert_state(state, done, "source_id", ["last_error", "cooldown_until"]).select("source_id", "error_count", "last_error", F.unix_micros("cooldown_until").alias("cooldown_until"), "cursor_type")


@query(
    "with n as (select source_id, max(created_at) as at from articles group by 1) select s.source_id, coalesce(len(map_keys(last_sitemap_checkpoint)), 0) + case when n.at is not null and not coalesce(list_contains(map_keys(last_sitemap_checkpoint), 'news'), false) then 1 else 0 end as surfaces, strftime(n.at, '%Y-%m-%dT%H:%M:%SZ') as news from source_discovery_state s left join n on n.source_id = s.source_id"
)
def sitemap_checkpoint_write(spark: SparkSession, d: str) -> DataFrame:
    """Checkpoint maps after a run: the newest instant of each source under the key of its surface."""
    newest = table(spark, d, "articles").groupBy("source_id").agg(F.max("created_at").alias("at"))
    state = table(spark, d, "source_discovery_state").select("source_id", "last_sitemap_checkpoint").join(newest, "source_id", "left")
    made = state.withColumn("m", checkpoint_after(F.col("last_sitemap_checkpoint"), F.lit("news"), F.col("at")))
    return made.select("source_id", F.coalesce(F.size("m"), F.lit(0)).cast("long").alias("surfaces"), F.try_element_at("m", F.lit("news")).alias("news"))


@query(
    "with c as (select a.id, a.source_id, coalesce(case when epoch_us(last_cursor_published_at) is null then true when epoch_us(a.created_at) = epoch_us(last_cursor_published_at) then false else epoch_us(a.created_at) > epoch_us(last_cursor_published_at) end, true) as kept from articles a left join source_discovery_state s on s.source_id = a.source_id)"
    " select source_id, count(*) filter (where kept) as kept, count(*) filter (where not kept) as dropped from c group by 1"
)
def cursor_dropped(spark: SparkSession, d: str) -> DataFrame:
    """How many candidates of each source its cursor lets pass and drops."""
    state = table(spark, d, "source_discovery_state").select("source_id", "last_cursor_published_at", "last_cursor_url")
    joined = table(spark, d, "articles").select("source_id", "created_at", "url").join(state, "source_id", "left")
    kept = after_feed_cursor(F.col("created_at"), F.col("last_cursor_published_at"), F.col("url"), F.col("last_cursor_url"), F.lit(False))
    return joined.withColumn("kept", kept).groupBy("source_id").agg(F.count_if("kept").alias("kept"), F.count_if(~F.col("kept")).alias("dropped"))


# ---- payloads


@query("select s.id as source, (row_number() over (partition by s.id order by a.id) - 1)::int as pos, a.url, coalesce(a.title, '') as title from articles a join sources s on s.id = a.source_id where coalesce(a.url, '') <> '' and s.id >= '2'")
def map_payload(spark: SparkSession, d: str) -> DataFrame:
    """A site-map answer for each source, read back; broken answers, links that are no objects and links without an address are dropped."""
    a = table(spark, d, "articles").select("source_id", "id", "url", "title")
    # one answer holds the links of one site; its size is the service's limit
    made = a.groupBy("source_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("id", "url", "title"))), lambda x: F.to_json(F.struct(x["url"].alias("url"), x["title"].alias("title")))).alias("links"))
    good = F.concat(F.lit('{"links":['), F.array_join("links", ","), F.lit(',"https://bare.example/",{"title":"no address"}]}'))
    answers = made.select(F.col("source_id").alias("source"), F.when(F.col("source_id") < "2", F.lit('{"links":[{"url":')).otherwise(good).alias("body"))
    return map_links(answers).select("source", "pos", "url", "title")


@query(
    "select id, case when id < '2' or raw_markdown is null then false else true end as success, case when id < '2' or raw_markdown is null then 0 else len(list_filter(regexp_split_to_array(raw_markdown, '\\s+'), lambda x: x <> '')) end as words, length(case when id < '2' or raw_markdown is null then '' else raw_markdown end) as chars from articles where not regexp_matches(coalesce(raw_markdown, ''), '[^ -~\\n\\r\\t]')"
)
def scrape_payload(spark: SparkSession, d: str) -> DataFrame:
    """Scrape answers for the articles in plain ASCII, some of them failed, read back."""
    a = table(spark, d, "articles").where(~F.coalesce("raw_markdown", F.lit("")).rlike(r"[^ -~\n\r\t]")).select("id", "raw_markdown")
    ok = (F.col("id") >= "2") & F.col("raw_markdown").isNotNull()
    body = F.when(ok, F.to_json(F.struct(F.lit(True).alias("success"), F.struct(F.col("raw_markdown").alias("markdown")).alias("data")))).otherwise(F.lit('{"success":false,"error":"blocked"}'))
    return scraped_pages(a.select("id", body.alias("body"))).select("id", "success", F.col("word_count").cast("long").alias("words"), F.length("markdown").cast("long").alias("chars"))


@query("select id, article_count::bigint as remaining_credits, 1000::bigint as plan_credits, strftime(started_at, '%Y-%m-%d') as billing_period_start from crawl_runs")
def credit_payload(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "crawl_runs")
    data = F.struct(F.col("article_count").cast("long").alias("remaining_credits"), F.lit(1000).alias("plan_credits"), F.date_format("started_at", "yyyy-MM-dd").alias("billing_period_start"))
    return credit_usage(r.select("id", F.to_json(F.struct(data.alias("data"))).alias("body"))).select("id", "remaining_credits", "plan_credits", "billing_period_start")


@query(
    "select id, url, case when id < '4' then 'A é A & ' || substr(id, 1, 4) when id < '8' then 'T<b>' || substr(id, 1, 4) || '</b>' else 'x' end as title, case when id < '8' and id >= '4' then 'first' else '' end as description, case when id >= '4' and id < '8' then 1783504800 end as at from articles where id < '8' or id >= 'e'"
)
def feed_parse_hostile(spark: SparkSession, d: str) -> DataFrame:
    """Payloads that mislead pattern matching: character references, CDATA with markup, a prefixed self-closed link, cut-off documents, alternatives in order of the document."""
    a = table(spark, d, "articles").select("id", F.replace("url", F.lit("&"), F.lit("&amp;")).alias("u"), F.substring("id", 1, 4).alias("k"))
    forms = [
        ("4", '<rss xmlns:atom="a"><channel><item><title>A &#233; &#x41; &amp; %2$s</title><link>%1$s</link></item></channel></rss>'),
        ("8", '<?xml version="1.0"?><!-- <rss> --><rss xmlns:dc="d"><channel><item><title><![CDATA[T<b>%2$s</b>]]></title><link>%1$s</link><summary>first</summary><description>second</description><dc:date>2026-07-08T10:00:00Z</dc:date><pubDate>Wed, 08 Jul 2020 10:00:00 GMT</pubDate></item></channel></rss>'),
        ("b", '<rss><channel><item><title>%2$s</title><link>%1$s</link></item><item><ti'),
        ("e", '<rss xmlns:atom="a"><channel><item><atom:link rel="self" href="https://x.example/"/><title>%2$s</title><link>%1$s</link></item></channel></rss>'),
    ]
    body = F.lit(None).cast("string")
    for below, form in reversed(forms):
        body = F.when(F.col("id") < below, F.format_string(form, "u", "k")).otherwise(F.coalesce(body, F.format_string('<feed xmlns="http://www.w3.org/2005/Atom"><entry><link rel="self" href="s"/><link href="%1$s"/><title>x</title></entry></feed>', "u")))
    return feed_entries(a.select("id", body.alias("body"))).select("id", "url", "title", "description", F.unix_seconds("published_at").alias("at"))


# ---- listings, ranks and pages of reports


@query("select source_id as target, arg_min(url, id) as newest_url from articles where length(coalesce(title, '')) >= 40 group by 1")
def newest_per_target(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "articles").select("source_id", "url", "id", F.when(F.length(F.coalesce("title", F.lit(""))) >= 40, 4).otherwise(3).alias("score"))
    return newest_of_target(a, "source_id", "url", "id", "score").withColumnRenamed("source_id", "target")


@query("select id, source_id, api_rank from (select id, source_id, row_number() over (partition by source_id order by id) as api_rank from articles where discovery_method = 'map') where api_rank <= 15")
def map_order_top(spark: SparkSession, d: str) -> DataFrame:
    """Map results keep the service's order, here that of the ids."""
    return first_in_order(table(spark, d, "articles").where("discovery_method = 'map'").select("id", "source_id"), "source_id", "id", 15)


@query("select canonical_name as canonical, entity_type as kind, size from (select trim(canonical_name) as canonical_name, trim(entity_type) as entity_type, count(*) as size from entities where trim(coalesce(canonical_name, '')) <> '' and trim(coalesce(entity_type, '')) <> '' group by 1, 2 having count(*) > 1)")
def duplicate_groups_sorted(spark: SparkSession, d: str) -> DataFrame:
    """The groups of duplicates in the order of their keys."""
    groups = duplicate_groups(table(spark, d, "entities"), F.col("canonical_name"), F.col("entity_type")).select("canonical", "kind", "size").distinct()
    return groups.orderBy("canonical", "kind")


@query("select id, started_at_us from (select id, epoch_us(started_at) as started_at_us from crawl_runs order by started_at desc, id limit 20 offset 20)")
def runs_page(spark: SparkSession, d: str) -> DataFrame:
    """The second page of runs, latest first."""
    return table(spark, d, "crawl_runs").orderBy(F.desc("started_at"), "id").offset(20).limit(20).select("id", F.unix_micros("started_at").alias("started_at_us"))


@query("select id, confidence_score::double as score from (select * from articles order by confidence_score desc nulls last, priority_level asc nulls last, id limit 50)")
def feed_sorted(spark: SparkSession, d: str) -> DataFrame:
    """A page of the feed sorted by columns of the user's choice; nulls last, ties by id."""
    wanted = [("confidence_score", False), ("priority_level", True)]
    order = [F.col(c).asc_nulls_last() if up else F.col(c).desc_nulls_last() for c, up in wanted]
    return table(spark, d, "articles").orderBy(*order, "id").limit(50).select("id", F.col("confidence_score").cast("double").alias("score"))


_REQUIRED = [("articles", "url"), ("articles", "title"), ("articles", "raw_markdown"), ("entities", "canonical_name"), ("sources", "extraction_mode"), ("crawl_runs", "completed_at")]


@query(" union all ".join(f"select 'not null {t}.{c}' as check_name, count(*) filter (where {c} is null) as violations from {t}" for t, c in _REQUIRED))
def not_null_asserts(spark: SparkSession, d: str) -> DataFrame:
    return not_null({t: table(spark, d, t) for t, _ in _REQUIRED}, _REQUIRED)


@query("select id, 'T ' || coalesce(title, 'N/A') || chr(10) || 'U ' || coalesce(url, 'N/A') || case when id < '8' then chr(10) || chr(10) || 'Answer in JSON only.' else '' end as prompt from articles")
def prompts_with_retry(spark: SparkSession, d: str) -> DataFrame:
    note = F.when(F.col("id") < "8", " Answer in JSON only. ").otherwise(F.lit(" "))
    return table(spark, d, "articles").select("id", prompt("T %s\nU %s", note, title=F.col("title"), url=F.col("url")).alias("prompt"))


@query("select id, coalesce(nullif(trim(title), ''), nullif(trim(url), ''), 'Untitled') as title, case when id < '8' then 'low' else priority_level end as analysed, case when id < '8' then 'medium' else priority_level end as written from articles")
def answer_defaults(spark: SparkSession, d: str) -> DataFrame:
    """The two sets of defaults, of the analysis and of the write."""
    answer = F.struct("title", F.when(F.col("id") >= "8", F.col("priority_level")).alias("priority_level"))
    one, two = (with_defaults(answer, F.col("url"), stage) for stage in ("analysis", "write"))
    return table(spark, d, "articles").select("id", one["title"].alias("title"), one["priority_level"].alias("analysed"), two["priority_level"].alias("written"))


# ---- the rules of known sources

_NAMES = sorted(SOURCE_RULES)
_SQ = lambda s: "'" + s.replace("'", "''") + "'"
_RULES_SQL = ", ".join("(" + ", ".join([_SQ(n)] + ["[" + ", ".join(_SQ(x) for x in SOURCE_RULES[n].get(k, [])) + "]::varchar[]" for k in ("include_keywords", "include_regexes", "exclude_regexes", "non_article_exceptions")]) + ")" for n in _NAMES)
_WORDS_SQL = "['/article/','/articles/','/news/','/story/','/stories/','/post/','/posts/','/read/','/abs/']"
_NON_SQL = r"(?i)/about(?:/|$)|/author(?:/|$)|/authors(?:/|$)|/staff(?:/|$)|/tag(?:/|$)|/category(?:/|$)|/categories(?:/|$)|/topics?(?:/|$)|/events?(?:/|$)|/jobs?(?:/|$)|/careers?(?:/|$)|/contact(?:/|$)|/privacy(?:/|$)|/terms(?:/|$)|/newsletter(?:/|$)|/subscribe(?:/|$)|/login(?:/|$)|/search(?:/|$)|/sitemap|/wp-json|/content/early/|\.xml$"
_PATHS = ["/2026/07/08/some-news/", "/news/big-deal/812345/", "/articles/s41587-026-01234-5", "/topics/omics/some-slug", "/topics/omics/", "/abs/2607.01234", "/content/10.1101/2026.07.01.1", "/doi/10.1126/x", "/biotech/a-slug", "/about/", "/pharmalot/2026/07/08/x", "/list/q-bio/new"]
_PATHS_SQL = "[" + ", ".join(_SQ(x) for x in _PATHS) + "]"


@query(
    rf"with r(name, kw, rx, ex, xc) as (values {_RULES_SQL}), u as (select name, kw, rx, ex, xc, 'https://x.example' || unnest({_PATHS_SQL}) as url from r),"
    r" f as (select *, len(list_filter(kw, lambda w: contains(lower(url), lower(w)))) > 0 as k, len(list_filter(rx, lambda p: regexp_matches(url, '(?i)' || p))) > 0 as p from u)"
    rf" select name, url, (case when regexp_matches(url, '/20\d\d/\d\d/(?:\d\d/)?') then 4 else 0 end) + (case when len(list_filter({_WORDS_SQL}, lambda w: contains(lower(url), w))) > 0 then 5 else 0 end) + (case when k then 5 else 0 end) + (case when p then 7 else 0 end)"
    rf" + (case when regexp_matches(lower(url), '/abs/|/doi/|/content/10\.1101/') then 6 else 0 end) - (case when not (k or p) then 20 else 0 end) + 2"
    rf" - (case when len(list_filter(xc, lambda p: regexp_matches(url, '(?i)' || p))) = 0 and (regexp_matches(url, '{_NON_SQL}') or len(list_filter(ex, lambda p: regexp_matches(url, '(?i)' || p))) > 0) then 20 else 0 end) as score from f"
)
def score_rules(spark: SparkSession, d: str) -> DataFrame:
    """Every form of address under the rule of every known source, as entries of a feed."""
    rules = with_rules(spark.createDataFrame([(n,) for n in _NAMES], "name string"), rules_table(spark), "name")
    links = rules.select("*", F.explode(F.array(*[F.lit("https://x.example" + x) for x in _PATHS])).alias("url"))
    s = link_score(F.col("url"), F.lit("A title of more than twenty-five letters"), F.lit("short"), F.lit("rss_feed"), *[F.col(c) for c in ("include_keywords", "include_regexes", "exclude_regexes", "non_article_exceptions")])
    return links.select("name", "url", s.alias("score"))
