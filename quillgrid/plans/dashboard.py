"""Queries of the reports: counts, trends, health, coverage, filters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quillgrid.operators.discovery import budget_mode, yield_drift
from quillgrid.plans.registry import NOW_MICROS, query
from quillgrid.runtime import table

_DAY_US = 86_400_000_000
_TODAY = "2026-04-10"
_DATE = "make_timestamp(epoch_us({}))::date::varchar"


def _at(micros: int):
    """An instant as a literal, so that comparisons with it reach the scan."""
    return F.timestamp_micros(F.lit(micros))


def _day(c: str):
    return F.date_format(c, "yyyy-MM-dd")


@query(
    f"select count(*) as total, count(*) filter (where priority_level = 'high') as high, count(*) filter (where list_contains(topic_tags, 'M&A') or len(list_filter(topic_tags, lambda t: contains(lower(t), 'funding'))) > 0) as deals,"
    f" (select count(*) from articles where {_DATE.format('created_at')} = '2026-04-09') as yesterday, (select count(*) from sources where enabled) as enabled_sources, (select count(*) from sources) as all_sources, (select count(*) from articles where status = 'new') as needs_review"
    f" from articles where {_DATE.format('created_at')} = '{_TODAY}'"
)
def overview_kpis(spark: SparkSession, d: str) -> DataFrame:
    """One pass over the articles and one over the sources, each reduced to a row."""
    deals = F.array_contains("topic_tags", "M&A") | F.exists("topic_tags", lambda t: F.contains(F.lower(t), F.lit("funding")))
    day = _day("created_at")
    today = day == _TODAY
    a = table(spark, d, "articles").agg(
        F.count_if(today).alias("total"),
        F.count_if(today & (F.col("priority_level") == "high")).alias("high"),
        F.count_if(today & deals).alias("deals"),
        F.count_if(day == "2026-04-09").alias("yesterday"),
        F.count_if(F.col("status") == "new").alias("needs_review"),
    )
    s = table(spark, d, "sources").agg(F.count_if("enabled").alias("enabled_sources"), F.count(F.lit(1)).alias("all_sources"))
    return a.crossJoin(s)


@query(f"with c as (select {_DATE.format('created_at')} as day, count(*) as articles from articles group by 1) select day, articles, articles - lag(articles) over (order by day) as delta from c")
def daily_delta(spark: SparkSession, d: str) -> DataFrame:
    """One row per day, so the unpartitioned window runs over days, not articles."""
    days = table(spark, d, "articles").groupBy(_day("created_at").alias("day")).agg(F.count(F.lit(1)).alias("articles"))
    return days.withColumn("delta", F.col("articles") - F.lag("articles").over(Window.orderBy("day")))


@query(f"select {_DATE.format('created_at')} as day, status, count(*) as articles from articles group by all")
def ingestion_by_day_status(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "articles").groupBy(_day("created_at").alias("day"), "status").agg(F.count(F.lit(1)).alias("articles"))


@query(f"select {_DATE.format('created_at')} as day, count(*) filter (where priority_level = 'high') as high, count(*) filter (where priority_level = 'medium') as medium, count(*) filter (where priority_level = 'low') as low from articles group by 1")
def priority_pivot(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "articles").groupBy(_day("created_at").alias("day")).pivot("priority_level", ["high", "medium", "low"]).agg(F.count(F.lit(1)))
    return p.select("day", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("high", "medium", "low")])


@query("select tag, count(*) as articles from (select unnest(topic_tags) as tag from articles) group by 1 order by articles desc, tag limit 30")
def tag_frequency(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "articles").select(F.explode("topic_tags").alias("tag")).groupBy("tag").agg(F.count(F.lit(1)).alias("articles")).orderBy(F.desc("articles"), "tag").limit(30)


@query("select floor(least(confidence_score::double, 0.999) / 0.2)::bigint as bucket, count(*) as articles from articles where confidence_score is not null group by 1")
def score_histogram(spark: SparkSession, d: str) -> DataFrame:
    bucket = F.floor(F.least(F.col("confidence_score").cast("double"), F.lit(0.999)) / 0.2)
    return table(spark, d, "articles").where("confidence_score is not null").groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("articles"))


@query(
    f"with w as (select * from crawl_runs where epoch_us(started_at) >= {NOW_MICROS} - 90 * {_DAY_US}), l as (select article_count from crawl_runs order by started_at desc, id limit 7)"
    " select round(100.0 * count(*) filter (where status = 'success') / nullif(count(*), 0), 4) as success_rate, sum(error_count)::bigint as errors, (select round(avg(article_count), 4) from l) as avg_articles from w"
)
def run_health(spark: SparkSession, d: str) -> DataFrame:
    runs = table(spark, d, "crawl_runs")
    recent = runs.where(F.col("started_at") >= _at(NOW_MICROS - 90 * _DAY_US)).agg(F.round(F.try_divide(100.0 * F.count_if(F.col("status") == "success"), F.count(F.lit(1))), 4).alias("success_rate"), F.sum("error_count").alias("errors"))
    last = runs.orderBy(F.desc("started_at"), "id").limit(7).agg(F.round(F.avg("article_count"), 4).alias("avg_articles"))
    return recent.crossJoin(last)


@query(f"select {_DATE.format('started_at')} as day, sum(article_count)::bigint as articles, sum(error_count)::bigint as errors, count(*) as runs, sum(epoch_us(completed_at) - epoch_us(started_at))::bigint as busy from crawl_runs group by 1")
def run_trend(spark: SparkSession, d: str) -> DataFrame:
    took = F.unix_micros("completed_at") - F.unix_micros("started_at")
    return table(spark, d, "crawl_runs").groupBy(_day("started_at").alias("day")).agg(F.sum("article_count").alias("articles"), F.sum("error_count").alias("errors"), F.count(F.lit(1)).alias("runs"), F.sum(took).alias("busy"))


@query(
    "with r as (select id as run_id, started_at from crawl_runs order by started_at desc, id limit 14), c as (select source_id, crawl_run_id, count(*) as n from articles group by all)"
    " select s.id as source_id, r.run_id, coalesce(c.n, 0) as articles from sources s cross join r left join c on c.source_id = s.id and c.crawl_run_id = r.run_id"
)
def source_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Every source by the last fourteen runs. The grid is a product of two dimensions, at most 14 rows a source; the articles are counted before they meet it."""
    runs = table(spark, d, "crawl_runs").orderBy(F.desc("started_at"), "id").limit(14).select(F.col("id").alias("run_id"))
    counts = table(spark, d, "articles").join(runs, F.col("crawl_run_id") == F.col("run_id"), "left_semi").groupBy("source_id", F.col("crawl_run_id").alias("run_id")).agg(F.count(F.lit(1)).alias("n"))
    grid = table(spark, d, "sources").select(F.col("id").alias("source_id")).crossJoin(runs)
    return grid.join(counts, ["source_id", "run_id"], "left").select("source_id", "run_id", F.coalesce("n", F.lit(0)).alias("articles"))


@query(
    f"select id from articles where epoch_us(created_at) between {NOW_MICROS} - 200 * {_DAY_US} and {NOW_MICROS} and priority_level in ('high', 'medium') and status = 'analyzed' and list_has_any(topic_tags, ['Oncology', 'M&A', 'Funding']) and (title ilike '%reports%' or title ilike '%delays%')"
    " order by created_at desc, id limit 25 offset 5"
)
def feed_filter_page(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "articles")
    kept = a.where(F.col("created_at").between(_at(NOW_MICROS - 200 * _DAY_US), _at(NOW_MICROS)) & F.col("priority_level").isin("high", "medium") & (F.col("status") == "analyzed")).where(
        F.arrays_overlap("topic_tags", F.array(F.lit("Oncology"), F.lit("M&A"), F.lit("Funding"))) & (F.col("title").ilike("%reports%") | F.col("title").ilike("%delays%"))
    )
    return kept.orderBy(F.desc("created_at"), "id").offset(5).limit(25).select("id")


@query("select id from articles where (list_contains(topic_tags, 'M&A') or array_to_string(topic_tags, '|') ilike '%funding%')")
def tag_containment(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "articles").where(F.array_contains("topic_tags", "M&A") | F.array_join("topic_tags", "|").ilike("%funding%")).select("id")


@query("select id, status, error_count from crawl_runs where status <> 'success' order by started_at desc, id limit 10")
def failed_runs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "crawl_runs").where("status <> 'success'").orderBy(F.desc("started_at"), "id").limit(10).select("id", "status", "error_count")


@query("select id, title from articles where priority_level = 'high' order by created_at desc, id limit 5")
def latest_high_priority(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "articles").where("priority_level = 'high'").orderBy(F.desc("created_at"), "id").limit(5).select("id", "title")


@query(
    "with g as (select article_id, count(*) as entities, string_agg(n.name, '; ' order by n.name, n.id) as names from (select distinct article_id, entity_id from article_entities) l join entities n on n.id = l.entity_id group by 1)"
    " select a.id, s.name as source, coalesce(g.entities, 0) as entities, coalesce(g.names, '') as names from articles a left join sources s on s.id = a.source_id left join g on g.article_id = a.id"
)
def article_detail(spark: SparkSession, d: str) -> DataFrame:
    links = table(spark, d, "article_entities").select("article_id", "entity_id").distinct()
    named = links.join(table(spark, d, "entities").select(F.col("id").alias("entity_id"), "name"), "entity_id")
    g = named.groupBy("article_id").agg(F.count(F.lit(1)).alias("entities"), F.array_sort(F.collect_list(F.struct("name", "entity_id"))).alias("list"))
    a = table(spark, d, "articles").select("id", "source_id").join(table(spark, d, "sources").select(F.col("id").alias("source_id"), F.col("name").alias("source")), "source_id", "left")
    names = F.array_join(F.transform("list", lambda x: x["name"]), "; ")
    return a.join(g, F.col("id") == F.col("article_id"), "left").select("id", "source", F.coalesce("entities", F.lit(0)).alias("entities"), F.coalesce(names, F.lit("")).alias("names"))


@query("select 'articles' as name, count(*) as n from articles union all select 'sources', count(*) from sources union all select 'entities', count(*) from entities union all select 'article_entities', count(*) from article_entities union all select 'crawl_runs', count(*) from crawl_runs")
def table_counts(spark: SparkSession, d: str) -> DataFrame:
    names = ("articles", "sources", "entities", "article_entities", "crawl_runs")
    parts = [table(spark, d, n).agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("name"), "n") for n in names]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query(
    f"with u as (select count(*) as used, count(distinct {_DATE.format('created_at')}) as days from articles) select used, days, case when (2.0 * used - used - (used::double / days) * 10) / (2.0 * used) > 0.3 then 'normal' when (2.0 * used - used - (used::double / days) * 10) / (2.0 * used) > 0.1 then 'conserve' else 'critical' end as mode from u"
)
def budget(spark: SparkSession, d: str) -> DataFrame:
    u = table(spark, d, "articles").agg(F.count(F.lit(1)).alias("used"), F.count_distinct(_day("created_at")).alias("days"))
    total = F.col("used") * 2.0
    return u.select("used", "days", budget_mode(total - F.col("used"), total, F.try_divide(F.col("used"), F.col("days")), F.lit(10)).alias("mode"))


@query(
    "select id, previous, coalesce(previous > 0 and article_count < previous * (1 - 0.7), false) as drifted from (select *, lag(article_count) over (partition by run_type order by started_at, id) as previous from crawl_runs)"
)
def discovery_drift(spark: SparkSession, d: str) -> DataFrame:
    runs = table(spark, d, "crawl_runs").withColumn("at", F.struct("started_at", "id"))
    return yield_drift(runs, "run_type", "at", "article_count").select("id", "previous", "drifted")


@query("select id, epoch_us(started_at) as at from crawl_runs order by started_at desc, id limit 1")
def latest_run(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "crawl_runs").orderBy(F.desc("started_at"), "id").limit(1).select("id", F.unix_micros("started_at").alias("at"))


