"""Queries on runs, deliveries, model requests and answers, and plain scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillgrid.functions.entity import fingerprint, invalidation, tags_of
from quillgrid.functions.text import prompt
from quillgrid.operators.runs import answer_status, ask_model, delivery_log, digest_markdown, finish_run, patch_targets, request_json, run_totals
from quillgrid.operators.warehouse import cascade_delete, deletable
from quillgrid.plans.registry import NOW, NOW_MICROS, query
from quillgrid.runtime import table
from quillgrid.sources.tables import scan


def _now() -> F.Column:
    return F.lit(NOW).cast("timestamp")


@query("select id, name, source_type from sources where domain = 'biotech' and source_type = 'news' and enabled")
def table_scan(spark: SparkSession, d: str) -> DataFrame:
    return scan(spark, d, "sources", {"domain": "biotech", "source_type": "news", "enabled": True}, ["id", "name", "source_type"])


@query("select s.id, s.name, t.cursor_type, coalesce(t.error_count, 0) as error_count from sources s left join source_discovery_state t on t.source_id = s.id")
def state_read(spark: SparkSession, d: str) -> DataFrame:
    state = table(spark, d, "source_discovery_state").select("source_id", "cursor_type", "error_count")
    return table(spark, d, "sources").join(state, F.col("id") == F.col("source_id"), "left").select("id", "name", "cursor_type", F.coalesce("error_count", F.lit(0)).alias("error_count"))


@query("select id, canonical_name from entities where canonical_name is not null")
def named_entities(spark: SparkSession, d: str) -> DataFrame:
    """In order of creation: a range-partitioned sort, not a rank."""
    return table(spark, d, "entities").where("canonical_name is not null").orderBy("created_at", "id").select("id", "canonical_name")


_WRITTEN = "w as (select crawl_run_id, case when status = 'error' then 'failed' when discovery_method = 'rss' then 'refreshed_changed' else 'inserted' end as disposition, case when status = 'error' then 1 else 0 end as ae, case when status = 'paywalled' then 1 end as le from articles), t as (select crawl_run_id, count(*) filter (where disposition <> 'failed') as articles, sum(ae + coalesce(le, 0))::bigint as errors from w group by 1)"


def _totals(spark: SparkSession, d: str) -> DataFrame:
    error = F.col("status") == "error"
    w = table(spark, d, "articles").select(
        "crawl_run_id",
        F.when(error, "failed").when(F.col("discovery_method") == "rss", "refreshed_changed").otherwise("inserted").alias("disposition"),
        error.cast("int").alias("ae"),
        F.when(F.col("status") == "paywalled", 1).alias("le"),
    )
    return run_totals(w, "crawl_run_id", "disposition", "ae", "le")


@query(f"with {_WRITTEN} select crawl_run_id, articles, errors, case when errors > 0 then 'partial_success' else 'success' end as status from t")
def run_summary(spark: SparkSession, d: str) -> DataFrame:
    return _totals(spark, d)


@query(
    f"with {_WRITTEN} select r.id, case when t.crawl_run_id is null then r.status when errors > 0 then 'partial_success' else 'success' end as status, coalesce(t.articles, r.article_count)::int as article_count, coalesce(t.errors, r.error_count)::int as error_count,"
    f" case when t.crawl_run_id is null then epoch_us(r.completed_at) else {NOW_MICROS} end as done from crawl_runs r left join t on t.crawl_run_id = r.id"
)
def run_finish(spark: SparkSession, d: str) -> DataFrame:
    done = finish_run(table(spark, d, "crawl_runs"), _totals(spark, d), "crawl_run_id", _now())
    return done.select("id", "status", "article_count", "error_count", F.unix_micros("completed_at").alias("done"))


@query(
    f"select id, case when id >= '8' then last_seen_url when id < '3' then last_seen_url when id < '6' then url || 'new' else last_seen_url end as seen, case when id >= '8' then last_error when id < '3' then 'timeout' end as error, case when id >= '8' then error_type when id < '3' then 'network' end as error_type,"
    f" case when id >= '8' then epoch_us(last_checked_at) else {NOW_MICROS} end as checked from source_category_targets"
)
def target_patch(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "source_category_targets")
    bad = F.col("id") < "3"
    results = t.where("id < '8'").select("id", F.when(~bad & (F.col("id") < "6"), F.concat("url", F.lit("new"))).alias("newest_url"), F.when(bad, "timeout").alias("error"), F.when(bad, "network").alias("error_type"))
    out = patch_targets(t, results, _now())
    return out.select("id", F.col("last_seen_url").alias("seen"), F.col("last_error").alias("error"), "error_type", F.unix_micros("last_checked_at").alias("checked"))


@query("select sha256(id || '|telegram|ops') as id, id as crawl_run_id, run_type || ' run: ' || article_count || ' articles, ' || error_count || ' errors' as message_preview from crawl_runs")
def delivery_rows(spark: SparkSession, d: str) -> DataFrame:
    return delivery_log(table(spark, d, "crawl_runs"), "telegram", "ops", _now()).select("id", "crawl_run_id", "message_preview")


@query(
    "select id, '## ' || coalesce(title, 'Untitled') || chr(10) || '- Priority: ' || priority_level || chr(10) || '- Tags: ' || case when len(topic_tags) > 0 then array_to_string(topic_tags, ', ') else 'none' end || chr(10) || '- URL: ' || url || chr(10) || chr(10)"
    " || case when trim(coalesce(summary, '')) <> '' then summary else 'No summary' end || chr(10) as block from articles"
)
def digest_blocks(spark: SparkSession, d: str) -> DataFrame:
    return digest_markdown(table(spark, d, "articles"))


@query("select id, 'Title: ' || coalesce(title, 'N/A') || chr(10) || 'Hint: ' || coalesce(summary, 'N/A') as prompt, length('{\"model\":\"m\",\"messages\":[{\"role\":\"user\",\"content\":\"') as head from articles")
def prompts(spark: SparkSession, d: str) -> DataFrame:
    p = prompt("Title: %s\nHint: %s", title=F.col("title"), hint=F.col("summary"))
    request = request_json("m", F.lit("x"))
    return table(spark, d, "articles").select("id", p.alias("prompt"), F.instr(request, 'x"}').alias("end")).select("id", "prompt", (F.col("end") - 1).cast("long").alias("head"))


@query(
    "with a as (select id, title, case when length(title) % 3 = 0 then 'no object' else '{\"title\":\"' || case when length(title) % 3 = 1 then '' else 'T' end || '\"}' end as answer from articles)"
    " select id, case when title is null then 'JSON_MALFORMED' when length(title) % 3 = 0 then 'JSON_MALFORMED' when length(title) % 3 = 1 then 'needs_review' else 'analyzed' end as status, case when title is null then 0 when length(title) % 3 = 2 then 1 else 2 end as attempts from a"
)
def model_answers(spark: SparkSession, d: str) -> DataFrame:
    """A stub model: its answer depends on the prompt's length; poor answers are asked for twice."""

    def stub(asked: list[str], attempt: int) -> list[str]:
        return ["no object" if len(p) % 3 == 0 else '{"title":"%s"}' % ("" if len(p) % 3 == 1 else "T") for p in asked]

    answers = ask_model(table(spark, d, "articles"), "id", "title", stub, lambda a: '"T"' in a)
    parsed = F.from_json(F.regexp_extract("answer", r"(?s)\{.*\}", 0), "title string")
    return answers.select("id", answer_status(F.col("answer"), parsed).alias("status"), "attempts")


@query(
    "select id, case when not (analysis_fingerprint.content_hash is not distinct from content_hash) then 'must' when not (analysis_fingerprint.prompt_template_version is not distinct from 'v1.2') or not (analysis_fingerprint.model is not distinct from 'model-a') then 'may' else 'no' end as again from articles"
)
def fingerprint_check(spark: SparkSession, d: str) -> DataFrame:
    now = fingerprint("v1.2", F.lit("model-a"), F.col("content_hash"))
    return table(spark, d, "articles").select("id", invalidation(F.col("analysis_fingerprint"), now).alias("again"))


@query("select id, len(topic_tags) as n, coalesce(array_to_string(topic_tags, '|'), '') as tags from articles")
def tag_normalize(spark: SparkSession, d: str) -> DataFrame:
    """Tags written as JSON text and read back."""
    t = tags_of(F.to_json("topic_tags"))
    return table(spark, d, "articles").select("id", F.size(t).cast("long").alias("n"), F.array_join(t, "|").alias("tags"))


@query("select id from crawl_runs r where not exists (select 1 from articles a where a.crawl_run_id = r.id)")
def deletable_runs(spark: SparkSession, d: str) -> DataFrame:
    return deletable(table(spark, d, "crawl_runs"), table(spark, d, "articles"), "crawl_run_id").select("id")


@query("select l.id from article_entities l join articles a on a.id = l.article_id where a.status <> 'error'")
def cascaded_links(spark: SparkSession, d: str) -> DataFrame:
    return cascade_delete(table(spark, d, "article_entities"), table(spark, d, "articles").where("status <> 'error'"), "article_id").select("id")


@query("select id, case when status = 'new' and id < '8' then 'reviewed' else status end as status from articles")
def status_update(spark: SparkSession, d: str) -> DataFrame:
    changed = (F.col("status") == "new") & (F.col("id") < "8")
    return table(spark, d, "articles").select("id", F.when(changed, "reviewed").otherwise(F.col("status")).alias("status"))


@query("select source_type, extraction_mode, count(*) as sources, count(*) filter (where enabled) as enabled from sources group by all")
def source_mix(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "sources").groupBy("source_type", "extraction_mode").agg(F.count(F.lit(1)).alias("sources"), F.count_if("enabled").alias("enabled"))
