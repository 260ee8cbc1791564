"""Queries on page text: hashes, gates, hints, branches, model answers, digests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quillgrid.functions.entity import priority_rank, sanitize_entities, tags_of
from quillgrid.functions.text import file_name, hash_markdown, json_object, needs_expansion, paywall_signal, sentence_count, summary_hint, word_count
from quillgrid.operators.discovery import processing_branch
from quillgrid.plans.registry import query
from quillgrid.runtime import table
from quillgrid.sources.jsonl import assign_entities

_WS = r"[\t\n\v\f\r \x{85}\p{Z}]"
_NORMAL = (
    r"lower(regexp_replace(array_to_string(list_transform(string_split(regexp_replace(regexp_replace(regexp_replace(nfc_normalize(coalesce({t}, '')), '(?s)<!--.*?-->', '', 'g'), '[ \t]+', ' ', 'g'), '\r\n?', chr(10), 'g'), chr(10)),"
    r" lambda x: regexp_replace(x, '^WS+|WS+$', '', 'g')), chr(10)), '^WS+|WS+$', '', 'g'))".replace("WS", _WS)
)


def _normal(t: str) -> str:
    return _NORMAL.replace("{t}", t)


def _words(t: str) -> str:
    return f"coalesce(len(list_filter(regexp_split_to_array({t}, '{_WS}+'), lambda x: x <> '')), 0)"


def _sentences(t: str) -> str:
    return f"coalesce(len(list_filter(regexp_split_to_array({t}, '[.!?。！？]+'), lambda x: regexp_replace(x, '{_WS}+', '', 'g') <> '')), 0)"


@query(f"select id, sha256({_normal('raw_markdown')}) as hash from articles")
def content_hash(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "articles").select("id", hash_markdown(F.col("raw_markdown")).alias("hash"))


@query(f"select sha256({_normal('text')}) as hash, min(doc_id) as doc_id, count(*) as copies from documents where text is not null group by 1")
def content_hash_dedupe(spark: SparkSession, d: str) -> DataFrame:
    hashed = table(spark, d, "documents").where("text is not null").select("doc_id", hash_markdown(F.col("text")).alias("hash"))
    return hashed.groupBy("hash").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies"))


@query(f"select id, {_words('raw_markdown')} as words, {_words('raw_markdown')} >= 300 as enough from articles")
def word_gate(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "articles").select("id", word_count(F.col("raw_markdown")).alias("words")).withColumn("enough", F.col("words") >= 300)


_S = f"regexp_replace(coalesce(summary, ''), '^{_WS}+|{_WS}+$', '', 'g')"


@query(f"select id, {_sentences('summary')} as sentences, ({_S} = '' or length({_S}) < 220 or {_sentences(_S)} < 4) as expand from articles")
def sentence_stats(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "articles").select("id", sentence_count(F.col("summary")).alias("sentences"), needs_expansion(F.col("summary")).alias("expand"))


@query(
    rf"select id, rtrim(substr(array_to_string(list_filter(list_transform(regexp_split_to_array(coalesce(raw_markdown, ''), '\r\n|\r|\n'), lambda x: regexp_replace(regexp_replace(regexp_replace(x, '^{_WS}+|{_WS}+$', '', 'g'), '^#+|#+$', '', 'g'), '^{_WS}+|{_WS}+$', '', 'g')), lambda x: x <> '')[1:3], ' '), 1, 480)) as hint from articles"
)
def summary_hint_lines(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "articles").select("id", summary_hint(F.col("raw_markdown")).alias("hint"))


_MARKED = "case when id < '4' then coalesce(raw_markdown, '') || ' Already a subscriber? [Log in] or purchase this article.' when id < '6' then 'Become a PREMIUM subscriber. ' || coalesce(raw_markdown, '') else raw_markdown end"
_SIGNAL = (
    "case when contains(lower({t}), 'sign up to read this article for free') then 'signup_gate' when contains(lower({t}), 'become a premium subscriber') then 'premium_gate' when contains(lower({t}), 'purchase this article') then 'purchase_gate'"
    " when contains(lower({t}), 'already a subscriber? [log in]') then 'subscriber_login_gate' when contains(lower({t}), 'just want immediate access to this one article? purchase it now') then 'purchase_gate' end"
)


def _marked() -> F.Column:
    t = F.coalesce("raw_markdown", F.lit(""))
    return F.when(F.col("id") < "4", F.concat(t, F.lit(" Already a subscriber? [Log in] or purchase this article."))).when(F.col("id") < "6", F.concat(F.lit("Become a PREMIUM subscriber. "), t)).otherwise(F.col("raw_markdown"))


@query(f"select id, {_SIGNAL.replace('{t}', 't')} as signal from (select id, {_MARKED} as t from articles)")
def paywall_scan(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "articles").select("id", paywall_signal(_marked()).alias("signal"))


@query(
    f"select id, case when status = 'error' or coalesce(t, '') = '' then 'error' when discovery_method = 'rss' and coalesce(content_hash, '') <> '' and content_hash = sha256({_normal('t')}) then 'unchanged'"
    f" when {_SIGNAL.replace('{t}', 't')} is not null then 'paywalled' when {_words('t')} < 300 then 'too_short' else 'analyze' end as branch from (select *, case when id >= '6' then raw_markdown else {_MARKED} end as t from articles)"
)
def process_branch(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "articles").withColumn("t", _marked())
    t = F.col("t")
    branch = processing_branch(
        (F.col("status") == "error") | (F.coalesce(t, F.lit("")) == ""), F.when(F.col("discovery_method") == "rss", "refresh").otherwise("new"), F.col("content_hash"), hash_markdown(t), paywall_signal(t), word_count(t)
    )
    return a.select("id", branch.alias("branch"))


@query(
    "with r as (select id, 'Sure, here it is: ' || chr(10) || '```json' || chr(10) || '{\"title\":\"' || replace(coalesce(title, ''), '\"', '') || '\",\"tags\":\"' || coalesce(topic_tags[1], '') || '\",\"priority_level\":\"' || priority_level || '\"}' || chr(10) || '```' as answer from articles),"
    " j as (select id, regexp_extract(answer, '(?s)\\{.*\\}', 0) as o from r)"
    " select id, nullif(trim(o::json->>'$.title'), '') as title, coalesce(o::json->>'$.tags', '') as tag, case when trim(coalesce(o::json->>'$.tags', '')) = '' then 0 else 1 end as tags, coalesce(nullif(o::json->>'$.priority_level', ''), 'medium') as priority from j"
)
def llm_json_extract(spark: SparkSession, d: str) -> DataFrame:
    """Model answers with prose and a fence around one object, read back; tags given as one text become a list."""
    a = table(spark, d, "articles")
    inner = F.concat(F.lit('{"title":"'), F.replace(F.coalesce("title", F.lit("")), F.lit('"'), F.lit("")), F.lit('","tags":"'), F.coalesce(F.get("topic_tags", F.lit(0)), F.lit("")), F.lit('","priority_level":"'), F.col("priority_level"), F.lit('"}'))
    answer = F.concat(F.lit("Sure, here it is: \n```json\n"), inner, F.lit("\n```"))
    o = a.select("id", F.from_json(json_object(answer), "title string, tags string, priority_level string").alias("o"))
    title = F.trim("o.title")
    return o.select("id", F.when(title != "", title).alias("title"), F.coalesce("o.tags", F.lit("")).alias("tag"), F.size(tags_of(F.col("o.tags"))).alias("tags"), F.coalesce(F.when(F.col("o.priority_level") != "", F.col("o.priority_level")), F.lit("medium")).alias("priority"))


@query(
    "select id, case when trim(name) = '' then null else trim(name) end as name, case when lower(trim(entity_type)) in ('company','person','drug','technology','deal') and id >= '5' then lower(trim(entity_type)) else 'company' end as entity_type from entities where trim(name) <> ''"
)
def entity_sanitize(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "entities")
    kind = F.when(F.col("id") >= "5", F.col("entity_type")).otherwise(F.lit("gadget"))
    one = e.select("id", F.explode(sanitize_entities(F.array(F.struct("name", kind.alias("entity_type"))))).alias("x"))
    return one.select("id", "x.name", "x.entity_type")


@query(
    "with e as (select l.article_id, n.name, n.entity_type, l.mention_count, l.id from article_entities l join entities n on n.id = l.entity_id)"
    " select a.id as article_id, count(e.id) as entities, coalesce(sum(e.mention_count), 0)::bigint as mentions, coalesce(min(e.name), '') as first_name from articles a left join e on e.article_id = a.id group by a.id"
)
def jsonl_tagged_lines(spark: SparkSession, d: str) -> DataFrame:
    """Articles and their links written as tagged lines and read back: each entity line belongs to the article before it."""
    articles = table(spark, d, "articles").select(F.col("id").alias("file"), F.lit(0).alias("part"), F.lit("").alias("sub"), F.to_json(F.struct(F.col("id").alias("title"), "url", F.lit("").alias("summary"), "priority_level")).alias("line"))
    links = table(spark, d, "article_entities").join(table(spark, d, "entities").select(F.col("id").alias("entity_id"), "name", "entity_type"), "entity_id")
    tagged = links.select(F.col("article_id").alias("file"), F.lit(1).alias("part"), F.col("id").alias("sub"), F.concat(F.lit("ENTITY:"), F.to_json(F.struct("name", "entity_type", "role_in_article", "mention_count"))).alias("line"))
    order = Window.partitionBy("file").orderBy("part", "sub")
    lines = articles.unionByName(tagged).select("file", F.row_number().over(order).alias("line_no"), "line")
    a, e, _ = assign_entities(lines, "title string, url string, summary string, priority_level string", "name string, entity_type string, role_in_article string, mention_count int")
    joined = a.select("file", "article_no", F.col("article.title").alias("article_id")).join(e, ["file", "article_no"], "left")
    return joined.groupBy("article_id").agg(F.count("entity").alias("entities"), F.coalesce(F.sum("entity.mention_count"), F.lit(0)).alias("mentions"), F.coalesce(F.min("entity.name"), F.lit("")).alias("first_name"))


@query(
    "select id, upper(priority_level) || ' | ' || coalesce(substr(title, 1, 100), 'Untitled') || ' | ' || coalesce(case when len(topic_tags) > 0 then array_to_string(topic_tags, ', ') end, 'none') || ' | ' || coalesce(nullif(substr(summary, 1, 150), ''), 'No summary') as line, rank from"
    " (select *, row_number() over (order by case priority_level when 'high' then 3 when 'low' then 1 else 2 end desc, created_at desc, id) as rank from articles where status = 'analyzed') where rank <= 5"
)
def digest(spark: SparkSession, d: str) -> DataFrame:
    """The five leading articles as digest lines: a top-k report, so it has a limit."""
    a = table(spark, d, "articles").where("status = 'analyzed'")
    top = a.orderBy(priority_rank(F.col("priority_level")).desc(), F.col("created_at").desc(), "id").limit(5)
    ranked = top.withColumn("rank", F.row_number().over(Window.orderBy(priority_rank(F.col("priority_level")).desc(), F.col("created_at").desc(), "id")))
    tags = F.when(F.size("topic_tags") > 0, F.array_join("topic_tags", ", "))
    short = F.substring("summary", 1, 150)
    line = F.concat_ws(" | ", F.upper("priority_level"), F.coalesce(F.substring("title", 1, 100), F.lit("Untitled")), F.coalesce(tags, F.lit("none")), F.coalesce(F.when(short != "", short), F.lit("No summary")))
    return ranked.select("id", line.alias("line"), "rank")


@query(r"select id, substr(regexp_replace(translate(coalesce(title, ''), '/:', '__'), '[^\p{L}\p{N}_ .\-]', '', 'g'), 1, 80) as file from articles")
def markdown_file_names(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "articles").select("id", file_name(F.col("title")).alias("file"))
