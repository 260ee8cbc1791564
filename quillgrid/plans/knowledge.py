"""Queries on entities: canonical names, merges, rankings, the graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillgrid.functions.entity import DOTTED, SUFFIXES, backfilled_name, canonical_name
from quillgrid.operators.graph import co_occurrence, edge_width, induced, neighbourhood, node_size, node_weights, top_per_key
from quillgrid.operators.warehouse import add_links, duplicate_groups, merge_entities, merge_summary, resolve_entities
from quillgrid.plans.registry import query
from quillgrid.runtime import table


def _canonical_sql(name: str) -> str:
    s = rf"lower(trim(coalesce({name}, '')))"
    for x in SUFFIXES:
        s = rf"regexp_replace({s}, ',?\s*{x}" + (r"\.?" if x in DOTTED else "") + "$', '')"
    return rf"trim(regexp_replace(regexp_replace({s}, '[.,;: ]+$', ''), '\s+', ' ', 'g'))"


@query(f"select id, {_canonical_sql('name')} as canonical, lower(trim(name)) as backfilled from entities")
def entity_canonicalize(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "entities").select("id", canonical_name(F.col("name")).alias("canonical"), backfilled_name(F.col("name")).alias("backfilled"))


_GROUPS = f"""k as (select *, {_canonical_sql('name')} as c, lower(trim(entity_type)) as t from entities), m as (select c, t, arg_min(id, (epoch_us(created_at), id)) as master_id, count(*) as size from k where c <> '' and t <> '' group by c, t having count(*) > 1),
 g as (select k.c as canonical, k.t as kind, k.id, m.master_id, m.size from k join m on k.c = m.c and k.t = m.t)"""


def _groups(spark: SparkSession, d: str) -> DataFrame:
    return duplicate_groups(table(spark, d, "entities"), canonical_name(F.col("name")), F.lower(F.trim("entity_type")))


@query(f"with {_GROUPS} select * from g")
def entity_master(spark: SparkSession, d: str) -> DataFrame:
    return _groups(spark, d)


@query(
    f"with {_GROUPS}, l as (select article_id, coalesce(g.master_id, e.entity_id) as entity_id, mention_count, role_in_article from article_entities e left join g on g.id = e.entity_id and g.id <> g.master_id)"
    " select article_id, entity_id, sum(coalesce(mention_count, 0))::bigint as mention_count, coalesce(min(role_in_article), 'mentioned') as role_in_article from l group by all"
)
def entity_merge(spark: SparkSession, d: str) -> DataFrame:
    return merge_entities(table(spark, d, "article_entities"), _groups(spark, d))


@query(
    f"with {_GROUPS}, u as (select id as entity_id, master_id from g where id <> master_id), v as (select distinct l.article_id, l.entity_id, u.master_id from article_entities l join u on u.entity_id = l.entity_id),"
    " j as (select v.*, row_number() over (partition by article_id, master_id order by entity_id) = 1 and not exists (select 1 from article_entities x where x.article_id = v.article_id and x.entity_id = v.master_id) as re from v)"
    " select (select count(distinct master_id) from g) as groups_found, (select count(*) from u) as entities_to_merge, count(*) filter (where re) as article_links_reassigned, count(*) filter (where not re) as article_links_merged, (select count(*) from u) as entities_deleted from j"
)
def entity_merge_summary(spark: SparkSession, d: str) -> DataFrame:
    return merge_summary(table(spark, d, "article_entities"), _groups(spark, d))


@query("select e.name, e.entity_type, sum(l.mention_count)::bigint as mentions, count(*) as links from article_entities l join entities e on e.id = l.entity_id group by all order by mentions desc, name, entity_type limit 10")
def top_entities(spark: SparkSession, d: str) -> DataFrame:
    counted = table(spark, d, "article_entities").groupBy("entity_id").agg(F.sum("mention_count").alias("m"), F.count(F.lit(1)).alias("n"))
    named = counted.join(table(spark, d, "entities").select(F.col("id").alias("entity_id"), "name", "entity_type"), "entity_id")
    return named.groupBy("name", "entity_type").agg(F.sum("m").alias("mentions"), F.sum("n").alias("links")).orderBy(F.desc("mentions"), "name", "entity_type").limit(10)


@query("select entity_id, sum(coalesce(mention_count, 0))::bigint as weight, greatest(20, least(sum(coalesce(mention_count, 0)) * 3, 60))::bigint as size from article_entities group by 1")
def entity_nodes(spark: SparkSession, d: str) -> DataFrame:
    return node_weights(table(spark, d, "article_entities")).withColumn("size", node_size(F.col("weight")).cast("long"))


_EDGES = (
    "r as (select article_id, entity_id, row_number() over (partition by article_id order by entity_id, id) as n from article_entities),"
    " w as (select least(a.entity_id, b.entity_id) as source, greatest(a.entity_id, b.entity_id) as target, count(*) as weight from r a join r b on a.article_id = b.article_id and a.n < b.n group by all)"
)


@query(f"with {_EDGES} select source, target, weight, least(weight * 2, 10) as width from w")
def entity_edges(spark: SparkSession, d: str) -> DataFrame:
    return co_occurrence(table(spark, d, "article_entities")).withColumn("width", edge_width(F.col("weight")))


@query("with r as (select distinct article_id, entity_id from article_entities) select a.entity_id as source, b.entity_id as target, count(*) as weight from r a join r b on a.article_id = b.article_id and a.entity_id < b.entity_id group by all")
def entity_edges_distinct(spark: SparkSession, d: str) -> DataFrame:
    return co_occurrence(table(spark, d, "article_entities"), distinct=True)


@query(f"with {_EDGES}, k as (select id from entities where lower(trim(entity_type)) = 'company') select source, target, weight from w where source in (select id from k) and target in (select id from k)")
def entity_subgraph(spark: SparkSession, d: str) -> DataFrame:
    companies = table(spark, d, "entities").where("lower(trim(entity_type)) = 'company'")
    return induced(table(spark, d, "article_entities"), companies)


@query(
    f"with {_EDGES}, h as (select arg_max(entity_id, (n, entity_id)) as c from (select entity_id, count(*) as n from article_entities group by 1)) select distinct id from (select source as id from w, h where source = c or target = c union all select target from w, h where source = c or target = c)"
)
def entity_neighbourhood(spark: SparkSession, d: str) -> DataFrame:
    links = table(spark, d, "article_entities")
    centre = links.groupBy("entity_id").agg(F.count(F.lit(1)).alias("n")).agg(F.max_by("entity_id", F.struct("n", "entity_id")).alias("entity_id"))
    return neighbourhood(links, centre)


@query(
    "with p as (select entity_id, article_id, sum(coalesce(mention_count, 0))::bigint as mentions from article_entities group by all) select entity_id, article_id, mentions, rank from (select *, row_number() over (partition by entity_id order by mentions desc, article_id) as rank from p) where rank <= 10"
)
def entity_related_top10(spark: SparkSession, d: str) -> DataFrame:
    pairs = table(spark, d, "article_entities").groupBy("entity_id", "article_id").agg(F.sum(F.coalesce("mention_count", F.lit(0))).alias("mentions"))
    return top_per_key(pairs, "entity_id", 10, F.desc("mentions"), F.col("article_id"))


@query(
    "with f as (select entity_id, sum(mention_count)::bigint as mentions, min(epoch_us(a.created_at)) as first_seen from article_entities l join articles a on a.id = l.article_id group by 1) select e.id, e.name, coalesce(f.mentions, 0) as mentions, f.first_seen from entities e left join f on f.entity_id = e.id"
)
def entity_list(spark: SparkSession, d: str) -> DataFrame:
    seen = table(spark, d, "articles").select(F.col("id").alias("article_id"), F.unix_micros("created_at").alias("at"))
    f = table(spark, d, "article_entities").join(seen, "article_id").groupBy("entity_id").agg(F.sum("mention_count").alias("mentions"), F.min("at").alias("first_seen"))
    return table(spark, d, "entities").join(f, F.col("id") == F.col("entity_id"), "left").select("id", "name", F.coalesce("mentions", F.lit(0)).alias("mentions"), "first_seen")


_RESOLVED = f"""i as (select id as in_id, name, entity_type, case when id < '8' then {_canonical_sql('name')} end as canonical_name from entities),
 a as (select canonical_name, entity_type, arg_min(id, (epoch_us(created_at), id)) as x from entities where trim(coalesce(canonical_name, '')) <> '' group by all), b as (select name, entity_type, arg_min(id, (epoch_us(created_at), id)) as y from entities where trim(name) <> '' group by all)"""


@query(f"with {_RESOLVED} select in_id, coalesce(a.x, b.y) as entity_id from i left join a on a.canonical_name = i.canonical_name and a.entity_type = i.entity_type left join b on b.name = i.name and b.entity_type = i.entity_type")
def entity_lookup(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "entities")
    incoming = e.select(F.col("id").alias("in_id"), "name", "entity_type", F.when(F.col("id") < "8", canonical_name(F.col("name"))).alias("canonical_name"))
    return resolve_entities(incoming, e).select("in_id", "entity_id")


@query(
    "with base as (select article_id, entity_id from article_entities where id < '8'), inc as (select distinct article_id, entity_id from article_entities where id >= '6'), kept as (select * from base where article_id >= '2')"
    " select article_id, entity_id, count(*) as n from (select * from kept union all select * from inc where not exists (select 1 from kept k where k.article_id = inc.article_id and k.entity_id = inc.entity_id)) group by all"
)
def entity_link_upsert(spark: SparkSession, d: str) -> DataFrame:
    """Links of one batch written onto another; articles before '2' were refreshed and lose their old links first."""
    links = table(spark, d, "article_entities").select("id", "article_id", "entity_id")
    base, incoming = (links.where(x).drop("id") for x in ("id < '8'", "id >= '6'"))
    cleared = base.where("article_id < '2'").select("article_id")
    return add_links(base, incoming, cleared).groupBy("article_id", "entity_id").agg(F.count(F.lit(1)).alias("n"))
