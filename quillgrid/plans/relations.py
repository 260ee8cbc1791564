"""Queries on how the tables hang together, on guarded changes of sources, and on the small helpers of a run."""

from __future__ import annotations

from pathlib import Path
from tempfile import TemporaryDirectory

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillgrid.config import map_limit, scrape_timeout_ms
from quillgrid.functions.dates import cooldown_until, iso_datetime
from quillgrid.functions.text import one_line
from quillgrid.operators.runs import delivery_log, run_totals
from quillgrid.operators.warehouse import delete_guarded, insert_missing, patch
from quillgrid.plans.registry import NOW, query
from quillgrid.rules import SOURCE_RULES, rules_table, with_rules
from quillgrid.runtime import table
from quillgrid.sources.manifest import read_manifest

#: (name, child, column, parent) of the relations between tables.
EDGES = [
    ("source of article", "articles", "source_id", "sources"),
    ("run of article", "articles", "crawl_run_id", "crawl_runs"),
    ("article of link", "article_entities", "article_id", "articles"),
    ("entity of link", "article_entities", "entity_id", "entities"),
    ("source of target", "source_category_targets", "source_id", "sources"),
    ("source of state", "source_discovery_state", "source_id", "sources"),
]


@query(
    " union all ".join(f"select '{n}' as relation, count(*) as joined, count(distinct p.id) as parents from {c} c join {p} p on p.id = c.{k}" for n, c, k, p in EDGES)
    + " union all select 'run of delivery', count(*), count(*) from crawl_runs"
)
def relation_counts(spark: SparkSession, d: str) -> DataFrame:
    """For each relation the children that find their parent and the parents that have children: children are counted by key before they are joined."""
    parts = []
    for name, child, column, parent in EDGES:
        counted = table(spark, d, child).groupBy(F.col(column).alias("id")).agg(F.count(F.lit(1)).alias("n"))
        met = counted.join(table(spark, d, parent).select("id"), "id")
        parts.append(met.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("joined"), F.count(F.lit(1)).alias("parents")).select(F.lit(name).alias("relation"), "joined", "parents"))
    runs = table(spark, d, "crawl_runs")
    logs = delivery_log(runs, "mail", "desk", F.lit(NOW).cast("timestamp")).join(runs.select(F.col("id").alias("crawl_run_id")), "crawl_run_id")
    parts.append(logs.agg(F.count(F.lit(1)).alias("joined"), F.count_distinct("crawl_run_id").alias("parents")).select(F.lit("run of delivery").alias("relation"), "joined", "parents"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query(
    "with t as (select source_id, count(*) filter (where enabled) as targets from source_category_targets group by 1), n as (select id, name, (row_number() over (order by id) - 1) % 12 as k from sources),"
    " r(k, patterns) as (values " + ", ".join(f"({i}, {sum(len(v) for v in SOURCE_RULES[n].values() if isinstance(v, list))})" for i, n in enumerate(sorted(SOURCE_RULES))) + ")"
    " select n.id, coalesce(s.cursor_type, '') as cursor_type, coalesce(t.targets, 0) as targets, coalesce(r.patterns, 0)::int as patterns from n left join source_discovery_state s on s.source_id = n.id left join t on t.source_id = n.id left join r on r.k = n.k"
)
def source_context(spark: SparkSession, d: str) -> DataFrame:
    """What a source brings into discovery: its state, its rule (the sources play the known ones in turn, every twelfth has none) and its enabled targets."""
    names = spark.createDataFrame(list(enumerate(sorted(SOURCE_RULES))), "k long, rule string")
    sources = table(spark, d, "sources").select("id")
    ranked = sources.alias("a").join(sources.alias("b"), F.col("b.id") < F.col("a.id"), "left").groupBy(F.col("a.id").alias("id")).agg((F.count("b.id") % 12).alias("k"))
    ruled = with_rules(ranked.join(names, "k", "left"), rules_table(spark), "rule")
    state = table(spark, d, "source_discovery_state").select(F.col("source_id").alias("id"), "cursor_type")
    targets = table(spark, d, "source_category_targets").groupBy(F.col("source_id").alias("id")).agg(F.count_if("enabled").alias("targets"))
    patterns = sum((F.size(c) for c in ("include_keywords", "include_regexes", "exclude_regexes", "non_article_exceptions")), F.lit(0))
    return ruled.join(state, "id", "left").join(targets, "id", "left").select("id", F.coalesce("cursor_type", F.lit("")).alias("cursor_type"), F.coalesce("targets", F.lit(0)).alias("targets"), patterns.alias("patterns"))


@query(
    "with g as (select id, name, enabled from sources where id not in (select source_id from articles where source_id is not null) or id >= '8'), u as (select id, name || ' (renamed)' as name, false as enabled from sources where id < '4')"
    " select s.id, coalesce(u.name, s.name) as name, coalesce(u.enabled, s.enabled) as enabled from sources s left join u on u.id = s.id where s.id < '8' or exists (select 1 from articles a where a.source_id = s.id) union all select 'new', 'New one', true"
)
def sources_changed(spark: SparkSession, d: str) -> DataFrame:
    """Sources after one is added, some are renamed and switched off, and the rest is to be deleted, which articles forbid."""
    s = table(spark, d, "sources").select("id", "name", "enabled")
    added = insert_missing(s, spark.createDataFrame([("new", "New one", True)], "id string, name string, enabled boolean"), ["id"])
    updates = s.where("id < '4'").select("id", F.concat("name", F.lit(" (renamed)")).alias("name"), F.lit(False).alias("enabled"), F.lit(None).cast("string").alias("hash"))
    renamed = patch(added.withColumn("hash", F.lit(None).cast("string")), updates, "id", ["name", "enabled"], [], "hash").select("id", "name", "enabled")
    left, _ = delete_guarded(renamed, s.where("id >= '8'").select("id"), table(spark, d, "articles"), "source_id")
    return left


@query("select id, name, url, enabled, 'map' as surface from sources where trim(name) <> ''")
def manifest_read(spark: SparkSession, d: str) -> DataFrame:
    """A YAML manifest of the sources, read back; of a name that comes twice the last stays, rows without a name go."""
    rows = table(spark, d, "sources").select("id", "name", "url", "enabled").orderBy("id").collect()  # a manifest is configuration
    quote = lambda x: "'" + str(x).replace("'", "''") + "'"
    item = lambda r, url: f"- {{name: {quote(r.name)}, url: {quote(url)}, enabled: {str(r.enabled).lower()}, primary_discovery_surface: map}}\n"
    with TemporaryDirectory() as folder:
        path = Path(folder) / "sources.yaml"
        path.write_text("sources:\n- {url: 'https://nameless.example/'}\n" + "".join(item(r, "https://old.example/") for r in rows[:3]) + "".join(item(r, r.url) for r in rows), encoding="utf-8")
        manifest = read_manifest(spark, str(path))
    ids = table(spark, d, "sources").select("id", F.col("name").alias("__name"))
    return manifest.join(ids, F.col("name") == F.col("__name")).select("id", "name", "url", "enabled", F.col("primary_discovery_surface").alias("surface"))


@query(
    "select id, strftime(started_at, '%Y-%m-%dT%H:%M:%SZ') as started, epoch_us(started_at) + 6 * 3600000000 as resting_until, coalesce(status in ('in_progress', 'running'), false) as busy, replace(replace(replace(coalesce(notes, ''), chr(31), ' '), chr(13), ' '), chr(10), ' ') as note from crawl_runs"
)
def run_lines(spark: SparkSession, d: str) -> DataFrame:
    """The small forms of a run's log line: instants as text, the end of a cooldown, the flag of a run under way, notes on one line."""
    r = table(spark, d, "crawl_runs")
    return r.select("id", iso_datetime(F.col("started_at")).alias("started"), F.unix_micros(cooldown_until(F.col("started_at"))).alias("resting_until"), F.coalesce(F.col("status").isin("in_progress", "running"), F.lit(False)).alias("busy"), one_line(F.col("notes")).alias("note"))


@query("select crawl_run_id as run, count(*) as articles, count(*) filter (where status = 'error')::bigint as errors, case when count(*) filter (where status = 'error') > 0 then 'partial_success' else 'success' end as status from articles group by 1")
def run_totals_all(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "articles").select(F.col("crawl_run_id").alias("run"), F.lit("inserted").alias("disposition"), (F.col("status") == "error").cast("long").alias("e"), F.lit(0).alias("l"))
    return run_totals(a, "run", "disposition", "e", "l")


@query("select p::int as preprint, a::int as attempt, (120000 + 60000 * p + 30000 * a)::int as timeout_ms, greatest((a + 1) * 7 * 20, 80)::int as links from range(2) x(p), range(4) y(a)")
def service_limits(spark: SparkSession, d: str) -> DataFrame:
    """Timeouts of page fetches and limits of map calls."""
    rows = [(p, a, scrape_timeout_ms(bool(p), a), map_limit((a + 1) * 7)) for p in range(2) for a in range(4)]
    return spark.createDataFrame(rows, "preprint int, attempt int, timeout_ms int, links int")


@query("select id, '{\"remaining_credits\":' || article_count || ',\"status\":' || case when status is null then 'null' else '\"' || status || '\"' end || '}' as line from crawl_runs")
def credit_lines(spark: SparkSession, d: str) -> DataFrame:
    """JSON lines of the credit report; null fields stay."""
    fields = F.struct(F.col("article_count").alias("remaining_credits"), "status")
    return table(spark, d, "crawl_runs").select("id", F.to_json(fields, {"ignoreNullFields": "false"}).alias("line"))
