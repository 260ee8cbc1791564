"""Queries that run as streams; their results equal the batch form, which is their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillgrid.plans.registry import query
from quillgrid.runtime import scratch
from quillgrid.streaming.ingest import breaker, daily_counts, drain, first_seen, read_stream, upsert_batches


@query("select distinct user_id, event_type from events")
def stream_dedupe(spark: SparkSession, d: str) -> DataFrame:
    return drain(first_seen(read_stream(spark, d, "events"), ["user_id", "event_type"], "ts", "400 days"), "dedupe").select("user_id", "event_type")


@query("with e as (select *, ts::date::varchar as day from events), m as (select max(ts) - interval 1 day as mark from events) select day, event_type, count(*) as n from e, m where ts::date + interval 1 day <= mark group by all")
def stream_daily_counts(spark: SparkSession, d: str) -> DataFrame:
    """Days closed by the watermark; the days still open stay in the state."""
    return drain(daily_counts(read_stream(spark, d, "events"), "ts", ["event_type"]), "days")


@query("with e as (select *, sum(case when event_type = 'error' then 0 else 1 end) over (partition by user_id order by ts, event_id) as island from events), r as (select user_id, event_id, case when event_type = 'error' then count(*) filter (where event_type = 'error') over (partition by user_id, island order by ts, event_id) else 0 end as run_length from e) select user_id, event_id, run_length, run_length >= 3 as tripped from r")
def stream_breaker(spark: SparkSession, d: str) -> DataFrame:
    failing = read_stream(spark, d, "events").select("user_id", "ts", "event_id", (F.col("event_type") == "error").alias("failed"))
    return drain(breaker(failing, "user_id", ["ts", "event_id"], "failed"), "breaker")


@query("select user_id, count(*) as n from (select distinct user_id from events) group by 1")
def stream_upsert(spark: SparkSession, d: str) -> DataFrame:
    root = scratch(spark, "stream-upsert")
    stream = read_stream(spark, d, "events").select("user_id")
    return drain(stream, "upsert", each=upsert_batches(spark, root, "user_id"), place=root).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
