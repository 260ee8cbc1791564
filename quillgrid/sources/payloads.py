"""Answers of outside services as tables: site maps, scraped pages, credit usage.

The calls themselves are inputs: a table of payload texts. JSON that cannot be read counts as a
failed call, never as an error of the job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillgrid.functions.text import hash_markdown, paywall_signal, word_count

_LINK = "struct<url:string,title:string,description:string>"


def map_links(payloads: DataFrame, body: str = "body") -> DataFrame:
    """The payload's columns with (pos, url, title, description) for each link of a site map, in the service's order; links without an address, or that are no objects, are dropped."""
    items = F.from_json(body, "struct<links:array<string>>")["links"]
    rows = payloads.select("*", F.posexplode(items).alias("pos", "__l")).withColumn("__o", F.from_json("__l", _LINK))
    return rows.where("coalesce(__o.url, '') <> ''").select(*payloads.columns, "pos", "__o.url", F.coalesce("__o.title", F.lit("")).alias("title"), F.coalesce("__o.description", F.lit("")).alias("description"))


def scraped_pages(payloads: DataFrame, body: str = "body") -> DataFrame:
    """The payload's columns with (success, markdown, word_count, content_hash, paywall_detected, paywall_signal, error).

    A payload that reports no success has an empty text, no words, no hash, and itself as the error.
    """
    o = F.from_json(body, "struct<success:boolean,data:struct<markdown:string>>")
    ok = F.coalesce(o["success"], F.lit(False))
    told = payloads.select("*", ok.alias("success"), F.when(ok, F.coalesce(o["data"]["markdown"], F.lit(""))).otherwise(F.lit("")).alias("markdown"))
    signal = F.when(F.col("success"), paywall_signal(F.col("markdown")))
    return told.select(
        "*",
        F.when(F.col("success"), word_count(F.col("markdown"))).otherwise(F.lit(0)).cast("int").alias("word_count"),
        F.when(F.col("success"), hash_markdown(F.col("markdown"))).alias("content_hash"),
        signal.isNotNull().alias("paywall_detected"),
        signal.alias("paywall_signal"),
        F.when(~F.col("success"), F.coalesce(F.col(body), F.lit("no answer"))).alias("error"),
    )


def credit_usage(payloads: DataFrame, body: str = "body") -> DataFrame:
    """The payload's columns with (remaining_credits, plan_credits, billing_period_start, billing_period_end), null where not given."""
    data = F.from_json(body, "struct<data:struct<remaining_credits:long,plan_credits:long,billing_period_start:string,billing_period_end:string>>")["data"]
    return payloads.select("*", *[data[c].alias(c) for c in ("remaining_credits", "plan_credits", "billing_period_start", "billing_period_end")])
