"""Runs, deliveries and model answers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DISPOSITIONS = ("inserted", "duplicate", "refreshed_changed", "refreshed_unchanged")


def run_status(errors: Column, failed: Column | None = None) -> Column:
    """'failed' for an aborted run, else 'partial_success' with errors, else 'success'."""
    ok = F.when(errors > 0, "partial_success").otherwise("success")
    return ok if failed is None else F.when(failed, "failed").otherwise(ok)


def run_totals(written: DataFrame, run: str, disposition: str, article_errors: str, link_errors: str) -> DataFrame:
    """(run, articles, errors, status): all dispositions together, and article plus link errors; a row for each run."""
    totals = written.groupBy(run).agg(F.count_if(F.col(disposition).isin(*DISPOSITIONS)).alias("articles"), F.sum(F.coalesce(article_errors, F.lit(0)) + F.coalesce(link_errors, F.lit(0))).cast("long").alias("errors"))
    return totals.withColumn("status", run_status(F.col("errors")))


def finish_run(runs: DataFrame, totals: DataFrame, key: str, now: Column) -> DataFrame:
    """The runs with the totals' counts, status and completion filled in; runs without totals stay as they are."""
    t = totals.select(F.col(key).alias("__key"), F.col("articles").alias("__articles"), F.col("errors").alias("__errors"), F.col("status").alias("__status"))
    j = runs.join(t, F.col("id") == F.col("__key"), "left")
    hit = F.col("__key").isNotNull()
    new = {"article_count": F.col("__articles").cast("int"), "error_count": F.col("__errors").cast("int"), "status": F.col("__status"), "completed_at": now}
    return j.select(*[F.when(hit, new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in runs.columns])


def patch_targets(targets: DataFrame, results: DataFrame, now: Column) -> DataFrame:
    """Category targets after a check. results: (id, newest_url, error, error_type).

    A success clears the errors and moves last_seen_url on, which stays where nothing was new; a
    failure records its error. Both set last_checked_at.
    """
    r = results.select(F.col("id").alias("__id"), F.col("newest_url").alias("__url"), F.col("error").alias("__error"), F.col("error_type").alias("__type"))
    j = targets.join(r, F.col("id") == F.col("__id"), "left")
    hit, bad = F.col("__id").isNotNull(), F.col("__error").isNotNull()
    new = {
        "last_checked_at": now,
        "last_error": F.col("__error"),
        "error_type": F.col("__type"),
        "detected_at": F.when(bad, now),
        "last_seen_url": F.when(bad, F.col("last_seen_url")).otherwise(F.coalesce("__url", "last_seen_url")),
    }
    return j.select(*[F.when(hit, new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in targets.columns])


def delivery_log(runs: DataFrame, channel: str, destination: str, now: Column) -> DataFrame:
    """One log row for each run, with a preview line."""
    preview = F.format_string("%s run: %d articles, %d errors", "run_type", "article_count", "error_count")
    return runs.select(F.sha2(F.concat_ws("|", "id", F.lit(channel), F.lit(destination)), 256).alias("id"), F.col("id").alias("crawl_run_id"), F.lit(channel).alias("channel_type"), F.lit(destination).alias("destination"), now.alias("delivered_at"), F.lit("sent").alias("status"), preview.alias("message_preview"))


def in_flight(runs: DataFrame, busy: tuple[str, ...] = ("in_progress", "running")) -> bool:
    """Is a run under way? The guard of a single-flight lock; it reads one row."""
    return not runs.where(F.col("status").isin(*busy)).limit(1).isEmpty()


def digest_markdown(articles: DataFrame) -> DataFrame:
    """(id, block): a markdown block for each article, with fallbacks for what is missing."""
    tags = F.when(F.size("topic_tags") > 0, F.array_join("topic_tags", ", ")).otherwise("none")
    summary = F.when(F.trim("summary") != "", F.col("summary")).otherwise("No summary")
    return articles.select("id", F.format_string("## %s\n- Priority: %s\n- Tags: %s\n- URL: %s\n\n%s\n", F.coalesce("title", F.lit("Untitled")), "priority_level", tags, "url", summary).alias("block"))


def request_json(model: str, prompt: Column, temperature: float = 0.3, tokens: int = 4096) -> Column:
    """The body of a model request."""
    return F.to_json(F.struct(F.lit(model).alias("model"), F.array(F.struct(F.lit("user").alias("role"), prompt.alias("content"))).alias("messages"), F.lit(temperature).alias("temperature"), F.lit(tokens).alias("max_tokens")))


def ask_model(rows: DataFrame, key: str, prompt: str, answer: Callable[[list[str], int], list[str]], good: Callable[[str], bool], attempts: int = 2) -> DataFrame:
    """(key, answer, attempts): an opaque model as a batch function from prompts and the attempt's number to answers.

    Answers that are not good are asked for again; that of the last attempt is taken as it is. Null
    prompts are not asked. The function runs in the workers, a batch at a time.
    """
    kind = rows.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            prompts = list(batch["p"])
            answers, tried = [None] * len(prompts), [0] * len(prompts)
            open_ = [i for i, p in enumerate(prompts) if p is not None]
            for attempt in range(1, attempts + 1):
                for i, a in zip(open_, answer([prompts[i] for i in open_], attempt) if open_ else []):
                    answers[i], tried[i] = a, attempt
                open_ = [i for i in open_ if not good(answers[i])]
            yield pd.DataFrame({"k": batch["k"], "answer": answers, "attempts": tried})

    out = rows.select(F.col(key).alias("k"), F.col(prompt).alias("p")).mapInPandas(run, f"k {kind}, answer string, attempts int")
    return out.withColumnRenamed("k", key)


def answer_status(answer: Column, parsed: Column) -> Column:
    """'JSON_MALFORMED' where no object could be read, 'needs_review' where its title is missing, else 'analyzed'."""
    return F.when(answer.isNull() | parsed.isNull() | (F.regexp_extract(answer, r"(?s)\{.*\}", 0) == ""), "JSON_MALFORMED").when(F.coalesce(F.trim(parsed["title"]), F.lit("")) == "", "needs_review").otherwise("analyzed")
