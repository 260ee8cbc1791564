"""Discovery: cursors, surfaces, lanes, ranks and cooldowns, over whole sets of candidates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quillgrid.functions.url import recency_key


def after_feed_cursor(published: Column, cursor: Column, url: Column, cursor_url: Column, coarse: Column) -> Column:
    """Undated rows and sources without a cursor pass; earlier rows do not; at the cursor only coarse sources pass, but for the cursor's own address."""
    equal = coarse & ~url.eqNullSafe(cursor_url)
    return F.when(published.isNull() | cursor.isNull(), True).when(published == cursor, equal).otherwise(published > cursor)


def after_sitemap_checkpoint(published: Column, checkpoint: Column) -> Column:
    """Later than the greatest value of a checkpoint map of timestamp texts; undated rows and empty checkpoints pass."""
    latest = F.array_max(F.transform(F.map_values(checkpoint), lambda v: F.try_to_timestamp(v)))
    return published.isNull() | latest.isNull() | (published > latest)


def latest_cursor(candidates: DataFrame, source: str, published: str, url: str) -> DataFrame:
    """(source, last_cursor_published_at, last_cursor_url) over the emitted rows of each source."""
    return candidates.where(F.col(published).isNotNull()).groupBy(source).agg(F.max(published).alias("last_cursor_published_at"), F.max_by(url, F.struct(published, url)).alias("last_cursor_url"))


def first_by_url(candidates: DataFrame, source: str, url: str, *order: Column) -> DataFrame:
    """The first row of each (source, address) in an order that must be total."""
    w = Window.partitionBy(source, url).orderBy(*order)
    return candidates.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def rank_surface(candidates: DataFrame, source: str, limit: int, compat: bool = True) -> DataFrame:
    """The first ``limit`` rows of each source's surface. ``compat`` keeps the historical order, which puts the *lowest* scores first."""
    score = F.col("score").asc() if compat else F.col("score").desc()
    w = Window.partitionBy(source).orderBy(score, F.col("published_at").desc_nulls_last(), F.col("url").desc())
    return candidates.withColumn("surface_rank", F.row_number().over(w)).where(F.col("surface_rank") <= limit)


def rank_final(candidates: DataFrame, source: str, limit: int) -> DataFrame:
    """Best score first; among equals undated and oldest first, then the address's own date, then the address."""
    key = recency_key(F.col("url"))
    w = Window.partitionBy(source).orderBy(F.col("score").desc(), F.col("published_at").asc_nulls_first(), key["y"].desc(), key["m"].desc(), key["d"].desc(), F.col("url").asc())
    return candidates.withColumn("final_rank", F.row_number().over(w)).where(F.col("final_rank") <= limit)


def find_existing(candidates: DataFrame, articles: DataFrame, url: str = "url", normalized: str = "normalized_url") -> DataFrame:
    """Candidates with existing_id and existing_hash of the stored article with the same normalized address, else the same address. Two equi-joins; an OR would become a nested loop."""
    stored = articles.select(F.col("id").alias("__id"), F.col("content_hash").alias("__hash"), F.col("normalized_url").alias("__norm"), F.col("url").alias("__url"))
    one = stored.groupBy("__norm").agg(F.min(F.struct("__id", "__hash")).alias("__a"))  # of several, the least id
    two = stored.groupBy("__url").agg(F.min(F.struct("__id", "__hash")).alias("__b"))
    joined = candidates.join(one, F.col(normalized) == F.col("__norm"), "left").join(two, F.col(url) == F.col("__url"), "left")
    hit = F.coalesce("__a", "__b")
    return joined.withColumns({"existing_id": hit["__id"], "existing_hash": hit["__hash"]}).drop("__a", "__b", "__norm", "__url")


def due_for_refresh(now: Column, enabled: Column, window_days: Column, cadence_hours: Column, published: Column, scraped: Column) -> Column:
    """Enabled, published within the window (its edge counts), and never scraped or not within the cadence (its edge counts)."""
    age = (F.unix_micros(now) - F.unix_micros(published)) <= window_days.cast("long") * 86_400_000_000
    rest = (F.unix_micros(now) - F.unix_micros(scraped)) >= F.greatest(F.coalesce(cadence_hours, F.lit(24)), F.lit(1)).cast("long") * 3_600_000_000
    return F.coalesce(enabled, F.lit(False)) & (F.coalesce(window_days, F.lit(0)) > 0) & published.isNotNull() & F.coalesce(age, F.lit(False)) & (scraped.isNull() | rest)


def lane(existing: Column, refreshable: Column) -> Column:
    """'new' for unknown articles, 'refresh' for known ones that are due, else 'skip'."""
    return F.when(existing.isNull(), "new").when(refreshable, "refresh").otherwise("skip")


def target_due(now: Column, checked: Column, frequency_hours: Column) -> Column:
    """Never checked, or at least the frequency ago; a null or zero frequency is 24 hours."""
    f = F.when(F.coalesce(frequency_hours, F.lit(0)) == 0, F.lit(24)).otherwise(frequency_hours)
    return checked.isNull() | (F.unix_micros(now) - F.unix_micros(checked) >= f.cast("long") * 3_600_000_000)


def in_cooldown(now: Column, surface: Column, cursor_type: Column, until: Column) -> Column:
    return F.coalesce((cursor_type == surface) & (until > now), F.lit(False))


def surface_plan(primary: Column, fallback: Column) -> Column:
    """The ordered, distinct surfaces of a source: primary, fallback, and the map at the end."""
    known = F.filter(F.array(primary, fallback, F.lit("map")), lambda s: s.isNotNull() & (s != ""))
    return F.array_distinct(known)


def first_working(attempts: DataFrame, key: str, order: str, failed: str, surface: str) -> DataFrame:
    """(key, surface, failures): the first attempt of each key that did not fail, even an empty one; null where all failed."""
    ok = F.when(~F.col(failed), F.struct(F.col(order).alias("o"), F.col(surface).alias("s")))
    return attempts.groupBy(key).agg(F.min(ok)["s"].alias("surface"), F.count_if(F.col(failed)).cast("long").alias("failures"))


def failure_runs(events: DataFrame, key: str, order: list[str], failed: str, trip: int = 3) -> DataFrame:
    """The events with ``run_length``, the failures in a row up to here, and ``tripped``, true from the ``trip``-th on. A success resets."""
    w = Window.partitionBy(key).orderBy(*order)
    island = events.withColumn("__island", F.count_if(~F.col(failed)).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    position = F.count_if(F.col(failed)).over(Window.partitionBy(key, "__island").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return island.withColumn("run_length", F.when(F.col(failed), position).otherwise(0).cast("long")).drop("__island").withColumn("tripped", F.col("run_length") >= trip)


def surface_state(events: DataFrame, key: str, order: list[str], failed: str, at: str, error: str, trip: int = 3, hours: int = 6) -> DataFrame:
    """(key, error_count, last_error, cooldown_until, last_successful_discovery_at) after all events of a key.

    Each failure from the ``trip``-th in a row on sets the cooldown anew; a success sets the count to 0
    and error and cooldown to null.
    """
    judged = failure_runs(events, key, order, failed, trip)
    last = F.max(F.struct(*order, "run_length", "tripped", failed, F.col(at).alias("__at"), F.col(error).alias("__error"))).alias("s")
    ended = judged.groupBy(key).agg(last, F.max(F.when(~F.col(failed), F.col(at))).alias("last_successful_discovery_at"))
    return ended.select(
        key,
        F.col("s.run_length").cast("int").alias("error_count"),
        F.when(F.col(f"s.{failed}"), F.col("s.__error")).alias("last_error"),
        F.when(F.col("s.tripped"), F.col("s.__at") + F.make_dt_interval(F.lit(0), F.lit(hours))).alias("cooldown_until"),
        "last_successful_discovery_at",
    )


def checkpoint_after(checkpoint: Column, key: Column, at: Column) -> Column:
    """A checkpoint map with the instant of one more surface, as ISO text; a null instant changes nothing."""
    entry = F.map_from_arrays(F.array(key), F.array(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'")))
    kept = F.map_filter(F.coalesce(checkpoint, F.create_map().cast("map<string,string>")), lambda k, v: k != key)
    return F.when(at.isNull() | key.isNull(), checkpoint).otherwise(F.map_concat(kept, entry))


def newest_of_target(links: DataFrame, target: str, url: str, position: str, score: str, least: int = 4) -> DataFrame:
    """(target, newest_url): the first link of each listing, in document order, that scores enough."""
    return links.where(F.col(score) >= least).groupBy(target).agg(F.min_by(url, position).alias("newest_url"))


def first_in_order(candidates: DataFrame, source: str, ordinal: str, limit: int) -> DataFrame:
    """The first rows of each source in the order in which a service gave them, with ``api_rank``."""
    w = Window.partitionBy(source).orderBy(ordinal)
    return candidates.withColumn("api_rank", F.row_number().over(w)).where(F.col("api_rank") <= limit)


def processing_branch(failed: Column, lane: Column, stored_hash: Column, new_hash: Column, paywall: Column, words: Column, least: int = 300) -> Column:
    """What happens to a scraped page; the first case that holds: error, unchanged, paywalled, too_short, analyze."""
    same = (lane == "refresh") & (F.coalesce(stored_hash, F.lit("")) != "") & (stored_hash == new_hash)
    return F.when(failed, "error").when(F.coalesce(same, F.lit(False)), "unchanged").when(paywall.isNotNull(), "paywalled").when(words < least, "too_short").otherwise("analyze")


def budget_mode(remaining: Column, total: Column, burn_per_day: Column, days_left: Column) -> Column:
    """'normal' above 30 % projected rest, 'conserve' above 10 %, else 'critical'."""
    rest = F.try_divide(remaining - burn_per_day * days_left, total)
    return F.when(rest > 0.3, "normal").when(rest > 0.1, "conserve").otherwise("critical")


def yield_drift(runs: DataFrame, key: str, order: str, count: str, drop: float = 0.7) -> DataFrame:
    """The runs with ``drifted``: whether the count fell by more than ``drop`` against the run before."""
    before = F.lag(count).over(Window.partitionBy(key).orderBy(order))
    return runs.withColumn("previous", before).withColumn("drifted", F.coalesce((F.col("previous") > 0) & (F.col(count) < F.col("previous") * (1 - drop)), F.lit(False)))
