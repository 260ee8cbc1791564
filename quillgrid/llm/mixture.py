"""Problem 8: mixing sources to target weights, by capped water-filling.

The mixture has a total size (by default the size of all listed sources once). Each source is due
its share of it; a source that cannot give that even when repeated as often as allowed is clamped
there, and what it leaves is spread over the others in proportion to their shares, until no source
is over its cap. In the order of cap by share, a source is clamped exactly when its cap by share is no
more than the level that is left to it and all later ones, so one window over the listed sources
finds the level; nothing is read by the driver. Each source then gives whole repetitions of
everything and one fractional repetition: the records with the least seeded hashes, up to the size
still due.

The fractional repetition never orders a source in one task: sizes are summed by (source, first bits
of the hash), running sums are taken over these 4,096 buckets, and only the bucket that holds the
boundary goes on, by its next bits. After LEVELS rounds a bucket holds one record in 7e10.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quillgrid.llm.tokenize import RANKS, token_counts
from quillgrid.runtime import as_table

BITS, LEVELS = 12, 3
SEED = 17


def water_level(sized: DataFrame, targets: DataFrame, total: float | None = None) -> DataFrame:
    """(source, target_share, max_repeats, available, due, whole, rest) for each listed source, as a table.

    Shares need not sum to one; null or negative shares and repetitions count as 0. When all caps
    together are under the total, every source gives its cap.
    """
    sizes = sized.groupBy("source").agg(F.sum("tokens").alias("available"))
    listed = targets.where("source is not null").groupBy("source").agg(F.max("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    rows = listed.join(sizes, "source", "left").withColumn("available", F.coalesce("available", F.lit(0)).cast("long"))
    share, cap = F.greatest(F.coalesce("target_share", F.lit(0.0)), F.lit(0.0)), F.col("available") * F.greatest(F.coalesce("max_repeats", F.lit(0)), F.lit(0))
    rows = rows.withColumns({"__share": share, "__cap": cap.cast("double")}).withColumn("__fills", (F.col("__share") > 0) & (F.col("__cap") > 0))
    # a row for each listed source, which are configuration: one window over all of them
    order = Window.partitionBy("__fills").orderBy(F.try_divide(F.col("__cap"), F.col("__share")), "source")
    before = F.coalesce(F.sum("__cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    after = F.sum("__share").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    whole = F.lit(float(total)) if total is not None else F.sum("available").over(Window.partitionBy()).cast("double")
    left = rows.withColumn("__total", whole).withColumn("__level", F.when(F.col("__fills"), F.try_divide(F.col("__total") - before, after)))
    clamped = F.col("__fills") & (F.col("__cap") <= F.col("__level") * F.col("__share"))
    level = F.max(F.when(F.col("__fills") & ~clamped, F.col("__level"))).over(Window.partitionBy())
    given = F.when(clamped, F.col("__cap")).when(F.col("__fills"), F.greatest(F.lit(0.0), level * F.col("__share"))).otherwise(F.lit(0.0))
    due = left.withColumn("due", F.round(given).cast("long"))
    times = F.when(F.col("available") > 0, F.floor(F.try_divide(F.col("due"), F.col("available")))).otherwise(F.lit(0)).cast("int")
    made = due.withColumn("whole", times).select("source", "target_share", "max_repeats", "available", "due", "whole", (F.col("due") - F.col("whole") * F.col("available")).alias("rest"))
    return as_table(made, "plan")


def _fraction(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """(doc_id, source, tokens, extra): extra is 1 for the records of the fractional repetition."""
    done, open_ = [], sized.join(plan.select("source", "rest"), "source").withColumn("before", F.lit(0).cast("long"))
    for level in range(LEVELS):
        bucket = F.shiftrightunsigned("h", 64 - BITS * (level + 1)).bitwiseAND(F.lit((1 << BITS) - 1))
        placed = open_.withColumn("bucket", bucket)
        sums = placed.groupBy("source", "before", "bucket").agg(F.sum("tokens").alias("size"))
        so_far = F.coalesce(F.sum("size").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        state = sums.select("source", "bucket", (F.col("before") + so_far).cast("long").alias("start"), "size")
        judged = placed.drop("before").join(state, ["source", "bucket"]).withColumn("side", F.when(F.col("start") + F.col("size") <= F.col("rest"), 1).when(F.col("start") >= F.col("rest"), 0).otherwise(-1))
        done.append(judged.where("side >= 0").select("doc_id", "source", "tokens", F.col("side").alias("extra")))
        open_ = as_table(judged.where("side < 0").select("doc_id", "source", "tokens", "h", "rest", F.col("start").alias("before")), "boundary")
    running = F.sum("tokens").over(Window.partitionBy("source").orderBy(F.col("h").bitwiseAND(F.lit((1 << 64 - BITS * LEVELS) - 1)), "doc_id").rowsBetween(Window.unboundedPreceding, 0))
    edge = open_.withColumn("extra", (F.col("before") + running - F.col("tokens") / 2 <= F.col("rest")).cast("int")).select("doc_id", "source", "tokens", "extra")
    return reduce(DataFrame.unionByName, [*done, edge])


def mixture(documents: DataFrame, targets: DataFrame, total: float | None = None, seed: int = SEED, key: str = "doc_id", source: str = "source", text: str = "text", ranks: str = RANKS, lengths: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(chosen, shares).

    chosen: (doc_id, source, tokens, copies), copies > 0, of the records in the mixture; shares:
    (source, target_share, actual_share, max_repeats, available_tokens, mixed_tokens, epochs).
    Sources that are not listed, null sources and records without tokens are not mixed; a listed
    source without records has an actual share of 0. Ties of the hash are broken by the key.
    ``lengths``: (doc_id, tokens), where they are known already; else the texts are encoded.
    """
    base = documents.select(F.col(key).alias("doc_id"), F.col(source).alias("source"), F.col(text).alias("text")).where("source is not null and text is not null")
    wanted = base.join(targets.select("source").distinct(), "source", "left_semi")
    # the whole key decides, so that rows with equal keys and texts share their fate
    hashed = F.xxhash64(F.lit(seed), F.col("doc_id"))
    counted = token_counts(wanted, "text", ranks) if lengths is None else wanted.join(lengths.select("doc_id", "tokens"), "doc_id")
    sized = as_table(counted.select("doc_id", "source", "tokens", hashed.alias("h")).where("tokens > 0"), "sized")
    plan = water_level(sized, targets, total)
    chosen = _fraction(sized, plan).join(plan.select("source", "whole"), "source").select("doc_id", "source", "tokens", (F.col("whole") + F.col("extra")).alias("copies")).where("copies > 0")
    mixed = chosen.groupBy("source").agg(F.sum(F.col("tokens").cast("long") * F.col("copies")).alias("mixed_tokens"))
    everything = mixed.agg(F.sum("mixed_tokens").alias("all_tokens"))
    shares = (
        plan.join(mixed, "source", "left")
        .crossJoin(everything)
        .select(
            "source",
            "target_share",
            F.coalesce(F.col("mixed_tokens") / F.col("all_tokens"), F.lit(0.0)).alias("actual_share"),
            "max_repeats",
            F.col("available").alias("available_tokens"),
            F.coalesce("mixed_tokens", F.lit(0)).alias("mixed_tokens"),
            F.when(F.col("available") > 0, F.coalesce("mixed_tokens", F.lit(0)) / F.col("available")).otherwise(F.lit(0.0)).alias("epochs"),
        )
    )
    return chosen, shares
