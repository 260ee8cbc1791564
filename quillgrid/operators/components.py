"""Connected components of a graph of links, as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillgrid.runtime import as_table


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(node, component) of every node of an edge, the component being its least node.

    Alternating large-star and small-star contraction: each round is two aggregations over the
    current edges, whose number never grows, and the rounds are logarithmic in the size of the
    longest chain. Each round is written as a table. Self-links and nulls are ignored.
    """
    now = edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).where("u is not null and v is not null and u <> v")
    now = as_table(now.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = None
    while True:
        # large star: each greater neighbour of a node is tied to the least node it sees
        both = now.select("u", "v").unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small star: a node and its lesser neighbours are tied to the least of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(low.select("u", F.col("m").alias("v")))
        now = as_table(small.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    heads = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(heads)
