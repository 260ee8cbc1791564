"""The graph of entities that occur together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def co_occurrence(links: DataFrame, article: str = "article_id", entity: str = "entity_id", distinct: bool = False) -> DataFrame:
    """(source, target, weight): pairs of links of one article, by unordered pair of entities.

    By default the weight counts pairs of rows, so repeated links count again and give edges of an
    entity with itself; ``distinct`` counts articles and has none. The self-join is on the article,
    whose links are few; identical (article, entity) rows are folded into a multiplicity first, so a
    repeated link is not multiplied row by row.
    """
    folded = links.groupBy(F.col(article).alias("a"), F.col(entity).alias("e")).agg(F.count(F.lit(1)).alias("m"))
    pairs = folded.alias("x").join(folded.alias("y"), F.col("x.a") == F.col("y.a")).where("x.e < y.e").select(F.col("x.e").alias("source"), F.col("y.e").alias("target"), (F.lit(1) if distinct else F.col("x.m") * F.col("y.m")).cast("long").alias("w"))
    if not distinct:
        selves = folded.where("m > 1").select(F.col("e").alias("source"), F.col("e").alias("target"), (F.col("m") * (F.col("m") - 1) / 2).cast("long").alias("w"))
        pairs = pairs.unionByName(selves)
    return pairs.groupBy("source", "target").agg(F.sum("w").cast("long").alias("weight"))


def node_weights(links: DataFrame, entity: str = "entity_id", count: str = "mention_count") -> DataFrame:
    """(entity, weight): mentions of each entity, null as 0."""
    return links.groupBy(entity).agg(F.sum(F.coalesce(count, F.lit(0))).cast("long").alias("weight"))


def induced(links: DataFrame, nodes: DataFrame, node: str = "id", entity: str = "entity_id", distinct: bool = False) -> DataFrame:
    """The edges whose two ends are among the nodes. The links are cut down before they are paired."""
    keep = nodes.select(F.col(node).alias(entity)).distinct()
    return co_occurrence(links.join(keep, entity, "left_semi"), entity=entity, distinct=distinct)


def neighbourhood(links: DataFrame, centre: DataFrame, article: str = "article_id", entity: str = "entity_id") -> DataFrame:
    """(id): the entities that share an article with one of ``centre`` (entity), and it itself where it shares one; only its articles are read.

    The links of an article with the centre are its neighbours; pairing is not needed. An article with
    nothing but one link of the centre ties it to none.
    """
    own = links.join(centre.select(entity), entity, "left_semi").select(article).distinct()
    near = links.join(own, article, "left_semi")
    alone = near.groupBy(article).agg(F.count(F.lit(1)).alias("n")).where("n = 1").select(article)
    return near.join(alone, article, "left_anti").select(F.col(entity).alias("id")).distinct()


def edge_width(weight: Column) -> Column:
    return F.least(weight * 2, F.lit(10))


def node_size(weight: Column) -> Column:
    return F.greatest(F.lit(20), F.least(weight * 3, F.lit(60)))


def top_per_key(df: DataFrame, key: str, n: int, *order: Column) -> DataFrame:
    """The first n rows of each key, with ``rank``."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where(F.col("rank") <= n)
