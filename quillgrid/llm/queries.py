"""The queries of the training-data problems, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillgrid.llm import boilerplate, mixture, names, near_duplicates, repeated_lines, shared_spans, template_residue, tokenize
from quillgrid.runtime import scratch, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return near_duplicates.same_story_pairs(table(spark, d, "articles"))


@query
def p1_groups(spark: SparkSession, d: str) -> DataFrame:
    return near_duplicates.story_groups(table(spark, d, "articles"))


def _line_store(spark: SparkSession, d: str) -> repeated_lines.LineStore:
    """The articles merged year by year."""
    return repeated_lines.merged_store(table(spark, d, "articles"), F.year("created_at"), scratch(spark, "lines"))


@query
def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return _line_store(spark, d).repeated().withColumnRenamed("document", "article_id")


@query
def p2_body(spark: SparkSession, d: str) -> DataFrame:
    return repeated_lines.bodies(table(spark, d, "articles"), _line_store(spark, d).repeated()).withColumnRenamed("document", "article_id")


@query
def p2_rebuilt(spark: SparkSession, d: str) -> DataFrame:
    store = _line_store(spark, d)
    return store.rebuilt(table(spark, d, "articles"), store.batches()[-1]).withColumnRenamed("document", "article_id")


@query
def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return names.same_entity_pairs(table(spark, d, "entities"), table(spark, d, "name_forms"))


@query
def p4_classes(spark: SparkSession, d: str) -> DataFrame:
    classes = names.entity_classes(table(spark, d, "entities"), table(spark, d, "name_forms"))
    return classes.select(F.col("id").alias("entity_id"), F.col("class").alias("class_key"))


@query
def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return template_residue.residue_fields(table(spark, d, "articles"))


@query
def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return boilerplate.furniture_lines(table(spark, d, "articles"))


@query
def p6_body(spark: SparkSession, d: str) -> DataFrame:
    return boilerplate.main_content(table(spark, d, "articles")).select(F.col("page_id").alias("article_id"), "body")


@query
def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokenize.corpus_ids(table(spark, d, "documents"))


@query
def p8_mixture(spark: SparkSession, d: str) -> DataFrame:
    return mixture.mixture(table(spark, d, "documents"), table(spark, d, "mixture_targets"))[0]


@query
def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    return mixture.mixture(table(spark, d, "documents"), table(spark, d, "mixture_targets"))[1]


@query
def p8_sources(spark: SparkSession, d: str) -> DataFrame:
    listed = table(spark, d, "documents").join(table(spark, d, "mixture_targets").select("source"), "source", "left_semi")
    return listed.groupBy("source").agg(F.count(F.lit(1)).alias("records"), F.count_if(F.col("text") != "").alias("with_text"), F.sum(F.length("text")).cast("long").alias("chars"))


@query
def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return shared_spans.span_pairs(table(spark, d, "documents"))


@query
def p9_shared(spark: SparkSession, d: str) -> DataFrame:
    return shared_spans.shared_amounts(table(spark, d, "documents"))


@query
def p9_spans(spark: SparkSession, d: str) -> DataFrame:
    return shared_spans.spans(table(spark, d, "documents"))


@query
def p9_places(spark: SparkSession, d: str) -> DataFrame:
    """Where the shared spans are."""
    return shared_spans.spans(table(spark, d, "documents"), doubling=False).select("doc_id", "start", "length")
