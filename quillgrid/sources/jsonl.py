"""The hand-off file of the writer: article objects, each followed by its tagged entity lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

TAG = "ENTITY:"


def read_tagged_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no, line): the lines of text files. A file is one hand-off, so its lines keep their order; numbers come from the file's own text."""
    whole = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), "value")
    return whole.select("file", F.posexplode(F.split("value", r"\r?\n")).alias("line_no", "line"))


def assign_entities(lines: DataFrame, article_schema: str, entity_schema: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(articles, entities, errors) of lines (file, line_no, line).

    articles: (file, article_no, article); entities: (file, article_no, entity), each with the
    article line before it; errors: (file, article_errors, entity_errors). Blank lines are skipped;
    entity lines before the first article are errors, as are lines that are no JSON object.
    """
    kept = lines.where(F.trim("line") != "").withColumn("is_entity", F.startswith("line", F.lit(TAG)))
    parsed = kept.withColumn("article", F.when(~F.col("is_entity"), F.from_json("line", article_schema))).withColumn("entity", F.when(F.col("is_entity"), F.from_json(F.expr(f"substr(line, {len(TAG) + 1})"), entity_schema)))
    good = F.col("article").isNotNull() & F.trim("line").startswith("{") & F.trim("line").endswith("}")
    order = Window.partitionBy("file").orderBy("line_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = parsed.withColumn("good_article", ~F.col("is_entity") & good).withColumn("article_no", F.count_if(F.col("good_article")).over(order))
    articles = numbered.where("good_article").select("file", "article_no", "article")
    whole = F.col("entity").isNotNull() & F.rtrim("line").endswith("}")
    entities = numbered.where(F.col("is_entity") & whole & (F.col("article_no") > 0)).select("file", "article_no", "entity")
    errors = numbered.groupBy("file").agg(F.count_if(~F.col("is_entity") & ~F.col("good_article")).alias("article_errors"), F.count_if(F.col("is_entity") & ~(whole & (F.col("article_no") > 0))).alias("entity_errors"))
    return articles, entities, errors
