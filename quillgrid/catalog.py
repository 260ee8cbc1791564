"""Every query of the core by name, with the SQL that an independent engine runs on the same tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillgrid.operators import timestamps
from quillgrid.plans import content, dashboard, knowledge, pipeline, relations, runs, streams, urls, writes  # noqa: F401 - they register their queries
from quillgrid.plans.registry import ORACLES, QUERIES, query  # noqa: F401
from quillgrid.runtime import table


@query()
def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return timestamps.table_instants(table(spark, d, "articles"), table(spark, d, "source_category_targets"), table(spark, d, "source_locale"))


@query()
def p3_status(spark: SparkSession, d: str) -> DataFrame:
    """How each value was read: certain, resolved or ambiguous by the posterior of the best reading, or unusable."""
    found = timestamps.table_readings(table(spark, d, "articles"), table(spark, d, "source_category_targets"), table(spark, d, "source_locale"))
    return found.select("table_name", "record_id", "reading", F.round("posterior", 6).alias("posterior"), "status")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.rank_candidates_final(spark, sf_dir)
