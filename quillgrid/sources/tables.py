"""Scans of stored tables: equality predicates, projection, limit; Parquet folders or a database."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillgrid.schemas import schema_of


def scan(spark: SparkSession, folder: str, name: str, where: dict[str, object] | None = None, columns: list[str] | None = None, limit: int | None = None) -> DataFrame:
    """Rows of a table that equal the given values; predicates and projection reach the Parquet scan. A table that is not there is empty."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}.parquet")
    if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        df = spark.read.parquet(f"{folder}/{name}.parquet")
    else:
        df = spark.createDataFrame([], schema_of(name))
    for column, value in (where or {}).items():
        df = df.where(F.col(column).eqNullSafe(F.lit(value)))
    df = df.select(*columns) if columns else df
    return df if limit is None else df.limit(limit)


def jdbc_scan(spark: SparkSession, url: str, name: str, options: dict[str, str] | None = None) -> DataFrame:
    """A table of a database; ``options`` may split it (partitionColumn, lowerBound, upperBound, numPartitions)."""
    return spark.read.format("jdbc").options(url=url, dbtable=name, **(options or {})).load()
