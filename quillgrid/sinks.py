"""Where results go: partitioned tables, markdown files, JSON lines."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillgrid.functions.text import file_name


def write_partitioned(df: DataFrame, path: str, by: str, sort: tuple[str, ...] = (), files: int = 1) -> None:
    """A table laid out for its lookups, in place of indexes: a folder for each day of ``by``, rows sorted within files so that their statistics prune; ``files`` spreads a day that holds many rows."""
    day = df.withColumn("day", F.to_date(by))
    spread = day.repartition("day", F.pmod(F.xxhash64(*(sort or (by,))), F.lit(files))) if files > 1 else day.repartition("day")
    spread.sortWithinPartitions("day", *sort).write.mode("overwrite").partitionBy("day").parquet(path)


def write_bucketed(df: DataFrame, name: str, keys: tuple[str, ...], buckets: int) -> None:
    """A table whose joins and aggregations on the keys need no shuffle."""
    df.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)


def markdown_files(pages: DataFrame, path: str, title: str = "title", text: str = "raw_markdown", key: str = "id") -> DataFrame:
    """Write each text to a file named after its title and key, from the workers; (key, file) of those written. ``path`` must be a folder that all workers share. Null texts have no file."""
    named = pages.where(F.col(text).isNotNull()).select(F.col(key).cast("string").alias("key"), F.concat(file_name(F.col(title)), F.lit("-"), F.col(key), F.lit(".md")).alias("file"), F.col(text).alias("text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pathlib import Path

        folder = Path(path.removeprefix("file://"))
        folder.mkdir(parents=True, exist_ok=True)
        for batch in batches:
            for name, body in zip(batch["file"], batch["text"]):
                (folder / name).write_text(body, encoding="utf-8", errors="surrogatepass")
            yield batch[["key", "file"]]

    return named.mapInPandas(run, "key string, file string")


def json_lines(df: DataFrame, path: str) -> None:
    """One JSON object for each row; null fields stay."""
    df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")).write.mode("overwrite").text(path)
