"""Incremental ingestion with Structured Streaming: first-seen rows, daily counts, circuit breaker, keyed upsert.

Streams read files, run with ``availableNow`` and keep their place in a checkpoint below the shared
folder, so a restarted run goes on where the last one ended; the checkpoint takes the place of a
stored cursor. State is keyed and spread over the shuffle partitions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from quillgrid.runtime import as_table, scratch


def read_stream(spark: SparkSession, folder: str, name: str, per_trigger: int = 8) -> DataFrame:
    """A table of a data folder as a stream of files, its schema taken from the files' footers."""
    schema = spark.read.parquet(f"{folder}/{name}.parquet").schema
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger)
    return source.option("pathGlobFilter", f"{name}.parquet").parquet(folder) if _is_file(spark, f"{folder}/{name}.parquet") else source.parquet(f"{folder}/{name}.parquet")


def _is_file(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(target).isFile()


def drain(stream: DataFrame, name: str, mode: str = "append", each: Callable[[DataFrame, int], None] | None = None, place: str | None = None) -> DataFrame:
    """Run a stream over all that is there and read its sink back. ``place``: a folder to go on from; a new one by default.

    ``each`` handles a micro-batch instead of the file sink; it must be safe to repeat.
    """
    spark = stream.sparkSession
    root = place or scratch(spark, f"stream-{name}")
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True)
    writer = writer.foreachBatch(each) if each else writer.format("parquet").option("path", f"{root}/rows")
    writer.start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{root}/rows")


def first_seen(stream: DataFrame, keys: list[str], event_time: str, late: str = "60 days") -> DataFrame:
    """The first row of each key, within a watermark that bounds the state."""
    return stream.withColumn(event_time, F.col(event_time).cast("timestamp")).withWatermark(event_time, late).dropDuplicatesWithinWatermark(keys)


def daily_counts(stream: DataFrame, event_time: str, keys: list[str], late: str = "1 day") -> DataFrame:
    """(day, keys, n) over tumbling days; late rows up to the watermark count."""
    timed = stream.withColumn(event_time, F.col(event_time).cast("timestamp")).withWatermark(event_time, late)
    return timed.groupBy(F.window(event_time, "1 day"), *keys).agg(F.count(F.lit(1)).alias("n")).select(F.date_format("window.start", "yyyy-MM-dd").alias("day"), *keys, "n")


def breaker(stream: DataFrame, key: str, order: list[str], failed: str, trip: int = 3) -> DataFrame:
    """(key, order[-1], run_length, tripped): failures in a row, kept as one number of state for each key.

    Rows of one micro-batch are taken in order; the files must arrive in order of time.
    """
    kinds = {c: stream.schema[c].dataType.simpleString() for c in (key, order[-1])}

    def step(_, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        run = state.get[0] if state.exists else 0
        rows = pd.concat(list(frames)).sort_values(order)
        lengths = []
        for bad in rows[failed]:
            run = run + 1 if bad else 0
            lengths.append(run)
        state.update((run,))
        yield pd.DataFrame({key: rows[key].to_numpy(), order[-1]: rows[order[-1]].to_numpy(), "run_length": lengths, "tripped": [n >= trip for n in lengths]})

    out = f"{key} {kinds[key]}, {order[-1]} {kinds[order[-1]]}, run_length long, tripped boolean"
    return stream.groupBy(key).applyInPandasWithState(step, out, "run long", "append", GroupStateTimeout.NoTimeout)


def upsert_batches(spark: SparkSession, root: str, key: str, buckets: int = 16) -> Callable[[DataFrame, int], None]:
    """A micro-batch handler that adds the keys the sink lacks. Each batch has a folder of its own that is overwritten when it is repeated.

    The keys are also kept apart, by bucket of their hash, so that a batch compares itself with the
    keys of its buckets and never reads earlier rows.
    """

    def each(batch: DataFrame, number: int) -> None:
        bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
        rows = batch.dropDuplicates([key]).withColumn("__bucket", bucket)
        if number > 0:
            touched = [r[0] for r in rows.select("__bucket").distinct().collect()]
            known = spark.read.schema(f"`{key}` {batch.schema[key].dataType.simpleString()}, __bucket int, batch int").option("basePath", f"{root}/keys").parquet(f"{root}/keys")
            rows = rows.join(known.where(F.col("__bucket").isin(touched) & (F.col("batch") < number)).select(key), key, "left_anti")
        rows = as_table(rows, "upsert")
        rows.select(key, "__bucket").write.mode("overwrite").partitionBy("__bucket").parquet(f"{root}/keys/batch={number}")
        rows.drop("__bucket").write.mode("overwrite").parquet(f"{root}/rows/batch={number}")

    return each


class Progress(StreamingQueryListener):
    """The progress of streams as rows (name, batch, rows, rows_per_second, state_rows, late_rows), for polling; ``running`` names those under way."""

    def __init__(self):
        self.rows: list[tuple] = []
        self.running: set[str] = set()

    def onQueryStarted(self, event) -> None:
        self.running.add(str(event.runId))

    def onQueryProgress(self, event) -> None:
        p = event.progress
        late = sum(s.numRowsDroppedByWatermark for s in p.stateOperators)
        self.rows.append((p.name, p.batchId, p.numInputRows, p.processedRowsPerSecond, sum(s.numRowsTotal for s in p.stateOperators), late))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.running.discard(str(event.runId))

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows, "name string, batch long, rows long, rows_per_second double, state_rows long, late_rows long")
