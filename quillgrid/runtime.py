"""Where intermediate tables live, and how they outlive an executor.

A stage that is read more than once is written as a Parquet table below the folder that the cluster
names in ``spark.checkpoint.dir``. Such a table cuts lineage, survives lost executors, and gives
Catalyst its true size, so that the choice between broadcast and shuffle joins rests on a measured
number. Where the setting is missing a temporary folder is used, but only on a local master: on a
cluster each executor would write to its own disk. The tables end with the application, or earlier by
:func:`forget_tables`.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local: dict[str, str] = {}
_written: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder for intermediate tables."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local:
        _local[app] = tempfile.mkdtemp(prefix="quillgrid-")
        atexit.register(shutil.rmtree, _local[app], ignore_errors=True)
    return "file://" + _local[app]


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder in the shared folder, made and deleted with the application."""
    path = f"{shared_dir(spark)}/quillgrid/{name}-{uuid.uuid4().hex}"
    fs, target = _file_system(spark, path)
    fs.mkdirs(target)
    fs.deleteOnExit(target)
    _written.append((spark, path))
    return path


def as_table(df: DataFrame, name: str, hashes: tuple[str, ...] = ()) -> DataFrame:
    """Write a DataFrame to the shared folder and read it back. ``hashes``: columns of hashes, for which a dictionary is a waste."""
    spark = df.sparkSession
    path = scratch(spark, name) + "/t"
    writer = df.write.option("compression", "lz4")
    for column in hashes:
        writer = writer.option(f"parquet.enable.dictionary#{column}", "false")
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget_tables(spark: SparkSession) -> None:
    """Delete the intermediate tables of a session; call it once their results are written."""
    for owner, path in [x for x in _written if x[0] is spark]:
        fs, target = _file_system(spark, path)
        fs.delete(target, True)
        _written.remove((owner, path))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the tables of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
