"""Problem 2: lines repeated across one site's documents, by incremental line-count tables.

A :class:`LineStore` is a folder with three tables, each a partition for each batch of documents
merged so far; a merge appends its own partitions and rewrites none:

* ``lines``: the postings, a row for each document with the hashes of its lines in order;
* ``counts``: the delta, a row for each (source, line) of the batch with the number of its documents;
* ``crossed``: the lines whose count, over all batches, reached the threshold in this merge. A line
  crosses once, so the lines over the threshold are simply all rows of this table.

A merge reads no text but that of its own batch. A crossing concerns two kinds of documents: those of
the new batch that hold a line over the threshold, whenever it crossed, and older ones that hold a
newly crossed line, which their postings tell. Only these are rebuilt. A merge that was cut short
may be run again; it replaces its own partitions.

A line is known by a 64-bit hash of its normal form (blanks collapsed, case ignored, each run of
digits one mark) within its source, so no text is shuffled. A source that holds a third of the
documents is spread over all tasks because the key includes the line; the postings of a line that
stands in a third of all documents are skewed on one key, which the join splits (AQE), the crossed
side being small.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MIN_CHARS, MIN_DOCUMENTS = 20, 8
_KEYS = ["source", "line"]


def line_keys(text: Column, min_chars: int = MIN_CHARS) -> Column:
    """For each line of a text the hash of its normal form, null for lines that are too short."""
    flat = F.regexp_replace(text, "[ \t\r]+", " ")
    normal = F.regexp_replace(F.lower(flat), "[0-9]+", "0")
    return F.zip_with(F.split(flat, "\n"), F.split(normal, "\n"), lambda x, y: F.when(F.length(F.trim(x)) >= min_chars, F.xxhash64(F.trim(y))))


def _postings(lines: DataFrame, over: DataFrame) -> DataFrame:
    """(document, line_no) of the lines in ``over``."""
    found = lines.select("document", "source", F.posexplode("lines").alias("at", "line")).where("line is not null")
    return found.join(over, _KEYS).select("document", (F.col("at") + 1).cast("int").alias("line_no"))


class LineStore:
    """The maintained state of one collection, below ``path``. Batches are whole numbers, merged in rising order.

    Each row of a batch is a document. Documents of null texts or null sources have no lines.
    """

    def __init__(self, spark: SparkSession, path: str, threshold: int = MIN_DOCUMENTS, min_chars: int = MIN_CHARS):
        self.spark, self.path, self.threshold, self.min_chars = spark, path.rstrip("/"), threshold, min_chars

    def batches(self) -> list[int]:
        """The batches merged so far, read from the folder."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/crossed")
        fs = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        done = self.spark._jvm.org.apache.hadoop.fs.Path
        names = [x.getPath().getName() for x in fs.listStatus(folder)] if fs.exists(folder) else []
        return sorted(int(n.partition("=")[2]) for n in names if n.startswith("batch=") and fs.exists(done(f"{self.path}/crossed/{n}/_SUCCESS")))

    def _write(self, table: DataFrame, name: str, batch: int) -> None:
        table.write.mode("overwrite").option("compression", "lz4").parquet(f"{self.path}/{name}/batch={batch}")

    def _read(self, name: str, batches: list[int], schema: str | T.StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{name}/batch={b}" for b in batches]) if batches else self.spark.createDataFrame([], schema)

    def lines(self, batches: list[int]) -> DataFrame:
        return self._read("lines", batches, self.spark.read.parquet(f"{self.path}/lines/batch={self.batches()[0]}").schema)

    def counts(self, batches: list[int]) -> DataFrame:
        return self._read("counts", batches, "source string, line long, n long")

    def crossed(self, batches: list[int]) -> DataFrame:
        return self._read("crossed", batches, "source string, line long")

    def merge(self, documents: DataFrame, batch: int, key: str = "id", source: str = "source_id", text: str = "raw_markdown") -> None:
        """Add a batch of documents: write its postings, its delta, and the lines that cross by it."""
        before = [b for b in self.batches() if b != batch]
        if before and before[-1] > batch:
            raise ValueError(f"batch {before[-1]} was merged before batch {batch}")
        usable = documents.where(F.col(text).isNotNull() & F.col(source).isNotNull())
        self._write(usable.select(F.col(key).alias("document"), F.col(source).cast("string").alias("source"), line_keys(F.col(text), self.min_chars).alias("lines")), "lines", batch)
        lines = self.spark.read.parquet(f"{self.path}/lines/batch={batch}")
        each = lines.select("source", F.explode(F.array_distinct("lines")).alias("line")).where("line is not null")
        self._write(each.groupBy(*_KEYS).agg(F.count(F.lit(1)).alias("n")), "counts", batch)
        zero = F.lit(0).cast("long")
        both = self.counts([batch]).select(*_KEYS, zero.alias("n_old"), F.col("n").alias("n_new"))
        if before:
            both = both.unionByName(self.counts(before).select(*_KEYS, F.col("n").alias("n_old"), zero.alias("n_new")))
            both = both.groupBy(*_KEYS).agg(F.sum("n_old").alias("n_old"), F.sum("n_new").alias("n_new"))
        crosses = (F.col("n_old") < self.threshold) & (F.col("n_old") + F.col("n_new") >= self.threshold)
        self._write(both.where(crosses).select(*_KEYS), "crossed", batch)

    def found(self, batch: int) -> DataFrame:
        """(document, line_no): what the merge of a batch adds to the repeated lines.

        Of its own documents every line over the threshold by then, of older ones the lines that
        crossed in this merge. Over all batches each repeated line comes once.
        """
        upto = [b for b in self.batches() if b <= batch]
        own = _postings(self.lines([batch]), self.crossed(upto))
        return own.unionByName(_postings(self.lines(upto[:-1]), self.crossed([batch]))) if upto[:-1] else own

    def repeated(self) -> DataFrame:
        """(document, line_no) of all batches, from the parts that the merges added."""
        return reduce(DataFrame.unionByName, [self.found(b) for b in self.batches()])

    def rebuilt(self, documents: DataFrame, batch: int, key: str = "id", text: str = "raw_markdown") -> DataFrame:
        """(document, body): the documents whose body changes by the merge of a batch, without all their repeated lines.

        ``documents`` must hold the documents of all batches so far; those that do not change are not rebuilt.
        """
        upto = [b for b in self.batches() if b <= batch]
        changed = self.found(batch).select("document").distinct()
        bad = _postings(self.lines(upto).join(changed, "document", "left_semi"), self.crossed(upto))
        return _without(documents, bad, key, text, "inner")


def _without(documents: DataFrame, bad: DataFrame, key: str, text: str, how: str) -> DataFrame:
    gone = bad.groupBy("document").agg(F.collect_set("line_no").alias("bad"))
    joined = documents.select(F.col(key).alias("document"), F.col(text).alias("text")).join(gone, "document", how)
    none = F.coalesce("bad", F.array().cast("array<int>"))
    kept = F.filter(F.transform(F.split("text", "\n"), lambda x, i: F.when(~F.array_contains(none, i + 1), x)), lambda x: x.isNotNull())
    return joined.select("document", F.when(F.col("text").isNotNull(), F.array_join(kept, "\n")).alias("body"))


def bodies(documents: DataFrame, repeated: DataFrame, key: str = "id", text: str = "raw_markdown") -> DataFrame:
    """(document, body): every document without its repeated lines (null text: null body). repeated: (document, line_no)."""
    return _without(documents, repeated, key, text, "left")


def merged_store(documents: DataFrame, batch: Column, path: str, key: str = "id", source: str = "source_id", text: str = "raw_markdown", threshold: int = MIN_DOCUMENTS, min_chars: int = MIN_CHARS) -> LineStore:
    """A store into which a table was merged batch by batch. ``batch``: the number of each document's batch, null counts as 0; there must be few batches."""
    store = LineStore(documents.sparkSession, path, threshold, min_chars)
    number = F.coalesce(batch.cast("int"), F.lit(0))
    for (b,) in documents.select(number.alias("b")).distinct().orderBy("b").collect() or [(0,)]:
        store.merge(documents.where(number == b), b, key, source, text)
    return store
