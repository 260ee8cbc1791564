"""Problem 7: encoding a corpus with a public tokenizer, by content-defined chunk reuse.

1. A rolling hash over ``WINDOW`` characters cuts each text where the hash falls on a boundary
   value, so equal passages are cut alike wherever they stand.
2. Equal chunks are encoded once: one row for each distinct chunk is encoded, all others join it.
3. Joins are repaired until they agree exactly. A token boundary is certain where a letter is followed
   by a non-letter, since no piece of the tokenizer's splitting pattern runs over such a place. Of an
   encoded chunk the ids between its first and its last certain boundary stand whatever is beside it;
   only the few characters before and after them travel as text and are encoded anew, together with
   those of the neighbouring chunk. A chunk without such a place travels whole.

The result is the same, id by id, as encoding each text whole. Null and empty texts give an empty
list. Chunks are known by 128-bit hashes; a chunk that stands in a third of all texts is encoded
once and its skewed join is split.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillgrid.runtime import as_table

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the published splitting pattern of the byte-level vocabulary of 50,257 ids.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: One cut in 512 characters on average; the cut depends on the 16 characters before it.
WINDOW, EVERY = 16, 512

_encodings: dict[str, tuple] = {}


def send_ranks(spark: SparkSession, ranks: str) -> None:
    """Send a rank file from the driver to every executor."""
    if os.path.basename(ranks) not in {os.path.basename(x) for x in spark.sparkContext.listFiles}:
        spark.sparkContext.addFile(ranks)


def encoding(ranks: str = RANKS):
    """(encoding, bytes of each id) of a rank file; loaded once for each worker, from its own path or from the files that were sent."""
    if ranks not in _encodings:
        import tiktoken

        with open(ranks if os.path.exists(ranks) else SparkFiles.get(os.path.basename(ranks)), "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        size = np.zeros(max(table.values()) + 1, np.int64)
        for piece, i in table.items():
            size[i] = len(piece)
        _encodings[ranks] = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=table, special_tokens={}), size
    return _encodings[ranks]


def cuts(text: str, window: int = WINDOW, every: int = EVERY) -> list[int]:
    """Where a text is cut, without its ends."""
    if len(text) <= window:
        return []
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    h, n = codes * np.uint64(0x9E3779B97F4A7C15), 1
    while n < window:
        h = h[: len(h) - n] * np.uint64(0xD6E8FEB86659FD93) + h[n:]
        n *= 2
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    at = np.flatnonzero((h >> np.uint64(33)) % np.uint64(every) == 0) + window
    return at[at < len(text)].tolist()


def chunks(text: str) -> list[str]:
    at = [0, *cuts(text), len(text)]
    return [text[x:y] for x, y in zip(at, at[1:])]


def _certain(text: str, i: int) -> bool:
    return text[i - 1].isalpha() and not text[i].isalpha()


def settle(part: str, ranks: str = RANKS) -> tuple[str, np.ndarray, str | None]:
    """(head, ids, tail) of a chunk: the ids that stand whatever its neighbours are, and the texts before and after them; tail is null where nothing stands, and head is all."""
    enc, size = encoding(ranks)
    tokens = np.asarray(enc.encode_ordinary(part), np.int64)
    starts = np.concatenate([[0], np.cumsum(size[tokens])])
    if part.isascii():
        byte = None
    else:
        codes = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32)
        byte = np.concatenate([[0], np.cumsum(1 + (codes >= 0x80) + (codes >= 0x800) + (codes >= 0x10000))])

    def token_at(i: int) -> int:
        """The number of the token that begins at a character, or -1."""
        at = i if byte is None else byte[i]
        k = int(np.searchsorted(starts, at))
        return k if k < len(starts) and starts[k] == at else -1

    def find(places) -> tuple[int, int] | None:
        return next(((i, k) for i in places if _certain(part, i) and (k := token_at(i)) >= 0), None)

    first = find(range(1, len(part)))
    if first is None:
        return part, tokens[:0], None
    last = find(range(len(part) - 1, 0, -1))
    return part[: first[0]], tokens[first[1] : last[1]], part[last[0] :]


def join_chunks(settled: list[tuple[str, np.ndarray, str | None]], ranks: str = RANKS) -> np.ndarray:
    """The ids of the joined chunks, exactly as if they had been encoded as one text."""
    enc, _ = encoding(ranks)
    out, open_ = [], ""
    for head, ids, tail in settled:
        open_ += head
        if tail is not None:
            out += [np.asarray(enc.encode_ordinary(open_), np.int64), ids]
            open_ = tail
    out.append(np.asarray(enc.encode_ordinary(open_), np.int64))
    return np.concatenate(out)


def corpus_ids(documents: DataFrame, key: str = "doc_id", text: str = "text", ranks: str = RANKS) -> DataFrame:
    """(doc_id, ids): a row for each distinct key and text; null or empty text: an empty list."""
    base = documents.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    kind = base.schema["doc_id"].dataType.simpleString()

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pieces, owner, number, whole, keys = [], [], [], [], []
            for row, text in enumerate(batch.column("text").to_pylist()):
                of_text = xxhash.xxh64_intdigest(text.encode()) - (1 << 63)
                for n, c in enumerate(chunks(text)):
                    owner.append(row)
                    whole.append(of_text)
                    number.append(n)
                    pieces.append(c)
                    keys.append(xxhash.xxh3_128_digest(c.encode()))
            columns = [batch.column("doc_id").take(pa.array(owner, pa.int32())), pa.array(whole, pa.int64()), pa.array(number, pa.int32()), pa.array(keys, pa.binary()), pa.array(pieces, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "whole", "n", "chunk", "part"])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [settle(x, ranks) for x in batch.column("part").to_pylist()]
            columns = [batch.column("chunk"), pa.array([m[0] for m in made], pa.string()), _lists([m[1] for m in made]), pa.array([m[2] for m in made], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["chunk", "head", "ids", "tail"])

    def mend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            groups = batch.column("pieces")
            ends, flat = groups.offsets.to_numpy(), groups.values
            number, ids = flat.field("n").to_numpy(), flat.field("ids")
            heads, tails = flat.field("head").to_pylist(), flat.field("tail").to_pylist()
            at, values = ids.offsets.to_numpy(), ids.values.to_numpy()
            made = []
            for x, y in zip(ends, ends[1:]):
                order = np.unique(number[x:y], return_index=True)[1] + x  # by number; a repeated row gives its pieces again
                made.append(join_chunks([(heads[i], values[at[i] : at[i + 1]].astype(np.int64), tails[i]) for i in order], ranks))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), _lists(made)], ["doc_id", "ids"])

    send_ranks(documents.sparkSession, ranks)
    parts = as_table(base.where("text <> ''").mapInArrow(split, f"doc_id {kind}, whole long, n int, chunk binary, part string"), "chunks")
    once = parts.groupBy("chunk").agg(F.first("part").alias("part")).mapInArrow(encode, "chunk binary, head string, ids array<int>, tail string")
    found = parts.select("doc_id", "whole", "n", "chunk").join(once, "chunk")
    whole = found.groupBy("doc_id", "whole").agg(F.collect_list(F.struct("n", "head", "ids", "tail")).alias("pieces")).select("doc_id", "pieces").mapInArrow(mend, f"doc_id {kind}, ids array<int>")
    blank = base.where("text is null or text = ''").select("doc_id", F.array().cast("array<int>").alias("ids")).dropDuplicates(["doc_id"])
    return whole.unionByName(blank)


def _lists(rows: list) -> pa.Array:
    """Rows of whole numbers as an Arrow array of int32 lists."""
    ends = np.concatenate([[0], np.cumsum([len(x) for x in rows])]).astype(np.int32)
    values = np.concatenate([np.asarray(x, np.int32) for x in rows]) if len(rows) else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values, pa.int32()))


def token_counts(documents: DataFrame, text: str = "text", ranks: str = RANKS, name: str = "tokens") -> DataFrame:
    """The documents with a column of their length in tokens; 0 for null and empty texts."""

    @F.pandas_udf("int")
    def count(batch: pd.Series) -> pd.Series:
        enc, _ = encoding(ranks)
        return batch.map(lambda x: len(enc.encode_ordinary(x)) if x else 0).astype("int32")

    send_ranks(documents.sparkSession, ranks)
    return documents.withColumn(name, count(F.col(text)))
