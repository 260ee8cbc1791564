"""Problem 1: versions of one story, by vantage-point trees over Hamming fingerprints.

A story is a page without furniture; two stories match when they have ``MIN_WORDS`` words each and
share at least ``THRESHOLD`` of their distinct three-word sequences.

* Each story gets a fingerprint of ``BITS`` = 256 bits, four of each of 64 min-hashes. A min-hash that
  agrees gives four equal bits, one that does not gives four random ones, so the Hamming distance of two
  stories follows from their similarity; a match at the threshold stays within ``RADIUS`` but for one
  in a hundred thousand, and unrelated stories lie four deviations beyond it.
* Shards: distances between unrelated stories crowd within a few bits of the middle, closer together
  than the radius is wide, so pivots chosen among the stories put every story within the radius of
  every border (the README has figures). The spheres that do separate are those around the rarest
  sequences of each story, so many that two stories that match have ``TOGETHER`` of them in common (or
  all that they must share), so no pair is lost; the radius is ``WIDE_RADIUS`` there. What is rare is
  told by counts of ``BUCKETS`` hash buckets, a table of fixed size; the counts give nothing but one
  common order, and every common order is as complete.
* Each shard is searched with one vantage-point tree, all its members together. A node is split where
  the triangle bound excludes the most, and is a leaf where it excludes nothing or holds ``LEAF`` at most.
  Two sets that must share s members have, of the first k that they share, each at least s - k + 1 to
  go; members and pairs with less to go are left out, and pairs that meet in fewer than k such shards.
* A shard that may be oversized is cut into blocks, and each pair of blocks is one unit of work, so no
  task ever holds a hot shard and no pair of its members is left out.
* With ``exact=False`` the spheres are those around ``BANDS`` pairs of min-hashes. That is cheaper, but
  loses 2e-5 of the pairs at the threshold, less above; no query uses it.
* Every candidate is verified exactly on the sets of sequences.

Equal stories are one class from the start: only one representative of each class is searched, and
classes are expanded to pairs at the very end.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillgrid.llm.boilerplate import annotate
from quillgrid.operators.components import connected_components
from quillgrid.runtime import as_table

MIN_WORDS, SHINGLE, THRESHOLD = 60, 3, 0.6
#: Two stories of n and m sequences match when they share this part of n + m.
SHARED = THRESHOLD / (1 + THRESHOLD)
#: 24 pairs of min-hashes: two stories at the threshold of 0.6 differ in all of them with probability (1 - 0.36) ** 24 = 2e-5.
BANDS, ROWS = 24, 2
MINS, BITS = 64, 256
#: Stories at the threshold differ in 51 bits on average with a deviation of 9.3; unrelated ones in 128 with a deviation of 8.
RADIUS = 91
#: In the spheres of rare sequences: seven deviations, lost with probability 1e-12.
WIDE_RADIUS = 116
#: Members of a shard that one unit of work holds at most.
BLOCK = 2048
#: Buckets in which sequences are counted, and parts of that table that are summed apart. The driver reads a byte for each bucket.
BUCKETS, PARTS = 1 << 21, 64
#: Two stories that match have so many of their first sequences in common, or all that they must share if those are fewer.
TOGETHER = 8
#: Vantage points that a node tries, and members of a leaf: so few are compared faster than they are split.
TRIES, LEAF = 4, 16

_WORDS = re.compile(r"[^\W_]+")

def _odd(n: int, seed: int, bits: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << (bits - 1), n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


# multiply-shift on 32 bits, which processors do for many values at once
_MUL = _odd(MINS, 20240607, 32).astype(np.uint32)
_ADD = _odd(MINS, 71, 32).astype(np.uint32)
_MIX = _odd(ROWS, 5, 63)
#: The bits of a min-hash that the fingerprint takes.
_PLACES = np.array([9, 12, 15, 18], np.uint32)

class _WordHashes(dict):
    """The hashes of words, each computed once."""

    def __missing__(self, word: str) -> int:
        if len(self) > 500_000:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


word_hash = _WordHashes()


def story_words(lines: list[str], flags: list[bool]) -> list[str]:
    """Runs of letters and digits of the lines that are no furniture, lower-cased."""
    return _WORDS.findall("\n".join(x for x, bad in zip(lines, flags) if not bad).lower())


def shingle_hashes(words: list[str], size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of ``size`` words."""
    if len(words) < size:
        return np.empty(0, np.uint64)
    a = np.fromiter(map(word_hash.__getitem__, words), np.uint64, len(words))
    out = a[: len(a) - size + 1].copy()
    for k in range(1, size):
        out *= np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
        out += a[k : len(a) - size + 1 + k]
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(32)
    return np.unique(out)


def sketch(shingles: np.ndarray) -> tuple[bytes, np.ndarray]:
    """(fingerprint, band keys as signed 64-bit numbers) of a set of sequences."""
    mins = ((shingles >> np.uint64(32)).astype(np.uint32)[:, None] * _MUL + _ADD).min(axis=0)
    fingerprint = np.packbits((mins[:, None] >> _PLACES & np.uint32(1)).astype(np.uint8)).tobytes()
    keys = (mins[: BANDS * ROWS].astype(np.uint64).reshape(BANDS, ROWS) * _MIX).sum(axis=1, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64)
    keys *= np.uint64(0xBF58476D1CE4E5B9)
    keys ^= keys >> np.uint64(31)
    return fingerprint, keys.view(np.int64)


_SKETCH = T.StructType(
    [
        T.StructField("story", T.BinaryType()),
        T.StructField("fingerprint", T.BinaryType()),
        T.StructField("bands", T.ArrayType(T.LongType())),
        T.StructField("shingles", T.ArrayType(T.IntegerType())),
    ]
)


def _sketch_row(lines: list[str], flags: list[bool]) -> tuple:
    words = story_words(lines, flags)
    if len(words) < MIN_WORDS:
        return None, None, None, None
    shingles = shingle_hashes(words)
    fingerprint, bands = sketch(shingles)
    return xxhash.xxh3_128_digest(shingles.tobytes()), fingerprint, bands, shingles.astype(np.uint32).view(np.int32)


def distances(points: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Hamming distances of fingerprints, rows of 64-bit words."""
    ones = np.bitwise_count(points ^ to)
    if ones.shape[-1] != 4 or not ones.flags.c_contiguous:
        return ones.sum(axis=-1, dtype=np.int32)
    four = ones.view(np.uint32)[..., 0]  # the counts of four words are added in one
    two = (four & np.uint32(0x00FF00FF)) + (four >> np.uint32(8) & np.uint32(0x00FF00FF))
    return (two + (two >> np.uint32(16)) & np.uint32(0x1FF)).view(np.int32)


class VantageTree:
    """A vantage-point tree over fingerprints under Hamming distance, joined with itself.

    A node holds a vantage point, an inner part within ``within`` of it and an outer part from
    ``beyond`` on. For a query at distance d the triangle inequality excludes the inner part when
    d - radius > within and the outer part when d + radius < beyond. The cut is put where these bounds
    exclude most members for the members themselves as queries; where none of ``TRIES`` vantage
    points excludes anything, the node is a leaf and compared directly.
    """

    def __init__(self, points: np.ndarray, radius: int = RADIUS):
        self.points, self.radius = points, radius
        self.nodes = self.leaves = self.compared = self.excluded = 0

    def _split(self, at: np.ndarray) -> tuple | None:
        best = None
        for v in at[np.linspace(0, len(at) - 1, min(TRIES, len(at))).astype(int)]:
            rest = at[at != v]
            d = distances(self.points[rest], self.points[v])
            order = np.argsort(d, kind="stable")
            s = d[order]
            cut = np.flatnonzero(s[1:] > s[:-1]) + 1  # the inner part has so many members
            if not len(cut):
                continue
            n = len(s)
            gain = (n - np.searchsorted(s, s[cut - 1] + self.radius, side="right")) * cut + np.searchsorted(s, s[cut] - self.radius, side="left") * (n - cut)
            k = int(np.argmax(gain))
            if gain[k] > 0 and (best is None or gain[k] > best[0]):
                best = gain[k], v, int(s[cut[k] - 1]), int(s[cut[k]]), rest[order[: cut[k]]], rest[order[cut[k] :]]
        return best and best[1:]

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """The positions (i, j), i < j, of the points within the radius of each other."""
        left, right = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        everything = np.arange(len(self.points))
        stack = [(everything, everything)]
        while stack:
            at, queries = stack.pop()
            split = self._split(at) if len(at) > LEAF else None
            if split is None:
                self.leaves += 1
                self.compared += len(at) * len(queries)
                step = max(1, (1 << 16) // max(1, len(at)))
                for x in range(0, len(queries), step):
                    part = queries[x : x + step]
                    i, j = np.nonzero(distances(self.points[part][:, None, :], self.points[at][None, :, :]) <= self.radius)
                    left.append(part[i])
                    right.append(at[j])
                continue
            v, within, beyond, inner, outer = split
            self.nodes += 1
            self.compared += len(queries)
            d = distances(self.points[queries], self.points[v])
            hit = queries[d <= self.radius]
            left.append(hit)
            right.append(np.full(len(hit), v))
            for part, mask in ((inner, d - self.radius <= within), (outer, d + self.radius >= beyond)):
                asked = queries[mask]
                self.excluded += (len(queries) - len(asked)) * len(part)
                if len(asked):
                    stack.append((part, asked))
        i, j = np.concatenate(left), np.concatenate(right)
        return i[i < j], j[i < j]


#: Rows of units of work, packed: the shard of each row; its story in ``stories``, and its side + 1 in two bits; what ``rest`` says; and n, story and fingerprint of the stories.
_PACKED = "part int, shards binary, members binary, rests binary, stories binary"
_NEAR = "story_a binary, story_b binary, need int"
#: Bits of n and of rest in the second number of a row, which holds n, rest and side + 1.
_META = 28
#: Rows of one part, about, and rows that are searched at a time.
PART, STEP = 1 << 20, 10_000


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """Whole units of work from the packed rows of a part, some at a time: (shard, meta, story, fingerprint), by shard."""
    packed: tuple[list, ...] = ([], [], [], [])
    for batch in batches:
        for values, column, kind in zip(packed, batch.columns[1:], (np.int64, np.uint32, np.uint32, np.int64)):
            values.extend(np.frombuffer(x, kind) for x in column.to_pylist())
    if not packed[0]:
        return
    told = [x.reshape(-1, 3 + BITS // 64) for x in packed[3]]
    base = np.cumsum([0, *map(len, told[:-1])])
    members = np.concatenate([(x >> np.uint32(2)).astype(np.int64) + y for x, y in zip(packed[1], base)])
    sides = np.concatenate(packed[1]) & np.uint32(3)
    shards, rests, stories = np.concatenate(packed[0]), np.concatenate(packed[2]), np.concatenate(told)
    order = np.argsort(shards)
    bounds = _runs(shards[order])[0]
    cuts = np.unique(np.r_[bounds[np.searchsorted(bounds, np.arange(0, len(shards), STEP), side="right") - 1], len(shards)])
    for at in (order[x:y] for x, y in zip(cuts[:-1], cuts[1:])):
        of = stories[members[at]]
        meta = of[:, 0] | rests[at].astype(np.int64) << _META | sides[at].astype(np.int64) << 2 * _META
        yield np.concatenate([np.stack([shards[at], meta], axis=1), of[:, 1:]], axis=1)


def _runs(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and sizes of the runs of equal keys."""
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]][: len(key)])
    return starts, np.diff(np.r_[starts, len(key)])


def _sizes(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(n, rest) of rows."""
    return rows[:, 1] & ((1 << _META) - 1), rows[:, 1] >> _META & ((1 << _META) - 1)


def _able(rows: np.ndarray) -> np.ndarray:
    """The members, by shard and n, that can match another of their shard if this sequence is one of the first that both have."""
    rows = rows[np.lexsort((_sizes(rows)[0], rows[:, 0]))]
    while len(rows):
        n, rest = _sizes(rows)
        reach = (rest + TOGETHER - 1 + 1e-6) / SHARED - n  # the longest partner
        starts, sizes = _runs(rows[:, 0])
        least = np.repeat(n[starts], sizes)
        least[starts] = n[np.minimum(starts + 1, len(n) - 1)]
        keep = (np.maximum(least, THRESHOLD * n) <= reach) & (n <= np.repeat(np.maximum.reduceat(reach, starts), sizes))
        keep &= np.repeat(np.add.reduceat(keep, starts, dtype=np.int64), sizes) > 1
        if keep.all():
            break
        rows = rows[keep]
    return rows


def _searched(rows: np.ndarray, radius: int = RADIUS, tally: list[int] | None = None) -> pa.RecordBatch:
    """(story_a, story_b, need), a < b, of the stories near each other in some units, a row for each shard that can be one of the first in common; those that match have ``need`` rows. tally: what ``_TALLY`` names."""
    rows = _able(rows)
    (n, rest), side = _sizes(rows), (rows[:, 1] >> 2 * _META) - 1
    points = np.ascontiguousarray(rows[:, 4:]).view(np.uint64)
    starts, sizes = _runs(rows[:, 0])

    def shared(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """The sequences that these pairs must share."""
        return np.ceil(SHARED * (n[i] + n[j]) - 1e-6).astype(np.int32)

    def possible(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        good = (np.minimum(rest[i], rest[j]) > shared(i, j) - TOGETHER) & (np.minimum(n[i], n[j]) >= THRESHOLD * np.maximum(n[i], n[j]) - 1e-6)
        return good & ((side[i] != side[j]) | (side[i] < 0)) & (rows[i, 2:4] != rows[j, 2:4]).any(axis=1)

    a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    single = sizes <= LEAF
    last = np.repeat(np.where(single, starts + sizes, 0), sizes)
    for o in range(1, LEAF):  # trees of one leaf, all at once
        i = np.flatnonzero(np.arange(o, len(rows) + o) < last)
        i = i[possible(i, i + o)]
        if tally is not None:
            tally[4] += len(i)
        i = i[distances(points[i], points[i + o]) <= radius]
        a.append(i)
        b.append(i + o)
    for s, size in zip(starts[~single], sizes[~single]):
        tree = VantageTree(points[s : s + size], radius)
        i, j = tree.pairs()
        good = possible(i + s, j + s)
        a.append(i[good] + s)
        b.append(j[good] + s)
        if tally is not None:
            for k, x in enumerate((1, 0, tree.nodes, tree.leaves, tree.compared, tree.excluded)):
                tally[k] += x
    if tally is not None:
        for k in range(2):
            tally[k] += int(single.sum())
    i, j = np.concatenate(a), np.concatenate(b)
    swap = (rows[i, 2] > rows[j, 2]) | (rows[i, 2] == rows[j, 2]) & (rows[i, 3] > rows[j, 3])
    i, j = np.where(swap, j, i), np.where(swap, i, j)
    stories = [pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(np.arange(0, 16 * len(x) + 1, 16, dtype=np.int32)), pa.py_buffer(np.ascontiguousarray(rows[x, 2:4]))]) for x in (i, j)]
    return pa.RecordBatch.from_arrays([*stories, pa.array(np.minimum(shared(i, j), TOGETHER))], names=["story_a", "story_b", "need"])


#: single: trees of one leaf's points, compared at once; the leaves are those of the other trees.
_TALLY = ["trees", "single", "inner_nodes", "leaves", "compared", "excluded"]


def _search(radius: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    return lambda batches: (_searched(rows, radius) for rows in _units(batches))


def _count(radius: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _units(batches):
            tally = [0] * len(_TALLY)
            _searched(rows, radius, tally)
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in tally], names=_TALLY)

    return run


def _shared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        share = np.empty(len(batch))
        for k, (x, y) in enumerate(zip(batch["x"], batch["y"])):
            n = len(np.intersect1d(x, y))
            share[k] = n / (len(x) + len(y) - n)
        keep = share >= THRESHOLD - 1e-12
        yield pd.DataFrame({"story_a": batch["story_a"][keep], "story_b": batch["story_b"][keep], "similarity": share[keep]})


def story_sketches(articles: DataFrame, key: str = "id", host: str = "source_id", text: str = "raw_markdown") -> DataFrame:
    """(page_id, story, fingerprint, bands, shingles, row) of the articles whose story has enough words, as a table; row is a number of its own."""
    return as_table(annotate(articles, _sketch_row, _SKETCH, key, host, text).where("story is not null").withColumn("row", F.monotonically_increasing_id()), "sketches")


def search_units(sketches: DataFrame, exact: bool = True) -> DataFrame:
    """The units of work (``_PACKED``), each unit in one partition; every two members of a shard meet in one of its units.

    n: the sequences of the story; rest: those from the one of this shard on, in the common order (both
    0 where shards are no sequences); side: of two blocks that are one unit, else -1.
    """
    copies = as_table(sketches.groupBy("story").agg(F.min("row").alias("kept"), F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("story").alias("copied"), "kept"), "copies")
    keys = sketches.select("story", "fingerprint", F.col("shingles" if exact else "bands").alias("keys"), "row")
    distinct = keys.join(copies, keys["story"] == copies["copied"], "left").where("kept is null or row = kept").select("story", "fingerprint", "keys")
    ranks, total = key_ranks(keys.select("keys"))
    rows = total * (1 - THRESHOLD) if exact else total
    parts = max(int(sketches.sparkSession.conf.get("spark.sql.shuffle.partitions")), int(rows) // PART + 1)
    return distinct.mapInArrow(_spheres(ranks, BLOCK, parts, exact), _PACKED).repartitionById(parts, F.col("part"))


def _bucket(keys: np.ndarray) -> np.ndarray:
    """By the upper bits of keys that are hashes."""
    u = keys.view(f"u{keys.itemsize}")
    return (u >> u.dtype.type(8 * u.itemsize + 1 - BUCKETS.bit_length())).astype(np.int64)


def _count_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        counts += np.bincount(_bucket(batch.column(0).flatten().to_numpy()), minlength=BUCKETS)
    if counts.any():
        yield pa.RecordBatch.from_arrays([pa.array(range(PARTS), pa.int32()), pa.array([x.tobytes() for x in np.split(counts.astype(np.uint32), PARTS)], pa.binary())], names=["part", "counts"])


def _rank_buckets(rows: pd.DataFrame) -> pd.DataFrame:
    counts = np.sum([np.frombuffer(x, np.uint32) for x in rows["counts"]], axis=0, dtype=np.uint64)
    return pd.DataFrame({"part": rows["part"].iloc[:1], "ranks": [np.floor(8 * np.log2(np.maximum(counts, 1))).astype(np.uint8).tobytes()], "total": [int(counts.sum())]})


def key_ranks(keys: DataFrame) -> tuple[np.ndarray, int]:
    """For each bucket of keys floor(8 log2 n) of the stories n that have them: an order of keys from rare to frequent, and a bound of how many share one. And how many keys there are."""
    counted = keys.mapInArrow(_count_buckets, "part int, counts binary")
    ranks, total = np.zeros((PARTS, BUCKETS // PARTS), np.uint8), 0
    for row in counted.groupBy("part").applyInPandas(_rank_buckets, "part int, ranks binary, total long").collect():
        ranks[row.part] = np.frombuffer(row.ranks, np.uint8)
        total += row.total
    return ranks.ravel(), total


def _spheres(ranks: np.ndarray, block: int, parts: int, exact: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows of :func:`search_units`: each story under its keys; if exact under its rarest sequences, so many that every match has ``TOGETHER`` of them in common.

    Of two sets with similarity t or more each shares at least t of its n members, so the n - ceil(t n) + k
    members that come first in any common order hold the first k that both have. Costs some 0.4 rows a word.
    """
    shared = SparkSession.active().sparkContext.broadcast(ranks)
    # a rank r stands for fewer than 2 ** ((r + 1) / 8) stories
    cuts = np.ceil(2.0 ** ((np.arange(256) + 1) / 8) / block).astype(np.int64)
    mix = np.uint64(0x9E3779B97F4A7C15)

    def packed(keys: np.ndarray, owner: np.ndarray, rest: np.ndarray, m: np.ndarray, mine: np.ndarray, told: np.ndarray) -> pa.RecordBatch:
        """A row for each part; a key that is cut into m blocks has one in each of m units."""
        each = np.repeat(np.arange(len(keys)), m)
        other = np.arange(len(each)) - np.repeat(np.cumsum(m) - m, m)
        keys, owner, rest, m, mine = keys[each], owner[each], rest[each], m[each], mine[each]
        unit = (np.minimum(mine, other) * m + np.maximum(mine, other) + 1).astype(np.uint64)
        shard = np.where(m > 1, (keys ^ unit * mix) * mix, keys)  # shards that happen to be one only cost comparisons
        side = np.where(mine == other, 0, 1 + (mine > other)).astype(np.uint32)
        part = (shard * mix >> np.uint64(33)) % np.uint64(parts)
        order = np.argsort(part.astype(np.uint16) if parts <= 1 << 16 else part, kind="stable")
        part, owner = part[order], owner[order]
        begin, sizes = _runs(part)
        fresh = np.r_[True, owner[1:] != owner[:-1]]
        fresh[begin] = True
        at = np.cumsum(fresh) - 1  # among the stories of all parts
        member = (at - np.repeat(at[begin], sizes)).astype(np.uint32) << np.uint32(2) | side[order]
        columns = (shard[order], begin), (member, begin), (rest[order].astype(np.uint32), begin), (told[owner[fresh]], at[begin])
        blobs = [pa.array([x.tobytes() for x in np.split(values, starts[1:])], pa.binary()) for values, starts in columns]
        return pa.RecordBatch.from_arrays([pa.array(part[begin].astype(np.int32)), *blobs], names=[x.split()[0] for x in _PACKED.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            story, fingerprint = (np.frombuffer(b"".join(batch.column(x).to_pylist()), np.int64).reshape(batch.num_rows, -1) for x in (0, 1))
            n = batch.column(2).value_lengths().to_numpy().astype(np.int64)
            keys = batch.column(2).flatten().to_numpy()
            rank = shared.value[_bucket(keys)]
            keys = keys.view(f"u{keys.itemsize}").astype(np.uint64)
            owner = np.repeat(np.arange(len(n)), n)
            rest = np.zeros(len(keys), np.int64)
            if exact:
                order = np.argsort(owner.astype(np.uint64) << np.uint64(40) | rank.astype(np.uint64) << np.uint64(32) | keys)
                at = np.arange(len(keys)) - np.repeat(np.cumsum(n) - n, n)
                first = at < np.repeat(n - np.ceil(n * THRESHOLD - 1e-9).astype(np.int64) + TOGETHER, n)
                keys, rank, owner = keys[order[first]], rank[order[first]], owner[first]
                rest = n[owner] - at[first]
            m = cuts[rank]
            mine = (story.view(np.uint64)[owner, 0] % m.astype(np.uint64)).astype(np.int64)
            told = np.concatenate([(n if exact else 0 * n)[:, None], story, fingerprint], axis=1)
            ends = np.cumsum(m)
            cuts_at = np.unique(np.r_[np.searchsorted(ends, np.arange(0, ends[-1] if len(ends) else 0, PART)), len(m)])
            for x, y in zip(cuts_at[:-1], cuts_at[1:]):
                yield packed(keys[x:y], owner[x:y], rest[x:y], m[x:y], mine[x:y], told)

    return run


def search_counts(sketches: DataFrame, exact: bool = True) -> DataFrame:
    """One row of what the search does: trees, those of one leaf's points, inner nodes, leaves, comparisons made and comparisons that the triangle bound excluded."""
    tallies = search_units(sketches, exact).mapInArrow(_count(WIDE_RADIUS if exact else RADIUS), ", ".join(f"{x} long" for x in _TALLY))
    return tallies.agg(*[F.sum(x).alias(x) for x in _TALLY])


def similar_stories(sketches: DataFrame, exact: bool = True) -> DataFrame:
    """(story_a, story_b, similarity): the pairs of different stories that match, one row each."""
    near = search_units(sketches, exact).mapInArrow(_search(WIDE_RADIUS if exact else RADIUS), _NEAR)
    pairs = as_table(near.groupBy("story_a", "story_b", "need").agg(F.count(F.lit(1)).alias("n")).where("n >= need").select("story_a", "story_b"), "near")
    named = pairs.select(F.col("story_a").alias("story")).union(pairs.select("story_b"))
    bodies = as_table(sketches.select("story", "shingles").join(named, "story", "left_semi").dropDuplicates(["story"]), "bodies")
    both = pairs.join(bodies.select(F.col("story").alias("story_a"), F.col("shingles").alias("x")), "story_a").join(
        bodies.select(F.col("story").alias("story_b"), F.col("shingles").alias("y")), "story_b"
    )
    return both.select("story_a", "story_b", "x", "y").mapInPandas(_shared, "story_a binary, story_b binary, similarity double")


def same_story_pairs(articles: DataFrame, key: str = "id", host: str = "source_id", text: str = "raw_markdown", exact: bool = True) -> DataFrame:
    """(article_id_a, article_id_b): every two articles with the same story, a < b.

    ``exact=False`` searches the spheres of pairs of min-hashes instead, which lose 2e-5 of the pairs at the threshold.
    Null and short texts match nothing. Articles with a repeated key count as one.
    """
    sketches = story_sketches(articles, key, host, text)
    members = sketches.select("story", F.col("page_id").alias("id"))
    between = (
        similar_stories(sketches, exact)
        .join(members.select(F.col("story").alias("story_a"), F.col("id").alias("x")), "story_a")
        .join(members.select(F.col("story").alias("story_b"), F.col("id").alias("y")), "story_b")
        .select(F.least("x", "y").alias("article_id_a"), F.greatest("x", "y").alias("article_id_b"))
    )
    within = members.alias("p").join(members.alias("q"), F.col("p.story") == F.col("q.story")).where("p.id < q.id").select(F.col("p.id").alias("article_id_a"), F.col("q.id").alias("article_id_b"))
    return between.where("article_id_a < article_id_b").unionByName(within).distinct()


def story_groups(articles: DataFrame, key: str = "id", host: str = "source_id", text: str = "raw_markdown") -> DataFrame:
    """(article_id, group_id, members, links) of each article that has a long enough story.

    group_id is the least article id of the group that matches tie together; links counts the
    *different* stories that match its own, so copies are never expanded into pairs.
    """
    sketches = story_sketches(articles, key, host, text)
    matches = as_table(similar_stories(sketches).select("story_a", "story_b"), "matches")
    parts = connected_components(matches, "story_a", "story_b")
    links = matches.select("story_a").union(matches.select("story_b")).groupBy("story_a").agg(F.count(F.lit(1)).alias("links")).withColumnRenamed("story_a", "linked")
    members = sketches.select(F.col("page_id").alias("article_id"), "story")
    tied = members.join(parts, members["story"] == parts["node"], "left").select("article_id", "story", F.coalesce("component", "story").alias("part"))
    heads = tied.groupBy("part").agg(F.min("article_id").alias("group_id"), F.count(F.lit(1)).alias("members"))
    return tied.join(heads, "part").join(links, tied["story"] == links["linked"], "left").select("article_id", "group_id", "members", F.coalesce("links", F.lit(0)).alias("links"))
