"""Problem 9: long exact spans shared between records, by level-wise doubling.

Level 0 are windows of ``BASE`` = 50 characters at *anchors*: of each run of ``RUN`` neighbouring
positions the one with the least hash. Two records that share a span share its anchors, and a span
of ``MIN_SPAN`` = 200 characters has one so near its start that the window of 100 characters there
still lies inside the span. A window that stands in one record only is dropped; the others are
extended to twice their length: 50, 100, 200. At 200 a window may begin at its anchor, or
as far before it as the first 100 characters allow; these two are kept for each anchor (128-bit hashes).
Only where the records of an anchor disagree on both sides, so that a span may begin and end within
these bounds, are the windows between them compared one by one. Nothing is sampled: each shared span
is found. For the report of spans (:func:`spans`) the surviving windows are doubled further, until no
candidates survive.

Equal texts are one class from the start and are represented by one member. Windows are grouped by
the *set* of records that hold them (a sum of record hashes, combined map-side), so records that
share a passage meet once and not once for each of its positions.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from quillgrid.runtime import as_table

#: RUN - 1 + 2 * BASE must not exceed MIN_SPAN, nor RUN - 1 + BASE.
MIN_SPAN, BASE, RUN = 200, 50, 101
LEVELS = 2
#: So far before an anchor a span of MIN_SPAN may begin that holds the anchor's window of the last level.
BACK = MIN_SPAN - (BASE << LEVELS - 1)
#: Characters of texts that are hashed together.
TOGETHER = 1 << 20
#: Texts are hashed together in pieces of so many characters; longer ones are cut into overlapping pieces.
PIECE = 1 << 16

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _join(left: np.ndarray, right: np.ndarray, salt: int) -> np.ndarray:
    """Hashes of the windows made of a left and a right part."""
    h = left * _A + (right ^ np.uint64(salt * 0x2545F491))
    h ^= h >> np.uint64(31)
    h *= _B
    h ^= h >> np.uint64(29)
    return h


def window_hashes(codes: np.ndarray, sizes: tuple[int, ...], seed: int = 1) -> dict[int, np.ndarray]:
    """For each size (a sum of powers of two built by doubling) the hash of the window at each position where it fits."""
    level = {1: _join(codes.astype(np.uint64) + np.uint64(seed), np.full(len(codes), np.uint64(seed * 77 + 5)), 1)}
    n = 1
    while 2 * n <= max(sizes):
        h = level[n]
        level[2 * n] = _join(h[: max(0, len(h) - n)], h[n:], 2 * n)
        n *= 2
    out = {}
    for size in sizes:
        bits = [1 << b for b in range(size.bit_length() - 1, -1, -1) if size >> b & 1]
        fit = max(0, len(codes) - size + 1)
        h, at = level[bits[0]][:fit], bits[0]
        for b in bits[1:]:
            h = _join(h, level[b][at : at + fit], b)
            at += b
        out[size] = h
    return out


def run_anchors(hashes: np.ndarray, run: int = RUN) -> np.ndarray:
    """For each run of neighbouring positions, by its start, the position of its least hash (the last of them)."""
    # sliding minimum of (hash, position) by doubling; ties go to the later position
    best, at, width = hashes, np.arange(len(hashes)), 1
    while width < run:
        step = min(width, run - width)
        later = best[step:] <= best[: max(0, len(best) - step)]
        best, at = np.where(later, best[step:], best[: max(0, len(best) - step)]), np.where(later, at[step:], at[: max(0, len(at) - step)])
        width += step
    return at


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def _pieces(texts) -> Iterator[tuple[np.ndarray, list[tuple[int, int, int, int]]]]:
    """Texts packed into arrays of characters: (codes, [(text number, its offset here, length here, offset of that part in the text)]).

    Parts of one long text overlap so that each window of MIN_SPAN characters lies in exactly one.
    """
    codes, parts, size = [], [], 0
    for number, text in enumerate(texts):
        c = _codes(text)
        at = 0
        while True:
            part = c[at : at + PIECE]
            if size and size + len(part) > PIECE:
                yield np.concatenate(codes), parts
                codes, parts, size = [], [], 0
            parts.append((number, size, len(part), at))
            codes.append(part)
            size += len(part)
            if at + PIECE >= len(c):
                break
            at += PIECE - MIN_SPAN + 1
    if size:
        yield np.concatenate(codes), parts


def _owners(at: np.ndarray, parts: list[tuple[int, int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """For positions in packed texts: the number of the text, and the position in it."""
    k = np.searchsorted([x for _, x, _, _ in parts], at, side="right") - 1
    table = np.array(parts, np.int64)
    return table[k, 0], at - table[k, 1] + table[k, 3]


def _starts(parts: list[tuple[int, int, int, int]]) -> np.ndarray:
    """Where windows of MIN_SPAN characters begin in packed texts; the run of anchors that begins there lies inside the window."""
    return np.concatenate([np.arange(x, x + n - MIN_SPAN + 1) for _, x, n, _ in parts])


def _anchor_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    sizes = tuple(BASE << level for level in range(LEVELS))
    for batch in batches:
        records = batch["record"].to_numpy()
        for codes, parts in _pieces(batch["text"]):
            h = window_hashes(codes, sizes)
            at = np.unique(run_anchors(h[BASE])[_starts(parts)])
            number, place = _owners(at, parts)
            rows = pd.DataFrame({"record": records[number], "at": place.astype(np.int32)} | {f"h{i}": h[s][at].astype(np.int64) for i, s in enumerate(sizes)})
            yield rows.drop_duplicates(["record", "at"])


def _hash_rows(n: int) -> np.ndarray:
    """Two vectors of n odd multipliers."""
    return np.random.default_rng(n).integers(0, 1 << 63, (2, n), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


_multipliers: dict[int, np.ndarray] = {}


def hash_windows(codes: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of the windows of some length at some positions, where all of them fit."""
    if size not in _multipliers:
        _multipliers[size] = _hash_rows(size)
    found = [np.empty((0, 2), np.uint64)]
    step = max(1, (1 << 20) // size)
    for i in range(0, len(at), step):
        w = codes[at[i : i + step, None] + np.arange(size)].astype(np.uint64) + np.uint64(1)
        h = np.stack([(w * m).sum(axis=1, dtype=np.uint64) for m in _multipliers[size]], axis=1)
        h ^= h >> np.uint64(32)
        h *= _B
        found.append(h)
    both = np.concatenate(found).astype(np.int64)
    return both[:, 0], both[:, 1]


def _together(frame: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Texts with their living anchors, some at a time: (codes of all, number of the row, where its text begins, anchor), the last three for each anchor."""
    codes, rows, begins, anchors, size = [], [], [], [], 0
    for number, (text, alive) in enumerate(zip(frame["text"], frame["alive"])):
        c, at = _codes(text), np.unique(np.asarray(alive, np.int64))
        codes.append(c)
        rows.append(np.full(len(at), number))
        begins.append(np.full(len(at), size))
        anchors.append(at)
        size += len(c)
        if size > TOGETHER:
            yield np.concatenate(codes), np.concatenate(rows), np.concatenate(begins), np.concatenate(anchors)
            codes, rows, begins, anchors, size = [], [], [], [], 0
    if codes:
        yield np.concatenate(codes), np.concatenate(rows), np.concatenate(begins), np.concatenate(anchors)


def _side_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For each living anchor the hashes of the windows of MIN_SPAN characters that begin there (x0, y0), or BACK before (x1, y1), null where they don't fit; and the characters of both."""
    for batch in batches:
        records, texts = batch["record"].to_numpy(), batch["text"].to_numpy()
        length = np.array([len(x) for x in texts], np.int64)
        groups = [dict(zip(a.tolist(), g.tolist())) for a, g in zip(batch["alive"], batch["groups"])]
        for codes, row, begin, at in _together(batch):
            out = {"record": records[row], "anchor": at.astype(np.int32), "g": np.array([groups[r][a] for r, a in zip(row.tolist(), at.tolist())], np.int64)}
            for side, start in ((0, at), (1, at - BACK)):
                fits = np.flatnonzero((start >= 0) & (start + MIN_SPAN <= length[row]))
                for name, h in zip(("x", "y"), hash_windows(codes, (begin + start)[fits], MIN_SPAN)):
                    column = pd.array(np.zeros(len(at), np.int64), dtype="Int64")
                    column[:] = pd.NA
                    column[fits] = h
                    out[f"{name}{side}"] = column
            out["start"] = np.maximum(0, at - BACK).astype(np.int32)
            out["context"] = [texts[r][max(0, a - BACK) : a + MIN_SPAN] for r, a in zip(row.tolist(), at.tolist())]
            yield pd.DataFrame(out)


def _between_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The windows of MIN_SPAN characters in the contexts of some anchors, each at the anchor of its own first run, so that none comes twice."""
    for batch in batches:
        records, begin, anchor = batch["record"].to_numpy(), batch["start"].to_numpy(), batch["anchor"].to_numpy()
        for codes, parts in _pieces(batch["context"]):
            w = _starts(parts)
            number, place = _owners(w, parts)
            own = run_anchors(window_hashes(codes, (BASE,))[BASE])[w] - w + place + begin[number] == anchor[number]
            w, number, place = w[own], number[own], place[own]
            x, y = (window_hashes(codes, (MIN_SPAN,), seed)[MIN_SPAN][w].astype(np.int64) for seed in (1, 4))
            yield pd.DataFrame({"record": records[number], "at": (place + begin[number]).astype(np.int32), "x": x, "y": y})


def _double_rows(size: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            records, length = batch["record"].to_numpy(), np.array([len(x) for x in batch["text"]], np.int64)
            for codes, row, begin, at in _together(batch):
                fits = at + size <= length[row]
                x, y = hash_windows(codes, (begin + at)[fits], size)
                yield pd.DataFrame({"record": records[row[fits]], "at": at[fits].astype(np.int32), "x": x, "y": y})

    return run


def text_classes(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, record) of the records long enough to share a span: record is the least id with the same text."""
    long = documents.where(F.length(F.col(text)) >= MIN_SPAN).select(F.col(key).alias("id"), F.md5(F.col(text)).alias("text_key"), F.length(F.col(text)).alias("chars"))
    least = long.groupBy("text_key", "chars").agg(F.min("id").alias("record"))
    return as_table(long.join(least, ["text_key", "chars"]).select("id", "record", "chars").distinct(), "text-classes")


def _texts(documents: DataFrame, classes: DataFrame, key: str, text: str) -> DataFrame:
    """(record, text): one member of each class of equal texts."""
    # copies are few beside the texts: taking them out leaves the texts where they are, unless there are many
    copies = as_table(classes.where("id <> record").select(F.col("id").alias("copy")), "copies")
    texts = documents.where(F.length(F.col(text)) >= MIN_SPAN).select(F.col(key).alias("record"), F.col(text).alias("text"))
    return texts.join(copies, texts["record"] == copies["copy"], "left_anti")


def living_anchors(texts: DataFrame) -> DataFrame:
    """(record, at, g): the anchors whose windows stand in two records at every level below MIN_SPAN, as a table; g is the hash of the last."""
    kind = texts.schema["record"].dataType.simpleString()
    schema = f"record {kind}, at int, " + ", ".join(f"h{i} long" for i in range(LEVELS))
    alive = as_table(texts.mapInPandas(_anchor_rows, schema), "windows", tuple(f"h{i}" for i in range(LEVELS)))
    for level in range(LEVELS):  # windows that stand in one record only end here; the others double
        h = f"h{level}"
        twice = alive.groupBy(h).agg(F.min("record").alias("a"), F.max("record").alias("b")).where("a < b").select(h)
        last = level == LEVELS - 1
        alive = as_table(alive.join(twice, h, "left_semi").select("record", "at", *[f"h{i}" for i in range(level + (not last), LEVELS)]), "windows")
    return alive.withColumnRenamed(f"h{LEVELS - 1}", "g")


def _with_texts(texts: DataFrame, alive: DataFrame, *also: str) -> DataFrame:
    """(record, text, alive, ...): the texts that have living anchors, with these."""
    lists = alive.groupBy("record").agg(F.collect_list(F.struct("at", *also)).alias("s"))
    return texts.join(lists, "record").select("record", "text", F.col("s.at").alias("alive"), *[F.col(f"s.{c}").alias("groups") for c in also])


def side_windows(texts: DataFrame, alive: DataFrame) -> DataFrame:
    """(record, anchor, g, x0, y0, x1, y1, start, context): the two windows of MIN_SPAN characters at each living anchor, as a table."""
    kind = texts.schema["record"].dataType.simpleString()
    schema = f"record {kind}, anchor int, g long, x0 long, y0 long, x1 long, y1 long, start int, context string"
    return as_table(_with_texts(texts, alive, "g").mapInPandas(_side_rows, schema), "sides", ("x0", "y0", "x1", "y1", "context"))


def _both_sides(sides: DataFrame) -> DataFrame:
    """(record, at, x, y) of the windows on both sides."""
    one = lambda n, at: sides.where(f"x{n} is not null").select("record", at.cast("int").alias("at"), F.col(f"x{n}").alias("x"), F.col(f"y{n}").alias("y"))
    return one(0, F.col("anchor")).unionByName(one(1, F.col("anchor") - BACK))


def _windows_between(sides: DataFrame, groups: DataFrame) -> DataFrame:
    """(record, at, x, y): the windows between the two sides of the anchors in ``groups`` (g), as a table."""
    kind = sides.schema["record"].dataType.simpleString()
    wanted = sides.join(groups, "g", "left_semi").select("record", "anchor", "start", "context")
    return as_table(wanted.mapInPandas(_between_rows, f"record {kind}, at int, x long, y long"), "between", ("x", "y"))


def _disagreeing(sides: DataFrame) -> DataFrame:
    """(g): the anchors whose records differ in the window on either side; a record whose text ends there differs from all."""
    lone = F.xxhash64("record", "anchor")
    told = sides.select("g", F.coalesce("x0", lone).alias("x0"), F.coalesce("x1", lone).alias("x1"))
    return told.groupBy("g").agg(*[f(x).alias(f"{n}_{x}") for x in ("x0", "x1") for n, f in (("min", F.min), ("max", F.max))]).where("min_x0 < max_x0 and min_x1 < max_x1").select("g")


def _holders(windows: DataFrame) -> DataFrame:
    """(x, y, holders, n) of the windows that stand in two records: the sum of the records' hashes, and their number.

    windows: (record, x, y); a record that comes twice with a window counts twice in both, which only
    sets such windows apart from others of the same records.
    """
    one = F.xxhash64("record").cast("decimal(20,0)")
    counted = windows.groupBy("x", "y").agg(F.sum(one).alias("holders"), F.count(F.lit(1)).alias("n"), F.min("record").alias("a"), F.max("record").alias("b"))
    return counted.where("a < b").select("x", "y", "holders", "n")


def span_pairs(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id_a, doc_id_b): every two records that share a span of MIN_SPAN characters, a < b.

    Null and shorter texts share nothing; records with equal texts share them whole. Rows with a
    repeated key count as one record.
    """
    classes = text_classes(documents, key, text)
    texts = _texts(documents, classes, key, text)
    alive = living_anchors(texts)
    sides = side_windows(texts, alive)
    between = _windows_between(sides, as_table(_disagreeing(sides), "disagreeing"))
    windows = _both_sides(sides).select("x", "y", "record").unionByName(between.select("x", "y", "record"))
    # one window stands for all that the same records hold
    chosen = as_table(_holders(windows).groupBy("holders", "n").agg(F.min(F.struct("x", "y")).alias("w")).select("w.x", "w.y"), "chosen")
    groups = as_table(windows.join(chosen, ["x", "y"], "left_semi").select("x", "y", "record"), "span-groups")
    pairs = groups.alias("p").join(groups.alias("q"), ["x", "y"]).where("p.record < q.record").select(F.col("p.record").alias("r"), F.col("q.record").alias("s")).distinct()
    one, two = classes.select(F.col("record").alias("r"), F.col("id").alias("i")), classes.select(F.col("record").alias("s"), F.col("id").alias("j"))
    between = pairs.join(one, "r").join(two, "s").select(F.least("i", "j").alias("doc_id_a"), F.greatest("i", "j").alias("doc_id_b"))
    within = classes.alias("p").join(classes.alias("q"), "record").where("p.id < q.id").select(F.col("p.id").alias("doc_id_a"), F.col("q.id").alias("doc_id_b"))
    return between.unionByName(within).where("doc_id_a < doc_id_b").distinct()


def _repeated(texts: DataFrame, alive: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(repeated, sides). repeated: (record, at, n), as a table, windows that stand in n > 1 records; together they cover all that is shared.

    A window between the two sides of an anchor only adds to them where one of the anchor's records is
    not covered by its sides' windows all around; only these anchors are looked at more closely.
    """
    sides = side_windows(texts, alive)
    both = _both_sides(sides)
    held = both.select("x", "y", "record").distinct().transform(_holders).select("x", "y", "n")
    plain = as_table(both.join(held, ["x", "y"]).select("record", "at", "n"), "repeated-sides")
    around = lambda: Window.partitionBy("record").orderBy("at")
    starts = plain.select("record", "at").distinct().withColumn("new", (F.col("at") > F.coalesce(F.lag("at").over(around()), F.lit(-MIN_SPAN - 1)) + MIN_SPAN).cast("int"))
    regions = starts.withColumn("region", F.sum("new").over(around())).groupBy("record", "region").agg(F.min("at").alias("x1"), (F.max("at") + MIN_SPAN).alias("x2")).drop("region")
    inside = alive.join(regions, "record").where(F.col("at") - BACK >= F.col("x1")).where(F.col("at") + MIN_SPAN <= F.col("x2")).select("record", "at")
    edges = as_table(alive.join(inside, ["record", "at"], "left_anti").select("g").distinct(), "edges")
    between = _windows_between(sides, edges)
    more = between.select("x", "y", "record").distinct().transform(_holders).select("x", "y", "n")
    finer = between.join(more, ["x", "y"]).select("record", "at", "n")
    return as_table(plain.unionByName(finer).groupBy("record", "at").agg(F.max("n").alias("n")), "repeated"), sides


def shared_amounts(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, chars, shared_chars, shared_share): how much of each record stands in another one, a row for each record.

    Null text: null chars and nothing shared. Rows with a repeated key should have the same text;
    they are reported as often as they come.
    """
    classes = text_classes(documents, key, text)
    texts = _texts(documents, classes, key, text)
    repeated, _ = _repeated(texts, living_anchors(texts))
    following = F.lead("at").over(Window.partitionBy("record").orderBy("at"))
    covered = repeated.select("record", F.least(F.lit(MIN_SPAN), F.coalesce(following - F.col("at"), F.lit(MIN_SPAN))).alias("c")).groupBy("record").agg(F.sum("c").alias("covered"))
    copies = classes.groupBy("record").agg(F.count(F.lit(1)).alias("copies"))
    known = classes.join(copies, "record").join(covered, "record", "left").select("id", F.when(F.col("copies") > 1, F.col("chars")).otherwise(F.coalesce("covered", F.lit(0))).cast("long").alias("shared"))
    base = documents.select(F.col(key).alias("doc_id"), F.length(F.col(text)).cast("long").alias("chars"))
    joined = base.join(known.dropDuplicates(["id"]), base["doc_id"] == known["id"], "left")
    shared = F.coalesce("shared", F.lit(0)).cast("long")
    return joined.select("doc_id", "chars", shared.alias("shared_chars"), F.when(F.col("chars") > 0, F.round(shared / F.col("chars"), 6)).otherwise(F.lit(0.0)).alias("shared_share"))


def doubled(texts: DataFrame, repeated_sides: DataFrame) -> DataFrame:
    """(record, at, longest): for each anchor whose window of MIN_SPAN characters stands in two records, the greatest doubling of it that still does.

    Windows repeated at one length alone are extended to twice that length, until none survives; the
    number of rounds is the logarithm of the longest shared span.
    """
    kind = texts.schema["record"].dataType.simpleString()
    alive, size, levels = as_table(repeated_sides.select("record", "at").distinct(), "doubling"), MIN_SPAN, []
    while not alive.isEmpty():
        levels.append(alive.withColumn("longest", F.lit(size)))
        size *= 2
        windows = as_table(_with_texts(texts, alive).mapInPandas(_double_rows(size), f"record {kind}, at int, x long, y long"), "doubling", ("x", "y"))
        twice = windows.groupBy("x", "y").agg(F.min("record").alias("a"), F.max("record").alias("b")).where("a < b").select("x", "y")
        alive = as_table(windows.join(twice, ["x", "y"], "left_semi").select("record", "at"), "doubling")
    if not levels:
        return alive.withColumn("longest", F.lit(size))
    return reduce(DataFrame.unionByName, levels).groupBy("record", "at").agg(F.max("longest").alias("longest"))


def spans(documents: DataFrame, key: str = "doc_id", text: str = "text", doubling: bool = True) -> DataFrame:
    """(doc_id, start, length, longest, holders): the maximal spans of each record that are shared, character by character.

    start counts from 1. A span is made of windows of MIN_SPAN characters that stand in other records
    and touch each other; longest is the greatest doubling of MIN_SPAN that one other record holds
    whole from one of its anchors on, 0 if the span has none; holders the number of different texts
    that hold the most common window. Records whose whole text others repeat are one span of all of it.
    Without ``doubling`` longest is not looked for, and is 0.
    """
    classes = text_classes(documents, key, text)
    texts = _texts(documents, classes, key, text)
    repeated, sides = _repeated(texts, living_anchors(texts))
    around = Window.partitionBy("record").orderBy("at")
    marked = repeated.withColumn("new", (F.col("at") > F.coalesce(F.lag("at").over(around), F.lit(-MIN_SPAN - 1)) + MIN_SPAN).cast("int"))
    regions = marked.withColumn("region", F.sum("new").over(around)).groupBy("record", "region").agg(F.min("at").alias("first"), F.max("at").alias("last"), F.max("n").alias("holders"))
    right = sides.where("x0 is not null").select("record", F.col("anchor").alias("at"), F.col("x0").alias("x"), F.col("y0").alias("y"))
    twice = right.groupBy("x", "y").agg(F.min("record").alias("a"), F.max("record").alias("b")).where("a < b").select("x", "y")
    found = right.join(twice, ["x", "y"], "left_semi")
    long = doubled(texts, found) if doubling else found.select("record", "at", F.lit(0).alias("longest"))
    inside = regions.join(long, "record", "left").groupBy("record", "region", "first", "last", "holders").agg(F.max(F.when(F.col("at").between(F.col("first"), F.col("last")), F.col("longest"))).alias("longest"))
    parts = inside.select("record", (F.col("first") + 1).alias("start"), (F.col("last") - F.col("first") + MIN_SPAN).alias("length"), F.coalesce("longest", F.lit(0)).alias("longest"), "holders")
    copies = classes.groupBy("record").agg(F.count(F.lit(1)).alias("copies"))
    owners = classes.join(copies, "record")
    own = owners.where("copies = 1").join(parts, "record").select(F.col("id").alias("doc_id"), "start", "length", "longest", F.col("holders").cast("long").alias("holders"))
    size = F.col("chars").cast("int")
    doublings = F.floor(F.log2(F.col("chars") / MIN_SPAN)).cast("int")
    whole = owners.where("copies > 1").select(F.col("id").alias("doc_id"), F.lit(1).alias("start"), size.alias("length"), (F.lit(MIN_SPAN) * F.pow(F.lit(2), doublings) if doubling else F.lit(0)).cast("int").alias("longest"), F.lit(1).cast("long").alias("holders"))
    return own.unionByName(whole).distinct()
