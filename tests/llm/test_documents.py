"""Problems 7, 8 and 9 against whole-text encoding, arithmetic and brute force."""

import random
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quillgrid.llm.mixture import mixture, water_level
from quillgrid.llm.shared_spans import BASE, LEVELS, MIN_SPAN, RUN, run_anchors, shared_amounts, span_pairs, spans, window_hashes
from quillgrid.llm.tokenize import RANKS, chunks, corpus_ids, cuts, encoding, join_chunks, settle

SCHEMA = "doc_id long, text string, source string, record string, n int, at int, h0 long, ids string, part string"


def documents(spark, texts, source="s"):
    return spark.createDataFrame([(i, t, source if isinstance(source, str) else source[i], "clash", 1, 2, 3, "clash", "clash") for i, t in enumerate(texts)], SCHEMA)


ODD = ["", " ", "a", "don't  stop\n\n\tnow ", "它是一个测试。" * 200, "😀👩‍👩‍👧" * 150, "a" * 4000, " " * 3000, "ab " * 2000, "x y z" * 300, "'s't're" * 400, "1234567890" * 300, "퟿" * 100, "né é" * 300]


def text_of(rng, n):
    return " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyzäß", k=rng.randrange(1, 9))) for _ in range(n))


def test_chunks_are_content_defined():
    rng = random.Random(1)
    shared = text_of(rng, 2000)
    a, b = chunks(text_of(rng, 50) + shared), chunks(text_of(rng, 77) + shared)
    assert "".join(a).endswith(shared) and len(set(a) & set(b)) >= len(a) - 3 and len(a) > 5


@pytest.mark.parametrize("text", ODD)
def test_joined_chunks_equal_whole(text):
    enc, _ = encoding(RANKS)
    for every in (3, 17, 512):
        at = [0, *cuts(text, 16, every), len(text)]
        parts = [text[x:y] for x, y in zip(at, at[1:])]
        assert join_chunks([settle(p) for p in parts]).tolist() == enc.encode_ordinary(text)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.characters(codec="utf-8"), min_size=1, max_size=120), st.lists(st.integers(1, 119), max_size=6))
def test_any_cut_is_repaired(text, at):
    enc, _ = encoding(RANKS)
    at = [0, *sorted({x for x in at if x < len(text)}), len(text)]
    parts = [text[x:y] for x, y in zip(at, at[1:])]
    assert join_chunks([settle(p) for p in parts]).tolist() == enc.encode_ordinary(text)


def test_corpus_ids(spark):
    rng = random.Random(2)
    base = text_of(rng, 900)
    texts = [*ODD, None, base, base, "x " + base, base + text_of(rng, 300), text_of(rng, 60_000)]
    enc, _ = encoding(RANKS)
    got = {r.doc_id: r.ids for r in corpus_ids(documents(spark, texts)).collect()}
    assert got == {i: enc.encode_ordinary(t) if t else [] for i, t in enumerate(texts)}
    assert corpus_ids(documents(spark, texts).limit(0)).count() == 0
    twice = documents(spark, texts).unionByName(documents(spark, texts))
    assert sorted((r.doc_id, r.ids) for r in corpus_ids(twice).collect()) == sorted(got.items())


def test_other_vocabulary(spark):
    other = RANKS.replace("byte_bpe_50k", "byte_bpe_multi_50k")
    enc, _ = encoding(other)
    texts = ["Grüße an alle", None]
    assert {r.doc_id: r.ids for r in corpus_ids(documents(spark, texts), ranks=other).collect()} == {0: enc.encode_ordinary(texts[0]), 1: []}


def test_anchors_of_runs():
    rng = random.Random(3)
    for _ in range(200):
        n = rng.randrange(1, 400)
        h = np.array([rng.randrange(50) for _ in range(n)], np.uint64)
        at = run_anchors(h, 16)
        assert len(at) == max(0, n - 15)
        for s in range(n - 15):
            assert s + 15 - int(np.argmin(h[s : s + 16][::-1])) == at[s]
    codes = np.arange(500, dtype=np.uint32)
    # the run of anchors at the start of a span, and the doubled window at its anchor, lie inside the span
    assert RUN - 1 + (BASE << (LEVELS - 1)) <= MIN_SPAN and RUN - 1 + BASE <= MIN_SPAN
    assert len(window_hashes(codes, (200,))[200]) == 301 and len(window_hashes(codes[:50], (200,))[200]) == 0


def brute(texts):
    holders = defaultdict(set)
    for i, t in enumerate(texts):
        for p in range(len(t or "") - MIN_SPAN + 1):
            holders[t[p : p + MIN_SPAN]].add(i)
    pairs = {(a, b) for v in holders.values() for a in v for b in v if a < b}
    amounts = {}
    for i, t in enumerate(texts):
        c = bytearray(len(t or ""))
        for p in range(len(t or "") - MIN_SPAN + 1):
            if len(holders[t[p : p + MIN_SPAN]]) > 1:
                c[p : p + MIN_SPAN] = b"\1" * MIN_SPAN
        amounts[i] = sum(c)
    return pairs, amounts


def test_spans_against_brute_force(spark):
    rng = random.Random(4)
    passages = [text_of(rng, 200)[:n] for n in (199, 200, 201, 230, 264, 400, 900)]
    texts = [text_of(rng, rng.randrange(1, 120)) + (x := rng.choice(passages))[: rng.choice([len(x), 150])] + text_of(rng, rng.randrange(1, 60)) for _ in range(70)]
    texts += [None, "", "a" * 199, "a" * 200, "a" * 300, "ab" * 150, texts[0], texts[0], texts[1], passages[1], passages[0], "汉字" * 120, "x" + "汉字" * 120, "😀" * 210, "é" * 250, text_of(rng, 20_000), (long := text_of(rng, 9_000)) + long[:50_000]]
    pairs, amounts = brute(texts)
    got = [tuple(r) for r in span_pairs(documents(spark, texts)).collect()]
    assert len(got) == len(set(got)) and set(got) == pairs and pairs
    shared = {r.doc_id: (r.chars, r.shared_chars) for r in shared_amounts(documents(spark, texts)).collect()}
    assert shared == {i: (None if t is None else len(t), amounts[i]) for i, t in enumerate(texts)}
    assert span_pairs(documents(spark, texts).limit(0)).count() == 0
    again = [tuple(r) for r in span_pairs(documents(spark, texts).unionByName(documents(spark, texts))).collect()]
    assert sorted(again) == sorted(pairs)


def brute_spans(texts):
    """(doc, start, length): the maximal unions of touching shared windows."""
    holders = defaultdict(set)
    for i, t in enumerate(texts):
        for p in range(len(t or "") - MIN_SPAN + 1):
            holders[t[p : p + MIN_SPAN]].add(i)
    found = set()
    for i, t in enumerate(texts):
        at = [p for p in range(len(t or "") - MIN_SPAN + 1) if len(holders[t[p : p + MIN_SPAN]]) > 1]
        first = None
        for k, p in enumerate(at):
            first = p if first is None else first
            if k + 1 == len(at) or at[k + 1] > p + MIN_SPAN:
                found.add((i, first + 1, p - first + MIN_SPAN))
                first = None
    return found


def test_maximal_spans_against_brute_force(spark):
    rng = random.Random(14)
    passages = [text_of(rng, 400)[:n] for n in (200, 215, 299, 640, 1700)]
    texts = [text_of(rng, rng.randrange(20, 90)) + rng.choice(passages) + text_of(rng, rng.randrange(20, 60)) + (rng.choice(passages) if i % 3 else "") for i in range(40)]
    texts += [None, "", "a" * 199, texts[0], texts[0]]
    rows = spans(documents(spark, texts)).collect()
    got = {(r.doc_id, r.start, r.length): r for r in rows}
    copies = {i for i, t in enumerate(texts) if t and texts.count(t) > 1}
    assert len(rows) == len(got) and {k for k in got if k[0] not in copies} == {x for x in brute_spans(texts) if x[0] not in copies}
    assert {k for k in got if k[0] in copies} == {(i, 1, len(texts[i])) for i in copies}
    for (i, start, length), r in got.items():
        assert r.holders >= 1 and r.longest <= length and (r.longest == 0 or any(texts[i][p : p + r.longest] in (t or "") for p in range(start - 1, start + length - r.longest) for j, t in enumerate(texts) if j != i))
    assert max(r.longest for r in rows) >= 800
    assert spans(documents(spark, texts).limit(0)).count() == 0


def test_long_texts_are_cut_into_pieces(spark, monkeypatch):
    import quillgrid.llm.shared_spans as module

    rng = random.Random(8)
    shared = text_of(rng, 400)
    texts = [text_of(rng, 300) + shared[k * 40 : k * 40 + 700] + text_of(rng, 200) for k in range(12)]
    pairs, amounts = brute(texts)
    monkeypatch.setattr(module, "PIECE", 700)
    packed = list(module._pieces(texts))
    assert len(packed) > 12 and max(len(c) for c, _ in packed) <= 700
    pieces = module._anchor_rows
    frame = __import__("pandas").DataFrame({"record": range(12), "text": texts})
    small = {(r.record, r.at, r.h0, r.h1) for f in pieces(iter([frame])) for r in f.itertuples()}
    # each window comes once, at the anchor of its first run
    contexts = [(i, a, max(0, a - 100), t[max(0, a - 100) : a + MIN_SPAN]) for i, t in enumerate(texts) for a in {r[1] for r in small if r[0] == i}]
    frame = __import__("pandas").DataFrame(contexts, columns=["record", "anchor", "start", "context"])
    windows = [(r.record, r.at, r.x, r.y) for f in module._between_rows(iter([frame])) for r in f.itertuples()]
    assert len(windows) == len({x[:2] for x in windows}) == sum(len(t) - MIN_SPAN + 1 for t in texts)
    monkeypatch.setattr(module, "PIECE", 1 << 20)
    assert set(windows) == {(r.record, r.at, r.x, r.y) for f in module._between_rows(iter([frame])) for r in f.itertuples()}
    frame = __import__("pandas").DataFrame({"record": range(12), "text": texts})
    assert small == {(r.record, r.at, r.h0, r.h1) for f in pieces(iter([frame])) for r in f.itertuples()}
    assert {tuple(r) for r in span_pairs(documents(spark, texts)).collect()} == pairs and pairs


def fill(sources, total):
    """Water-filling step by step: clamp whatever is over its cap, spread the rest, again."""
    caps = {n: size * max(0, repeats) for n, _, size, repeats in sources}
    share = {n: s for n, s, _, _ in sources if s > 0 and caps[n] > 0}
    given, left = {n: 0.0 for n, *_ in sources}, float(total)
    while share and left > 0:
        weight = sum(share.values())
        over = [n for n, s in share.items() if left * s / weight >= caps[n]]
        if not over:
            given.update({n: left * s / weight for n, s in share.items()})
            break
        for n in over:
            given[n] = float(caps[n])
            left -= caps[n]
            del share[n]
    return given


def test_filling(spark):
    rng = random.Random(11)
    cases = [([("a", 0.5, 100, 1), ("b", 0.5, 1000, 1)], 600), ([("a", 0.6, 100, 2), ("b", 0.3, 100, 1), ("c", 0.1, 1000, 1)], 600), ([("a", 1.0, 10, 2)], 600), ([("a", 1.0, 0, 2), ("b", 0.0, 50, 1)], 600), ([("a", 0.5, 10, 1)], 0)]
    cases += [([(f"s{i}", rng.choice([0.0, 0.1, 0.3, 1.0]), rng.choice([0, 7, 50, 900]), rng.randrange(0, 4)) for i in range(9)], rng.choice([10, 500, 5000])) for _ in range(5)]
    for sources, total in cases:
        sized = spark.createDataFrame([(n, size) for n, _, size, _ in sources if size], "source string, tokens int")
        targets = spark.createDataFrame([(n, s, r) for n, s, _, r in sources], "source string, target_share double, max_repeats int")
        got = {r.source: r for r in water_level(sized, targets, total).collect()}
        want = fill(sources, total)
        assert all(abs(got[n].due - want[n]) <= 1 for n in want), (sources, total)
        assert all(r.due == r.whole * r.available + r.rest and 0 <= r.rest <= max(r.available - 1, 0) for r in got.values())
    assert water_level(sized.limit(0), targets.limit(0)).count() == 0


def test_mixture(spark):
    rng = random.Random(5)
    names = ["big", "small", "tiny", "extra", None]
    sources = [rng.choices(names, [60, 20, 3, 15, 2])[0] for _ in range(1500)]
    texts = [None if i % 97 == 0 else "" if i % 89 == 0 else text_of(rng, rng.randrange(1, 60)) for i in range(1500)]
    docs = documents(spark, texts, sources)
    targets = spark.createDataFrame([("big", 0.4, 1), ("small", 0.3, 3), ("tiny", 0.3, 2), ("absent", 0.0, 2), (None, 0.0, 1)], "source string, target_share double, max_repeats int")
    chosen, shares = mixture(docs, targets)
    rows = chosen.collect()
    enc, _ = encoding(RANKS)
    size = {i: len(enc.encode_ordinary(t or "")) for i, t in enumerate(texts)}
    caps = {"big": 1, "small": 3, "tiny": 2}
    assert all(r.tokens == size[r.doc_id] > 0 and sources[r.doc_id] == r.source and 1 <= r.copies <= caps[r.source] for r in rows) and len({r.doc_id for r in rows}) == len(rows)
    have = {n: sum(size[i] for i, s in enumerate(sources) if s == n) for n in caps}
    due = fill([("big", 0.4, have["big"], 1), ("small", 0.3, have["small"], 3), ("tiny", 0.3, have["tiny"], 2)], sum(have.values()))
    got = {r.source: r for r in shares.collect()}
    longest = max(size.values())
    for n in caps:
        assert abs(got[n].mixed_tokens - due[n]) <= longest and got[n].mixed_tokens == sum(r.tokens * r.copies for r in rows if r.source == n)
    assert got["absent"].actual_share == 0 and abs(sum(r.actual_share for r in got.values()) - 1) < 1e-9 and "extra" not in got
    copies = {s: {r.copies for r in rows if r.source == s} for s in caps}
    assert all(max(c) - min(c) <= 1 for c in copies.values())  # whole repetitions and one fractional
    again = {(r.doc_id, r.copies) for r in mixture(docs.repartition(7), targets)[0].collect()}
    assert again == {(r.doc_id, r.copies) for r in rows}
    other = {(r.doc_id, r.copies) for r in mixture(docs, targets, seed=18)[0].collect()}
    assert other != again
    empty, none = mixture(docs.limit(0), targets)
    assert empty.count() == 0 and {r.mixed_tokens for r in none.collect()} == {0}
