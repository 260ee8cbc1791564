"""Problem 4 on its rules, against brute force, and on odd input."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from quillgrid.llm.names import Parser, edit_distance, edits_of, kindred, learned_kinds, same_entity_pairs, segment_keys, similar_cores

FORMS = [("Bob", "Robert", "given_name"), ("Labs", "Laboratories", "field_word"), ("Bio Sciences", "Biosciences", "field_word"), ("Tech", "Technologies", "field_word"), ("Genom.", "Genomics", "field_word"), (None, None, None)]
FULL = FORMS + [(x, x, "field_word") for x in ("Therapeutics", "Diagnostics", "International", "Pharmaceuticals")]


def true_distance(a, b):
    seen, n, m = {}, len(a), len(b)
    big = n + m
    d = [[big] * (m + 2) for _ in range(n + 2)]
    for i in range(n + 1):
        d[i + 1][1] = i
    for j in range(m + 1):
        d[1][j + 1] = j
    for i in range(1, n + 1):
        last = 0
        for j in range(1, m + 1):
            k, h, cost = seen.get(b[j - 1], 0), last, 1
            if a[i - 1] == b[j - 1]:
                cost, last = 0, j
            d[i + 1][j + 1] = min(d[i][j] + cost, d[i + 1][j] + 1, d[i][j + 1] + 1, d[k][h] + i - k - 1 + 1 + j - h - 1)
        seen[a[i - 1]] = i
    return d[n + 1][m + 1]


def typo(rng, s, alphabet="abcdefgh"):
    i, kind = rng.randrange(len(s)), rng.randrange(4)
    if kind == 0:
        return s[:i] + rng.choice(alphabet) + s[i:]
    if kind == 1:
        return s[:i] + s[i + 1 :]
    if kind == 2:
        return s[:i] + rng.choice(alphabet) + s[i + 1 :]
    return s[:i] + s[i + 1 : i + 2] + s[i : i + 1] + s[i + 2 :]


def test_edit_distance():
    rng = random.Random(1)
    for _ in range(4000):
        a = "".join(rng.choices("abc", k=rng.randrange(9)))
        b = a
        for _ in range(rng.randrange(4)):
            b = typo(rng, b or "a", "abc")
        for k in (0, 1, 2):
            assert edit_distance(a, b, k) == min(true_distance(a, b), k + 1)


def allowed(length):
    return edits_of(length, (10, 6))


def test_segments_miss_nothing():
    """Each two names within the allowed edits share a key of the index."""
    rng = random.Random(2)
    for _ in range(3000):
        a = "".join(rng.choices("abcdefgh", k=rng.randrange(6, 24)))
        b = a
        for _ in range(rng.randrange(1, 3)):
            b = typo(rng, b)
        short, long = sorted((a, b), key=lambda x: (len(x), x))
        if a != b and allowed(len(short)) and edit_distance(a, b, 2) <= allowed(len(short)):
            assert segment_keys("b", short, (10, 6), False) & segment_keys("b", long, (10, 6), True), (a, b)


SAME = [
    ("company", "Pangan Melquilo Technologies", ["PANGAN MELQUILO TECHNOLOGIES.", "Pangan Melquilo Technologies B.V.", "Pangan Melquilo Technologies, PLC", "PanganMelquilo Tech", "Technologies, Pangan Melquilo", "The Pangan Melquilo Technologies Group", "Pangan Melquilo Technologies (PMT)", "Tech. Pangan Melquilo", "Pangan Melquilo Ltd (Technologies)", "Pángan Melnuilo Technology"]),
    ("company", "University of Zumbrix Hanyiklel", ["Zumbrix Hanyiklel University", "U of Zumbrix Hanyiklel", "Univ. Zumbrix Hanyiklel", "The University of Zumbrix-Hanyiklel"]),
    ("company", "Rumbi Klixce Biosciences", ["Rumbi Klixce Bio Sciences", "Rumbi Klixce Bio-Sciences"]),
    ("person", "Robert Brixstix-Vlorvul", ["Bob Brixstix-Vlorvul", "R. Brixstix-Vlorvul", "Brixstix-Vlorvul, Robert", "BRIXSTIX-VLORVUL Robert", "Dr. Robert B. Brixstix-Vlorvul, PhD", "robert brixstix-vlorvul", "Robret Brxistix-Vlorvul", "R.W. Brixstix-Vlorvul"]),
    ("drug", "KCX-9914", ["kcx-9914", "KCX9914", "KCX–9914", "(KCX-9914)", "K.CX-9914", "KCX_9914", "KCX-9914®"]),
    ("drug", "XMG-5217", ["X.MG-5217", "xmg 5217 tablets", "XMG5217 SC"]),
    ("drug", "Drepracivamelmab", ["Drepracivaemlmab tablets", "DREPRACIVAMELMAB", "Drepracivamelmab (biosimilar-free)", "Drepracivamelmab 300 mg"]),
    ("technology", "Prate Trelkivci base editing platform", ["base editing platform (Prate Trelkivci)", "Prate Trelkivci BE platform", "Prate-Trelkivci base-editor platform", "Prate Trelkivci's base editing platform"]),
    ("deal", "Jummor-Yinello collaboration", ["Jummor & Yinello collab", "Yinello/Jummor partnership", "JUMMOR-YINELLO collaboration"]),
]
OTHERS = [
    ("company", "Pangan Melquilo Genomics"), ("company", "Zumbrix Hanyiklel Diagnostics"), ("person", "Thomas Brixstix-Vlorvul"), ("person", "T. Brixstix-Vlorvul"), ("drug", "KCX-9915"), ("drug", "KDX-9914"), ("technology", "Prate Trelkivci antibody drug conjugate"), ("deal", "Jummor-Yinello merger"), ("company", "Jummor-Yinello collaboration"),
]


#: Names that show what the kinds of technologies are.
KINDS = [f"{a}{b}or {b}{a}ex {kind}" for kind in ("base editing platform", "antibody drug conjugate", "lipid nanoparticle system") for a in ("zum", "rix", "kel", "tov") for b in ("bal", "fid", "gon")]


def test_kinds_are_learned(spark):
    names = KINDS + ["Prate Trelkivci ADC", "Prate Trelkivci LNP", "Base editing platform (Moss Hale)", None, ""]
    df = spark.createDataFrame([(n, " Technology ") for n in names] + [("base editing platform", "drug")], "name string, entity_type string")
    kinds = learned_kinds(df, "technology")
    assert sorted(map(" ".join, kinds)) == ["antibody drug conjugate", "base editing platform", "lipid nanoparticle system"]
    assert learned_kinds(df.limit(3), "technology") == [] and learned_kinds(df.limit(0), "technology") == []
    assert all(kindred(w, ["lipid", "nanoparticle", "system"]) for w in ("lipid", "lnp", "nano", "particles", "sytem", "lnps"))
    assert all(kindred(w, ["antibody", "drug", "conjugate"]) for w in ("adc", "adcs", "conjugates", "antib")) and kindred("be", ["base", "editing"]) and kindred("editor", ["base", "editing"])
    assert not any(kindred(w, ["base", "editing", "platform"]) for w in ("prate", "adc", "lnp", "bp", "ba", "e", "forma"))


def test_pet_names_are_learned(spark):
    rows = [(f"{f}-{g}", f"{g} {f}ov-{f}ax") for f in ("brum", "klix", "zond") for g in ("Francisco", "Paco")]
    rows += [("x-1", "Francisco Helm-Oster"), ("x-2", "Paco Helm-Oster"), ("x-3", "Thomas Helm-Oster"), ("y-1", "Thomas Wix-Yale"), ("y-2", "Paco Wix-Yale"), ("z-1", "Dorothea Quell-Rast"), ("z-2", "Dora Quell-Rast"), ("z-3", "Zach Quell-Rast"), ("z-4", "Zachary Quell-Rast")]
    df = spark.createDataFrame(rows, "id string, name string").withColumn("entity_type", F.lit("person"))
    forms = spark.createDataFrame(FULL, "short_form string, full_form string, form_kind string")
    want = {(f"{f}-Francisco", f"{f}-Paco") for f in ("brum", "klix", "zond")} | {("x-1", "x-2"), ("z-1", "z-2"), ("z-3", "z-4")}
    assert {tuple(r) for r in same_entity_pairs(df, forms).collect()} == want


def test_variants(spark):
    rows, want = [], set()
    rows += [(f"k{i:02d}", n, "technology", "clash", "clash", "clash") for i, n in enumerate(KINDS)]
    for g, (kind, name, variants) in enumerate(SAME):
        ids = []
        for n, v in enumerate([name, *variants]):
            ids.append(f"{g}-{n:02d}")
            rows.append((ids[-1], v, [kind, kind.upper(), f" {kind} "][n % 3], "clash", "clash", "clash"))
        want |= set(itertools.combinations(sorted(ids), 2))
    rows += [(f"o{i}", n, k, "clash", "clash", "clash") for i, (k, n) in enumerate(OTHERS)]
    want.add(("o2", "o3"))  # the initial has one person to fit
    rows += [("n1", None, "company", None, None, None), ("n2", "x", None, None, None, None), ("n3", "  ", "drug", None, None, None), ("n4", "???", "deal", None, None, None), ("n5", "???", "deal", None, None, None), ("n6", "y" * 5000, "person", None, None, None), ("n7", "Odd kind", "planet", None, None, None), ("n8", "ODD-KIND", "planet", None, None, None)]
    want |= {("n4", "n5"), ("n7", "n8")}
    df = spark.createDataFrame(rows, "id string, name string, entity_type string, core string, block string, class string")
    forms = spark.createDataFrame(FULL, "short_form string, full_form string, form_kind string")
    got = {tuple(r) for r in same_entity_pairs(df, forms).collect()}
    assert got == want
    assert same_entity_pairs(df.limit(0), forms).count() == 0
    assert ("0-00", "0-01") in {tuple(r) for r in same_entity_pairs(df, forms.limit(0)).collect()}


def test_ambiguous_initial_joins_nobody(spark):
    df = spark.createDataFrame([("1", "Robert Abbott-Quux"), ("2", "Rebecca Abbott-Quux"), ("3", "R. Abbott-Quux"), ("4", "Abbott-Quux, R.")], "id string, name string").withColumn("entity_type", F.lit("person"))
    forms = spark.createDataFrame(FULL, "short_form string, full_form string, form_kind string")
    assert {tuple(r) for r in same_entity_pairs(df, forms).collect()} == {("3", "4")}


def test_similar_cores_against_brute_force(spark):
    rng = random.Random(3)
    cores = {"".join(rng.choices("abcdefgh", k=rng.randrange(3, 18))) for _ in range(60)}
    for c in list(cores):
        for _ in range(3):
            v = c
            for _ in range(rng.randrange(1, 4)):
                v = typo(rng, v) or "a"
            cores.add(v)
    rows = [(rng.choice("xy"), c) for c in sorted(cores)]
    block = dict((c, b) for b, c in rows)
    want = {(a, b) for a, b in itertools.combinations(sorted(cores), 2) if block[a] == block[b] and edit_distance(a, b, 2) <= allowed(min(len(a), len(b)))}
    got = {tuple(sorted((r.core_a, r.core_b))) for r in similar_cores(spark.createDataFrame(rows, "block string, core string")).collect()}
    assert got == want


@pytest.mark.parametrize("kind", ["company", "person", "drug", "technology", "deal", "planet"])
@pytest.mark.parametrize("name", ["", "-", "(", "a", ",", "Dr.", "Ltd", "of", "u of", "'s", "1", "é" * 1000])
def test_parser_takes_anything(kind, name):
    assert all(len(x) == 3 for x in Parser(FULL).parse(kind, name))
