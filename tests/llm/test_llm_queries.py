import re
from collections import defaultdict

import pytest

from quillgrid.llm.oracles import ORACLES
from quillgrid.llm.queries import QUERIES
from quillgrid.llm.residue import has_placeholder
from quillgrid.llm.template_residue import is_residue
from quillgrid.llm.tokenize import encoding
from tests.check import connect, same_rows
from tests.llm.test_documents import brute_spans, fill

COLUMNS = {
    "p1_found": ["article_id_a", "article_id_b"], "p2_found": ["article_id", "line_no"], "p4_found": ["entity_id_a", "entity_id_b"], "p5_found": ["article_id", "field_name"], "p6_found": ["article_id", "line_no"], "p7_ids": ["doc_id", "ids"], "p9_found": ["doc_id_a", "doc_id_b"],
}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, data, name):
    same_rows(QUERIES[name](spark, data), connect(data), ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_runs(spark, data, name):
    df = QUERIES[name](spark, data)
    assert df.count() > 0 and df.columns == COLUMNS.get(name, df.columns)


@pytest.fixture(scope="module")
def found(spark, data):
    """The rows of a query, run once."""
    kept = {}

    def get(name):
        if name not in kept:
            kept[name] = QUERIES[name](spark, data).collect()
        return kept[name]

    return get


@pytest.fixture(scope="module")
def read(spark, data):
    return lambda name: spark.read.parquet(f"{data}/{name}.parquet").collect()


def classes_of(pairs):
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in pairs:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    return {x: root(x) for x in list(parent)}


def test_stories_equal_brute_force(found):
    """Every two bodies, by the definition."""
    grams = {}
    for r in found("p6_body"):
        w = re.findall(r"[^\W_]+", (r.body or "").lower())
        if len(w) >= 60:
            grams[r.article_id] = set(zip(w, w[1:], w[2:]))
    want = {(a, b) for a in grams for b in grams if a < b and len(grams[a] & grams[b]) >= 0.6 * len(grams[a] | grams[b])}
    assert {tuple(r) for r in found("p1_found")} == want and want
    classes = classes_of(want)
    assert {r.article_id: r.group_id for r in found("p1_groups")} == {i: classes.get(i, i) for i in grams}
    sizes = {r.article_id: r.members for r in found("p1_groups")}
    assert all(sizes[i] == sum(classes.get(j, j) == classes.get(i, i) for j in grams) for i in grams)


def test_bodies_and_lines_agree(found, read):
    gone = {(r.article_id, r.line_no) for r in found("p6_found")}
    text = {r.id: r.raw_markdown for r in read("articles")}
    assert len(gone) == len(found("p6_found")) and all(text[i].split("\n")[n - 1].strip() for i, n in gone)
    want = {i: None if t is None else "\n".join(x for n, x in enumerate(t.split("\n"), 1) if (i, n) not in gone) for i, t in text.items()}
    assert {r.article_id: r.body for r in found("p6_body")} == want


def test_residue_holds_all_that_detectors_see(found, read):
    rows = {tuple(r) for r in found("p5_found")}
    assert {(r.id, "analysis_notes") for r in read("articles") if is_residue(r.analysis_notes)} == {x for x in rows if x[1] == "analysis_notes"}
    assert {(r.id, "raw_markdown") for r in read("articles") if has_placeholder(r.raw_markdown or "")} <= rows


def test_names_agree(found, read):
    members = defaultdict(set)
    for r in found("p4_classes"):
        members[r.class_key].add(r.entity_id)
    assert {(a, b) for v in members.values() for a in v for b in v if a < b} == {tuple(r) for r in found("p4_found")}
    assert len(found("p4_classes")) == len({r.id for r in read("entities") if (r.name or "").strip() and (r.entity_type or "").strip()})


def test_ids_and_mixture_equal_the_tokenizer(found, read):
    enc, _ = encoding()
    docs = {r.doc_id: r for r in read("documents")}
    whole = {i: enc.encode_ordinary(r.text) if r.text else [] for i, r in docs.items()}
    assert {r.doc_id: r.ids for r in found("p7_ids")} == whole and len(found("p7_ids")) == len(docs)
    targets = {r.source: r for r in read("mixture_targets")}
    have = {s: sum(len(whole[i]) for i, r in docs.items() if r.source == s) for s in targets}
    due = fill([(s, r.target_share, have[s], r.max_repeats) for s, r in targets.items()], sum(have.values()))
    chosen, shares = found("p8_mixture"), {r.source: r for r in found("p8_shares")}
    assert all(r.tokens == len(whole[r.doc_id]) and docs[r.doc_id].source == r.source and 1 <= r.copies <= targets[r.source].max_repeats for r in chosen)
    for s in targets:
        mixed = sum(r.tokens * r.copies for r in chosen if r.source == s)
        assert shares[s].mixed_tokens == mixed and abs(mixed - due[s]) <= max([len(whole[i]) for i, r in docs.items() if r.source == s], default=0)
        copies = {i: 0 for i, r in docs.items() if r.source == s and whole[i]} | {r.doc_id: r.copies for r in chosen if r.source == s}
        assert not copies or max(copies.values()) - min(copies.values()) <= 1
    assert abs(sum(r.actual_share for r in shares.values()) - 1) < 1e-9


def test_spans_equal_brute_force(found, read):
    docs = sorted(read("documents"), key=lambda r: r.doc_id)
    want = {(docs[i].doc_id, start, length) for i, start, length in brute_spans([r.text for r in docs])}
    assert {(r.doc_id, r.start, r.length) for r in found("p9_spans")} == want
    assert all(r.longest <= r.length and r.holders >= 1 for r in found("p9_spans"))


def test_nothing_outside_imports_this_package():
    from pathlib import Path

    root = Path(__file__).resolve().parents[2] / "quillgrid"
    assert [p for p in root.rglob("*.py") if "llm" not in p.relative_to(root).parts and "quillgrid.llm" in p.read_text()] == []
