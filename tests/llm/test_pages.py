"""Problems 1, 2, 5 and 6 against brute force and on odd input."""

import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillgrid.llm.boilerplate import furniture_lines, main_content
from quillgrid.llm.furniture import element_hash, furniture_flags, is_form, is_response
from quillgrid.llm.near_duplicates import RADIUS, VantageTree, distances, same_story_pairs, search_counts, shingle_hashes, similar_stories, sketch, story_sketches
from quillgrid.llm.repeated_lines import LineStore, bodies, merged_store
from quillgrid.llm.residue import has_placeholder, is_filler, is_message
from quillgrid.llm.template_residue import compare, is_residue, residue_fields, slug
from quillgrid.runtime import scratch
from tests.llm.pages import articles

WORDS = "cell gene trial dose cohort assay vector payload linker antibody signal reader site phase label adult tumor marker panel viral load serum titer weekly".split()


def story(rng, n=90):
    return "# " + " ".join(rng.choices(WORDS, k=8)) + "\n\n" + ". ".join(" ".join(rng.choices(WORDS, k=9)) for _ in range(n // 9)) + "."


def test_shape_of_lines():
    furniture = [
        "By Ann Bee, staff writer for The Post", "Written by **Ann Bee**, The Post", "Ann Bee | Senior correspondent", "*Ann Bee reports for The Post*", "Aug 22", "13 min read", "Updated 9h ago", "Home > Vaccines / Rapid ble", "- [Neurology at Post](/neurology)",
        "[Skip to the story](#main)", "Related: [A b c](/cice)", "**Read next** [A b](/x)", "Advertisement", "<!-- ad slot 3 for post -->", "[Sponsored] Paid content on post", "Share this story (852)", "746 shares so far - tell your network", "Filed under: M&A, Oncology (Post)", "Tags: #a #b #c",
        "(c) 2020 Post Media. All rights reserved.", "© Post - Tous droits réservés", "Impressum | Datenschutz | Barrierefreiheit", "Get the Post morning briefing in your inbox. Enter your email to sign up.", "Ann Bee has covered oncology and funding for Post since 2010.", "tovyan27 wrote 4 hours ago: You forgot it. Reply",
    ]
    prose = [
        "By late spring, the group expects to move its data package from Toronto to Lisbon.", "| Mordax | 4.1-fold | 412 |", "- Tumor burden: 148 with A and 8,568 with B (mixed, Aarhus)", "> Readers were told that the trial had stopped.", "*Figure 6: payload at Leeds*",
        "The registers are [A](https://a.example/r) and [B](https://b.example/s).", "Visitors who accept a cookie in the study were counted.", "Three board members disagree about the plan.", "",
    ]
    assert [x for x in furniture if not (is_form(x) or any(furniture_flags([x])))] == []
    assert [x for x in prose if any(furniture_flags([x]))] == []
    assert furniture_flags(["# Title", "More stories", "- A b", "", "2. C d", "Back to prose here and now.", "* a list item"]) == [False, True, True, False, True, False, False]


def test_site_templates_need_recurrence(spark):
    rng = random.Random(1)
    rows = [{"id": f"a{i}", "source_id": "s", "raw_markdown": f"Our strange motto since {i}\n{story(rng)}\n\tOUR strange motto since {i + 1} "} for i in range(12)]
    rows += [{"id": "b0", "source_id": "t", "raw_markdown": "Our strange motto since 3\n" + story(rng)}, {"id": "n", "source_id": None}, {"id": "e", "source_id": "s", "raw_markdown": ""}, {"id": "n2"}, {"id": "z", "source_id": "s", "raw_markdown": "long " * 60_000}]
    df = articles(spark, rows)
    got = sorted((r.article_id, r.line_no) for r in furniture_lines(df).collect())
    last = {r["id"]: len(r["raw_markdown"].split("\n")) for r in rows if r["id"].startswith("a")}
    assert got == sorted([(i, 1) for i in last] + [(i, n) for i, n in last.items()])
    body = {r.page_id: r.body for r in main_content(df).collect()}
    assert body["n"] is None and body["e"] == "" and body["a3"] == rows[3]["raw_markdown"].split("\n", 1)[1].rsplit("\n", 1)[0] and len(body["z"]) == 300_000
    assert main_content(df).count() == len(rows)
    assert furniture_lines(df.limit(0)).count() == 0


def test_subtrees_and_slots(spark):
    """Without any rule of form: lists below a recurring label, links within the site, tags and breadcrumbs are slots."""
    rng = random.Random(12)
    page = lambda i: f"Trail » {i} {rng.random()}\nFurther things\n\n- {rng.random()} a\n- {rng.random()} b\n{story(rng)}\n\nNext to it [{rng.random()}](/x{i})\nMarks: #a{i} #b\nThe list of {chr(97 + i) * 5}\n- {chr(97 + i) * 4} c"
    rows = [{"id": f"a{i}", "source_id": "s", "raw_markdown": page(i)} for i in range(9)]
    rows += [{"id": f"b{i}", "source_id": "t", "raw_markdown": page(i)} for i in range(7)]
    rows += [{"id": f"m{i}", "source_id": "s", "raw_markdown": f"502 Bad Gateway\nserver {i} closed\nodd footer"} for i in range(9)]
    got = defaultdict(list)
    for r in furniture_lines(articles(spark, rows), forms=False).collect():
        got[r.article_id].append(r.line_no)
    assert set(got) == {f"a{i}" for i in range(9)}  # seven pages are no template, and a line beside a message belongs to it
    for i in range(9):
        lines = rows[i]["raw_markdown"].split("\n")
        assert [lines[n - 1][:9] for n in sorted(got[f"a{i}"])] == [lines[n][:9] for n in (0, 1, 3, 4, len(lines) - 4, len(lines) - 3)]


def test_what_is_no_slot_and_no_template(spark):
    """A comparison within a sentence is no breadcrumb, and what recurs on pages that are only a message is no template."""
    assert element_hash("responders had {x : body weight > 45} in set a") != element_hash("responders had {x : body weight > 45} in set b")
    assert element_hash("home > a / b") == element_hash("home > c") != element_hash("start > c") and element_hash("see [a](/x) #b1") == element_hash("see [c d](/y) #e")
    assert is_response(["502 Bad Gateway", "nginx"]) and not is_response(["# A title", "502 Bad Gateway"]) and not is_response(["nginx"]) and not is_response([])
    rng = random.Random(13)
    rows = [{"id": f"m{i}", "source_id": "s", "raw_markdown": f"502 Bad Gateway\n\nAdvertisement\nodd server name"} for i in range(9)]
    rows += [{"id": f"a{i}", "source_id": "s", "raw_markdown": story(rng)} for i in range(9)]
    assert {(r.article_id, r.line_no) for r in furniture_lines(articles(spark, rows)).collect()} == {(f"m{i}", 3) for i in range(9)}


def test_repeated_lines_against_brute_force(spark):
    rng = random.Random(2)
    pool = [f"Line number {k} of the house, all rights" for k in range(25)] + ["short", "x" * 19, "y" * 20]
    rows = [{"id": f"d{i}", "source_id": rng.choice(["s", "t", None]), "raw_markdown": "\r\n".join(rng.choice([x, x.upper(), "  " + x.replace(" ", " \t"), x.replace("1", "77")]) for x in rng.choices(pool, k=6)) if i % 11 else None} for i in range(120)]
    rows.append({"id": "e", "source_id": "s", "raw_markdown": ""})
    places, holders = defaultdict(set), defaultdict(set)
    for r in rows:
        for n, line in enumerate((r["raw_markdown"] or "").split("\n"), 1):
            line = re.sub(r"[ \t\r]+", " ", line).strip()
            if len(line) >= 20 and r["source_id"]:
                key = (r["source_id"], re.sub(r"\d+", "0", line.lower()))
                places[key].add((r["id"], n))
                holders[key].add(r["id"])
    want = {p for k, ps in places.items() if len(holders[k]) >= 8 for p in ps}
    df = articles(spark, rows)
    batch = F.when(F.col("id").rlike("[369]$"), 1).when(F.col("id").rlike("[147]$"), 2).when(F.col("id").rlike("[258]$"), 3)  # null counts as 0
    stores = {name: merged_store(df, by, scratch(spark, "lines")) for name, by in (("one", F.lit(5)), ("four", batch))}
    assert stores["one"].batches() == [5] and stores["four"].batches() == [0, 1, 2, 3]
    for store in stores.values():
        assert sorted(tuple(r) for r in store.repeated().collect()) == sorted(want) and want
    assert bodies(df, stores["four"].repeated()).count() == len(rows)
    whole = {r.document: r.body for r in bodies(df, stores["four"].repeated()).collect()}
    for r in rows:
        kept = None if r["raw_markdown"] is None else "\n".join(x for n, x in enumerate(r["raw_markdown"].split("\n"), 1) if (r["id"], n) not in want)
        assert whole[r["id"]] == kept
    # what each merge rebuilds is exactly what differs from the bodies before it
    number = {r["id"]: 1 if r["id"][-1] in "369" else 2 if r["id"][-1] in "147" else 3 if r["id"][-1] in "258" else 0 for r in rows}

    def bodies_upto(b):
        held = defaultdict(set)
        for k, ps in places.items():
            for i, n in ps:
                if number[i] <= b:
                    held[k].add(i)
        over = {p for k, ps in places.items() if len(held[k]) >= 8 for p in ps}
        return {r["id"]: "\n".join(x for n, x in enumerate(r["raw_markdown"].split("\n"), 1) if (r["id"], n) not in over) for r in rows if r["raw_markdown"] is not None and number[r["id"]] <= b}

    text = {r["id"]: r["raw_markdown"] for r in rows}
    before = {}
    for b in range(4):
        now = bodies_upto(b)
        changed = {i: x for i, x in now.items() if before.get(i, text[i]) != x}
        assert {r.document: r.body for r in stores["four"].rebuilt(df, b).collect()} == changed
        before = now
    empty = merged_store(df.limit(0), F.lit(1), scratch(spark, "lines"))
    assert empty.repeated().count() == 0 and empty.rebuilt(df.limit(0), empty.batches()[-1]).count() == 0


def test_new_document_loses_lines_that_crossed_before(spark):
    store = LineStore(spark, scratch(spark, "lines"))
    row = lambda i: {"id": f"n{i}", "source_id": "s", "raw_markdown": f"Story {chr(97 + i) * 3} in its own words\nThe same long line again"}
    old, new = articles(spark, [row(i) for i in range(9)]), articles(spark, [row(9)])
    store.merge(old, 1)
    store.merge(new, 2)
    assert {(r.document, r.body) for r in store.rebuilt(old.unionByName(new), 2).collect()} == {("n9", "Story jjj in its own words")}
    store.merge(new, 2)  # a merge may be run again
    assert store.batches() == [1, 2] and store.repeated().count() == 10
    with pytest.raises(ValueError):
        store.merge(new, 0)


def test_vantage_tree_finds_all_and_prunes():
    rng = np.random.default_rng(3)
    centres = rng.integers(0, 1 << 63, (40, 4), dtype=np.uint64)
    points = np.concatenate([c ^ (np.uint64(1) << rng.integers(0, 63, (20, 4)).astype(np.uint64)) for c in centres])
    for radius in (0, 6, 40, 120, 256):
        tree = VantageTree(points, radius)
        i, j = tree.pairs()
        near = distances(points[:, None, :], points[None, :, :]) <= radius
        assert sorted(zip(i.tolist(), j.tolist())) == [(int(a), int(b)) for a, b in zip(*np.nonzero(np.triu(near, 1)))]
        if radius == 40:
            assert tree.nodes and tree.excluded and tree.compared < 0.75 * len(points) ** 2
    for few in (points[:0], points[:1], np.repeat(points[:1], 9, axis=0)):
        n = len(few)
        assert len(VantageTree(few).pairs()[0]) == n * (n - 1) // 2


def test_sketches_track_similarity():
    rng = random.Random(4)
    words = [f"w{rng.randrange(5000)}" for _ in range(400)]
    near = words[:40] + [f"v{i}" for i in range(12)] + words[60:]
    a, b = shingle_hashes(words), shingle_hashes(near)
    share = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    (fa, ka), (fb, kb) = sketch(a), sketch(b)
    bits = distances(*(np.frombuffer(x, np.uint64) for x in (fa, fb)))
    assert share > 0.8 and len(fa) == 32 and bits <= RADIUS and set(ka) & set(kb)
    far = np.frombuffer(sketch(shingle_hashes([f"u{i}" for i in range(400)]))[0], np.uint64)
    assert distances(far, np.frombuffer(fa, np.uint64)) > RADIUS


def test_same_story_against_brute_force(spark):
    rng = random.Random(5)
    base = [story(rng, rng.choice([80, 120, 300])) for _ in range(40)]
    texts = list(base)
    for t in base[:25]:
        for _ in range(3):
            w = t.split(" ")
            for _ in range(rng.randrange(0, 14)):
                w[rng.randrange(len(w))] = rng.choice(WORDS)
            texts.append("Home > News / x\n" + " ".join(w) + "\nFiled under: A, B (C)")
    texts += [base[0], base[0].upper(), "# few words", "", None, base[1] + "\n" + base[2]]
    rows = [{"id": f"{i:03d}", "source_id": "s" if i % 3 else "t", "raw_markdown": t} for i, t in enumerate(texts)]

    def grams(t):
        w = re.findall(r"[^\W_]+", "\n".join(x for x, bad in zip((t or "").split("\n"), furniture_flags((t or "").split("\n"))) if not bad).lower())
        return set(zip(w, w[1:], w[2:])) if len(w) >= 60 else None

    g = {r["id"]: grams(r["raw_markdown"]) for r in rows}
    want = {(a, b) for a in g for b in g if a < b and g[a] and g[b] and len(g[a] & g[b]) >= 0.6 * len(g[a] | g[b])}
    df = articles(spark, rows)
    got = [tuple(r) for r in same_story_pairs(df).collect()]
    assert len(got) == len(set(got)) and set(got) <= want and len(want - set(got)) <= 0.001 * len(want)
    exact = [tuple(r) for r in same_story_pairs(df, exact=True).collect()]
    assert sorted(exact) == sorted(want)
    counts = search_counts(story_sketches(df)).first()
    assert counts.compared > 0 and counts.trees > 0
    assert same_story_pairs(df.limit(0)).count() == 0


def test_hot_shard_is_cut_into_blocks(spark, monkeypatch):
    import quillgrid.llm.near_duplicates as nd

    rng = random.Random(6)
    t = story(rng, 200).split(" ")
    rows = []
    for i in range(60):
        w = list(t)
        w[rng.randrange(10, len(w))] = f"odd{i}"
        rows.append({"id": f"{i:02d}", "source_id": "s", "raw_markdown": " ".join(w)})
    df = articles(spark, rows)
    whole = {tuple(sorted((bytes(r.story_a), bytes(r.story_b)))) for r in similar_stories(story_sketches(df)).collect()}
    monkeypatch.setattr(nd, "BLOCK", 7)
    hot = search_counts(story_sketches(df)).first()
    cut = {tuple(sorted((bytes(r.story_a), bytes(r.story_b)))) for r in similar_stories(story_sketches(df)).collect()}
    exact = {tuple(sorted((bytes(r.story_a), bytes(r.story_b)))) for r in similar_stories(story_sketches(df), exact=True).collect()}
    assert whole == cut == exact and len(whole) == 60 * 59 // 2 and hot.trees > 0


def test_no_pair_hangs_on_the_size_of_a_shard(spark, monkeypatch):
    import quillgrid.llm.near_duplicates as nd

    # every two of 20 stories share 80 of 120 sequences, and only one pair of min-hashes, or none
    monkeypatch.setattr(nd, "BLOCK", 7)
    schema = "story binary, fingerprint binary, bands array<long>, shingles array<int>, row long"
    for met in (True, False):
        rows = []
        for i in range(20):
            own = range((i + 1) << 20, (i + 1 << 20) + 20)
            bands = [1 << 50 if met and not k else (i * 24 + k + 1) << 51 for k in range(24)]
            rows.append((bytes([i] * 16), bytes(32), bands, [*range(80), *own], i))
        df = spark.createDataFrame(rows, schema)
        for searched in [similar_stories(df), similar_stories(df, exact=True), *[similar_stories(df, exact=False)] * met]:
            found = [(bytes(r.story_a), bytes(r.story_b)) for r in searched.collect()]
            assert len(found) == len({tuple(sorted(x)) for x in found}) == 190


RESIDUE = [
    "{{author.title}}", "Note for {% block x %}", "<%= a.summary %>", "Written on ${date}", "%%FIRST_NAME%%", "[[my-headline]]", "By __NAME__", "in {name_city}", "[INSERT NAN QUOTE]", "<vlor name here>", "[object Object]", "XX figure to come XX", "TK name TK", "TODO fill in caveat",
    "undefined", "null", "NaN", "undefined, NaN foo null, undefined", "Lorem ipsum dolor sit amet", "502 Bad Gateway", "# Error 404", "Fehler 404", "HTTP 429 from x while rendering", "Access denied (abc)", "Access to site/x was denied.", "Too many requests", "Please enable JavaScript to view the content",
    "Bitte JavaScript aktivieren (x)", "Activez les scripts de votre navigateur pour afficher x.", "You need to enable JavaScript to run this app (x).", "Checking your browser before opening x ...", "Verify you are human to go on to x", "[ ] I'm no robot", "The page /x could not be found on this server.",
    "X is down for maintenance, back shortly (y).", "TemplateError: no block named x", "Traceback: render('x') failed", "upstream x closed the connection early", "<!doctype html><title>Just a moment...</title>", "Write one optional note on <x> here", "# Oops!",
]
CLEAN = [
    "Values given as {low, high} for tumor burden.", "Responders were defined as {x : body weight > 8} in the set.", "The dose [362 per arm] was not found to change walking distance, and access to LQG was denied by payers in Graz.", "Trial of 404 people; check denominator.", "Placeholder arm received saline in Pune.",
    "A service outage in Osaka made the deck temporarily unavailable, so staff repeated the reading.", "Tool paper: browser viewer in JavaScript for antibody.", "The error rate of the cohort fell to 20 once it was replaced.", "Template strand described for patent family; low novelty.", "Paywalled after 5 paragraphs, gout section missing.",
    "Visitors who accept a cookie in the study were not found again.", "Acme rebuilt its viewer in JavaScript so that sites in Lyon can read it in a browser.", "", " ", None, "x" * 50_000,
]


@pytest.mark.parametrize("text", RESIDUE)
def test_residue(text):
    assert is_residue(text)


@pytest.mark.parametrize("text", CLEAN)
def test_no_residue(text):
    assert not is_residue(text)


def test_residue_fields(spark):
    rng = random.Random(7)
    rows = [{"id": f"ok{i}", "source_id": "s", "raw_markdown": story(rng), "title": "Cell gene trial", "url": "https://e/cell-gene-trial"} for i in range(10)]
    rows += [{"id": "bad", "source_id": "s", "raw_markdown": "Home > x / y\n502 Bad Gateway", "analysis_notes": "null"}, {"id": "slot", "source_id": "s", "raw_markdown": story(rng) + " in {{place}}"}]
    # a response that no detector knows: unlike its address and title, and given again and again
    rows += [{"id": f"odd{i}", "source_id": "s", "raw_markdown": f'Quux garply waldo fred plugh "Rapid tumor burden for adults" ({chr(97 + i) * 6})', "title": "Rapid tumor burden for adults", "url": f"https://e/rapid-tumor-burden-{i}"} for i in range(5)]
    rows += [{"id": "once", "source_id": "s", "raw_markdown": "Completely different little note", "title": "Rapid tumor burden", "url": "https://e/rapid"}, {"id": "match", "source_id": "s", "raw_markdown": "Tumor burden fell", "title": "Tumor burden fell", "url": "https://e/x"}]
    rows += [{"id": "n"}, {"id": "e", "source_id": "s", "raw_markdown": "", "analysis_notes": ""}, {"id": "f", "source_id": "s", "raw_markdown": "Advertisement\n\nFiled under: A (B)"}]
    got = sorted(tuple(r) for r in residue_fields(articles(spark, rows)).collect())
    assert got == sorted([("bad", "raw_markdown"), ("bad", "analysis_notes"), ("slot", "raw_markdown")] + [(f"odd{i}", "raw_markdown") for i in range(5)])
    without = sorted(tuple(r) for r in residue_fields(articles(spark, rows), messages=False).collect())
    assert without == sorted([("slot", "raw_markdown")] + [(f"odd{i}", "raw_markdown") for i in range(5)])
    assert residue_fields(articles(spark, rows).limit(0)).count() == 0
    assert compare(["# Tumor burden fell", "x"], "Tumor burden fell", None)[0] is False and compare(['We lost "Tumor burden fell"'], "Tumor burden fell", None)[0] is True and compare(["x"], None, None)[0] is True
    assert slug("https://e/a/b-c_d.html?x#y") == "b c d" and slug(None) == ""
    assert is_message("Not Found") and not is_message("The drug was not found in plasma of the mice that were given it.") and is_filler("Tempori egestor lorem deseri") and has_placeholder("a {{b}}")
