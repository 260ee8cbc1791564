import random
from datetime import datetime

from pyspark.sql import functions as F

from quillgrid.operators.components import connected_components
from quillgrid.operators.discovery import after_feed_cursor, budget_mode, checkpoint_after, due_for_refresh, failure_runs, first_in_order, first_working, lane, newest_of_target, processing_branch, rank_surface, surface_plan, surface_state, yield_drift
from quillgrid.operators.graph import co_occurrence, induced, neighbourhood
from quillgrid.operators.warehouse import add_links, cascade_delete, deletable, delete_guarded, dispositions, duplicate_groups, insert_missing, merge_entities, merge_summary, not_null, patch, resolve_entities, upsert_state, violations, write_articles, write_counts, write_entities
from quillgrid.sources.feeds import expand_sitemaps, feed_entries, monthly_sitemaps
from quillgrid.sources.payloads import credit_usage, map_links, scraped_pages
from quillgrid.sources.html import before_last_seen, html_anchors, next_pages, walk_pages
from quillgrid.sources.jsonl import assign_entities, read_tagged_lines
from quillgrid.sources.manifest import manifest_errors, read_manifest
from quillgrid.schemas import conform, schema_of


def at(text):
    return datetime.fromisoformat(text)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_components_against_union_find(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(40)] + [(5, 5), (None, 3)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    got = dict(rows(connected_components(spark.createDataFrame(edges, "src int, dst int"))))
    assert got == {x: find(x) for x in parent}
    assert connected_components(spark.createDataFrame([], "src int, dst int")).count() == 0


def test_feed_cursor(spark):
    t, before, after = at("2026-01-02"), at("2026-01-01"), at("2026-01-03")
    cases = [(None, False, "a", True), (before, True, "a", False), (t, False, "a", False), (t, True, "u", False), (t, True, "v", True), (after, False, "a", True)]
    df = spark.createDataFrame([(p, t, u, "u", c, w) for p, c, u, w in cases], "p timestamp, c timestamp, u string, cu string, coarse boolean, want boolean")
    assert df.where(after_feed_cursor(*[F.col(x) for x in ("p", "c", "u", "cu", "coarse")]) != F.col("want")).count() == 0


def test_refresh_lane(spark):
    now = at("2026-07-10")
    cases = [
        (None, True, None, None, "new"), ("a", True, at("2026-07-08"), at("2026-07-01"), "refresh"), ("a", True, at("2026-07-03"), None, "refresh"), ("a", True, at("2026-07-02T23:59:59"), None, "skip"),
        ("a", True, at("2026-07-08"), at("2026-07-07"), "refresh"), ("a", True, at("2026-07-08"), at("2026-07-07T00:00:01"), "skip"), ("a", True, None, None, "skip"), ("a", False, at("2026-07-08"), None, "skip"), ("a", None, at("2026-07-08"), None, "skip"),
    ]
    df = spark.createDataFrame([(now, *c) for c in cases], "now timestamp, id string, en boolean, p timestamp, s timestamp, want string")
    due = due_for_refresh(F.col("now"), F.col("en"), F.lit(7), F.lit(72), F.col("p"), F.col("s"))
    assert [(r.l, r.want) for r in df.select(lane(F.col("id"), due).alias("l"), "want").collect()] == [(c[-1], c[-1]) for c in cases]


def test_branch_order(spark):
    cases = [(True, "new", None, None, None, 500, "error"), (False, "refresh", "h", "h", "x", 5, "unchanged"), (False, "new", "h", "h", "x", 5, "paywalled"), (False, "refresh", "", "", None, 5, "too_short"), (False, "new", None, "h", None, 300, "analyze")]
    df = spark.createDataFrame(cases, "f boolean, l string, a string, b string, p string, w int, want string")
    assert df.where(processing_branch(*[F.col(c) for c in ("f", "l", "a", "b", "p", "w")]) != F.col("want")).count() == 0


def test_surfaces_and_breaker(spark):
    df = spark.createDataFrame([("rss", "map"), ("map", None), ("category_page", "rss"), (None, None)], "p string, f string")
    assert [r[0] for r in df.select(surface_plan(F.col("p"), F.col("f"))).collect()] == [["rss", "map"], ["map"], ["category_page", "rss", "map"], ["map"]]
    tries = spark.createDataFrame([("s", 1, True, "rss"), ("s", 2, False, "map"), ("t", 1, True, "rss")], "k string, o int, bad boolean, surface string")
    assert rows(first_working(tries, "k", "o", "bad", "surface")) == [("s", "map", 1), ("t", None, 1)] or set(first_working(tries, "k", "o", "bad", "surface").collect()) == {("s", "map", 1), ("t", None, 1)}
    seq = [("a", i, c == "x") for i, c in enumerate("xx.xxxx.x")]
    got = failure_runs(spark.createDataFrame(seq, "k string, n int, bad boolean"), "k", ["n"], "bad").orderBy("n").collect()
    assert [r.run_length for r in got] == [1, 2, 0, 1, 2, 3, 4, 0, 1] and [r.n for r in got if r.tripped] == [5, 6]


def test_surface_state(spark):
    seq = [("a", i, c == "x", at(f"2026-01-0{i + 1}"), f"e{i}") for i, c in enumerate("xx.xxxx")] + [("b", 0, True, at("2026-01-01"), "e"), ("b", 1, False, at("2026-01-02"), "e"), ("c", 0, True, None, None)]
    got = {r.k: (r.error_count, r.last_error, str(r.cooldown_until), str(r.last_successful_discovery_at)) for r in surface_state(spark.createDataFrame(seq, "k string, n int, bad boolean, t timestamp, e string"), "k", ["n"], "bad", "t", "e").collect()}
    assert got == {"a": (4, "e6", "2026-01-07 06:00:00", "2026-01-03 00:00:00"), "b": (0, None, "None", "2026-01-02 00:00:00"), "c": (1, None, "None", "None")}


def test_checkpoints_and_listings(spark):
    df = spark.createDataFrame([(None, at("2026-01-01")), ({"x": "1", "news": "0"}, at("2026-01-01")), ({"x": "1"}, None)], "m map<string,string>, t timestamp")
    assert [r[0] for r in df.select(checkpoint_after(F.col("m"), F.lit("news"), F.col("t"))).collect()] == [{"news": "2026-01-01T00:00:00Z"}, {"x": "1", "news": "2026-01-01T00:00:00Z"}, {"x": "1"}]
    links = spark.createDataFrame([("t", "u1", 1, 3), ("t", "u2", 2, 4), ("t", "u3", 3, 9), ("s", "u4", 1, 0)], "t string, u string, p int, s int")
    assert rows(newest_of_target(links, "t", "u", "p", "s")) == [("t", "u2")]
    assert [r.u for r in first_in_order(links, "t", "p", 1).orderBy("u").collect()] == ["u1", "u4"]


def test_new_tables(spark):
    base = spark.createDataFrame([("1", "http://a/", "http://a/", "t", "h"), ("2", "http://b/", "http://b/", "t", "h"), ("0", "http://a/2", "http://a/", "t", "h")], "id string, url string, normalized_url string, title string, content_hash string")
    new = spark.createDataFrame([("n1", "u1", "http://a/", "T", "h", "refresh"), ("n2", "u2", "http://b/", "T", "g", "refresh"), ("n3", "u3", "http://c/", "T", None, "refresh"), ("n4", "u4", "http://b/", "X", "g", "new"), ("n5", "u5", "http://b/", "Y", "k", "refresh")], "id string, url string, normalized_url string, title string, content_hash string, lane string")
    judged = dispositions(new, base, [F.col("id")])
    assert {r.id: (r.existing_id, r.disposition) for r in judged.collect()} == {"n1": ("0", "refreshed_unchanged"), "n2": ("2", "refreshed_changed"), "n3": (None, "inserted"), "n4": ("2", "duplicate"), "n5": ("2", "refreshed_changed")}
    assert rows(write_articles(judged, base, [F.col("id")], ["content_hash"], ["title"]).select("id", "title", F.coalesce("content_hash", F.lit("-")))) == [("0", "t", "h"), ("1", "t", "h"), ("2", "Y", "k"), ("n3", "T", "-")]
    report = write_counts(judged.withColumns({"failed": F.col("id") == "n4", "s": F.lit("s")}), spark.createDataFrame([("s", "a", "x"), ("s", None, "x"), ("s", "a", " "), ("z", "a", None)], "s string, article_id string, name string"), source="s")
    assert rows(report) == [("s", 1, 0, 2, 1, 1, 1, 2), ("z", 0, 0, 0, 0, 0, 0, 1)]
    ents = spark.createDataFrame([("1", "Acme", "acme", "company", at("2026-01-02"))], "id string, name string, canonical_name string, entity_type string, created_at timestamp")
    inc = spark.createDataFrame([("x", "Acme Inc", "acme", "company"), ("y", "Bolt", None, "company"), ("z", "Bolt", " ", "company"), ("w", "Cog Ltd", "cog", "company"), ("v", "Cog", "cog", "company")], "id string, name string, canonical_name string, entity_type string")
    made, named = write_entities(inc, ents, [F.col("id")])
    assert sorted(r.id for r in made.collect()) == ["1", "v", "y"] and {r.id: r.entity_id for r in named.collect()} == {"x": "1", "y": "y", "z": "y", "w": "v", "v": "v"}
    assert rows(not_null({"e": ents, "i": inc}, [("e", "name"), ("i", "canonical_name")])) == [("not null e.name", 0), ("not null i.canonical_name", 1)]
    s = spark.createDataFrame([("a", 1, "e"), ("b", 2, "f")], "k string, n int, e string")
    u = spark.createDataFrame([("b", None, None), ("c", 3, None)], "k string, n int, e string")
    assert sorted(upsert_state(s, u, "k", ["e"]).collect(), key=str) == [("a", 1, "e"), ("b", 2, None), ("c", 3, None)]


def test_guarded_delete(spark):
    p = spark.createDataFrame([("1",), ("2",), ("3",)], "id string")
    c = spark.createDataFrame([("a", "1"), ("b", None)], "id string, p string")
    left, refused = delete_guarded(p, spark.createDataFrame([("1",), ("2",), ("2",), ("9",)], "id string"), c, "p")
    assert rows(left) == [("1",), ("3",)] and rows(refused) == [("1",)]


def test_payloads(spark):
    df = spark.createDataFrame([("a", '{"links":[{"url":"u","title":"t"},"x",{"title":"no"},{"url":""}]}'), ("b", "no json"), ("c", None), ("d", '{"links":7}')], "k string, body string")
    assert rows(map_links(df).select("k", "pos", "url", "title")) == [("a", 0, "u", "t")]
    df = spark.createDataFrame([("a", '{"success":true,"data":{"markdown":"one two"}}'), ("b", '{"success":false}'), ("c", None), ("d", "junk")], "k string, body string")
    assert rows(scraped_pages(df).select("k", "success", "markdown", "word_count", F.col("content_hash").isNotNull(), "paywall_detected", F.coalesce("error", F.lit("-")))) == [
        ("a", True, "one two", 2, True, False, "-"), ("b", False, "", 0, False, False, '{"success":false}'), ("c", False, "", 0, False, False, "no answer"), ("d", False, "", 0, False, False, "junk")]
    assert credit_usage(spark.createDataFrame([('{"data":{"remaining_credits":5}}',)], "body string")).first().remaining_credits == 5


def test_hostile_feeds(spark):
    item = '<rss xmlns:a="x"><channel><item>%s</item></channel></rss>'
    cases = {
        "refs": (item % "<title>&#65;&amp;&#x42;</title><link>U</link>", [("U", "A&B", "")]),
        "late prefixed link": (item % '<link>U</link><a:link rel="self" href="S"/><title>T</title>', [("U", "T", "")]),
        "first link empty": (item % '<a:link rel="self" href="S"/><title>T</title><link>U</link>', []),
        "cut off": ("<rss><channel><item><link>U</link></item><item>", []),
        "cdata": (item % "<link><![CDATA[U]]></link><description><![CDATA[<summary>x</summary> y]]></description><summary>z</summary>", [("U", "", "<summary>x</summary> y")]),
        "comment": ("<!-- <rss> --><!DOCTYPE rss>" + item % "<!-- <link>no</link> --><link>U</link>", [("U", "", "")]),
        "html": ("<html><item><link>U</link></item></html>", []),
    }
    df = spark.createDataFrame([(k, b) for k, (b, _) in cases.items()], "k string, body string")
    got = {k: [] for k in cases}
    for r in feed_entries(df).collect():
        got[r.k].append((r.url, r.title, r.description))
    assert got == {k: want for k, (_, want) in cases.items()}


def test_surface_rank_compat_keeps_lowest(spark):
    df = spark.createDataFrame([("s", f"u{i}", i, None) for i in range(5)], "s string, url string, score int, published_at timestamp")
    assert {r.score for r in rank_surface(df, "s", 2).collect()} == {0, 1} and {r.score for r in rank_surface(df, "s", 2, compat=False).collect()} == {3, 4}


def test_budget_and_drift(spark):
    df = spark.createDataFrame([(700.0, 10.0), (350.0, 10.0), (300.0, 25.0)], "r double, b double")
    assert [r[0] for r in df.select(budget_mode(F.col("r"), F.lit(1000), F.col("b"), F.lit(10))).collect()] == ["normal", "conserve", "critical"]
    runs = spark.createDataFrame([("a", 1, 100), ("a", 2, 20), ("a", 3, 15)], "k string, n int, c int")
    assert [r.drifted for r in yield_drift(runs, "k", "n", "c").orderBy("n").collect()] == [False, True, False]


def test_merge_example(spark):
    e = spark.createDataFrame([("e1", "x", at("2026-01-01")), ("e2", "x ", at("2026-01-02")), ("e3", "x", at("2026-01-03")), ("e4", "", at("2026-01-01"))], "id string, c string, created_at timestamp").withColumn("t", F.lit("company"))
    links = spark.createDataFrame([("a1", "e1", 2, None), ("a1", "e2", 3, "subject"), ("a2", "e2", 1, None), ("a2", "e3", 4, None)], "article_id string, entity_id string, mention_count int, role_in_article string")
    g = duplicate_groups(e, F.col("c"), F.col("t"))
    merged = merge_entities(links, g)
    assert rows(merged.select("article_id", "entity_id", "mention_count")) == [("a1", "e1", 5), ("a2", "e1", 5)]
    s = merge_summary(links, g).first()
    assert (s.groups_found, s.entities_to_merge, s.article_links_reassigned, s.article_links_merged, s.entities_deleted) == (1, 2, 1, 2, 2)
    assert duplicate_groups(e.where("id in ('e1', 'e4')"), F.col("c"), F.col("t")).count() == 0


def test_co_occurrence_example(spark):
    links = [("a1", "x"), ("a1", "y"), ("a1", "z"), ("a2", "x"), ("a2", "y"), ("a3", "x"), ("a3", "x")]
    df = spark.createDataFrame(links, "article_id string, entity_id string")
    assert rows(co_occurrence(df)) == [("x", "x", 1), ("x", "y", 2), ("x", "z", 1), ("y", "z", 1)]
    assert rows(co_occurrence(df, distinct=True)) == [("x", "y", 2), ("x", "z", 1), ("y", "z", 1)]
    assert rows(induced(df, spark.createDataFrame([("x",), ("z",)], "id string"))) == [("x", "x", 1), ("x", "z", 1)]
    assert rows(neighbourhood(df, spark.createDataFrame([("z",)], "entity_id string"))) == [("x",), ("y",), ("z",)]


def test_writes(spark):
    base = spark.createDataFrame([("1", "http://a/", "http://a/"), ("2", "http://b/?x", "http://b/")], "id string, url string, normalized_url string")
    new = spark.createDataFrame([("n1", "http://a/#f", "http://a/"), ("n2", "http://c/", "http://c/"), ("n3", "http://c/#2", "http://c/"), ("n4", "http://b/?x", "http://other/")], "id string, url string, normalized_url string")
    got = {r.id: (r.existing_id, r.disposition) for r in dispositions(new, base, [F.col("id")]).collect()}
    assert got == {"n1": ("1", "duplicate"), "n2": (None, "inserted"), "n3": (None, "duplicate"), "n4": ("2", "duplicate")}
    b = spark.createDataFrame([("1", "t", "s", "h"), ("2", "t", "s", "h"), ("3", "t", "s", None)], "id string, title string, summary string, content_hash string")
    u = spark.createDataFrame([("1", "T", "S", "h"), ("2", "T", "S", ""), ("9", "T", "S", "q")], "id string, title string, summary string, content_hash string")
    assert rows(patch(b, u, "id", ["title"], ["summary"]).select("id", "title", "summary", F.coalesce(F.col("changed").cast("string"), F.lit("-")))) == [("1", "T", "s", "false"), ("2", "T", "S", "true"), ("3", "t", "s", "-")]
    s = spark.createDataFrame([("a", 1, "e"), ("b", 2, None)], "k string, n int, e string")
    assert sorted(upsert_state(s, spark.createDataFrame([("b", 0), ("c", 5)], "k string, n int"), "k").collect()) == [("a", 1, "e"), ("b", 0, None), ("c", 5, None)]
    assert insert_missing(s, s, ["k"]).count() == 2
    links = spark.createDataFrame([("a", "x", 1), ("b", "x", 1)], "article_id string, entity_id string, n int")
    more = spark.createDataFrame([("a", "y"), ("a", "y"), ("b", "x")], "article_id string, entity_id string")
    assert sorted((r.article_id, r.entity_id) for r in add_links(links, more, links.where("article_id = 'a'")).collect()) == [("a", "y"), ("b", "x")]
    ents = spark.createDataFrame([("1", "Acme", "acme", "company", at("2026-01-02")), ("2", "ACME", "acme", "company", at("2026-01-01"))], "id string, name string, canonical_name string, entity_type string, created_at timestamp")
    inc = spark.createDataFrame([("Acme Inc", "acme", "company"), ("Acme", "", "company"), ("Acme", None, "drug")], "name string, canonical_name string, entity_type string")
    assert {(r.name, r.entity_type, r.entity_id) for r in resolve_entities(inc, ents).collect()} == {("Acme Inc", "company", "2"), ("Acme", "company", "1"), ("Acme", "drug", None)}


def test_integrity(spark):
    p = spark.createDataFrame([("1", "u"), ("2", "u"), ("3", "v")], "id string, url string")
    c = spark.createDataFrame([("a", "1"), ("b", "9"), ("c", None)], "id string, p string")
    assert dict(rows(violations({"p": p, "c": c}, {"p": [("url",)]}, [("c", "p", "p")]))) == {"unique p(url)": 1, "reference c.p": 1}
    assert rows(cascade_delete(c, p, "p").select("id")) == [("a",)] and rows(deletable(p, c, "p").select("id")) == [("2",), ("3",)]
    assert conform(p.withColumn("extra", F.lit(1)), "entities").schema == schema_of("entities")


def test_feeds(spark):
    rss = '<?xml version="1.0"?><rss><channel><item><title>A &amp; B</title><link>http://e/1</link><summary>late</summary><description>first</description><pubDate>Wed, 08 Jul 2026 10:00:00 GMT</pubDate></item><item><title>no link</title></item></channel></rss>'
    atom = '<a:feed xmlns:a="http://www.w3.org/2005/Atom"><a:entry><a:title>T</a:title><a:link rel="self" href="http://e/s"/><a:link href="http://e/2"/><a:content>c</a:content><a:published>2026-07-08T10:00:00Z</a:published></a:entry></a:feed>'
    rdf = '<rdf:RDF xmlns:rdf="x" xmlns="y" xmlns:dc="z" xmlns:content="w"><item><title>R</title><link>http://e/3</link><content:encoded><![CDATA[<b>e</b>]]></content:encoded><dc:date>bad</dc:date></item></rdf:RDF>'
    df = spark.createDataFrame([("r", rss), ("a", atom), ("d", rdf), ("x", "not xml"), ("n", None)], "k string, body string")
    got = {r.k: (r.kind, r.url, r.title, r.description, str(r.published_at)) for r in feed_entries(df).collect()}
    assert got == {"r": ("rss", "http://e/1", "A & B", "late", "2026-07-08 10:00:00"), "a": ("atom", "http://e/2", "T", "c", "2026-07-08 10:00:00"), "d": ("rdf", "http://e/3", "R", "<b>e</b>", "None")}


def test_sitemaps(spark):
    index = "<sitemapindex><sitemap><loc>http://e/m1</loc></sitemap><sitemap><loc>http://e/deep</loc></sitemap></sitemapindex>"
    m1 = '<urlset xmlns="s"><url><loc>http://e/1</loc><lastmod>2026-07-01</lastmod></url><url><lastmod>2026-07-01</lastmod></url><url><loc>http://e/2</loc><lastmod>never</lastmod></url></urlset>'
    deep = "<sitemapindex><sitemap><loc>http://e/deeper</loc></sitemap></sitemapindex>"
    df = spark.createDataFrame([("http://e/i", index), ("http://e/m1", m1), ("http://e/deep", deep), ("http://e/deeper", m1.replace("/1", "/9"))], "request_url string, body string")
    only = df.where("request_url <> 'http://e/deeper'")
    assert {(r.url, str(r.published_at)) for r in expand_sitemaps(only).collect()} == {("http://e/1", "2026-07-01 00:00:00"), ("http://e/2", "None")}
    months = monthly_sitemaps(spark.createDataFrame([("s",)], "id string"), "{y}-{m}", F.lit("2026-02-15").cast("date"), 4)
    assert [r.sitemap_url for r in months.orderBy("month").collect()] == ["2025-11", "2025-12", "2026-01", "2026-02"]


def test_html(spark):
    page = '<a href="/a">x <b>y</b></a><a href="/lost"><a href="/b" rel="next nofollow">2&amp;3</a><a href="/c">Older posts</a><a href="/open">'
    df = spark.createDataFrame([("p", page), ("many", '<a href="/z">z</a>' * 300), ("n", None)], "k string, html string")
    got = [(r.href, r.text, r.rel) for r in html_anchors(df.where("k = 'p'"), "k", "html").orderBy("pos").collect()]
    assert got == [("/a", "x y", ""), ("/b", "2&3", "next nofollow"), ("/c", "Older posts", "")]
    assert html_anchors(df, "k", "html").where("k = 'many'").count() == 250
    anchors = spark.createDataFrame([("http://e/1", 0, "/2", "more", "next"), ("http://e/1", 1, "/9", "Next", ""), ("http://e/2", 0, "/3", "›", ""), ("http://e/3", 0, "/4", "older", "")], "page string, pos int, href string, text string, rel string")
    following = next_pages(anchors, "page")
    assert rows(following) == [("http://e/1", "http://e/2"), ("http://e/2", "http://e/3"), ("http://e/3", "http://e/4")]
    pages = spark.createDataFrame([(f"http://e/{i}",) for i in range(1, 6)], "page_url string")
    start = spark.createDataFrame([("t", "http://e/1")], "target string, page_url string")
    assert [r.page_url for r in walk_pages(start, pages, following, 3).orderBy("step").collect()] == ["http://e/1", "http://e/2", "http://e/3"]
    seen = spark.createDataFrame([("t", i, f"u{i}", "u3") for i in range(6)] + [("s", i, f"u{i}", None) for i in range(60)], "t string, pos int, url string, last string")
    out = before_last_seen(seen, "t", "url", "pos", "last", least=10, limit=5)
    assert out.where("t = 't'").count() == 3 and out.where("t = 's'").count() == 15


def test_tagged_lines(spark, tmp_path):
    text = 'ENTITY:{"name":"early"}\n{"title":"A"}\n\nENTITY:{"name":"x"}\nbroken\nENTITY:{"name":"y"}\n{"title":"B"}\nENTITY:nope\nENTITY:{"name":"z"}'
    (tmp_path / "f.txt").write_text(text)
    a, e, errors = assign_entities(read_tagged_lines(spark, str(tmp_path / "f.txt")), "title string", "name string")
    assert [(r.article_no, r.article.title) for r in a.orderBy("article_no").collect()] == [(1, "A"), (2, "B")]
    assert sorted((r.article_no, r.entity.name) for r in e.collect()) == [(1, "x"), (1, "y"), (2, "z")]
    assert [(r.article_errors, r.entity_errors) for r in errors.collect()] == [(1, 2)]


def test_manifest(spark, tmp_path):
    (tmp_path / "m.yaml").write_text(
        "- {name: A, url: 'https://a/', domain: d, source_type: news, enabled: true, crawl_frequency: daily, primary_discovery_surface: rss}\n- {url: 'https://x/'}\n"
        "- {name: B, url: 'https://a/', domain: d, source_type: news, enabled: true, crawl_frequency: daily, primary_discovery_surface: category_page, feed_url: feed, sitemap_urls: [s]}\n- {name: A, url: 'https://c/', domain: d, source_type: news, enabled: true}\n"
    )
    m = read_manifest(spark, str(tmp_path / "m.yaml"))
    got = {r.name: r.errors for r in manifest_errors(m).collect()}
    assert got == {"A": ["missing: crawl_frequency"], "B": ["primary_discovery_surface unknown: category_page", "feed_url not absolute", "sitemap_urls not absolute"]}
    assert read_manifest(spark, str(tmp_path / "none.yaml")).count() == 0


def test_runs_and_targets(spark):
    from quillgrid.operators.runs import finish_run, in_flight, patch_targets, run_totals

    w = spark.createDataFrame([("r", "inserted", 0, None), ("r", "failed", 1, 2), ("q", "duplicate", 0, 0)], "run string, d string, a int, l int")
    totals = run_totals(w, "run", "d", "a", "l")
    assert rows(totals) == [("q", 1, 0, "success"), ("r", 1, 3, "partial_success")]
    runs = spark.createDataFrame([("r", "in_progress", 0, 0, None), ("z", "failed", 7, 1, None)], "id string, status string, article_count int, error_count int, completed_at timestamp")
    assert in_flight(runs) and not in_flight(finish_run(runs, totals, "run", F.lit("2026-01-01").cast("timestamp"))) and not in_flight(runs.limit(0))
    t = spark.createDataFrame([("a", "u0", "old", "x"), ("b", "u0", None, None), ("c", None, None, None), ("d", "u0", "e", "t")], "id string, last_seen_url string, last_error string, error_type string").withColumns({"last_checked_at": F.lit(None).cast("timestamp"), "detected_at": F.lit(None).cast("timestamp")})
    res = spark.createDataFrame([("a", "u1", None, None), ("b", None, "boom", "net"), ("c", None, None, None)], "id string, newest_url string, error string, error_type string")
    got = {r.id: (r.last_seen_url, r.last_error, r.error_type, r.last_checked_at is not None) for r in patch_targets(t, res, F.lit("2026-01-01").cast("timestamp")).collect()}
    assert got == {"a": ("u1", None, None, True), "b": ("u0", "boom", "net", True), "c": (None, None, None, True), "d": ("u0", "e", "t", False)}


def test_model_callback(spark):
    from quillgrid.operators.runs import ask_model

    calls = spark.createDataFrame([("a", "good"), ("b", "bad"), ("c", None)], "id string, p string")
    got = {r.id: (r.answer, r.attempts) for r in ask_model(calls, "id", "p", lambda ps, n: [f"{p}{n}" for p in ps], lambda a: a.startswith("good")).collect()}
    assert got == {"a": ("good1", 1), "b": ("bad2", 2), "c": (None, 0)}


def test_scan_of_missing_table(spark, data):
    from quillgrid.sources.tables import scan

    assert scan(spark, data, "delivery_logs").count() == 0
    assert scan(spark, data, "sources", {"source_type": "preprint"}, ["id"], 1).count() == 1
