import hashlib
import re
import unicodedata
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from quillgrid.config import Settings, map_limit, override, scrape_timeout_ms
from quillgrid.functions.dates import iso_datetime, parse_datetime
from quillgrid.functions.entity import canonical_name, invalidation, sanitize_entities, tags_of
from quillgrid.functions.score import link_score
from quillgrid.functions.text import file_name, hash_markdown, json_object, paywall_signal, sentence_count, summary_hint, word_count
from quillgrid.functions.url import join_url, normalize_url, published_from_url, recency_key, same_domain


def apply(spark, f, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string").coalesce(1)
    return [r[0] for r in df.orderBy("i").select(f(F.col("v")).alias("o")).collect()]


URLS = [
    ("HTTPS://Example.COM:443", "https://example.com/"),
    ("http://example.com:8080/a?utm_source=x&b=1#f", "http://example.com:8080/a?b=1"),
    ("https://e.com/a?b=&c=x y", "https://e.com/a?b=&c=x+y"),
    ("https://e.com/a?flag", "https://e.com/a?flag="),
    ("https://e.com/a?q=%7Ex%2fy", "https://e.com/a?q=~x%2Fy"),
    ("https://e.com/a?page=2&REF=x", "https://e.com/a?page=2"),
    ("https://e.com/a?b=2&b=1&a=0", "https://e.com/a?b=2&b=1&a=0"),
    ("https://user:pw@e.com/p", "https://e.com/p"),
    ("https://e.com/a//b/../c", "https://e.com/a//b/../c"),
    ("/rel?utm_source=x", "/rel?utm_source=x"),
    ("mailto:a@b.c", "mailto:a@b.c"),
    ("  https://e.com/x#top ", "https://e.com/x"),
    ("", ""),
    (None, ""),
]


def test_normalize_url(spark):
    assert apply(spark, normalize_url, [x for x, _ in URLS]) == [y for _, y in URLS]


def test_normalize_url_is_idempotent_and_blind_to_tracking(spark):
    once = [y for _, y in URLS if y.startswith("http")]
    assert apply(spark, normalize_url, once) == once
    assert apply(spark, normalize_url, [u + ("&" if "?" in u else "?") + "gclid=1#x" for u in once]) == once


def test_canonical_names(spark):
    pairs = [
        ("Pfizer", "pfizer"), ("Pfizer Inc.", "pfizer"), ("PFIZER, INC", "pfizer"), ("Acme Co., Ltd.", "acme"), ("Foo Ltd Corp", "foo"), ("Foo Inc Corp", "foo inc"), ("Merck & Co.", "merck &"),
        ("  Eli   Lilly and Company ", "eli lilly and"), ("Cisco", "cis"), ("Visa", "vi"), ("Flag Therapeutics", "flag therapeutics"), ("Novo Nordisk A/S", "novo nordisk a/s"), ("Moderna Incorporated", "moderna"),
        ("BioNTech GmbH", "biontech"), ("Sanofi SA", "sanofi"), ("Roche Holding AG", "roche holding"), ("Zoetis;", "zoetis"), ("Co.", ""), (None, ""),
    ]
    assert apply(spark, canonical_name, [x for x, _ in pairs]) == [y for _, y in pairs]


def test_sentences_words_hints(spark):
    assert apply(spark, sentence_count, ["", "A. B! C?", "v1.2 is out.", "...", "一。二！三？", "No end", None]) == [0, 3, 2, 0, 3, 1, 0]
    assert apply(spark, word_count, ["a b c", "", " ", None]) == [3, 0, 0, 0]
    assert apply(spark, summary_hint, ["# T\n\n one \r\n## two\nthree\nfour", None]) == ["T one two", ""]
    assert len(apply(spark, summary_hint, ["x" * 5000])[0]) == 480


def test_hash_equivalence(spark):
    def expected(t):
        t = re.sub(r"<!--.*?-->", "", unicodedata.normalize("NFC", t or ""), flags=re.S)
        t = re.sub(r"\r\n?", "\n", re.sub(r"[ \t]+", " ", t))
        return hashlib.sha256("\n".join(x.strip() for x in t.split("\n")).strip().lower().encode()).hexdigest()

    same = ["# Hello  World\n\nBody é", "# hello world\r\n\r\nBODY é", "#\tHello World <!-- a\nb -->\n\n Body é "]
    other = ["# Hello World\n\n\nBody é", "", None, "x" * 300_000]
    out = apply(spark, hash_markdown, same + other)
    assert len(set(out[:3])) == 1 and out == [expected(t) for t in same + other]


def test_markers_and_names(spark):
    assert apply(spark, paywall_signal, ["Purchase this article. Become a premium subscriber", "Already a subscriber? [Log in]", "free", None]) == ["premium_gate", "subscriber_login_gate", None, None]
    assert apply(spark, file_name, ["a/b: c?*", None]) == ["a_b_ c", ""]
    assert apply(spark, json_object, ["x {a {b} c} y", "none"]) == ["{a {b} c}", ""]


def test_link_resolution(spark):
    base = "https://e.com/a/b.html?x=1"
    cases = ["c", "/d", "//o.com/x", "?q=2", "https://z.com/", "../up", "./c", "#f"]
    df = spark.createDataFrame([(base, h) for h in cases], "b string, h string").coalesce(1)
    plain = [r[0] for r in df.select(join_url(F.col("b"), F.col("h"))).collect()]
    dots = [r[0] for r in df.select(join_url(F.col("b"), F.col("h"), dots=True)).collect()]
    wanted = [urljoin(base, h).split("#")[0] for h in cases]
    assert dots == wanted
    assert [p for p, h in zip(plain, cases) if "." not in h[:2]] == [w for w, h in zip(wanted, cases) if "." not in h[:2]]


def test_same_domain_and_dates(spark):
    df = spark.createDataFrame([("m.e.com", "e.com", True), ("e.com", "e.com", True), ("xe.com", "e.com", False)], "a string, b string, w boolean")
    assert df.where(same_domain(F.col("a"), F.col("b")) != F.col("w")).count() == 0
    urls = ["https://x/2026/07/08/a", "https://x/2026/07/a", "https://x/2026/13/01/a", "https://x/a"]
    keys = apply(spark, recency_key, urls)
    assert [tuple(k) for k in keys] == [(2026, 7, 8), (2026, 7, 0), (2026, 13, 1), (0, 0, 0)]
    assert [str(x)[:10] if x else None for x in apply(spark, published_from_url, urls)] == ["2026-07-08", "2026-07-01", None, None]
    texts = ["2026-07-08T10:00:00Z", "2026-07-08T10:00:00+02:00", "Wed, 08 Jul 2026 10:00:00 GMT", "Wed, 8 Jul 2026 10:00:00 +0200", "soon", "", None]
    assert apply(spark, lambda c: iso_datetime(parse_datetime(c)), texts) == ["2026-07-08T10:00:00Z", "2026-07-08T08:00:00Z", "2026-07-08T10:00:00Z", "2026-07-08T08:00:00Z", None, None, None]


SCORES = [
    ("https://x.com/2026/07/08/big-news/", "", "homepage_links", "x" * 25, "", [], [], 6),
    ("https://x.com/news/foo", "", "homepage_links", "", "", [], [], 4),
    ("https://x.com/category/biotech/", "", "homepage_links", "", "", [], [], -21),
    ("https://x.com/about-us", "", "homepage_links", "", "", [], [], -1),
    ("https://arxiv.org/abs/2607.01234", "", "rss_feed", "x" * 25, "x" * 25, ["/abs/"], [], 19),
    ("https://www.science.org/doi/10.1126/x", "", "rss_feed", "", "", ["/doi/"], [], 10),
    ("https://www.science.org/content/blog-post/x", "", "rss_feed", "x" * 25, "", ["/doi/"], [], -18),
    ("https://www.nature.com/articles/s41587-026-01234-5", "", "article_listing", "", "", ["/articles/"], [r"/articles/s\d{5}-\d{3}-\d{5}-[\w-]+$"], 20),
]


def test_link_scores(spark):
    schema = "url string, x string, mode string, title string, d string, kw array<string>, rx array<string>, want int"
    df = spark.createDataFrame(SCORES, schema).withColumn("none", F.array().cast("array<string>"))
    s = link_score(*[F.col(c) for c in ("url", "title", "d", "mode", "kw", "rx", "none", "none")])
    assert [(r.s, r.want) for r in df.select(s.alias("s"), "want").collect()] == [(x[-1], x[-1]) for x in SCORES]


def test_entities_and_tags(spark):
    rows = [([(" A ", "drug"), ("", "drug"), (None, "x"), ("B", "gadget"), ("C", None)],), (None,)]
    df = spark.createDataFrame(rows, "e array<struct<name:string,entity_type:string>>")
    got = [[tuple(x) for x in r[0]] for r in df.select(sanitize_entities(F.col("e"))).collect()]
    assert got == [[("A", "drug"), ("B", "company"), ("C", "company")], []]
    assert apply(spark, tags_of, ['["a","b"]', "single", "[broken", " ", None]) == [["a", "b"], ["single"], ["[broken"], [], []]


def test_fingerprint_invalidation(spark):
    s = "a struct<content_hash:string,prompt_template_version:string,model:string,temperature:double>"
    df = spark.createDataFrame([((("h", "v", "m", 0.1)), ("h", "v", "m", 0.9)), (("h", "v", "m", 0.1), ("h", "w", "m", 0.1)), ((None, "v", "m", 0.1), ("h", "v", "m", 0.1))], f"{s}, {s.replace('a ', 'b ', 1)}")
    assert [r[0] for r in df.select(invalidation(F.col("a"), F.col("b"))).collect()] == ["no", "may", "must"]


def test_settings():
    s = Settings.from_mapping({"ARTICLES_PER_SOURCE": "0", "min_words": "x", "compat": "no", "refresh_window_days": "-3"})
    assert (s.articles_per_source, s.min_words, s.compat, s.refresh_window_days) == (1, 300, False, 0)
    assert override("STAT-News=5, gen = x,gen=7", "stat news", 15) == 5 and override("gen=x", "GEN", 15) == 15 and override(None, "a", 2) == 2
    assert scrape_timeout_ms(True, 2) == 240_000 and map_limit(15) == 300 and map_limit(1) == 80


@pytest.mark.parametrize("text", ["", "no braces"])
def test_json_object_without_braces(spark, text):
    assert apply(spark, json_object, [text]) == [""]
