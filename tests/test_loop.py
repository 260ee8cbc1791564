"""The steps of the loop end to end, the command line, sinks, and streams that go on."""

import json

import pytest
from pyspark.sql import functions as F

from quillgrid.__main__ import main
from quillgrid.plans.loop import discover, write
from quillgrid.runtime import as_table, forget_tables, scratch, shared_dir
from quillgrid.schemas import schema_of
from quillgrid.sinks import json_lines, markdown_files, write_partitioned
from quillgrid.streaming.ingest import Progress, breaker, drain, upsert_batches

RSS = '<rss><channel><item><title>A headline of more than twenty-five letters</title><link>https://s.example/news/a?utm_source=x</link><pubDate>Wed, 08 Jul 2026 10:00:00 GMT</pubDate></item><item><link>https://s.example/about/</link></item></channel></rss>'
PAYLOADS = [
    ("S", "rss", 0, "https://s.example/feed", RSS, 200, None),
    ("S", "map", 0, "https://s.example/", '{"links":[{"url":"https://s.example/2026/07/08/b/","title":"B"},{"url":"https://s.example/news/a"}]}', 200, None),
    ("S", "sitemap", 0, "https://s.example/map.xml", "<urlset><url><loc>https://s.example/news/c</loc><lastmod>2026-07-01</lastmod></url></urlset>", 200, None),
    ("S", "category_page", 0, "https://s.example/list/", '<a href="/articles/d">D</a><a href="https://other.example/articles/e">E</a>', 200, None),
    ("S", "rss", 1, "https://s.example/f2", None, 500, "failed"),
    ("T", "rss", 0, "https://t.example/feed", "<rss><channel><item><li", 200, None),
]


@pytest.fixture
def warehouse(spark, tmp_path):
    spark.createDataFrame(PAYLOADS, schema_of("payloads")).write.parquet(f"{tmp_path}/payloads.parquet")
    rows = [("1", n, f"https://{n.lower()}.example/", f"{n.lower()}.example", "news", True, "daily", "homepage_links") for n in "ST"]
    spark.createDataFrame(rows, "id string, name string, url string, domain string, source_type string, enabled boolean, crawl_frequency string, extraction_mode string").write.parquet(f"{tmp_path}/sources.parquet")
    a = spark.createDataFrame([("a1", "1", "https://s.example/news/a", "https://s.example/news/a", "old", "h1")], "id string, source_id string, url string, normalized_url string, title string, content_hash string")
    a.write.parquet(f"{tmp_path}/articles.parquet")
    e = spark.createDataFrame([("e1", "Acme", "company", "acme", "2026-01-01"), ("e2", "ACME Inc", "company", "acme", "2026-01-02")], "id string, name string, entity_type string, canonical_name string, created_at string").withColumn("created_at", F.col("created_at").cast("timestamp"))
    e.write.parquet(f"{tmp_path}/entities.parquet")
    spark.createDataFrame([("l1", "a1", "e1", "mentioned", 2), ("l2", "a1", "e2", None, 3)], "id string, article_id string, entity_id string, role_in_article string, mention_count int").write.parquet(f"{tmp_path}/article_entities.parquet")
    return str(tmp_path)


def said(capsys):
    return [json.loads(x) for x in capsys.readouterr().out.splitlines() if x.startswith("{")]


def test_discover(spark, warehouse, capsys):
    assert main(["discover", warehouse, "--limit", "3"], spark) == 0
    got = said(capsys)
    assert [(r["url"], r["discovery_method"], r["final_rank"]) for r in got] == [("https://s.example/news/a", "rss", 1), ("https://s.example/articles/d", "category_page", 2), ("https://s.example/2026/07/08/b/", "map", 3)]
    empty = spark.createDataFrame([], schema_of("payloads"))
    assert discover(empty, spark.read.parquet(f"{warehouse}/sources.parquet")).count() == 0


def test_write(spark, warehouse, tmp_path, capsys):
    lines = ['{"title":"N","url":"https://s.example/news/a#x","lane":"refresh","content_hash":"h2"}', 'ENTITY:{"name":"Acme Corp","entity_type":"company"}', '{"title":"New","url":"https://s.example/n"}', 'ENTITY:{"name":"Bolt"}', 'ENTITY:{"name":""}', "junk"]
    (tmp_path / "lines.txt").write_text("\n".join(lines))
    assert main(["write", f"{tmp_path}/lines.txt", warehouse, "--source", "1", "--now", "2026-07-01 00:00:00", "--out", f"{tmp_path}/new"], spark) == 0
    (counts,) = said(capsys)
    assert counts == {"articles_inserted": 1, "articles_duplicate": 0, "articles_refreshed_changed": 1, "articles_refreshed_unchanged": 0, "articles_errors": 1, "entity_links_errors": 0, "entity_links_success": 2}
    new = {n: spark.read.parquet(f"{tmp_path}/new/{n}.parquet") for n in ("articles", "entities", "article_entities")}
    assert {(r.url, r.title, r.content_hash) for r in new["articles"].collect()} == {("https://s.example/news/a", "N", "h2"), ("https://s.example/n", "New", None)}
    assert sorted(r.name for r in new["entities"].collect()) == ["ACME Inc", "Acme", "Bolt"]
    assert {(r.article_id == "a1", r.entity_id == "e1") for r in new["article_entities"].collect()} == {(True, True), (False, False)}
    again, counts = write(spark.createDataFrame([("f", 0, lines[2])], "file string, line_no int, line string"), new, "1", "r", "2026-07-02")
    assert again["articles"].count() == 2 and counts.first().articles_duplicate == 1


def test_merge(spark, warehouse, tmp_path, capsys):
    assert main(["merge", warehouse], spark) == 0
    counts, group = said(capsys)
    assert counts["mode"] == "dry_run" and counts["entities_deleted"] == 1 and group["master_id"] == "e1" and group["duplicate_ids"] == ["e2"]
    assert main(["merge", warehouse, "--apply", "--out", f"{tmp_path}/merged"], spark) == 0
    assert [r.id for r in spark.read.parquet(f"{tmp_path}/merged/entities.parquet").collect()] == ["e1"]
    assert [(r.entity_id, r.mention_count) for r in spark.read.parquet(f"{tmp_path}/merged/article_entities.parquet").collect()] == [("e1", 5)]


def test_validate_and_run(spark, data, tmp_path, capsys):
    (tmp_path / "m.yaml").write_text("sources:\n- {name: A, url: 'https://a.example/', domain: a.example, source_type: news, enabled: true, crawl_frequency: daily, primary_discovery_surface: map}\n")
    assert main(["validate", f"{tmp_path}/m.yaml"], spark) == 0 and main(["list"], spark) == 0
    (tmp_path / "m.yaml").write_text("sources:\n- {name: A, url: 'https://a.example/', primary_discovery_surface: rss}\n")
    assert main(["validate", f"{tmp_path}/m.yaml"], spark) == 1
    assert main(["run", "enabled_sources", data, "--out", f"{tmp_path}/out"], spark) == 0 and spark.read.parquet(f"{tmp_path}/out").count() > 0


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(f"{i}", f"T/{i}: x", "text" if i else None, f"2026-07-0{1 + i % 2} 10:00:00") for i in range(6)], "id string, title string, raw_markdown string, at string").withColumn("at", F.col("at").cast("timestamp"))
    write_partitioned(df, f"{tmp_path}/t", "at", ("id",), files=2)
    back = spark.read.parquet(f"{tmp_path}/t")
    assert back.count() == 6 and "PartitionFilters: [isnotnull(day" in back.where("day = '2026-07-01'")._jdf.queryExecution().toString()
    assert markdown_files(df, f"{tmp_path}/md").count() == 5 and (tmp_path / "md" / "T_1_ x-1.md").read_text() == "text"
    json_lines(df.select("id", "raw_markdown"), f"{tmp_path}/j")
    assert {json.loads(r.value)["raw_markdown"] for r in spark.read.text(f"{tmp_path}/j").collect()} == {None, "text"}


def test_streams_report_progress_and_go_on(spark, tmp_path):
    schema = "k string, n int, bad boolean"
    put = lambda name, rows: spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/in/{name}")
    put("1", [("a", 1, True), ("a", 2, True), ("b", 1, True)])
    read = lambda: spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
    progress = Progress()
    spark.streams.addListener(progress)
    run = lambda: drain(breaker(read(), "k", ["n"], "bad"), "b", place=f"{tmp_path}/b")
    assert {(r.k, r.n, r.tripped) for r in run().collect()} == {("a", 1, False), ("a", 2, False), ("b", 1, False)}
    put("2", [("a", 3, True), ("a", 4, True), ("b", 2, False), ("c", 1, True)])
    assert {(r.k, r.n) for r in run().where("tripped").collect()} == {("a", 3), ("a", 4)}
    keyed = lambda: drain(read().select("k"), "u", each=upsert_batches(spark, f"{tmp_path}/u", "k"), place=f"{tmp_path}/u")
    assert sorted(r.k for r in keyed().collect()) == ["a", "b", "c"]
    put("3", [("a", 9, False), ("d", 1, False)])
    assert sorted(r.k for r in keyed().collect()) == ["a", "b", "c", "d"]
    for _ in range(50):
        if progress.rows and not progress.running:
            break
        __import__("time").sleep(0.2)
    spark.streams.removeListener(progress)
    assert progress.table(spark).agg(F.sum("rows")).first()[0] >= 7


def test_tables_are_forgotten(spark):
    t = as_table(spark.range(3).toDF("x"), "t")
    path = t.inputFiles()[0].removeprefix("file://")
    assert __import__("os").path.exists(path)
    forget_tables(spark)
    assert not __import__("os").path.exists(path)


def test_no_local_folder_on_a_cluster():
    class Context:
        master = "spark://somewhere:7077"

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(ValueError):
        shared_dir(Session())
    assert scratch
