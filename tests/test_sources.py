import json
from datetime import datetime

from pyspark.sql import functions as F

from gristmill.operators import shapes
from gristmill.sources import payloads, registry
from gristmill.sources.sinks import Store, export
from gristmill.streaming import fresh

PAGE = "source_name string, url string, ord int, text string"


def page(spark, *bodies):
    return spark.createDataFrame([("s", "u", i, b if b is None or isinstance(b, str) else json.dumps(b)) for i, b in enumerate(bodies)], PAGE)


ATOM = """<feed xmlns="http://www.w3.org/2005/Atom"><entry><id>http://arxiv.example/abs/1.2v1</id><title>A
  B</title><published>2026-01-01T00:00:00Z</published><summary>code https://github.com/o/r.</summary><author><name>X  Y</name></author><author><name> </name></author></entry>
<entry><id>bad</id><title>C</title></entry><entry><id>x</id></entry></feed>"""


def test_atom_papers(spark):
    got = payloads.arxiv_papers(page(spark, ATOM, "<feed", None)).orderBy("pos").collect()
    assert [(r.title, r.authors, r.paper_external_id, r.github_url, r.published_date) for r in got] == [("A B", ["X Y"], "1.2v1", "https://github.com/o/r", datetime(2026, 1, 1)), ("C", [], None, None, None)]
    assert payloads.broken_feeds(page(spark, ATOM, "<feed", None)).count() == 2


def test_feeds(spark):
    rss = "<rss><channel><item><title>T</title><link> https://e.com/1 </link><pubDate>Thu, 10 Sep 2026 12:00:00 +0000</pubDate></item><item><title>N</title></item></channel></rss>"
    atom = '<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>U</title><link href="https://e.com/2"/><updated>2026-01-01</updated></entry></feed>'
    got = payloads.feed_items(page(spark, rss, atom)).orderBy("ord").collect()
    assert [(r.title, r.link, r.published) for r in got] == [("T", "https://e.com/1", "Thu, 10 Sep 2026 12:00:00 +0000"), ("U", "https://e.com/2", None)]


def test_listed_papers_and_broken_bodies(spark):
    body = {"results": [{"title": "A", "url_abs": "u", "repository": {"url": "https://github.com/a/b"}, "authors": ["x"]}, {"title": "B", "url_abs": "v", "repository": "https://github.com/c/d"}, {"title": " "}, 5, None]}
    got = payloads.listed_papers(page(spark, body)).orderBy("pos").collect()
    assert [(r.title, r.github_url) for r in got] == [("A", "https://github.com/a/b"), ("B", "https://github.com/c/d")]
    bad = payloads.broken(page(spark, body, {"message": "no"}, "x", None), "$.results").collect()
    assert sorted(r.message for r in bad) == ["body is not JSON", "body is not JSON", "no"]


def test_jobs_formats(spark):
    tagged = [{"legal": "terms"}, {"position": "Dev", "company": "A", "url": "u", "date": "d"}, {"position": "x"}]
    assert [(r.title, r.company, r.is_remote) for r in payloads.tagged_jobs(page(spark, tagged)).collect()] == [("Dev", "A", True)]
    assert payloads.category_jobs(page(spark, [{"title": "T", "company_name": "C", "url": "u"}])).count() == 1
    thread = {"children": [{"text": 'Acme | Dev | x<p><a href="https://a">', "created_at": "2026-01-01T00:00:00Z"}, {"text": "no pipes", "created_at": "2026-01-01T00:00:00Z"}, {"text": "A | B", "created_at": "2026-01-01T00:00:00Z"}, {"text": None}]}
    assert [(r.company, r.title, r.url) for r in payloads.hiring_comments(page(spark, thread)).collect()] == [("Acme", "Dev", "https://a")]
    xml = "<urlset xmlns='n'><url><loc> https://a </loc></url><url><loc>https://a</loc></url><url><loc></loc></url><url><x:loc>https://b?x=1&amp;y=2</x:loc></url></urlset>"
    assert sorted(r.loc for r in payloads.sitemap_urls(page(spark, xml, "<urlset><url><loc>https://c</loc>")).collect()) == ["https://a", "https://b?x=1&y=2"]
    posting = '<script type="application/ld+json">{"@type":"JobPosting","title":"T","hiringOrganization":{"name":"C"}}</script>'
    assert [(r.title, r.url) for r in payloads.posting_pages(page(spark, posting, "<p>")).collect()] == [("T", "u")]


def test_products_and_companies(spark):
    hub = [{"id": "acme/model", "cardData": {"title": "Nice  Model"}, "likes": 3, "sdk": None}, {"modelId": "b/c", "author": "B"}, {"id": "noowner"}, {"id": "acme/model"}]
    got = payloads.hub_products(page(spark, hub), "https://hub.example/", ["likes", "sdk"]).orderBy("pos").collect()
    assert [(r.product_name, r.startup_name, r.metadata_json) for r in got] == [("Nice Model", "acme", {"likes": "3"}), ("c", "B", {})]
    router = {"data": [{"id": "v/m", "name": "Vend: M", "hugging_face_id": "V/M", "context_length": 5}, {"id": "x", "name": "N"}]}
    assert [(r.startup_name, r.dedup_key) for r in payloads.router_products(page(spark, router), "https://r.example/").collect()] == [("Vend", "v/m")]
    body = {"hits": [{"name": "A  B", "slug": "a-b", "team_size": "12"}, {"name": "A", "slug": "a-b"}, {"name": "C", "slug": "c/d"}, {"name": "D", "slug": "d", "team_size": True}, {"name": "E", "slug": "e", "team_size": -1}, {"name": "F", "slug": "f", "team_size": 7}, {"slug": "g"}]}
    pages = spark.createDataFrame([(1, json.dumps(body))], "page_id bigint, body string")
    got = payloads.directory_companies(shapes.page_hits(pages), "p/").orderBy("pos1").collect()
    assert [(r.entity_name, r.employee_count) for r in got] == [("A B", 12), ("D", None), ("E", None), ("F", 7)]
    facets = page(spark, {"facets": {"batch": {"W1": 3, "W2": 0, "W3": "x"}}}, {"facets": 3}, "bad")
    assert [tuple(r) for r in payloads.facet_map(facets, "batch").collect()] == [("W1", 3)]


def test_articles(spark):
    rows = [("s", "https://e.com/1", "T", "bad date", '<meta name="parsely-pub-date" content="2026-01-01T00:00:00Z"><p>' + "word " * 40 + "</p>"), ("s", "https://e.com/2", "U", None, "<p>x</p>")]
    got = payloads.article_records(spark.createDataFrame(rows, "source_name string, link string, title string, feed_date string, page string")).orderBy("url").collect()
    assert got[0].published_at == datetime(2026, 1, 1) and got[0].publication_date_candidates.selected == "parsely-pub-date" and not got[0].extraction_failed
    assert got[1].extraction_failed and got[1].published_at is None


def test_captured_source_and_registry(spark, tmp_path):
    (tmp_path / "a.json").write_text("{}")
    (tmp_path / "b.xml").write_text("<x/>")
    registry.register_sources(spark)
    got = spark.read.format("captured").option("path", str(tmp_path)).option("source", "demo").load().orderBy("ord").collect()
    assert [(r.source_name, r.text, r.ord) for r in got] == [("demo", "{}", 0), ("demo", "<x/>", 1)]
    small = spark.read.format("captured").option("path", str(tmp_path)).option("filesPerPartition", "1").load()
    assert small.rdd.getNumPartitions() == 2 and sorted(r.ord for r in small.collect()) == [0, 1]
    pages = registry.captured_pages(spark, str(tmp_path), "demo").orderBy("ord").collect()
    assert [(r.source_name, r.status_code, r.text) for r in pages] == [("demo", 200, "{}"), ("demo", 200, "<x/>")]
    names = spark.createDataFrame([("a", "news", True), ("b", "news", False)], "name string, vertical string, enabled boolean")
    rows = spark.createDataFrame([("a",), ("b",), ("c",)], "source_name string")
    assert [r.source_name for r in registry.only_enabled(rows, names).collect()] == ["a"]


def test_store_is_idempotent(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    store.create_all()
    rows = spark.createDataFrame([("T", "https://e/1", "s", "x"), ("T2", "https://e/1", "s", "y"), ("T3", "https://e/1", "r", "z")], "title string, url string, source_name string, raw_document_id string")
    assert store.upsert("news", rows, ["raw_document_id"]) == 2
    assert store.upsert("news", rows, ["raw_document_id"]) == 0
    assert store.exists("news", source_name="s", url="https://e/1") and not store.exists("news", source_name="q")
    products = spark.createDataFrame([("a", "s", "u1", "k"), ("b", "s", "u2", "k"), ("c", "s", "u3", None), ("d", "s", "u4", None)], "startup_name string, source_name string, source_url string, dedup_key string")
    assert store.upsert("products", products, ["startup_name"]) == 3
    assert store.upsert("products", products.withColumn("source_url", F.concat("source_url", F.lit("x"))), ["startup_name"]) == 2
    store.append("processing_errors", spark.createDataFrame([("s", "u")], "source_name string, url string"))
    assert store.read("processing_errors").count() == 1
    export(store.read("news"), str(tmp_path / "csv"), "csv")


def test_stream_equals_batch(spark, tmp_path):
    at = datetime(2026, 1, 1, 12)
    rows = [(1, "a", datetime(2026, 1, 1, 11)), (2, "a", datetime(2026, 1, 1, 10)), (3, "b", datetime(2025, 1, 1)), (4, "c", datetime(2026, 1, 2))]
    spark.createDataFrame(rows, "i int, k string, ts timestamp").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("i int, k string, ts timestamp").parquet(str(tmp_path / "in"))
    out = [fresh.run_available(spark, fresh.fresh_stream(stream, "ts", at), str(tmp_path / "out"), str(tmp_path / f"cp{i}"), ["k"], ["ts"]).collect() for i in range(2)]
    assert [[r.i for r in o] for o in out] == [[2], [2]]
    assert fresh.first_seen_stream(stream, ["k"], "ts", "1 hour").isStreaming


def test_streams_read_files_and_folders_of_parts(spark, tmp_path):
    rows = spark.range(100).select("id", F.lit("x").alias("k"))
    rows.repartition(3).write.parquet(str(tmp_path / "many.parquet"))
    rows.coalesce(1).write.parquet(str(tmp_path / "tmp"))
    next((tmp_path / "tmp").glob("part-*")).rename(tmp_path / "one.parquet")
    rows.limit(5).write.parquet(str(tmp_path / "one.parquet-old"))
    for name in ("many", "one"):
        stream = fresh.table_stream(spark, str(tmp_path), name, rows.schema)
        out = fresh.run_available(spark, stream, str(tmp_path / f"out-{name}"), str(tmp_path / f"at-{name}"), ["id"], ["id"])
        assert out.count() == 100
