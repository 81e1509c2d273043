"""The pipelines' company names reach the resolver."""

from gristmill.operators import resolve
from gristmill.plans import pipelines, runs

FOLDER = "/root/testdata/sf0.01"


def test_every_pipeline_resolves_its_names(spark):
    log = pipelines.pipeline_entities(spark, FOLDER).collect()
    want = {("startups", r.source_url) for r in pipelines.pipeline_startups(spark, FOLDER).collect()}
    want |= {("products", r.id) for r in pipelines.pipeline_products(spark, FOLDER).collect() if r.outcome == "kept"}
    want |= {("jobs", r.id) for r in pipelines.pipeline_jobs(spark, FOLDER).collect() if r.status in ("inserted", "duplicate")}
    assert len(log) == len(want) and {(r.vertical, r.id) for r in log} == want
    assert all((r.canonical_id is None) == (r.method == "unresolved") for r in log)
    assert {"created", "fuzzy", "normalized_exact"} <= {r.method for r in log}
    ids = {r.normalized_name: r.canonical_id for r in log if r.method != "unresolved"}
    assert all(ids[r.normalized_name] == r.canonical_id for r in log if r.canonical_id)  # one meaning of a key over all three
    assert {r.vertical for r in log if r.method != "created"} >= {"jobs", "products"}  # links to what an earlier run created


def test_common_subsequence():
    assert [resolve.common_subsequence(*p) for p in (("", "a"), ("abcbdab", "bdcaba"), ("x" * 90, "x" * 80 + "y"))] == [0, 4, 80]


def test_runs_are_safe_to_repeat_and_share_entities(spark):
    store = runs.new_store(spark)
    first = {r.source_name: r.inserted for r in runs.run_startups(spark, FOLDER, store).collect()}
    runs.run_jobs(spark, FOLDER, store)
    tables = ("startups", "jobs", "canonical_entities", "entity_aliases", "entity_mapping_log", "processing_errors")
    counts = [store.read(t).count() for t in tables]
    assert first["yc_directory"] == counts[0] > 0 and min(counts) > 0
    runs.run_startups(spark, FOLDER, store)
    runs.run_jobs(spark, FOLDER, store)
    assert [store.read(t).count() for t in tables] == counts
    ids = {r.id for r in store.read("canonical_entities").collect()}
    linked = [r.canonical_entity_id for t in ("startups", "jobs") for r in store.read(t).collect()]
    assert {i for i in linked if i} <= ids and sum(i is not None for i in linked) > 0.9 * len(linked)
    log = store.read("entity_mapping_log").collect()
    assert {r.crawl_run_id for r in log} == {"startups-1", "jobs-1"} and all(r.canonical_name for r in log if r.canonical_entity_id)


def test_the_first_source_in_order_wins_a_product(spark, tmp_path):
    rows = [("a", "product", '{"product_name": "X", "startup_name": "S"}', "orbit_index", "https://o.example/1", 1), ("b", "product", '{"product_name": "x", "startup_name": "S"}', "vendorpages", "https://v.example/1", 9), ("c", "product", '{"product_name": "Y"}', "vendorpages", "https://v.example/2", 2)]
    spark.createDataFrame(rows, "id string, record_type string, data string, source_name string, source_url string, ord bigint").write.parquet(str(tmp_path / "parsed_records.parquet"))
    store = runs.new_store(spark)
    runs.run_products(spark, str(tmp_path), store)
    assert [(r.source_name, r.product_name) for r in store.read("products").collect()] == [("vendorpages", "x")]
    assert [(r.error_category, r.message) for r in store.read("processing_errors").collect()] == [("ValidationError", "startup_name: must not be blank")]
