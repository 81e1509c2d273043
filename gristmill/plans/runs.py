"""The record pipelines to the end: gate, resolve, raw document, insert, error rows, mapping log, counters, in a Store.

A run is safe to repeat: what takes each row once is keyed (``Store.upsert``), and what is appended (errors, the mapping log)
names its run, so that a run that is already there appends nothing.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.functions import text as tx
from gristmill.operators import dedup, metrics, resolve, validate
from gristmill.plans import pipelines
from gristmill.session import new_path, stage, table
from gristmill.sources.sinks import Store

RUN_TIME = datetime(2026, 6, 1)


def run_entities(store: Store, names: DataFrame, run: str) -> DataFrame:
    """names: row_id, raw_name, source_url, at (a sortable order). Resolves them over the store's entities and aliases, stores
    new ones and the mapping log; (row_id, canonical_entity_id, method) of every row."""
    ordered = stage(names.orderBy("at").select("row_id", "raw_name", "source_url", F.monotonically_increasing_id().alias("ord")), "run-names")
    entities, aliases = store.read("canonical_entities"), store.read("entity_aliases")
    log = resolve.resolve(ordered.select("raw_name", "ord"), entities.select("id", "normalized_name"), aliases.select("canonical_entity_id", "normalized_alias"))
    log = stage(log.join(ordered.select("ord", "row_id", "source_url"), "ord"), "run-log")
    now = F.lit(RUN_TIME).alias("created_at")
    created = log.filter("method = 'created'").select(F.col("canonical_id").alias("id"), F.col("raw_name").alias("canonical_name"), "normalized_name", F.lit("company").alias("entity_type"), now, "ord")
    store.upsert("canonical_entities", created, ["ord"])
    other = log.filter("method in ('fuzzy', 'alias')").select("canonical_id", F.col("raw_name").alias("alias"), F.col("normalized_name").alias("normalized_alias"), "ord")
    store.upsert("entity_aliases", other.withColumnRenamed("canonical_id", "canonical_entity_id"), ["ord"])
    named = store.read("canonical_entities").select(F.col("id").alias("canonical_id"), "canonical_name")
    rows = log.join(named, "canonical_id", "left").withColumnRenamed("canonical_id", "canonical_entity_id")
    store.append_run("entity_mapping_log", rows.select("raw_name", "normalized_name", "canonical_name", "canonical_entity_id", "method", "confidence", "source_url", "review_candidate", now), run)
    return log.select("row_id", F.col("canonical_id").alias("canonical_entity_id"), "method")


def _order(*columns: str) -> Column:
    return F.struct(*columns).alias("at")


def run_errors(store: Store, rows: DataFrame, category: str, run: str, url: str = "url") -> None:
    """Rows that break rules, as rows of the error table. rows: source_name, address, errors."""
    store.append_run("processing_errors", validate.processing_errors(rows, category, url).select("*", F.lit(RUN_TIME).alias("created_at")), run)


def run_jobs(spark: SparkSession, sf_dir: str, store: Store, run: str = "jobs-1") -> DataFrame:
    """Postings into the store; their counters."""
    routed = stage(pipelines.route_jobs(table(spark, sf_dir, "jobs")), "routed-jobs")
    passed = routed.filter("status in ('inserted', 'duplicate')")
    found = run_entities(store, passed.select(F.col("id").alias("row_id"), F.col("company").alias("raw_name"), F.col("url").alias("source_url"), _order("collected_at", "id")), run)
    rows = passed.filter("status = 'inserted'").drop("canonical_entity_id", "posted_at").join(found, F.col("id") == F.col("row_id")).drop("id")
    store.upsert("jobs", rows.withColumnRenamed("posted_ts", "posted_at"), ["collected_at", "row_id"])
    run_errors(store, routed.filter("status = 'invalid'"), "validation_error", run)
    return metrics.run_metrics(routed, "source_name")


def run_news(spark: SparkSession, sf_dir: str, store: Store, run: str = "news-1") -> DataFrame:
    """Articles and their raw documents into the store; their counters."""
    routed = stage(pipelines.route_news(table(spark, sf_dir, "news"), table(spark, sf_dir, "sources")), "routed-news")
    passed = routed.filter("status = 'inserted'").withColumn("content_hash", tx.content_hash(F.col("full_text_location")))
    raw = passed.select("source_name", F.col("url").alias("source_url"), F.lit(200).alias("http_status"), "content_hash", F.col("full_text_location").alias("raw_content_location"), F.lit("extracted").alias("extraction_status"), F.col("collected_at").alias("retrieved_at"), F.lit(run).alias("crawl_run_id"), F.col("id").alias("row_id"))
    store.upsert("raw_documents", raw, ["retrieved_at", "row_id"])
    rows = passed.withColumn("raw_document_id", store.id_of("raw_documents", "content_hash")).withColumn("published_at", F.col("moment")).withColumnRenamed("id", "row_id")
    store.upsert("news", rows, ["collected_at", "row_id"])
    run_errors(store, routed.filter("status = 'invalid'"), "validation_error", run)
    return metrics.run_metrics(routed, "source_name")


def run_startups(spark: SparkSession, sf_dir: str, store: Store, run: str = "startups-1") -> DataFrame:
    """Directory companies into the store; their counters."""
    rows = stage(pipelines.pipeline_startups(spark, sf_dir).withColumn("source_name", F.lit("yc_directory")), "run-startups")
    checked = stage(validate.validate(rows, validate.startup_rules()), "checked-startups")
    good = checked.filter(F.size("errors") == 0)
    found = run_entities(store, good.select(F.col("source_url").alias("row_id"), F.col("entity_name").alias("raw_name"), "source_url", _order("page_id", "pos1")), run)
    inserted = store.upsert("startups", good.join(found, F.col("source_url") == F.col("row_id")), ["page_id", "pos1"])
    run_errors(store, checked.filter(F.size("errors") > 0), "ValidationError", run, "source_url")
    return checked.groupBy("source_name").agg(F.count("*").alias("discovered"), F.count_if(F.size("errors") > 0).alias("invalid")).withColumn("inserted", F.lit(inserted))


def run_products(spark: SparkSession, sf_dir: str, store: Store, run: str = "products-1") -> DataFrame:
    """Products into the store, sources in their fixed order; (source_name, outcome, n)."""
    rank = F.coalesce(F.array_position(F.array(*[F.lit(s) for s in pipelines.PRODUCT_ORDER]), F.col("source_name")), F.lit(0))
    rows = pipelines.product_rows(spark, sf_dir).withColumn("source_rank", F.when(rank > 0, rank).otherwise(len(pipelines.PRODUCT_ORDER) + 1))
    checked = stage(validate.validate(rows, validate.product_rules()), "checked-products")
    outcome = stage(dedup.two_key_dedup(checked.filter(F.size("errors") == 0).drop("errors"), "source_url", "dedup_key", ["source_rank", "ord", "id"]), "run-products")
    kept = outcome.filter("outcome = 'kept'")
    found = run_entities(store, kept.select(F.col("id").alias("row_id"), F.col("startup_name").alias("raw_name"), "source_url", _order("source_rank", "ord", "id")), run)
    store.upsert("products", kept.join(found, F.col("id") == F.col("row_id")).drop("id"), ["source_rank", "ord", "row_id"])
    run_errors(store, checked.filter(F.size("errors") > 0), "ValidationError", run, "source_url")
    return outcome.groupBy("source_name", "outcome").agg(F.count("*").alias("n"))


def new_store(spark: SparkSession) -> Store:
    store = Store(spark, new_path(spark, "store"))
    store.create_all()
    return store


def pipeline_jobs_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored postings with the entity of their company."""
    store = new_store(spark)
    run_jobs(spark, sf_dir, store)
    return store.read("jobs").select("source_name", "url", "company", "posted_at", "canonical_entity_id")


def pipeline_products_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored products with the entity of their maker."""
    store = new_store(spark)
    run_products(spark, sf_dir, store)
    return store.read("products").select("source_name", "source_url", "product_name", "startup_name", "canonical_entity_id")


def pipeline_news_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored articles with the content and the first address of their raw document."""
    store = new_store(spark)
    run_news(spark, sf_dir, store)
    raw = store.read("raw_documents").select(F.col("id").alias("raw_document_id"), "content_hash", F.col("source_url").alias("first_url"))
    return store.read("news").join(raw, "raw_document_id", "left").select("source_name", "url", "published_at", "content_hash", "first_url")


def pipeline_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The error table after a run of every pipeline."""
    store = new_store(spark)
    for run in (run_news, run_jobs, run_startups, run_products):
        run(spark, sf_dir, store)
    return store.read("processing_errors").select("crawl_run_id", "source_name", "url", "error_category", "message")


def pipeline_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(run, tbl, n): rows of each table of the store after one run of the jobs and news pipelines and after another."""
    store = new_store(spark)
    parts = None
    for run in (1, 2):
        run_jobs(spark, sf_dir, store)
        run_news(spark, sf_dir, store)
        for tbl in ("jobs", "news", "raw_documents", "canonical_entities", "entity_aliases", "entity_mapping_log", "processing_errors"):
            n = store.read(tbl).count()
            part = spark.range(1).select(F.lit(run).alias("run"), F.lit(tbl).alias("tbl"), F.lit(n).cast("bigint").alias("n"))
            parts = part if parts is None else parts.unionByName(part)
    return parts


QUERIES = {f.__name__: f for f in (pipeline_jobs_entities, pipeline_products_entities, pipeline_news_provenance, pipeline_errors, pipeline_rerun)}
ORACLES: dict[str, str] = {}
