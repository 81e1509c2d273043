"""Explicit schemas of the persisted tables; nothing is inferred."""

TABLES = {
    "research_papers": "title string, authors array<string>, paper_url string, paper_external_id string, github_url string, github_stars int, published_date timestamp, source_name string, raw_document_id string, collected_at timestamp",
    "news": "title string, url string, source_name string, published_at timestamp, full_text_location string, extracted_metadata map<string,string>, raw_document_id string, collected_at timestamp",
    "jobs": "company string, canonical_entity_id string, title string, url string, posted_at timestamp, is_remote boolean, role_family string, source_name string, raw_document_id string, metadata_json map<string,string>, collected_at timestamp",
    "startups": "entity_name string, canonical_entity_id string, source_name string, source_url string, employee_count int, raw_document_id string, collected_at timestamp",
    "products": "product_name string, startup_name string, canonical_entity_id string, source_name string, source_url string, source_external_id string, dedup_key string, metadata_json map<string,string>, raw_document_id string, collected_at timestamp",
    "raw_documents": "source_name string, source_url string, canonical_url string, retrieved_at timestamp, http_status int, content_hash string, raw_content_location string, extraction_status string, publication_date_candidates map<string,string>, crawl_run_id string",
    "canonical_entities": "canonical_name string, normalized_name string, entity_type string, created_at timestamp",
    "entity_aliases": "canonical_entity_id string, alias string, normalized_alias string",
    "entity_mapping_log": "crawl_run_id string, raw_name string, normalized_name string, canonical_name string, canonical_entity_id string, method string, confidence double, source_url string, review_candidate string, created_at timestamp",
    "processing_errors": "crawl_run_id string, source_name string, url string, error_category string, message string, context map<string,string>, created_at timestamp",
    "llm_requests": "provider string, model string, request_id string, source_url string, record_type string, input_size_chars int, estimated_tokens int, output_size_chars int, latency_ms int, status string, retry_count int, fallback_used boolean, error_type string, created_at timestamp",
    "sources": "name string, vertical string, base_url string, discovery_mechanism string, enabled boolean, created_at timestamp",
    "crawl_runs": "vertical string, started_at timestamp, finished_at timestamp, status string, target_records int, stats map<string,string>",
    "crawl_jobs": "crawl_run_id string, source_name string, url string, normalized_url string, status string, attempts int, last_error string, created_at timestamp, updated_at timestamp",
}

#: Columns that identify a row of each table that takes each row once.
NATURAL_KEYS = {
    "research_papers": ["paper_url"],
    "news": ["source_name", "url"],
    "jobs": ["source_name", "url"],
    "startups": ["source_name", "source_url"],
    "products": ["source_name", "source_url"],
    "raw_documents": ["content_hash"],
    "canonical_entities": ["normalized_name"],
    "entity_aliases": ["normalized_alias"],
    "sources": ["name"],
    "crawl_jobs": ["crawl_run_id", "normalized_url"],
}


def ddl(table: str) -> str:
    """The table's schema with its deterministic identifier."""
    return f"id string, {TABLES[table]}"
