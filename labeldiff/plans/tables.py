"""The store's tables: schema and key of each, what must not change under a key, what refers to what, and the version of the whole."""

from __future__ import annotations

#: 2: sections have leave_seq; parts of version 1 are read with null there.
SCHEMA_VERSION = 2
_ITEM = "ingredient_name string, normalized string, discovery_id string, decision_id string, selection string, discovery string, ingestion string, verification string, set_id string, version string, raw_sha256 string, document_id string, quarantine_id string, compatibility string, n_candidates long, n_sections long, n_mapped long, n_unmapped long, n_empty long, manual_review boolean, retry boolean, error string, message string"
_COUNTS = "total long, selected long, fetched long, ingested long, verified long, quarantined long, unresolved long, failed long"

TABLES = {
    "schema": ("version int, at timestamp", ["version"]),
    "raw": ("set_id string, version string, raw_sha256 string, path string, metadata_path string, content binary, container binary, member string, manifest string, retrieved_at timestamp, authority string, provider string, jurisdiction string, source_url string", ["set_id", "version"]),
    "documents": ("document_id string, source_id string, lineage_id string, path string, raw_sha256 string, n_bytes long, set_id string, version string, document_root string, title string, doc_type string, language string, effective date, generic_name string, generics array<string>, ingredients array<string>, brands array<string>, forms array<string>, routes array<string>, normalized_sha256 string, parser_version string, schema_version string, mapping_version string, retrieved_at timestamp", ["document_id"]),
    "sections": ("document_id string, lineage_id string, seq int, parent_seq int, depth int, code string, heading string, text string, status string, locator string, xml_id string, structure string, comparison string, sha256 string, section_id string, parent_id string, leave_seq int", ["section_id"]),
    "products": ("document_id string, seq int, brand string, form string, route string, product_id string", ["product_id"]),
    "ingredients": ("document_id string, seq int, name string, ingredient_id string", ["document_id", "seq"]),
    "mappings": ("document_id string, section_id string, seq int, concept string, method string, confidence double, mapping_id string", ["mapping_id"]),
    "statuses": ("document_id string, concept string, status string", ["document_id", "concept"]),
    "quarantine": ("path string, raw_sha256 string, n_bytes long, content binary, stage string, category string, message string, quarantine_id string", ["quarantine_id"]),
    "ingestion_events": ("run_id string, seq long, state string, path string, raw_sha256 string, category string, message string, at timestamp", ["run_id", "seq"]),
    "history": ("lineage_id string, snapshot_id string, retrieved_at timestamp, position int, version string, published date, published_text string, body string, raw_sha256 string", ["snapshot_id", "position"]),
    "diffs": ("diff_id string, lineage_id string, old_document_id string, new_document_id string, engine string, canonical string, sha256 string, generated_at timestamp", ["diff_id"]),
    "section_diffs": ("section_diff_id string, diff_id string, index int, canonical string, sha256 string", ["section_diff_id"]),
    "edges": ("edge_id string, lineage_id string, old_document_id string, new_document_id string, status string, canonical string, sha256 string", ["edge_id"]),
    "lists": ("utilization_list_id string, canonical string, sha256 string", ["utilization_list_id"]),
    "entries": ("utilization_list_id string, rank int, ingredient_name string, normalized string, metric_value string, metric_unit string, source_row_identifier string", ["utilization_list_id", "rank"]),
    "discoveries": ("discovery_id string, utilization_list_id string, rank int, normalized string, connector string, source_url string, raw_sha256 string, body string, truncated boolean", ["discovery_id"]),
    "candidates": ("candidate_id string, discovery_id string, index int, set_id string, version string, title string, published string, metadata string, metadata_sha256 string, classes array<string>, accepted boolean, reasons array<string>", ["candidate_id"]),
    "decisions": ("decision_id string, discovery_id string, rule string, status string, selected_index int, manual_review boolean, canonical string, sha256 string", ["decision_id"]),
    "lookup_failures": ("discovery_id string, utilization_list_id string, rank int, seq long, category string, message string", ["discovery_id", "seq"]),
    "compatibility": ("document_id string, raw_sha256 string, seq long, status string, message string", ["raw_sha256", "seq"]),
    "batch_runs": (f"run_id string, seq long, utilization_list_id string, status string, {_COUNTS}, artifact_sha256 string, at timestamp", ["run_id", "seq"]),
    "batch_items": (f"run_id string, rank int, seq long, {_ITEM}", ["run_id", "rank", "seq"]),
    "batch_artifacts": ("artifact_id string, run_id string, canonical string, sha256 string", ["artifact_id"]),
}

#: Columns whose values belong to the key for good: a commit that brings others is refused.
CONTENTS = {
    "discoveries": ["normalized", "connector", "raw_sha256", "body", "truncated"],
    "candidates": ["discovery_id", "index", "set_id", "version", "title", "published", "metadata_sha256", "classes", "accepted", "reasons"],
    "decisions": ["discovery_id", "rule", "status", "selected_index", "manual_review", "sha256"],
    "history": ["version", "published_text", "raw_sha256"],
    "edges": ["old_document_id", "new_document_id", "status", "sha256"],
    "section_diffs": ["sha256"],
    "lists": ["sha256"],
}

#: table: [(columns, table that must have them, its key)]; null refers to nothing.
REFERENCES = {
    **{n: [(["document_id"], "documents", ["document_id"])] for n in ("products", "ingredients", "statuses")},
    "sections": [(["document_id"], "documents", ["document_id"]), (["parent_id"], "sections", ["section_id"])],
    "mappings": [(["document_id"], "documents", ["document_id"]), (["section_id"], "sections", ["section_id"])],
    "section_diffs": [(["diff_id"], "diffs", ["diff_id"])],
    "edges": [(["old_document_id"], "documents", ["document_id"]), (["new_document_id"], "documents", ["document_id"])],
    "entries": [(["utilization_list_id"], "lists", ["utilization_list_id"])],
    "discoveries": [(["utilization_list_id"], "lists", ["utilization_list_id"])],
    "candidates": [(["discovery_id"], "discoveries", ["discovery_id"])],
    "decisions": [(["discovery_id"], "discoveries", ["discovery_id"])],
    "batch_items": [(["run_id"], "batch_runs", ["run_id"])],
    "batch_artifacts": [(["run_id"], "batch_runs", ["run_id"])],
}
