"""Schemas of the engine's tables; offsets are code points from 0, ends exclusive."""

VERSION = "source_id string, source_document_id string, source_url string, published_at string, retrieved_at string, checksum string, normalized_text string, raw_content_ref string, content_type string, created_at string, updated_at string"
CHUNK = "chunk_id string, source_id string, source_document_id string, document_checksum string, chunk_index int, start_char int, end_char int, chunk_text string"
CLAIM = "claim_id string, chunk_id string, source_id string, source_document_id string, document_checksum string, start_char int, end_char int, evidence_text string, normalized_claim_text string, confidence double, claim_type string, extractor_version string"
CANDIDATE = "struct<canonical_entity_key: string, canonical_name: string, entity_type: string, fused_score: double, lexical_score: double, vector_score: double>"
METADATA = f"struct<channel: string, spacy_label: string, coref_canonical: string, decision_status: string, decision_score: double, reason_codes: array<string>, selected_candidate_key: string, top_candidates: array<{CANDIDATE}>>"
MENTION = f"entity_id string, chunk_id string, source_id string, source_document_id string, document_checksum string, start_char int, end_char int, mention_text string, normalized_mention_text string, entity_type string, confidence double, extractor_version string, canonical_entity_key string, metadata {METADATA}"
CATALOG = "canonical_entity_key string, canonical_name string, entity_type string, aliases array<string>"
ANOMALY = "category string, severity string, message string, source_path string, line_number long"
DISCOVERED = "source_url string, published_at string"
ENTITY_TYPES = ("POLICY", "ORG", "PERSON", "JURISDICTION", "PROGRAM")
