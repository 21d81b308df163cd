"""Identifiers: SHA-256 of fields joined by a pipe character."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def joined(*fields: Column) -> Column:
    """Fields as text with pipes between; a null field is empty, as concat_ws would skip it."""
    return F.concat_ws("|", *(F.coalesce(f.cast("string"), F.lit("")) for f in fields))


def full_hash(*fields: Column) -> Column:
    return F.sha2(joined(*fields), 256)


def short_id(prefix: str, *fields: Column) -> Column:
    return F.concat(F.lit(f"{prefix}_"), F.substring(full_hash(*fields), 1, 16))


def checksum(content: Column) -> Column:
    return F.sha2(content, 256)


def chunk_id(source_id: Column, source_document_id: Column, document_checksum: Column, chunk_index: Column, start: Column, end: Column) -> Column:
    return short_id("chunk", source_id, source_document_id, document_checksum, chunk_index, start, end)


def claim_id(chunk: Column, start: Column, end: Column, normalized_text: Column, version: Column) -> Column:
    return short_id("claim", chunk, start, end, normalized_text, version)


def entity_id(chunk: Column, start: Column, end: Column, entity_type: Column, version: Column) -> Column:
    return short_id("entity", chunk, start, end, entity_type, version)


def canonical_entity_key(entity_type: Column, canonical_name: Column) -> Column:
    return short_id("entity_canon", entity_type, canonical_name)


def publisher_node(source_id: Column) -> Column:
    return F.concat(F.lit("publisher:"), F.sha2(source_id, 256))


def entity_node(entity_type: Column, key: Column) -> Column:
    return F.concat(F.lit("entity:"), full_hash(entity_type, key))


def edge(edge_type: Column, source: Column, target: Column, *scope: Column) -> Column:
    return F.concat(F.lit("edge:"), full_hash(edge_type, source, target, *scope))


def pseudo_time(stage: Column, version: Column, input_hash: Column) -> Column:
    """A time that depends on the inputs alone: 12 hex digits of their hash as seconds below 2e9."""
    seconds = F.conv(F.substring(full_hash(stage, version, input_hash), 1, 12), 16, 10).cast("long") % 2_000_000_000
    return F.timestamp_seconds(seconds)


def split_rank(seed: int | str, record_id: Column) -> Column:
    return F.sha2(F.concat(F.lit(f"{seed}:"), record_id.cast("string")), 256)
