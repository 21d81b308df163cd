"""Validation of JSON-lines inputs: nothing aborts, everything that is wrong becomes a row of schemas.ANOMALY."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fields that a row must have.
CLAIM_FIELDS = ("claim_id", "chunk_id", "source_id", "source_document_id", "document_checksum", "start_char", "end_char", "evidence_text", "normalized_claim_text", "confidence", "extractor_version")
ENTITY_FIELDS = ("entity_id", "chunk_id", "source_id", "source_document_id", "document_checksum", "start_char", "end_char", "mention_text", "normalized_mention_text", "entity_type", "confidence", "extractor_version")


# Output that must match, as readers look for these messages.
NO_JSON, NO_OBJECT = "Invalid JSON row", "Row payload is not a JSON object"
MISSING_FIELDS, MISSING_CHUNK = "Missing {} fields: ", "{} references missing chunk_id"


def anomaly(rows: DataFrame, category: str, message) -> DataFrame:
    return rows.select(F.lit(category).alias("category"), F.lit("error").alias("severity"), message.alias("message"), "source_path", "line_number")


def parsed(lines: DataFrame) -> DataFrame:
    """lines (source_path, line_number, line) with the value as VARIANT, its kind, and keys of an object; blank lines dropped."""
    v = lines.where(~F.col("line").rlike(r"^\s*$")).withColumn("v", F.try_parse_json("line"))
    kind = F.schema_of_variant("v")
    return v.withColumn("is_object", F.coalesce(F.startswith(kind, F.lit("OBJECT")), F.lit(False))).withColumn("keys", F.when(F.col("is_object"), F.json_object_keys("line")))


def parse_anomalies(p: DataFrame) -> DataFrame:
    bad = anomaly(p.where(F.col("v").isNull()), "json_decode_error", F.lit(NO_JSON))
    return bad.unionByName(anomaly(p.where(F.col("v").isNotNull() & ~F.col("is_object")), "json_not_object", F.lit(NO_OBJECT)))


def chunk_ids(p: DataFrame) -> DataFrame:
    return p.where("is_object").select(F.try_variant_get("v", "$.chunk_id", "string").alias("chunk_id")).where("chunk_id <> ''").distinct()


def reference_anomalies(p: DataFrame, known_chunks: DataFrame, fields: tuple[str, ...], what: str) -> DataFrame:
    """Rows without a field, and rows whose chunk doesn't exist. A field that is null is there."""
    missing = F.array_sort(F.array_except(F.array(*map(F.lit, fields)), "keys"))
    rows = p.where("is_object").withColumn("missing", missing)
    out = anomaly(rows.where(F.size("missing") > 0), f"missing_{what}_fields", F.concat(F.lit(MISSING_FIELDS.format(what)), F.array_join("missing", ", ")))
    whole = rows.where(F.size("missing") == 0).withColumn("chunk_id", F.try_variant_get("v", "$.chunk_id", "string"))
    orphans = whole.join(known_chunks, "chunk_id", "left_anti")
    return out.unionByName(anomaly(orphans, f"orphan_{what}_chunk", F.lit(MISSING_CHUNK.format(what.title()))))


def anomalies(chunks: DataFrame, claims: DataFrame, entities: DataFrame) -> DataFrame:
    """All anomalies of the three inputs, each as lines (source_path, line_number, line)."""
    c, cl, en = parsed(chunks), parsed(claims), parsed(entities)
    known = chunk_ids(c)
    out = parse_anomalies(c).unionByName(parse_anomalies(cl)).unionByName(parse_anomalies(en))
    return out.unionByName(reference_anomalies(cl, known, CLAIM_FIELDS, "claim")).unionByName(reference_anomalies(en, known, ENTITY_FIELDS, "entity"))


def by_category(rows: DataFrame) -> DataFrame:
    return rows.groupBy("category").agg(F.count("*").alias("n"))


def exit_code(rows: DataFrame, most: int = 0) -> int:
    return int(rows.limit(most + 1).count() > most)
