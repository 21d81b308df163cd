"""Inputs of the queries: tables, and a templated corpus on which all extraction rules fire.

The corpus is a join of orders, customer, nation and part whose columns fill sentences; the same template is given as
SQL for the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import ids
from ..operators.chunks import document_versions

PLACES = ("Queensland", "New South Wales", "South Australia", "Tasmania", "Victoria")
TYPES = ("POLICY", "ORG", "PERSON", "JURISDICTION", "PROGRAM")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def title(c):
    return F.initcap(F.lower(c))


def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, c, n, p = (table(spark, sf_dir, x) for x in ("orders", "customer", "nation", "part"))
    part = p.select(F.col("p_partkey").alias("k"), title(F.col("p_name")).alias("name"), title(F.col("p_type")).alias("kind"), "p_size").where("k > -200 AND k < 200")  # all that the join can meet
    place = F.get(F.array(*map(F.lit, PLACES)), F.col("n_nationkey") % 5)
    o = o.select("o_orderkey", "o_custkey", "o_totalprice").repartition("o_orderkey")  # texts are made and read in even tasks, however few splits the table has
    j = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey).join(F.broadcast(part), F.col("k") == o.o_orderkey % 200)
    odd = F.when(F.col("o_orderkey") % 4 == 0, F.lit("References. ")).when(F.col("o_orderkey") % 4 == 1, F.concat(F.lit("Prices rose by $"), F.floor(F.col("o_totalprice") / 1000).cast("string"), F.lit(" in 1997. "))).when(F.col("o_orderkey") % 4 == 2, F.lit("Table 3: results. ")).otherwise(F.lit('"A quoted line." '))
    body = F.concat(
        F.lit("The "), "name", F.lit(" Act must reduce costs by "), F.col("p_size").cast("string"), F.lit(" million. Dr Ada "), "kind", F.lit(" of the "), "kind", F.lit(" Institute argues that "), place,
        F.lit(" needs the "), "name", F.lit(" Plan. "), odd, F.lit("Nothing follows"),
    )
    rows = j.select(
        F.lower("c_mktsegment").alias("source_id"), F.concat(F.lit("https://data.example.org/orders/"), F.expr("o_orderkey div 8").cast("string")).alias("source_document_id"), (F.col("o_orderkey") % 8).cast("int").alias("chunk_index"), F.lit(0).alias("start_char"), body.alias("chunk_text"),
    )
    rows = rows.withColumn("document_checksum", F.sha2("source_document_id", 256)).withColumn("end_char", F.length("chunk_text"))
    key = ids.chunk_id(*(F.col(x) for x in ("source_id", "source_document_id", "document_checksum", "chunk_index", "start_char", "end_char")))
    return rows.select(key.alias("chunk_id"), "source_id", "source_document_id", "document_checksum", "chunk_index", "start_char", "end_char", "chunk_text")


#: The same as SQL for the oracle; also the sentences of each chunk.
CHUNKS_SQL = """
filled AS (SELECT o_orderkey, o_totalprice, lower(c_mktsegment) AS source_id, 'https://data.example.org/orders/' || (o_orderkey // 8)::VARCHAR AS source_document_id,
  upper(substr(split_part(p_name, ' ', 1), 1, 1)) || lower(substr(split_part(p_name, ' ', 1), 2)) || ' ' || upper(substr(split_part(p_name, ' ', 2), 1, 1)) || lower(substr(split_part(p_name, ' ', 2), 2)) AS name,
  upper(substr(p_type, 1, 1)) || lower(substr(p_type, 2)) AS kind, p_size, ['Queensland', 'New South Wales', 'South Australia', 'Tasmania', 'Victoria'][n_nationkey % 5 + 1] AS place
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN part ON p_partkey = o_orderkey % 200),
worded AS (SELECT *, sha256(source_document_id) AS document_checksum, (o_orderkey % 8)::INTEGER AS chunk_index, 'The ' || name || ' Act must reduce costs by ' || p_size || ' million. Dr Ada ' || kind || ' of the ' || kind || ' Institute argues that ' || place || ' needs the ' || name || ' Plan. ' ||
  CASE o_orderkey % 4 WHEN 0 THEN 'References. ' WHEN 1 THEN 'Prices rose by $' || floor(o_totalprice / 1000)::BIGINT || ' in 1997. ' WHEN 2 THEN 'Table 3: results. ' ELSE '"A quoted line." ' END || 'Nothing follows' AS chunk_text FROM filled),
chunks AS (SELECT 'chunk_' || substr(sha256(source_id || '|' || source_document_id || '|' || document_checksum || '|' || chunk_index || '|0|' || length(chunk_text)), 1, 16) AS chunk_id, *, 0 AS start_char, length(chunk_text)::INTEGER AS end_char FROM worded)
"""


def sentences_sql(rows: str, key: str, text: str) -> str:
    """CTEs pieces and sentences (key, position, text, start_char, end_char) of a relation."""
    pattern = r"(?:[0-9]+(?:\.[0-9]+)*|[^.!?0-9])*[.!?]|(?:[0-9]+(?:\.[0-9]+)*|[^.!?0-9])+$"
    return f"""
split_up AS (SELECT {key}, unnest(regexp_extract_all({text}, '{pattern}')) AS piece, generate_subscripts(regexp_extract_all({text}, '{pattern}'), 1) AS n FROM {rows}),
placed AS (SELECT *, coalesce(sum(length(piece)) OVER (PARTITION BY {key} ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::INTEGER AS upto FROM split_up),
cut AS (SELECT *, regexp_replace(piece, '^\\s+', '') AS lefty FROM placed),
trimmed AS (SELECT *, regexp_replace(lefty, '\\s+$', '') AS text FROM cut),
sentences AS (SELECT {key}, (row_number() OVER (PARTITION BY {key} ORDER BY n) - 1)::INTEGER AS position, text, (upto + length(piece) - length(lefty))::INTEGER AS start_char, (upto + length(piece) - length(lefty) + length(text))::INTEGER AS end_char FROM trimmed WHERE text <> '')
"""


def any_of(column: str, words) -> str:
    return "(" + " OR ".join(f"contains({column}, '{w}')" for w in words) + ")"


def scored_sql() -> str:
    """CTE scored: sentences of the templated chunks with cue flags, skipped and score."""
    from ..functions import text as t

    heads = ", ".join(f"'{h}'" for h in t.HEADINGS)
    quantity = r"(?i)(\b\d+(?:[.,]\d+)?%\b|\$\s?\d+(?:[.,]\d+)?|\b\d+(?:[.,]\d+)?\s*(?:billion|million|tonnes|tons|kt|mt)\b|\b\d{4}\b)"
    numbered = r"(?i)^(table|figure|fig\.?|appendix|chapter|section)\s+[A-Za-z0-9\-]+(?:\s+[A-Za-z0-9\-]+)*(?:[:.-]+)?$"
    return f"""
flagged AS (SELECT *, regexp_replace(trim(text), '\\s+', ' ', 'g') AS norm, {any_of("lower(text)", t.MODALITY)} AS modality, regexp_matches(text, '{quantity}') AS quantity, {any_of("lower(text)", t.CAUSAL)} AS causal, {any_of("lower(text)", t.ATTRIBUTION)} AS attribution FROM sentences),
scored AS (SELECT *, (rtrim(lower(norm), '.:;,-') IN ({heads}) OR regexp_matches(norm, '{numbered}') OR regexp_matches(norm, '^[A-Za-z][A-Za-z\\s]{{0,40}}:$') OR norm LIKE '%:' OR norm LIKE '%:.' OR contains(norm, '|') OR norm LIKE '>%'
  OR (length(rtrim(norm, '.:;,-')) >= 2 AND (rtrim(norm, '.:;,-') LIKE '"%"' OR rtrim(norm, '.:;,-') LIKE '''%''' OR rtrim(norm, '.:;,-') LIKE '“%”'))) AS skipped,
  (CASE WHEN modality THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END + CASE WHEN quantity THEN 0.8::DOUBLE ELSE 0.0::DOUBLE END + CASE WHEN causal THEN 0.6::DOUBLE ELSE 0.0::DOUBLE END + CASE WHEN attribution THEN 0.3::DOUBLE ELSE 0.0::DOUBLE END) AS score FROM flagged)
"""


CLAIMS_SQL = """
claims AS (SELECT 'claim_' || substr(sha256(chunk_id || '|' || s.start_char || '|' || s.end_char || '|' || norm || '|rules-v1'), 1, 16) AS claim_id, c.chunk_id, c.source_id, c.source_document_id, c.document_checksum, s.start_char, s.end_char, s.text AS evidence_text, norm AS normalized_claim_text, least(1.0::DOUBLE, score) AS confidence
  FROM scored s JOIN chunks c USING (chunk_id) WHERE NOT skipped AND score >= 0.8)
"""


def mentions_sql(version: str = "rules-v1") -> str:
    """CTE mentions of the templated chunks, from what the template put where."""
    return f"""
put AS (SELECT chunk_id, source_id, source_document_id, document_checksum, unnest([name || ' Act', 'Dr Ada ' || kind, kind || ' Institute', place, name || ' Plan']) AS mention_text, unnest(['POLICY', 'PERSON', 'ORG', 'JURISDICTION', 'PROGRAM']) AS entity_type, chunk_text FROM chunks),
mentions AS (SELECT 'entity_' || substr(sha256(chunk_id || '|' || (instr(chunk_text, mention_text) - 1) || '|' || (instr(chunk_text, mention_text) - 1 + length(mention_text)) || '|' || entity_type || '|{version}'), 1, 16) AS entity_id,
  chunk_id, source_id, source_document_id, document_checksum, (instr(chunk_text, mention_text) - 1)::INTEGER AS start_char, (instr(chunk_text, mention_text) - 1 + length(mention_text))::INTEGER AS end_char, mention_text, entity_type, 1.0::DOUBLE AS confidence FROM put)
"""


def with_chunks(*ctes: str) -> str:
    return "WITH " + ",".join(x.strip() for x in (CHUNKS_SQL, *ctes))


SENTENCES = sentences_sql("chunks", "chunk_id", "chunk_text")


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part table as an entity catalog."""
    p = table(spark, sf_dir, "part")
    kind = F.get(F.array(*map(F.lit, TYPES)), F.col("p_size") % 5)
    return p.select(F.concat(F.lit("part_"), F.lpad(F.col("p_partkey").cast("string"), 9, "0")).alias("canonical_entity_key"), title(F.col("p_name")).alias("canonical_name"), kind.alias("entity_type"), F.array("p_brand", "p_name").alias("aliases"))


CATALOG_SQL = """
catalog AS (SELECT 'part_' || lpad(p_partkey::VARCHAR, 9, '0') AS canonical_entity_key, upper(substr(split_part(p_name, ' ', 1), 1, 1)) || lower(substr(split_part(p_name, ' ', 1), 2)) || ' ' || upper(substr(split_part(p_name, ' ', 2), 1, 1)) || lower(substr(split_part(p_name, ' ', 2), 2)) AS canonical_name,
  ['POLICY', 'ORG', 'PERSON', 'JURISDICTION', 'PROGRAM'][p_size % 5 + 1] AS entity_type, p_brand, p_name FROM part),
tokened AS (SELECT *, list_sort(list_distinct(list_filter(string_split_regex(lower(canonical_name || ' ' || p_brand || ' ' || p_name), '[^a-z0-9]+'), lambda t: t <> ''))) AS tokens FROM catalog)
"""


def versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_versions(table(spark, sf_dir, "documents"))


VERSIONS_SQL = r"""
versions AS (SELECT doc_id, source AS source_id, 'https://corpus.example.org/doc/' || doc_id AS source_document_id, sha256(coalesce(text, '')) AS checksum, trim(regexp_replace(text, '\s+', ' ', 'g')) AS body FROM documents)
"""
