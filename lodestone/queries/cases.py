"""Sentences on which the rules contend, with what must come out written down by hand, and further operators over whole tables."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import functions as F

from ..operators import acquisition, canonical, chunks, claims, datasets, entities
from ..operators import catalog as cat
from ..sources import jsonl
from . import corpus
from .catalogue import JUDGED_SQL, RETRIEVED_SQL, asked_mentions, json_lines, query, review_items
from .corpus import CATALOG_SQL, CLAIMS_SQL, SENTENCES, VERSIONS_SQL, scored_sql, table, with_chunks

#: text, and the rules' mentions as (type, mention)
ENTITY_CASES = [
    ("The National Climate Policy Institute was founded.", [("POLICY", "National Climate Policy")]),
    ("Commonwealth of Australia law applies.", [("JURISDICTION", "Commonwealth of Australia")]),
    ("South Australia and AUSTRALIA agree.", [("JURISDICTION", "South Australia"), ("JURISDICTION", "AUSTRALIA")]),
    ("Mr John Smith of the Green Council met Jane Doe.", [("PERSON", "Mr John Smith"), ("ORG", "Green Council")]),
    ("Jane Doe spoke.", []),
    ("Dr Clean Energy Fund rose.", [("PROGRAM", "Dr Clean Energy Fund")]),
    ("A Water Act and the Water Plan.", [("POLICY", "Water Act"), ("PROGRAM", "Water Plan")]),
    ('They cite "Clean Air Act" alone.', [("POLICY", "Clean Air Act")]),
    ("The Act passed. Act now.", []),
    ("Bank of Queensland and Reserve Bank.", [("JURISDICTION", "Queensland"), ("ORG", "Reserve Bank")]),
    ("the Northern Territory Framework", [("POLICY", "Northern Territory Framework")]),
    ("Solar Scheme ended. Wind Agency began.", [("PROGRAM", "Solar Scheme"), ("ORG", "Wind Agency")]),
    ("the Green\nJobs Package", [("PROGRAM", "Green\nJobs Package")]),
    ("", []),
]
#: the same for names without a title, where persons need less
NAME_CASES = [
    ("Jane Doe met Sarah Ann Lee in town.", [("PERSON", "Jane Doe"), ("PERSON", "Sarah Ann Lee")]),
    ("Ms Ada Wong met Jane Doe.", [("PERSON", "Ms Ada Wong")]),
    ("Green Council sat.", [("ORG", "Green Council")]),
    ("New South Wales sat.", [("JURISDICTION", "New South Wales")]),
]
#: the gazetteer's, which keeps articles
GAZETTEER_CASES = [
    ("The Green Act and a Blue Fund.", [("POLICY", "The Green Act"), ("PROGRAM", "Blue Fund")]),
    ("An Ocean Plan Bank opens.", [("PROGRAM", "An Ocean Plan"), ("ORG", "An Ocean Plan Bank")]),
]
#: all channels merged: (type, mention, channel)
ENSEMBLE_CASES = [
    ("The Green Act holds.", [("POLICY", "Green Act", "rule")]),
    ("An Ocean Plan Bank opens.", [("PROGRAM", "Ocean Plan", "rule")]),
    ("Dr Ada Lee of Tasmania.", [("PERSON", "Dr Ada Lee", "rule"), ("JURISDICTION", "Tasmania", "rule")]),
]
#: text, and its claims with their confidence
CLAIM_CASES = [
    ("Governments must act.", [("Governments must act.", 1.0)]),
    ("Costs rose 5% in 2020.", [("Costs rose 5% in 2020.", 0.8)]),
    ("The tax reduces waste, the report finds.", [("The tax reduces waste, the report finds.", 0.9)]),
    ("The tax reduces waste.", []),
    ("Table 3: must read.", [("Table 3: must read.", 1.0)]),
    ("Table 3 must read.", []),
    ("References.", []),
    ('"We must act." So it goes.', [('"We must act.', 1.0)]),
    ("\u201cMust act\u201d.", []),
    ("It costs $ 5.", [("It costs $ 5.", 0.8)]),
    ("a | must.", []),
    ("> must.", []),
    ("You must:", []),
    ("Version 3.5 must hold. Next", [("Version 3.5 must hold.", 1.0)]),
    ("  Emissions of 12 Mt  ", [("Emissions of 12 Mt", 0.8)]),
    ("", []),
]


def rows_of(spark, texts):
    made = [(f"case_{i:03}", "s", "d", "c", i, 0, len(t), t) for i, t in enumerate(texts)]
    return spark.createDataFrame(made, "chunk_id string, source_id string, source_document_id string, document_checksum string, chunk_index int, start_char int, end_char int, chunk_text string")


def listed(cases, names: str, empty: str) -> str:
    """The hand-written rows as SQL."""
    quote = lambda v: str(v) if isinstance(v, float) else "'" + v.replace("'", "''") + "'"
    rows = [f"('case_{i:03}', {', '.join(map(quote, row))})" for i, (_, found) in enumerate(cases) for row in found]
    return f"SELECT * FROM (VALUES {', '.join(rows)}) AS t(chunk_id, {names})" if rows else empty


def mentions_of(df):
    return df.select("chunk_id", "entity_type", "mention_text")


@query(listed(ENTITY_CASES, "entity_type, mention_text", ""))
def entity_cases(spark, sf):
    return mentions_of(entities.rule_mentions(rows_of(spark, [t for t, _ in ENTITY_CASES])))


@query(listed(NAME_CASES, "entity_type, mention_text", ""))
def entity_cases_plain_names(spark, sf):
    rules = entities.EntityRules()
    return mentions_of(entities.rule_mentions(rows_of(spark, [t for t, _ in NAME_CASES]), entities.EntityRules(thresholds={**rules.thresholds, "PERSON": 0.4})))


@query(listed(GAZETTEER_CASES, "entity_type, mention_text", ""))
def entity_cases_gazetteer(spark, sf):
    return mentions_of(entities.gazetteer_mentions(rows_of(spark, [t for t, _ in GAZETTEER_CASES])))


@query(listed(ENSEMBLE_CASES, "entity_type, mention_text, channel", ""))
def entity_cases_ensemble(spark, sf):
    return entities.ensemble_mentions(rows_of(spark, [t for t, _ in ENSEMBLE_CASES])).select("chunk_id", "entity_type", "mention_text", F.col("metadata.channel").alias("channel"))


@query("SELECT chunk_id, evidence_text, confidence::DOUBLE AS confidence FROM (" + listed(CLAIM_CASES, "evidence_text, confidence", "") + ")")
def claim_cases(spark, sf):
    return claims.rule_claims(rows_of(spark, [t for t, _ in CLAIM_CASES])).select("chunk_id", "evidence_text", F.round("confidence", 6).alias("confidence"))


# Further operators


@query("SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 1314900 SECOND")
def within_years(spark, sf):
    """Events of the last twenty-fourth of a year, which has 365.25 days, before a fixed time."""
    cutoff = acquisition.cutoff_of(1 / 24, datetime(2024, 1, 31, tzinfo=timezone.utc))
    return table(spark, sf, "events").select("event_id", "ts").where(F.col("ts") >= F.lit(cutoff))


@query("WITH " + VERSIONS_SQL.strip() + " SELECT source_document_id, checksum FROM versions WHERE doc_id % 3 <> 0")
def chunk_incremental_skip(spark, sf):
    """Versions that still need chunks, where a third has them."""
    v = corpus.versions(spark, sf)
    stored = chunks.document_versions(table(spark, sf, "documents").where("doc_id % 3 = 0")).withColumnRenamed("checksum", "document_checksum")
    return chunks.new_versions(v, stored).select("source_document_id", "checksum")


@query(with_chunks(SENTENCES, scored_sql(), CLAIMS_SQL) + " SELECT claim_id, chunk_id FROM claims")
def claim_ids(spark, sf):
    return claims.rule_claims(corpus.chunks(spark, sf)).select("claim_id", "chunk_id")


JACCARD_SQL = RETRIEVED_SQL.replace("top AS (", "unused AS (") + """,
best AS (SELECT *, row_number() OVER (PARTITION BY mention_text, entity_type ORDER BY round(j, 6) DESC, canonical_entity_key) AS rank FROM jac QUALIFY rank <= 3)
"""


@query(JACCARD_SQL + " SELECT mention_text, entity_type, rank::INTEGER AS rank, canonical_entity_key, round(j, 4) AS score FROM best")
def jaccard_topk(spark, sf):
    """The three catalog rows of the largest token Jaccard of every distinct mention: the fused score with one weight alone."""
    r = cat.best_rows(asked_mentions(spark, sf).select(*cat.ASKED).distinct(), corpus.catalog(spark, sf), 3, lexical_weight=1.0, vector_weight=0.0, bonus=0.0)
    return r.select(F.col("normalized_mention_text").alias("mention_text"), "entity_type", "rank", "canonical_entity_key", F.round("fused_score", 4).alias("score"))


@query(with_chunks() + " SELECT 'source_id' AS figure, 0::BIGINT AS only_claims, 0::BIGINT AS only_entities UNION ALL SELECT 'document_checksum', count(DISTINCT document_checksum) FILTER (length(source_document_id) % 2 = 0)::BIGINT, 0::BIGINT FROM chunks")
def staleness_check(spark, sf):
    """Which sources and checksums claims and canonical entities don't have in common, where entities of every other length of a document's name are missing."""
    c = corpus.chunks(spark, sf).select("source_id", "source_document_id", "document_checksum")
    return canonical.differences(c, c.where(F.length("source_document_id") % 2 != 0))


@query(f"WITH {CATALOG_SQL.strip()} SELECT 'v7' AS catalog_version, count(*)::BIGINT AS processed_records, count(*) FILTER (canonical_entity_key NOT LIKE '%7')::BIGINT AS inserted_records, count(*)::BIGINT AS vectors_written FROM catalog")
def catalog_import_report(spark, sf):
    c = corpus.catalog(spark, sf)
    return cat.import_report(c, c.where("canonical_entity_key LIKE '%7'"), "v7").drop("seed_hash")


@query(JUDGED_SQL + """, decided AS (SELECT j.status FROM mentions m JOIN judged j USING (mention_text, entity_type))
 SELECT (SELECT count(*) FROM decided)::BIGINT AS mentions, (SELECT count(*) FROM decided WHERE status <> 'linked')::BIGINT AS queued, (SELECT count(*) FROM decided WHERE status <> 'linked')::BIGINT AS events""")
def resolution_run(spark, sf):
    """Mentions resolved, queued for review and logged in one run on an empty queue."""
    m = asked_mentions(spark, sf)
    items = spark.createDataFrame([], "mention_entity_id string, chunk_id string, mention_text string, entity_type string, decision_status string, decision_score double, selected_candidate_key string, review_state string, created_at string, updated_at string")
    done, queue, events = cat.resolved_and_queued(m, corpus.catalog(spark, sf), items, spark.createDataFrame([], "event_hash string"), "2025")
    one = lambda df, name: df.agg(F.count("*").alias(name)).withColumn("k", F.lit(1))
    return one(done, "mentions").join(one(queue, "queued"), "k").join(one(events, "events"), "k").drop("k")


@query("SELECT user_id::VARCHAR AS mention_entity_id, max(event_type) AS decision_status, max(value) AS decision_score, 'pending' AS review_state FROM events GROUP BY 1")
def review_list(spark, sf):
    return cat.review_list(review_items(spark, sf, "true").withColumn("review_state", F.lit("pending")))


@query("SELECT count(*)::BIGINT AS rows FROM events WHERE event_id % 10 > 3 OR event_id % 10 = 2")
def jsonl_object_count(spark, sf):
    return jsonl.object_count(json_lines(spark, sf, "claims"))


@query("SELECT event_id + 1 AS line_number FROM events WHERE event_id % 10 > 3 OR event_id % 10 = 2 ORDER BY event_id LIMIT 100")
def jsonl_row_cap(spark, sf):
    """The first hundred objects of a file, as a reader with a row cap takes them."""
    return jsonl.objects(json_lines(spark, sf, "claims"), 100).select("line_number")


SPANS_SQL = "g AS (SELECT DISTINCT event_id // 4 AS c, (user_id % 5)::INTEGER AS s FROM events WHERE event_id % 4 <> 0), p AS (SELECT DISTINCT event_id // 4 AS c, (user_id % 5)::INTEGER AS s FROM events WHERE event_id % 4 <> 1)"


@query(f"""WITH {SPANS_SQL}, n AS (SELECT count(*) FILTER (g.c IS NOT NULL AND p.c IS NOT NULL)::DOUBLE AS tp, count(*) FILTER (g.c IS NULL) AS fp, count(*) FILTER (p.c IS NULL) AS fn FROM g FULL JOIN p ON g.c = p.c AND g.s = p.s),
 f AS (SELECT tp / (tp + fp) AS p, tp / (tp + fn) AS r FROM n), x AS (SELECT unnest(['precision', 'recall', 'f1']) AS gate, unnest([0.60::DOUBLE, 0.20::DOUBLE, 0.30::DOUBLE]) AS least, unnest([p, r, 2 * p * r / (p + r)]) AS reached FROM f)
 SELECT 'micro.all.' || gate AS gate, least, round(reached, 6) AS reached, reached >= least AS passed FROM x""")
def claim_gates(spark, sf):
    """Gold and predicted claim spans from the events, four of which make a chunk."""
    def side(condition):
        e = table(spark, sf, "events").where(condition)
        return e.select(F.expr("event_id div 4").alias("chunk_id"), (F.col("user_id") % 5).cast("int").alias("start_char"), (F.col("user_id") % 5 + 1).cast("int").alias("end_char"))

    return datasets.claims_evaluated(side("event_id % 4 <> 0"), side("event_id % 4 <> 1")).withColumn("reached", F.round("reached", 6))


@query("""SELECT 'run' AS labeling_run_id, 'v1' AS dataset_version, (SELECT count(*) FROM conversations)::BIGINT AS sampled_chunks, count(*) FILTER (turn % 3 <> 1 AND length(role) % 2 = 0)::BIGINT AS records_written, coalesce(sum(CASE WHEN turn % 3 <> 1 AND length(role) % 2 = 0 THEN turn % 3 END), 0)::BIGINT AS claims_written,
 count(*) FILTER (turn % 3 = 1)::BIGINT AS parse_failures, count(*) FILTER (turn % 3 = 2 AND length(role) % 2 = 1)::BIGINT + 0 AS invalid_rows FROM (SELECT turn, CASE WHEN turn % 3 = 0 THEN 'even' ELSE role END AS role FROM conversations)""")
def silver_diagnostics(spark, sf):
    """Turns as labelled chunks: a third can't be parsed; of the second third those of roles with an odd name have an empty span."""
    c = table(spark, sf, "conversations")
    odd = F.length("role") % 2
    claim = F.struct(F.lit(0).alias("start_char"), F.when(odd == 1, 0).otherwise(5).alias("end_char"))
    rows = c.select(F.concat_ws("-", "conv_id", "turn").alias("chunk_id"), F.when(F.col("turn") % 3 == 2, F.array(claim, claim)).otherwise(F.array().cast("array<struct<start_char:int,end_char:int>>")).alias("silver_claims"), F.when(F.col("turn") % 3 == 1, "no JSON").alias("parse_error"))
    return datasets.silver_diagnostics(c, rows, "run", "v1")
