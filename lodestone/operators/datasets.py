"""Labelled datasets: contracts, quality figures, splits, samples, aggregation, evaluation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import ids
from ..functions.text import safe_divide
from ..schemas import ENTITY_TYPES

LABELERS = ("llm", "rule", "human")
TEXTS = ("chunk_id", "source_id", "source_document_id", "document_checksum", "chunk_text", "labeling_run_id", "labeler_version", "label_prompt_version", "dataset_version", "labeled_at_utc")


def contract_faults(rows: DataFrame, spans: str, with_types: bool = False) -> Column:
    """Names of the rules that a silver row breaks: required texts, labeller kinds, spans, and for entities types and mentions."""
    checks = [F.when(F.coalesce(F.trim(F.col(c)), F.lit("")) == "", f"{c}_missing") for c in TEXTS if c in rows.columns]
    checks.append(F.when(~F.coalesce(F.col("labeler_kind").isin(*LABELERS), F.lit(False)), "labeler_kind_invalid"))
    checks.append(F.when(F.col(spans).isNull(), f"{spans}_missing"))
    checks.append(F.when(F.exists(spans, lambda s: (s["start_char"] < 0) | (s["end_char"] <= s["start_char"])), "span_invalid"))
    if with_types:
        checks.append(F.when(F.exists(spans, lambda s: ~F.coalesce(s["entity_type"].isin(*ENTITY_TYPES), F.lit(False))), "entity_type_invalid"))
        checks.append(F.when(F.exists(spans, lambda s: F.coalesce(s["mention_text"], F.lit("")) == ""), "mention_text_missing"))
    return F.filter(F.array(*checks), lambda x: x.isNotNull())


def quality(rows: DataFrame, spans: str, with_types: bool = False) -> DataFrame:
    """One row: rows, invalid ones, those without labels and their rate, spans, spans whose text isn't the mention's."""
    r = rows.withColumn("faults", contract_faults(rows, spans, with_types))
    good = F.size("faults") == 0
    off = F.size(F.filter(spans, lambda s: F.col("chunk_text").substr(s["start_char"] + 1, s["end_char"] - s["start_char"]) != s["mention_text"])) if with_types else F.lit(0)
    q = r.agg(
        F.count("*").alias("total_rows"), F.count_if(~good).alias("invalid_rows"), F.count_if(good & (F.size(spans) == 0)).alias("empty_rows"), F.coalesce(F.sum(F.when(good, F.size(spans))), F.lit(0)).cast("long").alias("span_count"),
        F.coalesce(F.sum(F.when(good, off)), F.lit(0)).cast("long").alias("offset_mismatches"), F.count_if(good).alias("_valid"),
    )
    return q.withColumn("empty_label_rate", safe_divide(F.col("empty_rows"), F.col("_valid"))).drop("_valid")


def type_histogram(rows: DataFrame, spans: str) -> DataFrame:
    return rows.select(F.explode(spans).alias("s")).groupBy(F.col("s.entity_type").alias("entity_type")).agg(F.count("*").alias("n"))


def aggregated(rows: DataFrame, position: str, spans: str = "silver_claims") -> DataFrame:
    """Rows of one chunk as one: distinct spans sorted, the first row's other fields. Invalid spans are dropped."""
    ok = F.filter(spans, lambda s: (s["start_char"] >= 0) & (s["start_char"] < s["end_char"]) & (s["end_char"] <= F.length("chunk_text")))
    rest = [c for c in rows.columns if c not in ("chunk_id", spans, position)]
    first = rows.groupBy("chunk_id").agg(F.min_by(F.struct(*rest), position).alias("r"))
    merged = rows.select("chunk_id", F.explode(ok).alias("s")).distinct().groupBy("chunk_id").agg(F.array_sort(F.collect_list("s")).alias(spans))
    out = first.join(merged, "chunk_id", "left")
    return out.select("chunk_id", *(f"r.{c}" for c in rest), F.coalesce(spans, F.array().cast(rows.schema[spans].dataType)).alias(spans))


def ranked_by_hash(rows: DataFrame, key: str, seed: int | str) -> DataFrame:
    """rows with `position`, their place from 0 by digest of seed and key, and `total`.

    Digests are even, so their first three hex digits deal the rows into 4096 buckets; buckets are counted, and rows
    are ranked within them: no task sees all rows.
    """
    r = rows.withColumn("_h", ids.split_rank(seed, F.col(key))).withColumn("_b", F.substring("_h", 1, 3))
    sizes = r.groupBy("_b").agg(F.count("*").alias("_n"))
    every = Window.orderBy("_b")
    before = sizes.select("_b", (F.sum("_n").over(every) - F.col("_n")).alias("_before"), F.sum("_n").over(every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("total"))
    w = Window.partitionBy("_b").orderBy("_h", key)
    return r.join(F.broadcast(before), "_b").withColumn("position", F.col("_before") + F.row_number().over(w) - 1).drop("_h", "_b", "_before")


def split(rows: DataFrame, key: str, ratios: tuple[float, float, float] = (0.8, 0.1, 0.1), seed: int | str = 42) -> DataFrame:
    """rows with `split`: the first int(n * train) by hash train, the next int(n * dev) dev, the rest test."""
    if abs(sum(ratios) - 1.0) > 1e-9 or min(ratios) < 0:
        raise ValueError("split ratios must sum to 1.0")
    r = ranked_by_hash(rows, key, seed)
    train = F.floor(F.col("total") * ratios[0])
    dev = F.floor(F.col("total") * ratios[1])
    return r.withColumn("split", F.when(F.col("position") < train, "train").when(F.col("position") < train + dev, "dev").otherwise("test")).drop("position", "total")


def sample(rows: DataFrame, key: str, n: int, seed: int | str = 42) -> DataFrame:
    """The n rows of the smallest hashes: a sample without replacement that reruns repeat."""
    return ranked_by_hash(rows, key, seed).where(F.col("position") < max(0, n)).drop("position", "total")


SPAN = ["chunk_id", "start_char", "end_char", "entity_type"]


def compared(gold: DataFrame, predicted: DataFrame, keys: list[str] = SPAN) -> DataFrame:
    """Distinct spans of either side with tp, fp and fn flags."""
    g, p = gold.select(*keys).distinct().withColumn("g", F.lit(1)), predicted.select(*keys).distinct().withColumn("p", F.lit(1))
    both = g.join(p, keys, "full_outer")
    return both.select(*keys, (F.col("g").isNotNull() & F.col("p").isNotNull()).alias("tp"), F.col("g").isNull().alias("fp"), F.col("p").isNull().alias("fn"))


def scored(rows: DataFrame) -> DataFrame:
    p, r = safe_divide(F.col("tp"), F.col("tp") + F.col("fp")), safe_divide(F.col("tp"), F.col("tp") + F.col("fn"))
    return rows.withColumn("precision", p).withColumn("recall", r).withColumn("f1", safe_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))


def evaluated(gold: DataFrame, predicted: DataFrame, keys: list[str] = SPAN) -> DataFrame:
    """scope (micro, type or chunk), value, tp, fp, fn, precision, recall, f1: all from one pass over grouping sets."""
    c = compared(gold, predicted, keys)
    dims = [d for d in ("entity_type", "chunk_id") if d in keys]
    figures = [F.count_if("tp").alias("tp"), F.count_if("fp").alias("fp"), F.count_if("fn").alias("fn")]
    if not dims:
        return scored(c.agg(*figures).select(F.lit("micro").alias("scope"), F.lit("all").alias("value"), "tp", "fp", "fn"))
    g = c.groupingSets([[], *[[F.col(d)] for d in dims]], *map(F.col, dims)).agg(*figures, *(F.grouping(d).alias(f"_{d}") for d in dims))
    scope = value = None
    for d in dims:
        here = F.col(f"_{d}") == 0
        scope = F.when(here, "type" if d == "entity_type" else "chunk") if scope is None else scope.when(here, "type" if d == "entity_type" else "chunk")
        named = F.coalesce(F.col(d).cast("string"), F.lit("all"))
        value = F.when(here, named) if value is None else value.when(here, named)
    return scored(g.select(scope.otherwise("micro").alias("scope"), value.otherwise("all").alias("value"), "tp", "fp", "fn"))


# The least figures that an extractor must reach.
ENTITY_GATES = {("micro", "all", "precision"): 0.85, ("micro", "all", "recall"): 0.30, ("type", "POLICY", "precision"): 0.80, ("type", "ORG", "precision"): 0.80, ("type", "JURISDICTION", "precision"): 0.80, ("type", "PERSON", "precision"): 0.70, ("type", "PROGRAM", "precision"): 0.70}
CLAIM_GATES = {("micro", "all", "precision"): 0.60, ("micro", "all", "recall"): 0.20, ("micro", "all", "f1"): 0.30}


def gates(scores: DataFrame, least: dict[tuple[str, str, str], float] = ENTITY_GATES) -> DataFrame:
    """gate, least, reached, passed; a figure that is missing is 0."""
    spark = scores.sparkSession
    want = spark.createDataFrame([(*k, v) for k, v in least.items()], "scope string, value string, figure string, least double")
    long = scores.where("scope <> 'chunk'").select("scope", "value", F.explode(F.array(*(F.struct(F.lit(f).alias("figure"), F.col(f).alias("reached")) for f in ("precision", "recall", "f1")))).alias("x")).select("scope", "value", "x.figure", "x.reached")
    j = F.broadcast(want).join(long, ["scope", "value", "figure"], "left").withColumn("reached", F.coalesce("reached", F.lit(0.0)))
    return j.select(F.concat_ws(".", "scope", "value", "figure").alias("gate"), "least", "reached", (F.col("reached") >= F.col("least")).alias("passed"))


def claims_evaluated(gold: DataFrame, predicted: DataFrame) -> DataFrame:
    """The gates of claim spans: exact matches of place, over all chunks."""
    return gates(evaluated(gold, predicted, ["chunk_id", "start_char", "end_char"]), CLAIM_GATES)


def silver_diagnostics(sampled: DataFrame, labelled: DataFrame, run_id: str, version: str) -> DataFrame:
    """One row about a labelling run: labelled has chunk_id, silver_claims, parse_error (null: none) of the chunks that were tried.

    A row is invalid if it was parsed and has a span that is none; failures are counted, and stay rows of `labelled`.
    """
    ok = F.col("parse_error").isNull()
    bad = F.exists("silver_claims", lambda s: (s["start_char"] < 0) | (s["end_char"] <= s["start_char"]))
    good = ok & ~F.coalesce(bad, F.lit(False))
    one = lambda df: df.withColumn("_k", F.lit(1))
    n = labelled.agg(F.count_if(good).alias("records_written"), F.coalesce(F.sum(F.when(good, F.size("silver_claims"))), F.lit(0)).cast("long").alias("claims_written"), F.count_if(~ok).alias("parse_failures"), F.count_if(ok & ~good).alias("invalid_rows"))
    return one(sampled.agg(F.count("*").alias("sampled_chunks"))).join(one(n), "_k").select(F.lit(run_id).alias("labeling_run_id"), F.lit(version).alias("dataset_version"), "sampled_chunks", "records_written", "claims_written", "parse_failures", "invalid_rows")


def threshold_search(scores: DataFrame, thresholds=(0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8)) -> DataFrame:
    """scores (score, label) at each threshold: threshold, tp, fp, fn, f1, and whether it is the first of the best. One pass; no join with the thresholds."""
    hit, truth = (lambda t: F.col("score") >= t), F.col("label") == 1
    n = scores.agg(*(x for i, t in enumerate(thresholds) for x in (F.count_if(hit(t) & truth).alias(f"tp{i}"), F.count_if(hit(t) & ~truth).alias(f"fp{i}"), F.count_if(~hit(t) & truth).alias(f"fn{i}"))))
    rows = n.select(F.explode(F.array(*(F.struct(F.lit(t).alias("threshold"), F.col(f"tp{i}").alias("tp"), F.col(f"fp{i}").alias("fp"), F.col(f"fn{i}").alias("fn")) for i, t in enumerate(thresholds)))).alias("x")).select("x.*")
    s = scored(rows).select("threshold", "tp", "fp", "fn", "f1")
    best = Window.orderBy(F.desc("f1"), "threshold")  # a row for each threshold
    return s.withColumn("best", F.row_number().over(best) == 1)


def silver_claim_rows(chunks: DataFrame, claims: DataFrame) -> DataFrame:
    """A row for each claim with its one span, or a row with none for a chunk without claims."""
    span = F.struct("start_char", "end_char")
    c = claims.select("chunk_id", span.alias("s"))
    return chunks.drop("start_char", "end_char").join(c, "chunk_id", "left").withColumn("silver_claims", F.when(F.col("s").isNull(), F.array().cast("array<struct<start_char:int,end_char:int>>")).otherwise(F.array("s"))).drop("s")


def silver_entity_rows(chunks: DataFrame, mentions: DataFrame) -> DataFrame:
    """A row for each chunk with its mentions of valid types, in order of place."""
    m = mentions.where(F.col("entity_type").isin(*ENTITY_TYPES)).groupBy("chunk_id").agg(F.array_sort(F.collect_list(F.struct("start_char", "end_char", "mention_text", "entity_type"))).alias("silver_entities"))
    out = chunks.drop("start_char", "end_char").join(m, "chunk_id", "left")
    return out.withColumn("silver_entities", F.coalesce("silver_entities", F.array().cast("array<struct<start_char:int,end_char:int,mention_text:string,entity_type:string>>")))


def silver_entities_beside(chunks: DataFrame, found: Column) -> DataFrame:
    """`silver_entity_rows` of mentions that stand beside their chunk (found: an array of spans): nothing is joined."""
    valid = F.filter("found", lambda m: m["entity_type"].isin(*ENTITY_TYPES))
    row = lambda m: F.struct(*(m[c].alias(c) for c in ("start_char", "end_char", "mention_text", "entity_type")))
    rest = [c for c in chunks.columns if c not in ("start_char", "end_char")]
    return chunks.select(*rest, found.alias("found")).select(*rest, F.array_sort(F.transform(valid, row)).alias("silver_entities"))


def gold_scaffold(chunks: DataFrame, n: int, seed: int | str = 42) -> DataFrame:
    """n sampled chunks with empty labels, for annotators."""
    return sample(chunks, "chunk_id", n, seed).withColumn("gold_entities", F.array().cast("array<struct<start_char:int,end_char:int,entity_type:string,mention_text:string>>"))
