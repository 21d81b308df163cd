"""Claims: spans of a chunk's text that assert something. Each extractor takes chunks and returns rows of schemas.CLAIM."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, StructType

from ..functions import ids, text
from ..schemas import CLAIM
from .chunks import spans


def claim_rows(spans: DataFrame, version: str, *keep: str) -> DataFrame:
    """Rows of schemas.CLAIM from chunk columns plus start_char, end_char, evidence_text, confidence; then the columns to keep."""
    n = text.normalized(F.col("evidence_text"))
    out = spans.withColumn("normalized_claim_text", n)
    key = ids.claim_id(F.col("chunk_id"), F.col("start_char"), F.col("end_char"), F.col("normalized_claim_text"), F.lit(version))
    return out.select(
        key.alias("claim_id"), "chunk_id", "source_id", "source_document_id", "document_checksum", F.col("start_char").cast("int").alias("start_char"), F.col("end_char").cast("int").alias("end_char"),
        "evidence_text", "normalized_claim_text", F.col("confidence").cast("double").alias("confidence"), F.lit(None).cast("string").alias("claim_type"), F.lit(version).alias("extractor_version"), *keep,
    )


SPINE = ("chunk_id", "source_id", "source_document_id", "document_checksum")


def sentence_rows(chunks: DataFrame) -> DataFrame:
    """A row for each sentence of each chunk: the chunk's keys, chunk_text, position, text, start_char, end_char."""
    s = chunks.select(*SPINE, "chunk_text", F.posexplode(text.sentences(F.col("chunk_text"))).alias("position", "s"))
    return s.select(*SPINE, "chunk_text", "position", "s.text", "s.start_char", "s.end_char")


def each(rows: DataFrame, array: Column, *keep: str, name: str = "s") -> DataFrame:
    """keep and a row for each element. An inner explode would make Spark compute the array a second time, to leave out empty ones beforehand."""
    return rows.select(*keep, F.explode_outer(array).alias(name)).where(F.col(name).isNotNull())


KEPT, KEPT_CHARS = 1 << 15, 500  # sentences whose results a task keeps, and the longest of them


def by_sentence(make: Callable[[], Callable[[str], Sequence[tuple]]], fields: str) -> Callable[[Column], Column]:
    """Of a text an array with a struct (position, start_char, end_char, then fields) for each tuple that make()'s function gives for each of its sentences.

    Tuples begin with start and end within the sentence. Only texts go to Python, in Arrow batches. Like texts of a
    batch are looked at once, and a short sentence that a task meets again isn't looked at again.
    """
    out = StructType.fromDDL(f"position int, start_char int, end_char int, {fields}")
    held: dict = {}

    def run(texts: pa.Array) -> pa.Array:
        if "f" not in held:
            held["f"] = make()
            held["known"] = lru_cache(KEPT)(lambda sentence: tuple(held["f"](sentence)))
        f, known = held["f"], held["known"]
        rows: list[tuple] = []
        offsets = [0]
        whole = texts.dictionary_encode(null_encoding="encode")
        for body in whole.dictionary.to_pylist():
            if body and not body.isspace():
                for position, (at, end) in enumerate(spans(body, "scanner")):
                    for a, b, *rest in (known if end - at <= KEPT_CHARS else f)(body[at:end]):
                        rows.append((position, at + a, at + b, *rest))
            offsets.append(len(rows))
        kinds = to_arrow_schema(out)
        columns = zip(*rows, strict=True) if rows else [()] * len(kinds)
        values = pa.StructArray.from_arrays([pa.array(c, k.type) for c, k in zip(columns, kinds, strict=True)], fields=list(kinds))
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values).take(whole.indices)

    run.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, ArrayType(out))


class Scorer:
    """`text.scored_sentences` of one sentence, in Python."""

    def __init__(self, weights: Sequence[float] = (1.0, 0.8, 0.6, 0.3), modality: Sequence[str] = text.MODALITY, causal: Sequence[str] = text.CAUSAL, attribution: Sequence[str] = text.ATTRIBUTION):
        self.weights, self.lexicons = weights, (modality, causal, attribution)
        self.quantity, self.numbered = (re.compile(p.replace("(?iU)", "(?i)")) for p in (text.QUANTITY, text.NUMBERED_HEADING))

    def skippable(self, sentence: str) -> bool:
        n = " ".join(sentence.split())
        bare = n.rstrip(".:;,-")
        quoted = len(bare) >= 2 and any(bare.startswith(x) and bare.endswith(y) for x, y in text.QUOTES)
        return n.endswith((":", ":.")) or "|" in n or n.startswith(">") or n.lower().rstrip(".:;,-") in text.HEADINGS or quoted or self.numbered.search(n) is not None

    def __call__(self, sentence: str):
        low = sentence.lower()
        modality, causal, attribution = (any(p in low for p in phrases) for phrases in self.lexicons)
        found = {"modality": modality, "quantity": self.quantity.search(sentence) is not None, "causal": causal, "attribution": attribution}
        score = 0.0
        for has, w in zip(found.values(), self.weights, strict=True):
            score += w if has else 0.0
        yield 0, len(sentence), sentence, self.skippable(sentence), found, score


SCORED = "text string, skipped boolean, cues struct<modality: boolean, quantity: boolean, causal: boolean, attribution: boolean>, score double"


def scored_rows(chunks: DataFrame, **options) -> DataFrame:
    """sentence_rows with skipped, cues and score, each computed once."""
    scored = by_sentence(lambda: Scorer(**options), SCORED)
    return each(chunks, scored(F.col("chunk_text")), *SPINE).select(*SPINE, "s.*")


def rule_finder(threshold: float = 0.8, weights: Sequence[float] = (1.0, 0.8, 0.6, 0.3), **lexicons) -> Callable[[str], list[tuple[int, int, str, float]]]:
    scorer = Scorer(weights=weights, **lexicons)
    return lambda sentence: [(a, b, s, min(1.0, score)) for a, b, s, skipped, _, score in scorer(sentence) if not skipped and score >= threshold]


def rule_spans(threshold: float = 0.8, weights: Sequence[float] = (1.0, 0.8, 0.6, 0.3), **lexicons) -> Callable[[Column], Column]:
    """Of a text an array of its rule claims: structs (position, start_char, end_char, evidence_text, confidence)."""

    return by_sentence(lambda: rule_finder(threshold, weights, **lexicons), "evidence_text string, confidence double")


def rule_claims(chunks: DataFrame, threshold: float = 0.8, weights: Sequence[float] = (1.0, 0.8, 0.6, 0.3), version: str = "rules-v1", **lexicons) -> DataFrame:
    """Sentences whose cues' weights reach the threshold; the score, at most 1, is the confidence. One claim a sentence."""
    hits = rule_spans(threshold, weights, **lexicons)
    return claim_rows(each(chunks, hits(F.col("chunk_text")), *SPINE).select(*SPINE, "s.*"), version)


def score_breakdown(chunks: DataFrame) -> DataFrame:
    """Each sentence's cues and score, skippable ones marked."""
    return scored_rows(chunks).select("chunk_id", "position", "start_char", "end_char", "cues.*", "skipped", "score")


def aligned(body: str, needle: str, used: set[tuple[int, int]]) -> tuple[int, int] | None:
    """The first place of the needle, or of the needle with white space normalised, that isn't used yet. Places may overlap."""
    at = body.find(needle)
    if at < 0:
        needle = " ".join(needle.split())
        at = body.find(needle) if needle else -1
    while at >= 0 and (at, at + len(needle)) in used:
        at = body.find(needle, at + 1)
    return (at, at + len(needle)) if at >= 0 else None


def aligned_claims(chunks: DataFrame, answers: Column, version: str, confidence: float = 1.0) -> DataFrame:
    """Claims whose texts a model has given (answers: array<string> of a chunk), at the places where they stand; blank texts and those that stand nowhere are dropped."""
    out = StructType.fromDDL("chunk_id string, source_id string, source_document_id string, document_checksum string, start_char int, end_char int, evidence_text string, confidence double")
    kinds = to_arrow_schema(out)

    def run(batches):
        for batch in batches:
            rows: list[list] = [[] for _ in kinds]
            for *spine, body, given in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                used: set[tuple[int, int]] = set()
                for claim in given or []:
                    claim = (claim or "").strip()
                    span = aligned(body or "", claim, used) if claim else None
                    if span:
                        used.add(span)
                        for column, value in zip(rows, (*spine, *span, body[span[0] : span[1]], confidence), strict=True):
                            column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(rows, kinds, strict=True)], schema=kinds)

    return claim_rows(chunks.select(*SPINE, "chunk_text", answers.alias("answers")).mapInArrow(run, out), version)


def content_of(reply: Column, shape: str = "hosted") -> Column:
    """The claims of a model's JSON reply: hosted replies nest it in choices[0].message.content, local ones in message.content."""
    path = "$.choices[0].message.content" if shape == "hosted" else "$.message.content"
    return F.from_json(F.get_json_object(reply, path), "claims array<string>")["claims"]


def model_claims(chunks: DataFrame, replies: DataFrame, shape: str = "hosted", version: str = "llm-v1") -> DataFrame:
    """Claims from replies (chunk_id, reply) of a language model asked elsewhere; chunks without a reply have none."""
    joined = chunks.join(replies.select("chunk_id", "reply"), "chunk_id")
    return aligned_claims(joined, content_of(F.col("reply"), shape), version)


def asked_claims(chunks: DataFrame, ask: Callable[[], Callable[[list[str]], list[list[str]]]], version: str) -> DataFrame:
    """Claims from a model that runs in the executors: ask() loads it, once in each Python worker; it maps texts to lists of claims."""
    held: dict = {}

    def run(batches):
        if "model" not in held:
            held["model"] = ask()
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("chunk_text")).to_pylist()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(held["model"](texts), pa.list_(pa.string()))], [*batch.schema.names, "answers"])

    picked = chunks.select(*SPINE, "chunk_text")
    schema = "chunk_id string, source_id string, source_document_id string, document_checksum string, chunk_text string, answers array<string>"
    return aligned_claims(picked.mapInArrow(run, schema), F.col("answers"), version)


def generated_sentences(generated: Column) -> Column:
    """A sequence model's output text as candidate claims, a sentence each."""
    return F.transform(text.sentences(generated), lambda s: s["text"])


KEY = ("chunk_id", "start_char", "end_char", "normalized_claim_text", "extractor_version", "document_checksum")


def report(chunks: DataFrame, extracted: DataFrame, stored: DataFrame) -> DataFrame:
    """For each chunk: sentences, claims found, and how many of them are new or stored already."""
    marked = extracted.join(stored.select("claim_id").distinct().withColumn("old", F.lit(True)), "claim_id", "left")
    counts = marked.groupBy("chunk_id").agg(F.count("*").alias("claims_count"), F.count_if(F.col("old").isNull()).alias("new_claims"))
    out = chunks.select("chunk_id", text.sentence_count(F.col("chunk_text")).alias("processed_sentences")).join(counts, "chunk_id", "left").na.fill(0, ["claims_count", "new_claims"])
    return out.select("chunk_id", F.lit("completed").alias("status"), "processed_sentences", "claims_count", "new_claims", (F.col("claims_count") - F.col("new_claims")).alias("existing_claims"))


def report_beside(chunks: DataFrame, found: Column, stored: DataFrame, version: str = "rules-v1") -> DataFrame:
    """`report` of claims that stand beside their chunk (found: an array of rule_spans): chunks are read once, and only ids are shuffled."""
    name = lambda s: ids.claim_id(F.col("chunk_id"), s["start_char"], s["end_char"], text.normalized(s["evidence_text"]), F.lit(version))
    n = chunks.select("chunk_id", text.sentence_count(F.col("chunk_text")).alias("processed_sentences"), found.alias("found"))
    each = n.select("chunk_id", "processed_sentences", F.explode_outer(F.transform("found", name)).alias("claim"))
    # a chunk without claims goes by its own id, so that such chunks don't meet in one task
    old = stored.select(F.col("claim_id").alias("_key")).distinct().withColumn("old", F.lit(True))
    marked = each.withColumn("_key", F.coalesce("claim", "chunk_id")).join(old, "_key", "left")
    out = marked.groupBy("chunk_id").agg(F.max("processed_sentences").alias("processed_sentences"), F.count("claim").alias("claims_count"), F.count_if(F.col("claim").isNotNull() & F.col("old").isNull()).alias("new_claims"))
    return out.select("chunk_id", F.lit("completed").alias("status"), "processed_sentences", "claims_count", "new_claims", (F.col("claims_count") - F.col("new_claims")).alias("existing_claims"))


def empty(spark) -> DataFrame:
    return spark.createDataFrame([], CLAIM)
