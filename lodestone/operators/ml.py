"""The token classifiers of claim spans, in Spark ML, and their decoding."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import FeatureHasher
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .claims import SPINE, claim_rows
from .spans import bio_spans, bio_tags, token_rows

FEATURES = ["lower", "is_title", "is_digit", "is_upper", "is_currency", "prefix3", "suffix3", "previous", "following"]


def classifier(label: str, score: str) -> Pipeline:
    hashed = FeatureHasher(inputCols=FEATURES, outputCol=f"{label}_features", numFeatures=1 << 16)
    model = LogisticRegression(featuresCol=f"{label}_features", labelCol=label, weightCol=f"{label}_weight", probabilityCol=f"{score}_probability", rawPredictionCol=f"{score}_raw", predictionCol=f"{score}_prediction", maxIter=30, regParam=0.01)
    return Pipeline(stages=[hashed, model])


def trained(chunks: DataFrame, spans: DataFrame) -> tuple[PipelineModel, PipelineModel]:
    """Models of a token beginning a span and of its being inside one; classes weigh alike."""
    t = token_rows(chunks, "chunk_id", "chunk_text")
    tags = bio_tags(t, spans, "chunk_id").select("chunk_id", "position", "tag")
    rows = t.join(tags, ["chunk_id", "position"]).withColumn("begin", (F.col("tag") == "B").cast("double")).withColumn("inside", (F.col("tag") == "I").cast("double")).persist()
    n = rows.agg(F.count("*").alias("n"), F.sum("begin").alias("begin"), F.sum("inside").alias("inside")).first()
    models = []
    for label in ("begin", "inside"):
        positive = max(1.0, n[label] or 0.0)
        weight = F.when(F.col(label) == 1, n["n"] / (2 * positive)).otherwise(n["n"] / (2 * max(1.0, n["n"] - positive)))
        models.append(classifier(label, f"{label}_score").fit(rows.withColumn(f"{label}_weight", weight)))
    rows.unpersist()
    return models[0], models[1]


def token_claims(chunks: DataFrame, models: tuple[PipelineModel, PipelineModel], threshold: float = 0.5, version: str = "ml-v1") -> DataFrame:
    """Claims from the two models' scores, begins and insides above the threshold; a claim's confidence is its tokens' mean."""
    scored = token_rows(chunks, "chunk_id", "chunk_text")
    for m, name in zip(models, ("begin", "inside"), strict=True):
        scored = m.transform(scored).withColumn(f"{name}_p", vector_to_array(f"{name}_score_probability")[1])
    b, i = F.col("begin_p"), F.col("inside_p")
    found = bio_spans(scored, "chunk_id", (b >= threshold) & (b >= i), i >= threshold, F.greatest(b, i))
    joined = found.join(chunks.select(*SPINE, "chunk_text"), "chunk_id").withColumn("evidence_text", F.expr("substring(chunk_text, start_char + 1, end_char - start_char)"))
    return claim_rows(joined, version)
