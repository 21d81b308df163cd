"""Streaming twins of the append-only stages, and topics.

Chunking and extraction are row-local, so the batch functions run on streams as they are. What must happen once a key
is kept by a watermarked state or by the sink's anti-join, per micro-batch.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.acquisition import unseen
from ..operators.chunks import ChunkConfig, chunked
from ..operators.claims import rule_claims


def chunk_stream(versions: DataFrame, config: ChunkConfig = ChunkConfig(), segmenter: str = "sentencizer") -> DataFrame:
    return chunked(versions, config, segmenter)


def claim_stream(chunks: DataFrame, **options) -> DataFrame:
    return rule_claims(chunks, **options)


def once_each(rows: DataFrame, keys: list[str], time: str, delay: str = "1 hour") -> DataFrame:
    """Rows without those whose key came before within the delay; state is bounded by the watermark."""
    return rows.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def windowed_counts(events: DataFrame, time: str, by: list[str], length: str = "10 minutes", slide: str | None = None, delay: str = "10 minutes") -> DataFrame:
    w = F.window(time, length, slide) if slide else F.window(time, length)
    return events.withWatermark(time, delay).groupBy(w.alias("w"), *by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("window_start"), *by, "n")


def append_new_batches(rows: DataFrame, path: str, keys: list[str], checkpoint: str) -> StreamingQuery:
    """Appends to Parquet at path what isn't there yet; a batch that is run again after a failure adds nothing twice."""

    def put(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        try:
            stored = spark.read.schema(batch.schema).parquet(path)
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            stored = spark.createDataFrame([], batch.schema)
        unseen(batch, stored, keys).write.mode("append").parquet(path)

    return rows.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def final_table(aggregate: DataFrame) -> DataFrame:
    """The state of a streaming aggregate once its source is read to the end, as a table in a folder that driver and executors share."""
    spark = aggregate.sparkSession
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if spark.sparkContext.master.startswith("local-cluster") or not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="lodestone-")
    path = f"{base.rstrip('/')}/stream-{uuid.uuid4().hex}"
    query = aggregate.writeStream.outputMode("complete").option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True)
    query.foreachBatch(lambda batch, number: batch.write.mode("overwrite").parquet(f"{path}/rows")).start().awaitTermination()
    return spark.read.schema(aggregate.schema).parquet(f"{path}/rows")


class Topics:
    """Sends each micro-batch's rows of a topic to its subscribers; a row without a topic is an error."""

    def __init__(self):
        self.subscribers: dict[str, list[Callable[[DataFrame], None]]] = {}

    def subscribe(self, topic: str, f: Callable[[DataFrame], None]) -> None:
        self.subscribers.setdefault(topic, []).append(f)

    def publish(self, events: DataFrame) -> None:
        if not events.where(F.col("topic").isNull()).isEmpty():
            raise ValueError("event without a topic")
        for topic, fs in self.subscribers.items():
            for f in fs:
                f(events.where(F.col("topic") == topic))

    def run(self, events: DataFrame, checkpoint: str) -> StreamingQuery:
        return events.writeStream.foreachBatch(lambda batch, number: self.publish(batch)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
