"""Helpers that the training-data operators share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables, read by Spark alone so that any store will do."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir, which driver and executors share.

    Only where a local session names no folder is a temporary one set; on a cluster that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="lodestone-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/lodestone-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str = "step") -> DataFrame:
    """The rows of df from a Parquet table in the shared folder: lineage ends there, and losing an executor loses nothing."""
    path = f"{shared_folder(df.sparkSession)}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, key: str, name: str = "step", dealt: bool = False) -> DataFrame:
    """Like `written`, in buckets by key, so that joins by it needn't shuffle these rows again.

    dealt: df's partitions hold few buckets each already, so it isn't shuffled here either. The table has no name afterwards.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table_name = f"lodestone_{uuid.uuid4().hex}"
    (df if dealt else df.repartition(n, key)).write.format("parquet").bucketBy(n, key).option("path", f"{shared_folder(spark)}/{name}").saveAsTable(table_name)
    out = spark.table(table_name)
    spark.sql(f"DROP TABLE {table_name}")
    return out


def pieces(batch: pa.RecordBatch, column: str, most_bytes: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Runs of the batch's rows whose text takes about most_bytes: bounds the working memory; a longer text stands alone."""
    lengths = [0 if x is None else x for x in pa.compute.binary_length(batch.column(column)).to_pylist()]
    start = size = 0
    for i, n in enumerate(lengths):
        if size + n > most_bytes and i > start:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += n
    if start < batch.num_rows:
        yield batch.slice(start)


def schemas(ddl: str) -> tuple[StructType, pa.Schema]:
    """A schema for Spark and for Arrow; parsed on the driver, as executors can't."""
    out = StructType.fromDDL(ddl)
    return out, to_arrow_schema(out)


def map_rows(df: DataFrame, schema: str, make: Callable[[], Callable[[pa.RecordBatch], list]], text: str, most_bytes: int = 2 << 20) -> DataFrame:
    """df through make()'s function, which turns a few rows into lists, one for each column of schema.

    make runs once in each task, on the executor: it loads what the task needs.
    """
    out, kinds = schemas(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        for batch in batches:
            for part in pieces(batch, text, most_bytes):
                columns = f(part)
                yield pa.RecordBatch.from_arrays([pa.array(c, type=k.type) for c, k in zip(columns, kinds, strict=True)], schema=kinds)

    return df.mapInArrow(run, out)
