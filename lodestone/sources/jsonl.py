"""JSON-lines tables: tolerant and strict readers, and sinks that append, append what is new, or replace."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.acquisition import unseen


def as_schema(schema: str | StructType) -> StructType:
    return schema if isinstance(schema, StructType) else StructType.fromDDL(schema)


def read(spark: SparkSession, path: str | list[str], schema: str | StructType) -> DataFrame:
    """Rows of a fixed schema; blank lines are skipped, malformed ones give rows of nulls, which are dropped."""
    s = as_schema(schema)
    rows = spark.read.schema(s.add("_corrupt", "string")).option("columnNameOfCorruptRecord", "_corrupt").json(path)
    return rows.where(F.col("_corrupt").isNull()).drop("_corrupt")


def read_strict(spark: SparkSession, path: str | list[str], schema: str | StructType, required: tuple[str, ...] = (), what: str = "Row") -> DataFrame:
    """Rows of a fixed schema; a line that is no object, or a required text that is missing or blank, raises where it is read and names its line, from 1. Blank lines are skipped."""
    found = lines(spark, path).where(~F.col("line").rlike(r"^\s*$"))
    number = F.col("line_number").cast("string")
    keys = F.json_object_keys("line")
    parsed = F.when(F.try_parse_json("line").isNull() | keys.isNull(), F.raise_error(F.concat(F.lit(f"{what} "), number, F.lit(" is malformed: it must be an object")))).otherwise(F.from_json("line", as_schema(schema)))
    rows = found.select("line_number", parsed.alias("r")).select("line_number", "r.*")
    for c in required:
        rows = rows.withColumn(c, F.when(F.coalesce(F.trim(F.col(c)), F.lit("")) == "", F.raise_error(F.concat(F.lit(f"{what} "), number, F.lit(f" has invalid {c}")))).otherwise(F.col(c)))
    return rows.drop("line_number")


def lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """source_path, line_number (from 1 in each file), line. Numbers follow the places of lines in their file.

    Lines of a block of a file are numbered where they are read; only the blocks' counts meet, a row for each block.
    """
    raw = spark.read.text(path).select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("source_path"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_at"))
    blocks = raw.groupBy("source_path", "_block").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy("source_path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select("source_path", "_block", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return raw.join(offsets, ["source_path", "_block"]).select("source_path", (F.col("_before") + F.col("_at") - F.col("_first") + 1).alias("line_number"), "line")


def objects(rows: DataFrame, most: int | None = None) -> DataFrame:
    """The rows (source_path, line_number, line) that are JSON objects, the first `most` of them by place where that is given."""
    good = rows.where(F.try_parse_json("line").isNotNull() & F.json_object_keys("line").isNotNull())
    return good if most is None else good.orderBy("source_path", "line_number").limit(max(0, most))


def object_count(rows: DataFrame) -> DataFrame:
    """One row: how many lines are JSON objects."""
    return objects(rows).agg(F.count("*").alias("rows"))


def append(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").json(path)


def append_new(rows: DataFrame, path: str, keys: list[str]) -> int:
    """Appends rows whose key isn't stored at path yet, and says how many."""
    spark = rows.sparkSession
    try:
        stored = spark.read.schema(rows.schema).json(path)
        stored.take(0)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        stored = spark.createDataFrame([], rows.schema)
    fresh = unseen(rows, stored, keys).persist()
    n = fresh.count()
    if n:
        fresh.write.mode("append").json(path)
    fresh.unpersist()
    return n


def replace(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").json(path)


def term_list(spark: SparkSession, path: str) -> list[str]:
    """Non-blank lines of a short file of terms, such as a gazetteer."""
    return [r[0] for r in spark.read.text(path).select(F.trim("value").alias("v")).where("v <> ''").collect()]


def sorted_json(*columns: str | Column) -> Column:
    """A struct of the columns as JSON, in the given order, nulls kept."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
