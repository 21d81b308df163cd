"""Artifacts and other files: raw pages, catalogs, vectors, graphs."""

from __future__ import annotations

import io

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from ..functions import ids
from ..schemas import CATALOG


def artifacts(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Raw files: path, content, modified time, checksum."""
    raw = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    return raw.select("path", "content", F.col("modificationTime").alias("modified_at"), ids.checksum(F.col("content")).alias("checksum"))


def store_artifacts(rows: DataFrame, path: str) -> None:
    """Raw contents, once for each checksum, in a table keyed by it; what is stored already isn't stored again."""
    new = rows.select(ids.checksum(F.col("content")).alias("checksum"), "content").dropDuplicates(["checksum"])
    spark = rows.sparkSession
    if exists(spark, path):
        new = new.join(spark.read.parquet(path).select("checksum"), "checksum", "left_anti")
    new.write.mode("append").parquet(path)


def hadoop_path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop_path(spark, path)
    return fs.exists(p)


def require_file(spark: SparkSession, path: str, label: str) -> None:
    """Raises unless the path is a file, or a table's folder with files in it, in any store that Spark reads."""
    fs, p = hadoop_path(spark, path)
    if not fs.exists(p):
        raise ValueError(f"{label} input path does not exist: {path}")
    if not fs.getFileStatus(p).isFile() and not any(x.isFile() and x.getPath().getName()[0] not in "._" for x in fs.listStatus(p)):
        raise ValueError(f"{label} input path is not a file: {path}")


def sqlite_rows(spark: SparkSession, path: str, sql: str, schema: str) -> DataFrame:
    """Rows that a query finds in each SQLite file at path. Files are read by Spark and opened in memory, one a task at a time."""
    names = [f.name for f in StructType.fromDDL(schema)]

    def run(frames):
        import sqlite3

        for frame in frames:
            for content in frame["content"]:
                db = sqlite3.connect(":memory:")
                db.deserialize(content)
                yield pd.DataFrame(db.execute(sql).fetchall(), columns=names)
                db.close()

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(run, schema)


def sqlite_catalog(spark: SparkSession, path: str) -> DataFrame:
    """The catalog rows of a SQLite catalog file."""
    rows = sqlite_rows(spark, path, "SELECT canonical_entity_key, canonical_name, entity_type, aliases_json FROM entity_catalog", "canonical_entity_key string, canonical_name string, entity_type string, aliases_json string")
    return rows.select("canonical_entity_key", "canonical_name", "entity_type", F.from_json("aliases_json", "array<string>").alias("aliases"))


def catalog_seed(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.schema(CATALOG).json(path)
    if rows.isEmpty():
        raise ValueError("catalog seed is empty")
    return rows


def vector_sidecar(spark: SparkSession, path: str) -> DataFrame:
    """canonical_entity_key, tokens from one JSON document with a list of vectors; blank tokens dropped."""
    doc = spark.read.schema("catalog_version string, seed_hash string, vectors array<struct<canonical_entity_key:string,entity_type:string,tokens:array<string>>>").option("multiLine", True).json(path)
    v = doc.select(F.explode("vectors").alias("v")).select("v.canonical_entity_key", F.filter("v.tokens", lambda t: F.trim(t) != "").alias("tokens"))
    return v.where(F.col("canonical_entity_key").isNotNull() & F.col("tokens").isNotNull())


@F.pandas_udf(StringType())
def pdf_text(content: pd.Series) -> pd.Series:
    """Text of a PDF's pages, blank ones left out, joined by line ends: by pypdf where it is installed, else by `pdf`."""
    try:
        from pypdf import PdfReader
    except ModuleNotFoundError:
        from .pdf import text_of as one
    else:

        def one(raw: bytes) -> str:
            pages = [p.extract_text() or "" for p in PdfReader(io.BytesIO(raw)).pages]
            return "\n".join(p for p in pages if p).strip()

    return content.map(lambda raw: None if raw is None else one(raw))


def write_graph(nodes: DataFrame, edges: DataFrame, path: str) -> None:
    """Nodes and edges as Parquet, sorted within files by id for pruning."""
    for name, df in (("nodes", nodes), ("edges", edges)):
        df.repartitionByRange("id").sortWithinPartitions("id").write.mode("overwrite").parquet(f"{path}/{name}")


def kept_runs(names: list[str], most: int = 5) -> list[str]:
    """The newest run folders by name, which stay."""
    return sorted(names, reverse=True)[:most]


def publish(spark: SparkSession, root: str, run: str, most: int = 5) -> list[str]:
    """Makes `run` the latest one below root and deletes all but the newest runs; works on any Hadoop file system."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = lambda p: jvm.org.apache.hadoop.fs.Path(p)
    fs = path(root).getFileSystem(conf)
    last = path(f"{root}/latest")
    if fs.exists(last):
        fs.delete(last, True)
    jvm.org.apache.hadoop.fs.FileUtil.copy(fs, path(f"{root}/{run}"), fs, last, False, conf)
    runs = [s.getPath().getName() for s in fs.listStatus(path(root)) if s.isDirectory() and s.getPath().getName() != "latest"]
    keep = kept_runs(runs, most)
    for r in runs:
        if r not in keep:
            fs.delete(path(f"{root}/{r}"), True)
    return keep
