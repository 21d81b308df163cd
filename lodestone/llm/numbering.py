"""Positions of rows in a total order, without a window over all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

WITHIN = (1 << 33) - 1


def numbered(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """rows with a column `name`: their position from 0 in that order (ties among equal keys in any order), and `{name}_count`, how many rows there are.

    One range shuffle sorts; each sorted partition numbers its own rows; the partitions' sizes, a row for each
    partition, give the offsets. The numbered rows are written first, so that a lost executor cannot renumber them.
    rows should be narrow, and cheap to make twice (Spark samples them to find the ranges).
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_rows = rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
    at = written(sorted_rows.withColumn("_at", F.monotonically_increasing_id()), name)
    sizes = at.groupBy(F.shiftright("_at", 33).alias("_part")).agg(F.count("*").alias("_n"))
    every = Window.orderBy("_part")
    offsets = sizes.select("_part", (F.sum("_n").over(every) - F.col("_n")).alias("_offset"), F.sum("_n").over(every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias(f"{name}_count"))
    joined = at.withColumn("_part", F.shiftright("_at", 33)).join(F.broadcast(offsets), "_part")  # a row for each partition
    return joined.withColumn(name, F.col("_offset") + F.col("_at").bitwiseAND(F.lit(WITHIN))).drop("_part", "_offset", "_at")
