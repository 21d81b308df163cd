"""Sharding along a Hilbert curve.

Several metadata dimensions are quantised into bins cut at quantiles of their rows, so that counts are about equal but
for values that many rows share; strings are ordered by seven bytes after what all of them begin with. A row's bins are a point of a cube, and the
Hilbert curve through the cube orders the rows so that neighbours on it are neighbours in every dimension. Runs of the
order are the shards: each covers a small range of all dimensions at once, which min/max statistics can prune by.

Defined results: nulls of a dimension are in its lowest bin; a null text has 0 bytes and counts as size 1; the law is
`rows`: the shards' counts are at most one apart; equal rows have adjacent places; with fewer rows than shards the rest
stay empty; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written
from .numbering import numbered

BITS = 5


def hilbert_index(points: np.ndarray, bits: int) -> np.ndarray:
    """Places along the Hilbert curve of points (rows of coordinates below 2**bits), by the transpose method of Skilling (2004)."""
    x = [points[:, k].astype(np.int64) for k in range(points.shape[1])]
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:  # undo the excess work of each level
        for k in range(n):
            high = (x[k] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[k]) & (q - 1))
            x[0] = np.where(high, x[0] ^ (q - 1), x[0] ^ swap)
            x[k] = x[k] ^ swap
        q >>= 1
    for k in range(1, n):  # Gray code
        x[k] = x[k] ^ x[k - 1]
    flip = np.zeros(len(points), np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        flip = np.where((x[n - 1] & q) != 0, flip ^ (q - 1), flip)
        q >>= 1
    out = np.zeros(len(points), np.int64)
    for b in range(bits - 1, -1, -1):
        for k in range(n):
            out = out << 1 | ((x[k] ^ flip) >> b & 1)
    return out


def text_code(c: Column, skip: int = 0) -> Column:
    """A number that orders strings by seven bytes after the first skip ones."""
    return F.conv(F.rpad(F.hex(F.substring(c.cast("binary"), skip + 1, 7)), 14, "0"), 16, 10).cast("long")


def is_number(kind: str) -> bool:
    return kind in ("tinyint", "smallint", "int", "bigint", "float", "double", "date", "timestamp", "timestamp_ntz") or kind.startswith("decimal")


def codes_of(df: DataFrame, names: list[str]) -> list[Column]:
    """Numbers that order each column's values."""
    kinds = dict(df.dtypes)
    texts = [n for n in names if not is_number(kinds[n])]
    ends = df.agg(*(f(df[n].cast("string")) for n in texts for f in (F.min, F.max))).first() if texts else ()
    skip = {}
    for n, low, high in zip(texts, ends[::2], ends[1::2], strict=True):
        low, high = ((x or "").encode("utf-8", "surrogatepass") for x in (low, high))  # what both ends begin with all strings begin with
        skip[n] = next((i for i, (a, b) in enumerate(zip(low, high, strict=False)) if a != b), min(len(low), len(high)))
    out = []
    for n in names:
        if n in skip:
            out.append(text_code(df[n].cast("string"), skip[n]).cast("double"))
        else:
            out.append((df[n].cast("timestamp") if kinds[n] in ("date", "timestamp", "timestamp_ntz") else df[n]).cast("double"))
    return out


def with_curve(coded: DataFrame, dims: list[str], bits: int = BITS) -> DataFrame:
    """coded with `curve`: the Hilbert place of its quantised columns dims (doubles, null: the lowest bin). Bins are cut at quantiles of the rows."""
    parts = [k / (1 << bits) for k in range(1, 1 << bits)]
    cuts = [np.array(sorted(set(q or [])), np.float64) for q in coded.agg(*(F.percentile_approx(d, parts, 10000) for d in dims)).first()]
    at = [coded.columns.index(d) for d in dims]
    out = coded.select("*", F.lit(0).cast("long").alias("curve"))

    def run(batches):
        for batch in batches:
            points = np.zeros((batch.num_rows, len(dims)), np.int64)
            for k, i in enumerate(at):
                v = batch.column(i).to_numpy(zero_copy_only=False).astype(np.float64)
                points[:, k] = np.where(np.isnan(v), 0, np.searchsorted(cuts[k], v, "right"))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(hilbert_index(points, bits))], schema=batch.schema)

    return out.mapInArrow(run, out.schema)


def hilbert_shards(df: DataFrame, dims: list[str], keep: list[str], tie: list[str], shards: int = 16, bits: int = BITS) -> DataFrame:
    """keep + dims' codes (as dim_<name>), curve, shard, slot: equal-count runs of the curve's order; tie orders rows of one place.

    The columns that go through the sort are these alone, not the texts.
    """
    names = [f"dim_{d}" for d in dims]
    coded = written(df.select(*keep, *(c.alias(n) for c, n in zip(codes_of(df, dims), names, strict=True))), "coded")
    order = [F.col("curve"), *(F.col(c).asc_nulls_first() for c in tie)]
    placed = numbered(written(with_curve(coded, names, bits), "curve"), order, "place")
    place, n = F.col("place"), F.col("place_count")
    shard = F.floor(place * shards / n) if shards == 1 else F.expr(f"(place * {shards}L) div place_count")
    first = F.expr(f"(((place * {shards}L) div place_count) * place_count + {shards - 1}L) div {shards}L")
    return placed.withColumn("shard", shard.cast("int")).withColumn("slot", (place - first).cast("long")).drop("place", "place_count")


def shard_report(docs: DataFrame, shards: int = 16) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard (null: the law isn't `key`), curve of every row."""
    text = docs["text"].cast("string")
    narrow = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"), docs["source"].cast("string").alias("source"), docs["lang"].cast("string").alias("lang"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"), F.crc32(F.coalesce(text, F.lit("")).cast("binary")).cast("long").alias("text_crc32"),
    )
    placed = hilbert_shards(narrow, ["lang", "size", "source"], ["doc_id", "size", "text_crc32"], ["text_crc32", "doc_id"], shards)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "curve")


def manifest(placed: DataFrame) -> DataFrame:
    """For each shard its rows and the range of every dim_ column: what a reader prunes by."""
    dims = [c for c in placed.columns if c.startswith("dim_")]
    return placed.groupBy("shard").agg(F.count("*").alias("rows"), *(f(c).alias(f"{n}_{c}") for c in dims for n, f in (("min", F.min), ("max", F.max))))
