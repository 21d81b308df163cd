"""Mixing sources to target weights, in DataFrame functions only.

Words are added up per source; targets follow the weights up to a cap for each source; a source's repetition rate is its
target over its words. Each document is emitted floor(rate) times, and once more if a hash of its id, read as a number
in [0, 1), is below the fraction.

Defined results: a null text has size 0; a null source is a source of its own, last in order; a source without words has
target 0 and its documents are taken 0 times; equal ids draw alike; an empty table gives no rows; in `mix` all columns
pass through, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written
from .numbering import numbered

WEIGHTS = (3, 1, 2)
WORD = r"[^\x20\x09-\x0D]+"
SEED = "mix-1"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(doc_id: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) from the first 52 bits of an MD5 digest."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """source, source_size, weight, target of each source of sized (source, size); the excess over a source's cap goes to the others by weight until none is above."""
    per_source = written(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    ranked = numbered(per_source, [F.col("source").asc_nulls_last()], "place")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int")).cast("double")
    t = written(ranked.select("source", "source_size", weight.alias("weight"), (F.col("source_size") * most).alias("cap")), "weights")
    total = t.agg(F.sum("source_size")).first()[0] or 0
    level, before = 0.0, -1
    while True:  # each pass reads one row back; the capped sources only grow in number
        above = F.col("cap") < F.lit(level) * F.col("weight")
        n, capped, open_weight = t.agg(F.count_if(above), F.sum(F.when(above, F.col("cap")).otherwise(0.0)), F.sum(F.when(above, 0.0).otherwise(F.col("weight")))).first()
        if n == before or not open_weight:
            break
        before, level = n, (share * total - capped) / open_weight
    return t.select("source", "source_size", "weight", F.least(F.col("cap"), F.lit(level) * F.col("weight")).alias("target"))


def copies(doc_id: Column, target: Column, source_size: Column, seed: str = SEED) -> Column:
    rate = F.when(source_size > 0, target / source_size).otherwise(0.0)
    return (F.floor(rate) + F.when(draw(doc_id, seed) < rate - F.floor(rate), 1).otherwise(0)).cast("long")


def mix_report(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken of every row."""
    sized = written(docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["source"].cast("string").alias("source"), word_count(docs["text"]).alias("size")), "sized")
    t = targets(sized)
    joined = sized.alias("d").join(t.alias("t"), F.col("d.source").eqNullSafe(F.col("t.source")))
    return joined.select("doc_id", "size", "source_size", "target", (F.col("size") * copies(F.col("doc_id"), F.col("target"), F.col("source_size"))).alias("taken"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of docs, each as often as the mix takes it."""
    sized = docs.select(docs[source_col].cast("string").alias("source"), word_count(docs[text_col]).alias("size"))
    t = targets(sized.groupBy("source").agg(F.sum("size").alias("size")))
    # a row travels as one struct, so that its columns' names can't clash with these
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"), docs[source_col].cast("string").alias("of"), docs[id_col].alias("id"))
    joined = rows.join(t, F.col("of").eqNullSafe(F.col("source")))
    n = copies(F.col("id"), F.col("target"), F.col("source_size"))
    return joined.select("row", F.explode(F.array_repeat(F.lit(1), n.cast("int")))).select("row.*")


ORACLE = r"""
WITH sized AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
per_source AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (SELECT source, source_size, 2.0 * source_size::DOUBLE AS cap,
  CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS w FROM per_source),
ordered AS (SELECT *, coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE) AS caps_before,
  sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w_left, sum(source_size::DOUBLE) OVER () AS total FROM weighed),
levels AS (SELECT *, (1.5::DOUBLE * total - caps_before) / w_left AS level FROM ordered),
final AS (SELECT (SELECT level FROM levels WHERE cap / w >= level ORDER BY cap / w, source NULLS LAST LIMIT 1) AS level),
t AS (SELECT source, source_size, CASE WHEN final.level IS NULL THEN cap ELSE least(cap, final.level * w) END AS target FROM levels CROSS JOIN final),
rated AS (SELECT d.doc_id, d.size, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate,
  ('0x' || substr(md5('mix-1:' || coalesce(d.doc_id::VARCHAR, '')), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u
  FROM sized d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, (size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken FROM rated
"""
