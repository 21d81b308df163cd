"""Best-fit packing into bins of several permitted lengths.

Documents become pieces of at most the longest permitted length; pieces are packed best-fit, longest first: a piece goes
where the least room stays. If no open bin has room, a bin is opened. Which length to open depends on the others: several
opening rules (open at least each permitted length; open the length of the least cost a token that the pieces still to
come can fill) are tried on the whole shard, every bin is downsized to the shortest length that holds its contents, and
the rule of the least total cost stands.

A document of n words has n + 1 tokens: its words and an end mark. Shards are by hash, so each packs alone; their number
follows the number of pieces.

Defined results: null and empty texts have one token, their end mark; a document longer than the longest length is cut
into full pieces and a rest; equal rows are packed as rows of their own; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import schemas, written
from .mixing import word_count

LENGTHS = (512, 1024, 2048, 4096)
OVERHEAD = 16  # tokens' worth of cost that each sequence has besides its length
PER_SHARD = 20_000
COPIES = 10_000  # of one id and size that are numbered together


def cost_of(length: int) -> int:
    return length + OVERHEAD


def downsized(used: int, lengths: Sequence[int]) -> int:
    return next(c for c in lengths if c >= used)


def best_fit(sizes: Sequence[int], lengths: Sequence[int], opening: Callable[[int, int], int]) -> tuple[list[int], list[int]]:
    """Bins of sizes (descending), and each bin's use. opening(size, tokens still to come) says which length a new bin has.

    Open bins stand in stacks by the room they have left; a bit for each room that has a bin finds the tightest one.
    """
    stacks: list[list[int]] = [[] for _ in range(lengths[-1] + 1)]
    rooms = 0
    left = sum(sizes)
    place, capacity, used = [], [], []
    for size in sizes:
        fits = rooms >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            b = stacks[room].pop()
            if not stacks[room]:
                rooms &= ~(1 << room)
        else:
            b = len(used)
            capacity.append(opening(size, left))
            used.append(0)
            room = capacity[b]
        used[b] += size
        room -= size
        if room:
            stacks[room].append(b)
            rooms |= 1 << room
        place.append(b)
        left -= size
    return place, used


def pack(sizes: Sequence[int], lengths: Sequence[int] = LENGTHS) -> tuple[list[int], list[int]]:
    """For sizes (descending) each one's bin, and each bin's length, by the opening rule of the least total cost."""
    lengths = sorted(lengths)

    def at_least(c: int) -> Callable[[int, int], int]:
        return lambda size, left: max(c, downsized(size, lengths))

    def cheapest(size: int, left: int) -> int:
        return min((c for c in lengths if c >= size), key=lambda c: (cost_of(c) / min(c, left), c))

    best: tuple[int, list[int], list[int]] | None = None
    for rule in (*map(at_least, reversed(lengths)), cheapest):
        place, used = best_fit(sizes, lengths, rule)
        bins = [downsized(u, lengths) for u in used]
        total = sum(map(cost_of, bins))
        if best is None or total < best[0]:
            best = total, place, bins
    return (best[1], best[2]) if best else ([], [])


def packed(docs: DataFrame, lengths: Sequence[int] = LENGTHS, per_shard: int = PER_SHARD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, copy, piece, start (first token in the document), n_tokens, bin_id, bin_length, bin_offset of every piece; copy tells rows of one id apart."""
    lengths = tuple(sorted(lengths))
    most = lengths[-1]
    sized = docs.select(docs[id_col].cast("long").alias("doc_id"), (word_count(docs[text_col].cast("string")) + 1).alias("tokens"))
    per_id = sized.groupBy("doc_id", "tokens").agg(F.count("*").alias("copies"))
    # copies are numbered by two short sequences, so that no array grows with them
    many = per_id.select("doc_id", "tokens", "copies", F.explode(F.sequence(F.lit(0), F.floor((F.col("copies") - 1) / COPIES))).alias("part"))
    rows = many.select("doc_id", "tokens", F.explode(F.sequence(F.col("part") * COPIES, F.least(F.col("copies"), (F.col("part") + 1) * COPIES) - 1)).alias("copy"))
    cut = rows.select("doc_id", "tokens", "copy", F.explode(F.sequence(F.lit(0), F.floor((F.col("tokens") - 1) / most).cast("int"))).alias("piece"))
    pieces = written(cut.select("doc_id", "copy", "piece", (F.col("piece").cast("long") * most).alias("start"), F.least(F.col("tokens") - F.col("piece").cast("long") * most, F.lit(most)).cast("int").alias("n_tokens")), "pieces")
    shards = max(1, -(-pieces.count() // per_shard))
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("doc_id", "copy", "piece"), F.lit(shards)).cast("long"))
    out, kinds = schemas("doc_id long, copy long, piece int, start long, n_tokens int, bin_id string, bin_length int, bin_offset int")

    def one(t: pa.Table) -> pa.Table:
        sizes, ids = t.column("n_tokens").to_numpy(), t.column("doc_id")
        # nulls first, then ids as whole numbers, so that the order never depends on the shuffle's
        order = np.lexsort((t.column("piece").to_numpy(), t.column("copy").to_numpy(), ids.fill_null(0).to_numpy(), ids.is_valid().to_numpy(), -sizes.astype(np.int64)))
        place, bins = pack(sizes[order].tolist(), lengths)
        shard, offset, at = t.column("shard")[0].as_py(), [0] * len(bins), []
        for b, n in zip(place, sizes[order].tolist(), strict=True):
            at.append(offset[b])
            offset[b] += n
        t = t.take(pa.array(order)).select(["doc_id", "copy", "piece", "start", "n_tokens"])
        for name, values in (("bin_id", [f"{shard}-{b}" for b in place]), ("bin_length", [bins[b] for b in place]), ("bin_offset", at)):
            t = t.append_column(name, pa.array(values, kinds.field(name).type))
        return t.cast(kinds)

    return dealt.groupBy("shard").applyInArrow(one, out)
