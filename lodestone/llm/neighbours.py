"""Approximate nearest neighbours by adaptive dimension scan of inverted lists.

Largest inner products become smallest distances by one more coordinate (every vector gets the same norm). Lists come
from k-means on a bounded sample; every vector is indexed. All vectors are turned by one random rotation, after which
the first d of D coordinates estimate a distance without bias, with a relative deviation of about sqrt((1 - d/D) / 2d).
Within each probed list the coordinates are read in blocks; a candidate is abandoned once its partial distance is so
large that the hypothesis "it is nearer than the k-th so far" is rejected. How many deviations reject is fitted on the
sample's true neighbours, as is the number of probed lists. What is left is scored exactly in double precision on the
original vectors.

Lists that lie close together form groups of bounded size; a larger list is several blocks. Only the original vectors
are shuffled, a query once for each group that it probes and a list's vector once for each block of queries: a vector
that a third of all rows share fills many blocks, not one task.

Defined results: vectors that are null, zero, or hold null or non-finite components, rows without vec_id, and vectors
of another length than the most frequent one take no part; very large and very small ones do; equal vectors tie, the
smaller vec_id first; a query never finds rows of its own vec_id; where a query's vec_id repeats, the vector of the
smallest bytes asks; with fewer than k candidates all are returned; scores that overflow are infinite, and undefined ones
come last; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import schemas, written

SAMPLE = 20_000  # vectors, about, that the lists, the number of probes, the test and the first radius are fitted on
BLOCK = 4_096  # vectors, about, in a group of lists or in a block of a larger list
RADIUS = 3  # a query's first radius reaches to its (3 k)-th nearest of the sample
QUERY_BLOCK = 4_096  # queries, about, in a block
SCANNED = 128  # queries scanned together
COLUMNS = 8  # coordinates read between two tests
DENSE = 0.2  # part of candidates still looked at, above which a block of columns is read by one matrix product
KEPT = 0.99  # part of true neighbours that no test may abandon, on the sample


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id, v (array<double>), most (root mean square of v's components, without overflow) of the vectors that take part."""
    v = vectors.select(vectors[id_col].cast("long").alias("vec_id"), vectors[vector_col].cast("array<double>").alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = v.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & ~F.coalesce(bad, F.lit(True))).withColumn("top", F.array_max(F.transform("v", F.abs))).where("top > 0")
    squares = F.aggregate("v", F.lit(0.0), lambda a, x: a + (x / F.col("top")) * (x / F.col("top")))
    return whole.select("vec_id", "v", (F.col("top") * F.sqrt(squares / F.size("v"))).alias("most"))


def rotation(n: int, seed: int = 11) -> np.ndarray:
    return np.linalg.qr(np.random.default_rng(seed).normal(size=(n, n)))[0]


def nearest_rows(x: np.ndarray, centres: np.ndarray, n: int) -> np.ndarray:
    """The n nearest centres of each row of x, nearest first."""
    d = (centres * centres).sum(axis=1)[None, :] - 2 * x @ centres.T
    some = np.argpartition(d, min(n, d.shape[1]) - 1, axis=1)[:, :n]
    return np.take_along_axis(some, np.argsort(np.take_along_axis(d, some, axis=1), axis=1, kind="stable"), axis=1)


def k_means(x: np.ndarray, k: int, rounds: int = 8, seed: int = 5) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        own = nearest_rows(x, centres, 1)[:, 0]
        n = np.bincount(own, minlength=k)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        some = n > 0
        centres[some] = sums[some] / n[some, None]
    return centres


def deviation(d: int, dims: int) -> float:
    """What the test counts in: the first d of dims coordinates estimate a distance to about this relative error."""
    return math.sqrt((1 - d / dims) / d)


class Lists:
    """What the bounded sample teaches: centres, rotation, scale, probes and the test."""

    def __init__(self, sample: np.ndarray, most: float, rows: int, k: int, recall: float):
        self.dims, self.most = sample.shape[1], most
        self.turn = rotation(self.dims + 1)
        x = self.raised(sample)
        n = int(min(len(np.unique(x, axis=0)), max(1, round(math.sqrt(rows))), 4096))
        self.centres = k_means(x, n)
        self.bound = x.astype(np.float32)
        self.probes, self.reject = self.fitted(sample, x, k, recall)

    def raised(self, v: np.ndarray) -> np.ndarray:
        """Vectors with the coordinate that evens out their norms, rotated."""
        v = v / self.most
        more = np.sqrt(np.maximum(0.0, self.dims * (1 + 1e-9) - (v * v).sum(axis=1)))
        return np.concatenate((v, more[:, None]), axis=1) @ self.turn

    def asked(self, v: np.ndarray) -> np.ndarray:
        return np.concatenate((v / self.most, np.zeros((len(v), 1))), axis=1) @ self.turn

    def fitted(self, sample: np.ndarray, x: np.ndarray, k: int, recall: float) -> tuple[int, float]:
        """Probes that reach that recall on queries from the sample, and deviations that keep KEPT of their true neighbours; each of their k nearest counts alike."""
        own = nearest_rows(x, self.centres, 1)[:, 0]
        at = np.arange(0, len(x), max(1, len(x) // 400))
        asks = self.asked(sample[at])
        near = nearest_rows(asks, self.centres, len(self.centres))
        tests = np.arange(COLUMNS, self.dims + 1, COLUMNS)
        scale = np.array([deviation(int(d), self.dims + 1) for d in tests])
        places, errors = [], [np.zeros(1)]
        for q, ask, order in zip(at, asks, near, strict=True):
            s = x @ ask
            s[q] = -np.inf
            best = np.argpartition(-s, min(k, len(s) - 1))[:k]
            rank = np.empty(len(self.centres), np.int64)
            rank[order] = np.arange(len(self.centres))
            places.append(rank[own[best]])
            parts = np.cumsum((x[best] - ask) ** 2, axis=1)
            seen = np.sqrt(parts[:, tests - 1] * (self.dims + 1) / tests / np.maximum(parts[:, -1:], 1e-300))
            errors.append(((seen - 1) / scale).max(axis=1, initial=0.0))
        return int(np.quantile(np.concatenate(places), recall, method="higher")) + 1, float(np.quantile(np.concatenate(errors), KEPT, method="higher"))

    def radius2(self, asks: np.ndarray, k: int) -> np.ndarray:
        """For each query a squared distance that its (RADIUS k)-th nearest of the sample doesn't exceed; the query itself may be among them."""
        far = min(RADIUS * k, len(self.bound) - 1)
        if far < k:
            return np.full(len(asks), np.inf)
        norms, out = np.einsum("ij,ij->i", self.bound, self.bound), np.empty(len(asks))
        for lo in range(0, len(asks), 64):
            q = asks[lo : lo + 64]
            d = norms[None, :] - 2 * (q.astype(np.float32) @ self.bound.T)
            out[lo : lo + 64] = np.partition(d, far, axis=1)[:, far] + (q * q).sum(axis=1)
        return out * (1 + 1e-5) + 1e-5


def groups_of(centres: np.ndarray, held: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each list its group, and for each group its number of blocks. Lists near each other share a group of up to BLOCK vectors; a larger list is a group alone."""
    group, sizes = np.full(len(centres), -1), []
    left = set(np.flatnonzero(held).tolist())
    while left:
        here = min(left)
        size = 0
        order = nearest_rows(centres[here][None], centres, len(centres))[0].tolist()
        for c in [here, *(c for c in order if c != here)]:
            if c in left and (not size or size + held[c] <= BLOCK):
                group[c] = len(sizes)
                size += int(held[c])
                left.remove(c)
            elif c in left:
                break
        sizes.append(size)
    return group, np.array([-(-n // BLOCK) for n in sizes], np.int64)


def scan(lists: Lists, queries: np.ndarray, radius2: np.ndarray, own: np.ndarray, probed: np.ndarray, base: np.ndarray, ids: np.ndarray, k: int, read: list | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each query the up to k nearest of base, as arrays (query, place in base, score).

    radius2: no candidate beyond that squared distance can be among the query's k nearest over all rows; probed: which
    queries probe which base vector's list. While many candidates are left, a block of columns is read by one matrix
    product for all of them; then who stays is a pair of its own. read gets (coordinates that the tests ask for,
    coordinates of all candidates).
    """
    x = lists.raised(base).astype(np.float32)
    dims = x.shape[1]
    tests = [*range(COLUMNS, dims, COLUMNS), dims]
    limits = [(d / dims) * (1 + lists.reject * deviation(d, dims)) ** 2 if d < dims else 1.0 for d in tests]
    for lo in range(0, len(queries), SCANNED):
        exact = queries[lo : lo + SCANNED]
        q, r, may = lists.asked(exact).astype(np.float32), radius2[lo : lo + SCANNED].copy(), probed[lo : lo + SCANNED] & (ids[None, :] != own[lo : lo + SCANNED, None])
        counted, every = 0, int(may.sum())
        part = np.zeros((len(q), len(x)), np.float32)
        i = j = d = None
        at = 0
        for stop, limit in zip(tests, limits, strict=True):
            counted += (int(may.sum()) if i is None else len(i)) * (stop - at)
            if i is None:
                a, b = q[:, at:stop], x[:, at:stop]
                part += np.einsum("ij,ij->i", a, a)[:, None] + np.einsum("ij,ij->i", b, b)[None, :] - 2 * (a @ b.T)
                if at == 0 and len(x) > k:  # the k nearest by the first columns bound the k-th distance
                    best = np.argpartition(np.where(may, part, np.inf), k - 1, axis=1)[:, :k]
                    gap = x[best] - q[:, None, :]
                    whole = np.where(np.take_along_axis(may, best, axis=1), np.einsum("qkd,qkd->qk", gap, gap), np.inf)
                    r = np.minimum(r, whole.max(axis=1) * (1 + 1e-5) + 1e-5)
                may &= part <= (r * limit)[:, None] + 1e-5
                if may.sum() < DENSE * may.size or stop == dims:
                    i, j = np.nonzero(may)
                    d = part[i, j]
            else:
                gap = x[j, at:stop] - q[i, at:stop]
                d = d + np.einsum("ij,ij->i", gap, gap)
                stay = d <= (r * limit)[i] + 1e-5
                i, j, d = i[stay], j[stay], d[stay]
            at = stop
        if read is not None:
            read.append((counted, every * dims))
        if len(i):
            with np.errstate(all="ignore"):
                score = np.einsum("ij,ij->i", exact[i], base[j])
            order = np.lexsort((ids[j], -np.where(np.isnan(score), -np.inf, score), i))
            i, j, score = i[order], j[order], score[order]
            kept = np.arange(len(i)) - np.searchsorted(i, i) < k
            yield lo + i[kept], j[kept], score[kept]


def search(vectors: DataFrame, k: int = 20, every: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", recall: float = 0.95) -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose id is divisible by `every` its k nearest of all other rows.

    recall: the part of true neighbours that the probed lists hold, on the sample that the number of probes is fitted to.
    """
    spark = vectors.sparkSession
    out, kinds = schemas("query_id long, vec_id long, score double")
    final = "query_id long, rank int, vec_id long, score double"
    good = usable(vectors, id_col, vector_col)
    sizes = good.groupBy(F.size("v").alias("dims")).agg(F.count("*").alias("n"), F.max("most").alias("most")).orderBy(F.desc("n"), "dims").first()
    if sizes is None:
        return spark.createDataFrame([], final)
    dims, rows, most = sizes
    good = good.where(F.size("v") == dims)
    draw = F.pmod(F.xxhash64("vec_id", F.lit("lists")), F.lit(1 << 30))
    sample = good.where(draw < int((1 << 30) * min(1.0, SAMPLE / rows))).select("vec_id", "v").toArrow().sort_by("vec_id")
    if sample.num_rows == 0:
        sample = good.orderBy("vec_id").limit(1).select("vec_id", "v").toArrow()
    matrix = sample.column("v").combine_chunks().flatten().to_numpy().reshape(-1, dims)
    lists = Lists(matrix[np.random.default_rng(3).permutation(len(matrix))], most, rows, k, recall)
    kind = np.float32 if "array<float>" in (t for c, t in vectors.dtypes if c == vector_col) else np.float64  # as stored: exact either way

    def matrix_of(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
        return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, dims).astype(np.float64)

    def index(batches):
        for batch in batches:
            v = batch.column(1).flatten().to_numpy().reshape(-1, dims)
            own = nearest_rows(lists.raised(v), lists.centres, 1)[:, 0].astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own), pa.array([r.tobytes() for r in v.astype(kind)], pa.binary())], ["vec_id", "list", "v"])

    indexed = written(good.select("vec_id", "v").mapInArrow(index, "vec_id long, list int, v binary"), "index")
    held = np.zeros(len(lists.centres), np.int64)
    for c, n in indexed.groupBy("list").agg(F.count("*").alias("n")).collect():  # a row a list: 4096 at most
        held[c] = n
    group, blocks = groups_of(lists.centres, held)

    def ask(batches):
        for batch in batches:
            v = matrix_of(batch.column(1))
            q = lists.asked(v)
            near = nearest_rows(q, lists.centres, len(lists.centres)) if len(q) else []
            # farther lists are probed too where the near ones hold too few rows
            some = [order[: max(lists.probes, int(np.searchsorted(np.cumsum(held[order]), k + 1)) + 1)] for order in near]
            some = [order[held[order] > 0] for order in some]
            places = [[(i, g, b) for g in np.unique(group[order]).tolist() for b in range(blocks[g])] for i, order in enumerate(some)]
            at = np.array([x for p in places for x in p], np.int64).reshape(-1, 3)
            to = [some[i][group[some[i]] == g].astype(np.int32).tolist() for i, g, _ in at.tolist()]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at[:, 0])), pa.array(at[:, 1].astype(np.int32)), pa.array(at[:, 2].astype(np.int32)), pa.array(to, pa.list_(pa.int32())), batch.column(1).take(pa.array(at[:, 0])), pa.array(lists.radius2(q, k)[at[:, 0]])], ["query_id", "group", "block", "to", "v", "radius2"])

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    queries = indexed.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("v").alias("v")).repartition(parts, "vec_id")
    asked = written(queries.mapInArrow(ask, "query_id long, group int, block int, to array<int>, v binary, radius2 double"), "asked")
    counts = {g: n for g, n in asked.where("block = 0").groupBy("group").agg(F.count("*").alias("n")).collect()}  # a row a group, of which there are fewer than lists
    if not counts:
        return spark.createDataFrame([], final)
    # a row a list, and a row a group
    of_list = spark.createDataFrame([(c, int(g), int(blocks[g])) for c, g in enumerate(group.tolist()) if g in counts], "list int, group int, blocks int")
    of_group = spark.createDataFrame([(g, -(-n // QUERY_BLOCK)) for g, n in sorted(counts.items())], "group int, query_blocks int")
    keys = ["group", "block", "query_block"]

    def cell(base: pa.Table, asks: pa.Table) -> pa.Table:
        got: list[tuple] = []
        if base.num_rows and asks.num_rows:
            ids, own = base.column("vec_id").to_numpy(), asks.column("query_id").to_numpy()
            here, of = np.unique(base.column("list").to_numpy(), return_inverse=True)
            to = asks.column("to").combine_chunks()
            probes = np.zeros((asks.num_rows, len(here) + 1), np.bool_)
            found = np.searchsorted(here, np.asarray(to.flatten()))
            found[(found < len(here)) & (here[np.minimum(found, len(here) - 1)] != np.asarray(to.flatten()))] = len(here)  # a list of which no vector is in this block
            probes[np.repeat(np.arange(asks.num_rows), np.asarray(to.value_lengths())), found] = True
            for i, j, s in scan(lists, matrix_of(asks.column("v")), asks.column("radius2").to_numpy(), own, probes[:, of], matrix_of(base.column("v")), ids, k):
                got.append((own[i], ids[j], s))
        columns = [np.concatenate(c) for c in zip(*got, strict=True)] if got else [[], [], []]
        return pa.Table.from_arrays([pa.array(c, kind.type) for c, kind in zip(columns, kinds, strict=True)], schema=kinds)

    to = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    base = indexed.join(F.broadcast(of_list), "list").join(F.broadcast(of_group), "group").withColumn("block", F.pmod(F.xxhash64("vec_id"), "blocks").cast("int")).withColumn("query_block", to("query_blocks")).select(*keys, "vec_id", "list", "v")

    def scanned(asks: DataFrame) -> DataFrame:
        right = asks.join(F.broadcast(of_group), "group").withColumn("query_block", F.pmod(F.xxhash64("query_id"), "query_blocks").cast("int")).select(*keys, "query_id", "to", "v", "radius2")
        found = base.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(cell, out)
        order = Window.partitionBy("query_id").orderBy(F.desc(F.nanvl("score", F.lit(float("-inf")))), "vec_id")
        return written(found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"), "nearest")

    nearest = scanned(asked)
    short = asked.join(nearest.where(F.col("rank") == k).select("query_id"), "query_id", "left_anti")
    if short.isEmpty():
        return nearest
    # queries with fewer than k rows within the first radius look again without one
    again = scanned(short.withColumn("radius2", F.lit(float("inf"))))
    return nearest.join(short.select("query_id").distinct(), "query_id", "left_anti").unionByName(again)
