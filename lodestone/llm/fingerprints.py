"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A text is cut into paragraphs at line ends, and those further at sentence and clause marks, so that a change inside a
long paragraph stays local. Each piece has a 64-bit key: 44 bits of digest (of its bytes and of how many equal pieces
stand before it) and its length in 20 bits. A sketch is a table of cells (count, XOR of keys, XOR of checks); every
key goes into three of them. The sketches of two versions subtract cell by cell; peeling cells with one key left
recovers the keys that only one version has. Where the fingerprints' own tables are too small for the difference they
fail to peel, and tables of the same keys in larger sizes are tried, each with hashes of its own, until they peel; the
size that did is returned with each likeness. Likeness is the part of bytes that both versions share, of all bytes of either.

Defined results: a null text counts as empty; two empty texts have likeness 1; equal texts have equal fingerprints;
texts of any length are read whole; equal rows give equal rows; ties of doc_id are ordered by text; an empty table
gives no rows; a single row is its own next; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import schemas

CELLS = 24  # of the sketch in the fingerprint
HASHES = 3
LENGTH_BITS = np.uint64(20)
MOST_PIECE = 1 << 19  # bytes; a longer piece is cut, so that its length fits its bits
U = np.uint64

_rng = np.random.default_rng(20)
BYTE_CODES = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)
MARKS = np.zeros(256, np.bool_)
MARKS[list(b".!?;,|")] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (the public splitmix64 steps)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[0] = 1
    done, step = 1, base & (2**64 - 1)
    while done < n:
        k = min(done, n - done)
        out[done : done + k] = out[:k] * U(step)
        done, step = done + k, step * step & (2**64 - 1)
    return out


class Pieces:
    """Keys of the pieces of several texts: keys[first[i]:first[i + 1]] are text i's, sorted; size[i] its bytes."""

    def __init__(self, texts: list[bytes]):
        blob = b"".join(texts)
        b = np.frombuffer(blob, np.uint8)
        ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
        cut = np.zeros(len(b) + 1, np.bool_)
        if len(b):
            cut[1:] = b == 10
            cut[1:-1] |= MARKS[b[:-1]] & (b[1:] == 32)
            cut[MOST_PIECE::MOST_PIECE] = True
        cut[ends] = True
        cut[0] = False
        stop = np.flatnonzero(cut)
        start = np.concatenate(([0], stop[:-1])).astype(np.int64)
        if not len(b):
            stop, start = stop[:0], start[:0]
        owner = np.searchsorted(ends, start, "right")
        if len(b):
            p = powers(BASE, len(b))
            sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(BYTE_CODES[b] * p, dtype=np.uint64)))
            digest = mixed((sums[stop] - sums[start]) * powers(BASE_INVERSE, len(b))[start] + (stop - start).astype(np.uint64))
        else:
            digest = np.zeros(0, np.uint64)
        length = (stop - start).astype(np.uint64)
        order = np.lexsort((digest, owner))
        digest, length, owner = digest[order], length[order], owner[order]
        if len(digest):  # the k-th of equal pieces of a text gets k into its digest
            new = np.concatenate(([True], (digest[1:] != digest[:-1]) | (owner[1:] != owner[:-1])))
            at = np.arange(len(digest))
            nth = at - np.maximum.accumulate(np.where(new, at, 0))
            digest = np.where(nth > 0, mixed(digest + nth.astype(np.uint64) * U(BASE)), digest)
        self.keys = (digest >> LENGTH_BITS << LENGTH_BITS) | length
        self.first = np.searchsorted(owner, np.arange(len(texts) + 1))
        self.size = np.array([len(t) for t in texts], np.int64)

    def of(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Keys of those texts one after the other, and each key's place in `which`."""
        n = self.first[which + 1] - self.first[which]
        owner = np.repeat(np.arange(len(which)), n)
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.first[which], n)
        return self.keys[at], owner


class Sketch:
    """Tables of equal size, one for each of n texts."""

    def __init__(self, n: int, cells: int):
        self.n, self.cells = n, cells
        self.count, self.key, self.check = np.zeros(n * cells, np.int64), np.zeros(n * cells, np.uint64), np.zeros(n * cells, np.uint64)

    def places(self, keys: np.ndarray, owner: np.ndarray) -> list[np.ndarray]:
        """The cells of each key: one in each third of its table."""
        third = self.cells // HASHES
        return [owner * self.cells + k * third + (mixed(keys + U(k + 1 + 8 * self.cells)) % U(third)).astype(np.int64) for k in range(HASHES)]

    def put(self, keys: np.ndarray, owner: np.ndarray, sign: np.ndarray | int) -> list[np.ndarray]:
        check, at = mixed(keys ^ U(0x5851F42D4C957F2D)), self.places(keys, owner)
        for place in at:
            np.add.at(self.count, place, sign)
            np.bitwise_xor.at(self.key, place, keys)
            np.bitwise_xor.at(self.check, place, check)
        return at

    def __sub__(self, other: Sketch) -> Sketch:
        out = Sketch.__new__(Sketch)
        out.n, out.cells = self.n, self.cells
        out.count, out.key, out.check = self.count - other.count, self.key ^ other.key, self.check ^ other.check
        return out

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Empties the tables as far as it goes: the recovered keys, their tables and signs, and which tables are empty now."""
        out, watch = [], np.arange(self.n * self.cells)
        while len(watch):
            pure = watch[np.abs(self.count[watch]) == 1]
            pure = pure[mixed(self.key[pure] ^ U(0x5851F42D4C957F2D)) == self.check[pure]]
            if not len(pure):
                break
            owner, key = pure // self.cells, self.key[pure]
            _, one = np.unique(mixed(key + owner.astype(np.uint64) * U(BASE)), return_index=True)
            pure, owner, key = pure[one], owner[one], key[one]
            sign = self.count[pure]
            out.append((key, owner, sign))
            watch = np.concatenate(self.put(key, owner, -sign))
        full = (self.count != 0) | (self.key != 0) | (self.check != 0)
        empty = ~full.reshape(self.n, self.cells).any(axis=1)
        keys, owner, sign = (np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))
        return keys, owner, sign, empty

    def text(self, i: int) -> str:
        """Cells as hex: count (4 bytes), key (8), check (8)."""
        row = slice(i * self.cells, (i + 1) * self.cells)
        return np.rec.fromarrays((self.count[row].astype(">i4"), self.key[row].astype(">u8"), self.check[row].astype(">u8"))).tobytes().hex()


def rounded(cells: np.ndarray) -> np.ndarray:
    """The next size of a geometric scale, so that pairs of about one size share a pass."""
    return (CELLS * np.ceil(2 ** (np.ceil(2 * np.log2(np.maximum(cells, CELLS) / CELLS)) / 2))).astype(np.int64)


def sketch(pieces: Pieces, which: np.ndarray, cells: int) -> Sketch:
    s = Sketch(len(which), cells)
    s.put(*pieces.of(which), 1)
    return s


def peeled(a: Pieces, i: np.ndarray, b: Pieces, j: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For pairs (a's text i, b's text j): keys that one side alone has, the pair of each, and its sign (1: a's); and for each pair the cells that peeled.

    The first tables have the fingerprint's size. Where they don't peel, their counts tell about how many keys differ
    (signs average out, so that the squares of a third's counts add up to that number), and tables of two cells for each
    of those are tried, then twice as large ones until they peel.
    """
    keys, pair, sign = [], [], []
    keys_of = (a.first[i + 1] - a.first[i]) + (b.first[j + 1] - b.first[j])
    size = np.full(len(i), CELLS)
    left = np.arange(len(i))
    while len(left):
        again = []
        sizes = size[left]
        for cells in np.unique(sizes).tolist():
            alike = left[sizes == cells]
            block = max(1, (1 << 20) // cells)
            for at in range(0, len(alike), block):
                some = alike[at : at + block]
                tables = sketch(a, i[some], cells) - sketch(b, j[some], cells)
                squares = (tables.count.reshape(len(some), HASHES, -1) ** 2).sum(axis=2).min(axis=1)
                got, owner, s, empty = tables.peel()
                good = empty[owner]
                keys.append(got[good])
                pair.append(some[owner[good]])
                sign.append(s[good])
                failed = some[~empty]
                again.append(failed)
                size[failed] = rounded(np.maximum(2 * cells, 2 * np.minimum(squares[~empty], keys_of[failed])))
        left = np.concatenate(again) if again else left[:0]
    return *(np.concatenate(x) if x else np.zeros(0, t) for x, t in ((keys, np.uint64), (pair, np.int64), (sign, np.int64))), size


def differing(a: Pieces, i: np.ndarray, b: Pieces, j: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return peeled(a, i, b, j)[:3]


def likeness(a: Pieces, i: np.ndarray, b: Pieces, j: np.ndarray) -> np.ndarray:
    return likeness_and_cells(a, i, b, j)[0]


def likeness_and_cells(a: Pieces, i: np.ndarray, b: Pieces, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys, pair, _, cells = peeled(a, i, b, j)
    apart = np.bincount(pair, (keys & U((1 << 20) - 1)).astype(np.float64), len(i))
    shared = (a.size[i] + b.size[j] - apart) / 2
    total = shared + apart
    return np.clip(np.where(total > 0, shared / np.maximum(total, 1), 1.0), 0.0, 1.0), cells


def fingerprints_of(pieces: Pieces) -> list[str]:
    n = len(pieces.size)
    s = sketch(pieces, np.arange(n), CELLS)
    return [f"iblt1:{pieces.first[k + 1] - pieces.first[k]}:{pieces.size[k]}:{s.text(k)}" for k in range(n)]


def fingerprint(text: str | None) -> str:
    return fingerprints_of(Pieces([(text or "").encode("utf-8", "surrogatepass")]))[0]


def changed_pieces(old: str | None, new: str | None) -> tuple[list[int], list[int]]:
    """Digests of the pieces that only old and only new has, sorted."""
    a, b = (Pieces([(t or "").encode("utf-8", "surrogatepass")]) for t in (old, new))
    keys, _, sign = differing(a, np.array([0]), b, np.array([0]))
    return sorted(keys[sign > 0].tolist()), sorted(keys[sign < 0].tolist())


def edited(text: str, following: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def compared(rows: list[tuple[int | None, str]], following: list[str]) -> list:
    """Columns for rows (doc_id, text), each with the text of the next document."""
    texts = [t for _, t in rows]
    raw = lambda ts: [t.encode("utf-8", "surrogatepass") for t in ts]
    new = raw(map(edited, texts, following))
    # following is texts shifted by one, but for the last row
    own, other = Pieces(raw([*texts, following[-1]])), Pieces(new)
    n = len(rows)
    at = np.arange(n)
    marks = fingerprints_of(own)[:n]
    (near_edited, edited_cells), (near_next, next_cells) = likeness_and_cells(own, at, other, at), likeness_and_cells(own, at, own, at + 1)
    return [[d for d, _ in rows], list(map(len, texts)), [hashlib.sha256(x).hexdigest() for x in new], marks, fingerprints_of(other), near_edited, near_next, edited_cells, next_cells]


SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, edited_cells int, next_cells int"


def fingerprint_report(docs: DataFrame, block_bytes: int = 1 << 20, ranges: int | None = None) -> DataFrame:
    """Every document's fingerprint, and its likeness to its edited text and to the next document in descending doc_id.

    The id range is cut into `ranges` runs of about equal counts. One shuffle brings each run together and sorts it;
    the first document of each run is also sent to the end of the run before it, as its last document's next.
    """
    spark = docs.sparkSession
    n = ranges or 4 * max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"))
    bounds = rows.agg(F.percentile_approx("doc_id", [k / n for k in range(1, n)], 2000)).first()[0] or []
    bounds = sorted(set(bounds), reverse=True)
    # run 0 holds the largest ids, nulls come last; equal ids share a run
    run = F.when(F.col("doc_id").isNull(), F.lit(len(bounds))).otherwise(F.lit(len(bounds)) - F.size(F.filter(F.array(*map(F.lit, bounds)).cast("array<long>"), lambda b: b < F.col("doc_id"))))
    rows = rows.withColumn("run", run)
    tops = sorted((r["run"], r["top"]) for r in rows.groupBy("run").agg(F.max("doc_id").alias("top")).collect())  # a row for each run
    if not tops:
        return spark.createDataFrame([], SCHEMA)
    ids = [top for _, top in tops if top is not None]
    first = rows.where(F.col("doc_id").isin(ids)) if len(ids) == len(tops) else rows.where(F.col("doc_id").isin(ids) | F.col("doc_id").isNull())
    present = [r for r, _ in tops]
    before = F.element_at(F.create_map(*[F.lit(x) for k, r in enumerate(present) for x in (r, present[k - 1])]), F.col("run"))
    heads = first.groupBy("run").agg(F.min("text").alias("text")).select(F.lit(None).cast("long").alias("doc_id"), "text", before.alias("run"), F.lit(True).alias("head"))
    dealt = rows.withColumn("head", F.lit(False)).unionByName(heads).repartition("run").sortWithinPartitions("run", "head", F.desc_nulls_last("doc_id"), "text")

    out, kinds = schemas(SCHEMA)

    def run_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(block, tail):
            columns = compared(block, [*(t for _, t in block[1:]), tail])
            return pa.RecordBatch.from_arrays([pa.array(c, type=k.type) for c, k in zip(columns, kinds, strict=True)], schema=kinds)

        block: list[tuple[int | None, str]] = []
        size = 0
        for batch in batches:
            for doc_id, text, head in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if block and (head or size >= block_bytes):
                    yield made(block, text)
                    block, size = [], 0
                if not head:
                    block.append((doc_id, text))
                    size += len(text)

    return dealt.mapInArrow(run_all, out)
