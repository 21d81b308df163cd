"""Near-duplicate classes by Order MinHash and banded alignment.

A text is its lower-cased words (runs without ASCII white space). Its k-mers are two consecutive words, labelled with
how many equal ones stand before. Each of several hash functions picks the few smallest labelled k-mers; their hashes
in text order are one sketch. Two texts share a sketch with a probability that grows with the k-mers they share and
falls if those stand in another order, so sketches are sensitive to edit similarity. Candidates share a sketch; they
are linked if their word-level edit distance, by alignment in a growing band of diagonals, is at most a fifth of the
longer text's words. Classes are the connected components of the links.

No task sees all pairs of a large group. Texts of equal words are one node. Each bucket (the nodes of one sketch) has a
leader; at first every node is compared with the leader that it shares most sketches with, and only buckets that then
hold several components stay open. Small open buckets are compared in full; larger ones for some rounds with new
leaders. What is left then, pairs of a large bucket in different components, is compared in full, in blocks of nodes: no
link between different components is lost that a shared sketch shows. Where a fifth of the words is replaced, all apart from each other, texts still share three fifths of their
k-mers, which is a Jaccard similarity of 0.43: such pairs, the worst of those to link, share four of 48 sketches on
average, and none about twice in a hundred; edits that stand together or are fewer leave more. No number of partners, candidates or bucket entries is capped.

Every row gets a key of its own at first, and the texts are shuffled once, into buckets by that key. Texts for the
comparisons and the rows that are kept are found there, so neither repeated nor null ids matter, and no text is
shuffled by a key that many rows share.

Defined results: null texts count as empty; texts without a word are one class; texts of one word are one
k-mer; a class is named by its smallest doc_id (null if all its ids are null); equal rows are in one class; rows of one
id with different texts are in the classes of their texts; texts are read whole; an empty table gives no rows; in the
query other columns are ignored, in `deduplicated` they pass through.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bucketed, map_rows, schemas, written
from .fingerprints import BASE, BASE_INVERSE, BYTE_CODES, U, mixed, powers

WORDS = 2
SKETCHES = 48
PICKED = 3
SIMILARITY = 0.8
SMALL = 16  # nodes of a bucket up to which all its open pairs are compared after the first leader
ROUNDS = 3  # of leaders in larger buckets, at most, after the first
HUB_BLOCK = 64  # nodes, about, that are compared with one copy of a leader's text
BAG = 64  # counts of a text's words by hash, which bound the edit distance of many pairs at once
ONE_TASK = 200_000  # edges that one task joins up, at most: a few MB
OUTSIDE_BLOCK, ALL_BLOCK = 64, 256  # nodes, about, of either side of a block of the last comparison
_seeds = np.random.default_rng(9)
XOR = _seeds.integers(0, 1 << 63, SKETCHES, dtype=np.uint64)
ODD = _seeds.integers(0, 1 << 63, SKETCHES, dtype=np.uint64) * U(2) + U(1)
ORDER_CODES = _seeds.integers(0, 1 << 63, max(PICKED, WORDS), dtype=np.uint64) * U(2) + U(1)
SPACE = np.zeros(256, np.bool_)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "surrogatepass").split()


def node_of(text: str | None) -> tuple[bytes, int]:
    """A digest of the words and their number."""
    words = words_of(text)
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest(), len(words)


def word_hashes(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts, and for each text where its words start (with the end)."""
    blob = b" ".join([*raw, b""])
    b = np.frombuffer(blob, np.uint8)
    inside = np.concatenate(([False], ~SPACE[b], [False]))
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    start, stop = edge[::2], edge[1::2]
    ends = np.cumsum([0] + [len(r) + 1 for r in raw])
    first = np.searchsorted(start, ends)
    if not len(b):
        return np.zeros(0, np.uint64), first
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(BYTE_CODES[b] * powers(BASE, len(b)), dtype=np.uint64)))
    return mixed((sums[stop] - sums[start]) * powers(BASE_INVERSE, len(b))[start] + (stop - start).astype(np.uint64)), first


def labelled(words: np.ndarray) -> np.ndarray:
    """Hashes of the k-mers of one text's words, in text order, with their occurrence numbers in them."""
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    k = min(WORDS, n)
    h = np.zeros(n - k + 1, np.uint64)
    for i in range(k):
        h = (h ^ words[i : n - k + 1 + i]) * ORDER_CODES[i]
        h ^= h >> U(29)
    order = np.argsort(h, kind="stable")
    ranked = h[order]
    at = np.arange(len(h))
    nth = at - np.maximum.accumulate(np.where(np.concatenate(([True], ranked[1:] != ranked[:-1])), at, 0))
    out = np.empty_like(h)
    out[order] = mixed(ranked + nth.astype(np.uint64) * U(BASE))
    return out


def smallest(kmers: np.ndarray, a: int, b: int, m: int) -> np.ndarray:
    """For hash functions a to b the places of their m smallest k-mers, in text order."""
    n = len(kmers)
    v = (kmers[None, :] ^ XOR[a:b, None]) * ODD[a:b, None]
    if n < 64:
        return np.sort(np.argpartition(v, m - 1, axis=1)[:, :m], axis=1)
    # about 16 values of each row are below the limit, fewer than m of them hardly ever
    row, at = np.nonzero(v < U((1 << 64) // n * 16))
    few = np.bincount(row, minlength=b - a) < m
    order = np.lexsort((v[row, at], row))
    first = np.searchsorted(row, np.arange(b - a))
    take = np.minimum(first[:, None] + np.arange(m), len(at) - 1)
    out = at[order[take]] if len(at) else np.zeros((b - a, m), np.int64)
    if few.any():
        out[few] = np.argpartition(v[few], m - 1, axis=1)[:, :m]
    return np.sort(out, axis=1)


def sketch(kmers: np.ndarray, sketches: int = SKETCHES, picked: int = PICKED) -> np.ndarray:
    """The Order MinHash sketches of a text's labelled k-mers; none for a text without words."""
    n = len(kmers)
    if not n:
        return np.zeros(0, np.int64)
    m = min(picked, n)
    out = np.empty(sketches, np.uint64)
    rows = max(1, min(sketches, (1 << 20) // n))
    for a in range(0, sketches, rows):
        b = min(sketches, a + rows)
        at = smallest(kmers, a, b, m)
        h = np.arange(a, b, dtype=np.uint64) + U(1)
        for i in range(m):
            h = mixed(h * ORDER_CODES[i] + kmers[at[:, i]])
        out[a:b] = h
    return out.view(np.int64)


def sketches_of(texts: list[str | None]) -> list[np.ndarray]:
    hashes, first = word_hashes([(t or "").lower().encode("utf-8", "surrogatepass") for t in texts])
    return [sketch(labelled(hashes[first[i] : first[i + 1]])) for i in range(len(texts))]


def edit_distance(a: list, b: list, most: int) -> int | None:
    """The edit distance of two word lists if it is at most `most`, else None.

    For p = 0, 1, ... edits the furthest place reached on each diagonal of the band |k| <= p (Ukkonen 1985).
    """
    n, m = len(a), len(b)
    lo = 0
    while lo < n and lo < m and a[lo] == b[lo]:
        lo += 1
    while n > lo and m > lo and a[n - 1] == b[m - 1]:
        n, m = n - 1, m - 1
    a, b = a[lo:n], b[lo:m]
    n, m = len(a), len(b)
    if not n or not m:
        return max(n, m) if max(n, m) <= most else None
    if abs(n - m) > most:
        return None
    goal = m - n
    far: dict[int, int] = {}
    for p in range(most + 1):
        now: dict[int, int] = {}
        for k in range(max(-p, -n, goal - (most - p)), min(p, m, goal + (most - p)) + 1):
            if p == 0:
                x = 0
            else:
                x = max(far.get(k, -2) + 1, far.get(k - 1, -2), far.get(k + 1, -2) + 1)
            x = min(x, n, m - k)
            if x < 0 or x + k < 0:
                continue
            y = x + k
            while x < n and y < m and a[x] == b[y]:
                x += 1
                y += 1
            now[k] = x
        if now.get(goal, -1) >= n:
            return p
        far = now
    return None


def similar(a: list, b: list, similarity: float = SIMILARITY) -> bool:
    """Edit similarity of the word lists is at least that; words in common bound it first."""
    longest = max(len(a), len(b))
    most = int(longest * (1 - similarity) + 1e-9)
    if abs(len(a) - len(b)) > most or longest - sum((Counter(a) & Counter(b)).values()) > most:
        return False
    return edit_distance(a, b, most) is not None


def signed(rows: DataFrame) -> DataFrame:
    """row, id, node, n_words, sketches of every row (row, id, text)."""

    def make():
        def run(part: pa.RecordBatch) -> list:
            texts = part.column(2).to_pylist()
            nodes = [node_of(t) for t in texts]
            return [part.column(0), part.column(1), [k for k, _ in nodes], [n for _, n in nodes], sketches_of(texts)]

        return run

    return map_rows(rows, "row long, id long, node binary, n_words int, sketches array<long>", make, "text", 1 << 20)


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes whose texts are linked; `n` is about how many pairs have a, at most.

    Each pair brings b's text, and each block of a's pairs a's text once; they meet by block, a's text first. So pairs
    of one much used a are many blocks, and a task holds two texts at a time.
    """
    pairs = pairs.withColumn("block", F.pmod(F.xxhash64("b"), F.ceil(F.col("n") / HUB_BLOCK)).cast("int")).drop("n")
    ends = pairs.join(texts.select(F.col("key").alias("b"), "text"), "b").select("a", "block", "b", "text")
    hubs = pairs.select("a", "block").distinct().join(texts.select(F.col("key").alias("a"), "text"), "a").select("a", "block", F.lit(None).cast("long").alias("b"), "text")
    met = ends.unionByName(hubs).repartition("a", "block").sortWithinPartitions("a", "block", F.asc_nulls_first("b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub: list = []
        for batch in batches:
            found: list[tuple[int, int]] = []
            for a, b, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3), strict=True):
                words = words_of(text.as_py())
                if b is None:
                    hub = words
                elif similar(hub, words):
                    found.append((a, b))
            yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in range(2)], ["a", "b"])

    return met.mapInArrow(run, "a long, b long")


def joined_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same as `stars` for edges (a, b) in one task, by union and find."""
    up: dict = {}
    kinds = None

    def top(x):
        while (y := up.get(x, x)) != x:
            up[x] = up.get(y, y)
            x = y
        return x

    for batch in batches:
        kinds = batch.schema
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            x, y = sorted((top(a), top(b)))
            up[y] = x
            up.setdefault(x, x)
    found = [(x, r) for x in up if (r := top(x)) != x]
    if found:
        yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], kinds.field(k).type) for k in range(2)], schema=kinds)


def stars(links: DataFrame) -> DataFrame:
    """Connected components of links (a, b): each node but the smallest of its component as (a), with the smallest (b).

    Alternating large and small stars; only a node's smallest neighbour is gathered, never its list of them. Up to ONE_TASK
    edges, counted first, go to one task instead.
    """
    edges = written(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    if edges.count() <= ONE_TASK:
        return written(edges.coalesce(1).mapInArrow(joined_up, edges.schema), "stars")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min(F.least("a", "b")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b"))).distinct()
        edges = written(small, "edges")
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == before:
            return edges
        before = now


def merged(roots: DataFrame, links: DataFrame) -> DataFrame:
    """The stars of roots after these links; only their components' smallest nodes take part in the search for components."""
    ra, rb = roots.select("a", F.col("b").alias("ra")), roots.select(F.col("a").alias("b"), F.col("b").alias("rb"))
    between = links.join(ra, "a", "left").join(rb, "b", "left").select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b")).where("a <> b").distinct()
    between = written(between, "between")
    if between.isEmpty():
        return roots
    new = stars(between)
    moved = roots.join(new.select(F.col("a").alias("b"), F.col("b").alias("c")), "b", "left").select("a", F.coalesce("c", "b").alias("b"))
    return written(moved.unionByName(new), "roots")


def close(a: str, b: str):
    """Word counts near enough for a link."""
    return F.least(a, b) >= SIMILARITY * F.greatest(a, b) - 1e-9


def linked(signs: DataFrame, nodes: DataFrame, rows: DataFrame) -> DataFrame:
    """The component stars of the nodes (key), whose sketches and texts are those of the row of that number."""
    keys = nodes.select(F.col("key").alias("row"))
    posted = signs.join(keys.hint("shuffle_hash"), "row").select(F.col("row").alias("key"), "n_words", F.explode("sketches").alias("h"))
    sizes = posted.groupBy("h").agg(F.count("*").alias("k")).where("k > 1")
    left = written(posted.join(sizes, "h").select("h", "key", "n_words", F.col("key").alias("root"), "k"), "posted")
    wanted = left.select(F.col("key").alias("row")).distinct()
    texts = bucketed(rows.join(wanted.hint("shuffle_hash"), "row").select(F.col("row").alias("key"), "text"), "key", "texts", dealt=True)
    roots = seen = None
    stuck = False
    for turn in range(ROUNDS + 2):
        if roots is not None:
            new = roots.select(F.col("a").alias("key"), F.col("b").alias("new"))
            left = written(left.join(new, "key", "left").select("h", "key", "n_words", F.coalesce("new", "key").alias("root")), "named")
        # minima alone, so that the rows of one bucket are combined before they are shuffled
        lead = F.min(F.struct(F.xxhash64("key", F.lit(turn)), F.col("key"), F.col("n_words"), F.col("root")))
        open_ = written(left.groupBy("h").agg(lead.alias("lead"), F.count("*").alias("n"), F.min("root").alias("least"), F.max("root").alias("most")).where("least <> most").select("h", "n", "lead"), "open")
        if roots is not None and open_.isEmpty():
            break
        left = written(left.select("h", "key", "n_words", "root").join(open_, "h"), "left")
        whole, rest = left, None
        if roots is not None:
            small, left = left.where(F.col("n") <= SMALL), left.where(F.col("n") > SMALL)
            a, b = small.alias("a"), small.alias("b")
            apart = (F.col("a.key") < F.col("b.key")) & (F.col("a.root") != F.col("b.root")) & close("a.n_words", "b.n_words")
            rest = a.join(b, (F.col("a.h") == F.col("b.h")) & apart).select(F.col("a.key").alias("a"), F.col("b.key").alias("b"), F.col("a.n").alias("n"))
            if turn > ROUNDS or stuck:
                found = verified(fresh_pairs(rest, seen), texts).unionByName(across(left, texts))
                return merged(roots, written(found, "links"))
        led = left.where((F.col("root") != F.col("lead.root")) & close("n_words", "lead.n_words")).select(F.col("lead.key").alias("a"), F.col("key").alias("b"), "n")
        if roots is None:
            # at first a node meets the one leader alone that it shares most sketches with: that joins most of what belongs together
            shared = led.groupBy("a", "b").agg(F.count("*").alias("k"), F.max("n").alias("n"))
            fresh = written(shared.groupBy("b").agg(F.max_by(F.struct("a", "n"), F.struct("k", "a")).alias("x")).select("x.a", "b", "x.n"), "pairs")
            links = written(verified(fresh, texts), "links")
            roots, left, seen = stars(links), whole, fresh.select("a", "b")
            continue
        fresh = written(fresh_pairs(led.unionByName(rest), seen), "pairs")
        links = written(verified(fresh, texts), "links")
        roots = merged(roots, links)
        if left.isEmpty():
            break
        stuck = links.count() < 0.1 * fresh.count()  # other leaders would find as little
        seen = seen.unionByName(fresh.select("a", "b"))
    return roots


def fresh_pairs(pairs: DataFrame, seen: DataFrame) -> DataFrame:
    """Each pair once, with its largest n, but for those seen in either order."""
    both = seen.unionByName(seen.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return pairs.groupBy("a", "b").agg(F.max("n").alias("n")).join(both, ["a", "b"], "left_anti")


def with_bags(rows: DataFrame) -> DataFrame:
    """rows (key, open, text) with bag: how many words of the text have each of BAG hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.bincount([zlib.crc32(w) % BAG for w in words_of(t)], minlength=BAG).astype(np.int32).tobytes() for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.binary())], ["key", "open", "text", "bag"])

    return rows.select("key", "open", "text").mapInArrow(run, "key long, open array<long>, text string, bag binary")


def across(left: DataFrame, texts: DataFrame) -> DataFrame:
    """Links between nodes of different components that share a bucket of left, each pair looked at in its first such bucket.

    In each bucket the nodes outside its largest component meet all nodes, in blocks of both: texts go to the blocks,
    and pairs exist only while a block is at work. Bags of words rule out most of a block's pairs at once; only what is
    left is split into words and aligned.
    """
    parts = left.groupBy("h", "root").agg(F.count("*").alias("k"))
    sizes = written(parts.groupBy("h").agg(F.sum("k").alias("k"), F.max("k").alias("k_main"), F.max_by("root", F.struct("k", "root")).alias("main")), "sizes")
    own = with_bags(left.groupBy("key").agg(F.collect_list("h").alias("open")).join(texts, "key"))  # a number a sketch at most
    rows = left.select("h", "key", "root").join(sizes, "h")
    rows = rows.select("h", "key", "root", "main", F.ceil(F.col("k") / ALL_BLOCK).cast("int").alias("n_all"), F.ceil((F.col("k") - F.col("k_main")) / OUTSIDE_BLOCK).cast("int").alias("n_out"))
    rows = written(rows.join(own, "key"), "blocks")
    columns = ["h", "out_block", "all_block", "key", "root", "main", "open", "text", "bag"]
    spread = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    place = lambda n, salt: F.pmod(F.xxhash64("key", F.lit(salt)), n).cast("int")
    outside = rows.where("root <> main").withColumn("out_block", place(F.col("n_out"), 1)).withColumn("all_block", spread(F.col("n_all"))).select(*(F.col(c).alias(c) for c in columns))
    every = rows.withColumn("all_block", place(F.col("n_all"), 2)).withColumn("out_block", spread(F.col("n_out"))).select(*columns)
    out, kinds = schemas("a long, b long")

    def cell(ones: pa.Table, others: pa.Table) -> pa.Table:
        found: list[tuple[int, int]] = []
        if ones.num_rows and others.num_rows:
            here, main = ones.column("h")[0].as_py(), ones.column("main")[0].as_py()
            (key, root, bag), (key2, root2, bag2) = ((t.column("key").to_numpy(), t.column("root").to_numpy(), np.frombuffer(b"".join(t.column("bag").to_pylist()), np.int32).reshape(-1, BAG)) for t in (ones, others))
            size, size2 = bag.sum(axis=1), bag2.sum(axis=1)
            opened: dict[tuple[int, int], set[int]] = {}
            words: dict[tuple[int, int], list[bytes]] = {}

            def of(seen: dict, side: int, i: int, make):
                if (side, i) not in seen:
                    seen[side, i] = make((ones, others)[side], i)
                return seen[side, i]

            for i in range(len(key)):
                most = (np.maximum(size[i], size2) * (1 - SIMILARITY) + 1e-9).astype(np.int64)
                apart = bag2 - bag[i]
                more = np.maximum(apart, 0).sum(axis=1)
                # words of either that the other hasn't, as far as the bags tell; pairs outside the largest component come once
                may = (np.maximum(more, more - apart.sum(axis=1)) <= most) & (root2 != root[i]) & ((root2 == main) | (key2 > key[i]))
                for j in np.flatnonzero(may).tolist():
                    both = of(opened, 0, i, lambda t, k: set(t.column("open")[k].as_py())) & of(opened, 1, j, lambda t, k: set(t.column("open")[k].as_py()))
                    if min(both) == here and similar(of(words, 0, i, lambda t, k: words_of(t.column("text")[k].as_py())), of(words, 1, j, lambda t, k: words_of(t.column("text")[k].as_py()))):
                        found.append((int(key[i]), int(key2[j])))
        return pa.Table.from_arrays([pa.array([p[k] for p in found], pa.int64()) for k in range(2)], schema=kinds)

    keys = ["h", "out_block", "all_block"]
    return outside.groupBy(*keys).cogroup(every.groupBy(*keys)).applyInArrow(cell, out)


def grouped(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Of rows (row, id, text) in buckets by row: signs; node, root of every node; root, class_id, kept (a row), n_texts of every class.

    A class keeps its row of the smallest id, null ids last; of several such rows that of the smallest digest, then the first.
    """
    signs = bucketed(signed(rows.select("row", "id", "text")), "row", "signs", dealt=True)
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "node", F.col("row").alias("key"))).alias("first")
    nodes = written(signs.select("row", "id", "node").groupBy("node").agg(first).select("node", "first.no_id", "first.id", "first.key"), "nodes")
    roots = linked(signs, nodes, rows)
    named = written(nodes.join(roots.select(F.col("a").alias("key"), F.col("b").alias("root")), "key", "left").withColumn("root", F.coalesce("root", "key")), "roots")
    least = F.min(F.struct("no_id", "id", "node", "key")).alias("first")
    groups = written(named.groupBy("root").agg(least, F.count("*").alias("n_texts")).select("root", F.col("first.id").alias("class_id"), F.col("first.key").alias("kept"), "n_texts"), "groups")
    return signs, named.select("node", "root"), groups


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, class_id (the smallest doc_id of the class), n_texts (different word sequences in the class) of every row."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("text"))
    signs, named, groups = grouped(bucketed(rows, "row", "rows"))
    by_node = written(named.join(groups, "root").select("node", "class_id", "n_texts"), "classes")
    return signs.select(F.col("id").alias(id_col), "node").join(by_node, "node").select(id_col, "class_id", "n_texts")


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that their class keeps: one of each class, that of the smallest id. Rows with a null id stay."""
    name = "row"
    while name.lower() in map(str.lower, docs.columns):
        name += "_"
    whole = bucketed(docs.withColumn(name, F.monotonically_increasing_id()), name, "rows")
    rows = whole.select(F.col(name).alias("row"), whole[id_col].cast("long").alias("id"), whole[text_col].cast("string").alias("text"))
    kept = grouped(rows)[2].select(F.col("kept").alias(name))
    once = whole.where(whole[id_col].isNotNull()).join(kept.hint("shuffle_hash"), name, "left_semi")
    return once.unionByName(whole.where(whole[id_col].isNull())).select(*docs.columns)
