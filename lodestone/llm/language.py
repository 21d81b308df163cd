"""Language identification by averaged hashed subword embeddings with a linear softmax.

A text is the mean of the embeddings of its hashed byte n-grams inside words (word ends marked); a linear softmax reads
the mean. Both are trained by stochastic gradient descent in numpy on a bounded sample of labelled rows. A temperature
fitted on rows kept out of training makes the softmax a probability. A softmax only weighs the learned languages against
each other, so the score is that probability times the share of the text's n-grams that training has met: texts of other
languages and scripts score low. The rejection threshold is the score that a stated small part of the rows falls below;
every sampled row counts, scored by a model that was trained without it and its copies. If the sample has fewer rows
than that part needs (1 / reject), the score is extrapolated from the worst tenth of the rows.

Defined results: null texts and texts without a letter are `und` with score 0; every other text gets a learned value,
however short; texts are read whole; equal texts get equal results; an empty table gives no rows; with no labelled row
every text is `und`; other columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows

ORDERS = (2, 3, 4)
FOLDS = 5  # parts of the sample, each scored by a model trained on the others
MET_BITS = 20  # of the n-gram hashes that tell what training has met
ASCII_LETTER = re.compile("[A-Za-z]")
#: ASCII letters in lower case; bytes of other letters as they are; the rest becomes a space.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # bucket x language: each n-gram's part of the scores
    bias: np.ndarray
    met: np.ndarray  # whether training has met the n-gram, by MET_BITS bits of its hash
    temperature: float = 1.0
    threshold: float = 0.0
    notes: dict = field(default_factory=dict)


def has_letter(text: str | None) -> bool:
    return bool(text) and (ASCII_LETTER.search(text) is not None or any(map(str.isalpha, text)))


def folded(text: str) -> bytes:
    return b" " + (text if text.isascii() else text.lower()).encode("utf-8", "surrogatepass").translate(LETTERS) + b" "


def grams(blob: bytes, bits: int):
    """For each order the positions of n-grams without an inner space, and their buckets."""
    b = np.frombuffer(blob, np.uint8)
    space = b == 32
    for n in ORDERS:
        m = len(b) - n + 1
        if m <= 0:
            continue
        h = np.full(m, (0x9E3779B1 * (n + 1)) & 0xFFFFFFFF, np.uint32)
        for k in range(n):
            h = (h ^ b[k : k + m]) * np.uint32(0x01000193)
        ok = ~(space[:m] & space[n - 1 : n - 1 + m])
        for k in range(1, n - 1):
            ok &= ~space[k : k + m]
        at = np.flatnonzero(ok)
        h = h[at]
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x85EBCA6B)
        yield at, h >> np.uint32(32 - bits)


def logits(texts: list[str], model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Scores of each text for each language, before the temperature, and the share of its n-grams that training has met."""
    parts = [folded(t) for t in texts]
    starts = np.cumsum([0] + [len(p) for p in parts])[:-1]
    total, count, met = np.zeros((len(texts), len(model.languages))), np.zeros(len(texts)), np.zeros(len(texts))
    bits = int(model.table.shape[0]).bit_length() - 1
    blob = b"".join(parts)
    for at, fine in grams(blob, MET_BITS):
        bucket = fine >> np.uint32(MET_BITS - bits)
        first = np.searchsorted(at, np.append(starts, len(blob)))
        n = np.diff(first)
        count += n
        some = np.flatnonzero(n)
        if len(some):
            total[some] += np.add.reduceat(model.table[bucket], first[:-1][some], axis=0, dtype=np.float64)
            met[some] += np.add.reduceat(model.met[fine], first[:-1][some], dtype=np.int64)
    return total / np.maximum(count, 1)[:, None] + model.bias, met / np.maximum(count, 1)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def predict(texts: list[str | None], model: Model | None) -> tuple[list[str], list[float]]:
    langs, scores = ["und"] * len(texts), [0.0] * len(texts)
    known = [i for i, t in enumerate(texts) if has_letter(t)] if model else []
    if known:
        z, met = logits([texts[i] for i in known], model)
        p = softmax(z / model.temperature)
        for i, k, s in zip(known, p.argmax(axis=1), p.max(axis=1) * met, strict=True):
            langs[i], scores[i] = model.languages[k], float(min(1.0, s))
    return langs, scores


def low_quantile(scores: np.ndarray, part: float) -> float:
    """The score that this part of rows falls below; of fewer rows than 1 / part by an exponential tail of the losses -log(score), and not above their least score."""
    least = float(np.quantile(scores, part, method="lower"))
    if len(scores) * part >= 1:
        return least
    k = max(1, len(scores) // 10)
    loss = np.sort(-np.log(np.maximum(1e-12, scores)))[-k - 1 :]
    return min(least, float(np.exp(-(loss[0] + (loss - loss[0]).sum() / k * np.log(k / (len(scores) * part))))))


def train(rows: list[tuple[str, str]], bits: int = 16, width: int = 16, epochs: int = 4, rate: float = 2.0, reject: float = 0.0005, seed: int = 7) -> Model | None:
    """A model from (text, language) rows. A fifth of the texts is kept out of it; the temperature and the threshold come from all rows, each fifth scored by a model trained on the others."""
    rows = [(t, lang) for t, lang in rows if lang is not None and has_letter(t)]
    if not rows:
        return None
    languages = sorted({lang for _, lang in rows})
    rng = np.random.default_rng(seed)
    texts = {t: i for i, t in enumerate(dict.fromkeys(t for t, _ in rows))}
    folds = FOLDS if len(texts) >= 20 else 1
    fold = (rng.permutation(len(texts)) % folds)[[texts[t] for t, _ in rows]]
    bags, fines = [], []
    for t, _ in rows:
        fine = np.concatenate([b for _, b in grams(folded(t), MET_BITS)] or [np.zeros(0, np.uint32)])
        u, n = np.unique(fine >> np.uint32(MET_BITS - bits), return_counts=True)
        bags.append((u, (n / max(1, n.sum())).astype(np.float32)))
        fines.append(np.unique(fine))
    y = np.array([languages.index(lang) for _, lang in rows])

    def learnt(learn: np.ndarray) -> Model:
        weight = len(y) / (len(languages) * np.maximum(1, np.bincount(y[learn], minlength=len(languages))))
        embed = rng.normal(0, 0.1, (1 << bits, width)).astype(np.float32)
        soft, bias = rng.normal(0, 0.1, (width, len(languages))).astype(np.float32), np.zeros(len(languages), np.float32)
        for epoch in range(epochs):
            lr = rate * (1 - epoch / epochs)
            for i in rng.permutation(learn):
                u, f = bags[i]
                mean = f @ embed[u]
                z = mean @ soft + bias
                p = np.exp(z - z.max())
                p /= p.sum()
                p[y[i]] -= 1
                p *= min(3.0, weight[y[i]]) * 0.2
                g = soft @ p
                soft -= lr * np.outer(mean, p)
                bias -= lr * 0.1 * p
                embed[u] -= (lr * 20 * np.minimum(f, 0.02))[:, None] * g
        met = np.zeros(1 << MET_BITS, np.bool_)
        for i in learn:
            met[fines[i]] = True
        return Model(languages, (embed @ soft).astype(np.float32), bias.astype(np.float64), met)

    z, met, model = np.zeros((len(rows), len(languages))), np.zeros(len(rows)), None
    for k in range(folds):
        kept_out = np.flatnonzero(fold == k)
        part = learnt(np.flatnonzero(fold != k) if folds > 1 else kept_out)
        z[kept_out], met[kept_out] = logits([rows[i][0] for i in kept_out], part)
        model = model or part
    # targets a little below one, as for a row more that was wrong: rows without an error alone would ask for no temperature at all
    target = np.full(z.shape, 1 / (len(rows) + 2) / max(1, len(languages) - 1))
    target[np.arange(len(rows)), y] = (len(rows) + 1) / (len(rows) + 2)
    loss = {t: -(target * np.log(np.maximum(1e-300, softmax(z / t)))).sum(axis=1).mean() for t in 2.0 ** np.arange(-8, 8.25, 0.25)}
    model.temperature = float(min(loss, key=loss.get))
    p = softmax(z / model.temperature)
    model.threshold = low_quantile(np.minimum(1.0, p.max(axis=1) * met), reject)
    model.notes = {"kept_out": len(rows), "accuracy": float((p.argmax(axis=1) == y).mean())}
    return model


def held_out(doc_id) -> F.Column:
    return F.coalesce(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4, F.lit(0)) == 2


def fit(docs: DataFrame, per_language: int = 1000, **options) -> Model | None:
    """Trains on about per_language rows of each language at most (all, where a language has fewer), chosen by a hash of doc_id among those that aren't held out."""
    rows = docs.select("doc_id", docs["text"].cast("string").alias("text"), docs["lang"].cast("string").alias("lang")).where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    share = F.create_map(*[x for lang, n in counts.items() for x in (F.lit(lang), F.lit(min(1.0, per_language / n)))])
    draw = F.pmod(F.xxhash64(F.coalesce("doc_id", F.lit(-1)), F.lit("language")), F.lit(1 << 30)) / float(1 << 30)
    sample = rows.where(draw < share[F.col("lang")]).select("doc_id", "text", "lang").collect()
    sample.sort(key=lambda r: (r["doc_id"] is None, r["doc_id"], r["text"]))
    return train([(r["text"], r["lang"]) for r in sample], **options)


def identify(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, lang_pred, score, rejected of every row: rejected if `und` or if the calibrated score is below the model's threshold."""

    def make():
        def run(part: pa.RecordBatch) -> list:
            langs, scores = predict(part.column(1).to_pylist(), model)
            return [part.column(0), langs, scores, [lang == "und" or s < model.threshold for lang, s in zip(langs, scores, strict=True)]]

        return run

    picked = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("text"))
    return map_rows(picked, "id long, lang_pred string, score double, rejected boolean", make, "text", 1 << 20).withColumnRenamed("id", id_col)


def accepted(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """The rows of docs whose text is not rejected, unchanged, in one pass without a shuffle."""
    names, at = docs.columns, docs.columns.index(text_col)

    def run(batches):
        from .common import pieces

        for batch in batches:
            for part in pieces(batch, names[at], 1 << 20):
                langs, scores = predict(part.column(at).to_pylist(), model)
                keep = [lang != "und" and s >= model.threshold for lang, s in zip(langs, scores, strict=True)]
                yield part.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def language_report(docs: DataFrame, per_language: int = 1000) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row."""
    return identify(docs, fit(docs, per_language)).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
