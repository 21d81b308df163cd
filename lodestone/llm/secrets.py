"""Secret scans by token efficiency.

Key-shaped strings are found by pattern (assign, access, hex); beyond them a long run of key characters is a secret
when a byte-pair vocabulary needs many tokens for it. Prose and code take about four characters a token, random
strings about two or less. Runs that are known digests or identifiers are excluded first. Where a run as a whole isn't
random, its stretches of segments between separators that are random each are looked at by themselves, so that readable
text joined to a secret doesn't hide it.

Defined results: a null text counts as empty; equal rows give equal rows; a text of any length is read whole; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import map_rows

KINDS = ("assign", "access", "hex", "random")
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: How the vocabulary cuts a text before merging (fixed value, the public pattern of byte-level vocabularies).
CUTS = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

ASSIGN = re.compile(rb"""(?i:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))""")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]+")
KEYWORDS = re.compile(rb"(?i:passw|secret|token|api_?key)")
UUID = re.compile(rb"(?i:[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12})")
HEX_ONLY = re.compile(rb"(?i:[0-9a-f]+)")
#: Lengths in hex digits of MD5, SHA-1, SHA-224, SHA-256, SHA-384 and SHA-512 digests (fixed values).
DIGEST_LENGTHS = frozenset((32, 40, 56, 64, 96, 128))
#: What stands before a digest that is known as one: its algorithm's or purpose's name.
NAMED = re.compile(rb"(?i)(?:md5|sha-?[123]?(?:[-_/]?\d+)?|digest|checksum|hash|commit|revision|etag|fingerprint)(?:sum)?[^A-Za-z0-9]{0,4}$")
SEGMENT = re.compile(rb"[A-Za-z0-9]+")
ALPHABET = b"abcdefghijklmnopqrstuvwxyz" * 2
PLAIN = 0.9  # part of the ratio that runs of letters in one case, which may be words, must stay below
DIGIT, LETTER = re.compile(rb"[0-9]"), re.compile(rb"[A-Za-z]")
KEY_CHARS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"


@lru_cache(maxsize=2)
def encoder(vocabulary: str):
    """The vocabulary's encoder, loaded once in each Python worker."""
    import tiktoken

    with open(vocabulary, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("secrets", pat_str=CUTS, mergeable_ranks=ranks, special_tokens={})


def is_digest(run: bytes, before: bytes) -> bool:
    """Hex digits of a digest's length after a word that names one."""
    return len(run) in DIGEST_LENGTHS and HEX_ONLY.fullmatch(run) is not None and NAMED.search(before[-32:]) is not None


def excluded(run: bytes, before: bytes) -> bool:
    """Known digests, UUIDs, and identifiers: numbers, alphabets, and names or paths of segments without a digit."""
    if is_digest(run, before) or UUID.fullmatch(run) or not LETTER.search(run):
        return True
    return not DIGIT.search(run) and (not run.isalpha() or run.lower() in ALPHABET)


def is_random(run: bytes, before: bytes, least: int, ratio: float, encode) -> bool:
    if len(run) < least or excluded(run, before):
        return False
    limit = ratio * PLAIN if run.isalpha() and (run[1:].islower() or run.isupper()) else ratio
    return len(run) < limit * len(encode(run.decode()))


def random_parts(core: bytes, before: bytes, least: int, ratio: float, encode) -> list[tuple[int, int]]:
    """The random parts of a run, before which that text stands: the whole, or else stretches of random segments, one of half the length at least, or else segments."""
    known = any(is_digest(m[0], before + core[: m.start()]) for m in SEGMENT.finditer(core)) if len(core) > min(DIGEST_LENGTHS) else False
    if not known and is_random(core, before, least, ratio, encode):
        return [(0, len(core))]
    uuids = [m.span() for m in UUID.finditer(core)]
    stretches: list[list[tuple[int, int]]] = [[]]
    for m in SEGMENT.finditer(core):
        a, b = m.span()
        if is_digest(m[0], before + core[:a]) or any(x < b and a < y for x, y in uuids) or b - a >= ratio * len(encode(m[0].decode())):
            stretches.append([])
        else:
            stretches[-1].append((a, b))
    found = []
    for parts in filter(None, stretches):
        a, b = parts[0][0], parts[-1][1]
        if 2 * max(y - x for x, y in parts) >= least and is_random(core[a:b], before + core[:a], least, ratio, encode):
            found.append((a, b))
        else:
            found += [(x, y) for x, y in parts if is_random(core[x:y], before + core[:x], least, ratio, encode)]
    return found


def key_runs(blob: bytes, least: int) -> list[tuple[int, int]]:
    """Maximal runs of key characters of that length at least, in the whole blob."""
    inside = np.zeros(256, np.bool_)
    inside[list(KEY_CHARS)] = True
    stops = np.flatnonzero(~inside[np.frombuffer(blob, np.uint8)])
    stops = np.concatenate(([-1], stops, [len(blob)]))
    long = np.flatnonzero(np.diff(stops) > least)
    return list(zip((stops[long] + 1).tolist(), stops[long + 1].tolist(), strict=True))


def scan(texts: list[str | None], vocabulary: str, least: int, ratio: float) -> list[list[tuple[int, int, int]]]:
    """For each text its spans as (start, kind, end), in code points, in order."""
    encoded = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    blob = b"\n".join(encoded)
    starts = np.cumsum([0] + [len(e) + 1 for e in encoded])
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    owner = lambda at: int(np.searchsorted(starts, at, "right")) - 1
    for i in sorted({owner(m.start()) for m in KEYWORDS.finditer(blob)}):
        found[i] += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(encoded[i]) if len(m[2]) >= 8]
    encode = encoder(vocabulary).encode_ordinary
    for start, end in key_runs(blob, min(16, least)):
        run, i = blob[start:end], owner(start)
        at = start - int(starts[i])
        found[i] += [(at + m.start(), 1, at + m.end()) for m in ACCESS.finditer(run) if m.end() - m.start() >= 16]
        found[i] += [(at + m.start(), 2, at + m.end()) for m in HEX.finditer(run) if m.end() - m.start() >= 32]
        left = len(run) - len(run.lstrip(b".=-/+_"))
        core = run.strip(b".=-/+_")
        if any(a <= at + left and at + left + len(core) <= b for a, _, b in found[i]) or len(core) < least:
            continue  # a base span says so already
        parts = [(at + left + a, 3, at + left + b) for a, b in random_parts(core, encoded[i][max(0, at + left - 32) : at + left], least, ratio, encode)]
        found[i] += [x for x in parts if not any(a <= x[0] and x[2] <= b for a, _, b in found[i])]
    for i, spans in enumerate(found):
        if spans:
            raw = encoded[i]
            if len(raw) != len(texts[i]):
                spans[:] = [(len(raw[:a].decode("utf-8", "surrogatepass")), k, len(raw[:b].decode("utf-8", "surrogatepass"))) for a, k, b in spans]
            spans.sort()
    return found


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY, least: int = 20, ratio: float = 2.2) -> DataFrame:
    """Every row's secrets: id, spans array<struct<kind, start, end>> (code points, end exclusive).

    least: shortest run or part that the token test reads; ratio: characters a token below which a run is random.
    """

    def make():
        def run(part: pa.RecordBatch) -> list:
            spans = scan(part.column(1).to_pylist(), vocabulary, least, ratio)
            return [part.column(0), [[{"kind": KINDS[k], "start": a, "end": b} for a, k, b in s] for s in spans]]

        return run

    picked = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("text"))
    return map_rows(picked, "id long, spans array<struct<kind: string, start: long, end: long>>", make, "text").withColumnRenamed("id", id_col)


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def secret_report(docs: DataFrame, vocabulary: str = VOCABULARY, least: int = 20, ratio: float = 2.2) -> DataFrame:
    """The digest form of secret_spans that the query returns; base kinds are counted apart from the method's own."""

    def make():
        def run(part: pa.RecordBatch) -> list:
            spans = scan(part.column(1).to_pylist(), vocabulary, least, ratio)
            base = [[x for x in s if x[1] < 3] for s in spans]
            counts = [[sum(x[1] == k for x in s) for s in base] for k in range(3)]
            return [part.column(0), *counts, [hashlib.sha256(joined(s).encode()).hexdigest() for s in base], [joined(s) for s in spans]]

        return run

    picked = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return map_rows(picked, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string", make, "text")


def without_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mark: str = "[secret]", **options) -> DataFrame:
    """docs with every span replaced by mark; rows, other columns and clean texts stay as they are."""
    vocabulary, least, ratio = options.get("vocabulary", VOCABULARY), options.get("least", 20), options.get("ratio", 2.2)
    names, at = docs.columns, docs.columns.index(text_col)

    def redact(text: str | None, spans: list[tuple[int, int, int]]) -> str | None:
        out, upto = [], 0
        for a, _, b in spans:
            if a >= upto:
                out += [text[upto:a], mark]
            upto = max(upto, b)
        return text if not spans else "".join([*out, text[upto:]])

    def run(batches):
        from .common import pieces

        for batch in batches:
            for part in pieces(batch, names[at]):
                texts = part.column(at).to_pylist()
                clean = pa.array(map(redact, texts, scan(texts, vocabulary, least, ratio)), type=part.column(at).type)
                yield pa.RecordBatch.from_arrays([clean if i == at else c for i, c in enumerate(part.columns)], schema=part.schema)

    return docs.mapInArrow(run, docs.schema)
