"""Text of PDF files without a library: pages in order, their text-showing operators, Flate streams and object streams.

Strings are read as Latin-1, or as UTF-16 where they say so; fonts with codes of their own (ToUnicode maps), encrypted
files and scanned pages are not read, and give an empty text or what can be read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

OBJECT = re.compile(rb"(?<!\d)(\d+)\s+\d+\s+obj\b(.*?)\bendobj\b", re.S)
STREAM = re.compile(rb"(<<.*>>)\s*stream\r?\n(.*?)\r?\n?endstream", re.S)
REFERENCE = re.compile(rb"(\d+)\s+\d+\s+R\b")
TOKEN = re.compile(rb"\((?:[^()\\]|\\.|\((?:[^()\\]|\\.)*\))*\)|<[0-9A-Fa-f\s]*>|\[|\]|[^\s()<>\[\]]+", re.S)
#: Characters that a backslash stands for (fixed values of the file format).
ESCAPES = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"\b", b"f": b"\f"}
NEW_LINE = frozenset((b"Td", b"TD", b"T*", b"Tm", b"ET", b"'", b'"'))


def unpacked(head: bytes, body: bytes) -> bytes:
    if b"/FlateDecode" not in head:
        return body
    try:
        return zlib.decompressobj().decompress(body)
    except zlib.error:
        return b""


def objects(raw: bytes) -> dict[int, bytes]:
    """Bodies by number, those inside object streams included."""
    found = {int(m[1]): m[2] for m in OBJECT.finditer(raw)}
    for body in list(found.values()):
        m = STREAM.search(body)
        if m is None or b"/ObjStm" not in m[1]:
            continue
        first, data = re.search(rb"/First\s+(\d+)", m[1]), unpacked(m[1], m[2])
        if first is None:
            continue
        at = int(first[1])
        numbers = [int(x) for x in data[:at].split()]
        places = [*numbers[1::2], len(data) - at]
        for k, number in enumerate(numbers[::2]):
            found.setdefault(number, data[at + places[k] : at + places[k + 1]])
    return found


def pages(found: dict[int, bytes]) -> Iterator[bytes]:
    """Page objects in reading order; where there is no page tree, by number."""
    kids = {n: [int(x) for x in REFERENCE.findall(m[1])] for n, body in found.items() if re.search(rb"/Type\s*/Pages\b", body) and (m := re.search(rb"/Kids\s*\[(.*?)\]", body, re.S))}
    below = {k for ks in kids.values() for k in ks}
    stack = [n for n in sorted(kids, reverse=True) if n not in below] or sorted((n for n, b in found.items() if re.search(rb"/Type\s*/Page\b", b)), reverse=True)
    seen: set[int] = set()
    while stack:
        n = stack.pop()
        if n in seen or n not in found:
            continue
        seen.add(n)
        if n in kids:
            stack.extend(reversed(kids[n]))
        elif re.search(rb"/Type\s*/Page\b", found[n]):
            yield found[n]


def string(token: bytes) -> str:
    if token[:1] == b"<":
        digits = re.sub(rb"\s", b"", token[1:-1])
        raw = bytes.fromhex((digits + b"0" * (len(digits) % 2)).decode())
    else:
        plain = lambda m: ESCAPES.get(m[1], bytes([int(m[1], 8) & 255]) if m[1].isdigit() else b"" if m[1] in (b"\n", b"\r", b"\r\n") else m[1])
        raw = re.sub(rb"\\([0-7]{1,3}|\r\n|.)", plain, token[1:-1], flags=re.S)
    return raw[2:].decode("utf-16-be", "replace") if raw[:2] == b"\xfe\xff" else raw.decode("latin-1")


def shown(content: bytes) -> str:
    """What the text operators of a content stream show, a line for each move to another line."""
    lines, line, operands, inside = [], [], [], False
    for token in TOKEN.findall(content):
        if token == b"BT":
            inside = True
        elif inside and token in (b"Tj", b"'", b'"', b"TJ") or token in NEW_LINE:
            if token in NEW_LINE and line:
                lines.append("".join(line))
                line = []
            if token in (b"Tj", b"'", b'"', b"TJ"):
                for x in operands:
                    if x[:1] in (b"(", b"<"):
                        line.append(string(x))
                    elif token == b"TJ" and re.fullmatch(rb"-\d+(\.\d*)?", x) and float(x) < -200:
                        line.append(" ")  # a wide gap stands for a space
            operands = []
            inside = inside and token != b"ET"
        elif token[:1] in (b"(", b"<", b"[", b"]") or re.fullmatch(rb"[-+.\d]+", token):
            operands.append(token)
        else:
            operands = []
    return "\n".join([*lines, "".join(line)])


def text_of(raw: bytes) -> str:
    """The pages' texts, blank ones left out, joined by line ends."""
    found = objects(raw)
    texts = []
    for page in pages(found):
        m = re.search(rb"/Contents\s*(\[.*?\]|\d+\s+\d+\s+R)", page, re.S)
        streams = [STREAM.search(found.get(int(n), b"")) for n in REFERENCE.findall(m[1])] if m else []
        text = shown(b"\n".join(unpacked(s[1], s[2]) for s in streams if s))
        texts.append("\n".join(x for line in text.split("\n") if (x := " ".join(line.split()))))
    return "\n".join(t for t in texts if t)
