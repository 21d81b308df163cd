"""License scans with a positional rare-token index.

Word document frequencies are counted over all documents. Each template of the index posts its rarest words (highest
IDF) with their positions. A file is looked up by its own rarest licence words; postings that agree on the relative
position of a template vote for it there; a template that enough words place at one offset is accepted if its mandatory
key phrases stand in that part of the file.

Defined results: a null text counts as empty (0 words, no label, score 0); texts are read whole; equal rows give equal
rows; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows

#: Phrases whose places are counted, and their labels (fixed values).
BASE = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))

#: Notices of public licences: label, wording, mandatory key phrases (fixed values).
TEMPLATES = (
    ("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    ("apache-2.0", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at", ("apache license version 2 0",)),
    ("apache-2.0", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied", ("without warranties or conditions of any kind",)),
    ("mit", "released under the mit license", ("mit license",)),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software", ("permission is hereby granted free of charge", "deal in the software without restriction")),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3", ("gnu general public license version 3",)),
    ("gpl-2.0", "this work is licensed under the gnu general public license version 2", ("gnu general public license version 2",)),
    ("gpl-3.0-or-later", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version", ("gnu general public license", "either version 3 of the license")),
    ("gpl-2.0-or-later", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version", ("gnu general public license", "either version 2 of the license")),
    ("lgpl", "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation", ("gnu lesser general public license",)),
    ("agpl", "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation", ("gnu affero general public license",)),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ("redistribution and use in source and binary forms",)),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies", ("for any purpose with or without fee is hereby granted",)),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at", ("mozilla public license v 2 0",)),
    ("unlicense", "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software", ("free and unencumbered software released into the public domain",)),
    ("boost-1.0", "distributed under the boost software license version 1 0", ("boost software license version 1 0",)),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software", ("in no event will the authors be held liable",)),
    ("cc0-1.0", "to the extent possible under law the author has dedicated all copyright and related and neighboring rights to this software to the public domain worldwide", ("related and neighboring rights",)),
    ("cc-by-4.0", "licensed under cc by 4 0", ("cc by 4 0",)),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", ("cc by sa 4 0",)),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", ("cc by nc 4 0",)),
    ("cc-by-4.0", "this work is licensed under a creative commons attribution 4 0 international license", ("creative commons attribution 4 0",)),
    ("cc-by-sa-4.0", "this work is licensed under a creative commons attribution sharealike 4 0 international license", ("creative commons attribution sharealike 4 0",)),
)

#: Every byte to its lower case if it belongs to a word, else to a space; bytes from 0x80 on belong to non-ASCII letters.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(WORD_BYTES).split()


def document_frequencies(docs: DataFrame, text_col: str, vocabulary: frozenset[bytes]) -> tuple[int, dict[bytes, int]]:
    """Rows, and the rows that hold each word of vocabulary, over all of docs. What comes to the driver is one row a word of the templates."""

    def run(batches):
        seen: Counter = Counter()
        for batch in batches:
            seen[b""] += batch.num_rows
            for text in batch.column(0).to_pylist():
                if text:
                    seen.update(vocabulary.intersection(words_of(text)))
        yield pa.RecordBatch.from_pydict({"word": [w.decode() for w in seen], "n": list(seen.values())}, pa.schema([("word", pa.string()), ("n", pa.int64())]))

    counts = docs.select(docs[text_col].cast("string").alias("text")).mapInArrow(run, "word string, n long")
    found = {r["word"].encode(): r["n"] for r in counts.groupBy("word").agg(F.sum("n").alias("n")).collect()}
    return found.pop(b"", 0), found


class Index:
    """Templates by their rare words: word -> (template, position), with each word's IDF."""

    def __init__(self, rows: int, counts: dict[bytes, int], templates=TEMPLATES, rare: int = 12):
        self.labels = [label for label, _, _ in templates]
        self.words = [words_of(wording) for _, wording, _ in templates]
        self.keys = [[b" " + b" ".join(words_of(k)) + b" " for k in keys] for _, _, keys in templates]
        self.idf = {w: math.log((rows + 1) / (counts.get(w, 0) + 1)) for ws in self.words for w in ws}
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        self.chosen = []
        for t, ws in enumerate(self.words):
            top = set(sorted(set(ws), key=lambda w: (-self.idf[w], w))[:rare])
            self.chosen.append(top)
            for q, w in enumerate(ws):
                if w in top:
                    self.postings[w].append((t, q))
        self.looked = frozenset(self.postings) | {words_of(phrase)[0] for phrase, _ in BASE}

    def look_up(self, words: list[bytes], present: frozenset[bytes], most: int, share: float) -> dict[str, float]:
        """Labels whose template stands in words, with the largest share of its words in place.

        The file's `most` rarest words of each template are looked up, at all their positions.
        """
        wanted: dict[bytes, set[int]] = defaultdict(set)
        for t, top in enumerate(self.chosen):
            mine = sorted(top & present, key=lambda w: (-self.idf[w], w))[:most]
            if len(mine) >= share * min(most, len(top)):
                for w in mine:
                    wanted[w].add(t)
        votes: Counter = Counter()
        for p, w in enumerate(words) if wanted else ():
            if w in wanted:
                votes.update((t, p - q) for t, q in self.postings[w] if t in wanted[w])
        found: dict[str, float] = {}
        for (t, at), n in votes.items():
            size = len(self.words[t])
            if n < max(2, share * min(most, len(self.chosen[t]))):
                continue
            start = max(0, at)
            place = b" " + b" ".join(words[start : at + size + 4]) + b" "
            if all(k in place for k in self.keys[t]):
                same = sum(a == b for a, b in zip(words[start : at + size], self.words[t][start - at :], strict=False))
                found[self.labels[t]] = max(found.get(self.labels[t], 0.0), same / size)
        return found


def base_places(line: bytes) -> tuple[list[int], set[str]]:
    """Word positions at which a base phrase starts in line (the words joined by spaces, with one at either end), and the labels found."""
    firsts, labels = [], set()
    for phrase, label in BASE:
        needle = b" " + phrase.encode() + b" "
        at = line.find(needle)
        while at >= 0:
            firsts.append(line.count(b" ", 0, at))
            labels.add(label)
            at = line.find(needle, at + 1)
    return firsts, labels


def license_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = 8, share: float = 0.6, templates=TEMPLATES) -> DataFrame:
    """For every row: n_words, n_base, first_word, last_word, base_labels, labels, score.

    most: rare words looked up for a template; share: the part of them that must agree on one relative position.
    score is the best template's share of words in place; 0.5 where only a base phrase stands; else 0.
    """
    vocabulary = frozenset(w for _, wording, _ in templates for w in words_of(wording))
    rows, counts = document_frequencies(docs, text_col, vocabulary)

    def make():
        index = Index(rows, counts, templates)

        def one(text: str | None) -> tuple:
            words = words_of(text)
            present = index.looked.intersection(words)
            if not present:
                return len(words), 0, None, None, "", "", 0.0
            line = b" " + b" ".join(words) + b" "
            firsts, base = base_places(line)
            found = index.look_up(words, present, most, share)
            score = max([*found.values(), 0.5 if base else 0.0])
            return len(words), len(firsts), min(firsts, default=None), max(firsts, default=None), ",".join(sorted(base)), ",".join(sorted(base | found.keys())), score

        def run(part: pa.RecordBatch) -> list:
            rows_out = [one(t) for t in part.column(1).to_pylist()]
            return [part.column(0), *(list(c) for c in zip(*rows_out, strict=True))]

        return run

    picked = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("text"))
    schema = "id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
    return map_rows(picked, schema, make, "text").withColumnRenamed("id", id_col)
