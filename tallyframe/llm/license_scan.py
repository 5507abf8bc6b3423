"""Licence scan: exact phrases and fuzzy search for short notices.

A notice of ``m`` characters that may differ in ``k`` edits is split into
``k + EXTRA`` pieces; by the pigeonhole principle ``EXTRA`` of them at least
stand in any match unchanged, each moved by ``k`` characters at most.  All
pieces of all notices are found in one pass of an Aho-Corasick automaton over
the normalised text; so many pieces of one notice at about the same place open
a window wide enough for the whole notice and its edits but not for two copies,
and the ``regex`` library's best bounded-error match there gives a span and its
edits.  Of overlapping spans of one notice the one with the fewest edits stays.

Text is normalised by lower-casing A-Z and joining the words, runs of ASCII
letters, digits and any non-ASCII characters, by one space.

Defined results: null or empty text has no words, no spans and score 0; ids
may be null or repeat; each input row gives one row.
"""

from __future__ import annotations

from bisect import bisect
from collections.abc import Iterator, Mapping
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks

#: The base phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: Short notices as public licences word them, normalised, and their labels.
NOTICES = {
    "licensed under the apache license version 2 0": "apache-2.0",
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "this work is licensed under the gnu general public license version 3": "gpl-3.0",
    "under the terms of the gnu general public license as published by the free software foundation": "gpl",
    "under the terms of the gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "licensed under cc by nc 4 0": "cc-by-nc-4.0",
    "licensed under cc by 4 0": "cc-by-4.0",
    "licensed under a creative commons attribution": "cc-by",
    "redistribution and use in source and binary forms with or without modification": "bsd",
    "mozilla public license version 2 0": "mpl-2.0",
    "permission to use copy modify and or distribute this software for any purpose": "isc",
    "this is free and unencumbered software released into the public domain": "unlicense",
}

#: One edit for so many characters of a notice.
CHARS_PER_EDIT = 12
#: Pieces that must stand unchanged for a window to be searched.
EXTRA = 4

#: Bytes of words stay (A-Z as a-z), all else becomes a space.
_NORMAL = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

SPANS = "array<struct<label:string,start_word:long,end_word:long,edits:int,notice:string>>"
SCHEMA = f"n_words long, base_spans {SPANS}, fuzzy_spans {SPANS}"


def words_of(text: str | None) -> str:
    """The normalised text: its words joined by single spaces."""
    return b" ".join((text or "").encode().translate(_NORMAL).split()).decode()


def _gathered(hits: list[tuple[int, int]], reach: int, least: int) -> Iterator[tuple[int, int]]:
    """First and last start of hits (start, piece) that lie within ``reach`` of the first, where ``least`` pieces are."""
    k = 0
    while k < len(hits):
        first, n = hits[k][0], k
        while n < len(hits) and hits[n][0] - first <= reach:
            n += 1
        if len({piece for _, piece in hits[k:n]}) >= least:
            yield first, hits[n - 1][0]
            while k < len(hits) and hits[k][0] <= first:
                k += 1
        else:
            k += 1


class Scanner:
    def __init__(self, phrases: Mapping[str, str], notices: Mapping[str, str], chars_per_edit: int) -> None:
        self.phrases = list(phrases.items())
        self.notices = []
        seeds: dict[str, list[tuple[int, int]]] = {}
        for text, label in notices.items():
            edits = len(text) // chars_per_edit
            self.notices.append((text, label, edits, regex.compile(rf"(?b)(?<=^| )(?:{regex.escape(text)}){{e<={edits}}}(?= |$)")))
            pieces = min(edits + EXTRA, len(text))
            for k in range(pieces):
                a, b = k * len(text) // pieces, (k + 1) * len(text) // pieces
                seeds.setdefault(text[a:b], []).append((len(self.notices) - 1, a))
        self.automaton = ahocorasick.Automaton()
        for seed, uses in seeds.items():
            self.automaton.add_word(seed, (len(seed), uses))
        self.automaton.make_automaton()

    def base(self, text: str) -> list[tuple]:
        """Every place of every phrase: (label, first word, word after the last, 0, phrase)."""
        found, padded = [], f" {text} "
        for phrase, label in self.phrases:
            key, at = f" {phrase} ", padded.find(f" {phrase} ")
            words, done = 0, 0
            while at >= 0:
                words += padded.count(" ", done, at)
                done = at
                found.append((label, words, words + phrase.count(" ") + 1, 0, phrase))
                at = padded.find(key, at + 1)
        return found

    def fuzzy(self, text: str) -> list[tuple]:
        """Verified places of the notices, each with its edits."""
        starts: dict[int, set[tuple[int, int]]] = {}
        for end, (size, uses) in self.automaton.iter(text):
            for notice, offset in uses:
                starts.setdefault(notice, set()).add((end + 1 - size - offset, offset))
        kept = []
        for notice, hits in starts.items():
            full, _, edits, pattern = self.notices[notice]
            places = set()
            for low, high in _gathered(sorted(hits), 2 * edits, min(EXTRA, len(full) - edits)):
                a, b = max(0, low - edits - 1), min(len(text), high + len(full) + edits + 1)
                places.update((sum(m.fuzzy_counts), m.start(), m.end()) for m in pattern.finditer(text, a, b))
            taken: list[tuple[int, int]] = []  # in order and apart
            for edits, a, b in sorted(places):
                k = bisect(taken, (a, b))
                if (k and taken[k - 1][1] > a) or (k < len(taken) and taken[k][0] < b):
                    continue
                taken.insert(k, (a, b))
                kept.append((a, b, edits, notice))
        found, words, done = [], 0, 0
        for a, b, edits, notice in sorted(kept):
            words, done = words + text.count(" ", done, a), a
            found.append((self.notices[notice][1], words, words + text.count(" ", a, b) + 1, edits, self.notices[notice][0]))
        return sorted(found, key=lambda s: (s[1], s[2], s[0]))


@lru_cache(maxsize=4)
def _scanner(phrases: tuple, notices: tuple, chars_per_edit: int) -> Scanner:
    return Scanner(dict(phrases), dict(notices), chars_per_edit)


def scan(docs: DataFrame, phrases: Mapping[str, str] = PHRASES, notices: Mapping[str, str] = NOTICES, chars_per_edit: int = CHARS_PER_EDIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, n_words, base_spans, fuzzy_spans)`` of every whole text.

    Spans count words from 0 and end before ``end_word``; ``edits`` are the
    characters inserted, deleted or replaced.
    """
    key = (tuple(phrases.items()), tuple(notices.items()), chars_per_edit)
    kind = docs.schema[id_col].dataType.simpleString()
    names = ["label", "start_word", "end_word", "edits", "notice"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _scanner(*key)
        fields = [pa.field(n, t) for n, t in zip(names, [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string()])]
        spans = pa.list_(pa.struct(fields))
        for batch in blocks(batches, "text"):
            texts = [words_of(t) for t in batch.column("text").to_pylist()]
            found = [[[dict(zip(names, s)) for s in f(t)] for t in texts] for f in (scanner.base, scanner.fuzzy)]
            columns = [batch.column("id"), pa.array([t.count(" ") + 1 if t else 0 for t in texts], type=pa.int64()), *(pa.array(f, type=spans) for f in found)]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n_words", "base_spans", "fuzzy_spans"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {kind}, {SCHEMA}").withColumnRenamed("id", id_col)


def verdict(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts, labels and score: 1 with a base phrase, else 1 - edits / characters of the best notice, else 0."""
    labels = lambda *spans: F.array_join(F.sort_array(F.array_distinct(F.concat(*[F.col(f"{s}.label") for s in spans]))), ",")
    best = F.array_max(F.transform("fuzzy_spans", lambda s: 1 - s["edits"] / F.length(s["notice"])))
    return scanned.select(
        id_col,
        "n_words",
        F.size("base_spans").cast("long").alias("n_base"),
        F.array_min("base_spans.start_word").alias("first_word"),
        F.array_max("base_spans.start_word").alias("last_word"),
        labels("base_spans").alias("base_labels"),
        labels("base_spans", "fuzzy_spans").alias("labels"),
        F.when(F.size("base_spans") > 0, 1.0).otherwise(F.coalesce(best, F.lit(0.0))).alias("score"),
        F.size("fuzzy_spans").cast("long").alias("n_fuzzy"),
    )
