r"""Licence scans: fuzzy search for short notices.

Words are ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` of the text with A-Z in lower case, joined by single blanks: the normal
form. A notice with up to k edits, cut into k + 1 pieces, keeps at least one piece untouched (pigeonhole). An
Aho-Corasick automaton over all pieces finds those seeds in one pass; each asks for a span around it, overlapping spans
of a notice are joined, and the regex library's bounded-error matching verifies the edits inside and tells where
the notice lies.

Base labels come from phrases whose words stand consecutively. A notice allows ``error_share`` of its characters as
edits, ``max_edits`` at most, so that its pieces stay long enough to be rare.

Defined results: a null or empty text has no words, no labels and score 0; repeated rows are judged each on its own;
extra columns are ignored. ``score`` is 1 for a base phrase or an unedited notice, else 1 less the share of edited
characters of the best notice.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faretide.llm import arrays

# Phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Short notices in normal form, and their labels.
NOTICES = {
    "licensed under the apache license version 2 0": "apache",
    "licensed under the gnu general public license": "gpl",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "released under the mit license": "mit",
    "licensed under the mit license": "mit",
    "permission is hereby granted free of charge to any person": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "mozilla public license version 2 0": "mpl",
    "eclipse public license version": "epl",
    "creative commons attribution": "cc-by",
    "licensed under cc by": "cc-by",
    "boost software license version 1 0": "boost",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "permission to use copy modify and or distribute this software": "isc",
}

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
INSIDE = np.zeros(256, bool)
INSIDE[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def pieces(notice: str, edits: int) -> list[tuple[int, str]]:
    """``edits`` + 1 parts of about the same length, and where each begins."""
    cuts = [len(notice) * k // (edits + 1) for k in range(edits + 2)]
    return [(a, notice[a:b]) for a, b in zip(cuts, cuts[1:])]


class Finder:
    def __init__(self, notices: dict[str, str], phrases: dict[str, str], error_share: float, max_edits: int):
        self.phrases, self.notices = phrases, list(notices.items())
        self.edits = [min(max_edits, max(1, int(len(n) * error_share))) for n in notices]
        seeds: dict[str, list[tuple[int, int]]] = {}
        for k, (notice, _) in enumerate(self.notices):
            for at, part in pieces(notice, self.edits[k]):
                seeds.setdefault(part, []).append((k, at))
        self.automaton = ahocorasick.Automaton()
        for part, owners in seeds.items():
            self.automaton.add_word(part, (len(part), owners))
        self.automaton.make_automaton()
        # The best match of a span, not the first.
        self.patterns = [
            regex.compile(rf"(?b)(?:{regex.escape(n, special_only=True)}){{e<={e}}}") for (n, _), e in zip(self.notices, self.edits)
        ]

    def base(self, normal: str, starts: list[int]) -> list[tuple[str, int]]:
        """(label, first word) of each place of a phrase in ' word word ... '."""
        found = []
        for phrase, label in self.phrases.items():
            at = normal.find(f" {phrase} ")
            while at >= 0:
                found.append((label, bisect_right(starts, at + 1) - 1))
                at = normal.find(f" {phrase} ", at + 1)
        return found

    def notices_in(self, normal: str) -> list[tuple[str, int, int, int, int]]:
        """(label, from, to, edits, length of the notice) of every notice found."""
        spans: dict[int, list[list[int]]] = {}
        for last, (size, owners) in self.automaton.iter(normal):
            for k, at in owners:
                begin = last + 1 - size - at
                notice, edits = self.notices[k][0], self.edits[k]
                low, high = max(0, begin - edits), min(len(normal), begin + len(notice) + edits)
                held = spans.setdefault(k, [])
                if held and low <= held[-1][1]:
                    held[-1][1] = max(held[-1][1], high)
                    held[-1][0] = min(held[-1][0], low)
                else:
                    held.append([low, high])
        found = []
        for k, places in spans.items():
            notice, label = self.notices[k]
            for low, high in places:
                for m in _matches(self.patterns[k], normal, low, high):
                    found.append((label, m.start(), m.end(), sum(m.fuzzy_counts), len(notice)))
        return sorted(found, key=lambda x: x[1:])


def _matches(pattern: regex.Pattern, text: str, low: int, high: int) -> Iterator[regex.Match]:
    """The best match of a span, and those of what lies before and behind it."""
    parts = [(low, high)]
    while parts:
        low, high = parts.pop()
        if m := pattern.search(text, low, high):
            yield m
            parts += [(low, m.start()), (m.end(), high)]


@lru_cache(maxsize=4)
def finder(notices: tuple, phrases: tuple, error_share: float, max_edits: int) -> Finder:
    return Finder(dict(notices), dict(phrases), error_share, max_edits)


SPANS = pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("edits", pa.int64())]))
SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64())]
    + [("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("spans", SPANS)]
)
SQL = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
    "score double, spans array<struct<label:string,first_word:bigint,last_word:bigint,edits:bigint>>"
)


def _scan(key: tuple):
    def run(batches: Iterator[pa.RecordBatch]):
        find = finder(*key)
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                data, bounds = arrays.text_bytes(batch.column("text"))
                data = LOWER[data]
                starts, ends, first = arrays.word_spans(data, bounds, INSIDE)
                counts = np.diff(first)
                rows: dict[str, list] = {c: [] for c in SCHEMA.names}
                for row in range(batch.num_rows):
                    text = bytes(data[bounds[row] : bounds[row + 1]]).decode()
                    base, spans = [], []
                    normal = " " + " ".join(WORD.findall(text)) + " "
                    if counts[row]:
                        blanks = None
                        found = find.notices_in(normal)
                        if found or any(f" {p} " in normal for p in find.phrases):
                            blanks = [m.start() for m in re.finditer(r"\S+", normal)]
                            base = find.base(normal, blanks)
                            for label, low, high, edits, size in found:
                                a = max(0, bisect_right(blanks, low) - 1) if normal[low] != " " else bisect_right(blanks, low)
                                b = max(a, bisect_right(blanks, max(low, high - 1)) - 1)
                                spans.append(({"label": label, "first_word": a, "last_word": b, "edits": edits}, 1 - edits / size))
                    labels = sorted({x for x, _ in base})
                    every = sorted({*labels, *(s["label"] for s, _ in spans)})
                    places = [p for _, p in base]
                    score = 1.0 if base else max([0.0, *(s for _, s in spans)])
                    values = (
                        batch.column("doc_id")[row].as_py(), int(counts[row]), len(base), min(places, default=None), max(places, default=None),
                        ",".join(labels), ",".join(every), score, [s for s, _ in spans],
                    )
                    for c, value in zip(SCHEMA.names, values):
                        rows[c].append(value)
                yield pa.RecordBatch.from_pydict(rows, schema=SCHEMA)

    return run


def scan(docs: DataFrame, notices: dict[str, str] = NOTICES, phrases: dict[str, str] = PHRASES, error_share: float = 0.08, max_edits: int = 3) -> DataFrame:
    """Per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, and the notices' ``spans``."""
    if not 0 < error_share < 0.5:
        raise ValueError("error_share must lie between 0 and 0.5")
    key = (tuple(notices.items()), tuple(phrases.items()), error_share, max_edits)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInArrow(_scan(key), SQL)
