"""Fuzzy search for short licence notices.

Texts are normalised to lower-case words joined by one space.  A notice that may
be written with up to k edits is split into k + 1 exact seeds: by the pigeonhole
principle one of them stands unchanged in any such copy.  Exact search for the
seeds locates candidate windows; the regex library's bounded-error matching then
verifies them and reports spans and edit counts.  Exact phrases of ``PHRASES`` are
counted apart and always keep their label.

Defined results: null and empty texts have no words, no labels and score 0; repeated
rows are scanned one by one; an empty table gives an empty result; other columns are
ignored.  Long texts are scanned whole.
"""

from __future__ import annotations

import heapq
from bisect import bisect_right
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, arrow_schema, slices

#: Exact phrases and their labels.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

#: The wording of well-known short notices, and their labels.
NOTICES = {
    "licensed under the apache license version 2 0": "apache-2.0",
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "redistribution and use in source and binary forms with or without modification": "bsd",
    "gnu general public license": "gpl",
    "gnu lesser general public license": "lgpl",
    "mozilla public license version 2 0": "mpl-2.0",
    "creative commons attribution": "cc-by",
    "creative commons zero": "cc0",
    "released into the public domain": "public-domain",
    "all rights reserved": "reserved",
}
SEED_CHARS = 8
MOST_EDITS = 4


def _normal_bytes() -> bytes:
    kept = set(b"0123456789" + LOWER.encode()) | set(range(128, 256))
    table = bytearray(b if b in kept else 32 for b in range(256))
    for a, b in zip(UPPER.encode(), LOWER.encode()):
        table[a] = b
    return bytes(table)


NORMAL = _normal_bytes()


class Notice(NamedTuple):
    text: bytes
    label: str
    edits: int
    seeds: list[tuple[int, bytes]]
    pattern: regex.Pattern


def notice(text: str, label: str) -> Notice:
    """Seeds of at least ``SEED_CHARS`` and the pattern that verifies a window."""
    data = text.encode()
    edits = max(0, min(MOST_EDITS, len(data) // SEED_CHARS - 1))
    cuts = [len(data) * i // (edits + 1) for i in range(edits + 2)]
    seeds = [(a, data[a:b]) for a, b in zip(cuts, cuts[1:])]
    pattern = regex.compile(rb"(?b)(?<![^ ])(?:%s){e<=%d}(?![^ ])" % (regex.escape(data, literal_spaces=True), edits))
    return Notice(data, label, edits, seeds, pattern)


def places(norm: bytes, phrase: bytes) -> list[int]:
    """Byte offsets in ``norm`` where the phrase's words stand, shared words allowed."""
    found, padded, target = [], b" " + norm + b" ", b" " + phrase + b" "
    at = padded.find(target)
    while at >= 0:
        found.append(at)
        at = padded.find(target, at + 1)
    return found


def windows(norm: bytes, n: Notice) -> list[tuple[int, int]]:
    """Stretches that an edited copy around an exact seed can fill, ending with a word."""
    found = set()
    for offset, seed in n.seeds:
        at = norm.find(seed)
        while at >= 0:
            begin = max(0, at - offset - n.edits)
            end = min(len(norm), at - offset + len(n.text) + 2 * n.edits)
            if end < len(norm) and norm[end] != 32:
                end = norm.rfind(b" ", begin, end)
            found.add((begin, end))
            at = norm.find(seed, at + 1)
    return sorted(found)


def fuzzy_spans(norm: bytes, n: Notice) -> list[tuple[int, int, int]]:
    """(start, end, edits) of verified copies that do not overlap: those with the fewest edits
    first, then the leftmost.  Where a better copy takes part of a window, what is left of the
    window in front of it and behind it is searched again."""
    ready: list[tuple[int, int, int, int, int]] = []
    taken: list[tuple[int, int, int]] = []

    def search(a: int, b: int) -> None:
        if b - a >= len(n.text) - n.edits:
            m = n.pattern.search(norm, a, b)
            if m:
                heapq.heappush(ready, (sum(m.fuzzy_counts), m.start(), m.end(), a, b))

    for window in windows(norm, n):
        search(*window)
    while ready:
        edits, start, end, a, b = heapq.heappop(ready)
        at = bisect_right(taken, (start, len(norm) + 1, 0))
        near = [t for t in taken[max(0, at - 1):at + 1] if t[0] < end and start < t[1]]
        if not near:
            taken.insert(at, (start, end, edits))
        elif near[0][:2] != (start, end):
            search(a, min(b, near[0][0] - 1))
            search(max(a, near[0][1] + 1), b)
    return taken


OUT = ("doc_id long, n_words long, n_base long, first_word long, last_word long, "
       "base_labels string, labels string, score double, spans string")


def scanner(phrases: dict[str, str], notices: dict[str, str]):
    out = arrow_schema(OUT)
    base = [(p.encode(), label) for p, label in phrases.items()]
    fuzzy = [(t, label) for t, label in notices.items()]

    def row(doc_id, data: bytes, known: list[Notice]) -> tuple:
        words = data.translate(NORMAL).split()
        norm = b" ".join(words)
        # The word that starts at a byte has as many spaces before it as words.
        spaces = np.flatnonzero(np.frombuffer(norm, np.uint8) == 32)
        starts, base_labels = [], set()
        for phrase, label in base:
            found = places(norm, phrase)
            if found:
                starts += np.searchsorted(spaces, found).tolist()
                base_labels.add(label)
        labels, score, spans = set(base_labels), float(bool(base_labels)), []
        for n in known:
            for a, b, edits in fuzzy_spans(norm, n):
                labels.add(n.label)
                score = max(score, 1 - edits / len(n.text))
                first, last = np.searchsorted(spaces, (a, b)).tolist()
                spans.append((first, last + 1, n.label, edits))
        return (doc_id, len(words), len(starts), min(starts, default=None), max(starts, default=None),
                ",".join(sorted(base_labels)), ",".join(sorted(labels)), score,
                ",".join(f"{label}:{a}:{b}:{e}" for a, b, label, e in sorted(spans)))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [notice(t, label) for t, label in fuzzy]
        for batch in slices(batches):
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            rows = [row(i, t or b"", known) for i, t in zip(batch.column(0).to_pylist(), texts)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), out.types)], schema=out)

    return scan


def scan_licenses(documents: DataFrame, phrases: dict[str, str] | None = None,
                  notices: dict[str, str] | None = None) -> DataFrame:
    """One row per document: exact phrase places, labels, score and word spans
    ``label:first_word:end_word:edits``.  One narrow pass, no shuffle."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    return docs.mapInArrow(scanner(phrases or PHRASES, notices or NOTICES), OUT)
