"""License scans: exact phrases, and short notices found despite a few edits.

Text is lower-cased (A-Z) and cut into words; words joined by one space are the searched
form. A notice with e allowed edits is split into e + 1 pieces: a match with at most e edits
keeps one piece whole, so occurrences of the pieces (one automaton over all notices) locate
all candidates. Around each, bounded-error matching of the regex library verifies the
edits and gives the span. Where notices of one kind follow each other, the best match is
taken first and the text on both sides of it is searched again.

Null and empty texts have no words and no labels. Rows are independent: repeated rows and
ids, null ids and further columns do not matter. Whole texts are read, however long.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from vacancia.llm.common import ship

#: Phrases whose places are counted, and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Notices that are matched with edits: (text, label, allowed edits).
NOTICES = (
    ("gnu general public license", "gpl", 3),
    ("gnu lesser general public license", "lgpl", 3),
    ("licensed under the apache license", "apache", 4),
    ("permission is hereby granted free of charge", "mit", 5),
    ("released under the mit license", "mit", 3),
    ("redistribution and use in source and binary forms", "bsd", 5),
    ("mozilla public license", "mpl", 2),
    ("licensed under cc by", "cc-by", 2),
    ("creative commons attribution", "cc-by", 3),
    ("released into the public domain", "public-domain", 4),
    ("all rights reserved", "reserved", 2),
    ("no part of this publication may be reproduced", "reserved", 5),
)

SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
    "labels string, score double, spans array<struct<label:string,start:long,stop:long,edits:int,found:string>>")

_WORD = {*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)}
_TO_WORDS = bytes((i + 32 if 0x41 <= i <= 0x5A else i) if i in _WORD else 0x20 for i in range(256))


def seeds(notice: str, edits: int) -> list[tuple[int, str]]:
    """``edits + 1`` pieces of a notice with their offsets, as even as can be."""
    cuts = [i * len(notice) // (edits + 1) for i in range(edits + 2)]
    return [(a, notice[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def _matches(pattern, text: str, begin: int, end: int) -> Iterator:
    """Matches in ``text[begin:end]`` that do not overlap: the best one, then those beside it."""
    parts = [(begin, end)]
    while parts:
        a, b = parts.pop()
        m = pattern.search(text, a, b) if a < b else None
        if m and m.end() > m.start():
            yield m
            parts += [(a, m.start()), (m.end(), b)]


@dataclass
class Scanner:
    """The automaton over all pieces and one bounded-error pattern for each notice."""

    phrases: dict[str, str]
    notices: tuple[tuple[str, str, int], ...]
    automaton: object = field(init=False)

    def __post_init__(self):
        places: dict[str, list[tuple[int, int]]] = {}
        for k, (notice, _, edits) in enumerate(self.notices):
            for offset, piece in seeds(notice, edits):
                places.setdefault(piece, []).append((k, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, (len(piece), where))
        if places:
            self.automaton.make_automaton()
        self.patterns = [
            regex.compile(rf"(?b)(?<![^ ])(?:{regex.escape(n, literal_spaces=True)}){{e<={e}}}(?![^ ])")
            for n, _, e in self.notices]

    def fuzzy(self, text: str) -> list[tuple[str, int, int, int, str]]:
        """(label, start, stop, edits, found) of verified notices; offsets in ``text``."""
        windows: dict[int, list[list[int]]] = {}
        if len(self.automaton):
            for last, (size, where) in self.automaton.iter(text):
                for k, offset in where:
                    notice, _, edits = self.notices[k]
                    begin = last - size + 1 - offset
                    # Whole words on both sides, so that the edges of a match are seen.
                    a = text.rfind(" ", 0, max(0, begin - edits)) + 1
                    b = text.find(" ", begin + len(notice) + edits)
                    b = len(text) if b < 0 else b
                    spans = windows.setdefault(k, [])
                    if spans and a <= spans[-1][1] and a >= spans[-1][0]:
                        spans[-1][1] = max(spans[-1][1], b)
                    else:
                        spans.append([a, b])
        found = set()
        for k, spans in windows.items():
            for a, b in spans:
                for m in _matches(self.patterns[k], text, a, b):
                    found.add((self.notices[k][1], m.start(), m.end(), sum(m.fuzzy_counts), m.group(), k))
        return sorted(found)

    def scan(self, text: str | None) -> tuple:
        words = (text or "").encode("utf-8", "replace").translate(_TO_WORDS).split()
        clean = b" ".join(words)
        padded, starts, base = b" " + clean + b" ", [], set()
        for phrase, label in self.phrases.items():
            needle, at, word, seen = b" " + phrase.encode() + b" ", -1, 0, 0
            while (at := padded.find(needle, at + 1)) >= 0:
                word += padded.count(b" ", seen, at)
                seen = at
                starts.append(word)
                base.add(label)
        labels, score, spans = set(base), float(bool(base)), []
        string = clean.decode()
        for label, a, b, edits, matched, k in self.fuzzy(string):
            labels.add(label)
            score = max(score, 1 - edits / len(self.notices[k][0]))
            first = string.count(" ", 0, a)
            spans.append({"label": label, "start": first, "stop": first + matched.strip().count(" ") + 1,
                          "edits": edits, "found": matched})
        return (len(words), len(starts), min(starts, default=None), max(starts, default=None),
                ",".join(sorted(base)), ",".join(sorted(labels)), score, spans)


def scan(docs: DataFrame, phrases: dict[str, str] | None = None, notices=NOTICES,
         doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: base places, labels, score, verified spans (in words)."""
    scanner_parts = (dict(PHRASES if phrases is None else phrases), tuple(notices))
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(*scanner_parts)
        span = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("stop", pa.int64()),
                                   ("edits", pa.int32()), ("found", pa.string())]))
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), span]
        names = "n_words n_base first_word last_word base_labels labels score spans".split()
        for batch in batches:
            rows = [scanner.scan(x) for x in batch.column(1).to_pylist()]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                names=["doc_id", *names])

    return docs.selectExpr(f"cast(`{doc_id}` AS long) doc_id", f"`{text}` text").mapInArrow(run, SCHEMA)
