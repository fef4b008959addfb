"""License notices in texts, spelled exactly or nearly so.

A notice of m characters may differ from its pattern in a few edits. The pattern is cut
into one piece more than that, so one piece at least stands unchanged (pigeonhole): an
Aho-Corasick automaton over the pieces of all notices finds the places to look at, and the
regex library's bounded-error matching verifies a window around each and tells the span.

Texts are compared as words joined by one space, so line ends, comment marks and
punctuation are no edits. A match starts and ends with whole words.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from wiretide.llm.common import row_pass, text_table

#: A pattern allows one edit less than it has whole pieces of so many characters, and so many at most:
#: the time of a bounded-error match grows steeply with its bound.
PIECE, MOST_EDITS = 12, 5

#: Base phrases, found as whole consecutive words (fixed by the contract).
PHRASES = (("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license"))

#: Short notices: label and wording, as their publishers give them.
NOTICES = (
    ("mit", "released under the mit license"),
    ("mit", "licensed under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "you may not use this file except in compliance with the license"),
    ("gpl", "licensed under the gnu general public license"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "gnu lesser general public license"),
    ("agpl", "gnu affero general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd", "neither the name of the copyright holder nor the names of its contributors may be used to endorse"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license"),
    ("epl", "made available under the terms of the eclipse public license"),
    ("boost", "distributed under the boost software license"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("cc0", "the person who associated a work with this deed has dedicated the work to the public domain"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("proprietary", "all rights reserved no part of this work may be reproduced"),
)

#: Bytes that separate words: all of ASCII but digits and letters.
_GAPS = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def joined_words(text: str | None) -> str:
    """The words, A-Z lower-cased, each between two single spaces; one space where there are none."""
    # Only spaces are left of ASCII's white space, and bytes split at no other.
    words = b" ".join((text or "").encode("utf-8", "surrogatepass").lower().translate(_GAPS).split())
    return f" {words.decode('utf-8', 'surrogatepass')} " if words else " "


def edits_allowed(pattern: str) -> int:
    return min(max(len(pattern) // PIECE - 1, 0), MOST_EDITS)


@dataclass(frozen=True)
class Match:
    """A notice or phrase found: words first..last (from 0), characters start..end of the joined words."""

    label: str
    pattern: str
    first: int
    last: int
    errors: int
    start: int
    end: int
    base: bool


class Scanner:
    """Finds phrases and notices in one text after the other."""

    def __init__(self, phrases: tuple = PHRASES, notices: tuple = NOTICES):
        import ahocorasick
        import regex

        self.phrases, self.notices = phrases, notices
        self.allowed = [edits_allowed(p) for _, p in notices]
        # Better matches first within a window; the words around it are not part of the pattern.
        self.exact = [regex.compile(f"(?b) ((?:{regex.escape(p)}){{e<={k}}}) ") for (_, p), k in zip(notices, self.allowed)]
        pieces: dict[str, list] = {}
        for i, (_, phrase) in enumerate(phrases):
            pieces.setdefault(f" {phrase} ", []).append((None, i, 0))
        for i, (_, pattern) in enumerate(notices):
            parts = self.allowed[i] + 1
            cuts = [len(pattern) * j // parts for j in range(parts + 1)]
            for a, b in zip(cuts, cuts[1:]):
                pieces.setdefault(pattern[a:b], []).append((i, None, a))
        self.automaton = ahocorasick.Automaton()
        for piece, uses in pieces.items():
            self.automaton.add_word(piece, (len(piece), uses))
        self.automaton.make_automaton()
        self.verify = lru_cache(maxsize=4096)(self._verify)

    def _verify(self, i: int, window: str) -> tuple[int, int, int] | None:
        """Start, end and edits of the best match in the window, if there is one."""
        m = self.exact[i].search(window)
        return (m.start(1), m.end(1), sum(m.fuzzy_counts)) if m else None

    def _of_notice(self, i: int, joined: str, starts: list[int]) -> Iterable[tuple[int, int, int]]:
        """Matches of a notice that a piece places at about `starts`; of overlapping ones the better."""
        size, k = len(self.notices[i][1]), self.allowed[i]
        starts.sort()
        kept: tuple[int, int, int] | None = None
        at = 0
        while at < len(starts):
            first = starts[at]
            # Starts near each other belong to one place; every one's own window lies in the common one.
            while at < len(starts) and starts[at] <= first + 2 * k:
                last = starts[at]
                at += 1
            begin = max(first - k - 1, 0)
            found = self.verify(i, joined[begin : last + size + k + 1])
            if not found:
                continue
            found = (begin + found[0], begin + found[1], found[2])
            if kept and found[0] < kept[1]:
                kept = min(kept, found, key=lambda m: (m[2], m[0]))
                continue
            if kept:
                yield kept
            kept = found
        if kept:
            yield kept

    def scan(self, text: str | None) -> tuple[int, list[Match]]:
        """Number of words, and all matches by place."""
        joined = joined_words(text)
        spans, starts = [], {}
        for end, (size, uses) in self.automaton.iter(joined):
            for notice, phrase, offset in uses:
                if notice is None:
                    spans.append((end - size + 2, end, 0, phrase, True))
                else:
                    starts.setdefault(notice, []).append(end + 1 - size - offset)
        for i, at in starts.items():
            spans += [(*m, i, False) for m in self._of_notice(i, joined, at)]
        spans.sort()
        out, word, seen = [], 0, 1
        for start, end, errors, i, base in spans:
            word += joined.count(" ", seen, start)
            seen = start
            label, pattern = (self.phrases if base else self.notices)[i]
            out.append(Match(label, pattern, word, word + joined.count(" ", start, end), errors, start, end, base))
        return joined.count(" ") - 1, out


@lru_cache(maxsize=4)
def scanner(phrases: tuple, notices: tuple) -> Scanner:
    """One scanner per worker process and list of notices."""
    return Scanner(phrases, notices)


def closeness(m: Match) -> float:
    """1 for the wording itself, less by the share of edited characters."""
    return 1.0 - m.errors / len(m.pattern)


def scan_documents(docs: DataFrame, phrases: tuple = PHRASES, notices: tuple = NOTICES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, n_notices.

    n_base counts all places of the phrases, overlapping ones too; first_word and last_word are
    the smallest and largest word number at which one starts, null without any. base_labels
    are those of the phrases, labels those of phrases and notices, distinct, sorted,
    comma-joined, empty without any. score is 1 for a phrase or an exact notice, less by the
    share of edited characters of the closest notice, 0 without any. Null and empty texts have
    no words. Every row gets its own result, repeated ones and those without an id too.
    """

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        tool, out = scanner(phrases, notices), []
        for text in batch.column(1).to_pylist():
            n, found = tool.scan(text)
            base = [m for m in found if m.base]
            names = ",".join(sorted({m.label for m in base})), ",".join(sorted({m.label for m in found}))
            first, last = (min(m.first for m in base), max(m.first for m in base)) if base else (None, None)
            out.append((n, len(base), first, last, *names, max(map(closeness, found), default=0.0), len(found) - len(base)))
        types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.int64()]
        columns = [pa.array(c, type=t) for c, t in zip(zip(*out), types)]
        return pa.RecordBatch.from_arrays([batch.column(0), *columns], names=COLUMNS)

    schema = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, n_notices long"
    return row_pass(text_table(docs, id_col, text_col), work, schema)


COLUMNS = "doc_id n_words n_base first_word last_word base_labels labels score n_notices".split()


def find_notices(docs: DataFrame, phrases: tuple = PHRASES, notices: tuple = NOTICES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per match: doc_id, label, pattern, base, errors, first_word, last_word, start, end, found.

    start and end are characters of the text as it is, found what stands there. A base phrase
    within a notice has a row of its own. Texts without a match have no row.
    """
    names = "doc_id label pattern base errors first_word last_word start end found".split()
    types = [pa.int64(), pa.string(), pa.string(), pa.bool_()] + [pa.int64()] * 5 + [pa.string()]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        tool, out = scanner(phrases, notices), []
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            found = tool.scan(text)[1]
            spans = [m.span() for m in _WORD.finditer(text)] if found else []
            for m in found:
                start, end = spans[m.first][0], spans[m.last][1]
                out.append((doc, m.label, m.pattern, m.base, m.errors, m.first, m.last, start, end, text[start:end]))
        columns = zip(*out) if out else [[] for _ in names]
        return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, types)], names=names)

    schema = "doc_id long, label string, pattern string, base boolean, errors long, first_word long, last_word long, start long, end long, found string"
    return row_pass(text_table(docs, id_col, text_col), work, schema)
