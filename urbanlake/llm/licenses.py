"""License scans by fuzzy short-notice search.

Each notice, as lower-case words joined by one space, may occur with up to
``max_edits`` errors (insertions, deletions, substitutions of characters).  It
is split into ``max_edits + 1`` pieces: however the errors fall, one piece
stands unchanged (pigeonhole).  One automaton over the pieces of all notices
finds these seeds in the document; around each seed, widened by the notice's
length and the errors allowed, the regex library's bounded-error matching looks
for the best match and gives its span and errors.  A match holds its seed, so no
search is longer than a notice with its errors.  Of overlapping finds of a notice
the one with fewest errors stands (ties: the first), and the rest of their windows
is searched again.

Base labels come from exact phrases of whole words.

Each document is worked on by itself, in Arrow batches: the scan neither
shuffles nor gathers anything.  Defined cases: a null or empty text has no word
and no label, score 0; repeated rows are scanned each; a null ``doc_id`` is
kept as it is.
"""

from __future__ import annotations

import bisect
import heapq
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from urbanlake.llm.common import batches, text_bytes

#: Phrases whose words, standing consecutively, give a base label.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Short notices and the labels that a match within the allowed errors gives.
NOTICES = {
    "licensed under the apache license version 2 0": "apache-2.0",
    "released under the terms of the gnu general public license": "gpl-notice",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu": "gpl-notice",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit-notice",
    "licensed under the mit license": "mit-notice",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "permission to use copy modify and or distribute this software for any purpose": "isc",
    "subject to the terms of the mozilla public license": "mpl",
    "licensed under a creative commons attribution": "cc",
    "this work is licensed under cc by": "cc",
    "licensed under cc by nc": "cc-by-nc",
    "licensed under cc by sa": "cc-by-sa",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "all rights reserved worldwide": "all-rights-reserved",
}
#: One error is allowed for this many characters of a notice.
CHARS_PER_EDIT = 12

#: Runs of what is neither ASCII punctuation, control, space nor (after lower-casing) upper case.
WORD = regex.compile(rb"[0-9a-z\x80-\xff]+")


def max_edits(notice: str, chars_per_edit: int = CHARS_PER_EDIT) -> int:
    return len(notice) // chars_per_edit


def pieces(notice: str, errors: int) -> list[tuple[int, str]]:
    """The notice cut into errors + 1 runs of about equal length, with their starts."""
    cuts = [round(i * len(notice) / (errors + 1)) for i in range(errors + 2)]
    return [(a, notice[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


class Scanner:
    """Finds phrases and notices in one normalised text."""

    def __init__(self, notices: dict[str, str] = NOTICES, phrases: dict[str, str] = PHRASES,
                 chars_per_edit: int = CHARS_PER_EDIT) -> None:
        self.phrases = [(f" {p} ".encode(), label) for p, label in phrases.items()]
        self.notices = []
        seeds: dict[str, list[tuple[int, int]]] = {}
        for k, (notice, label) in enumerate(notices.items()):
            errors = max_edits(notice, chars_per_edit)
            self.notices.append((len(notice), errors, regex.compile(
                rf"(?b)(?<![^ ])(?:{regex.escape(notice, special_only=True)}){{e<={errors}}}(?![^ ])"), label))
            for at, piece in pieces(notice, errors):
                seeds.setdefault(piece, []).append((k, at))
        self.seeds = ahocorasick.Automaton()
        for piece, uses in seeds.items():
            self.seeds.add_word(piece, (len(piece), uses))
        self.seeds.make_automaton()

    def phrase_starts(self, text: bytes) -> list[tuple[int, str]]:
        """Byte starts and labels; ``text`` has a space before and after every word."""
        found = []
        for phrase, label in self.phrases:
            at = text.find(phrase)
            while at >= 0:
                found.append((at, label))
                at = text.find(phrase, at + 1)
        return found

    def fuzzy(self, text: str) -> list[tuple[int, int, int, str]]:
        """``(start, end, errors, label)`` of the notices found, of each notice the best ones that don't overlap."""
        windows: dict[int, set[int]] = {}
        for end, (length, uses) in self.seeds.iter(text):
            for k, at in uses:
                windows.setdefault(k, set()).add(end + 1 - length - at)
        found = []
        for k, starts in windows.items():
            found += [(*span, self.notices[k][3]) for span in self._best_of(text, k, sorted(starts))]
        return sorted(found)

    def _best_of(self, text: str, k: int, starts: list[int]) -> list[tuple[int, int, int]]:
        """Best-first finds of one notice around the places where its seeds let it start."""
        size, errors, pattern, _ = self.notices[k]
        known: dict[str, tuple[int, int, int] | None] = {}     # by a window's text: repeated lines are searched once

        def search(low: int, high: int) -> tuple[int, int, int, int, int] | None:
            """The best match between two places, as ``(errors, start, end, low, high)``; ``high`` is before a space."""
            high = text.rfind(" ", low, high + 1)
            if high - low < size - errors:
                return None
            part = text[max(low - 1, 0):high + 1]
            if part not in known:
                m = pattern.search(part, low - max(low - 1, 0), len(part) - 1)
                known[part] = None if m is None else (sum(m.fuzzy_counts), m.start(), m.end())
            hit = known[part]
            if hit is None:
                return None
            shift = max(low - 1, 0)
            return hit[0], hit[1] + shift, hit[2] + shift, low, high

        heap, first = [], None
        for at in starts:                                      # seeds of one occurrence differ by its errors at most
            if first is not None and at - first <= 2 * errors + 2:
                continue
            first = at
            low = max(0, at - errors - 1)
            if (hit := search(low, min(len(text) - 1, at + size + 4 * errors + 4))) is not None:
                heap.append(hit)
        heapq.heapify(heap)
        taken: list[tuple[int, int]] = []                      # sorted and apart
        out = []
        while heap:
            wrong, start, end, low, high = heapq.heappop(heap)
            i = bisect.bisect_right(taken, (start, len(text) + 1))
            before = taken[i - 1] if i and taken[i - 1][1] > start else None
            after = taken[i] if i < len(taken) and taken[i][0] < end else None
            clash = before or after
            if clash is None:
                out.append((start, end, wrong))
                taken.insert(i, (start, end))
                clash = (start, end)
            for a, z in ((low, clash[0] - 1), (max(clash[1], low), high)):
                if z > a and (hit := search(a, z)) is not None:
                    heapq.heappush(heap, hit)
        return out


def scan_text(utf8: bytes, scanner: Scanner) -> dict:
    """Counts, labels and spans of one document; spans are characters of the words joined by one space."""
    words = WORD.findall(utf8.lower())
    joined = b" " + b" ".join(words) + b" "
    base = scanner.phrase_starts(joined)
    starts, blanks, upto = [], 0, 0
    for at, _ in sorted(base):
        blanks, upto = blanks + joined.count(b" ", upto, at + 1), at + 1
        starts.append(blanks - 1)
    text = joined.decode("utf-8", "replace")
    fuzzy = scanner.fuzzy(text) if words else []
    labels = {label for _, label in base}
    best = 1.0 if base else max((1 - errors / max(end - start, 1) for start, end, errors, _ in fuzzy), default=0.0)
    return {"n_words": len(words), "n_base": len(base), "first_word": min(starts, default=None),
            "last_word": max(starts, default=None), "base_labels": ",".join(sorted(labels)),
            "labels": ",".join(sorted(labels | {x[3] for x in fuzzy})), "score": best,
            "spans": [{"start": s - 1, "end": e - 1, "edits": n, "label": x} for s, e, n, x in fuzzy]}


RESULT = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
    ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
    ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("edits", pa.int32()), ("label", pa.string())])))])


def license_scan(docs: DataFrame, notices: dict[str, str] | None = None, chars_per_edit: int = CHARS_PER_EDIT) -> DataFrame:
    """One row per row of ``docs``: word count, base phrases, labels, score and the fuzzy notices' spans."""
    notices = NOTICES if notices is None else notices

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(notices, chars_per_edit=chars_per_edit)
        for b in batches(rows):
            out = [{"doc_id": d, **scan_text(t, scanner)}
                   for d, t in zip(b.column("doc_id").to_pylist(), b.column("utf8").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_pylist(out, schema=RESULT)

    return text_bytes(docs).mapInArrow(
        run, "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
             "score double, spans array<struct<start:int,end:int,edits:int,label:string>>")
