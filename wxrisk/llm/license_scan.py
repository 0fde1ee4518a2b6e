"""License scans: exact phrases, and short notices with a bounded number of edits.

A notice with at most ``e`` edits keeps one of e + 1 pieces unharmed. The pieces of all notices
are sought together in one pass (Aho-Corasick); around each hit the ``regex`` module's bounded
errors decide and give the span. A word that tells a notice from another one carries no edit, and of
overlapping notices the one with the fewest edits stays. Documents are read alone, so nothing is shuffled.
"""

from __future__ import annotations

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wxrisk.llm import common

# Phrases whose words must stand consecutively, and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Notices (words only) that may carry edits, and their labels.
NOTICES = (
    ("licensed under the gnu general public license", "gpl"),
    ("licensed under the gnu lesser general public license", "lgpl"),
    ("licensed under the apache license version 2 0", "apache"),
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit"),
    ("redistribution and use in source and binary forms with or without modification", "bsd"),
    ("subject to the terms of the mozilla public license", "mpl"),
    ("licensed under a creative commons attribution", "cc-by"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("licensed under cc by sa 4 0", "cc-by-sa"),
    ("licensed under cc by 4 0", "cc-by"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("all rights reserved", "all-rights-reserved"),
)
# Words of notices that tell them from like ones (BSD, ISC, CC BY-ND ...); they must stand as they are.
EXACT = ("by nc", "by sa", "by", "mit", "lesser")
#: Letters of a notice per allowed edit.
LETTERS_PER_EDIT = 10

_WORDS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256)
)

SCAN = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
SPANS = "array<struct<label:string, notice:string, edits:int, first_word:long, last_word:long, found:string>>"


def pieces(notice: str, edits: int) -> list[tuple[int, str]]:
    """(place, piece) of ``edits`` + 1 parts of nearly equal length."""
    cuts = [round(k * len(notice) / (edits + 1)) for k in range(edits + 2)]
    return [(a, notice[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def pattern(notice: str, edits: int) -> regex.Pattern:
    """The best match of a notice with its edits; they may lie before and after an exact word, not in it."""
    for word in EXACT:
        before, word, after = notice.partition(f" {word} ")
        if word:
            ways = (f"(?:{regex.escape(before)}){{e<={k}}}{regex.escape(word)}(?:{regex.escape(after)}){{e<={edits - k}}}" for k in range(edits + 1))
            return regex.compile(f"(?b)(?:{'|'.join(ways)})")
    return regex.compile(f"(?b)(?:{regex.escape(notice)}){{e<={edits}}}")


def told_apart(found: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Of overlapping (begin, end, notice, edits) the one with the fewest edits, then the longest.

    Notices that share no more letters than their edits and the space between them don't overlap.
    """
    kept: list[tuple[int, int, int, int]] = []
    group: list[tuple[int, int, int, int]] = []
    reach = 0

    def settle():
        own: list[tuple[int, int, int, int]] = []
        for f in sorted(group, key=lambda f: (f[3], f[0] - f[1], f[0], f[2])):
            if all(min(f[1], o[1]) - max(f[0], o[0]) <= 1 + f[3] + o[3] for o in own):
                own.append(f)
        kept.extend(sorted(own))

    for f in sorted(found):
        if group and f[0] >= reach:
            settle()
            group.clear()
        group.append(f)
        reach = max(reach, f[1]) if len(group) > 1 else f[1]
    settle()
    return kept


class NoticeFinder:
    """Finds phrases and notices in one text; built once per task."""

    def __init__(self, phrases=PHRASES, notices=NOTICES, per_edit: int = LETTERS_PER_EDIT):
        self.phrases = [(f" {p} ".encode(), label) for p, label in phrases.items()]
        self.notices = [(f" {n} ", label, max(1, len(n) // per_edit)) for n, label in notices]
        self.patterns = [pattern(n, e) for n, _, e in self.notices]
        seeds: dict[str, list[tuple[int, int]]] = {}
        for number, (notice, _, edits) in enumerate(self.notices):
            for place, piece in pieces(notice, edits):
                seeds.setdefault(piece, []).append((number, place))
        self.seeds = ahocorasick.Automaton()
        for piece, places in seeds.items():
            self.seeds.add_word(piece, (len(piece), places))
        self.seeds.make_automaton()

    def base(self, text: bytes) -> tuple[int, list[int], set[str]]:
        """All places of the phrases as byte positions in a text of single spaces, ordered, and their labels."""
        found, labels = [], set()
        for phrase, label in self.phrases:
            at = text.find(phrase)
            while at >= 0:
                found.append(at)
                labels.add(label)
                at = text.find(phrase, at + len(phrase) - 1)
        return len(found), sorted(found), labels

    def fuzzy(self, text: str) -> list[tuple[int, int, int, int]]:
        """(begin, end, notice number, edits) of the notices; overlapping finds of one notice are given once."""
        windows: dict[int, list[list[int]]] = {}
        for last, (length, places) in self.seeds.iter(text):
            for number, place in places:
                notice, _, edits = self.notices[number]
                begin = max(0, last + 1 - length - place - edits)
                end = min(len(text), last + 1 - length - place + len(notice) + edits)
                known = windows.setdefault(number, [])
                if known and begin <= known[-1][1]:
                    known[-1][0] = min(known[-1][0], begin)
                    known[-1][1] = max(known[-1][1], end)
                else:
                    known.append([begin, end])
        found = []
        for number, spans in windows.items():
            for begin, end in spans:
                for match in self.patterns[number].finditer(text, begin, end):
                    found.append((match.start(), match.end(), number, sum(match.fuzzy_counts)))
        return sorted(found)

    def scan(self, raw: bytes) -> tuple:
        words = raw.translate(_WORDS).split()
        text = b" " + b" ".join(words) + b" "
        n_base, places, labels = self.base(text)
        as_text = text.decode("utf-8", "replace")
        spans, best = [], 1.0 if n_base else 0.0
        for begin, end, number, edits in told_apart(self.fuzzy(as_text)):
            notice, label, _ = self.notices[number]
            best = max(best, 1.0 - edits / len(notice))
            found = as_text[begin:end].strip()
            first = as_text.count(" ", 0, begin + 1) - 1
            spans.append({"label": label, "notice": notice.strip(), "edits": edits, "first_word": first,
                          "last_word": first + found.count(" "), "found": found})
        every = labels | {s["label"] for s in spans}
        first, last = (text.count(b" ", 0, p) for p in (places[0], places[-1])) if places else (None, None)
        return len(words), n_base, first, last, ",".join(sorted(labels)), ",".join(sorted(every)), best, spans


def scanned(docs: DataFrame) -> DataFrame:
    """doc_id, the counts and labels of exact phrases, labels, score and the spans of fuzzy notices per row.

    Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased; positions count
    words from 0. A null or empty text has no word, empty labels, null positions, score 0 and no
    span. Score is 1 for an exact phrase, else 1 - edits / length of the best notice. Rows are
    scanned alone: copies, ties and other columns don't matter.
    """
    def rows(batches):
        finder = NoticeFinder()
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.list_(pa.struct([
            ("label", pa.string()), ("notice", pa.string()), ("edits", pa.int32()), ("first_word", pa.int64()),
            ("last_word", pa.int64()), ("found", pa.string())])))
        names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
        for batch in batches:
            for a, b in common.chunks(batch.column(1)):
                raw, ends = common.text_bytes(batch.column(1)[a:b])
                found = [finder.scan(raw[i:j]) for i, j in zip(ends[:-1], ends[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[a:b], *(pa.array(c, k) for c, k in zip(zip(*found, strict=True), kinds, strict=True))], names)

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return plain.mapInArrow(rows, f"doc_id long, {SCAN}, spans {SPANS}")
