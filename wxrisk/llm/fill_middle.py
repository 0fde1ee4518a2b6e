"""Fill-in-the-middle texts by content-defined chunk memoization.

A rolling hash over the bytes cuts every text into chunks where the text itself says so, so copied passages
give equal chunks wherever they stand. What a chunk adds to a text is a small summary: its units, its code
points, and whether letters stand at its two edges. A task keeps summaries by the chunk's content, so equal
chunks are counted once. Summaries add up: a run of letters that goes on over an edge is one unit less. The sums tell
which chunk holds a cut, and only that chunk is looked into.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wxrisk.llm import common

#: Bytes that the rolling hash looks back over, and the distance to the last cut that a new one needs.
WINDOW = 16
GAP = 64
#: One place in so many ends a chunk.
CUT_EVERY = 512
#: Bytes hashed at once, and bytes of chunks whose summaries a task keeps; beyond it starts anew.
PIECE = 1 << 20
CACHE_BYTES = 32 << 20

# The marks of the output, shares of forms in percent, and the seed before a doc_id.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
FORMED_PERCENT = 90
SUFFIX_FIRST_PERCENT = 20
SEED = "1:"

_LETTERS = bytes([*range(0x41, 0x5B), *range(0x61, 0x7B)])
_INNER = bytes(range(0x80, 0xC0))
_RUNS = bytes(0x61 if b in _LETTERS else 0x20 for b in range(256))
_IS_LETTER = np.isin(np.arange(256), list(_LETTERS))
_STARTS_POINT = ~np.isin(np.arange(256), list(_INNER))
_CODES = (common.mix(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)
_RADIX = 0x9E3779B1


def rolling(data: np.ndarray) -> np.ndarray:
    """A 32-bit hash of the WINDOW bytes that end at each place (fewer at the beginning)."""
    h, width = _CODES[data], 1
    while width < WINDOW:
        factor = np.uint32(pow(_RADIX, width, 1 << 32))
        longer = h.copy()
        longer[width:] += h[:-width] * factor
        h, width = longer, 2 * width
    return h


def chunk_ends(data: np.ndarray) -> np.ndarray:
    """Where the chunks of a UTF-8 text end: at the places chosen by hash, between code points; the last is the text's end.

    A place counts only if none of the GAP - 1 places before is chosen, so a text that repeats one byte is one chunk.
    Long texts are hashed piece by piece.
    """
    found = []
    for begin in range(0, len(data), PIECE):
        back = max(0, begin - GAP - WINDOW)
        hit = np.flatnonzero(rolling(data[back:begin + PIECE]) % np.uint32(CUT_EVERY) == 0) + back + 1
        alone = hit[np.diff(hit, prepend=-GAP) >= GAP]
        found.append(alone[(alone > begin) & (alone < len(data))])
    ends = np.concatenate(found) if found else np.zeros(0, np.int64)
    return np.append(ends[_STARTS_POINT[data[ends]]], len(data))


class Summaries:
    """(units, code points, letter at the begin, letter at the end) of chunks, kept by content."""

    def __init__(self, limit: int = CACHE_BYTES):
        self.limit, self.kept, self.held, self.hits, self.misses = limit, {}, 0, 0, 0

    def __call__(self, chunk: bytes) -> tuple[int, int, bool, bool]:
        found = self.kept.get(chunk)  # a dictionary compares the content, not the hash alone
        if found is not None:
            self.hits += 1
            return found
        self.misses += 1
        points = len(chunk.translate(None, _INNER))
        others = len(chunk.translate(None, _INNER + _LETTERS))
        found = (others + len(chunk.translate(_RUNS).split()), points, chunk[0] in _LETTERS, chunk[-1] in _LETTERS)
        if self.held + len(chunk) > self.limit:
            self.kept, self.held = {}, 0
        if len(chunk) <= self.limit // 16:
            self.kept[chunk] = found
            self.held += len(chunk)
        return found


class Cuttable:
    """A text as chunks with running sums of their summaries."""

    def __init__(self, text: bytes, summaries: Summaries):
        self.text = text
        ends = chunk_ends(np.frombuffer(text, np.uint8))
        self.begins = np.append(0, ends[:-1])
        parts = [summaries(text[a:b]) for a, b in zip(self.begins.tolist(), ends.tolist(), strict=True) if b > a]
        units, points, first, last = (np.array(x) for x in zip(*parts, strict=True)) if parts else (np.zeros(0, int),) * 4
        self.goes_on = np.zeros(len(parts), np.int64)
        self.goes_on[1:] = last[:-1].astype(bool) & first[1:].astype(bool)
        self.units = np.cumsum(units - self.goes_on)
        self.points = np.cumsum(points)

    @property
    def n(self) -> int:
        return int(self.units[-1]) if len(self.units) else 0

    def cut(self, k: int) -> tuple[int, int]:
        """(byte, code point) after the first k units."""
        if k >= self.n:
            return len(self.text), int(self.points[-1]) if len(self.points) else 0
        chunk = int(np.searchsorted(self.units, k, side="right"))
        earlier = int(self.units[chunk - 1]) if chunk else 0
        begin = int(self.begins[chunk])
        end = int(self.begins[chunk + 1]) if chunk + 1 < len(self.begins) else len(self.text)
        own = np.frombuffer(self.text, np.uint8, end - begin, begin)
        letter, starts = _IS_LETTER[own], _STARTS_POINT[own]
        opens = starts & ~(letter & np.append(False, letter[:-1]))
        place = int(np.flatnonzero(opens)[k - earlier + int(self.goes_on[chunk])])
        return begin + place, (int(self.points[chunk - 1]) if chunk else 0) + int(starts[:place].sum())


def draws(doc_id: int | None) -> tuple[int, int, int, int]:
    """h1 to h4 of a document; one without an id draws as the empty id."""
    digest = hashlib.sha256(f"{SEED}{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[k:k + 4], "big") for k in (0, 4, 8, 12))


def formed(text: bytes, doc_id: int | None, summaries: Summaries) -> tuple[int, str, int | None, int | None, bytes]:
    """(units, form, prefix and middle code points or None, output)."""
    h1, h2, h3, h4 = draws(doc_id)
    whole = Cuttable(text, summaries)
    n = whole.n
    if not text or h3 % 100 >= FORMED_PERCENT or any(mark.encode() in text for mark in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, text
    (a, a_points), (b, b_points) = (whole.cut(k) for k in sorted((h1 % (n + 1), h2 % (n + 1))))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    p, s, m = PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode()
    if h4 % 100 < SUFFIX_FIRST_PERCENT:
        return n, "spm", a_points, b_points - a_points, b"".join((s, suffix, p, prefix, m, middle))
    return n, "psm", a_points, b_points - a_points, b"".join((p, prefix, s, suffix, m, middle))


def transformed(docs: DataFrame) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output), a row per row of ``docs``.

    Only doc_id and text are read, so other columns may have any names. A null text is empty, an empty text is
    plain. Repeated rows come out alike; a null doc_id stays null. No rows give no rows. A row needs nothing
    of other rows, so a lost task is simply run again.
    """
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summaries = Summaries()
        for batch in batches:
            for begin, end in common.chunks(batch.column(1), PIECE):
                ids = batch.column(0).slice(begin, end - begin)
                raw, ends = common.text_bytes(batch.column(1).slice(begin, end - begin))
                made = [formed(raw[a:b], i, summaries) for a, b, i in zip(ends[:-1], ends[1:], ids.to_pylist(), strict=True)]
                n, form, before, middle, output = zip(*made, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(n, pa.int64()), pa.array(form), pa.array(before, pa.int64()), pa.array(middle, pa.int64()), pa.array(output, pa.binary()).cast(pa.string())],
                    ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return plain.mapInArrow(rows, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of. No part holds a mark, so the marks part it exactly."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}")
    psm, spm = F.concat(parts[1], parts[3], parts[2]), F.concat(parts[2], parts[3], parts[1])
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def digests(made: DataFrame) -> DataFrame:
    """The rows of ``transformed`` with SHA-256 of output and restored text in place of the output."""
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2(F.col("output"), 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))
