"""What several operators share: staged tables and word arrays over Arrow text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wxrisk.session import TableStages

#: Bytes of text that a task turns into arrays at once.
CHUNK_BYTES = 4 << 20

_LOWER_AND_SPACES = bytes(
    0x20 if b == 0x20 or 0x09 <= b <= 0x0D else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stages(df: DataFrame, label: str) -> TableStages:
    return TableStages(df.sparkSession, label)


def sampled(rows: DataFrame, key: str, limit: int) -> DataFrame:
    """At most ``limit`` rows, those with the smallest hash of ``key``; null keys are left out.

    A share that is expected to hold a little more than the limit is cut off by hash before
    sorting, so what is gathered does not grow with the table.
    """
    known = rows.where(F.col(key).isNotNull())
    share = min(1.0, (1.2 * limit + 100) / max(1, known.count()))
    place = F.pmod(F.xxhash64(key), F.lit(1 << 40))
    return known.where(place <= F.lit(int(share * (1 << 40)))).orderBy(place, key).limit(limit)


def row_key() -> Column:
    """doc_id, or for rows without one a number beyond 2**62 from the text's hash."""
    return F.coalesce(F.col("doc_id").cast("long"), F.pmod(F.xxhash64("text"), F.lit(1 << 61)) + F.lit(1 << 62))


def lowered(text: Column) -> Column:
    """A-Z to lower case and nothing else; null becomes empty."""
    return F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def space_words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text, in order; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "[ \\t-\\r]+"), lambda w: w != "")


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once a row, also where a lambda refers to it."""
    return F.transform(F.array(value), body)[0]


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` has it; letter case does not count."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def pinned(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with computed columns that later steps read instead of computing them again.

    The optimizer copies an ordinary expression into each filter above it; what a generator
    makes it does not copy.
    """
    name = fresh(df, "_pinned")
    one = F.explode(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))).alias(name)
    kept = [F.col(f"`{c}`") for c in df.columns if c not in columns]
    return df.select(*kept, one).select(*kept, *[F.col(f"{name}.{n}").alias(n) for n in columns])


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes; a longer text is a range of its own."""
    if not len(texts):
        return
    ends = text_offsets(texts)
    begin = 0
    while begin < len(texts):
        end = int(np.searchsorted(ends, ends[begin] + limit, side="right")) - 1
        end = min(len(texts), max(begin + 1, end))
        yield begin, end
        begin = end


def text_offsets(texts: pa.Array) -> np.ndarray:
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    return np.frombuffer(texts.buffers()[1], kind)[texts.offset: texts.offset + len(texts) + 1].astype(np.int64)


def text_bytes(texts: pa.Array) -> tuple[bytes, np.ndarray]:
    """All texts of an array as one byte string, and where each begins (and the last ends)."""
    ends = text_offsets(texts)
    data = texts.buffers()[2]
    return (data[int(ends[0]):int(ends[-1])].to_pybytes() if data is not None else b""), ends - ends[0]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit scrambler."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


_BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_RADIX = np.uint64(0xD6E8FEB86659FD93)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the lower-cased words ``[^\\x20\\x09-\\x0D]+`` of all texts, and where each text's words begin."""
    raw, ends = text_bytes(texts)
    data = np.frombuffer(raw.translate(_LOWER_AND_SPACES), np.uint8)
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    inside = data != 0x20
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    edges = ends[:-1][ends[:-1] < len(data)]
    opens[edges] = inside[edges]
    starts = np.flatnonzero(opens)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    letters = data[inside]
    first = (np.cumsum(inside) - 1)[starts]
    lengths = np.diff(np.append(first, len(letters)))
    place = np.arange(len(letters)) - np.repeat(first, lengths)
    powers = np.cumprod(np.full(int(lengths.max()) + 1, _RADIX))
    words = np.add.reduceat(_BYTE_CODES[letters] * powers[place], first)
    words = mix(words + lengths.astype(np.uint64) * _RADIX)
    return words, np.searchsorted(starts, ends)
