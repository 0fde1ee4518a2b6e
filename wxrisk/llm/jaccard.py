"""Near duplicates: exact Jaccard join over word shingles with rare-first prefixes.

1. Every shingle's document count is taken over all documents: tasks send sorted 32-bit keys
   in packed blocks, one per range of the hash space. The counts are kept in two arrays of
   fixed size: a bit for "in two documents or more" and a level (log2 of the count). A shared
   cell can only make a shingle look more frequent, so the order it gives is the same for every
   document and nothing is missed.
2. A document sorts its shingles rare first. Whatever it shares lies in repeated shingles, so
   a document with too few of them has no partner and sends nothing on.
3. Documents with equal sets become one class. Classes meet on their prefix shingles in two
   rounds. In the first each class is held against one pivot per shingle and length band, and
   the verified links are joined to components. In the second, classes of one shingle that are
   still in different components are paired. A group of thousands of near copies is thus a
   star, not all its pairs, and every link between components is still found.
4. Pairs must pass the length, positional and suffix filters, and are verified once.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wxrisk.llm import common
from wxrisk.llm.components import components

#: Bits of the "repeated" array at most (32 MB); the level array has a 64th as many bytes.
SKETCH_BITS = 28
#: Text bytes whose shingles one counting group holds.
GROUP_BYTES = 8 << 20
#: 64-bit words of the suffix filter's signature: the parities of that many times 64 parts of the hash space.
SIGNATURE_WORDS = 8

_WEIGHTS = common.mix(np.arange(101, 165, dtype=np.uint64))


def shingle_sets(texts: pa.Array, width: int) -> Iterator[np.ndarray]:
    """Each text's distinct shingles as sorted hashes; a shorter text is one shingle, an empty one none."""
    words, starts = common.word_hashes(texts)
    if len(words) >= width:
        rolled = np.zeros(len(words) - width + 1, np.uint64)
        for k in range(width):
            rolled += words[k:len(words) - width + 1 + k] * _WEIGHTS[k]
        rolled = common.mix(rolled)
    for begin, end in zip(starts[:-1], starts[1:], strict=True):
        if end - begin >= width:
            yield np.unique(rolled[begin:end - width + 1])
        elif end > begin:
            parts = words[begin:end] * _WEIGHTS[:end - begin]
            yield common.mix(np.array([parts.sum() + np.uint64(end - begin)], np.uint64))
        else:
            yield np.zeros(0, np.uint64)


def _counted(docs: DataFrame, width: int, groups: int) -> DataFrame:
    """(part, once, more): sorted keys of a chunk's shingles in one part of the hash space."""
    def blocks(batches):
        for batch in batches:
            texts = batch.column(0)
            for a, b in common.chunks(texts):
                keys, counts = np.unique(np.concatenate(list(shingle_sets(texts[a:b], width))), return_counts=True)
                if not len(keys):
                    continue
                part = (keys >> np.uint64(64 - groups)).astype(np.int64)
                short = ((keys << np.uint64(groups)) >> np.uint64(32)).astype(np.uint32)
                cuts = np.searchsorted(part, np.arange((1 << groups) + 1))
                rows = [(p, short[i:j], counts[i:j]) for p, (i, j) in enumerate(zip(cuts, cuts[1:], strict=False)) if j > i]
                yield pa.RecordBatch.from_arrays([
                    pa.array([p for p, _, _ in rows], pa.int32()),
                    pa.array([k[n == 1].tobytes() for _, k, n in rows], pa.binary()),
                    pa.array([k[n > 1].tobytes() + n[n > 1].astype(np.uint32).tobytes() for _, k, n in rows], pa.binary()),
                ], ["part", "once", "more"])

    return docs.select("text").mapInArrow(blocks, "part int, once binary, more binary")


def _sketch(docs: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray, int, int]:
    """(repeated bits, levels, their sizes as powers of two) from the counts of all documents."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 1
    groups = max(8, math.ceil(math.log2(size / GROUP_BYTES + 1)))
    bits = max(groups + 8, min(SKETCH_BITS, math.ceil(math.log2(2 * size + 1))))
    cells = bits - 6

    def count(frame: pd.DataFrame) -> pd.DataFrame:
        once = [np.frombuffer(x, np.uint32) for x in frame["once"]]
        more = [np.frombuffer(x, np.uint32).reshape(2, -1) for x in frame["more"]]
        keys = np.concatenate([*once, *(x[0] for x in more)])
        seen = np.concatenate([np.ones(sum(map(len, once)), np.int64), *(x[1].astype(np.int64) for x in more)])
        order = np.argsort(keys, kind="stable")
        keys, seen = keys[order], seen[order]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        keys, seen = keys[first].astype(np.int64), np.add.reduceat(seen, first)
        keys, seen = keys[seen > 1], seen[seen > 1]
        flags, levels = np.zeros(1 << (bits - groups), bool), np.zeros(1 << (cells - groups), np.uint8)
        flags[keys >> (32 - bits + groups)] = True
        np.maximum.at(levels, keys >> (32 - cells + groups), np.log2(seen).astype(np.uint8))
        return pd.DataFrame({"part": [int(frame["part"].iloc[0])], "flags": [np.packbits(flags).tobytes()], "levels": [levels.tobytes()]})

    parts = _counted(docs, width, groups).groupBy("part").applyInPandas(count, "part int, flags binary, levels binary")
    repeated, levels = np.zeros(1 << (bits - 3), np.uint8), np.zeros(1 << cells, np.uint8)
    for row in parts.toLocalIterator():
        for whole, block in ((repeated, row["flags"]), (levels, row["levels"])):
            whole[row["part"] * len(block):(row["part"] + 1) * len(block)] = np.frombuffer(block, np.uint8)
    return repeated, levels, bits, cells


def _needed(n: int, percent: int) -> int:
    return -(-n * percent // 100)


def _ordered_sets(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """(doc_id, n, node, rare, grams): grams, rare first, only where a partner is possible."""
    repeated, levels, bits, cells = _sketch(docs, width)
    shared = docs.sparkSession.sparkContext.broadcast((repeated, levels))

    def rows(batches):
        flags, ranks = shared.value
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for a, b in common.chunks(texts):
                out: list[tuple] = []
                for grams in shingle_sets(texts[a:b], width):
                    at = (grams >> np.uint64(64 - bits)).astype(np.int64)
                    often = (flags[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1
                    rare, n = int(len(grams) - often.sum()), len(grams)
                    node = hashlib.md5(grams.tobytes()).digest() if n else None
                    if n and n - rare >= _needed(n, percent):
                        rank = np.where(often == 1, ranks[(grams >> np.uint64(64 - cells)).astype(np.int64)] + 1, 0)
                        out.append((n, node, rare, grams[np.argsort(rank, kind="stable")].tobytes()))
                    else:
                        out.append((n, node, rare, None))
                yield pa.RecordBatch.from_arrays(
                    [ids[a:b].cast(pa.int64()), *(pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.binary(), pa.int64(), pa.binary()), strict=True))],
                    ["doc_id", "n", "node", "rare", "grams"],
                )

    return docs.select("doc_id", "text").mapInArrow(rows, "doc_id long, n long, node binary, rare long, grams binary")


def _prefixes(classes: DataFrame, percent: int) -> DataFrame:
    """(gram, node, n, pos, rare, s0 ... s7): the repeated shingles of each prefix, and the set's signature."""
    signed = [f"s{k}" for k in range(SIGNATURE_WORDS)]

    def rows(batches):
        for batch in batches:
            out = []
            for node, n, rare, raw in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                grams = np.frombuffer(raw, np.uint64)
                prefix = n - _needed(n, percent) + 1
                size = 64 * SIGNATURE_WORDS
                odd = np.bincount(((grams >> np.uint64(20)) % np.uint64(size)).astype(np.int64), minlength=size) & 1
                signature = np.packbits(odd.astype(bool)).view(np.int64).tolist()
                out += [(g, node, n, rare + k, rare, *signature) for k, g in enumerate(grams[rare:prefix].view(np.int64).tolist())]
            kinds = (pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), *[pa.int64()] * SIGNATURE_WORDS)
            columns = zip(*out, strict=True) if out else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                                             ["gram", "node", "n", "pos", "rare", *signed])

    return classes.select("node", "n", "rare", "grams").mapInArrow(
        rows, "gram long, node binary, n long, pos long, rare long, " + ", ".join(f"{c} long" for c in signed)
    )


def _may_link(percent: int) -> Column:
    """Length and positional filters for the sides x and y of one shared shingle."""
    least, most = F.least("nx", "ny"), F.greatest("nx", "ny")
    wanted = F.ceil(F.lit(percent) * (F.col("nx") + F.col("ny")) / F.lit(100 + percent) - F.lit(1e-9))
    rest = F.least(F.col("nx") - F.col("px"), F.col("ny") - F.col("py"))
    # the smaller pos of two equally ordered sets bounds what may come before the shared shingle
    return (least * 100 >= most * percent) & (F.least("px", "py") + rest >= wanted)


def _suffix_filter(percent: int) -> Column:
    """The parities that differ are no more than the shingles that only one of two linked sets can have."""
    apart = sum((F.bit_count(F.col("qx")[f"s{k}"].bitwiseXOR(F.col("qy")[f"s{k}"])) for k in range(SIGNATURE_WORDS)), F.lit(0))
    return apart * (100 + percent) <= (F.col("nx") + F.col("ny")) * (100 - percent)


def _signature(column: str = "") -> Column:
    return F.struct(*[F.col(f"{column}s{k}").alias(f"s{k}") for k in range(SIGNATURE_WORDS)])


def _side(tokens: DataFrame, s: str, *more: str) -> DataFrame:
    return tokens.select("gram", F.col("node").alias(s), F.col("n").alias(f"n{s}"), F.col("pos").alias(f"p{s}"), _signature().alias(f"q{s}"), *more)


def _distinct_pairs(pairs: DataFrame, percent: int) -> DataFrame:
    kept = pairs.where((F.col("x") != F.col("y")) & _may_link(percent) & _suffix_filter(percent))
    return kept.select("x", "y").distinct()


def _verified(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sets really are that similar; each is held against its partner once."""
    sets = classes.select("node", "grams")
    wide = pairs.join(sets.select(F.col("node").alias("y"), F.col("grams").alias("gy")), "y").join(
        sets.select(F.col("node").alias("x"), F.col("grams").alias("gx")), "x")

    def check(batches):
        for batch in batches:
            keep = []
            for gx, gy in zip(batch.column(2), batch.column(3), strict=True):
                a, b = np.frombuffer(gx.as_buffer(), np.uint64), np.frombuffer(gy.as_buffer(), np.uint64)
                both = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(100 * both >= percent * (len(a) + len(b) - both))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return wide.select("x", "y", "gx", "gy").mapInArrow(check, "x binary, y binary")


def near_duplicate_components(docs: DataFrame, width: int = 4, percent: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs`` (doc_id, text; other columns are ignored).

    A document's set holds the distinct ``width``-word shingles of its lower-cased (A-Z) words;
    a shorter text is one shingle. Two documents link when 100 * intersection >= percent * union;
    component_id is the smallest doc_id reachable by links. Null and empty texts have no shingle
    and are a component of their own. A row without doc_id takes part, but names no component
    unless it is alone, in which case component_id is null. Repeated rows share a component.
    """
    stage = common.stages(docs, "jaccard")
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = stage(_ordered_sets(plain, width, percent), "sets")
    classes = stage(
        rows.where("grams is not null").groupBy("node").agg(F.first("n").alias("n"), F.first("rare").alias("rare"), F.first("grams").alias("grams")),
        "classes",
    )
    tokens = stage(_prefixes(classes, percent).withColumn(
        "band", F.floor(F.log(F.col("n").cast("double")) / F.lit(math.log(100 / percent))).cast("int")), "prefixes")

    pivots = tokens.groupBy("gram", "band").agg(F.min(F.struct("rare", "node", "n", "pos", *[f"s{k}" for k in range(SIGNATURE_WORDS)])).alias("p"))
    near = pivots.select("gram", F.explode(F.array(F.col("band") - 1, "band", F.col("band") + 1)).alias("band"),
                         F.col("p.node").alias("x"), F.col("p.n").alias("nx"), F.col("p.pos").alias("px"), _signature("p.").alias("qx"))
    stars = _distinct_pairs(_side(tokens, "y", "band").join(near, ["gram", "band"]), percent)
    links = stage(_verified(stars, classes, percent), "starlinks")
    first = stage(components(links, stage), "first")

    labelled = tokens.join(first, "node", "left").withColumn("label", F.coalesce("label", "node"))
    labelled = stage(labelled, "labelled")
    mixed = labelled.groupBy("gram").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("gram")
    left = labelled.join(mixed, "gram", "left_semi")
    crossing = _side(left, "x", F.col("label").alias("lx")).join(_side(left, "y", F.col("label").alias("ly")), "gram").where("lx < ly")
    more = _verified(_distinct_pairs(crossing, percent), classes, percent)
    names = first.select("node", "label")
    bridged = (
        more.join(names.toDF("x", "lx"), "x", "left").join(names.toDF("y", "ly"), "y", "left")
        .select(F.coalesce("lx", "x").alias("x"), F.coalesce("ly", "y").alias("y"))
    )
    second = components(bridged, stage).toDF("label", "top")
    tops = names.unionByName(second.join(names, "label", "left_anti").select(F.col("label").alias("node"), "label"))
    tops = tops.join(second, "label", "left").select("node", F.coalesce("top", "label").alias("top"))

    known = rows.where("n > 0").select("doc_id", "n", "node").join(tops, "node", "left").withColumn("top", F.coalesce("top", "node"))
    known = stage(known.select("doc_id", "n", "top"), "known")
    smallest = known.groupBy("top").agg(F.min("doc_id").alias("component_id"))
    linked = known.join(smallest, "top").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return linked.unionByName(rows.where("n = 0").select("doc_id", F.lit(0).cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def one_of_each_group(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row per group of near duplicates: that with the smallest doc_id.

    Rows without doc_id come last in a group and are told apart by their text; repeated rows
    become one. doc_id is taken to be unique: rows of one doc_id with different texts stay. Columns may have any names.
    """
    key = common.fresh(docs, "_key")
    keyed = docs.withColumn(key, common.row_key())
    groups = near_duplicate_components(keyed.select(F.col(key).alias("doc_id"), "text"), width, percent)
    kept = groups.where("doc_id = component_id").select(F.col("doc_id").alias(key)).distinct()
    return keyed.join(kept, key, "left_semi").dropDuplicates([key, "text"]).select(*[f"`{c}`" for c in docs.columns])
