"""How the sources of a language differ in their words: count-cell ranking.

Words are counted per (language, source) inside the tasks before anything is shuffled. All terms of a source with
the same count there and the same count in the language have the same difference, so they are one cell: the
difference is worked out per cell, equal values are merged, cells are ranked by how many terms stand before them, and
only the cells that reach the wanted ranks are expanded into terms, in UTF-8 order.

Pairs of sources are compared in blocks: a task holds the counts of at most two blocks of sources over one bucket of
terms and gives the sums of its differences.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wxrisk.llm import common

# Least documents of a kept term, what is added to each count, ranks of terms.
LEAST_DOCS = 30
ADDED = 5
TERM_RANKS = 50
#: Sources in a block and terms in a bucket of the pair comparison, on average.
BLOCK_SOURCES = 64
BUCKET_TERMS = 4096
#: Entries of a task's counts; beyond it they are sent on and the task starts anew.
MOST_HELD = 400_000

_WORD_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
_COUNTED = "lang string, source string, term string, n long, docs long"


def counted(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents, in parts that are still to be added up.

    Each source that occurs also has the empty term, which no text holds, with counts of 0.
    """
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def sent() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, docs_with) in seen.items():
                n[b""], docs_with[b""] = 0, 0
                size = len(n)
                yield pa.RecordBatch.from_arrays([
                    pa.array([lang] * size), pa.array([source] * size), pa.array(list(n), pa.binary()).cast(pa.string()),
                    pa.array(list(n.values()), pa.int64()), pa.array([docs_with[t] for t in n], pa.int64()),
                ], ["lang", "source", "term", "n", "docs"])
            seen.clear()

        for batch in batches:
            for begin, end in common.chunks(batch.column(2)):
                part = batch.slice(begin, end - begin)
                raw, ends = common.text_bytes(part.column(2))
                raw = raw.translate(_WORD_BYTES)
                for lang, source, a, b in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), ends[:-1].tolist(), ends[1:].tolist(), strict=True):
                    own = seen.setdefault((lang, source), (Counter(), Counter()))
                    words = raw[a:b].split()
                    own[0].update(words)
                    own[1].update(set(words))
                if sum(len(n) + 1 for n, _ in seen.values()) > MOST_HELD:
                    yield from sent()
        yield from sent()

    plain = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    return plain.mapInArrow(rows, _COUNTED)


def kept_terms(docs: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """(lang, source, term, n, lang_n) of terms in at least ``least_docs`` documents of the language; the empty term stays.

    Partitioned once, by language and term; sums per source and per language need no other shuffle.
    """
    per_source = counted(docs).repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    of_term = Window.partitionBy("lang", "term")
    told = per_source.select("lang", "source", "term", "n", F.sum("n").over(of_term).alias("lang_n"), F.sum("docs").over(of_term).alias("lang_docs"))
    return told.where((F.col("lang_docs") >= least_docs) | (F.col("term") == "")).drop("lang_docs")


def share(count: Column, whole: Column) -> Column:
    """1 + floor(1000000000 * count / whole), in steps of 1,000 so that no product leaves 64 bits; count is at most whole."""
    made, rest = F.lit(0).cast("long"), count
    for _ in range(3):
        rest = rest * 1000
        made = made * 1000 + F.call_function("div", rest, whole)
        rest = rest % whole
    return made + 1


def share_of(count: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """``share`` of arrays."""
    made, rest = np.zeros_like(count), count
    for _ in range(3):
        rest = rest * 1000
        made = made * 1000 + rest // whole
        rest = rest % whole
    return made + 1


def _languages(kept: DataFrame) -> DataFrame:
    """(lang, terms, lang_total) of the kept terms; a language without any has zeros."""
    per_term = kept.groupBy("lang", "term").agg(F.max("lang_n").alias("lang_n"))
    return per_term.groupBy("lang").agg(F.count(F.when(F.col("term") != "", 1)).alias("terms"), F.sum("lang_n").alias("lang_total"))


def _sources(kept: DataFrame) -> DataFrame:
    """(lang, source, total, place) of every source that occurs; ``place`` numbers the sources of a language from 0."""
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    return totals.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1)


def term_ranks(kept: DataFrame, languages: DataFrame, sources: DataFrame, ranks: int = TERM_RANKS) -> DataFrame:
    """(lang, source, item, value, rank) of the terms that a source uses more than its language, up to ``ranks``."""
    cells = kept.where("term <> '' and n > 0").groupBy("lang", "source", "n", "lang_n").agg(F.count("*").alias("held"))
    valued = (
        cells.join(sources, ["lang", "source"]).join(languages, "lang")
        .withColumn("p", share(F.col("n") + ADDED, F.col("total") + ADDED * F.col("terms")))
        .withColumn("q", share(F.col("lang_n") + ADDED, F.col("lang_total") + ADDED * F.col("terms")))
        .where("p > q").select("lang", "source", "n", "lang_n", "held", (F.col("p") - F.col("q")).alias("value"))
    )
    # Each value holds a term at least, so the best `ranks` values hold all that is wanted.
    of_source = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
    merged = valued.groupBy("lang", "source", "value").agg(F.sum("held").alias("held"))
    best = merged.withColumn("step", F.row_number().over(of_source)).where(F.col("step") <= ranks)
    before = F.sum("held").over(of_source.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("held")
    wanted = best.withColumn("before", before).where(F.col("before") < ranks).select("lang", "source", "value")
    chosen = valued.join(wanted, ["lang", "source", "value"]).select("lang", "source", "n", "lang_n", "value")
    expanded = kept.where("term <> '' and n > 0").join(chosen, ["lang", "source", "n", "lang_n"])
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "term")
    placed = expanded.select("lang", "source", F.col("term").alias("item"), "value", F.row_number().over(order).alias("rank"))
    return placed.where(F.col("rank") <= ranks)


def _block_sums(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    """Sums of differences of the pairs between two blocks of sources over one bucket, and how many terms they cover.

    The rows are those of one (language, block, block, bucket). Every source of the blocks has the empty term,
    which tells it is there and counts for nothing.
    """
    first, second = key[1].as_py(), key[2].as_py()
    terms = rows.column("term").combine_chunks().dictionary_encode()
    column, names = np.asarray(terms.indices), terms.dictionary.to_pylist()
    place, n, whole = (rows.column(c).to_numpy() for c in ("place", "n", "whole"))
    found, at = np.unique(place, return_inverse=True)
    wholes = np.zeros(len(found), np.int64)
    wholes[at] = np.maximum(whole, 1)
    counts = np.zeros((len(found), len(names)), np.int64)
    counts[at, column] = n
    p = share_of(counts + ADDED, wholes[:, None])
    p[:, names.index("")] = 0
    one, two = np.flatnonzero(found // BLOCK_SOURCES == first), np.flatnonzero(found // BLOCK_SOURCES == second)
    made = [np.zeros((0, 3), np.int64)]
    for a in one:
        others = two[two > a]
        made.append(np.stack([np.full(len(others), found[a]), found[others], np.abs(p[others] - p[a]).sum(axis=1)], axis=1))
    x, y, part = np.concatenate(made).T
    return pa.table({
        "lang": pa.array([key[0].as_py()] * len(x), pa.string()), "x": x, "y": y, "part": part, "covered": np.full(len(x), len(names) - 1)})


def pair_sums(kept: DataFrame, languages: DataFrame, sources: DataFrame) -> DataFrame:
    """(lang, source, item, value) of all pairs of sources of a language, the smaller name first.

    A source's terms go to each pairing of its block; terms that neither source of a pair holds are added as a product.
    """
    block = F.floor(F.col("place") / BLOCK_SOURCES)
    sized = sources.join(languages, "lang").select(
        "lang", "source", "place", "terms", F.greatest(F.col("total") + ADDED * F.col("terms"), F.lit(1)).alias("whole"),
        block.alias("own"), F.max(block).over(Window.partitionBy("lang")).alias("last"), (F.floor(F.col("terms") / BUCKET_TERMS) + 1).alias("buckets"))
    every = F.sequence(F.lit(0).cast("long"), F.col("buckets") - 1)
    bucket = F.when(F.col("term") == "", every).otherwise(F.array(F.pmod(F.xxhash64("term"), F.col("buckets"))))
    placed = (
        kept.select("lang", "source", "term", "n").join(sized, ["lang", "source"])
        .withColumn("bucket", F.explode(bucket)).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("last"))))
        .select("lang", F.least("own", "other").alias("first"), F.greatest("own", "other").alias("second"), "bucket", "term", F.col("place").cast("long").alias("place"), "n", "whole")
    )
    parts = placed.groupBy("lang", "first", "second", "bucket").applyInArrow(_block_sums, "lang string, x long, y long, part long, covered long")
    summed = parts.groupBy("lang", "x", "y").agg(F.sum("part").alias("part"), F.sum("covered").alias("covered"))
    one = sized.select("lang", "source", F.col("place").alias("x"), F.col("whole").alias("x_whole"), "terms")
    two = sized.select("lang", F.col("source").alias("item"), F.col("place").alias("y"), F.col("whole").alias("y_whole"))
    added = F.lit(ADDED).cast("long")
    neither = F.when(F.col("terms") == 0, 0).otherwise(F.abs(share(added, F.col("x_whole")) - share(added, F.col("y_whole"))))
    rest = (F.col("terms") - F.coalesce("covered", F.lit(0))) * neither
    pairs = one.join(two, "lang").where("x < y").join(summed, ["lang", "x", "y"], "left")
    return pairs.select("lang", "source", "item", (F.coalesce("part", F.lit(0)) + rest).cast("long").alias("value"))


def divergences(docs: DataFrame, least_docs: int = LEAST_DOCS, ranks: int = TERM_RANKS) -> DataFrame:
    """(lang, source, part, item, value, rank) of both parts.

    Null text, lang and source are read as ''. Sources without kept terms have pairs (0 without kept terms in the
    language) and no term rows. Repeated rows count as often as they stand; equal values are ranked by item in
    UTF-8 order; no rows give no rows. Other columns are not read. What is counted is staged in the shared folder.
    """
    stage = common.stages(docs, "source-audit")
    kept = stage(kept_terms(docs, least_docs), "kept")
    languages, sources = stage(_languages(kept), "languages"), stage(_sources(kept), "sources")
    terms = term_ranks(kept, languages, sources, ranks).withColumn("part", F.lit("term"))
    pairs = pair_sums(kept, languages, sources)
    both = F.explode(F.array(F.struct(F.col("source").alias("s"), F.col("item").alias("i")), F.struct(F.col("item").alias("s"), F.col("source").alias("i")))).alias("e")
    turned = pairs.select("lang", "value", both).select("lang", F.col("e.s").alias("source"), F.col("e.i").alias("item"), "value")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = turned.withColumn("rank", F.row_number().over(order)).withColumn("part", F.lit("pair"))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return ranked.select(columns).unionByName(terms.select(columns))
