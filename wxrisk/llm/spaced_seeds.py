"""Benchmark decontamination by spaced-seed hashes and substitution-tolerant overlaps.

Native. Masks fix which words of a window are hashed; the others may differ. What is broadcast are rows of
(seed, item number, place) in blocks of BLOCK_SEEDS rows, whatever the length of the items; documents are streamed
past them and a hit is shuffled as (document, item, shift, place) alone. Words are fetched by a join for the few
documents and items that have a hit, and only as far as the item reaches.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wxrisk.llm.common import fresh, let, lowered, pinned, row_key, stages

# Masks of one span, 1 for a word that counts. Any two substitutions in 12 words or more leave a seed.
MASKS = ("111010011", "110110101", "101101011", "110011011")
SPAN = len(MASKS[0])
#: Items of at least this many words are sought by MASKS, shorter ones by masks of their own.
LEAST_MASKED = 12
#: Rows of (seed, item, place) that one broadcast holds: about 16 MB.
BLOCK_SEEDS = 500_000
#: An overlap counts if this percentage of the item's words agrees in place, or of a window of RUN words around a hit.
LEAST_PERCENT = 80
RUN = 13
#: An overlap with an item of fewer words is told by ``leaks`` but is no ground to leave a document out.
FEWEST_WORDS = 5


def masks_for(words: int) -> tuple[str, ...]:
    """The masks that an item of so many words is sought by.

    Up to four words it must stand as it is. Up to nine words one may differ: there is a mask for each word left
    out. With ten or eleven words two may differ: one of three pieces is whole.
    """
    if words >= LEAST_MASKED:
        return MASKS
    if words < 5:
        return ("1" * words,)
    if words < 10:
        return tuple("1" * k + "0" + "1" * (words - 1 - k) for k in range(words))
    cuts = (0, 3, 6, words)
    return tuple("0" * a + "1" * (b - a) + "0" * (words - b) for a, b in zip(cuts[:-1], cuts[1:], strict=True))


def words_of(text: Column) -> Column:
    """Lower-cased words of letters, digits and non-ASCII characters."""
    return F.filter(F.split(lowered(text), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), lambda w: w != "")


def _windows(hashes: Column, masks: list[str], spare: int = 0) -> Column:
    """(at, seed) of all windows of all masks, from the word hashes; masks are told apart by their own text.

    Windows of the masks of short items may begin ``spare`` words before the text and end so many after it, so that
    an item is found that a document cuts off; what is not there is left out of the hash.
    """
    def of(mask: str) -> Column:
        used = [k for k, flag in enumerate(mask) if flag == "1"]
        over = 0 if mask in MASKS else spare
        last = F.size(hashes) - len(mask)
        made = F.transform(F.sequence(F.lit(-over), F.greatest(last + over, F.lit(-over))),
                           lambda i: F.struct(i.alias("at"), F.xxhash64(F.lit(mask), *[F.get(hashes, i + k) for k in used]).alias("seed")))
        return F.when(last + over >= -over, made).otherwise(F.slice(made, 1, 0))

    return F.concat(*[of(mask) for mask in masks])


def _seeded(rows: DataFrame, masks: list[str], *keep: str, spare: int = 0) -> DataFrame:
    """``keep`` columns, ``at`` and ``seed``, a row per window and mask; the words stay behind."""
    hashes = F.transform("words", lambda w: F.xxhash64(w))
    made = pinned(rows.select(*keep, "words"), _made=let(hashes, lambda h: _windows(h, masks, spare)))
    return made.select(*keep, F.explode("_made").alias("_w")).select(*keep, F.col("_w.at").alias("at"), F.col("_w.seed").alias("seed"))


def _alignments(texts: DataFrame, items: DataFrame, stage) -> DataFrame:
    """(doc, item, n, shift, begins): where an item of n words may stand in a document, and the begins of the runs around its hits."""
    sizes = items.agg(F.collect_set(F.least(F.size("words"), F.lit(LEAST_MASKED))).alias("n")).first()["n"]  # a dozen numbers at most
    parts = [_seeded(items.where(F.size("words") >= n if n == LEAST_MASKED else F.size("words") == n), list(masks_for(n)), "item", "n") for n in sorted(sizes)]
    if not parts:
        return None
    used = [mask for n in sorted(sizes) for mask in masks_for(n)]
    seeds = stage(reduce(DataFrame.unionByName, parts).select("item", "n", F.col("at").alias("item_at"), "seed"), "seeds")
    blocks = max(1, math.ceil(seeds.count() / BLOCK_SEEDS))
    hits = reduce(DataFrame.unionByName, [
        _seeded(texts, used, "doc", spare=2).join(F.broadcast(seeds.where(F.pmod(F.xxhash64("item", "item_at"), F.lit(blocks)) == b)), "seed") for b in range(blocks)])
    begin = F.greatest(F.lit(0), F.least(F.col("item_at") - (RUN - SPAN) // 2, F.col("n") - RUN))
    return stage(hits.groupBy("doc", "item", "n", (F.col("at") - F.col("item_at")).alias("shift")).agg(F.collect_set(begin).alias("begins")), "alignments")


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, item_words, matched, run_matched, starts_at) for each document that holds a benchmark passage.

    One row per document and item, with the overlap that agrees most: matched words of the whole
    item, of the RUN words around a hit, and the word at which the item begins in the document
    (negative if its beginning is cut off). Items of one to four words must stand as they are, longer ones are found
    with the substitutions that LEAST_PERCENT allows (``masks_for``). Documents and items without words match nothing;
    rows with a null doc_id or item_id are kept under null. Repeated rows count once. Other columns are not read.
    Hits are staged in the shared folder.
    """
    stage = stages(docs, "leaks")
    known = benchmark.select("item_id", words_of(F.col("text")).alias("words")).where(F.size("words") > 0).distinct()
    known = stage(known.select("item_id", "words", F.size("words").alias("n"), F.xxhash64("item_id", "words").alias("item")), "items")
    plain = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("doc"))
    texts = pinned(plain.select("doc", "text"), words=words_of(F.col("text")))
    found = _alignments(texts, known, stage)
    if found is None:
        return plain.where("false").select("doc_id", F.lit(None).cast(benchmark.schema["item_id"].dataType).alias("item_id"), *[F.lit(0).cast("long").alias(c) for c in ("item_words", "matched", "run_matched", "starts_at")])
    shift, n = F.col("shift"), F.col("n")
    # Documents that have a hit are few, so the optimizer may filter the others out before they are sent.
    placed = plain.join(found.select("doc").distinct(), "doc", "left_semi").dropDuplicates(["doc"])
    words = pinned(placed.select("doc", "doc_id", "text"), words=words_of(F.col("text"))).select("doc", "doc_id", "words")
    reached = found.join(words, "doc").select(
        "doc_id", "item", "shift", "begins", F.slice("words", F.greatest(shift, F.lit(0)) + 1, F.greatest(n + F.least(shift, F.lit(0)), F.lit(0))).alias("part"))
    met = reached.join(known, "item")
    skipped = F.greatest(-shift, F.lit(0))
    same = F.transform("words", lambda w, j: F.coalesce(F.get(F.col("part"), j - skipped) == w, F.lit(False)))
    agreed = pinned(met.select("doc_id", "item_id", "shift", "begins", "n", "words", "part"), agree=same)
    run = F.least(n, F.lit(RUN))
    checked = agreed.select(
        "doc_id", "item_id", n.cast("long").alias("item_words"), shift.cast("long").alias("starts_at"), run.alias("run"),
        F.size(F.filter("agree", lambda x: x)).cast("long").alias("matched"),
        F.array_max(F.transform("begins", lambda b: F.size(F.filter(F.slice(F.col("agree"), b + 1, run), lambda x: x)))).cast("long").alias("run_matched"))
    good = (F.col("matched") * 100 >= F.col("item_words") * LEAST_PERCENT) | (F.col("run_matched") * 100 >= F.col("run") * LEAST_PERCENT)
    best = checked.where(good).groupBy("doc_id", "item_id").agg(F.max(F.struct("matched", "run_matched", "item_words", "starts_at")).alias("best"))
    return best.select("doc_id", "item_id", *[F.col(f"best.{c}").alias(c) for c in ("item_words", "matched", "run_matched", "starts_at")])


def without_leaks(docs: DataFrame, benchmark: DataFrame, fewest_words: int = FEWEST_WORDS) -> DataFrame:
    """The documents that hold no passage of an item of at least ``fewest_words`` words; columns and rows as in ``docs``.

    A document is known by doc_id or, without one, by its text; null and empty texts stay. Columns may have any names.
    """
    key = fresh(docs, "_key")
    keyed = docs.withColumn(key, row_key())
    found = leaks(keyed.select(F.col(key).alias("doc_id"), "text"), benchmark).where(F.col("item_words") >= fewest_words)
    return keyed.join(found.select(F.col("doc_id").alias(key)).distinct(), key, "left_anti").select(*[f"`{c}`" for c in docs.columns])
