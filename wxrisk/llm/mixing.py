"""Mixing sources to target weights by repetition rates and hash-seeded draws."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wxrisk.llm.common import fresh, space_words

# Weights of the sources in code point order, repeating; the mix's size and the most a source may be repeated.
WEIGHTS = (5, 2, 1)
TOTAL_PERCENT = 150
MOST_REPEATS = 2
#: Sources up to this number are broadcast to the documents; more are joined by shuffle.
BROADCAST_SOURCES = 50_000


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, percent: int = TOTAL_PERCENT,
                   most: int = MOST_REPEATS) -> DataFrame:
    """(source, source_size, weight, target) from (source, size) rows.

    Targets fill up by weight: sources in the order of ``most * size / weight`` stop at their
    limit, the rest share what is left. Sums are whole numbers until the last division. The
    windows run over one row per source. With all sizes 0 all targets are 0.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int")).cast("long")
    limits = totals.withColumn("weight", weight).withColumn("ratio", F.col("source_size") / F.col("weight"))
    order = Window.orderBy("ratio", F.col("source").isNull(), "source")
    everything = Window.partitionBy()
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = F.sum("source_size").over(everything)
    left = whole * percent - F.coalesce(F.sum("source_size").over(before), F.lit(0)) * (100 * most)
    levelled = limits.withColumn("left", left).withColumn("rest", F.sum("weight").over(after) * 100)
    open_ = F.col("left") <= F.col("source_size") * F.lit(100 * most) * F.col("rest") / (F.col("weight") * 100)
    first = F.first(F.when(open_, F.struct("left", "rest")), ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return levelled.withColumn("level", first).select(
        "source", "source_size", "weight",
        F.when(F.col("level").isNull(), (F.col("source_size") * most).cast("double"))
        .otherwise((F.col("level.left") * F.col("weight")).cast("double") / F.col("level.rest")).alias("target"))


def _draw(seed: int, *columns: str) -> Column:
    """A number in [0, 1) that depends on the row's values alone: 52 bits of an MD5 sum."""
    digits = F.md5(F.concat_ws("|", F.lit(str(seed)), *columns).cast("binary"))
    return F.conv(F.substring(digits, 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def mixed(docs: DataFrame, seed: int = 20, **targets) -> DataFrame:
    """``docs`` with size, source_size, target, rate, copies and taken.

    size counts the words ``[^\\x20\\x09-\\x0D]+`` (0 for null). A document's rate is target over
    size of its source; it is taken floor(rate) times and once more if its draw, a hash of seed,
    doc_id and text, lies below the rest. Reruns and lost tasks draw alike; rows equal in doc_id
    and text draw alike too. A null source is a source of its own. In a source without words
    nothing is taken. Columns of ``docs`` with these names are replaced.
    """
    own = ("size", "source_size", "target", "rate", "copies", "taken")
    kept = docs.select(*[c for c in docs.columns if c not in own])
    sized = kept.withColumn("size", F.size(space_words(F.col("text"))).cast("long"))
    other = fresh(docs, "_source")
    goals = source_targets(sized.select("source", "size"), **targets).withColumnRenamed("source", other)
    goals = goals.select(other, "source_size", "target")
    if docs.select("source").distinct().limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES:
        goals = F.broadcast(goals)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    more = (_draw(seed, "doc_id", "text") < F.col("rate") - F.floor("rate")).cast("long")
    return (
        sized.join(goals, F.col("source").eqNullSafe(F.col(other))).drop(other)
        .withColumn("rate", rate).withColumn("copies", F.floor("rate") + more)
        .withColumn("taken", F.col("copies") * F.col("size"))
    )


def emitted(docs: DataFrame, seed: int = 20, **targets) -> DataFrame:
    """The mix itself: each document as many times as it is taken, with ``copy`` from 1.

    Columns of ``docs`` keep their values also where they have names of ``mixed``; only a column ``copy`` is
    replaced. Null and empty texts have no words and are taken by their source's rate like others.
    """
    own = {c: fresh(docs, f"_kept_{c}") for c in docs.columns if c.lower() in ("size", "source_size", "target", "rate", "copies", "taken")}
    rows = mixed(docs.withColumnsRenamed(own), seed, **targets).where("copies > 0")
    copy = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")
    return rows.select(*[F.col(f"`{own.get(c, c)}`").alias(c) for c in docs.columns if c.lower() != "copy"], copy)
