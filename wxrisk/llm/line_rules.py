"""Quality rules, line first: failing lines go, then documents that lose too much.

Native: array functions inside each row, no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wxrisk.llm.common import fresh, let, pinned, space_words

SPACE = r"[ \t-\r]"
WORD_CHAR = r"[^ \t-\r]"
SYMBOLS = "#*$%&|<>"

# What a line may end with, and what marks navigation and boilerplate.
LINE_ENDS = ".!?:;,\"')]}…»”’"
NAVIGATION = r"(?i)^\s*(home|menu|login|log in|sign in|sign up|register|next|previous|back|search|share|print|skip to content)\b[^.!?]*$|(\s[|»›·>]\s.*){2,}"
BOILERPLATE = (
    r"(?i)\b(all rights reserved|privacy policy|terms of (use|service)|cookie (policy|settings)|we use cookies|enable javascript"
    r"|subscribe to our|click here|licensed under|is licensed|copyright \(c\)|lorem ipsum)\b"
)

#: A line fails with more symbols than this share of its words, or more exclamation marks.
SYMBOLS_PER_WORD = 0.3
SHOUTS_PER_WORD = 0.5
#: A document goes if more than this percentage of its word characters stood in failing lines.
MOST_LOST_PERCENT = 50
FEWEST_WORDS = 50
MOST_REPEATED_PERCENT = 50


def _word_chars(text: Column) -> Column:
    return F.char_length(F.regexp_replace(text, f"{SPACE}+", "")).cast("long")


def _symbols(text: Column) -> Column:
    return F.char_length(F.regexp_replace(text, f"[^{SYMBOLS}]+", "")).cast("long")


def line_reason(line: Column) -> Column:
    """Why a line fails: ``symbols``, ``shouting``, ``boilerplate``, ``navigation`` or ``punctuation``; null if it doesn't.

    A line without a word never fails. A line fails for punctuation if it has four words or more
    and no end mark; shorter ones pass, they may be headings.
    """
    words = F.size(F.split(F.trim(F.regexp_replace(line, f"{SPACE}+", " ")), " "))
    shouts = F.char_length(F.regexp_replace(line, "[^!]+", ""))
    # The plain searches come first, so most lines are never counted out.
    return (
        F.when(~line.rlike(WORD_CHAR), F.lit(None))
        .when(line.rlike(f"[{SYMBOLS}]") & (_symbols(line) > words * SYMBOLS_PER_WORD), "symbols")
        .when(line.contains("!") & (shouts > words * SHOUTS_PER_WORD), "shouting")
        .when(line.rlike(BOILERPLATE), "boilerplate")
        .when(line.rlike(NAVIGATION), "navigation")
        .when(~line.rlike(rf"[\Q{LINE_ENDS}\E]{SPACE}*\z") & (words >= 4), "punctuation")
    )


def _repeated_words(words: Column) -> Column:
    """Words that stand in a 3-word window found twice or more; windows are compared by 64-bit hash.

    Windows are sorted by (hash, place), so equal ones are neighbours; then the places of the
    repeated ones are merged in order.
    """
    def windows(w: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(w) - 3),
            lambda i: F.struct(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("at")),
        )

    def repeated(s: Column) -> Column:
        return F.sort_array(F.transform(
            F.filter(s, lambda x, k: (F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"])), lambda x: x["at"]))

    def covered(p: Column) -> Column:
        steps = F.transform(p, lambda at, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - at, F.lit(3))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda total, step: total + step)

    return let(words, lambda w: F.when(F.size(w) < 4, F.lit(0).cast("long")).otherwise(
        let(F.sort_array(windows(w)), lambda s: let(repeated(s), covered))))


def judged(docs: DataFrame, text: str = "text", counts: bool = True) -> DataFrame:
    """``docs`` with a struct column ``rules``: the counts, the failing lines, the cleaned text and the verdict.

    rules.n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words; rules.reasons (one per failing
    line, in order); rules.lost_chars; rules.clean_text (the passing lines); rules.base_failed; rules.kept.
    Without ``counts`` there are no n_symbols, n_dup_lines and reasons, which no verdict needs.
    Null texts count as empty and are not kept. Rows are judged alone, so ties, copies and other
    columns don't matter; an existing column ``rules`` is replaced.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.transform(F.split(body, "\n", -1), lambda x: F.struct(x.alias("line"), line_reason(x).alias("reason")))

    def more(v: Column) -> list[Column]:
        return [
            _symbols(body).alias("n_symbols"),
            let(F.filter(F.split(body, "\n", -1), lambda x: x.rlike(WORD_CHAR)),
                lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")).alias("n_dup_lines"),
            F.transform(F.filter(v["lines"], lambda x: x["reason"].isNotNull()), lambda x: x["reason"]).alias("reasons"),
        ] if counts else []

    rules = let(F.struct(lines.alias("lines"), space_words(body).alias("words")), lambda v: F.struct(
        F.size(v["words"]).cast("long").alias("n_words"),
        _word_chars(body).alias("word_chars"),
        _repeated_words(v["words"]).alias("n_repeat_words"),
        F.aggregate(F.filter(v["lines"], lambda x: x["reason"].isNotNull()), F.lit(0).cast("long"),
                    lambda total, x: total + _word_chars(x["line"])).alias("lost_chars"),
        F.array_join(F.transform(F.filter(v["lines"], lambda x: x["reason"].isNull()), lambda x: x["line"]), "\n").alias("clean_text"),
        *more(v),
    ))
    failed = (F.col("rules.n_words") < FEWEST_WORDS) | (F.col("rules.n_repeat_words") * 100 > F.col("rules.n_words") * MOST_REPEATED_PERCENT)
    fits = F.col("rules.lost_chars") * 100 <= F.col("rules.word_chars") * MOST_LOST_PERCENT
    return pinned(docs, rules=rules).withColumn(
        "rules", F.col("rules").withField("base_failed", failed).withField("kept", ~failed & fits))


def rule_verdicts(docs: DataFrame) -> DataFrame:
    """doc_id, the base counts, base_failed, kept, and lost_chars per row of ``docs``."""
    return judged(docs.select("doc_id", "text")).select(
        "doc_id", *[F.col(f"rules.{c}").alias(c) for c in (
            "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "lost_chars")])


def keep_clean(docs: DataFrame) -> DataFrame:
    """The documents that the rules keep, without their failing lines; columns as in ``docs``.

    Null and empty texts go. A column ``rules`` of ``docs`` and columns with names of helpers keep their values.
    """
    own = {c: fresh(docs, "_own_rules") for c in docs.columns if c.lower() == "rules"}
    kept = judged(docs.withColumnsRenamed(own), counts=False).where("rules.kept").withColumn("text", F.col("rules.clean_text"))
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return kept.select(*[F.col(f"`{own.get(c, c)}`").alias(c) for c in docs.columns])
