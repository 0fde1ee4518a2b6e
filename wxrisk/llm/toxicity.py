"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

The labelled rows are a bounded sample (SAMPLE_ROWS by hash of doc_id). All of them are examples, with all of
their words; how often a word occurs is counted over all documents. A term that goes with the label weighs more
in the cosine, by the root of its log-likelihood ratio. The index keeps, for each column and block of examples,
the largest weight; a query reads the blocks whose bound can reach its k-th cosine and skips the others. The index is
bounded, so each task has it and documents are scored where they are read.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from functools import cached_property

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wxrisk.llm import common

#: Labelled rows that are read at most; those with the smallest hash of doc_id.
SAMPLE_ROWS = 4_096
#: Terms that go with the label, at most. Words have no limit but the sample's vocabulary.
MOST_TERMS = 5_000
NEIGHBOURS = 15
BLOCK = 8
#: Columns that stand in the most examples are kept as rows of a matrix; and texts that are compared at once.
DENSE = 512
AT_ONCE = 32
#: Blocks that a text reads at most before its k-th cosine is set anew: few at first, then all that may still reach it.
ROUNDS = (4,)
#: More than twice what single precision can change in a cosine.
SLACK = 1e-4
#: Letters of the word beginnings that are terms beside the words.
STEMS = (4, 5, 6, 7)
#: Weight of the base rate in a vote, in units of one perfect neighbour.
PRIOR = 0.5
THRESHOLD = 0.3

# Marks beyond ASCII that part words; other characters beyond ASCII are letters.
_MARKS = re.compile("[\u00a0-\u00a9\u00ab-\u00b4\u00b6-\u00b9\u00bb-\u00bf\u00d7\u00f7\u2000-\u206f\u3000-\u303f]")
_LETTERS = bytes(b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))


def word_terms(word: str) -> list[str]:
    """A word and its beginnings, marked by a leading ``^``."""
    return [word, *("^" + word[:n] for n in STEMS if len(word) > n)]


def spaced(text: str) -> str:
    """The text in lower case with spaces for all but letters, and one at either end."""
    return f" {_MARKS.sub(' ', text.lower())} ".encode().translate(_LETTERS).decode()


def words_of(text: str) -> Counter:
    return Counter(spaced(text).split())


class TermFinder:
    """Counts the known terms of texts; one automaton seeks all of them in one pass."""

    def __init__(self, columns: dict[str, int]):
        self.columns = columns

    @cached_property
    def automaton(self) -> ahocorasick.Automaton:
        made = ahocorasick.Automaton()
        for term, column in self.columns.items():
            begins = term.startswith("^")
            made.add_word(f" {term[1:]}" if begins else f" {term} ", (column, begins))
        made.make_automaton()
        return made

    def __call__(self, text: str) -> Counter:
        return self.of_spaced(spaced(text))

    def of_spaced(self, body: str) -> Counter:
        """The same for a text that ``spaced`` has gone over."""
        if not self.columns:
            return Counter()
        return Counter(column for last, (column, begins) in self.automaton.iter(body) if not begins or body[last + 1] != " ")


def family(text: str) -> int:
    """Equal for copies and mostly equal for near copies: the smallest hash of five-word shingles."""
    words, _ = common.word_hashes(pa.array([text]))
    if len(words) < 5:
        return int(words.sum() >> np.uint64(1)) if len(words) else 0
    rolled = sum(words[k:len(words) - 4 + k] * np.uint64(2 * k + 3) for k in range(5))
    return int(common.mix(rolled).min() >> np.uint64(1))


def is_held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from: crc32 of the doc_id's text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE_ROWS) -> DataFrame:
    """(doc_id, text, toxic) of at most ``limit`` labelled rows that are not held out."""
    usable = labels.where(F.col("toxic").isNotNull() & ~is_held_out(F.col("doc_id")))
    chosen = common.sampled(usable.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")), "doc_id", limit)
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")


def _small(batches, place: int):
    """The batches in slices of about 256 KB of text, so that a task's lists stay short."""
    for batch in batches:
        for a, b in common.chunks(batch.column(place), 1 << 18):
            yield batch.slice(a, b - a)


def chosen_terms(sample: DataFrame, stage) -> dict[str, float]:
    """Terms that go with the label beyond chance, and their log-likelihood ratios.

    Families count, not rows, so that a word shared by near copies alone is no evidence. The
    log-likelihood ratio must exceed what the best of all terms reaches by chance.
    """
    def rows(batches):
        for batch in _small(batches, 0):
            out = []
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                kin = family(text)
                out += [(t, kin, toxic) for t in {t for w in words_of(text) for t in word_terms(w)}] + [("", kin, toxic)]
            columns = list(zip(*out, strict=True)) or [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.int64(), pa.int32()), strict=True)], ["term", "kin", "toxic"])

    seen = sample.select("text", "toxic").mapInArrow(rows, "term string, kin long, toxic int").groupBy("term", "kin").agg(F.max("toxic").alias("toxic"))
    counts = seen.groupBy("term").agg(F.sum("toxic").alias("bad"), F.count("*").alias("n"))
    counts = stage(counts, "terms")
    total = counts.where("term = ''").first()
    if total is None or not 0 < total["bad"] < total["n"]:
        return {}
    number = counts.count()
    rate, bad, n = total["bad"] / total["n"], F.col("bad").cast("double"), F.col("n").cast("double")
    other = n - bad
    ratio = 2 * (F.when(bad > 0, bad * F.log(bad / (n * rate))).otherwise(0.0) + F.when(other > 0, other * F.log(other / (n * (1 - rate)))).otherwise(0.0))
    best = (
        counts.where("term <> ''").withColumn("ratio", ratio)
        .where((F.col("ratio") > 2 * math.log(number) + 6) & (bad > 3 * rate * n) & (bad >= 0.5 * n))
        .orderBy(F.desc("ratio"), "term").limit(MOST_TERMS).select("term", "ratio").collect()
    )
    return {r["term"]: r["ratio"] for r in best}


def word_columns(bodies: list[str], vocabulary: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, column, count, place of the first one among the text's words) of the words that are known.

    ``bodies`` are texts that ``spaced`` has gone over, ``vocabulary`` has the sorted 64-bit hashes of the words. Ordered
    by text and column.
    """
    if not len(bodies) or not len(vocabulary):
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    hashes, starts = common.word_hashes(pa.array(bodies))
    at = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
    known = np.flatnonzero(vocabulary[at] == hashes)
    text = np.repeat(np.arange(len(bodies)), np.diff(starts))[known]
    keys, first, n = np.unique(text * len(vocabulary) + at[known], return_index=True, return_counts=True)
    text = keys // len(vocabulary)
    return text, keys % len(vocabulary), n, known[first] - starts[text]


def vocabulary_of(sample: DataFrame) -> np.ndarray:
    """Sorted hashes of all words of the sample."""
    def rows(batches):
        seen = np.zeros(0, np.uint64)
        for batch in _small(batches, 0):
            hashes, _ = common.word_hashes(pa.array([spaced(t) for t in batch.column(0).to_pylist()]))
            seen = np.union1d(seen, hashes)
        yield pa.RecordBatch.from_arrays([pa.array(seen.view(np.int64))], ["h"])

    found = sample.select("text").mapInArrow(rows, "h long").distinct().toArrow()
    return np.sort(found.column(0).to_numpy().view(np.uint64))


def frequencies(docs: DataFrame, terms: list[str], vocabulary: np.ndarray) -> tuple[np.ndarray, int]:
    """In how many documents each term, then each word occurs; and the number of documents."""
    known, size = {t: k for k, t in enumerate(terms)}, len(terms) + len(vocabulary)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def rows(batches):
        counts, n, find = np.zeros(size, np.int64), 0, TermFinder(known)
        for batch in _small(batches, 0):
            bodies = [spaced(t) for t in batch.column(0).to_pylist()]
            n += len(bodies)
            for body in bodies if known else []:
                counts[list(find.of_spaced(body))] += 1
            counts[len(known):] += np.bincount(word_columns(bodies, shared.value)[1], minlength=size - len(known))
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1), pa.int32()), pa.array(np.append(counts[some], n), pa.int64())], ["k", "n"])

    found = docs.select(F.coalesce("text", F.lit("")).alias("text")).mapInArrow(rows, "k int, n long").groupBy("k").agg(F.sum("n").alias("n")).toArrow()
    at, n = (found.column(c).to_numpy() for c in ("k", "n"))
    counts = np.zeros(size, np.int64)
    counts[at[at >= 0]] = n[at >= 0]
    return counts, int(n[at < 0].sum())


def _spread(begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """All numbers of the ranges, one range after the other."""
    n = end - begin
    return np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(n.sum())


class ExampleIndex:
    """The examples' unit vectors as inverted lists with a largest weight for each column and block of examples.

    Columns are the terms of ``idf``, then the words whose sorted hashes are ``vocabulary``. Lists of the most
    common columns, which have nearly every block, are the rows of a matrix, and so are their block maxima. Blocks that
    can reach the k-th cosine are read in single precision, and what may be among the best is computed exactly.
    """

    def __init__(self, idf: dict[str, float], block: int = BLOCK, vocabulary: np.ndarray | None = None, word_idf: np.ndarray | None = None):
        self.idf = idf
        self.names = list(idf)
        self.vocabulary = np.zeros(0, np.uint64) if vocabulary is None else vocabulary
        self.values = np.append(list(idf.values()), [] if word_idf is None else word_idf)
        self.find = TermFinder({t: k for k, t in enumerate(idf)})
        self.block = block
        self.short = None
        self.add([])

    def counted(self, bodies: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(columns, counts, places of the words or -1) of each spaced text; empty if nothing of it is known."""
        text, column, n, place = word_columns(bodies, self.vocabulary)
        column = column + len(self.names)
        ends = np.searchsorted(text, np.arange(len(bodies) + 1))
        made = []
        for k, body in enumerate(bodies):
            own = slice(ends[k], ends[k + 1])
            found = sorted(self.find.of_spaced(body).items())
            at, m = (np.array(x, np.int64) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 2
            made.append((np.append(at, column[own]), np.append(m, n[own]), np.append(np.full(len(at), -1), place[own])))
        return made

    def weighed(self, at: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The unit vector's weights."""
        weights = (1 + np.log(n)) * self.values[at]
        return weights / np.sqrt((weights * weights).sum()) if len(weights) else weights

    def vectors(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(columns, weights, places of the words) of each text's unit vector."""
        return self.vectors_of_spaced([spaced(t) for t in texts])

    def vectors_of_spaced(self, bodies: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        return [(at, self.weighed(at, n), place) for at, n, place in self.counted(bodies)]

    def vector(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """(columns, weights) of a text's unit vector; both empty if it has none of the words and terms."""
        return self.vectors([text])[0][:2]

    def add_counted(self, ids: np.ndarray, labels: np.ndarray, sizes: np.ndarray, at: np.ndarray, n: np.ndarray) -> ExampleIndex:
        """Examples by columns and counts, one after the other; this short form is also what is pickled."""
        steps = np.diff(at.astype(np.int32), prepend=np.int32(0))
        short = n.astype(np.min_scalar_type(int(n.max(initial=0))))
        self.short = (ids, labels, sizes, zlib.compress(steps.tobytes(), 1), zlib.compress(short.tobytes(), 1), short.dtype.str)
        weights = (1 + np.log(n)) * self.values[at]
        opens = (np.cumsum(sizes) - sizes)[sizes > 0]
        if len(opens):
            weights /= np.repeat(np.sqrt(np.add.reduceat(weights * weights, opens)), sizes[sizes > 0])
        return self._laid_out(ids, labels, sizes, at, weights)

    def __getstate__(self):
        return (self.idf, self.block, self.vocabulary, self.values[len(self.names):], self.short) if self.short else self.__dict__

    def __setstate__(self, state):
        if isinstance(state, dict):
            self.__dict__.update(state)
            return
        *own, (ids, labels, sizes, steps, short, kind) = state
        self.__init__(*own)
        at = np.cumsum(np.frombuffer(zlib.decompress(steps), np.int32), dtype=np.int64)
        self.add_counted(ids, labels, sizes, at, np.frombuffer(zlib.decompress(short), kind).astype(np.int64))

    def add(self, examples: list[tuple[int, int, np.ndarray, np.ndarray]]) -> ExampleIndex:
        """Examples (id, label, columns, weights); like ones are put side by side, so that blocks differ."""
        sizes = np.array([len(e[2]) for e in examples], np.int64)
        at, weights = (np.concatenate([np.zeros(0), *[e[k] for e in examples]]) for k in (2, 3))
        return self._laid_out(np.array([e[0] for e in examples], np.int64), np.array([e[1] for e in examples]), sizes, at.astype(np.int64), weights)

    def _laid_out(self, ids: np.ndarray, labels: np.ndarray, sizes: np.ndarray, at: np.ndarray, weights: np.ndarray) -> ExampleIndex:
        """The index over examples that lie one after the other; those without a column are left out."""
        ends = np.cumsum(sizes)
        held = np.flatnonzero(sizes > 0)
        opens = (ends - sizes)[held]
        most = np.maximum.reduceat(weights, opens) if len(held) else np.zeros(0)
        leads = np.where(weights == np.repeat(most, sizes[held]), np.arange(len(weights)), len(weights))
        lead = at[np.minimum.reduceat(leads, opens)] if len(held) else np.zeros(0, np.int64)
        order = held[np.lexsort((ids[held], -most, lead))]
        self.ids, self.labels, sizes, ends = ids[order].astype(np.int64), labels[order].astype(float), sizes[order], ends[order]
        own = _spread(ends - sizes, ends)
        column, self.weights = at[own], weights[own]
        self.columns = column.astype(np.int32)
        self.begins = np.append(0, np.cumsum(sizes))
        row = np.repeat(np.arange(len(order), dtype=np.int32), sizes)
        often = np.bincount(column, minlength=len(self.values))
        common_ones = np.argsort(-often, kind="stable")[:DENSE]
        self.slots = np.full(len(self.values), -1, np.int32)
        self.slots[common_ones] = np.arange(len(common_ones))
        slot = self.slots[column]
        self.dense = np.zeros((len(order), len(common_ones)), np.float32)
        self.dense[row[slot >= 0], slot[slot >= 0]] = self.weights[slot >= 0]
        self.edges = np.arange(0, len(order), self.block)
        self.dense_most = np.maximum.reduceat(self.dense, self.edges, axis=0).T.copy() if len(order) else np.zeros((len(common_ones), 0), np.float32)
        rare = np.flatnonzero(slot < 0)
        rare = rare[np.argsort(column[rare], kind="stable")]
        self.rows, self.rare = row[rare], self.weights[rare].astype(np.float32)
        listed, blocks = column[rare], self.rows // self.block
        opens = np.flatnonzero((np.diff(listed, prepend=-1) != 0) | (np.diff(blocks, prepend=-1) != 0))
        self.list_begins = np.append(opens, len(rare))
        self.list_blocks = blocks[opens]
        self.list_most = np.maximum.reduceat(self.rare, opens) if len(opens) else np.zeros(0, np.float32)
        self.lists = np.searchsorted(listed[opens], np.arange(len(self.values) + 1))
        self.read = self.there = 0
        return self

    def nearest_of(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int = NEIGHBOURS, leave: list[int] | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
        """``nearest`` of several queries; ``leave`` has for each the id of the examples that are left out.

        ``read`` counts the blocks that were read and ``there`` those that share a column, over all calls.
        """
        made, whole = [], np.zeros(len(self.values))
        for first in range(0, len(queries), AT_ONCE):
            some = queries[first:first + AT_ONCE]
            rough, least = self._rough(some, k, None if leave is None else np.array(leave[first:first + AT_ONCE]))
            text, place = np.nonzero((rough >= least[:, None] - SLACK) & (rough > 0))
            ends = np.searchsorted(text, np.arange(len(some) + 1))
            for j, (at, weights) in enumerate(some):
                near = place[ends[j]:ends[j + 1]]
                if not len(near):
                    made.append((np.zeros(0, np.int64), np.zeros(0)))
                    continue
                begin, end = self.begins[near], self.begins[near + 1]
                own = _spread(begin, end)
                whole[at] = weights
                cosines = np.add.reduceat(whole[self.columns[own]] * self.weights[own], np.append(0, np.cumsum(end - begin)[:-1]))
                whole[at] = 0
                order = np.lexsort((near, -np.round(cosines, 12)))[:k]
                made.append((near[order], cosines[order]))
        return made

    def _rough(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int, leave: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """Single-precision cosines of the blocks that were read (0 elsewhere), and the k-th of each query."""
        count, size = len(self.ids), len(queries)
        rough = np.zeros((size, count), np.float32)
        if not count:
            return rough, np.zeros(size, np.float32)
        at, weights = (np.concatenate([q[j] for q in queries]) for j in (0, 1))
        text, slot = np.repeat(np.arange(size), [len(q[0]) for q in queries]), self.slots[at]
        thick = np.zeros((size, self.dense.shape[1]), np.float32)
        thick[text[slot >= 0], slot[slot >= 0]] = weights[slot >= 0]
        begin, end = self.lists[at[slot < 0]], self.lists[at[slot < 0] + 1]
        lists, times = _spread(begin, end), end - begin
        text, weights = np.repeat(text[slot < 0], times), np.repeat(weights[slot < 0], times)
        cells = text * len(self.edges) + self.list_blocks[lists]
        thin = np.bincount(cells, weights * self.list_most[lists], size * len(self.edges))
        bound = thick @ self.dense_most + thin.reshape(size, len(self.edges)).astype(np.float32)
        open_ones = bound > 0
        self.there += int(open_ones.sum())
        bound += SLACK
        least = np.zeros(size, np.float32)
        for most in (*ROUNDS, None):
            wanted = open_ones & (bound >= least[:, None])
            if most is not None and wanted.shape[1] > most:
                wanted &= bound >= np.partition(bound * wanted, -most, axis=1)[:, -most, None]
            if not wanted.any():
                break
            open_ones &= ~wanted
            self.read += int(wanted.sum())
            read = np.flatnonzero(wanted.any(axis=0))
            if 2 * len(read) < len(self.edges):
                rows = _spread(self.edges[read], np.minimum(self.edges[read] + self.block, count))
                matrix = self.dense[rows]
            else:  # copying the most of the matrix costs more than it saves
                rows, matrix = np.arange(count), self.dense
            # Lists are read where the own query wants the block, matrix rows where any of the batch does.
            own = np.flatnonzero(wanted.ravel()[cells])
            opens, closes = self.list_begins[lists[own]], self.list_begins[lists[own] + 1]
            postings, times = _spread(opens, closes), closes - opens
            sums = np.bincount(np.repeat(text[own] * count, times) + self.rows[postings], np.repeat(weights[own], times) * self.rare[postings], size * count)
            sums = sums.reshape(size, count)
            found = thick @ matrix.T
            found += sums if len(rows) == count else sums[:, rows]
            shown = wanted[:, rows // self.block]
            if leave is not None:
                shown &= self.ids[rows] != leave[:, None]
            if len(rows) == count:
                np.copyto(rough, found, where=shown, casting="same_kind")
            else:
                rough[:, rows] = np.where(shown, found, rough[:, rows])
            if count > k:
                least = np.partition(rough, -k, axis=1)[:, -k]
        return rough, least

    def nearest(self, at: np.ndarray, weights: np.ndarray, k: int = NEIGHBOURS, leave: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(positions, cosines) of the k most similar examples, exactly; ties go to the smaller position. ``leave`` is an id."""
        return self.nearest_of([(at, weights)], k, None if leave is None else [leave])[0]


def vote(cosines: np.ndarray, labels: np.ndarray, base: float, prior: float = PRIOR) -> float:
    """Votes weighted by 1 - angular distance, with the base rate as one more weak vote."""
    weights = 1 - np.arccos(np.clip(cosines, -1, 1)) / (math.pi / 2)
    return float(((weights * labels).sum() + prior * base) / (weights.sum() + prior))


def rising(values: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool-adjacent-violators: (upper ends of value, rate), each pool smoothed by one half."""
    pools: list[list[float]] = []
    for v, y in sorted(zip(values.tolist(), labels.tolist(), strict=True)):
        pools.append([v, y, 1.0])
        while len(pools) > 1 and (pools[-2][0] == pools[-1][0] or pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]):
            v2, y2, n2 = pools.pop()
            pools[-1] = [v2, pools[-1][1] + y2, pools[-1][2] + n2]
    rates = np.maximum.accumulate([(y + 0.5) / (n + 1) for _, y, n in pools]) if pools else np.zeros(0)
    return np.array([v for v, _, _ in pools]), rates


class ToxicityModel:
    """The index, the base rates and the calibration; picklable and of bounded size."""

    def __init__(self, index: ExampleIndex, base: float, none_rate: float, ends: np.ndarray, rates: np.ndarray):
        self.index, self.base, self.none_rate, self.ends, self.rates = index, base, none_rate, ends, rates

    def scores(self, texts: list[str], why: bool = True) -> list[tuple[float, list[tuple[int, float, int]], list[str]]]:
        """(score, [(example id, cosine, label)], terms and words found) of each text; only the score unless ``why``."""
        bodies = [spaced(t) for t in texts]
        vectors = self.index.vectors_of_spaced(bodies)
        near = self.index.nearest_of([(at, weights) for at, weights, _ in vectors])
        return [self._score(body, *v, *n, why) for body, v, n in zip(bodies, vectors, near, strict=True)]

    def score(self, text: str) -> tuple[float, list[tuple[int, float, int]], list[str]]:
        return self.scores([text])[0]

    def _score(self, body, at, weights, places, near, cosines, why):
        if not len(near):
            return self.none_rate, [], []
        raw = vote(cosines, self.index.labels[near], self.base)
        place = min(int(np.searchsorted(self.ends, raw - 1e-12)), len(self.rates) - 1)
        score = float(self.rates[place])
        if not why:
            return score, [], []
        evidence = [(int(self.index.ids[k]), float(c), int(self.index.labels[k])) for k, c in zip(near[:3], cosines[:3], strict=True)]
        words, names = body.encode().split(), self.index.names
        high = np.flatnonzero(weights >= np.partition(weights, -5)[-5]) if len(weights) > 5 else np.arange(len(weights))
        best = high[np.argsort(-weights[high], kind="stable")[:5]]
        return score, evidence, [names[at[k]] if places[k] < 0 else words[places[k]].decode() for k in best]


def fitted(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE_ROWS) -> ToxicityModel:
    """A model of the labelled rows that are not held out. Without both labels every text gets the base rate."""
    stage = common.stages(docs, "toxicity")
    sample = stage(labelled_sample(docs, labels, limit), "sample")
    ratios = chosen_terms(sample, stage)
    terms, vocabulary = list(ratios), vocabulary_of(sample)
    counts, total = frequencies(docs, terms, vocabulary)
    idf = np.log((1 + total) / (1 + counts)) + 1
    raised = idf[:len(terms)] * (1 + np.sqrt(list(ratios.values())))
    empty = ExampleIndex(dict(zip(terms, raised.tolist(), strict=True)), BLOCK, vocabulary, idf[len(terms):])
    context = docs.sparkSession.sparkContext
    shared = context.broadcast(empty)

    def counts_of(batches):
        for batch in _small(batches, 1):
            got = shared.value.counted([spaced(t) for t in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array([a for a, _, _ in got], pa.list_(pa.int32())), pa.array([n for _, n, _ in got], pa.list_(pa.int32()))], ["doc_id", "toxic", "at", "n"])

    plain = sample.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "toxic")
    rows = plain.mapInArrow(counts_of, "doc_id long, toxic int, at array<int>, n array<int>").orderBy("doc_id", "toxic", "at", "n").toArrow().combine_chunks()
    ids, toxic = (rows.column(c).to_numpy() for c in ("doc_id", "toxic"))
    at, n = (np.concatenate([np.zeros(0, np.int32), *[c.flatten().to_numpy() for c in rows.column(k).chunks]]) for k in ("at", "n"))
    sizes = np.concatenate([np.zeros(0, np.int64), *[c.value_lengths().to_numpy() for c in rows.column("at").chunks]]).astype(np.int64)
    base = float(toxic.mean()) if len(toxic) else 0.0
    none_rate = (float(toxic[sizes == 0].sum()) + base) / (int((sizes == 0).sum()) + 1)
    index = empty.add_counted(ids, toxic, sizes, at, n)
    filled = context.broadcast(index)

    def voted(batches):
        known = filled.value
        for batch in _small(batches, 1):
            some = [(a, w) for a, w, _ in known.vectors(batch.column(1).to_pylist())]
            near = known.nearest_of(some, leave=batch.column(0).to_pylist())
            raw = [vote(cosines, known.labels[found], base) if len(found) else None for found, cosines in near]
            yield pa.RecordBatch.from_arrays([pa.array(raw, pa.float64()), batch.column(2)], ["raw", "toxic"])

    shared.unpersist()
    votes = plain.mapInArrow(voted, "raw double, toxic int").where("raw is not null").toArrow()
    filled.unpersist()
    ends, rates = rising(votes.column("raw").to_numpy(), votes.column("toxic").to_numpy().astype(float))
    stage.remove()
    return ToxicityModel(index, base, none_rate, ends, rates)


EVIDENCE = "evidence array<struct<doc_id:long, cosine:double, toxic:int>>, terms array<string>"


def scored(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """(doc_id, held_out, score, predicted, evidence, terms) per row; the text alone decides.

    Null and empty texts, and those without a known word, get the rate of such labelled texts.
    Repeated rows are scored alike; a null doc_id stays null and counts as not held out.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def rows(batches):
        known = shared.value
        for batch in _small(batches, 1):
            got = known.scores(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([s for s, _, _ in got], pa.float64()),
                pa.array([[{"doc_id": i, "cosine": c, "toxic": y} for i, c, y in e] for _, e, _ in got],
                         pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64()), ("toxic", pa.int32())]))),
                pa.array([t for _, _, t in got], pa.list_(pa.string())),
            ], ["doc_id", "score", "evidence", "terms"])

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    found = plain.mapInArrow(rows, f"doc_id long, score double, {EVIDENCE}")
    return found.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score",
                        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "evidence", "terms")


def keep_harmless(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """The documents that score below the threshold; columns as in ``docs``. A row is judged where it stands."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index("text")

    def rows(batches):
        known = shared.value
        for batch in _small(batches, place):
            keep = [s < THRESHOLD for s, _, _ in known.scores([t or "" for t in batch.column(place).to_pylist()], why=False)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(rows, docs.schema)
