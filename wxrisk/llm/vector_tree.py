"""Approximate nearest neighbours by inner product: a hierarchical k-means tree searched best bin first.

The tree is fitted on a bounded sample and every row is filed under a leaf. A query pops nodes from a priority
queue, the one whose centre has the largest product first, until it has met as many leaves as calibration found
to be needed: for a bounded set of queries the true neighbours are found by a scan of all rows, and the number of
leaves is widened until the wanted share of them is met. The search widens too: what a query has found in its
first leaves is the floor for the next, so hardly more than the answer is sent on. Neighbouring leaves are packed into
bins that are joined with the queries that visit them; a large leaf is many parts and many visitors are several
groups, so no task holds a leaf that has a third of the rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wxrisk.llm import common

#: Numbers (rows x dimensions) in the sample that the tree is fitted on, at most; rows with the smallest hash of vec_id.
SAMPLE_NUMBERS = 1 << 22
#: Children of a node, rows of a leaf (more where the sample is too small to part them), rounds of k-means.
BRANCHES = 16
LEAF_ROWS = 128
LEAST_SAMPLE = 8
ROUNDS = 8
#: Queries that calibrate the search, and the share of their true neighbours that it has to meet.
CALIBRATION = 256
RECALL = 0.95
#: Rows of a bin's part and visiting queries in one group of the search; queries multiplied at once.
SEGMENT = 8192
VISITORS = 4096
AT_ONCE = 256
#: Leaves of the first search, and how many times as many each wider one reaches.
FIRST_LEAVES = 8
WIDER = 8
#: Far above what a different order of adding changes in a product, relative to the largest one.
SLACK = 1e-9


class Tree:
    """Centres of all nodes, their children or leaf numbers."""

    def __init__(self, width: int):
        self.width = width
        self.centres: np.ndarray = np.zeros((1, width))
        self.children: list[list[int]] = [[]]
        self.leaf_of: list[int] = [0]
        self.leaves = 1

    @classmethod
    def fitted(cls, sample: np.ndarray, leaf_rows: float, branches: int = BRANCHES, seed: int = 11) -> Tree:
        """Splits every node with more than ``leaf_rows`` rows of the sample; equal rows are not split."""
        tree, draw = cls(sample.shape[1]), np.random.default_rng(seed)
        if not len(sample):
            return tree
        centres, children, open_ones = [sample.mean(axis=0)], [[]], [(0, np.arange(len(sample)))]
        while open_ones:
            node, rows = open_ones.pop()
            if len(rows) <= leaf_rows:
                continue
            groups, means = k_means(sample[rows], min(branches, int(np.ceil(len(rows) / leaf_rows))), draw)
            if len(means) < 2:
                continue
            for k, mean in enumerate(means):
                children[node].append(len(centres))
                open_ones.append((len(centres), rows[groups == k]))
                centres.append(mean)
                children.append([])
        tree.centres, tree.children = np.array(centres), children
        numbers = iter(range(len(children)))
        tree.leaf_of = [-1 if own else next(numbers) for own in children]
        tree.leaves = sum(not own for own in children)
        return tree

    def filed(self, rows: np.ndarray) -> np.ndarray:
        """The leaf of each row: down the tree to the closest centre."""
        node = np.zeros(len(rows), np.int64)
        todo = [(0, np.arange(len(rows)))]
        while todo:
            at, own = todo.pop()
            node[own] = at
            if self.children[at] and len(own):
                below = self.children[at]
                closest = nearest_centre(rows[own], self.centres[below])
                todo += [(below[k], own[closest == k]) for k in range(len(below))]
        return np.array(self.leaf_of, np.int64)[node]

    def best_first(self, queries: np.ndarray, visits: int) -> list[list[int]]:
        """The first ``visits`` leaves of each query; the queue gives the node whose centre's product is largest."""
        made = []
        for begin in range(0, len(queries), AT_ONCE):
            for products in -(queries[begin:begin + AT_ONCE] @ self.centres.T):
                costs, met, queue = products.tolist(), [], [(0.0, 0)]
                while queue and len(met) < visits:
                    _, node = heapq.heappop(queue)
                    if self.children[node]:
                        for below in self.children[node]:
                            heapq.heappush(queue, (costs[below], below))
                    else:
                        met.append(self.leaf_of[node])
                made.append(met)
        return made


def nearest_centre(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    lengths = (centres * centres).sum(axis=1)
    return np.concatenate([np.zeros(0, np.int64), *[(lengths - 2 * (rows[a:a + SEGMENT] @ centres.T)).argmin(axis=1) for a in range(0, len(rows), SEGMENT)]])


def k_means(rows: np.ndarray, k: int, draw: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """(group of each row, centres) of at most k groups that all hold rows."""
    centres = rows[draw.permutation(len(rows))[:k]]
    groups = nearest_centre(rows, centres)
    for _ in range(ROUNDS):
        sums = np.zeros_like(centres)
        np.add.at(sums, groups, rows)
        held = np.bincount(groups, minlength=len(centres))
        centres = sums[held > 0] / held[held > 0, None]
        groups = nearest_centre(rows, centres)
    held, groups = np.unique(groups, return_inverse=True)
    return groups, centres[held]


def products(rows: np.ndarray, queries: np.ndarray, place: np.ndarray, number: np.ndarray) -> np.ndarray:
    """Inner products of rows and queries in double precision, each added from the first dimension to the last, so that equal rows have equal ones."""
    sums = np.zeros(len(place))
    for row, query in zip(np.ascontiguousarray(rows.T), np.ascontiguousarray(queries.T), strict=True):
        sums += row[place] * query[number]
    return sums


def first_of(number: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best entries of each query, largest score first, equal ones by smaller id."""
    order = np.lexsort((ids, -score, number))
    sorted_numbers = number[order]
    return order[np.arange(len(order)) - np.searchsorted(sorted_numbers, sorted_numbers) < k]


def best_of(ids: np.ndarray, rows: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int,
            floor: np.ndarray | None = None, met: list[tuple[int, int, np.ndarray]] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query number, row number, product) of the k best rows of each query that reach its floor; never its own row.

    ``met`` has ranges of rows with the sorted numbers of the queries that visit them; without it all visit all.
    Matrix products find what may be among the best, ties included; only that is worked out exactly.
    """
    made = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
    longest = float(np.sqrt((rows * rows).sum(axis=1).max(initial=0)))
    for begin in range(0, len(queries), AT_ONCE):
        some = queries[begin:begin + AT_ONCE]
        if met is None:
            rough = some @ rows.T
        else:
            rough = np.full((len(some), len(rows)), -np.inf)
            for a, b, visitors in met:
                own = visitors[slice(*np.searchsorted(visitors, (begin, begin + AT_ONCE)))] - begin
                rough[own, a:b] = some[own] @ rows[a:b].T
        rough[ids == query_ids[begin:begin + AT_ONCE, None]] = -np.inf
        if floor is not None:
            least = floor[begin:begin + AT_ONCE]
        else:
            least = np.partition(rough, -k, axis=1)[:, -k] if len(rows) > k else np.full(len(some), -np.inf)
        slack = SLACK * (1 + np.sqrt((some * some).sum(axis=1)) * longest)
        number, place = np.nonzero((rough >= (least - slack)[:, None]) & (rough > -np.inf))
        score = products(rows, some, place, number)
        best = first_of(number, ids[place], score, k)
        made.append((number[best] + begin, place[best], score[best]))
    return tuple(np.concatenate(x) for x in zip(*made, strict=True))


def searchable(vectors: DataFrame) -> DataFrame:
    """(vec_id, vector) of the rows that take part."""
    vector = F.col("embedding").cast("array<double>")
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    zero = F.forall(vector, lambda x: x == 0)
    known = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull())
    return known.where(~odd & ~zero).select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("vector"))


def matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Rows of a list column as an array; what a shorter row lacks is 0."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    made = np.zeros((len(sizes), width))
    made[np.arange(width) < sizes[:, None]] = flat
    return made


_BEST = "query_id long, vec_id long, leaf long, score double"


class VectorIndex:
    """A fitted tree, the rows filed under its leaves, and the number of leaves that a query visits."""

    def __init__(self, rows: DataFrame, tree: Tree, filed: DataFrame, sizes: dict[int, int], stage):
        self.rows, self.tree, self.filed, self.sizes, self.stage = rows, tree, filed, sizes, stage
        self.visits = tree.leaves
        self.calibrated_recall = 1.0

    @classmethod
    def built(cls, vectors: DataFrame, leaf_rows: int = LEAF_ROWS, sample_numbers: int = SAMPLE_NUMBERS) -> VectorIndex:
        """Every row that takes part is filed; only the tree is fitted on a sample."""
        stage = common.stages(vectors, "vectors")
        rows = searchable(vectors)
        told = rows.agg(F.max(F.size("vector")).alias("width"), F.count("*").alias("n")).first()
        width, n = told["width"] or 1, told["n"]
        limit = max(1, sample_numbers // width)
        sample = matrix(common.sampled(rows, "vec_id", limit).orderBy("vec_id", "vector").toArrow().column("vector"), width) if n else np.zeros((0, width))
        tree = Tree.fitted(sample, max(LEAST_SAMPLE, leaf_rows * len(sample) / max(1, n)))
        shared = vectors.sparkSession.sparkContext.broadcast(tree)

        def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                leaf = shared.value.filed(matrix(batch.column(1), width))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf)], ["vec_id", "vector", "leaf"])

        filed = stage(rows.mapInArrow(file, "vec_id long, vector array<double>, leaf long"), "filed")
        # One row per leaf; leaves are bounded by the sample.
        sizes = {r["leaf"]: r["count"] for r in filed.groupBy("leaf").count().collect()}
        return cls(rows, tree, filed, sizes, stage)

    def _true_neighbours(self, ids: np.ndarray, queries: np.ndarray, k: int) -> DataFrame:
        """(query_id, vec_id, leaf, score) of the exact k nearest; every task scans its rows for the bounded queries."""
        width = self.tree.width
        shared = self.filed.sparkSession.sparkContext.broadcast((ids, queries))

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known, asked = shared.value
            best = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
            for batch in batches:
                own, leaf = (batch.column(c).to_numpy() for c in (0, 2))
                number, place, score = best_of(own, matrix(batch.column(1), width), known, asked, k)
                best = [np.append(old, new) for old, new in zip(best, (number, own[place], leaf[place], score), strict=True)]
                first = first_of(best[0], best[1], best[3], k)
                best = [x[first] for x in best]
            yield pa.RecordBatch.from_arrays([pa.array(known[best[0]]), *map(pa.array, best[1:])], ["query_id", "vec_id", "leaf", "score"])

        return nearest_first(self.filed.mapInArrow(scan, _BEST), k)

    def calibrate(self, queries: DataFrame, k: int, recall: float = RECALL, limit: int = CALIBRATION) -> VectorIndex:
        """Widens the visits until ``recall`` of the true neighbours of a bounded set of queries are met."""
        chosen = common.sampled(queries, "vec_id", limit).orderBy("vec_id").toArrow()
        if not chosen.num_rows:
            return self
        ids, asked = chosen.column("vec_id").to_numpy(), matrix(chosen.column("vector"), self.tree.width)
        truth = self._true_neighbours(ids, asked, k).select("query_id", "leaf").toArrow()
        places = {i: {leaf: place for place, leaf in enumerate(met)} for i, met in zip(ids.tolist(), self.tree.best_first(asked, self.tree.leaves), strict=True)}
        needed = np.array([places[i][leaf] + 1 for i, leaf in zip(truth.column("query_id").to_pylist(), truth.column("leaf").to_pylist(), strict=True)])
        visits = 1
        while len(needed) and (needed <= visits).mean() < recall:
            visits += 1
        self.visits, self.calibrated_recall = visits, float((needed <= visits).mean()) if len(needed) else 1.0
        return self

    def bins(self) -> dict[int, tuple[int, int]]:
        """(bin, rows of the bin) of each leaf: leaves that follow one another in the tree, up to SEGMENT rows, or one larger leaf."""
        packs, held = [], SEGMENT + 1
        for leaf in sorted(self.sizes):
            if held + self.sizes[leaf] > SEGMENT:
                packs.append([])
                held = 0
            packs[-1].append(leaf)
            held += self.sizes[leaf]
        return {leaf: (number, sum(self.sizes[x] for x in pack)) for number, pack in enumerate(packs) for leaf in pack}

    def search(self, queries: DataFrame, k: int) -> DataFrame:
        """(query_id, rank, vec_id, score) of the nearest found of (vec_id, vector) rows, one row per query's id."""
        tree, visits, width, bins = self.tree, self.visits, self.tree.width, self.bins()
        shared = self.filed.sparkSession.sparkContext.broadcast((tree, {leaf: b for leaf, (b, _) in bins.items()}))
        steps = [0, min(FIRST_LEAVES, visits)]
        while steps[-1] < visits:
            steps.append(min(visits, steps[-1] * WIDER))

        def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """A row for each query, step and bin with the leaves of the bin that the step visits."""
            known, bin_of = shared.value
            for batch in batches:
                rows, places, bin_numbers, leaves = [], [], [], []
                for row, met in enumerate(known.best_first(matrix(batch.column(1), width), visits)):
                    for step in range(len(steps) - 1):
                        own: dict[int, list[int]] = {}
                        for leaf in met[steps[step]:steps[step + 1]]:
                            if leaf in bin_of:
                                own.setdefault(bin_of[leaf], []).append(leaf)
                        rows += [row] * len(own)
                        places += [step] * len(own)
                        bin_numbers += own.keys()
                        leaves += own.values()
                yield pa.RecordBatch.from_arrays([*[c.take(pa.array(rows, pa.int64())) for c in batch.columns], pa.array(places, pa.int32()), pa.array(bin_numbers, pa.int64()),
                                                  pa.array(leaves, pa.list_(pa.int64()))], ["vec_id", "vector", "step", "bin", "leaves"])

        routed = self.stage(queries.mapInArrow(route, "vec_id long, vector array<double>, step int, bin long, leaves array<long>"), "routed")
        guests = {(r["step"], r["bin"]): r["count"] for r in routed.groupBy("step", "bin").count().collect()}  # bounded by steps and leaves
        found = None
        for step in range(len(steps) - 1):
            asked = routed.where(F.col("step") == step).drop("step")
            if found is None:
                asked = asked.withColumn("floor", F.lit(None).cast("double"))
            else:
                kth = found.groupBy(F.col("query_id").alias("vec_id")).agg(F.when(F.count("*") >= k, F.min("score")).otherwise(float("-inf")).alias("floor"))
                asked = asked.join(kth, "vec_id", "left").fillna(float("-inf"), ["floor"])
            more = self._met(asked, {b: n for (s, b), n in guests.items() if s == step}, bins, k)
            found = nearest_first(more if found is None else found.select(more.columns).unionByName(more), k)
            if step + 2 < len(steps):
                found = self.stage(found, f"step-{step}")
        return found.select("query_id", "rank", "vec_id", "score")

    def _met(self, asked: DataFrame, guests: dict[int, int], bins: dict[int, tuple[int, int]], k: int) -> DataFrame:
        """(query_id, vec_id, score) of the best rows of each bin's part for the queries that visit it."""
        spark, width = self.filed.sparkSession, self.tree.width
        dealt = [(leaf, b, -(-size // SEGMENT), -(-guests[b] // VISITORS)) for leaf, (b, size) in bins.items() if b in guests]
        # Both have a row per leaf at most, so they are bounded by the sample.
        of_leaf = F.broadcast(spark.createDataFrame(dealt, "leaf long, bin long, parts int, groups int"))
        of_bin = F.broadcast(spark.createDataFrame(sorted({x[1:] for x in dealt}), "bin long, parts int, groups int"))

        def whole(number: str):
            return F.explode(F.sequence(F.lit(0), F.col(number) - 1))

        def drawn(number: str):
            return F.pmod(F.xxhash64("vec_id"), F.col(number)).cast("int")

        members = self.filed.join(of_leaf, "leaf").withColumn("parts", drawn("parts")).withColumn("groups", whole("groups"))
        visitors = asked.join(of_bin, "bin").withColumn("groups", drawn("groups")).withColumn("parts", whole("parts"))

        def meet(held: pa.Table, guests: pa.Table) -> pa.Table:
            held = held.sort_by("leaf")
            ids, leaf, rows = held.column("vec_id").to_numpy(), held.column("leaf").to_numpy(), matrix(held.column("vector"), width)
            query_ids, queries, floor = guests.column("vec_id").to_numpy(), matrix(guests.column("vector"), width), guests.column("floor")
            lists = guests.column("leaves").combine_chunks()
            wanted = lists.flatten().to_numpy(zero_copy_only=False)
            number = np.repeat(np.arange(len(query_ids)), lists.value_lengths().to_numpy(zero_copy_only=False))
            order = np.argsort(wanted, kind="stable")
            wanted, number = wanted[order], number[order]
            met = [(*np.searchsorted(leaf, (x, x + 1)).tolist(), number[slice(*np.searchsorted(wanted, (x, x + 1)))]) for x in np.unique(leaf)]
            number, place, score = best_of(ids, rows, query_ids, queries, k, floor.to_numpy() if floor.null_count == 0 else None, met)
            return pa.table({"query_id": query_ids[number], "vec_id": ids[place], "score": score})

        keys = ["bin", "parts", "groups"]
        return members.groupBy(*keys).cogroup(visitors.groupBy(*keys)).applyInArrow(meet, "query_id long, vec_id long, score double")


def nearest_first(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def neighbours(vectors: DataFrame, k: int = 20, every: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each row whose vec_id is divisible by ``every``.

    Rows take no part if vec_id or vector is null, or the vector is empty, zero or has a null or non-finite component.
    What a shorter vector lacks counts as 0. Equal products are ranked by vec_id. Rows that repeat a vec_id
    are candidates each; as a query the id counts once, with the smallest of its vectors, and none of
    its rows is a candidate for itself. No rows give no rows. Only vec_id and embedding are read.
    """
    index = VectorIndex.built(vectors)
    queries = index.rows.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    queries = index.stage(queries, "queries")
    return index.calibrate(queries, k).search(queries, k)
