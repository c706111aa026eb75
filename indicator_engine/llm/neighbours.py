"""Approximate nearest neighbours by inner product: few stable projections and a kd-tree.

Inner products become distances: with one more component, ``sqrt(longest^2 - |x|^2)``, all
vectors are of one length, and the nearest vector to a query (whose further component is 0)
is the one with the largest inner product.  ``PROJECTIONS`` Gaussian (2-stable) combinations
of the components are a vector's projection: for a vector at distance d of the query, the
squared distance of the projections over d^2 follows the chi-square distribution.

A kd-tree over the projections, fitted on a sample of at most ``SAMPLE_VALUES`` components,
deals all vectors to about ``CELLS`` cells at most, a cell to segments of about ``SEGMENT``
vectors (which also splits a vector that repeats), and each segment has a kd-tree of its own,
built once and written.  A segment's leaves are taken in order of their projected
distance to the query and their vectors verified in full, until the chi-square test holds:
the projected distance reached, squared, over the squared distance of the k-th best vector
found so far is a value that an unseen vector nearer than that one would exceed with
probability below ``1 - sure``.  So each true neighbour is found with probability ``sure``
at least.  No number of candidates ends the search.

Two rounds: a query first looks into the segments of its own cell; the k-th best distance
found there is the bound with which it visits every other cell that the test does not rule
out.  A task holds one segment and a block of queries at a time; the blocks that visit a
segment are its stream in a join, which adaptive execution splits where it is long.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from indicator_engine.llm.common import gathered, list_matrix, pack, unpack, whole_vector, written

PROJECTIONS = 12
SURE = 0.97
SEGMENT = 8192
LEAF = 128
CELLS = 4096
SAMPLE_VALUES = 2 << 20
BLOCK = 1024
SEED = 20

_FOUND = "query_id long, vec_id long, score double"
_ARRAYS = {
    "ids": np.int64,
    "vectors": np.float64,
    "points": np.float64,
    "bounds": np.int64,
    "low": np.float64,
    "high": np.float64,
}
_SEGMENT = "_cell long, _piece long, " + ", ".join(f"_{name} binary" for name in _ARRAYS)


def chi_square(x: float, degrees: int) -> float:
    """Distribution function for an even number of degrees of freedom."""
    half, term, total = x / 2, 1.0, 1.0
    for i in range(1, degrees // 2):
        term *= half / i
        total += term
    return 1.0 - math.exp(-half) * total


def chi_square_at(share: float, degrees: int) -> float:
    """Where the distribution function reaches ``share``."""
    low, high = 0.0, 1.0
    while chi_square(high, degrees) < share:
        high *= 2
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square(middle, degrees) < share else (low, middle)
    return high


@dataclass(frozen=True)
class Space:
    """What all tasks share: the projection, the squared longest length, the stop of the search."""

    directions: np.ndarray  # (width + 1) x projections
    longest: float  # squared
    stop: float

    @property
    def width(self) -> int:
        return len(self.directions) - 1

    def project(self, vectors: np.ndarray) -> np.ndarray:
        lift = np.sqrt(np.maximum(0.0, self.longest - (vectors * vectors).sum(axis=1)))
        return vectors @ self.directions[:-1] + lift[:, None] * self.directions[-1]

    def project_queries(self, queries: np.ndarray) -> np.ndarray:
        return queries @ self.directions[:-1]


class Tree:
    """kd-tree by medians: ``order`` puts the points leaf by leaf, a leaf is a run of it with a box."""

    def __init__(self, points: np.ndarray, leaf: int):
        self.order = np.arange(len(points))
        self.starts: list[int] = []
        self.cuts: list[tuple] = []  # (dimension, value, left, right); a leaf is ~number
        self._split(points, 0, len(points), leaf)
        self.ends = [*self.starts[1:], len(points)]
        runs = [points[self.order[a:b]] for a, b in zip(self.starts, self.ends)]
        self.low = np.array([r.min(axis=0) for r in runs]).reshape(-1, points.shape[1])
        self.high = np.array([r.max(axis=0) for r in runs]).reshape(-1, points.shape[1])

    def _split(self, points: np.ndarray, low: int, high: int, leaf: int) -> int:
        own = points[self.order[low:high]]
        spread = np.ptp(own, axis=0) if len(own) else np.zeros(1)
        if high - low <= leaf or not spread.max() > 0:
            self.starts.append(low)
            return ~(len(self.starts) - 1)
        d = int(spread.argmax())
        value = np.median(own[:, d])
        left = own[:, d] < value
        if not left.any():  # more than half of the points share the least value
            left = own[:, d] <= value
            value = np.nextafter(value, np.inf)
        self.order[low:high] = np.concatenate([self.order[low:high][left], self.order[low:high][~left]])
        middle = low + int(left.sum())
        self.cuts.append(())
        node = len(self.cuts) - 1
        self.cuts[node] = (d, value, self._split(points, low, middle, leaf), self._split(points, middle, high, leaf))
        return node

    def leaf_of(self, points: np.ndarray) -> np.ndarray:
        """The leaf on whose side of all cuts a point lies."""
        out = np.zeros(len(points), np.int64)
        todo = [(0 if self.cuts else ~0, np.arange(len(points)))]
        while todo:
            node, rows = todo.pop()
            if node < 0:
                out[rows] = ~node
                continue
            d, value, left, right = self.cuts[node]
            side = points[rows, d] < value
            todo += [(left, rows[side]), (right, rows[~side])]
        return out

    def regions(self) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of all space that ``leaf_of`` gives to each leaf."""
        width = self.low.shape[1]
        low, high = np.full((len(self.starts), width), -np.inf), np.full((len(self.starts), width), np.inf)
        todo = [(0 if self.cuts else ~0, np.full(width, -np.inf), np.full(width, np.inf))]
        while todo:
            node, a, b = todo.pop()
            if node < 0:
                low[~node], high[~node] = a, b
                continue
            d, value, left, right = self.cuts[node]
            upper, lower = b.copy(), a.copy()
            upper[d] = lower[d] = value
            todo += [(left, a, upper), (right, lower, b)]
        return low, high


def apart(point: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of a point to each box."""
    beyond = np.maximum(0.0, np.maximum(low - point, point - high))
    return np.einsum("ij,ij->i", beyond, beyond)


@dataclass(frozen=True)
class Segment:
    """Vectors, ids and projections in order of the leaves of a kd-tree; bounds and boxes of the leaves."""

    ids: np.ndarray
    vectors: np.ndarray
    points: np.ndarray
    bounds: np.ndarray
    low: np.ndarray
    high: np.ndarray

    @classmethod
    def build(cls, ids: np.ndarray, vectors: np.ndarray, space: Space) -> Segment:
        points = space.project(vectors)
        tree = Tree(points, LEAF)
        bounds = np.array([*tree.starts, len(points)])
        return cls(ids[tree.order], vectors[tree.order], points[tree.order], bounds, tree.low, tree.high)

    def packed(self) -> list[bytes]:
        return [pack(getattr(self, name)) for name in _ARRAYS]

    @classmethod
    def unpacked(cls, stored: dict, width: int, projections: int) -> Segment:
        flat = {name: unpack(stored[f"_{name}"], dtype) for name, dtype in _ARRAYS.items()}
        wide = {"vectors": width, "points": projections, "low": projections, "high": projections}
        return cls(**{name: a.reshape(-1, wide[name]) if name in wide else a for name, a in flat.items()})

    def search(
        self, own: np.ndarray, queries: np.ndarray, k: int, bounds: np.ndarray, space: Space
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query number, row and score of the vectors verified before the test holds, the ``k`` best of each query.

        ``bounds`` are scores that k vectors elsewhere reach (-inf: not known).  The
        queries go on side by side: in a step each takes its next leaves, and a leaf
        is compared with all queries that take it at once.
        """
        points = space.project_queries(queries)
        squares = (queries * queries).sum(axis=1)
        slack = 1e-9 * np.sqrt(squares * space.longest)
        norms = (self.points * self.points).sum(axis=1)
        near = np.zeros((len(queries), len(self.low)))
        for d in range(points.shape[1]):
            own_d = points[:, d : d + 1]
            near += np.maximum(0.0, np.maximum(self.low[:, d] - own_d, own_d - self.high[:, d])) ** 2
        order = np.argsort(near, axis=1, kind="stable")
        bounds = bounds.copy()
        held = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        active = np.arange(len(queries))
        at, step = 0, 1
        while at < len(self.low):
            reach = space.stop * np.maximum(0.0, squares + space.longest - 2 * bounds)
            active = active[near[active, order[active, at]] <= reach[active]]
            if not len(active):
                break
            leaves = order[active, at : at + step]
            asked = np.repeat(active, leaves.shape[1])
            leaves = leaves.ravel()
            taken = near[asked, leaves] <= reach[asked]
            asked, leaves = asked[taken], leaves[taken]
            by_leaf = np.argsort(leaves, kind="stable")
            asked, leaves = asked[by_leaf], leaves[by_leaf]
            begins = np.flatnonzero(np.diff(leaves, prepend=-1))
            found_q, found_row = [held[0][:0]], [held[1][:0]]
            for begin, end in zip(begins, [*begins[1:], len(leaves)]):
                q, run = asked[begin:end], slice(self.bounds[leaves[begin]], self.bounds[leaves[begin] + 1])
                scores = queries[q] @ self.vectors[run].T
                gaps = (points[q] ** 2).sum(axis=1)[:, None] + norms[run] - 2 * (points[q] @ self.points[run].T)
                verified = (gaps <= reach[q][:, None]) & (self.ids[run] != own[q][:, None])
                i, j = np.nonzero(verified & (scores >= (bounds - slack)[q][:, None]))
                found_q.append(q[i])
                found_row.append(run.start + j)
            q, row = np.concatenate(found_q), np.concatenate(found_row)
            held = self._best(*(np.concatenate(pair) for pair in zip(held, (q, row, self._scores(queries, q, row)))), k)
            full = np.flatnonzero(np.bincount(held[0], minlength=len(queries)) == k)
            last = np.flatnonzero(np.diff(held[0], append=-1))  # the worst one held of each query
            worst = dict(zip(held[0][last].tolist(), held[2][last].tolist()))
            bounds[full] = np.maximum(bounds[full], [worst[i] for i in full.tolist()])
            at, step = at + step, step * 2
        return held

    def _scores(self, queries: np.ndarray, q: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Added up in one order for every row: equal vectors have equal scores."""
        out = np.zeros(len(q))
        for a in range(0, len(q), LEAF * LEAF):
            part = slice(a, a + LEAF * LEAF)
            out[part] = (self.vectors[row[part]] * queries[q[part]]).sum(axis=1)
        return out

    def _best(self, q: np.ndarray, row: np.ndarray, score: np.ndarray, k: int) -> tuple:
        order = np.lexsort((self.ids[row], -score, q))
        q, row, score = q[order], row[order], score[order]
        begins = np.flatnonzero(np.diff(q, prepend=-1))
        rank = np.arange(len(q)) - np.repeat(begins, np.diff([*begins, len(q)]))
        return q[rank < k], row[rank < k], score[rank < k]


def _good(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """``_id`` and ``_v`` of the vectors that take part."""
    there = F.col(id_column).isNotNull() & whole_vector(vector_column)
    nonzero = F.exists(F.col(vector_column), lambda x: x != 0)
    return vectors.where(there & nonzero).select(
        F.col(id_column).cast("long").alias("_id"), F.col(vector_column).cast("array<double>").alias("_v")
    )


def _pieces(count: Column, size: int) -> Column:
    return F.ceil(count / F.lit(size)).cast("long")


def nearest(
    spark: SparkSession,
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 20,
    sure: float = SURE,
    projections: int = PROJECTIONS,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of ``vectors`` for every row of ``queries``.

    Nearest is the largest inner product, in doubles; ties go to the smaller id.  Every
    true neighbour is found with probability ``sure`` or more.  Vectors that are null,
    zero, or hold null or non-finite components, and rows without id, take no part.  A
    query's candidates are the rows with another id; repeated rows count each; queries
    repeated with one id are asked once, with their least vector.  Shorter vectors end
    with zeros.  With ``k`` candidates or fewer all are returned; empty tables give no
    rows.  Other columns are not read.  ``projections`` is even.
    """
    rows = _good(vectors, id_column, vector_column)
    asked = _good(queries, id_column, vector_column).groupBy("_id").agg(F.min("_v").alias("_v"))
    squares = F.aggregate("_v", F.lit(0.0), lambda s, x: s + x * x)
    facts = rows.agg(F.max(F.size("_v")).alias("width"), F.max(squares).alias("longest"), F.count(F.lit(1)).alias("n"))
    width, longest, n = facts.first()
    asked_width = asked.agg(F.max(F.size("_v"))).first()[0]
    if not n or not asked_width:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    width = max(width, asked_width)
    directions = np.random.default_rng(SEED).normal(size=(width + 1, projections))
    space = Space(directions, float(longest), chi_square_at(sure, projections))

    # the smallest hashes: the same sample on every run
    by_hash = rows.orderBy(F.xxhash64("_id", F.lit(SEED)), "_id", "_v")
    sample = by_hash.limit(max(1, SAMPLE_VALUES // width)).select("_v").toArrow()
    n_cells = min(CELLS, -(-n // SEGMENT))
    top = Tree(space.project(list_matrix(sample.column("_v"), width)), -(-sample.num_rows // n_cells))
    low, high = top.regions()

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = top.leaf_of(space.project(list_matrix(batch.column("_v"), width)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], names=["_id", "_v", "_cell"])

    cells = written(spark, rows.mapInArrow(dealt, "_id long, _v array<double>, _cell long"), "neighbour-cells")
    # at most CELLS rows
    sizes = cells.groupBy("_cell").agg(_pieces(F.count(F.lit(1)), SEGMENT).alias("_pieces"))
    salt = F.pmod(F.xxhash64("_id", F.to_json("_v"), F.monotonically_increasing_id()), F.col("_pieces"))

    def packed(key: tuple, table: pa.Table) -> pa.Table:
        built = Segment.build(table.column("_id").to_numpy(), list_matrix(table.column("_v"), width), space)
        place = [pa.array([part.as_py()], pa.int64()) for part in key]
        arrays = [pa.array([a], pa.binary()) for a in built.packed()]
        return pa.table([*place, *arrays], names=["_cell", "_piece", *(f"_{name}" for name in _ARRAYS)])

    segments = written(
        spark,
        cells.join(F.broadcast(sizes), "_cell")
        .withColumn("_piece", salt)
        .groupBy("_cell", "_piece")
        .applyInArrow(packed, _SEGMENT),
        "neighbour-segments",
    )

    def visits(first: bool):
        """Cells that a query looks into: its own, or all others that the test does not rule out."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for table in gathered(batches, BLOCK):
                points = space.project_queries(list_matrix(table.column("_v"), width))
                home = top.leaf_of(points)
                bounds = table.column("_bound").to_numpy()
                if first:
                    row, cell = np.arange(len(points)), home
                else:
                    lengths = (list_matrix(table.column("_v"), width) ** 2).sum(axis=1) + space.longest
                    reach = space.stop * np.maximum(0.0, lengths - 2 * bounds)
                    open_ = [np.flatnonzero(apart(p, low, high) <= r) for p, r in zip(points, reach)]
                    open_ = [c[c != h] for c, h in zip(open_, home)]
                    row, cell = np.repeat(np.arange(len(points)), [len(c) for c in open_]), np.concatenate(open_)
                taken = table.take(pa.array(row))
                out = pa.table([*taken.columns, pa.array(cell, pa.int64())], names=["_id", "_v", "_bound", "_cell"])
                yield from out.to_batches()

        return run

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p in batch.to_pylist():
                segment = Segment.unpacked(p, width, projections)
                q_ids, bounds = unpack(p["_q_ids"], np.int64), unpack(p["_q_bounds"], np.float64)
                q_values = unpack(p["_q_values"], np.float64).reshape(len(q_ids), width)
                q, row, score = segment.search(q_ids, q_values, k, bounds, space)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q_ids[q]), pa.array(segment.ids[row]), pa.array(score)],
                    names=["query_id", "vec_id", "score"],
                )

    def blocked(key: tuple, table: pa.Table) -> pa.Table:
        return pa.table(
            {
                "_cell": pa.array([key[0].as_py()], pa.int64()),
                "_q_ids": pa.array([pack(table.column("_id").to_numpy())], pa.binary()),
                "_q_bounds": pa.array([pack(table.column("_bound").to_numpy())], pa.binary()),
                "_q_values": pa.array([pack(list_matrix(table.column("_v"), width))], pa.binary()),
            }
        )

    blocks = max(1, -(-queries.count() // BLOCK))

    def found(bounded: DataFrame, first: bool) -> DataFrame:
        pairs = bounded.mapInArrow(visits(first), "_id long, _v array<double>, _bound double, _cell long")
        grouped = pairs.groupBy("_cell", F.pmod(F.xxhash64("_id"), F.lit(blocks)).alias("_block")).applyInArrow(
            blocked, "_cell long, _q_ids binary, _q_bounds binary, _q_values binary"
        )
        pieces = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_pieces") - 1)).alias("_piece")
        calls = grouped.join(F.broadcast(sizes), "_cell").select("*", pieces).drop("_pieces")
        return calls.join(segments, ["_cell", "_piece"]).drop("_cell", "_piece").mapInArrow(search, _FOUND)

    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def best(hits: DataFrame) -> DataFrame:
        return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    unbounded = asked.withColumn("_bound", F.lit(float("-inf")))
    home = written(spark, best(found(unbounded, True)).drop("rank"), "neighbour-home")
    # a query with fewer than k hits at home has no bound yet
    bound = home.groupBy("query_id").agg(F.when(F.count(F.lit(1)) == k, F.min("score")).alias("_bound"))
    bounded = asked.join(bound, F.col("_id") == F.col("query_id"), "left").select(
        "_id", "_v", F.coalesce("_bound", F.lit(float("-inf"))).alias("_bound")
    )
    everything = home.unionByName(found(bounded, False)) if len(low) > 1 else home
    return best(everything).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
