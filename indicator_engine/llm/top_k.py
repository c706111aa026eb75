"""Exact top-k by inner product on a bit-sliced index.

Vectors become integers, ``floor(scale * x)``.  A segment of the index keeps, for each
attribute and each binary digit, one bitmap over its rows.  The score of all rows of a
segment is added up on those bitmaps: a weight is a sum of powers of two, so each
digit of a weight adds the attribute's slices at a shifted place; full adders turn
three bitmaps of one place into one of it and one of the next.  A negative weight takes
complemented slices and a constant.  The k best rows are chosen from the most
significant slice of the sum downward; rows tied at the boundary are resolved by
smaller id, and the chosen rows are scored again from the integers.

Segments hold ``SEGMENT_ROWS`` rows and queries come in blocks of ``BLOCK``.  A segment is
sent once for every ``SPAN`` blocks, and the blocks follow it as rows sorted behind it: its
bitmaps are made once and the blocks stream past them, so memory holds one segment and a
few blocks whatever the size of either table, and a task's work is bounded too.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from indicator_engine.llm.common import pack, slices, unpack

SEGMENT_ROWS = 16_384
BLOCK = 512
#: blocks that one copy of a segment answers
SPAN = 16
SCALE = 256

_SEGMENT = "_segment long, _ids binary, _width int, _values binary"


def _integers(vectors: DataFrame, id_column: str, vector_column: str, scale: int) -> DataFrame:
    """``_id`` and ``_v`` (array of longs) of the vectors that take part."""
    v = F.col(vector_column)
    good = F.col(id_column).isNotNull() & v.isNotNull() & F.forall(
        v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    whole = F.transform(v, lambda x: F.floor(x.cast("double") * scale))
    return vectors.where(good).select(F.col(id_column).cast("long").alias("_id"), whole.alias("_v"))


def _matrix(column: pa.ListArray) -> np.ndarray:
    """Rows of different length are filled with zeros."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    width = int(sizes.max()) if len(sizes) else 0
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def _segments(key: tuple, table: pa.Table) -> pa.Table:
    table = table.combine_chunks()
    values = _matrix(table.column("_v").combine_chunks())
    return pa.table(
        {
            "_segment": pa.array([key[0].as_py()], pa.int64()),
            "_ids": pa.array([pack(table.column("_id").to_numpy())], pa.binary()),
            "_width": pa.array([values.shape[1]], pa.int32()),
            "_values": pa.array([pack(values)], pa.binary()),
        }
    )


class Slices:
    """Bitmaps over the rows of a segment: attribute a, digit b is row ``a * digits + b``."""

    def __init__(self, ids: np.ndarray, values: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.values = ids[order], values[order]
        self.rows, self.width = values.shape
        self.least = self.values.min(axis=0) if self.rows else np.zeros(self.width, np.int64)
        raised = (self.values - self.least).astype(np.uint64)
        self.digits = max(1, int(raised.max(initial=0)).bit_length())
        self.words = max(1, -(-self.rows // 64))
        bits = np.zeros((self.width, self.digits, self.words * 64), np.uint8)
        for b in range(self.digits):
            bits[:, b, : self.rows] = ((raised >> np.uint64(b)) & np.uint64(1)).T
        plain = self.bitmap(bits.reshape(self.width * self.digits, -1))
        self.slices = np.concatenate([plain, ~plain])  # complements follow
        self.all = self.bitmap((np.arange(self.words * 64) < self.rows).astype(np.uint8)[None])[0]

    @staticmethod
    def bitmap(bits: np.ndarray) -> np.ndarray:
        return np.packbits(bits, axis=-1, bitorder="little").view("<u8")

    def sums(self, query: np.ndarray) -> list[np.ndarray]:
        """Slices, least significant first, of the score plus a constant of the query."""
        weight, flip = np.abs(query), (query < 0) * (self.width * self.digits)
        places: dict[int, list[np.ndarray]] = {}
        for j in range(int(weight.max(initial=0)).bit_length()):
            rows = np.flatnonzero((weight >> j) & 1)
            for b in range(self.digits):
                places.setdefault(j + b, []).append(flip[rows] + rows * self.digits + b)
        out, carried = [], []
        place = 0
        while place <= max(places, default=-1) or carried:
            chosen = [self.slices[np.concatenate(places[place])]] if place in places else []
            stack = np.concatenate([*chosen, *carried]) if chosen or carried else np.zeros((0, self.words), "<u8")
            carried = []
            while len(stack) > 1:
                if len(stack) == 2:
                    a, b = stack
                    carried.append((a & b)[None])
                    stack = (a ^ b)[None]
                else:
                    n = len(stack) // 3
                    a, b, c = stack[:n], stack[n : 2 * n], stack[2 * n : 3 * n]
                    half = a ^ b
                    carried.append((a & b) | (c & half))
                    stack = np.concatenate([half ^ c, stack[3 * n :]])
            out.append(stack[0] if len(stack) else np.zeros(self.words, "<u8"))
            place += 1
        return out

    def best(self, query: np.ndarray, k: int, skip: int) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers and scores of the k best rows other than those with id ``skip``."""
        query = np.concatenate([query, np.zeros(max(0, self.width - len(query)), np.int64)])[: self.width]
        tied = self.all.copy()
        for row in range(np.searchsorted(self.ids, skip), np.searchsorted(self.ids, skip, "right")):
            tied[row // 64] &= ~(np.uint64(1) << np.uint64(row % 64))
        taken = np.zeros_like(tied)
        for digit in reversed(self.sums(query)):
            more = taken | (tied & digit)
            n = int(np.bitwise_count(more).sum())
            if n > k:
                tied &= digit
            else:
                taken = more
                tied = tied & ~digit
                if n == k:
                    tied[:] = 0
                    break
        sure, edge = self._rows(taken), self._rows(tied)
        rows = np.concatenate([sure, edge[: max(0, k - len(sure))]])  # rows are in order of id
        return rows, self.values[rows] @ query

    def _rows(self, bitmap: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 5,
    scale: int = SCALE,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best rows of ``vectors`` for every row of ``queries``.

    Vectors that are null, hold null or non-finite components, or have no id take no
    part.  A query's candidates are the rows with another id; ties go to the smaller
    id, repeated rows count each.  Shorter vectors end with zeros.  Queries repeated
    with one id are asked once, with their least vector.  Empty tables give no rows.
    Scores must fit a long.  Other columns are not read.
    """
    rows = _integers(vectors, id_column, vector_column, scale)
    asked = _integers(queries, id_column, vector_column, scale).groupBy("_id").agg(F.min("_v").alias("_v"))
    n_segments = max(1, -(-vectors.count() // SEGMENT_ROWS))
    n_blocks = max(1, -(-queries.count() // BLOCK))

    def dealt(frame: DataFrame, parts: int, salt: int) -> DataFrame:
        return frame.withColumn("_segment", F.pmod(F.xxhash64("_id", F.to_json(F.col("_v")), F.lit(salt)), F.lit(parts)))

    def packed(frame: DataFrame, parts: int, salt: int) -> DataFrame:
        return dealt(frame, parts, salt).groupBy("_segment").applyInArrow(_segments, _SEGMENT)

    def numbers(n: int):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))

    # a segment has block -1, so that it stands before the blocks of its span
    n_spans = -(-n_blocks // SPAN)
    index = packed(rows, n_segments, 1).withColumns({"_span": numbers(n_spans), "_block": F.lit(-1).cast("long")})
    blocks = packed(asked, n_blocks, 2).withColumnsRenamed({"_segment": "_block"})
    blocks = blocks.withColumn("_span", F.floor(F.col("_block") / SPAN)).withColumn("_segment", numbers(n_segments))
    # few keys of much work each: more partitions than keys, and none put together by their size
    parts = max(int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions")), n_segments * n_spans)
    dealt_out = index.unionByName(blocks).repartition(parts, "_segment", "_span")
    stream = dealt_out.sortWithinPartitions("_segment", "_span", "_block")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = held = None
        for p in (p for batch in slices(batches, 1) for p in batch.to_pylist()):
            ids = unpack(p["_ids"], np.int64)
            values = unpack(p["_values"], np.int64).reshape(len(ids), p["_width"])
            if p["_block"] < 0:
                part, held = Slices(ids, values), (p["_segment"], p["_span"])
                continue
            if held != (p["_segment"], p["_span"]):
                continue  # a segment without rows
            found = [(i, *part.best(q, k, i)) for i, q in zip(ids, values)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat([f[0] for f in found], [len(f[1]) for f in found]), pa.int64()),
                    pa.array(np.concatenate([part.ids[f[1]] for f in found]), pa.int64()),
                    pa.array(np.concatenate([f[2] for f in found]), pa.int64()),
                ],
                names=["query_id", "vec_id", "score"],
            )

    best = stream.mapInArrow(search, "query_id long, vec_id long, score long")
    ranked = best.withColumn("rank", F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
