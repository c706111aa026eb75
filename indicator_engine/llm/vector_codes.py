"""Vector code compression: one codebook for each part of a vector, a code byte a part.

Components become integers, ``floor(scale * x)``, and a vector is cut into equal parts.
Codebooks start from the vectors with the smallest ids and move in rounds: every part goes
to the nearest entry, every entry to the floor of the mean of its parts.

Distances are worked out on a trie.  The distinct parts of a chunk, in lexicographic
order, are the leaves of a trie with a dimension a level; a node holds the distances from
its prefix to all entries, added up so far, and its children share them.  The trie is
walked depth first; a subtree of at most ``SUBTREE`` leaves is done level by level at
once, which bounds the memory of the walk.  Leaves take the smallest distance and, in a
round, add their part times its copies to the entry's sum.

A task reads its share of the vectors and returns the sums of its entries only, so no
round moves a vector; the driver holds the codebooks, ``entries x width`` integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from indicator_engine.llm.common import gathered, list_matrix, whole_vector, written

SCALE = 256
PARTS = 16
ENTRIES = 64
ROUNDS = 2
SUBTREE = 4096
CHUNK_VALUES = 4 << 20


@dataclass(frozen=True)
class Codebooks:
    """``values[part, entry, dimension]``; without vectors there are no entries."""

    values: np.ndarray
    scale: int = SCALE

    @property
    def width(self) -> int:
        return self.values.shape[0] * self.values.shape[2]

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.values.ravel().tolist())).encode()).hexdigest()


def integers(column: pa.Array, width: int, scale: int) -> np.ndarray:
    return np.floor(list_matrix(column, width) * scale).astype(np.int64)


def nearest(leaves: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entry (ties: the first) and squared distance for distinct parts in lexicographic order."""
    entry = np.zeros(len(leaves), np.int64)
    distance = np.zeros(len(leaves), np.int64)
    last = leaves.shape[1]

    def descend(low: int, high: int, depth: int, shared: np.ndarray) -> None:
        if high - low <= SUBTREE or depth == last:
            at_once(low, high, depth, shared)
            return
        values = leaves[low:high, depth]
        starts = np.flatnonzero(np.diff(values, prepend=values[0] - 1)) + low
        for start, end in zip(starts, [*starts[1:], high]):
            descend(start, end, depth + 1, shared + (leaves[start, depth] - book[:, depth]) ** 2)

    def at_once(low: int, high: int, depth: int, shared: np.ndarray) -> None:
        rows = leaves[low:high]
        nodes, begins = shared[None], np.arange(high - low) == 0
        for level in range(depth, last):
            parent = np.cumsum(begins) - 1
            begins = begins | (np.diff(rows[:, level], prepend=rows[0, level]) != 0)
            at = np.flatnonzero(begins)
            nodes = nodes[parent[at]] + (rows[at, level][:, None] - book[:, level]) ** 2
        entry[low:high] = nodes.argmin(axis=1)
        distance[low:high] = nodes.min(axis=1)

    if len(leaves):
        descend(0, len(leaves), 0, np.zeros(len(book), np.int64))
    return entry, distance


def _kept(vectors: DataFrame, vector_column: str) -> DataFrame:
    return vectors.where(whole_vector(vector_column))


def _chunk(width: int) -> int:
    return max(1, CHUNK_VALUES // max(1, width))


def learn(
    vectors: DataFrame,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> Codebooks:
    """Codebooks fitted on all vectors that are not null and hold neither null nor non-finite components.

    The starting entries are the parts of the first ``entries`` vectors by id (null last)
    and, for a repeated id, by their values; of fewer vectors there are fewer entries.
    An entry no part is assigned to stays.  Shorter vectors end with zeros, and the
    width is filled up to a multiple of ``parts``.  Sums must fit a long.
    """
    rows = _kept(vectors, vector_column).select(F.col(id_column).alias("_id"), F.col(vector_column).alias("_v"))
    longest = rows.agg(F.max(F.size("_v"))).first()[0] or 0
    size = -(-longest // parts)
    first = rows.orderBy(F.col("_id").asc_nulls_last(), "_v").limit(entries).collect()
    start = integers(pa.array([r["_v"] for r in first], pa.list_(pa.float64())), parts * size, scale)
    books = start.reshape(len(first), parts, size).transpose(1, 0, 2).copy()

    for _ in range(rounds if books.size else 0):
        held = books  # the function below is sent with the books of this round

        def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums, counts = np.zeros_like(held), np.zeros(held.shape[:2], np.int64)
            for table in gathered(batches, _chunk(parts * size)):
                values = integers(table.column("_v"), parts * size, scale).reshape(-1, parts, size)
                for p in range(parts):
                    leaves, copies = np.unique(values[:, p], axis=0, return_counts=True)
                    entry, _ = nearest(leaves, held[p])
                    np.add.at(sums[p], entry, leaves * copies[:, None])
                    np.add.at(counts[p], entry, copies)
            p, e = np.nonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(p, size)),
                    pa.array(np.repeat(e, size)),
                    pa.array(np.tile(np.arange(size), len(p))),
                    pa.array(np.repeat(counts[p, e], size)),
                    pa.array(sums[p, e].ravel()),
                ],
                names=["part", "entry", "dimension", "n", "total"],
            )

        moved = rows.select("_v").mapInArrow(add_up, "part long, entry long, dimension long, n long, total long")
        # at most entries x width rows
        means = moved.groupBy("part", "entry", "dimension").agg(
            F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")
        )
        books = books.copy()
        for r in means.collect():
            books[r["part"], r["entry"], r["dimension"]] = int(r["total"]) // r["n"]
    return Codebooks(books, scale)


def encode(
    vectors: DataFrame, books: Codebooks, carry: Sequence[str] = ("vec_id",), vector_column: str = "embedding"
) -> DataFrame:
    """``carry`` columns, ``code`` (binary, a byte a part) and ``error`` (squared distances added up).

    Vectors that are null or hold null or non-finite components are dropped; repeated rows
    stay as often as they come, null ids stay.  Books without entries give no rows.
    """
    values, scale, width = books.values, books.scale, books.width
    if values.shape[1] > 256:
        raise ValueError("a code byte names at most 256 entries")
    names = [f"_c{i}" for i in range(len(carry))]  # apart from the names used here
    rows = _kept(vectors, vector_column).select(
        *(F.col(c).alias(n) for c, n in zip(carry, names)), F.col(vector_column).alias("_v")
    )
    if not values.shape[1]:
        rows = rows.where("false")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in gathered(batches, _chunk(width)):
            cut = integers(table.column("_v"), width, scale).reshape(table.num_rows, len(values), -1)
            codes = np.zeros(cut.shape[:2], np.uint8)
            errors = np.zeros(len(cut), np.int64)
            for p in range(len(values)):
                leaves, row = np.unique(cut[:, p], axis=0, return_inverse=True)
                entry, distance = nearest(leaves, values[p])
                codes[:, p] = entry[row]
                errors += distance[row]
            out = [table.column(n).combine_chunks() for n in names]
            code = pa.array([c.tobytes() for c in codes], pa.binary())
            yield from pa.table([*out, code, pa.array(errors)], names=[*names, "code", "error"]).to_batches()

    schema = T.StructType(
        [*rows.schema.fields[:-1], T.StructField("code", T.BinaryType()), T.StructField("error", T.LongType())]
    )
    done = rows.mapInArrow(run, schema)
    return done.select(*(F.col(n).alias(c) for n, c in zip(names, carry)), "code", "error")


def decode(codes: DataFrame, books: Codebooks, code_column: str = "code") -> DataFrame:
    """``codes`` with ``approximate``: the vector that the code's entries make, scaled back; a null code gives null."""
    entries = F.lit([[e.tolist() for e in part] for part in books.values])
    byte = lambda p: F.conv(F.hex(F.substring(code_column, p + 1, 1)), 16, 10).cast("int")
    picked = [F.get(F.get(entries, F.lit(p)), byte(p)) for p in range(len(books.values))]
    flat = F.transform(F.flatten(F.array(*picked)), lambda x: x / F.lit(float(books.scale)))
    return codes.withColumn("approximate", F.when(F.col(code_column).isNotNull(), flat))


def compress(
    spark: SparkSession, vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding",
    label_column: str = "label",
) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256``: a row for every vector that takes part.

    ``label_error`` is the error of all vectors of the label; null labels go together.
    The join takes the added-up errors, a row a label, to rows of a label that may hold
    most of them: adaptive execution splits it.  See ``learn`` and ``encode`` for nulls,
    ties, repeated rows and vectors of other lengths; an empty table gives no rows.
    """
    books = learn(vectors, id_column=id_column, vector_column=vector_column)
    coded = encode(vectors, books, [id_column, label_column], vector_column)
    coded = written(spark, coded.toDF("vec_id", "label", "code", "error"), "vector-codes")
    by_label = coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    joined = coded.join(by_label, F.col("label").eqNullSafe(F.col("_label")))
    return joined.select(
        F.col("vec_id").alias(id_column),
        F.lower(F.hex("code")).alias("code"),
        "error",
        "label_error",
        F.lit(books.sha256()).alias("codebooks_sha256"),
    )
