"""Helpers shared by the corpus operators."""

from __future__ import annotations

import math
import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from indicator_engine.session import shared_folder

#: the six characters that end a word (Java and DuckDB spelling of the same class)
SPACE = r"[\x20\x09-\x0D]+"

#: statistics of this size are Spark's default for "not known", or a guess at a join
UNKNOWN = 1 << 55

#: stored input beyond which pieces that a task streams become larger
GROWING = 4 << 30
WORD = r"[^\x20\x09-\x0D]+"


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def row_key(id_column: str = "doc_id", text: str = "text") -> Column:
    """Key of a row that also tells rows of one id with other texts apart."""
    return F.xxhash64(F.col(id_column), F.col(text))


def pack(values: np.ndarray) -> bytes:
    """Array to compressed bytes; the dtype is the reader's to know."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values).tobytes())


def unpack(data: bytes, dtype) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=dtype)


def pack_sorted(values: np.ndarray) -> bytes:
    """Ascending uint64 values as differences, one byte plane after the other."""
    steps = np.diff(values, prepend=np.uint64(0)) if len(values) else values
    planes = np.ascontiguousarray(steps.astype("<u8")).view(np.uint8).reshape(-1, 8).T
    return pack(planes)


def unpack_sorted(data: bytes) -> np.ndarray:
    planes = unpack(data, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=np.uint64)


def input_bytes(frame: DataFrame) -> int | None:
    """Size by the optimizer's statistics (file sizes of a table); None where there are none."""
    size = int(str(frame._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size if size < UNKNOWN else None


def piece_bytes(size: int, mb: int, grow: int = 1) -> int:
    """Stored bytes of a piece: ``mb`` MB, and with ``grow`` up to as many times that, by the root of the input.

    Up to 4 GB of input pieces stay as they are; beyond, pieces and their number grow alike.
    """
    return int((mb << 20) * min(grow, max(1.0, math.sqrt(size / GROWING))))


def parts_for(frame: DataFrame, mb: int, least: int = 1, grow: int = 1) -> int:
    """Number of pieces of about ``mb`` MB of stored input (see ``piece_bytes``), or what the session sets where its size is unknown."""
    size = input_bytes(frame)
    if size is None:
        return max(least, int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return max(least, math.ceil(size / piece_bytes(size, mb, grow)))


def written(spark: SparkSession, frame: DataFrame, label: str) -> DataFrame:
    """The frame as a table in the shared folder: cuts lineage, survives lost executors."""
    path = shared_folder(spark, label)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def worker_wide(name: str, make: Callable, group: str | None = None):
    """A value that later tasks of the same Python worker find again.

    A worker holds the values of one group (by default the name is one): those of
    another stage or model go when a task asks for the first of its own.
    """
    holder = _of_group(group or name)
    if name not in holder:
        holder[name] = make()
    return holder[name]


def release_worker_values() -> None:
    """For tasks that hold none: let go of what tasks of other stages have left in this worker."""
    _of_group("")


def _of_group(group: str) -> dict:
    holder = vars(sys.modules.setdefault("corpus_worker_values", types.ModuleType("corpus_worker_values")))
    if holder.get("group") != group:
        holder["group"], holder["values"] = group, {}
        give_back()
    return holder["values"]


def give_back() -> None:
    """Return free memory to the machine: a worker that waits for its next stage otherwise keeps it."""
    pa.default_memory_pool().release_unused()
    pa.system_memory_pool().release_unused()


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The batches in smaller parts, so that what is made of a part stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts of an Arrow string column as one byte array, and their offsets; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, dtype="<i8")[column.offset : column.offset + len(column) + 1]
    buffer = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return buffer[ends[0] : ends[-1]] if len(ends) else buffer, ends - ends[0] if len(ends) else ends


def whole_vector(column: str) -> Column:
    """The vector is there, without null and non-finite components."""
    v = F.col(column)
    return v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def list_matrix(column: pa.Array, width: int, dtype=np.float64) -> np.ndarray:
    """An Arrow column of number lists as a matrix; shorter lists end with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(sizes), width), dtype)
    out[np.arange(width) < sizes[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def gathered(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """The batches put together to tables of about ``rows`` rows."""
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield pa.Table.from_batches(held).combine_chunks()
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held).combine_chunks()
