"""Token ids in compressed binary files: static-range asymmetric numeral systems.

One table of symbol frequencies, counted over the whole corpus and scaled to
``2 ** SCALE``, serves every block.  A block holds whole documents in ascending id
order; it is cut into segments of ``SEGMENT`` ids, and each segment is coded alone by
``LANES`` interleaved states.  The final states and the number of code words of a
segment are its checkpoint: any segment can be decoded without the others.  A CRC-32
over the ids of a block is verified when it is read.

Files are Parquet tables of blocks, so Spark's commit protocol replaces the output of
a lost task.  The documents before a block are known from its partition (range-
partitioned ids) and its offset in it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from indicator_engine.llm.common import pack, parts_for, slices, unpack, worker_wide
from indicator_engine.llm.token_counts import Memo, Tokenizer, text_groups
from indicator_engine.session import shared_folder

SCALE = 20
LANES = 32
SEGMENT = 1 << 15
#: segments coded side by side
BATCH = 160
_LOW = np.uint64(1 << 31)
_WORD = np.uint64(32)
_SCALE = np.uint64(SCALE)

_ENCODED = "_id long, _n long, _ids binary"
_BLOCK = (
    "part int, seq int, first_token long, n_tokens long, doc_ids array<long>, doc_tokens array<long>, "
    "seg_words array<int>, states binary, words binary, crc32 long"
)


# ---- the coder ---------------------------------------------------------------


def scaled(counts: np.ndarray) -> np.ndarray:
    """Frequencies that sum to ``2 ** SCALE`` and are positive where a count is."""
    present = np.flatnonzero(counts)
    freq = np.zeros(len(counts), np.uint64)
    if len(present):
        room = (1 << SCALE) - len(present)
        freq[present] = 1 + (counts[present].astype(np.float64) / counts.sum() * room).astype(np.uint64)
        freq[present[np.argmax(counts[present])]] += np.uint64((1 << SCALE) - int(freq.sum()))
    return freq


class Coder:
    def __init__(self, freq: np.ndarray):
        self.freq = freq.astype(np.uint64)
        self.start = np.concatenate([[0], np.cumsum(self.freq)[:-1]]).astype(np.uint64)
        self.symbol = np.repeat(np.arange(len(freq), dtype=np.uint32), freq.astype(np.int64))

    def encode(self, segments: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each segment its final states and its code words in reading order."""
        steps = -(-max(map(len, segments)) // LANES)
        symbols = np.zeros((len(segments), steps * LANES), np.int32)
        for row, ids in zip(symbols, segments):
            row[: len(ids)] = ids
        lengths = np.array([len(s) for s in segments])[:, None]
        shape = (len(segments), steps, LANES)
        symbols = symbols.reshape(shape)
        state = np.full((len(segments), LANES), _LOW, np.uint64)
        words, sent = np.zeros(shape, np.uint32), np.zeros(shape, bool)
        lane = np.arange(LANES)
        for t in range(steps - 1, -1, -1):
            valid = t * LANES + lane < lengths
            f, c = self.freq[symbols[:, t]], self.start[symbols[:, t]]
            f = np.where(valid, f, np.uint64(1))
            over = valid & (state >= f << np.uint64(63 - SCALE))
            words[:, t] = state.astype(np.uint32)
            sent[:, t] = over
            state = np.where(over, state >> _WORD, state)
            high = state // f
            state = np.where(valid, (high << _SCALE) + (state - high * f) + c, state)
        return [(state[i], words[i][sent[i]]) for i in range(len(segments))]

    def decode(self, lengths: list[int], states: list[np.ndarray], words: list[np.ndarray]) -> list[np.ndarray]:
        n, steps = len(lengths), -(-max(lengths) // LANES)
        state = np.stack(states).astype(np.uint64)
        flat = np.concatenate([*words, np.zeros(1, np.uint32)]).astype(np.uint64)
        at = np.concatenate([[0], np.cumsum([len(w) for w in words])[:-1]])
        size = np.array(lengths)[:, None]
        out = np.zeros((n, steps, LANES), np.uint32)
        lane, low = np.arange(LANES), np.uint64((1 << SCALE) - 1)
        for t in range(steps):
            valid = t * LANES + lane < size
            slot = state & low
            symbol = self.symbol[slot]
            out[:, t] = symbol
            state = np.where(valid, self.freq[symbol] * (state >> _SCALE) + slot - self.start[symbol], state)
            need = valid & (state < _LOW)
            rank = np.cumsum(need, axis=1)
            read = np.where(need, at[:, None] + rank - 1, len(flat) - 1)
            state = np.where(need, (state << _WORD) | flat[read], state)
            at = at + rank[:, -1]
        return [row.reshape(-1)[:length] for row, length in zip(out, lengths)]


def _cut(ids: np.ndarray) -> list[np.ndarray]:
    return [ids[i : i + SEGMENT] for i in range(0, len(ids), SEGMENT)]


# ---- Spark -------------------------------------------------------------------


def token_ids(docs: DataFrame, path: str, end_id: int, id_column: str, text_column: str) -> DataFrame:
    """``_id``, number of ids, ids as unsigned 32-bit integers (compressed); null text is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = f"ids {path}"
        tokenizer = worker_wide(path, lambda: Tokenizer(path), group)
        memo = Memo(tokenizer.pieces, name=path, group=group)
        end = np.array([end_id], "<u4").tobytes()
        for batch in slices(batches):
            sizes, data = [], []
            for group in text_groups(batch.column("_text")):
                for ids in tokenizer.ids_of(group, memo):
                    sizes.append(len(ids) + 1)
                    data.append(_packed(ids.tobytes() + end))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), pa.array(sizes, pa.int64()), pa.array(data, pa.binary())],
                names=["_id", "_n", "_ids"],
            )

    rows = docs.select(F.col(id_column).cast("long").alias("_id"), F.col(text_column).cast("string").alias("_text"))
    return rows.mapInArrow(run, _ENCODED)


def _packed(ids: bytes) -> bytes:
    """Low and high halves apart, as 16-bit planes: the second is mostly zero."""
    return pack(np.frombuffer(ids, "<u2").reshape(-1, 2).T)


def _unpacked(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(unpack(data, "<u2").reshape(2, -1).T).view("<u4").ravel()


def _symbol_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(0, np.int64)
    for batch in slices(batches):
        own = np.bincount(np.concatenate([_unpacked(data) for data in batch.column("_ids").to_pylist()]))
        if len(own) > len(counts):
            own[: len(counts)] += counts
            counts = own
        else:
            counts[: len(own)] += own
    found = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays(
        [pa.array(found, pa.int64()), pa.array(counts[found], pa.int64())], names=["symbol", "n"]
    )


def _writer(freq: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part = Coder(freq), TaskContext.get().partitionId()
        blocks: list[tuple[list, list, np.ndarray]] = []
        ids: list = []
        data: list[np.ndarray] = []
        held = seq = first = segments = 0

        def close() -> None:
            nonlocal ids, data, held, segments
            if ids:
                blocks.append((ids, [len(d) for d in data], np.concatenate(data)))
                segments += -(-held // SEGMENT)
            ids, data, held = [], [], 0

        def coded() -> pa.RecordBatch:
            nonlocal seq, first, segments
            cuts = [_cut(b[2]) for b in blocks]
            flat = [s for c in cuts for s in c]
            done = iter([x for i in range(0, len(flat), BATCH) for x in coder.encode(flat[i : i + BATCH])])
            rows = []
            for (doc_ids, sizes, whole), cut in zip(blocks, cuts):
                states, words = zip(*(next(done) for _ in cut))
                rows.append(
                    {
                        "part": part,
                        "seq": seq,
                        "first_token": first,
                        "n_tokens": len(whole),
                        "doc_ids": doc_ids,
                        "doc_tokens": sizes,
                        "seg_words": [len(w) for w in words],
                        "states": np.stack(states).astype("<u8").tobytes(),
                        "words": np.concatenate(words).astype("<u4").tobytes(),
                        "crc32": zlib.crc32(whole.astype("<u4").tobytes()),
                    }
                )
                seq += 1
                first += len(whole)
            blocks.clear()
            segments = 0
            return pa.RecordBatch.from_pylist(rows, schema=_BLOCK_ARROW)

        for batch in batches:
            for i, packed in zip(batch.column("_id").to_pylist(), batch.column("_ids").to_pylist()):
                own = _unpacked(packed)
                if held + len(own) > SEGMENT:
                    close()
                ids.append(i)
                data.append(own)
                held += len(own)
                if segments >= BATCH:
                    yield coded()
        close()
        if blocks:
            yield coded()

    return run


_BLOCK_ARROW = pa.schema(
    [
        ("part", pa.int32()),
        ("seq", pa.int32()),
        ("first_token", pa.int64()),
        ("n_tokens", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("doc_tokens", pa.list_(pa.int64())),
        ("seg_words", pa.list_(pa.int32())),
        ("states", pa.binary()),
        ("words", pa.binary()),
        ("crc32", pa.int64()),
    ]
)


def write_token_files(
    spark: SparkSession,
    docs: DataFrame,
    folder: str,
    path: str,
    end_id: int = 2,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> None:
    """Write ``<folder>/blocks`` (the coded ids) and ``<folder>/symbols`` (the shared table).

    Documents are in ascending id order, null ids first, repeated ids in the order of
    their tokens; each ends with ``end_id``.  A null text is empty.  An empty table
    gives empty files.  The symbol table has at most one row per vocabulary entry.
    """
    staged = f"{folder}/staged"
    token_ids(docs, path, end_id, id_column, text_column).write.parquet(staged)
    encoded = spark.read.schema(_ENCODED).parquet(staged)
    table = encoded.mapInArrow(_symbol_counts, "symbol long, n long").groupBy("symbol").agg(F.sum("n").alias("n"))
    rows = table.toPandas()  # bounded by the vocabulary
    counts = np.zeros(int(rows["symbol"].max()) + 1 if len(rows) else 1, np.int64)
    counts[rows["symbol"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
    freq = scaled(counts)
    kept = np.flatnonzero(freq)
    spark.createDataFrame(
        [(int(s), int(freq[s])) for s in kept], "symbol long, freq long"
    ).coalesce(1).write.parquet(f"{folder}/symbols")
    ordered = encoded.repartitionByRange(parts_for(encoded, 16, 4, grow=16), "_id").sortWithinPartitions("_id", "_n", "_ids")
    ordered.mapInArrow(_writer(freq), _BLOCK).write.parquet(f"{folder}/blocks")


def read_token_files(spark: SparkSession, folder: str, id_column: str = "doc_id", ids: bool = True) -> DataFrame:
    """One row per document: id, ``start``, ``n_tokens``, ``ids_crc32`` and, if asked for, ``ids``.

    A block whose ids do not give its checksum stops the read.
    """
    rows = spark.read.schema("symbol long, freq long").parquet(f"{folder}/symbols").toPandas()  # a vocabulary
    freq = np.zeros(int(rows["symbol"].max()) + 1 if len(rows) else 1, np.uint64)
    freq[rows["symbol"].to_numpy(np.int64)] = rows["freq"].to_numpy(np.uint64)
    blocks = spark.read.schema(_BLOCK).parquet(f"{folder}/blocks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(freq)
        for batch in batches:
            for from_ in range(0, batch.num_rows, BATCH):
                yield _documents(coder, batch.slice(from_, BATCH).to_pylist(), ids)

    schema = "part int, _id long, _in_part long, n_tokens long, ids_crc32 long" + ", ids array<long>" * ids
    read = blocks.mapInArrow(run, schema)
    # one row per written partition
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = blocks.groupBy("part").agg(F.sum("n_tokens").alias("_n"))
    parts = parts.select("part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return read.join(F.broadcast(parts), "part").select(
        F.col("_id").alias(id_column),
        (F.col("_before") + F.col("_in_part")).alias("start"),
        "n_tokens",
        "ids_crc32",
        *["ids"] * ids,
    )


def _documents(coder: Coder, blocks: list[dict], with_ids: bool) -> pa.RecordBatch:
    lengths, states, words = [], [], []
    for b in blocks:
        full, last = divmod(b["n_tokens"], SEGMENT)
        own = [SEGMENT] * full + [last] * bool(last)
        lengths += own
        states += list(np.frombuffer(b["states"], "<u8").reshape(len(own), LANES))
        words += np.split(np.frombuffer(b["words"], "<u4"), np.cumsum(b["seg_words"])[:-1])
    done = iter(
        [
            x
            for i in range(0, len(lengths), BATCH)
            for x in coder.decode(lengths[i : i + BATCH], states[i : i + BATCH], words[i : i + BATCH])
        ]
    )
    out: dict[str, list] = {c: [] for c in ("part", "_id", "_in_part", "n_tokens", "ids_crc32", *["ids"] * with_ids)}
    for b in blocks:
        ids = np.concatenate([next(done) for _ in b["seg_words"]]).astype("<u4")
        if zlib.crc32(ids.tobytes()) != b["crc32"]:
            raise ValueError(f"checksum of block {b['part']}/{b['seq']} does not match")
        at = 0
        for i, n in zip(b["doc_ids"], b["doc_tokens"]):
            out["part"].append(b["part"])
            out["_id"].append(i)
            out["_in_part"].append(b["first_token"] + at)
            out["n_tokens"].append(n)
            out["ids_crc32"].append(zlib.crc32(ids[at : at + n].tobytes()))
            if with_ids:
                out["ids"].append(ids[at : at + n].astype(np.int64))
            at += n
    kinds = {"part": pa.int32(), "ids": pa.list_(pa.int64())}
    return pa.RecordBatch.from_arrays(
        [pa.array(v, kinds.get(c, pa.int64())) for c, v in out.items()], names=list(out)
    )


def token_files(spark: SparkSession, docs: DataFrame, path: str, **options) -> DataFrame:
    """Write the files below ``spark.checkpoint.dir`` and read them back, without the ids themselves."""
    folder = shared_folder(spark, "token-files")
    write_token_files(spark, docs, folder, path, **options)
    return read_token_files(spark, folder, options.get("id_column", "doc_id"), ids=False)
