"""Removal of long byte strings that already occur in a document with a smaller id.

Prefix-free parsing, spread over a cluster.  A rolling hash runs over all strings of
``TRIGGER`` bytes; the smallest hash inside a window of ``length`` bytes is the window's
trigger.  Consecutive windows with one trigger form a phrase (phrases overlap by
``length - 1`` bytes), so every window lies in one phrase of the parse, and equal
windows, wherever they are, lie in phrases with equal triggers.

1. The documents are packed into chunks, written once.
2. Triggers that occur in one document only cannot hold a repeat.  Every chunk sends its
   triggers, sorted and packed, to buckets by hash; a bucket answers each chunk with
   those seen in several documents.
3. Chunks send the dictionary of their remaining phrases: distinct phrase, smallest id,
   places (the parse).  A bucket merges the dictionaries.  Where a trigger has one
   phrase, all its windows first occur in the phrase's smallest id.  Where it has several,
   the suffix array of the dictionary, sorted to depth ``length`` by prefix doubling,
   puts equal windows next to each other.  The parse carries the smallest ids back to
   the places.
   Phrases of a trigger with more than ``HOT_BYTES`` bytes in all chunks are not sent:
   each chunk deals their distinct windows, as 128-bit hashes with the smallest id, to
   buckets by that hash.  There the smallest ids of equal windows meet.
4. Chunks take the spans found and cut them out; windows of hot triggers are looked up
   among those that came back.

The inner phrases of a passage that many documents share are one phrase per chunk,
whatever their number of places.  Those over its edges, and over a repeated line shorter
than a window, reach into each document's own text: as many phrases of one trigger as
there are places.  Such a trigger is hot, and its windows are spread over all buckets.
A bucket sees packed rows, at most one per chunk.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indicator_engine.llm.common import pack, pack_sorted, parts_for, text_bytes, unpack, unpack_sorted, written

LENGTH = 50
TRIGGER = 20
CHUNK_BYTES = 8 << 20
#: positions hashed at once, so that the arrays stay in the processor's cache
_SLAB = 1 << 16
#: bytes of phrases sorted at once
_SORTED = 1 << 19
#: a trigger whose phrases have more bytes, over all places, is dealt by windows
HOT_BYTES = 1 << 21
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)

_CHUNK = "_chunk long, _ids binary, _known binary, _sizes binary, _data binary"
_PIECE = "_bucket int, _chunk long, _payload binary"


def _powers(base: np.uint64, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, base, np.uint64)]), dtype=np.uint64)


def triggers(data: np.ndarray, length: int = LENGTH, width: int = TRIGGER) -> np.ndarray:
    """For every window of ``length`` bytes the smallest mixed rolling hash of its ``width``-byte strings."""
    if len(data) < length:
        return np.zeros(0, np.uint64)
    span = length - width + 1
    up, down = _powers(_BASE, _SLAB + length), _powers(_INVERSE, _SLAB + length)
    value = (np.arange(1, 257, dtype=np.uint64) * _MIX) ^ (np.arange(1, 257, dtype=np.uint64) << np.uint64(37))
    out = np.empty(len(data) - length + 1, np.uint64)
    for at in range(0, len(out), _SLAB):
        part = data[at : at + _SLAB + length - 1]
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(value[part] * up[: len(part)], dtype=np.uint64)])
        h = (sums[width:] - sums[:-width]) * down[: len(part) - width + 1]
        h = (h ^ (h >> np.uint64(32))) * _MIX
        h = (h ^ (h >> np.uint64(29))) * _BASE
        h >>= np.uint64(16)
        size = 1
        while size * 2 <= span:
            h = np.minimum(h[:-size], h[size:])
            size *= 2
        if size < span:
            h = np.minimum(h[: len(h) - (span - size)], h[span - size :])
        out[at : at + len(h)] = h
    return out


def window_triggers(data: np.ndarray, ends: np.ndarray, known: np.ndarray, length: int) -> np.ndarray:
    """Trigger of each window of a chunk; ``_NONE`` where the window leaves its document or has no id."""
    out = triggers(data, length)
    first = np.where(known, np.maximum(ends[1:] - length + 1, ends[:-1]), ends[:-1])
    for start, stop in zip(first.tolist(), ends[1:].tolist()):
        out[start:stop] = _NONE
    return out


def runs(trigger: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First window and number of windows of each phrase."""
    if not len(trigger):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    new = np.empty(len(trigger), bool)
    new[0] = True
    np.not_equal(trigger[1:], trigger[:-1], out=new[1:])
    starts = ends[:-1]
    new[starts[starts < len(trigger)]] = True
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(trigger)))
    real = trigger[first] != _NONE
    return first[real], count[real]


# ---- 1: chunks ---------------------------------------------------------------


def _pack_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 32
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        start = 0
        sizes = pc.binary_length(batch.column("_text")).fill_null(0).to_numpy(zero_copy_only=False)
        for row, n in enumerate(sizes.tolist(), 1):
            size += n
            if size >= CHUNK_BYTES:
                held.append(batch.slice(start, row - start))
                yield _chunk(number, held)
                number, held, start, size = number + 1, [], row, 0
        if start < batch.num_rows:
            held.append(batch.slice(start))
    if held:
        yield _chunk(number, held)


def _chunk(number: int, batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    table = pa.Table.from_batches(batches)
    ids = table.column("_id").combine_chunks()
    data, ends = text_bytes(table.column("_text").cast(pa.large_string()))
    return pa.RecordBatch.from_arrays(
        [
            pa.array([number], pa.int64()),
            pa.array([pack(ids.fill_null(0).to_numpy())], pa.binary()),
            pa.array([pack(ids.is_valid().to_numpy(zero_copy_only=False))], pa.binary()),
            pa.array([pack(np.diff(ends).astype(np.int64))], pa.binary()),
            pa.array([pack(data)], pa.binary()),
        ],
        names=["_chunk", "_ids", "_known", "_sizes", "_data"],
    )


class _Chunk:
    def __init__(self, row: dict):
        self.number = row["_chunk"]
        self.ids, self.known = unpack(row["_ids"], np.int64), unpack(row["_known"], bool)
        self.ends = np.concatenate([[0], np.cumsum(unpack(row["_sizes"], np.int64))])
        self.data = unpack(row["_data"], np.uint8)

    def phrases(self, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Trigger, first window and number of windows of every phrase, in order of place."""
        trigger = window_triggers(self.data, self.ends, self.known, length)
        first, count = runs(trigger, self.ends)
        return trigger[first], first, count

    def documents(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ends, places, "right") - 1


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for row in range(batch.num_rows):
            yield batch.slice(row, 1).to_pylist()[0]


def _pieces(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    bucket, chunk, payload = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket, pa.int32()), pa.array(chunk, pa.int64()), pa.array(payload, pa.binary())],
        names=["_bucket", "_chunk", "_payload"],
    )


def _bucket_of(trigger: np.ndarray, buckets: int) -> np.ndarray:
    """Triggers are minima, so they are hashed anew."""
    mixed = (trigger * _MIX) & np.uint64((1 << 48) - 1)
    mixed = ((mixed ^ (mixed >> np.uint64(23))) * _BASE) >> np.uint64(32)
    return ((mixed * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)


def _join(parts: list[bytes]) -> bytes:
    sizes = np.array([len(p) for p in parts], "<u8").tobytes()
    return len(parts).to_bytes(4, "little") + sizes + b"".join(parts)


def _split(data: bytes) -> list[bytes]:
    n = int.from_bytes(data[:4], "little")
    at = 4 + 8 * n
    out = []
    for size in np.frombuffer(data[4:at], "<u8").tolist():
        out.append(data[at : at + size])
        at += size
    return out


# ---- 2: triggers of several documents ----------------------------------------


def _trigger_pieces(buckets: int, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            chunk = _Chunk(row)
            trigger, first, count = chunk.phrases(length)
            ids = chunk.ids[chunk.documents(first)]
            order = np.argsort(trigger, kind="stable")
            trigger, ids, size = trigger[order], ids[order], count[order] + length - 1
            starts = np.flatnonzero(np.concatenate([[True], trigger[1:] != trigger[:-1]])) if len(trigger) else order
            several = np.zeros(0, bool)
            if len(starts):
                several = np.minimum.reduceat(ids, starts) != np.maximum.reduceat(ids, starts)
                size = np.add.reduceat(size, starts)
            own = trigger[starts]
            bucket = _bucket_of(own, buckets)
            by = np.argsort(bucket, kind="stable")
            edges = np.searchsorted(bucket[by], np.arange(buckets + 1))
            out = []
            for b in range(buckets):
                at = by[edges[b] : edges[b + 1]]
                if len(at):
                    out.append((b, chunk.number, _join([pack_sorted(own[at]), pack(np.packbits(several[at])), pack(size[at].astype(np.int32))])))
            yield _pieces(out)

    return run


def _shared_triggers(key: tuple, table: pa.Table) -> pa.Table:
    chunks = table.column("_chunk").to_pylist()
    own, several, size = [], [], []
    for payload in table.column("_payload").to_pylist():
        sorted_, bits, bytes_ = _split(payload)
        own.append(unpack_sorted(sorted_))
        size.append(unpack(bytes_, np.int32))
        several.append(np.unpackbits(unpack(bits, np.uint8), count=len(own[-1])).astype(bool))
    every = np.concatenate(own)
    order = np.argsort(every, kind="stable")
    ranked = every[order]
    twice = np.concatenate(several)[order]
    if len(ranked):
        same = ranked[1:] == ranked[:-1]
        starts = np.flatnonzero(np.concatenate([[True], ~same]))
        sizes = np.diff(np.append(starts, len(ranked)))
        shared = np.repeat((sizes > 1) | np.logical_or.reduceat(twice, starts), sizes)
        back, hot = np.empty(len(every), bool), np.empty(len(every), bool)
        back[order] = shared
        total = np.add.reduceat(np.concatenate(size)[order].astype(np.int64), starts)
        hot[order] = np.repeat(total > HOT_BYTES, sizes)
    else:
        back = hot = np.zeros(0, bool)
    out, at = [], 0
    for chunk, trigger in zip(chunks, own):
        keep = back[at : at + len(trigger)]
        kept, dealt = trigger[keep], hot[at : at + len(trigger)][keep]
        at += len(trigger)
        if len(kept):
            out.append((key[0].as_py(), chunk, _join([pack_sorted(kept[~dealt]), pack_sorted(kept[dealt])])))
    return pa.Table.from_batches([_pieces(out)])


# ---- 3: dictionary and parse -------------------------------------------------


def _among(values: np.ndarray, ascending: np.ndarray) -> np.ndarray:
    if not len(ascending):
        return np.zeros(len(values), bool)
    return ascending[np.minimum(np.searchsorted(ascending, values), len(ascending) - 1)] == values


def _window_hashes(data: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Two independent hashes of the ``length`` bytes from each place."""
    one, two = np.full(len(at), _BASE), np.full(len(at), _MIX)
    for step in [*range(0, length - 8, 8), length - 8]:
        word = np.zeros(len(at), np.uint64)
        for i in range(8):
            word = (word << np.uint64(8)) | data[at + (step + i)]
        one = (one ^ word) * _MIX
        one ^= one >> np.uint64(29)
        two = (two ^ word) * _BASE
        two ^= two >> np.uint64(31)
    return one * _BASE ^ one >> np.uint64(32), two


def _hot_windows(chunk: _Chunk, trigger, first, count, hot: np.ndarray, length: int):
    """Place, id, trigger and both hashes of the windows of hot triggers, a slab at a time."""
    rows = np.flatnonzero(_among(trigger, hot))
    ends = np.cumsum(count[rows])
    for low in range(0, int(ends[-1]) if len(rows) else 0, _SLAB):
        window = np.arange(low, min(low + _SLAB, int(ends[-1])))
        row = np.searchsorted(ends, window, "right")
        at = first[rows[row]] + window - (ends[row] - count[rows[row]])
        yield at, chunk.ids[chunk.documents(at)], trigger[rows[row]], *_window_hashes(chunk.data, at, length)


def _equal_runs(one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by both hashes, and where in it a new window begins."""
    order = np.lexsort((two, one))
    a, b = one[order], two[order]
    return order, np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))


def _distinct_windows(ids: list, marks: list, ones: list, twos: list):
    """Smallest id, greatest id, trigger and hashes of the distinct windows, in order of their hashes."""
    low, high, mark, one, two = (np.concatenate(x) for x in (*ids, marks, ones, twos))
    order, heads = _equal_runs(one, two)
    at = order[heads]
    return np.minimum.reduceat(low[order], heads), np.maximum.reduceat(high[order], heads), mark[at], one[at], two[at]


def _hot_pieces(chunk: _Chunk, trigger, first, count, hot: np.ndarray, buckets: int, length: int) -> list[tuple[int, int, bytes]]:
    """The chunk's distinct windows of hot triggers, dealt by hash to buckets of their own."""
    slabs = [
        _distinct_windows(([ids], [ids]), [mark], [one], [two])
        for _, ids, mark, one, two in _hot_windows(chunk, trigger, first, count, hot, length)
    ]
    if not slabs:
        return []
    lows, highs, marks, ones, twos = zip(*slabs)
    low, high, mark, one, two = _distinct_windows((lows, highs), marks, ones, twos)
    bucket = _bucket_of(one, buckets)
    by = np.argsort(bucket, kind="stable")
    edges = np.searchsorted(bucket[by], np.arange(buckets + 1))
    out = []
    for b in range(buckets):
        at = by[edges[b] : edges[b + 1]]
        if len(at):
            out.append((buckets + b, chunk.number, _join([pack_sorted(one[at]), *(pack(x[at]) for x in (two, mark, low, high))])))
    return out


def _hot_lows(key: tuple, table: pa.Table) -> pa.Table:
    """For each chunk those of its hot windows that some chunk has in a document of smaller id."""
    chunks = table.column("_chunk").to_pylist()
    parts = []
    for payload in table.column("_payload").to_pylist():
        one, two, mark, low, high = _split(payload)
        parts.append((unpack_sorted(one), unpack(two, np.uint64), unpack(mark, np.uint64), unpack(low, np.int64), unpack(high, np.int64)))
    one, two, low = (np.concatenate([p[i] for p in parts]) for i in (0, 1, 3))
    order, heads = _equal_runs(one, two)
    lowest = np.empty(len(order), np.int64)
    lowest[order] = np.repeat(np.minimum.reduceat(low[order], heads), np.diff(np.append(heads, len(order))))
    out, at = [], 0
    for chunk, (one, two, mark, low, high) in zip(chunks, parts):
        least = lowest[at : at + len(one)]
        at += len(one)
        gone = least < high
        if gone.any():
            payload = [pack(np.unique(mark[gone])), pack_sorted(one[gone]), pack(two[gone]), pack(least[gone])]
            out.append((key[0].as_py(), chunk, _join(payload)))
    return pa.Table.from_batches([_pieces(out)])


def _hot_gone(chunk: _Chunk, answers: list[list[bytes]], length: int) -> Iterator[np.ndarray]:
    """Places of the chunk's windows that the answers of the hot buckets remove."""
    hot = np.unique(np.concatenate([unpack(a[0], np.uint64) for a in answers]))
    one = np.concatenate([unpack_sorted(a[1]) for a in answers])
    two, low = (np.concatenate([unpack(a[i], t) for a in answers]) for i, t in ((2, np.uint64), (3, np.int64)))
    order = np.lexsort((two, one))
    one, two, low = one[order], two[order], low[order]
    for at, ids, _, a, b in _hot_windows(chunk, *chunk.phrases(length), hot, length):
        place = np.searchsorted(one, a)
        # first hashes that are equal for different windows stand next to each other
        while True:
            there = np.minimum(place, len(one) - 1)
            on = (place < len(one)) & (one[there] == a) & (two[there] != b)
            if not on.any():
                break
            place += on
        found = (place < len(one)) & (one[there] == a)
        yield at[found & (low[there] < ids)]


def _dictionary_pieces(buckets: int, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            chunk = _Chunk(row)
            trigger, first, count = chunk.phrases(length)
            answers = [_split(p) for p in row["_payloads"]]
            shared, hot = (np.sort(np.concatenate([unpack_sorted(p) for p in part])) for part in zip(*answers))
            yield _pieces(_hot_pieces(chunk, trigger, first, count, hot, buckets, length))
            keep = _among(trigger, shared)
            trigger, first, count = trigger[keep], first[keep], count[keep]
            ids = chunk.ids[chunk.documents(first)]
            bucket = _bucket_of(trigger, buckets)
            order = np.lexsort((first, bucket))
            edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
            raw = chunk.data.tobytes()
            out = []
            for b in range(buckets):
                rows = order[edges[b] : edges[b + 1]]
                if not len(rows):
                    continue
                found: dict[bytes, int] = {}
                phrase = np.empty(len(rows), np.int32)
                starts, stops = first[rows].tolist(), (first[rows] + count[rows] + length - 1).tolist()
                for i, (s, e) in enumerate(zip(starts, stops)):
                    phrase[i] = found.setdefault(raw[s:e], len(found))
                least = np.full(len(found), np.iinfo(np.int64).max)
                np.minimum.at(least, phrase, ids[rows])
                mark = np.zeros(len(found), np.uint64)
                mark[phrase] = trigger[rows]
                payload = [
                    pack(mark),
                    pack(least),
                    pack(np.array([len(p) for p in found], np.int32)),
                    pack(np.frombuffer(b"".join(found), np.uint8)),
                    pack(phrase),
                    pack(np.diff(first[rows], prepend=0).astype(np.int32)),
                    pack(np.diff(ids[rows], prepend=0)),
                ]
                out.append((b, chunk.number, _join(payload)))
            yield _pieces(out)

    return run


def suffix_ranks(data: np.ndarray, length: int) -> np.ndarray:
    """Rank of every position by its next ``length`` bytes (zeros follow the end); equal strings share a rank.

    Prefix doubling: ranks by 8 bytes, pairs of them by 16, and so on; the last step
    overlaps two halves.
    """
    padded = np.concatenate([data, np.zeros(length + 8, np.uint8)])
    n = len(data)
    head = np.zeros(len(padded) - 7, np.uint64)
    for i in range(8):
        head = (head << np.uint64(8)) | padded[i : i + len(head)]
    rank = np.unique(head, return_inverse=True)[1].astype(np.uint64)
    size = 8
    while size < length:
        step = min(size, length - size)
        pair = (rank[: len(rank) - step] << np.uint64(32)) | rank[step:]
        rank = np.unique(pair, return_inverse=True)[1].astype(np.uint64)
        size += step
    return rank[:n].astype(np.int64)


def _first_documents(texts: list[bytes], least: np.ndarray, marks: np.ndarray, length: int) -> list[np.ndarray]:
    """For each phrase the smallest id of each of its windows, over all phrases with its trigger.

    Phrases come in order of their triggers; triggers are taken together while their
    phrases have less than ``_SORTED`` bytes.
    """
    sizes = np.array([len(t) for t in texts])
    heads = np.flatnonzero(np.concatenate([[True], marks[1:] != marks[:-1]]))
    ends = np.cumsum(sizes)[np.append(heads[1:], len(texts)) - 1]
    out: list[np.ndarray] = []
    at, done = 0, 0
    while at < len(heads):
        to = max(at + 1, int(np.searchsorted(ends, done + _SORTED, "right")))
        rows = slice(heads[at], heads[to] if to < len(heads) else len(texts))
        out += _lowest(texts[rows], sizes[rows], least[rows], length)
        at, done = to, ends[to - 1]
    return out


def _lowest(texts: list[bytes], sizes: np.ndarray, least: np.ndarray, length: int) -> list[np.ndarray]:
    data = np.frombuffer(b"".join(texts), np.uint8)
    starts = np.cumsum(sizes) - sizes
    windows = sizes - length + 1
    offset = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
    place = np.repeat(starts, windows) + offset
    rank = suffix_ranks(data, length)[place]
    order = np.argsort(rank, kind="stable")  # the suffix array, windows only
    ranked = rank[order]
    heads = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
    lowest = np.minimum.reduceat(np.repeat(least, windows)[order], heads)
    out = np.empty(len(order), np.int64)
    out[order] = np.repeat(lowest, np.diff(np.append(heads, len(order))))
    return np.split(out, np.cumsum(windows)[:-1])


def _spans(buckets: int, length: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        if key[0].as_py() >= buckets:
            return _hot_lows(key, table)
        chunks = table.column("_chunk").to_pylist()
        found: dict[bytes, int] = {}
        least: list[int] = []
        marks: list[int] = []
        parses = []
        for payload in table.column("_payload").to_pylist():
            mark, low, sizes, data, phrase, first, ids = _split(payload)
            raw, at = unpack(data, np.uint8).tobytes(), 0
            merged = []
            for m, i, n in zip(
                unpack(mark, np.uint64).tolist(), unpack(low, np.int64).tolist(), unpack(sizes, np.int32).tolist()
            ):
                p = found.setdefault(raw[at : at + n], len(least))
                at += n
                if p == len(least):
                    least.append(i)
                    marks.append(m)
                elif i < least[p]:
                    least[p] = i
                merged.append(p)
            parses.append(
                (
                    np.array(merged)[unpack(phrase, np.int32)],
                    np.cumsum(unpack(first, np.int32).astype(np.int64)),
                    np.cumsum(unpack(ids, np.int64)),
                )
            )
        texts, least, marks = list(found), np.array(least), np.array(marks, np.uint64)
        size = np.array([len(t) for t in texts])
        # triggers with several phrases: the suffix array tells what these share
        order = np.argsort(marks, kind="stable")
        heads = np.flatnonzero(np.concatenate([[True], marks[order][1:] != marks[order][:-1]]))
        many = np.zeros(len(texts), bool)
        many[order] = np.repeat(np.diff(np.append(heads, len(order))) > 1, np.diff(np.append(heads, len(order))))
        mixed = order[many[order]]
        lows = _first_documents([texts[i] for i in mixed], least[mixed], marks[mixed], length) if len(mixed) else []
        owners = dict(zip(mixed.tolist(), lows))
        out = []
        for chunk, (phrase, first, ids) in zip(chunks, parses):
            whole = ~many[phrase] & (least[phrase] < ids)
            starts, stops = [first[whole]], [first[whole] + size[phrase[whole]]]
            rows = np.flatnonzero(many[phrase])
            if len(rows):
                lows = [owners[p] for p in phrase[rows].tolist()]
                count = np.array([len(w) for w in lows])
                base = np.repeat(first[rows], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                gone = base[np.concatenate(lows) < np.repeat(ids[rows], count)]
                gone.sort()
                if len(gone):
                    new = np.concatenate([[True], np.diff(gone) > 1])
                    end = np.concatenate([new[1:], [True]])
                    starts.append(gone[new])
                    stops.append(gone[end] + length)
            starts, stops = np.concatenate(starts), np.concatenate(stops)
            if len(starts):
                by = np.argsort(starts, kind="stable")
                payload = _join([pack(np.diff(starts[by], prepend=0).astype(np.int32)), pack((stops - starts)[by].astype(np.int32))])
                out.append((key[0].as_py(), chunk, payload))
        return pa.Table.from_batches([_pieces(out)])

    return run


# ---- 4: cutting --------------------------------------------------------------


def _cut(with_bytes: bool, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            chunk = _Chunk(row)
            edge = np.zeros(len(chunk.data) + 1, np.int32)
            answers = [_split(p) for p in row["_payloads"] or []]
            hot = [a for a in answers if len(a) > 2]
            for places in _hot_gone(chunk, hot, length) if hot else ():
                np.add.at(edge, places, 1)
                np.add.at(edge, places + length, -1)
            for answer in answers:
                if len(answer) > 2:
                    continue
                starts, sizes = (unpack(p, np.int32).astype(np.int64) for p in answer)
                starts = np.cumsum(starts)
                np.add.at(edge, starts, 1)
                np.add.at(edge, starts + sizes, -1)
            gone = np.cumsum(edge, dtype=np.int32, out=edge)[:-1] > 0
            sizes = np.diff(chunk.ends)
            total = np.concatenate([edge[:1] * 0, np.cumsum(gone, dtype=np.int32)])
            removed = total[chunk.ends[1:]] - total[chunk.ends[:-1]]
            begin = gone.copy()
            begin[1:] &= ~gone[:-1]
            inside = chunk.ends[:-1][sizes > 0]
            begin[inside] = gone[inside]
            runs_ = np.concatenate([edge[:1] * 0, np.cumsum(begin, dtype=np.int32)])
            spans = runs_[chunk.ends[1:]] - runs_[chunk.ends[:-1]]
            left = chunk.data[~gone].tobytes()
            stops = np.cumsum(sizes - removed)
            kept = [left[e - n : e] for e, n in zip(stops.tolist(), (sizes - removed).tolist())]
            columns = [
                pa.array(chunk.ids, pa.int64(), mask=~chunk.known),
                pa.array(sizes, pa.int64()),
                pa.array(removed, pa.int64()),
                pa.array(spans, pa.int64()),
                pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
            ]
            names = ["_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if with_bytes:
                columns.append(pa.array(kept, pa.binary()))
                names.append("kept_bytes")
            for at in range(0, len(kept), 4096):
                yield pa.RecordBatch.from_arrays(columns, names=names).slice(at, 4096)

    return run


def remove_repeats(
    spark: SparkSession,
    docs: DataFrame,
    length: int = LENGTH,
    id_column: str = "doc_id",
    text_column: str = "text",
    with_bytes: bool = False,
) -> DataFrame:
    """One row per row of ``docs``: id, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` (and ``kept_bytes``).

    Texts are UTF-8 bytes, null is empty; a match never crosses documents.  A byte goes
    if a string of ``length`` bytes (32 at least) over it also starts in a row with a
    smaller id; all is judged on the input.  Rows with one id never remove each other's
    bytes; a null id neither removes nor loses any.  Repeats inside a document stay.
    An empty table gives no rows; other columns are not read.
    """
    if length < TRIGGER + 12:
        raise ValueError("length must be at least 32")
    rows = docs.select(F.col(id_column).cast("long").alias("_id"), F.col(text_column).cast("string").alias("_text"))
    chunks = written(spark, rows.mapInArrow(_pack_chunks, _CHUNK), "repeat-chunks")
    packed = chunks.where("_chunk IS NOT NULL")  # one exchange of the texts serves both joins
    buckets = parts_for(chunks, 6, 8)

    def by_chunk(pieces: DataFrame, how: str) -> DataFrame:
        per_chunk = pieces.groupBy("_chunk").agg(F.collect_list("_payload").alias("_payloads"))
        return packed.join(per_chunk, "_chunk", how)

    own = chunks.mapInArrow(_trigger_pieces(buckets, length), _PIECE)
    shared = own.groupBy("_bucket").applyInArrow(_shared_triggers, _PIECE)
    phrases = by_chunk(shared, "inner").mapInArrow(_dictionary_pieces(buckets, length), _PIECE)
    spans = phrases.groupBy("_bucket").applyInArrow(_spans(buckets, length), _PIECE)
    schema = "_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept_bytes binary" * with_bytes
    return by_chunk(spans, "left").mapInArrow(_cut(with_bytes, length), schema).withColumnRenamed("_id", id_column)
