"""Near-duplicate groups by HyperMinHash.

A text's shingles are hashed to 64 bits.  Every register of the sketch hashes all of
them anew and keeps of its smallest hash the number of leading zeros and ``MANTISSA``
bits, 16 bits together; so registers are independent and filled however small the set
is.  Bands of ``ROWS`` registers are hashed; so many bands are taken that a pair at the
threshold meets in none of them, or falls short in the comparison of sketches, with a
probability below ``MISS``.

1. Equal shingle sets collapse to the row with the smallest id.
2. In each band bucket every set is tied to the smallest id there; the connected parts
   of that graph are candidate classes, which contain every link.
3. Only texts of such classes are moved, once.  A class is cut into blocks of ``BLOCK``
   sets; each pair of blocks meets in a group of its own, so a group is bounded whatever
   the class.  A group compares sketches and confirms on the full sets where as many
   registers agree as ``least_agreeing`` says; pairs already connected are skipped, so it
   returns fewer links than sets.
4. Components of the confirmed links.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indicator_engine.llm.common import text_bytes, written
from indicator_engine.llm.components import components

ROWS = 7
MISS = 1e-8
MANTISSA = 10
BLOCK = 512
#: part of ``MISS`` left to the comparison of sketches
SKETCH_SHARE = 0.1
#: texts hashed at once, in bytes
_SLAB = 1 << 18
#: shingles hashed for all registers at once
_COLUMNS = 128
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_VALUE = (np.arange(1, 257, dtype=np.uint64) * _MIX2) ^ (np.arange(1, 257, dtype=np.uint64) << np.uint64(41))


def bands(threshold: int) -> int:
    """Number of bands for a threshold in per cent."""
    return math.ceil(math.log(MISS * (1 - SKETCH_SHARE)) / math.log(1 - (threshold / 100) ** ROWS))


def least_agreeing(threshold: int, size: int) -> int:
    """Registers of ``size`` that agree in a pair at the threshold but for the sketches' share of ``MISS``.

    The exact binomial tail; registers that agree by chance only add to it.
    """
    need, tail = threshold / 100, 0.0
    if need >= 1:
        return size
    for agree in range(size + 1):
        ways = math.lgamma(size + 1) - math.lgamma(agree + 1) - math.lgamma(size - agree + 1)
        tail += math.exp(ways + agree * math.log(need) + (size - agree) * math.log(1 - need))
        if tail > MISS * SKETCH_SHARE:
            return agree
    return size


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _MIX
    h = (h ^ (h >> np.uint64(27))) * _MIX2
    return h ^ (h >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, base, np.uint64)]), dtype=np.uint64)


def shingle_sets(column: pa.Array, words: int) -> Iterator[np.ndarray]:
    """Ascending distinct hashes of the ``words``-word shingles of each text, in order of rows.

    A text of fewer words has one shingle, all of it; without words it has none.
    """
    data, ends = text_bytes(column.cast(pa.large_string()))
    row, n = 0, len(ends) - 1
    up, down = _powers(_BASE, _SLAB), _powers(_INVERSE, _SLAB)
    while row < n:
        last = int(np.searchsorted(ends, ends[row] + _SLAB, "right")) - 1
        last = min(max(last, row + 1), n)
        part = data[ends[row] : ends[last]]
        if len(part) >= len(up):
            up, down = _powers(_BASE, len(part)), _powers(_INVERSE, len(part))
        yield from _slab_sets(part, ends[row : last + 1] - ends[row], words, up, down)
        row = last


def _slab_sets(data, ends, words, up, down) -> Iterator[np.ndarray]:
    if not len(data):
        yield from (np.zeros(0, np.uint64) for _ in range(len(ends) - 1))
        return
    inside = ~_SPACE[data]
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    cut = ends[1:-1]
    cut = np.unique(cut[(cut > 0) & (cut < len(data))])
    joined = cut[inside[cut] & inside[cut - 1]]  # a word ends where its document does
    starts = np.sort(np.concatenate([np.flatnonzero(edge == 1), joined]))
    stops = np.sort(np.concatenate([np.flatnonzero(edge == -1), joined]))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_VALUE[_LOWER[data]] * up[: len(data)], dtype=np.uint64)])
    word = _mixed((sums[stops] - sums[starts]) * down[starts] + (stops - starts).astype(np.uint64))
    first = np.searchsorted(starts, ends)
    if len(word) >= words:
        shingle = np.zeros(len(word) - words + 1, np.uint64)
        for i in range(words):
            shingle = shingle * _BASE + word[i : len(word) - words + 1 + i]
        shingle = _mixed(shingle)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= words:
            own = np.sort(shingle[a : b - words + 1])
            yield own[np.concatenate([[True], own[1:] != own[:-1]])]
        elif b > a:
            whole = np.zeros(1, np.uint64)
            for w in word[a:b]:
                whole = whole * _BASE + w
            yield _mixed(whole + np.uint64(b - a))
        else:
            yield np.zeros(0, np.uint64)


# ---- sketches ----------------------------------------------------------------


def seeds(size: int) -> tuple[np.ndarray, np.ndarray]:
    """What each of ``size`` registers mixes into a shingle's hash."""
    every = _mixed(np.arange(1, 2 * size + 1, dtype=np.uint64) * _BASE)
    return every[:size, None], every[size:, None] | np.uint64(1)


def sketch(own: np.ndarray, seed: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Registers of a non-empty set: leading zeros and mantissa of the smallest hash under each seed."""
    flip, times = seed
    low = np.full(len(flip), np.iinfo(np.uint64).max)
    for at in range(0, len(own), _COLUMNS):
        np.minimum(low, ((own[at : at + _COLUMNS] ^ flip) * times).min(axis=1), out=low)
    mantissa, exponent = np.frexp(np.maximum(low.astype(np.float64), 1.0) / 2.0**64)
    register = (np.clip(-exponent, 0, 63) << MANTISSA) | ((mantissa * 2 - 1) * (1 << MANTISSA)).astype(np.int64)
    return register.astype(np.uint16)


def band_keys(registers: np.ndarray, n_bands: int) -> np.ndarray:
    rows = registers.reshape(-1, n_bands).T.astype(np.uint64)
    key = np.arange(1, n_bands + 1, dtype=np.uint64) * _MIX
    for i in range(rows.shape[1]):
        key = (key ^ rows[:, i]) * _BASE
        key ^= key >> np.uint64(29)
    return key.view(np.int64)


def _signatures(words: int, n_bands: int, threshold: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seed = seeds(n_bands * ROWS)
        for batch in batches:
            size, one, two = [], [], []
            keys: list[bytes | None] = []
            ids = batch.column("_id").to_pylist()
            least: dict[tuple, int] = {}
            for row, own in enumerate(shingle_sets(batch.column("_text"), words)):
                size.append(len(own))
                one.append(int(own.sum(dtype=np.uint64).view(np.int64)) if len(own) else 0)
                two.append(int(_mixed(own ^ _BASE).sum(dtype=np.uint64).view(np.int64)) if len(own) else 0)
                # one of the equal sets of a batch stands for them in the bands; a set with
                # n elements is at most n / (n + 1) like another
                new = len(own) * (100 - threshold) >= threshold and ids[row] is not None and least.setdefault((one[-1], two[-1]), row) == row
                keys.append(band_keys(sketch(own, seed), n_bands).tobytes() if new else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_id"),
                    pa.array(size, pa.int64()),
                    pa.array(one, pa.int64()),
                    pa.array(two, pa.int64()),
                    pa.array(keys, pa.binary()),
                ],
                names=["_id", "_n", "_one", "_two", "_keys"],
            )

    return run


def _band_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            part = batch.slice(at, 1024)
            keys = [np.frombuffer(k, np.int64) for k in part.column("_keys").to_pylist()]
            ids = np.repeat(part.column("_id").to_numpy(), [len(k) for k in keys])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(keys)), pa.array(ids, pa.int64())], names=["_key", "_id"]
            )


# ---- links -------------------------------------------------------------------


def _moved_sets(words: int):
    """Full sets of the candidate texts; a text of the same id but another set is left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                one = part.column("_one").to_pylist()
                rows, data = [], []
                for row, own in enumerate(shingle_sets(part.column("_text"), words)):
                    if len(own) and int(own.sum(dtype=np.uint64).view(np.int64)) == one[row]:
                        rows.append(row)
                        data.append(own.tobytes())
                kept = part.take(pa.array(rows, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [kept.column("_class"), kept.column("_blocks"), kept.column("_rep"), pa.array(data, pa.binary())],
                    names=["_class", "_blocks", "_rep", "_set"],
                )

    return run


def _linked(a: np.ndarray, b: np.ndarray, threshold: int) -> bool:
    common = int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())
    return 100 * common >= threshold * (len(a) + len(b) - common)


def _group_links(ids: list[int], blocks: list[int], sets: list[np.ndarray], across: bool, threshold: int, size: int):
    """Confirmed links that connect what the group can connect."""
    order = np.argsort(ids, kind="stable")
    ids, blocks, sets = [ids[i] for i in order], np.array(blocks)[order], [sets[i] for i in order]
    n = np.array([len(s) for s in sets])
    seed = seeds(size)
    regs = np.stack([sketch(s, seed) for s in sets])
    root = list(range(len(ids)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    floor = least_agreeing(threshold, size)
    for i in range(1, len(ids)):
        before = np.arange(i)
        if across:
            before = before[blocks[:i] != blocks[i]]
        # sizes alone rule a pair out
        before = before[(100 * np.minimum(n[before], n[i])) >= threshold * np.maximum(n[before], n[i])]
        if not len(before):
            continue
        agree = (regs[before] == regs[i]).sum(axis=1)
        likely = agree >= floor
        for j in before[likely][np.argsort(-agree[likely], kind="stable")].tolist():
            a, b = find(i), find(j)
            if a != b and _linked(sets[i], sets[j], threshold):
                root[max(a, b)] = min(a, b)
                yield ids[i], ids[j]


def _block_links(threshold: int, n_bands: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = None
        held: list[tuple[int, int, np.ndarray]] = []

        def links() -> Iterator[tuple[int, int]]:
            if len(held) > 1:
                ids, blocks, sets = zip(*held)
                yield from _group_links(list(ids), list(blocks), list(sets), key[1] != key[2], threshold, n_bands * ROWS)

        for batch in batches:
            out: list[tuple[int, int]] = []
            names = ("_class", "_low", "_high", "_block", "_rep", "_set")
            for c, low, high, block, rep, data in zip(*(batch.column(x).to_pylist() for x in names)):
                if (c, low, high) != key:
                    out += links()
                    key, held = (c, low, high), []
                if not held or held[-1][0] != rep:
                    held.append((rep, block, np.frombuffer(data, np.uint64)))
            yield _pairs(out)
        yield _pairs(list(links()))

    return run


def _pairs(rows: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*rows) if rows else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def near_groups(
    spark: SparkSession,
    docs: DataFrame,
    words: int = 5,
    threshold: int = 80,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: id, ``n_shingles``, ``component_id``, ``kept``.

    Two rows are linked if their sets of distinct ``words``-word shingles (A-Z in lower
    case) have a Jaccard similarity of ``threshold`` per cent or more; the component is
    the smallest id reachable over links, and the row with that id is kept.  Null texts
    and texts without words have no shingles and are linked with nothing; so are rows
    without an id, which are kept with a null component.  Rows repeated with one id are
    members of one group if their texts are linked.  An empty table gives no rows;
    other columns are not read.
    """
    n_bands = bands(threshold)
    rows = docs.select(F.col(id_column).cast("long").alias("_id"), F.col(text_column).cast("string").alias("_text"))
    signed = written(
        spark,
        rows.mapInArrow(_signatures(words, n_bands, threshold), "_id long, _n long, _one long, _two long, _keys binary"),
        "near-signatures",
    )
    known = signed.where("_n > 0 AND _id IS NOT NULL")
    # written, so that the join has a stage of its own, which adaptive execution splits where many rows are copies
    reps = written(spark, known.groupBy("_one", "_two").agg(F.min("_id").alias("_rep")), "near-representatives")
    members = written(spark, known.select("_id", "_n", "_one", "_two").join(reps, ["_one", "_two"]), "near-members")

    band_rows = signed.where("_keys IS NOT NULL").select("_id", "_keys").mapInArrow(_band_rows, "_key long, _id long")
    common = band_rows.groupBy("_key").agg(F.min("_id").alias("_low"), F.max("_id").alias("_high")).where("_low < _high")
    ties = band_rows.join(common, "_key").where("_id <> _low").select("_id", "_low").distinct()
    of = members.select(F.col("_id").alias("_member"), "_rep").distinct()
    ties = ties.join(of, F.col("_id") == F.col("_member")).select(F.col("_rep").alias("a"), "_low")
    ties = ties.join(of, F.col("_low") == F.col("_member")).select("a", F.col("_rep").alias("b"))
    hung = components(spark, ties)
    classes = hung.unionByName(hung.select(F.col("component").alias("node"), "component").distinct())
    sizes = classes.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("_blocks"))
    candidates = classes.join(sizes, "component").join(
        members.where("_id = _rep").select(F.col("_rep").alias("node"), "_one").distinct(), "node"
    )
    candidates = candidates.select(
        F.col("node").alias("_rep"), F.col("component").alias("_class"), "_blocks", "_one"
    )

    moved = rows.join(candidates, F.col("_id") == F.col("_rep")).select("_class", "_blocks", "_rep", "_one", "_text")
    sets = moved.mapInArrow(_moved_sets(words), "_class long, _blocks int, _rep long, _set binary")
    sets = sets.withColumn("_block", F.pmod(F.xxhash64("_rep"), F.col("_blocks")).cast("int"))
    met = sets.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    met = met.withColumn("_low", F.least("_block", "_other")).withColumn("_high", F.greatest("_block", "_other"))
    grouped = met.repartition("_class", "_low", "_high").sortWithinPartitions("_class", "_low", "_high", "_rep")
    links = grouped.select("_class", "_low", "_high", "_block", "_rep", "_set").mapInArrow(
        _block_links(threshold, n_bands), "a long, b long"
    )
    joined = components(spark, links).withColumnRenamed("node", "_rep")

    judged = members.join(joined, "_rep", "left").select("_id", "_n", F.coalesce("component", "_rep").alias("_component"))
    alone = signed.where("_n = 0 OR _id IS NULL").select("_id", "_n", F.col("_id").alias("_component"))
    kept = F.col("_id").isNull() | (F.col("_id") == F.col("_component"))
    return judged.unionByName(alone).select(
        F.col("_id").alias(id_column),
        F.col("_n").alias("n_shingles"),
        F.col("_component").alias("component_id"),
        kept.alias("kept"),
    )
