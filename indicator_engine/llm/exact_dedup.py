"""Exact dedup by content sort.

Texts equal after white-space normalisation form a group; its row with the smallest
id stays.  Copies that meet in one Arrow batch are collapsed first, so a group of any
size reaches the sort as at most one row per batch.  Sampled splitters then
range-partition the normalised bytes, Spark's external sort places equals next to each
other, and each row is compared in full with its neighbour.

Only the verdict (digest, kept id, size) goes back to the rows.  Groups that hold at
least one ``HEAVY``-th of the rows, at most ``HEAVY`` of them, are broadcast; the rest
joins by digest, where no key is larger than that share.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indicator_engine.llm.common import SPACE, parts_for, text_or_empty, written

HEAVY = 1000
#: leading characters of the splitters; the digest after them splits a common beginning
SPLITTER_CHARS = 64

_CLASS = "_keep long, _size long, _digest string"


def _collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for the equal texts of a batch: smallest id, number of rows."""
    for batch in batches:
        first: dict[str, int] = {}
        ids, texts = batch.column("_id").to_pylist(), batch.column("_norm").to_pylist()
        least: list[int | None] = []
        sizes: list[int] = []
        rows: list[int] = []
        for row, (i, text) in enumerate(zip(ids, texts)):
            at = first.setdefault(text, len(rows))
            if at == len(rows):
                rows.append(row)
                least.append(i)
                sizes.append(1)
            else:
                sizes[at] += 1
                if i is not None and (least[at] is None or i < least[at]):
                    least[at] = i
        taken = batch.take(pa.array(rows, pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(least, pa.int64()), pa.array(sizes, pa.int64()), taken.column("_digest"), taken.column("_norm")],
            names=["_keep", "_size", "_digest", "_norm"],
        )


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in content order: full comparison with the row before, one row per run of equals."""
    text = keep = digest = None
    size = 0
    for batch in batches:
        out: list[tuple] = []
        rows = zip(*(batch.column(c).to_pylist() for c in ("_norm", "_keep", "_size", "_digest")))
        for norm, k, s, d in rows:
            if size and norm == text:
                size += s
                if k is not None and (keep is None or k < keep):
                    keep = k
            else:
                if size:
                    out.append((keep, size, digest))
                text, keep, size, digest = norm, k, s, d
        yield _runs(out)
    if size:
        yield _runs([(keep, size, digest)])


def _runs(rows: list[tuple]) -> pa.RecordBatch:
    keep, size, digest = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(keep, pa.int64()), pa.array(size, pa.int64()), pa.array(digest, pa.string())],
        names=["_keep", "_size", "_digest"],
    )


def exact_groups(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per distinct normalised text: ``_digest`` (SHA-256), ``_keep`` (smallest id), ``_size``."""
    norm = F.regexp_replace(text_or_empty(text_column), SPACE, " ")
    rows = docs.select(F.col(id_column).cast("long").alias("_id"), norm.alias("_norm")).withColumn(
        "_digest", F.sha2("_norm", 256)
    )
    collapsed = rows.mapInArrow(_collapse, _CLASS + ", _norm string")
    return (
        collapsed.withColumn("_head", F.substring("_norm", 1, SPLITTER_CHARS))
        .repartitionByRange(parts_for(docs, 8, 8, grow=16), "_head", "_digest")
        .drop("_head")
        .sortWithinPartitions("_norm")
        .mapInArrow(_neighbours, _CLASS)
    )


def exact_dedup(spark: SparkSession, docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Every row of ``docs`` with ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``.

    A null text counts as empty.  A null id never is the smallest unless all ids of its
    group are null; then the group has a null ``keep_id`` and all its rows stay.  Rows
    repeated with one id stay as often as they come.  An empty table gives no rows.
    Columns of ``docs`` with the names of the new ones are replaced.
    """
    groups = written(spark, exact_groups(docs, id_column, text_column), "exact-groups")
    total = groups.agg(F.sum("_size")).first()[0] or 0
    heavy = groups.where((F.col("_size") > 1) & (F.col("_size") * HEAVY >= total))
    heavy = heavy.withColumnRenamed("_digest", "_heavy_digest")
    new = ("keep_id", "group_size", "kept", "text_sha256")
    kept_columns = [c for c in docs.columns if c not in new]
    names = [f"_c{i}" for i in range(len(kept_columns))]  # apart from the names used here
    digest = F.sha2(F.regexp_replace(text_or_empty(text_column), SPACE, " "), 256)
    rows = docs.select(*(F.col(c).alias(n) for c, n in zip(kept_columns, names)), digest.alias("_sha"))
    own_id = F.col(names[kept_columns.index(id_column)])
    # at most HEAVY rows of 88 bytes
    heavy = F.broadcast(heavy.select("_heavy_digest", F.col("_keep").alias("_hk"), F.col("_size").alias("_hs")))
    seen = rows.join(heavy, F.col("_sha") == F.col("_heavy_digest"), "left")
    common = seen.where(F.col("_heavy_digest").isNotNull()).select(
        *names, "_sha", F.col("_hk").alias("_keep"), F.col("_hs").alias("_size")
    )
    rare = seen.where(F.col("_heavy_digest").isNull()).join(groups, F.col("_sha") == F.col("_digest"))
    judged = common.unionByName(rare.select(*names, "_sha", "_keep", "_size"))
    return judged.select(
        *(F.col(n).alias(c) for c, n in zip(kept_columns, names)),
        F.col("_keep").alias("keep_id"),
        F.col("_size").alias("group_size"),
        (F.col("_keep").isNull() | own_id.eqNullSafe(F.col("_keep"))).alias("kept"),
        F.col("_sha").alias("text_sha256"),
    )
