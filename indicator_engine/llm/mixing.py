"""Mixing sources to target weights along a time-varying curriculum; native functions only.

Every source has a target number of words.  Its weight over training time t in [0, 1]
is the line ``1 + ramp * (2t - 1)`` times that target; the integral of the line is the
words demanded until t, and its inverse (a square root) gives each word the time at
which it is due.  A source is read again and again in a fixed pseudo-random order until
its target is met, so a document is taken once per pass and partly at the end.

A source may hold most rows: running sums are taken inside hash buckets of each source,
as many as leave a bucket at most ``BUCKET_BYTES`` of the stored input, and the buckets'
own sums are added in front.  The windows over sources are one task: a row a source, of
which training corpora have thousands at most.  The result is range-sorted by position;
rows without one, and rows due at the same time, follow the pseudo-random order, so that
neither is one partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from indicator_engine.llm.common import WORD, input_bytes

WEIGHTS = (5.0, 2.0, 1.0)
RAMPS = (-0.5, 0.0, 0.5)
SHARE = 1.5
CAP = 2.0
#: hexadecimal digits of the order key that name a bucket, at least: 16**3 buckets a source
BUCKET_DIGITS = 3
#: stored input that a bucket holds at most, on average, if all rows are of one source
BUCKET_BYTES = 256 << 20
_TIES = ("_order", "_null", "_src", "_words", "_text_hash")


def source_targets(
    sizes: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    ramps: tuple[float, ...] = RAMPS,
    share: float = SHARE,
    cap: float = CAP,
) -> DataFrame:
    """``_null, _src, source_size`` to the same with ``target`` and ``_ramp``.

    Sources in order of code points, null last, get the weights in turn and share
    ``share`` times all words by weight; no target exceeds ``cap`` times its source.
    In order of cap per weight, a source is capped while the level that the rest would
    reach is above its own; the first level below is the one that holds for the rest.
    """
    by_name = W.orderBy("_null", "_src")
    by_level = W.orderBy("_ratio", "_null", "_src")
    before, rest = by_level.rowsBetween(W.unboundedPreceding, -1), by_level.rowsBetween(0, W.unboundedFollowing)
    every = W.partitionBy()
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    pick = lambda values: F.element_at(F.array(*map(F.lit, values)), (turn + 1).cast("int"))
    level = (
        sizes.withColumn("_weight", pick(weights))
        .withColumn("_ramp", pick([ramps[i % len(ramps)] for i in range(len(weights))]))
        .withColumn("_cap", F.col("source_size") * F.lit(cap))
        .withColumn("_ratio", F.col("_cap") / F.col("_weight"))
        .withColumn("_goal", F.sum("source_size").over(every) * F.lit(share))
        .withColumn("_level", (F.col("_goal") - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / F.sum("_weight").over(rest))
    )
    held = F.max(F.when(F.col("_level") < F.col("_ratio"), F.col("_level"))).over(every)
    target = F.least(F.col("_cap"), F.coalesce(held * F.col("_weight"), F.col("_cap")))
    return level.select("_null", "_src", "source_size", "_ramp", target.alias("target"))


def _due(met: Column, ramp: Column) -> Column:
    """Training time at which the share ``met`` of a source's demand is reached."""
    slope = 1 - ramp
    return F.when(ramp == 0, met).otherwise((F.sqrt(slope * slope + 4 * ramp * met) - slope) / (2 * ramp))


def bucket_digits(size: int | None) -> int:
    """Digits of the order key that cut a source of ``size`` stored bytes (None: not known) into buckets."""
    digits = BUCKET_DIGITS
    while (size or 0) > BUCKET_BYTES * 16**digits:
        digits += 1
    return digits


def _placed(docs, weights, ramps, share, cap, seed, id_column, text_column, source_column, keep) -> DataFrame:
    """``_row`` (id and kept columns), size and target of the source, words taken, first word's place in its source.

    ``_order``, ``_null``, ``_src``, ``_words`` and ``_text_hash`` settle ties of time: rows
    equal in all of them are the same, or differ in further columns only.
    """
    source = F.col(source_column).cast("string")
    size = F.coalesce(F.regexp_count(F.col(text_column), F.lit(WORD)), F.lit(0)).cast("long")
    order = F.md5(F.concat_ws(":", F.lit(seed), F.col(id_column).cast("string")))
    rows = docs.select(
        F.col(id_column).alias("_id"),
        source.isNull().alias("_null"),
        F.coalesce(source, F.lit("")).alias("_src"),
        size.alias("_words"),
        order.alias("_order"),
        F.xxhash64(F.col(text_column)).alias("_text_hash"),
        F.struct(F.col(id_column), *(F.col(c) for c in keep)).alias("_row"),
    ).withColumn("_bucket", F.substring("_order", 1, bucket_digits(input_bytes(docs))))
    key = ["_null", "_src"]
    buckets = rows.groupBy(*key, "_bucket").agg(F.sum("_words").alias("_in_bucket"))
    earlier = W.partitionBy(*key).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = buckets.withColumn("_offset", F.coalesce(F.sum("_in_bucket").over(earlier), F.lit(0)))
    sizes = buckets.groupBy(*key).agg(F.sum("_in_bucket").alias("source_size"))
    plan = offsets.join(source_targets(sizes, weights, ramps, share, cap), key)
    inside = W.partitionBy(*key, "_bucket").orderBy("_order", "_id", "_words", "_text_hash").rowsBetween(W.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_words").over(inside), F.lit(0))
    placed = rows.withColumn("_before", before).join(plan, [*key, "_bucket"])
    start = F.col("_before") + F.col("_offset")
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    rest = F.floor(F.col("target") - passes * F.col("source_size")) - start
    taken = F.col("_words") * passes + F.greatest(F.lit(0), F.least(rest, F.col("_words")))
    return placed.select(
        "_row", *_TIES, "source_size", "target", "_ramp", start.alias("_start"), taken.cast("long").alias("_taken")
    )


def _in_training_order(rows: DataFrame, *time: str) -> DataFrame:
    keys = [*time, *_TIES]
    return rows.repartitionByRange(*keys[: len(time) + 1]).sortWithinPartitions(*keys)


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    ramps: tuple[float, ...] = RAMPS,
    share: float = SHARE,
    cap: float = CAP,
    seed: str = "mix",
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
) -> DataFrame:
    """One row per document in training order: id, ``size``, ``source_size``, ``target``, ``taken``, ``position``.

    ``position`` is the training time of the document's first word, null if none is
    taken; such rows come first.  Null text and text without words have size 0 and take nothing; a null
    source is a source of its own; null ids sort first in a source's order.  Rows
    repeated with one id count each.  An empty table gives no rows.  Other columns are
    not carried, whatever their names.
    """
    placed = _placed(docs, weights, ramps, share, cap, seed, id_column, text_column, source_column, ())
    due = _due(F.col("_start") / F.col("target"), F.col("_ramp"))
    at = F.when(F.col("_taken") > 0, due)
    return _in_training_order(placed.withColumn("_at", at), "_at").select(
        F.col(f"_row.`{id_column}`").alias(id_column),
        F.col("_words").alias("size"),
        "source_size",
        "target",
        F.col("_taken").alias("taken"),
        F.col("_at").alias("position"),
    )


def mixed_documents(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    ramps: tuple[float, ...] = RAMPS,
    share: float = SHARE,
    cap: float = CAP,
    seed: str = "mix",
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
) -> DataFrame:
    """The mixture itself: each document once per pass that takes words of it, in training order.

    Returns the columns of ``docs``, range-sorted by position, ties in the pseudo-random
    order of the ids; a document cut off by the
    end of its source's target is whole.  Edge cases as for ``mix``.
    """
    others = tuple(c for c in docs.columns if c != id_column)
    placed = _placed(docs, weights, ramps, share, cap, seed, id_column, text_column, source_column, others)
    passes = F.ceil(F.col("_taken") / F.col("_words")).cast("int")
    copies = placed.where("_taken > 0").withColumn("_pass", F.explode(F.sequence(F.lit(0), passes - 1)))
    met = (F.col("_start") + F.col("_pass") * F.col("source_size")) / F.col("target")
    due = copies.withColumn("_at", _due(met, F.col("_ramp")))
    return _in_training_order(due, "_at").select(*(F.col(f"_row.`{c}`").alias(c) for c in docs.columns))
