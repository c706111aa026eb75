from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLOTS = 256

#: size of the quantile sketches, and how far a rank read from one may be off
SKETCH = 4096
SLACK = 0.004

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType)
_IMAGE_BITS = 62


def order_image(df: DataFrame, order_by: Sequence[str]) -> tuple[Column, str] | None:
    """A number that never falls along the order (null last), and its type; None where there is none.

    Whole numbers of 32 bits, dates and the first bytes of a text are put one after the
    other as far as a long has room; a fraction or a long stands alone.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    image, room = F.lit(0).cast("long"), _IMAGE_BITS
    for i, name in enumerate(order_by):
        kind, c = kinds[name], F.col(name)
        if i == 0 and isinstance(kind, (T.DoubleType, T.FloatType, T.DecimalType)):
            return c.cast("double"), "double"
        if i == 0 and isinstance(kind, T.LongType):
            return c, "bigint"
        if isinstance(kind, (*_WHOLE, T.DateType)) and room >= 33:
            number = F.unix_date(c) if isinstance(kind, T.DateType) else c
            part = F.coalesce(number.cast("long") + (1 << 31), F.lit(1 << 32))
            image, room = F.shiftleft(image, 33) + part, room - 33
        elif isinstance(kind, T.StringType) and room >= 9:
            width = (room - 1) // 8
            head = F.rpad(F.hex(F.substring(c.cast("binary"), 1, width)), 2 * width, "0")
            part = F.coalesce(F.conv(head, 16, 10).cast("long"), F.lit(1 << (8 * width)))
            return F.shiftleft(image, 8 * width + 1) + part, "bigint"
        else:
            break
    return (image, "bigint") if room < _IMAGE_BITS else None


def _cut(df: DataFrame, image: Column, kind: str, n: int, slots: int) -> Column:
    """Scalar subquery: an image that about ``n`` rows do not exceed, few more and hardly ever fewer.

    Sketches are merged in two levels, so that no task merges one of every input partition.
    """
    sketch = getattr(F, f"kll_sketch_agg_{kind}")(image, SKETCH)
    merge = getattr(F, f"kll_merge_agg_{kind}")
    quantile = getattr(F, f"kll_sketch_get_quantile_{kind}")
    parts = df.groupBy(F.pmod(F.spark_partition_id(), F.lit(slots)).alias("_slot")).agg(
        F.count(image).alias("_rows"), sketch.alias("_sketch")
    )
    whole = parts.where("_rows > 0").agg(F.sum("_rows").alias("_rows"), merge("_sketch").alias("_sketch"))
    # a sketch is asked for fixed ranks only: every SLACK-th, and the one after the next is taken
    steps = math.ceil(1 / SLACK)
    ranks = F.array(*(F.lit(min(1.0, (i + 1) * SLACK)) for i in range(steps)))
    step = F.least(F.floor(F.lit(float(n)) / F.col("_rows") / SLACK) + 1, F.lit(steps - 1))
    picked = F.get(quantile("_sketch", ranks), step.cast("int"))
    return whole.select(F.when(F.col("_rows") > 0, picked).alias("_cut")).scalar()


def below_cut(df: DataFrame, n: int, order_by: Sequence[str], slots: int = SLOTS) -> DataFrame:
    """The first ``n`` rows by ``order_by`` and a few thousandths of a thousandth of the others.

    Two quantile sketches of the order key, the second over the rows below the cut of
    the first, give a cut; a count makes sure that ``n`` rows lie below it, and if they do
    not, nothing is cut.  Each of the three is a scan of the order columns that shuffles
    sketches or counts only.  Rows tied at the cut all stay, as does everything where the
    order key has no number (see ``order_image``).
    """
    found = order_image(df, order_by)
    if found is None:
        return df
    image, kind = found
    keys = df.select(image.alias("_image"))
    own = F.col("_image")
    near = keys.where(own <= _cut(keys, own, kind, n, slots))
    cut = _cut(near, own, kind, n, slots)
    enough = keys.where(own <= cut).agg(F.count(F.lit(1)) >= n).scalar()
    return df.where((image <= cut) | ~F.coalesce(enough, F.lit(False)))


def ordered_sample(
    df: DataFrame, n: int, order_by: Sequence[str], slots: int = SLOTS, *, scanned: bool = False
) -> DataFrame:
    """The first ``n`` rows by ``order_by`` (null last) — the same rows on every run; top-n by definition.

    A plain sort-and-limit sends up to ``n`` rows of every input partition to
    one task.  Here the slots of one level each cut their share to ``n`` rows
    before the next level joins them: ``slots`` first, then their square root,
    so the last task sees sqrt(slots) x n rows however large the input or the
    cluster.  The slot follows the input partition, not a value, so equal rows
    spread.

    ``scanned`` says that ``df`` is read from a table with little work: then a cut
    through the order key (``below_cut``, which scans it three times) leaves little more
    than ``n`` rows of the whole input before anything is shuffled, instead of ``n`` of
    every input partition.
    """
    order = [F.col(c).asc_nulls_last() for c in order_by]
    levels = (slots, max(1, math.isqrt(slots)))
    cut = below_cut(df, n, order_by, slots) if scanned else df
    cut = cut.withColumn("_slot", F.pmod(F.spark_partition_id(), F.lit(slots)))
    for size in levels:
        within_slot = Window.partitionBy("_slot").orderBy(*order)
        cut = (
            cut.withColumn("_slot", F.col("_slot") % size)
            .withColumn("_rank", F.row_number().over(within_slot))
            .where(F.col("_rank") <= n)
        )
    return cut.drop("_slot", "_rank").orderBy(*order).limit(n)


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """Any ``n`` rows, for a look at a table."""
    return df.limit(n)
