"""Conversation structure repair: the cheapest edits that make a conversation alternate.

A conversation is well formed when the initials of its roles give ``(s?(ua)+)?``.  Each row
is kept (0), given the role user or assistant (1) or deleted (2); rows without text can be
put in anywhere (5).  Blank rows and rows whose role and text came before must go; a
truncated row that stays costs 5 more.  Of the cheapest edits those whose initials
(D, I, K, R) are least in ASCII are taken.

The search is a dynamic programme over four states (nothing yet, after s, after u, after a).
Its backward costs are stored at checkpoints only, one a block of about the square root of
the longest conversation; a block is computed again from its checkpoint while the edits
are emitted walking forward.  Blocks are rows of Spark: first the cost of crossing each
block from every state to every state, then, a row a block and conversation, the costs at
the checkpoints, then the state each block leaves behind, then the edits.  So a
conversation that holds most of all rows is spread over tasks; what meets in one task is a
block, or the blocks' summaries of a conversation.  Rows that must go have one edit
whatever the state and leave the programme early; texts stay out of it: a row is known by
turn, role and the SHA-256 of its text.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from indicator_engine.llm.common import parts_for, written

BLANKS = " \t\n\x0b\x0c\r"  # the characters of [\x20\x09-\x0D]
ENDS = (".", "!", "?")
RENAME, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
LEAST_BLOCK = 64

# states: 0 nothing yet, 1 after s, 2 after u, 3 after a; a row's initial moves from state to state
_KEEP = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
_NEXT = (2, 2, 3, 2)  # where an inserted or renamed row leads
_FAR = 1 << 50  # more than any cost
_FINAL = (0, 2 * INSERT, INSERT, 0)  # costs when no row is left

# a row's letter in the programme: its initial (o: another), in capitals when truncated
_INITIALS = ("s", "u", "a")


def _before(costs: list[int], letter: str) -> list[int]:
    """Costs in front of a row from those behind it."""
    more = TRUNCATED if letter.isupper() else 0
    keep = _KEEP.get(letter.lower(), {})
    out = []
    for state in range(4):
        best = min(DELETE + costs[state], RENAME + more + costs[_NEXT[state]])
        out.append(min(best, more + costs[keep[state]]) if state in keep else best)
    user, assistant = min(out[2], INSERT + out[3]), min(out[3], INSERT + out[2])
    return [min(out[0], INSERT + user), min(out[1], INSERT + user), user, assistant]


def _crossing(letters: str) -> list[int]:
    """Cheapest way from each state before the rows to each state behind them (4 x 4, by state before)."""
    columns = []
    for end in range(4):
        costs = [0 if state == end else _FAR for state in range(4)]
        for letter in reversed(letters):
            costs = _before(costs, letter)
        columns.append(costs)
    return [columns[end][start] for start in range(4) for end in range(4)]


def _walk(letters: str, behind: list[int], state: int, last: bool) -> tuple[list[str], str, int]:
    """Edits of each row, edits after the last row of a conversation, and the state left behind.

    An edit is D, K, U or A (renamed to user or assistant), with rows put in before it as
    u and a.  Of the edits on a cheapest way the least of D, I, K, R is taken.
    """
    costs = [list(behind)]
    for letter in reversed(letters):
        costs.append(_before(costs[-1], letter))
    costs.reverse()
    edits = []
    for i, letter in enumerate(letters):
        more = TRUNCATED if letter.isupper() else 0
        keep = _KEEP.get(letter.lower(), {})
        put = ""
        while True:
            here, then = costs[i][state], costs[i + 1]
            if here == DELETE + then[state]:
                edits.append(put + "D")
                break
            if here == INSERT + costs[i][_NEXT[state]]:
                put += "ua"[_NEXT[state] - 2]
                state = _NEXT[state]
                continue
            if state in keep and here == more + then[keep[state]]:
                edits.append(put + "K")
                state = keep[state]
            else:
                state = _NEXT[state]
                edits.append(put + "UA"[state - 2])
            break
    tail = ""
    while last and _FINAL[state]:
        tail += "ua"[_NEXT[state] - 2]
        state = _NEXT[state]
    return edits, tail, state


def damage(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, _copies``: rows with faults put in by the checksum of id and turn.

    A null role or text is one space, as is a null id or turn in the checksum.  Of twenty
    remainders 0 drops the row, 1 empties its text, 2 removes its sentence ends, 3 repeats
    it, 4 gives it the role user.
    """
    named = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")]
    conv, turn, role, text = named
    fault = F.crc32(F.concat(conv, F.lit(":"), turn)) % 20
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), fault.alias("_fault")).where(
        "_fault <> 0"
    ).select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.when(F.col("_fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("_fault") == 1, "")
        .when(F.col("_fault") == 2, F.translate("text", "".join(ENDS), ""))
        .otherwise(F.col("text"))
        .alias("text"),
        F.when(F.col("_fault") == 3, 2).otherwise(1).cast("long").alias("_copies"),
    )


@dataclass(frozen=True)
class Repair:
    """``edits``: a row for every different row, in order of ``_at``; ``rows``: the repaired conversations."""

    edits: DataFrame
    rows: DataFrame


def _key(conv: Column) -> Column:
    """Text that also tells a null id from all others, so that it can be joined and grouped by."""
    return F.when(conv.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), conv.cast("string")))


def repair(spark: SparkSession, rows: DataFrame) -> Repair:
    """The edits of every conversation and what they make of it.

    ``rows`` has ``conv_id, turn, role, text`` and may have ``_copies`` (times a row
    stands there; else once); other columns are not read.  Rows go by turn, null first,
    then by role and the SHA-256 of the text; equal rows stand next to each other.  A null
    role or text counts as one space, a null id is a conversation of its own.

    ``edits``: ``_conv, _at`` (order), ``turn, role, digest, copies, fault`` (blank,
    duplicate, truncated or null: that of the first copy; the others are duplicates or
    blank), ``edit`` (D, K, U, A with u and a for rows put in before), ``tail`` (rows put
    in at the end).  ``rows``: ``_conv, _at, _step, role, text``; rows put in have an empty
    text.  An empty table gives none.
    """
    copies = F.col("_copies") if "_copies" in rows.columns else F.lit(1)
    filled = rows.select(
        _key(F.col("conv_id")).alias("_conv"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        copies.cast("long").alias("copies"),
    ).withColumn("digest", F.sha2("text", 256))
    shown = F.rtrim(F.col("text"), F.lit(BLANKS))
    state = F.when(shown == "", "blank").when(~F.right(shown, F.lit(1)).isin(*ENDS), "truncated").otherwise("")
    same = ["_conv", "turn", "role", "digest"]
    different = filled.withColumn("state", state).groupBy(*same, "state").agg(F.sum("copies").alias("copies"))
    order = [F.col("_conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]
    ordered = written(
        spark,
        different.repartitionByRange(parts_for(rows, 64, 8), *order)
        .sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id()),
        "conversation-order",
    )

    longest = ordered.groupBy("_conv").count().agg(F.max("count")).first()[0] or 0
    bits = max(LEAST_BLOCK, math.isqrt(longest)).bit_length()
    block = F.shiftright("_at", bits)
    initial = F.substring("role", 1, 1)
    letter = F.when(initial.isin(*_INITIALS), initial).otherwise("o")
    letter = F.when(F.col("state") == "truncated", F.upper(letter)).otherwise(letter)
    # the first of equal rows; blank rows and the others must go whatever else is done
    alive = (
        ordered.where("state <> 'blank'")
        .groupBy("_conv", "role", "digest")
        .agg(F.min(F.struct("_at", letter.alias("letter"))).alias("first"))
        .select("_conv", "first.*")
    )
    steps = F.sort_array(F.collect_list(F.struct("_at", "letter")))  # a block at most
    blocks = alive.groupBy("_conv", block.alias("block")).agg(steps.alias("steps"))
    ends = alive.groupBy("_conv").agg(F.min(block).alias("_low"), F.max(block).alias("_high"))
    blocks = blocks.join(ends, "_conv").select(
        "_conv",
        "block",
        F.array_join("steps.letter", "").alias("letters"),
        F.col("steps._at").alias("ats"),
        (F.col("block") == F.col("_high")).alias("last"),
        (F.col("_low") == F.col("_high")).alias("whole"),
    )
    blocks = written(spark, blocks, "conversation-blocks")
    several = blocks.where("NOT whole")
    checkpoints = _scan(several.mapInArrow(_cross, "_conv string, block long, items array<long>"), _backward)
    left = several.join(checkpoints, ["_conv", "block"]).mapInArrow(_leave, "_conv string, block long, items array<long>")
    entered = _scan(left, _forward).withColumnRenamed("value", "entered")
    long_ones = several.join(checkpoints, ["_conv", "block"]).join(entered, ["_conv", "block"]).select(
        "_conv", "letters", "ats", "last", F.col("value").alias("behind"), F.col("entered")[0].alias("state")
    )
    short_ones = blocks.where("whole").select(
        "_conv",
        "letters",
        "ats",
        "last",
        F.lit(list(_FINAL)).cast("array<long>").alias("behind"),
        F.lit(0).cast("long").alias("state"),
    )
    walked = short_ones.unionByName(long_ones).mapInArrow(_emit, "_at long, edit string, tail string")
    edits = ordered.join(walked, "_at", "left").select(
        *same,
        "_at",
        "copies",
        F.when(F.col("state") == "blank", "blank")
        .when(F.col("edit").isNull(), "duplicate")
        .when(F.col("state") == "truncated", "truncated")
        .alias("fault"),
        F.coalesce("edit", F.lit("D")).alias("edit"),
        F.coalesce("tail", F.lit("")).alias("tail"),
    )
    edits = written(spark, edits, "conversation-edits")
    return Repair(edits, _repaired(edits, filled))


def _scan(items: DataFrame, run) -> DataFrame:
    """A pass over the blocks of each conversation, a row a block: ``_conv, block, value``."""
    lists = items.groupBy("_conv").agg(F.sort_array(F.collect_list(F.struct("block", "items"))).alias("blocks"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for conv, blocks in zip(batch.column("_conv").to_pylist(), batch.column("blocks").to_pylist()):
                out += [(conv, b, v) for b, v in run([(b["block"], b["items"]) for b in blocks])]
            yield _batch(out, ["_conv", "block", "value"], [pa.string(), pa.int64(), pa.list_(pa.int64())])

    return lists.mapInArrow(scan, "_conv string, block long, value array<long>")


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def _backward(blocks: list[tuple]) -> Iterator[tuple]:
    """Costs behind each block, from the last to the first."""
    costs = list(_FINAL)
    for block, crossing in reversed(blocks):
        yield block, costs
        costs = [min(crossing[4 * start + end] + costs[end] for end in range(4)) for start in range(4)]


def _forward(blocks: list[tuple]) -> Iterator[tuple]:
    """The state in which each block is entered."""
    state = 0
    for block, left in blocks:
        yield block, [state]
        state = left[state]


def _cross(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        items = [_crossing(letters) for letters in batch.column("letters").to_pylist()]
        yield _summaries(batch, items)


def _leave(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each state in which a block may be entered the state in which it is left."""
    for batch in batches:
        both = zip(batch.column("letters").to_pylist(), batch.column("value").to_pylist())
        yield _summaries(batch, [[_walk(x, behind, s, False)[2] for s in range(4)] for x, behind in both])


def _summaries(batch: pa.RecordBatch, items: list[list[int]]) -> pa.RecordBatch:
    arrays = [batch.column("_conv"), batch.column("block"), pa.array(items, pa.list_(pa.int64()))]
    return pa.RecordBatch.from_arrays(arrays, names=["_conv", "block", "items"])


def _emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for p in batch.to_pylist():
            edits, tail, _ = _walk(p["letters"], p["behind"], p["state"], p["last"])
            out += zip(p["ats"], edits, [""] * (len(edits) - 1) + [tail])
        yield _batch(out, ["_at", "edit", "tail"], [pa.int64(), pa.string(), pa.string()])


def _repaired(edits: DataFrame, filled: DataFrame) -> DataFrame:
    """The rows that the edits leave, in order of ``_at`` and ``_step``."""
    same = ["_conv", "turn", "role", "digest"]
    steps = edits.where("edit <> 'D' OR tail <> ''").withColumn("made", F.concat("edit", "tail"))
    # only the letter of the row itself takes its text: at most one of D, K, U, A
    texts = filled.groupBy(*same).agg(F.min("text").alias("text"))
    matched = steps.alias("e").join(
        texts.alias("t"),
        (F.col("e._conv") == F.col("t._conv"))
        & F.col("e.turn").eqNullSafe(F.col("t.turn"))
        & (F.col("e.role") == F.col("t.role"))
        & (F.col("e.digest") == F.col("t.digest")),
    )
    one = matched.select("e._conv", "e._at", "e.role", "t.text", F.posexplode(F.split("e.made", "")).alias("_step", "_one"))
    own = F.col("_one").isin("K", "U", "A")
    return one.where("_one NOT IN ('D', '')").select(
        "_conv",
        "_at",
        "_step",
        F.when(F.col("_one") == "K", F.col("role")).when(F.lower("_one") == "u", "user").otherwise("assistant").alias("role"),
        F.when(own, F.col("text")).otherwise("").alias("text"),
    )


def _faults(edits: DataFrame) -> DataFrame:
    """Per conversation: counts of faults, cost, gaps in the turns, pairs of roles that may not be neighbours.

    Neighbours are looked up within runs of ``RUN`` places, then between the runs.
    """
    run = F.shiftright("_at", 12).alias("_run")
    here = W.partitionBy("_conv", "_run").orderBy("_at")
    initial = F.substring("role", 1, 1)
    legal = ("su", "ua", "au")
    near = edits.select("*", run, initial.alias("_initial")).withColumns(
        {
            "_pair": F.concat(F.lag("_initial").over(here), F.col("_initial")),
            "_turn": (F.lag("turn").over(here).isNull() | (F.lag("turn").over(here) != F.col("turn"))),
        }
    )
    letters = F.col("edit")
    inserted = F.length(F.regexp_replace(F.concat("edit", "tail"), "[DKUA]", ""))
    renamed = F.col("edit").rlike("[UA]$").cast("long")
    deleted = F.col("edit").endswith("D").cast("long") + F.col("copies") - 1
    stays = (~letters.endswith("D") & (F.coalesce("fault", F.lit("")) == "truncated")).cast("long")
    first = F.when(F.col("fault") == "blank", F.col("copies"))
    runs = near.groupBy("_conv", "_run").agg(
        F.sum(F.coalesce(first, F.lit(0))).alias("blank"),
        F.sum(
            F.when(F.col("fault") == "blank", 0).when(F.col("fault") == "duplicate", F.col("copies")).otherwise(F.col("copies") - 1)
        ).alias("duplicate"),
        F.count_if(F.col("fault") == "truncated").alias("truncated"),
        (F.sum(F.col("copies") - 1) + F.count_if(~F.col("_pair").isin(*legal))).alias("illegal"),
        F.sum(INSERT * inserted + RENAME * renamed + DELETE * deleted + TRUNCATED * stays).alias("cost"),
        F.min("turn").alias("_least"),
        F.max("turn").alias("_most"),
        F.count_if(F.col("turn").isNotNull() & F.col("_turn")).alias("_turns"),
        F.min_by("_initial", "_at").alias("_head"),
        F.max_by("_initial", "_at").alias("_foot"),
        F.max_by("turn", "_at").alias("_last_turn"),
        F.min_by("turn", "_at").alias("_first_turn"),
    )
    between = W.partitionBy("_conv").orderBy("_run")
    runs = runs.withColumns(
        {
            "_pair": F.concat(F.lag("_foot").over(between), F.col("_head")),
            "_same": F.coalesce(F.lag("_last_turn").over(between) == F.col("_first_turn"), F.lit(False)),
        }
    )
    turns = F.sum("_turns") - F.count_if(F.col("_same"))
    return runs.groupBy("_conv").agg(
        F.coalesce(F.max("_most") - F.min("_least") + 1 - turns, F.lit(0)).alias("gaps"),
        F.sum("blank").alias("blank"),
        F.sum("duplicate").alias("duplicate"),
        F.sum("truncated").alias("truncated"),
        (F.sum("illegal") + F.count_if(~F.col("_pair").isin(*legal))).alias("illegal"),
        F.sum("cost").alias("cost"),
    )


def _audits(edits: DataFrame) -> DataFrame:
    """The initials of all edits of a conversation as one text, put together run by run."""
    own = F.concat("edit", F.repeat(F.lit("D"), (F.col("copies") - 1).cast("int")), "tail")
    initials = F.translate(own, "uaUA", "IIRR")
    in_order = lambda place, text: F.array_join(
        F.transform(F.sort_array(F.collect_list(F.struct(place, text))), lambda x: x[text]), ""
    )
    runs = edits.select("_conv", F.shiftright("_at", 12).alias("_run"), "_at", initials.alias("_text"))
    runs = runs.groupBy("_conv", "_run").agg(in_order("_at", "_text").alias("_text"))
    return runs.groupBy("_conv").agg(in_order("_run", "_text").alias("audit"))


def _digests(rows: DataFrame) -> DataFrame:
    """SHA-256 of a conversation's ``role:text`` lines.

    The hash takes its input in order, so one task reads a conversation from end to end;
    it holds one row at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, digest = None, None
        for batch in batches:
            out = []
            for c, role, text in zip(*(batch.column(n).to_pylist() for n in ("_conv", "role", "text"))):
                line = f"{role}:{text}".encode("utf-8", "surrogatepass")
                if c == conv:
                    digest.update(b"\n" + line)
                    continue
                if digest is not None:
                    out.append((conv, digest.hexdigest()))
                conv, digest = c, hashlib.sha256(line)
            yield _batch(out, ["_conv", "repaired_sha256"], [pa.string(), pa.string()])
        if digest is not None:
            yield _batch([(conv, digest.hexdigest())], ["_conv", "repaired_sha256"], [pa.string(), pa.string()])

    ordered = rows.repartition("_conv").sortWithinPartitions("_conv", "_at", "_step")
    return ordered.select("_conv", "role", "text").mapInArrow(run, "_conv string, repaired_sha256 string")


def audit(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """A row for every ``conv_id`` of ``conversations`` about its damaged rows and their repair.

    ``gaps, blank, duplicate, truncated, illegal, cost`` (longs), ``audit`` (initials of
    the edits) and ``repaired_sha256``.  A conversation without a row left has zeros, an
    empty audit and the hash of nothing.  See ``damage`` and ``repair`` for nulls, ties
    and repeated rows; an empty table gives no rows.
    """
    kind = conversations.schema["conv_id"].dataType
    done = repair(spark, damage(conversations))
    every = conversations.select(_key(F.col("conv_id")).alias("_conv")).distinct()
    joined = every.join(_faults(done.edits), "_conv", "left").join(_audits(done.edits), "_conv", "left")
    joined = joined.join(_digests(done.rows), "_conv", "left")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return joined.select(
        F.when(F.col("_conv") != "", F.substring("_conv", 2, 1 << 30)).cast(kind).alias("conv_id"),
        *(F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in counts),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
