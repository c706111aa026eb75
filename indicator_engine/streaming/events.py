"""Indicator events: source, transform and sink as three functions.

Another source replaces ``read_events`` only: ``read_event_table`` is one, over a table to
which another job appends.  Another sink replaces ``land`` only: ``absorb`` merges events
into a served table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from indicator_engine.functions import as_timestamp
from indicator_engine.names import Names
from indicator_engine.operators.targets import latest_by_key
from indicator_engine.sinks.tables import Table, publish_partitions

# Fields of an event.  Declared by hand: a field that does not parse is null, the schema never moves.
EVENT_SCHEMA = T.StructType(
    [
        T.StructField("id_municipio", T.StringType()),
        T.StructField("ano", T.IntegerType()),
        T.StructField("taxa_alfabetizacao", T.DoubleType()),
        T.StructField("media_portugues", T.DoubleType()),
        T.StructField("evento_ts", T.StringType()),
    ]
)


#: longer than any file has existed
NO_AGE_LIMIT = "36500d"


def read_events(
    spark: SparkSession,
    folder: str,
    schema: T.StructType = EVENT_SCHEMA,
    max_files_per_batch: int | None = 10_000,
    max_file_age: str = NO_AGE_LIMIT,
    archive: str | None = None,
) -> DataFrame:
    """Stream of the JSON files in a folder, each file once per checkpoint.

    The file cap bounds a micro-batch, so a backlog drains in several batches; no
    file is left out.  A file of any age is read: Spark's own limit of a week
    would skip backfills and copies that keep their times.  The price is that the
    source remembers every file it has seen; ``archive`` bounds that by moving
    drained files to another folder.
    """
    reader = spark.readStream.schema(schema).option("maxFileAge", max_file_age)
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    if max_files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    return reader.json(folder)


def read_event_table(
    spark: SparkSession,
    table: Table,
    text: str = "value",
    schema: T.StructType = EVENT_SCHEMA,
    max_files_per_batch: int | None = 10_000,
    max_file_age: str = NO_AGE_LIMIT,
) -> DataFrame:
    """Stream of the JSON texts that a table's column ``text`` holds, each row once per checkpoint.

    As with files, a text that is no JSON is an event without any field.
    """
    reader = spark.readStream.option("maxFileAge", max_file_age)
    if max_files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    if table.name is not None:
        rows = reader.table(table.name)
    else:
        rows = reader.schema(T.StructType([T.StructField(text, T.StringType())])).parquet(table.path)
    return rows.select(F.from_json(F.col(text), schema).alias("_event")).select("_event.*")


def stamp(events: DataFrame, names: Names = Names()) -> DataFrame:
    """Parse the event time and add the ingest time; stateless."""
    return events.withColumns(
        {names.event_time: as_timestamp(names.event_time), names.ingested: F.current_timestamp()}
    )


def land(stream: DataFrame, table: Table, checkpoint: str, files_per_batch: int | None = None) -> StreamingQuery:
    """Append everything that has arrived to the table, then stop.

    A micro-batch of many small event files would leave as many small table files;
    ``files_per_batch`` is the most that it writes.  All tasks read and parse; the rows
    are dealt to the few that write afterwards.
    """
    if files_per_batch is not None:
        stream = stream.repartition(files_per_batch)
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    if table.name is None:
        return writer.start(table.path)
    if table.path is not None:
        writer = writer.option("path", table.path)
    return writer.toTable(table.name)


def drain(
    events: DataFrame,
    table: Table,
    checkpoint: str,
    names: Names = Names(),
    files_per_batch: int | None = None,
) -> DataFrame:
    """Land what a stream of events, from whatever source, has to give; return the table."""
    land(stamp(events, names), table, checkpoint, files_per_batch).awaitTermination()
    return table.read(events.sparkSession)


def ingest(
    spark: SparkSession,
    folder: str,
    table: Table,
    checkpoint: str,
    names: Names = Names(),
    schema: T.StructType = EVENT_SCHEMA,
    max_files_per_batch: int | None = 10_000,
    max_file_age: str = NO_AGE_LIMIT,
    files_per_batch: int | None = None,
    archive: str | None = None,
) -> DataFrame:
    """Drain the folder into the table and return the table."""
    events = read_events(spark, folder, schema, max_files_per_batch, max_file_age, archive)
    return drain(events, table, checkpoint, names, files_per_batch)


def absorb(
    stream: DataFrame, served: Table, checkpoint: str, names: Names = Names(), label: str = "events"
) -> StreamingQuery:
    """Merge everything that has arrived into a table published by year, then stop.

    A micro-batch rewrites the years it has events of and no other; see ``merge_events``
    for what becomes of a row.  The table remembers the last batch of each ``label``, so
    that a batch that comes again changes nothing; take another label with another checkpoint.
    """

    def take(batch: DataFrame, batch_id: int) -> None:
        absorb_batch(batch, batch_id, served, names, label)

    writer = stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def absorb_batch(
    batch: DataFrame, batch_id: int, served: Table, names: Names = Names(), label: str = "events"
) -> list[int]:
    """One micro-batch of ``absorb``; returns the years it has rewritten."""
    spark = batch.sparkSession
    mark = f"absorbed.{label}"
    told = spark.sql(f"SHOW TBLPROPERTIES {served.name}").where(F.col("key") == mark).first()
    if told is not None and batch_id <= int(told["value"]):
        return []
    events = batch.where(F.col(names.entity).isNotNull() & F.col(names.year).isNotNull())
    # a row a year
    years = sorted(r[0] for r in events.select(names.year).distinct().collect())
    if years:
        current = served.read(spark).where(F.col(names.year).isin(years))
        publish_partitions(merge_events(current, events, names), served, years, names.year)
    spark.sql(f"ALTER TABLE {served.name} SET TBLPROPERTIES ('{mark}' = '{batch_id}')")
    return years


def merge_events(current: DataFrame, events: DataFrame, names: Names = Names()) -> DataFrame:
    """The rows with the measures of the newest event of their entity and year.

    A measure the event lacks keeps its value; an event of no row makes one, whose other
    columns are null.  Where ``current`` holds the time of the event a row was last
    changed by, an event older than that changes nothing.
    """
    keys = [names.entity, names.year]
    taken = {m: f"_new_{m}" for m in (*names.measures, names.event_time)}
    newest = latest_by_key(events, keys, age=F.col(names.event_time)).select(
        *keys, F.lit(True).alias("_new"), *(F.col(c).alias(n) for c, n in taken.items())
    )
    wins = F.col("_new").isNotNull()
    if names.event_time in current.columns:
        at, new = F.col(names.event_time), F.col(taken[names.event_time])
        wins = wins & (at.isNull() | F.coalesce(new >= at, F.lit(False)))
    merged = current.join(newest, keys, "full")
    changed = {c: F.when(wins, F.coalesce(n, c)).otherwise(F.col(c)) for c, n in taken.items() if c in current.columns}
    return merged.withColumns(changed).select(*current.columns)


def summary_by_year(landed: DataFrame, names: Names = Names(), *, exact_scale: int | None = None) -> DataFrame:
    """Events and mean rate per year; unreadable events form the null year."""
    mean = F.avg(names.rate)
    if exact_scale is not None:
        mean = mean.cast(f"decimal(28,{exact_scale})").cast("double")
    return landed.groupBy(names.year).agg(
        F.count(F.lit(1)).alias(names.events), mean.alias(names.mean_rate)
    )


def rejects(landed: DataFrame, schema: T.StructType = EVENT_SCHEMA) -> DataFrame:
    """Events of which no field could be read."""
    unreadable = F.coalesce(*(F.col(f.name).cast("string") for f in schema)).isNull()
    return landed.where(unreadable)
