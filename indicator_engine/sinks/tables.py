"""Table writes.

A table is a catalog name, a path, or both (an external table).  Never write a
table from a plan that reads it: Parquet has no snapshot to read from.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from indicator_engine.names import Names
from indicator_engine.sources.raw import read_csv_text, with_provenance


#: earlier versions of a catalog table whose files stay, for readers that have begun
KEPT_VERSIONS = 1


@dataclass(frozen=True)
class Table:
    name: str | None = None
    path: str | None = None

    def __post_init__(self):
        if not (self.name or self.path):
            raise ValueError("a table needs a name or a path")

    @property
    def label(self) -> str:
        return self.name or self.path

    def read(self, spark: SparkSession, columns: Sequence[str] | None = None) -> DataFrame:
        """The table; ``columns`` restores an order that partitioning moved."""
        df = spark.table(self.name) if self.name else spark.read.parquet(self.path)
        return df.select(*columns) if columns else df

    def exists(self, spark: SparkSession) -> bool:
        if self.name is not None:
            return spark.catalog.tableExists(self.name)
        return _folders(spark, self.path).holds(self.path)

    def replace(self, spark: SparkSession, lay_out: Callable[[DataFrame], DataFrameWriter], df: DataFrame) -> None:
        """Write ``df`` in the table's place; until it is written whole the old rows stay.

        A folder is written beside the old one and renamed.  A catalog table gets a
        folder of its own for every version, and the catalog is pointed to it once it
        is whole: no rows are copied or renamed, and a reader sees one version or the
        other.
        """
        if self.name is None:
            staged = f"{self.path.rstrip('/')}.staged-{uuid.uuid4().hex}"
            try:
                lay_out(df).format("parquet").save(staged)
            except BaseException:
                _folders(spark, staged).delete(staged)
                raise
            _folders(spark, staged).swap(staged, self.path)
        elif not self.exists(spark) and self.path is None:
            self.save(lay_out(df))
        else:
            with self._version(spark, lay_out(df)) as staged:
                self._take(spark, staged)

    def replace_partitions(
        self, spark: SparkSession, lay_out: Callable[[DataFrame], DataFrameWriter], df: DataFrame, partition: str,
        values: Sequence,
    ) -> None:
        """Put ``df`` in the place of the partitions with these values; the other partitions are not touched.

        Each partition is pointed to its new folder when all of them are written; one
        without rows goes.  Only for catalog tables, whose partitions the catalog knows.
        """
        if self.name is None:
            raise ValueError("partitions are replaced in the catalog: the table needs a name")
        with self._version(spark, lay_out(df)) as staged:
            self._point_partitions(spark, staged, [f"{partition}={_partition_text(v)}" for v in values])

    @contextmanager
    def _version(self, spark: SparkSession, writer: DataFrameWriter) -> Iterator[Table]:
        """The rows as an external table in a fresh folder of this one; only the folder outlives the block."""
        base = self._home(spark)
        # names in order of time
        folder = f"{base}/v-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
        staged = Table(f"{self.name}__staged_{uuid.uuid4().hex}", folder)
        try:
            staged.save(writer)
            yield staged
        except BaseException:
            spark.sql(f"DROP TABLE IF EXISTS {staged.name}")
            if not self._refers_to(spark, folder):
                _folders(spark, folder).delete(folder)
            raise
        spark.sql(f"DROP TABLE IF EXISTS {staged.name}")
        self._tidy(spark, base)

    def _home(self, spark: SparkSession) -> str:
        if self.path is not None:
            return self.path.rstrip("/")
        schema, _, name = self.name.rpartition(".")
        located = spark.catalog.getDatabase(schema or spark.catalog.currentDatabase()).locationUri
        return f"{located.rstrip('/')}/{name}__versions"

    def _take(self, spark: SparkSession, staged: Table) -> None:
        """Point this table to the files of a staged one."""
        if not self.exists(spark):
            spark.sql(f"ALTER TABLE {staged.name} RENAME TO {self.name}")
        elif self._layout(spark) != staged._layout(spark):
            # the catalog cannot change a schema and a place at once: one name goes, the other takes it
            old = f"{self.name}__old_{uuid.uuid4().hex}"
            spark.sql(f"ALTER TABLE {self.name} RENAME TO {old}")
            try:
                spark.sql(f"ALTER TABLE {staged.name} RENAME TO {self.name}")
            except BaseException:
                spark.sql(f"ALTER TABLE {old} RENAME TO {self.name}")
                raise
            spark.sql(f"DROP TABLE {old}")
        elif any(c.isPartition for c in spark.catalog.listColumns(self.name)):
            self._point_partitions(spark, staged, None)
        else:
            self._point(spark, staged.path)

    def _point(self, spark: SparkSession, folder: str, partition: str = "") -> None:
        spark.sql(f"ALTER TABLE {self.name} {partition} SET LOCATION '{folder}'")
        spark.catalog.refreshTable(self.name)

    def _point_partitions(self, spark: SparkSession, staged: Table, names: Sequence[str] | None) -> None:
        """Point the named partitions (None: all) to a staged table; those it has no rows for go."""
        new, old = staged._partitions(spark), self._partitions(spark)
        if names is not None:
            names = [name for name in old if unquote(name) in set(names)]
        for name in new:
            spec = _partition_spec(name)
            if name not in old:
                spark.sql(f"ALTER TABLE {self.name} ADD IF NOT EXISTS {spec} LOCATION '{staged.path}/{name}'")
            else:
                self._point(spark, f"{staged.path}/{name}", spec)
        for name in old if names is None else names:
            if name not in new:
                spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS {_partition_spec(name)}")
        spark.catalog.refreshTable(self.name)

    def _partitions(self, spark: SparkSession) -> set[str]:
        """Names of the partitions as they are in paths: a row a partition, few by design."""
        return {r["partition"] for r in spark.sql(f"SHOW PARTITIONS {self.name}").collect()}

    def _described(self, spark: SparkSession, what: str = "") -> dict[str, str]:
        rows = spark.sql(f"DESCRIBE EXTENDED {self.name} {what}").collect()
        # what is said of a partition stands before what is said of its table
        return {r["col_name"]: r["data_type"] for r in reversed(rows)}

    def _layout(self, spark: SparkSession) -> tuple:
        columns = [(c.name, c.dataType, c.isPartition, c.isBucket) for c in spark.catalog.listColumns(self.name)]
        told = self._described(spark)
        return (columns, *(told.get(key) for key in ("Num Buckets", "Bucket Columns", "Sort Columns")))

    def _refers_to(self, spark: SparkSession, folder: str) -> bool:
        """Whether the catalog shows files of a folder as this table's."""
        return any(folder in place for place in self._places(spark))

    def _places(self, spark: SparkSession) -> set[str]:
        if not self.exists(spark):
            return set()
        places = {self._described(spark)["Location"]}
        if any(c.isPartition for c in spark.catalog.listColumns(self.name)):
            for name in self._partitions(spark):
                places.add(self._described(spark, _partition_spec(name))["Location"])
        return places

    def _tidy(self, spark: SparkSession, base: str) -> None:
        """Delete versions that nothing points to, but for the last ones."""
        files = _folders(spark, base)
        places = self._places(spark)
        unused = [v for v in files.within(base, "v-") if not any(f"/{v}" in place for place in places)]
        for version in sorted(unused)[: max(0, len(unused) - KEPT_VERSIONS)]:
            files.delete(f"{base}/{version}")

    def save(self, writer: DataFrameWriter) -> None:
        """Write or append; an existing catalog table knows its place."""
        writer = writer.format("parquet")
        if self.name is None:
            writer.save(self.path)
        elif self.path is None or self.exists(SparkSession.active()):
            writer.saveAsTable(self.name)
        else:
            writer.option("path", self.path).saveAsTable(self.name)


def _partition_text(value) -> str:
    return "__HIVE_DEFAULT_PARTITION__" if value is None else str(value)


def _partition_spec(name: str) -> str:
    """``PARTITION (...)`` of a partition as it is named in paths."""
    column, _, value = unquote(name).partition("=")
    if value == "__HIVE_DEFAULT_PARTITION__":
        return f"PARTITION (`{column}` = null)"
    return f"PARTITION (`{column}` = '{value}')"


class _folders:
    """Rename, list and delete on the file system that holds a path, by Spark's own file system classes."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = spark._jvm.org.apache.hadoop.fs.Path
        self.files = self.path(path).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def holds(self, path: str) -> bool:
        return self.files.exists(self.path(path))

    def within(self, path: str, prefix: str) -> list[str]:
        found = self.files.listStatus(self.path(path)) if self.holds(path) else []
        return [name for f in found if (name := f.getPath().getName()).startswith(prefix)]

    def delete(self, path: str) -> None:
        self.files.delete(self.path(path), True)

    def swap(self, staged: str, path: str) -> None:
        """Put a folder in another's place; the old one is gone only once the new one stands."""
        old = f"{staged}.old"
        held = self.files.exists(self.path(path))
        if held and not self.files.rename(self.path(path), self.path(old)):
            raise OSError(f"cannot move {path}")
        if not self.files.rename(self.path(staged), self.path(path)):
            if held:
                self.files.rename(self.path(old), self.path(path))
            raise OSError(f"cannot put {staged} in the place of {path}")
        if held:
            self.delete(old)


@dataclass(frozen=True)
class LoadAudit:
    """What a write left behind; the rows are counted while they are written."""

    table: str
    rows: int
    rejected: int = 0


AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("tabela", T.StringType()),
        T.StructField("linhas", T.LongType()),
        T.StructField("rejeitadas", T.LongType()),
        T.StructField("executado_em", T.TimestampType()),
    ]
)


def audit_frame(spark: SparkSession, audits: Sequence[LoadAudit]) -> DataFrame:
    schema = T.StructType(
        [
            T.StructField("table", T.StringType()),
            T.StructField("rows", T.LongType()),
            T.StructField("rejected", T.LongType()),
        ]
    )
    return spark.createDataFrame([(a.table, a.rows, a.rejected) for a in audits], schema)


def record(spark: SparkSession, audits: Sequence[LoadAudit], history: Table) -> LoadAudit:
    """Append what writes have counted to a history; no table is read for it."""
    told = audit_frame(spark, audits).toDF(*AUDIT_SCHEMA.names[:3])
    return append(told.withColumn("executado_em", F.current_timestamp()), history, AUDIT_SCHEMA)


def ensure_schema(spark: SparkSession, schema: str) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def overwrite(
    df: DataFrame, table: Table, *, bucket_by: str | None = None, buckets: int | None = None
) -> LoadAudit:
    """Replace a table; its schema may change, and a write that fails leaves the old rows.

    With ``bucket_by`` and ``buckets`` the rows are laid out by that key, one
    file per bucket, so that later joins and windows on it need no shuffle.
    """
    bucketed = bool(bucket_by and buckets)
    if bucketed and table.name is None:
        raise ValueError("a bucketed table needs a catalog name")

    def lay_out(rows: DataFrame) -> DataFrameWriter:
        if not bucketed:
            return rows.write
        return rows.repartition(buckets, bucket_by).write.bucketBy(buckets, bucket_by).sortBy(bucket_by)

    counted, seen = _counted(df)
    table.replace(df.sparkSession, lay_out, counted)
    return LoadAudit(table.label, seen.get["rows"])


def publish(df: DataFrame, table: Table, partition: str = Names.year) -> LoadAudit:
    """Replace a table partitioned by year.

    The rebalance groups each year into files of the advisory size: a small
    year is one file, a year holding most rows is split over many tasks.
    """
    counted, seen = _counted(df)
    table.replace(
        df.sparkSession, lambda rows: rows.hint("rebalance", partition).write.partitionBy(partition), counted
    )
    return LoadAudit(table.label, seen.get["rows"])


def publish_partitions(df: DataFrame, table: Table, values: Sequence, partition: str = Names.year) -> LoadAudit:
    """Replace some years of a published table; ``df`` holds all rows of these years."""
    counted, seen = _counted(df)
    table.replace_partitions(
        df.sparkSession,
        lambda rows: rows.hint("rebalance", partition).write.partitionBy(partition),
        counted,
        partition,
        values,
    )
    return LoadAudit(table.label, seen.get["rows"])


def append(df: DataFrame, table: Table, schema: T.StructType) -> LoadAudit:
    """Append to a history whose schema is a contract."""
    fitted, seen = _counted(df.to(schema))
    table.save(fitted.write.mode("append"))
    return LoadAudit(table.label, seen.get["rows"])


def export_csv(df: DataFrame, path: str) -> None:
    """CSV with a header that ``read_csv_text`` reads back as it was, outer spaces, quotes and breaks included."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


#: what a rejected row, and the values found in it, are called in its table
REJECTED, PARSED = "_linha", "_valores"


def land_raw(
    spark: SparkSession,
    path: str,
    table: Table,
    *,
    origin: str | None = None,
    columns: list[str] | None = None,
    multi_line: bool = False,
    names: Names = Names(),
    quarantine: Table | None = None,
) -> LoadAudit:
    """CSV to raw table: text as it came, plus provenance.

    Rows of another width stop the load, unless there is a ``quarantine``: then they
    are written there, each as the text it was, with the values found in it and its
    provenance, and counted.  The
    files are parsed once more only if there are any.
    """
    if quarantine is None:
        text = read_csv_text(spark, path, columns, multi_line=multi_line)
        return overwrite(with_provenance(text, origin, names), table)
    text = read_csv_text(spark, path, columns, multi_line=multi_line, rejects=REJECTED)
    found = F.array(*(F.col(f"`{c}`") for c in text.columns if c != REJECTED))
    parsed = with_provenance(text, origin, names)
    seen = Observation()
    counted = parsed.observe(seen, F.count_if(F.col(REJECTED).isNotNull()).alias("rejected"))
    audit = overwrite(counted.where(F.col(REJECTED).isNull()).drop(REJECTED), table)
    rejected = seen.get["rejected"]
    broken = parsed.where(F.col(REJECTED).isNotNull()) if rejected else parsed.limit(0)
    overwrite(broken.select(REJECTED, found.alias(PARSED), names.origin, names.ingested), quarantine)
    return LoadAudit(audit.table, audit.rows, rejected)
