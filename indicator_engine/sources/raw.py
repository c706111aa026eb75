"""Raw landing: CSV text with provenance, no type decided."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from indicator_engine.names import Names

# Raw file and the raw table it becomes.
RAW_ENTITIES = {
    "uf.csv": "uf",
    "municipio.csv": "municipio",
    "meta_brasil.csv": "meta_alfabetizacao_brasil",
    "meta_uf.csv": "meta_alfabetizacao_uf",
    "meta_municipio.csv": "meta_alfabetizacao_municipio",
    "alunos.csv": "alunos",
}


def read_csv_text(
    spark: SparkSession,
    path: str,
    columns: list[str] | None = None,
    *,
    multi_line: bool = False,
    rejects: str | None = None,
) -> DataFrame:
    """CSV with a header, every column string, values as they came.

    A quote inside a quoted value is doubled.  Without ``columns`` the names come
    from the header, which costs a look at one file; with them the scan needs no
    such job.  Either way every file's header is checked against the names: columns
    are never taken by position from another order.

    A row with more or fewer values stops the read.  With ``rejects`` it does not: the
    column of that name holds the row as it came, and null for a row that is as it
    should be.  Values with line breaks need ``multi_line``, with which a file is one
    task; without it such a row counts as two of the wrong width.
    """
    reader = (
        spark.read.option("header", True)
        .option("inferSchema", False)
        .option("escape", '"')
        .option("nullValue", "\u0000")  # nothing between two commas is null, an empty quoted text is not
        .option("mode", "PERMISSIVE" if rejects else "FAILFAST")
        .option("columnPruning", rejects is None)  # the width of a row shows only when all of it is parsed
        .option("multiLine", multi_line)
    )
    if columns is None:
        columns = reader.option("enforceSchema", False).csv(path).columns
    if rejects in columns:
        raise ValueError(f"the files have a column {rejects}")
    if rejects:
        reader = reader.option("columnNameOfCorruptRecord", rejects)
    text = T.StructType([T.StructField(name, T.StringType()) for name in [*columns, *([rejects] if rejects else [])]])
    return reader.schema(text).option("enforceSchema", False).csv(path)


def with_provenance(df: DataFrame, origin: str | None, names: Names = Names()) -> DataFrame:
    """Add where a row came from and when it was read.

    ``origin=None`` takes the name of the file each row was read from.
    """
    source = F.col("_metadata.file_name") if origin is None else F.lit(origin)
    return df.select("*", source.alias(names.origin), F.current_timestamp().alias(names.ingested))


def read_raw(table: DataFrame, names: Names = Names()) -> DataFrame:
    """A landed table without its provenance."""
    return table.drop(names.origin, names.ingested)
