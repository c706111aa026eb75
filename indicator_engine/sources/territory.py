from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from indicator_engine.names import Names

# The 27 states — two-digit code, abbreviation, name, macro-region.
STATES = (
    ("11", "RO", "Rondonia", "Norte"),
    ("12", "AC", "Acre", "Norte"),
    ("13", "AM", "Amazonas", "Norte"),
    ("14", "RR", "Roraima", "Norte"),
    ("15", "PA", "Para", "Norte"),
    ("16", "AP", "Amapa", "Norte"),
    ("17", "TO", "Tocantins", "Norte"),
    ("21", "MA", "Maranhao", "Nordeste"),
    ("22", "PI", "Piaui", "Nordeste"),
    ("23", "CE", "Ceara", "Nordeste"),
    ("24", "RN", "Rio Grande do Norte", "Nordeste"),
    ("25", "PB", "Paraiba", "Nordeste"),
    ("26", "PE", "Pernambuco", "Nordeste"),
    ("27", "AL", "Alagoas", "Nordeste"),
    ("28", "SE", "Sergipe", "Nordeste"),
    ("29", "BA", "Bahia", "Nordeste"),
    ("31", "MG", "Minas Gerais", "Sudeste"),
    ("32", "ES", "Espirito Santo", "Sudeste"),
    ("33", "RJ", "Rio de Janeiro", "Sudeste"),
    ("35", "SP", "Sao Paulo", "Sudeste"),
    ("41", "PR", "Parana", "Sul"),
    ("42", "SC", "Santa Catarina", "Sul"),
    ("43", "RS", "Rio Grande do Sul", "Sul"),
    ("50", "MS", "Mato Grosso do Sul", "Centro-Oeste"),
    ("51", "MT", "Mato Grosso", "Centro-Oeste"),
    ("52", "GO", "Goias", "Centro-Oeste"),
    ("53", "DF", "Distrito Federal", "Centro-Oeste"),
)


def state_dimension(spark: SparkSession, names: Names = Names()) -> DataFrame:
    columns = (names.code, *names.labels)
    schema = T.StructType([T.StructField(c, T.StringType(), False) for c in columns])
    # one partition: written as one file, whatever the size of the cluster
    return spark.createDataFrame(list(STATES), schema).coalesce(1)
