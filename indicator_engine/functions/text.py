from __future__ import annotations

import re
import unicodedata
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Texts that count as "yes" in the micro-data flag (case folded).
TRUE_TEXTS = ("1", "sim", "true")

# Code of the school network and its label.
NETWORKS = {
    "0": "Total",
    "1": "Federal",
    "2": "Estadual",
    "3": "Municipal",
    "4": "Privada",
    "5": "Pública (Estadual e Municipal)",
    "6": "Pública (Federal, Estadual e Municipal)",
}


def flag_from_text(c: Column | str, true_texts: Sequence[str] = TRUE_TEXTS) -> Column:
    """1 when the text is one of ``true_texts`` in any case, else 0 — also for null."""
    column = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.lower(column).isin(*true_texts).cast("int"), F.lit(0))


def pad_key(c: Column | str, width: int = 7) -> Column:
    """Left-pad a key with zeros up to ``width``; a longer key is kept whole."""
    text = (F.col(c) if isinstance(c, str) else c).cast("string")
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def decode(c: Column | str, labels: Mapping[str, str] = NETWORKS) -> Column:
    """Label of a code from a fixed map; null for an unknown code."""
    pairs = [F.lit(part) for item in labels.items() for part in item]
    return F.create_map(*pairs)[F.col(c) if isinstance(c, str) else c]


def snake_case(name: str) -> str:
    plain = unicodedata.normalize("NFKD", name).encode("ascii", "ignore").decode()
    words = re.sub(r"([a-z0-9])([A-Z])", r"\1 \2", plain)
    body = re.sub(r"[^0-9a-zA-Z]+", "_", words).strip("_").lower()
    return "_" + body if name.startswith("_") else body


def snake_columns(df: DataFrame) -> DataFrame:
    """Column names in snake_case without accents."""
    return df.toDF(*(snake_case(name) for name in df.columns))
