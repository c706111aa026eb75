from __future__ import annotations

import random

import pytest

pytest.importorskip("indicator_engine.llm.queries")

WORDS = [f"w{i}" for i in range(400)]


def passage(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="session")
def awkward_rows():
    """Nulls, empty and very long texts, copies, near copies, ties, a repeated row, special strings."""
    base = passage(1, 120)
    near = base.split()
    near[60] = "changed"
    long = passage(2, 60_000)
    return [
        (10, base, "en", "a"),
        (11, base, "en", "a"),
        (12, base.replace(" ", "\n\t "), "en", "b"),
        (13, base.upper(), "de", "b"),
        (14, " ".join(near), "de", "b"),
        (15, None, None, None),
        (16, "", "en", "a"),
        (17, " \t\n", "fr", None),
        (18, "one", "fr", "c"),
        (19, "one two", "fr", "c"),
        (20, "ONE  two", None, "c"),
        (21, "<|endoftext|> x<|endoftext|>", "es", "c"),
        (22, "é😀 ß x  y 　z \x00 12345.6 don't", "es", "d"),
        (23, long, "en", "d"),
        (24, "junk " + long[1000:9000] + " tail", "en", "d"),
        (25, "%%% 123 ###", "en", "d"),
        (26, passage(3, 300) + base, "fr", "d"),
        (26, passage(3, 300) + base, "fr", "d"),
        (None, base, "en", "a"),
        (27, "z" * 30_000, None, ""),
    ]


@pytest.fixture(scope="session")
def awkward(spark, awkward_rows):
    """The rows with further columns whose names the operators use themselves."""
    from pyspark.sql import functions as F

    frame = spark.createDataFrame(awkward_rows, "doc_id long, text string, lang string, source string").repartition(3)
    taken = ("size", "kept", "score", "_id", "_text", "_norm", "_row", "_bucket", "n_tokens", "target", "_keep", "piece_ids")
    return frame.withColumns({c: F.lit("x") for c in taken}).withColumn("n_chars", F.lit(None).cast("long")).cache()


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.where("false")
