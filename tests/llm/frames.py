"""Small documents for the operator tests."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

EXTRA = "doc_id long, text string, row string, score double, bin int, `_key` string"


def documents(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """(doc_id, text) rows, with further columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, "x", 0.5, 3, None) for i, t in rows], EXTRA).repartition(3)


def words(seed: int, n: int, vocabulary: int = 400) -> list[str]:
    rng = random.Random(seed)
    return [f"{'abcdefghij'[rng.randrange(10)]}{'aeiou'[rng.randrange(5)]}w{rng.randrange(vocabulary)}" for _ in range(n)]


def prose(seed: int, n: int, vocabulary: int = 400) -> str:
    return " ".join(words(seed, n, vocabulary))
