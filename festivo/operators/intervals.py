"""Joins of day intervals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

BUCKET_DAYS = 28


def _buckets(first: Column, last: Column, days: int) -> Column:
    """Numbers of the buckets that an interval touches; none for an empty or unknown interval."""
    number = lambda day: F.floor(F.unix_date(day) / days).cast("int")
    return F.when(first <= last, F.sequence(number(first), number(last)))


def overlap_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_interval: tuple[str, str],
    right_interval: tuple[str, str],
    bucket_days: int = BUCKET_DAYS,
) -> DataFrame:
    """Pairs of rows with equal keys whose closed day intervals overlap, each pair once.

    Both sides are expanded to the buckets of ``bucket_days`` that they touch and joined by equality on keys and
    bucket, so that a key with many intervals is spread over time. The overlap is tested on what the buckets bring
    together, and a pair that shares several buckets counts in the first of them. Null or reversed intervals overlap
    nothing.
    """
    a, b = left_interval
    c, d = right_interval
    spread = left.withColumn("_bucket", F.explode(_buckets(F.col(a), F.col(b), bucket_days)))
    others = right.withColumn("_bucket", F.explode(_buckets(F.col(c), F.col(d), bucket_days)))
    first = F.floor(F.unix_date(F.greatest(a, c)) / bucket_days)
    meets = (F.col(a) <= F.col(d)) & (F.col(c) <= F.col(b)) & (F.col("_bucket") == first)
    return spread.join(others, [*keys, "_bucket"]).filter(meets).drop("_bucket")
