"""Aggregations that stay spread out when one group is very large."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_counts(df: DataFrame, *keys: str, **sums: Column) -> DataFrame:
    """Rows per distinct combination of keys, plus sums; combined before the shuffle."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(value).alias(name) for name, value in sums.items()],
    )


def most_common(value: Column, count: Column, wanted: Column) -> Column:
    """Over counted values: the most frequent one, ties to the smallest in byte order.

    Works on one row per distinct value, so no task ever holds a map of all values of a
    group, as mode() would.
    """
    rank = F.when(wanted & value.isNotNull(), F.struct(-count, value))
    return F.min_by(value, rank)
