"""Key uniqueness and foreign keys, checked by counting keys before any shuffle."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelhouse.operators.grouping import with_counts


def key_problems(df: DataFrame, key: list[str]) -> DataFrame:
    """One row: how many rows lack part of the key, keys used twice, and surplus rows."""
    missing = F.greatest(*[F.col(c).isNull() for c in key]) if len(key) > 1 else F.col(key[0]).isNull()
    repeated = ~missing & (F.col("n") > 1)
    counted = with_counts(df, *key)
    return counted.agg(
        F.coalesce(F.sum(F.when(missing, F.col("n"))), F.lit(0)).alias("null_keys"),
        F.count_if(repeated).alias("duplicate_keys"),
        F.coalesce(F.sum(F.when(repeated, F.col("n") - 1)), F.lit(0)).alias("surplus_rows"),
    )


def unmatched(
    parent: DataFrame, parent_columns: list[str], children: list[tuple[DataFrame, list[str]]]
) -> DataFrame:
    """One row: of each child (`keys_1`, `keys_2`...) how many of its keys no parent has.

    NULL keys do not count. Parent and children are counted by key together: the parent is moved
    once for all its children, each table as one row per key and task, and nothing is sorted.
    """
    key = [f"_key_{i}" for i in range(len(parent_columns))]
    sides = [
        df.select(*[F.col(c).alias(k) for c, k in zip(columns, key)], F.lit(i).alias("_side")).dropna()
        for i, (df, columns) in enumerate([(parent, parent_columns), *children])
    ]
    places = range(1, len(sides))
    counted = reduce(DataFrame.unionAll, sides).groupBy(*key).agg(
        *[F.bool_or(F.col("_side") == i).alias(f"_in_{i}") for i in (0, *places)])
    return counted.where("NOT _in_0").agg(
        *[F.count_if(f"_in_{i}").alias(f"keys_{i}") for i in places])


def orphans(
    child: DataFrame, columns: list[str], parent: DataFrame, parent_columns: list[str],
    few: bool = False,
) -> DataFrame:
    """Distinct child keys without a parent, with their row counts; NULL keys do not count.

    Children are reduced to one row per key first, so a hot key is one row in the join. Of
    `few` children the keys first filter the parents where these are read (Spark broadcasts
    them, or makes a Bloom filter of them, by their size), so that few parents are shuffled.
    """
    used = with_counts(child.select(*columns).dropna(), *columns)
    known = parent.select(*[F.col(p).alias(c) for p, c in zip(parent_columns, columns)])
    if few:
        known = known.join(used.select(*columns), columns, "left_semi")
    return used.join(known, columns, "left_anti")
