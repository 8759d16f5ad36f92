"""What a table holds: rows, columns, types and missing values; and missing columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelhouse.tables import TABLES


def profile(df: DataFrame, name: str) -> DataFrame:
    """One row per column: (table, column, type, rows, missing), from one scan."""
    counted = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count(F.col(c)).alias(f"c{i}") for i, c in enumerate(df.columns)],
    )
    return counted.select(F.inline(F.array(*[
        F.struct(
            F.lit(name).alias("table"), F.lit(column).alias("column"), F.lit(kind).alias("type"),
            F.col("rows"), (F.col("rows") - F.col(f"c{i}")).alias("missing"),
        )
        for i, (column, kind) in enumerate(df.dtypes)
    ])))


def missing_columns(name: str, found: Iterable[str]) -> list[str]:
    """Declared columns that a file header or table lacks."""
    present = set(found)
    return [c for c in TABLES[name].names if c not in present]


def conformance(found: dict[str, DataFrame]) -> DataFrame:
    """(table, declared, missing_column): one row per missing column, or one with null."""
    some = next(iter(found.values()))
    lines = [
        (name, len(TABLES[name].names), column)
        for name, df in found.items() for column in missing_columns(name, df.columns) or [None]
    ]
    return some.sparkSession.createDataFrame(
        lines, "table string, declared bigint, missing_column string")
