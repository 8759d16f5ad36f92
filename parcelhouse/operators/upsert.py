"""Insert-or-replace by key."""

from __future__ import annotations

from pyspark.sql import DataFrame


def not_replaced(existing: DataFrame, incoming: DataFrame, key: list[str]) -> DataFrame:
    """The existing rows whose key does not come in again."""
    return existing.join(incoming.select(*key), key, "left_anti").select(*existing.columns)


def upsert(existing: DataFrame | None, incoming: DataFrame, key: list[str]) -> DataFrame:
    """Incoming rows, plus the existing rows whose key does not come in again.

    Existing rows are never deleted. `incoming` must hold each key once; audits.py checks
    that before a new version is published.
    """
    if existing is None:
        return incoming
    return not_replaced(existing, incoming, key).select(*incoming.columns).unionByName(incoming)
