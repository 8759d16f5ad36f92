"""What tests of the tables share."""

from __future__ import annotations


def rows(df, *columns):
    """The rows as a set of tuples, of some columns or all."""
    return {tuple(r) for r in (df.select(*columns) if columns else df).collect()}
