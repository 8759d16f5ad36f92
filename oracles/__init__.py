"""DuckDB SQL that computes the expected result of each registered query.

Each query names the building blocks it needs (raw_orders, stg_items, ...); with_blocks
puts them in front as common table expressions.
"""

from __future__ import annotations

import re

from oracles.blocks import BLOCKS


def with_blocks(sql: str) -> str:
    """The query, preceded by the blocks it uses, each after the blocks it uses itself."""
    ordered: list[str] = []

    def add(text: str) -> None:
        for name in BLOCKS:
            if name not in ordered and re.search(rf"\b{name}\b", text):
                add(BLOCKS[name])
                if name not in ordered:
                    ordered.append(name)

    add(sql)
    if not ordered:
        return sql
    return "WITH " + ",\n".join(f"{n} AS ({BLOCKS[n]})" for n in ordered) + "\n" + sql
