"""Integrity audits: what key, foreign key and domain constraints would have refused."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelhouse.operators.keys import key_problems, orphans, unmatched
from parcelhouse.tables import TABLES

Tables = Callable[[str], DataFrame]


class IntegrityError(Exception):
    """A table breaks a declared key, foreign key or domain."""


def _all(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def primary_keys(tables: Tables, names: Iterable[str]) -> DataFrame:
    """Per declared key: rows with a NULL part, keys used twice, surplus rows."""
    audited = [
        key_problems(tables(name), list(key)).select(
            F.lit(name).alias("table"), F.lit(", ".join(key)).alias("key"),
            "null_keys", "duplicate_keys", "surplus_rows",
        )
        for name in names
        for key in (TABLES[name].key, *TABLES[name].unique)
    ]
    return _all(audited)


def foreign_keys(
    tables: Tables, names: Iterable[str], parents: Tables | None = None
) -> DataFrame:
    """Per declared foreign key: keys without a parent and the rows that hold them.

    `parents` are given where the children are only a part of their table. Parents are then
    reduced to the keys in use before they are compared.
    """
    few, parents = parents is not None, parents or tables
    audited = []
    for name in names:
        for parent in TABLES[name].parents:
            lost = orphans(
                tables(name), list(parent.columns),
                parents(parent.table), list(parent.table_columns), few,
            )
            audited.append(lost.agg(
                F.lit(name).alias("table"),
                F.lit(", ".join(parent.columns)).alias("columns"),
                F.lit(parent.table).alias("parent"),
                F.count(F.lit(1)).alias("orphan_keys"),
                F.coalesce(F.sum("n"), F.lit(0)).alias("orphan_rows"),
            ))
    return _all(audited)


def _rules(name: str) -> Iterator[tuple[str, str]]:
    """(label, condition of a failing row) for every rule of a table."""
    table = TABLES[name]
    for c in table.columns:
        if c.required:
            yield f"{c.name}: not null", f"{c.name} IS NULL"
        if c.length:
            yield f"{c.name}: length <= {c.length}", f"length({c.name}) > {c.length}"
    yield from _value_rules(name)


def _value_rules(name: str) -> Iterator[tuple[str, str]]:
    """Only the rules on values. A NULL passes them."""
    table = TABLES[name]
    for column, (low, high) in table.between.items():
        yield f"{column}: between {low} and {high}", f"{column} NOT BETWEEN {low} AND {high}"
    for column, values in table.allowed.items():
        listed = ", ".join(f"'{v}'" for v in values)
        yield f"{column}: in ({', '.join(values)})", f"{column} NOT IN ({listed})"


def _violations(tables: Tables, names: Iterable[str], rules) -> DataFrame:
    """One aggregate per table, one output row per rule."""
    audited = []
    for name in names:
        found = dict(rules(name))
        if not found:
            continue
        counts = tables(name).agg(
            *[F.expr(f"count_if({failing}) AS `{label}`") for label, failing in found.items()]
        )
        audited.append(
            counts.unpivot([], [f"`{label}`" for label in found], "label", "failing_rows")
            .withColumn("table", F.lit(name))
        )
    return _all(audited).selectExpr(
        "table", "split_part(label, ': ', 1) AS column", "split_part(label, ': ', 2) AS rule",
        "failing_rows",
    )


def domains(tables: Tables, names: Iterable[str]) -> DataFrame:
    """NOT NULL, length and value rules of every column."""
    return _violations(tables, names, _rules)


def value_checks(tables: Tables, names: Iterable[str]) -> DataFrame:
    return _violations(tables, names, _value_rules)


def row_counts(tables: Tables, names: Iterable[str]) -> DataFrame:
    return _all(
        tables(name).agg(F.lit(name).alias("table"), F.count(F.lit(1)).alias("rows"))
        for name in names
    )


def compare_counts(actual: DataFrame, expected: dict[str, int]) -> DataFrame:
    """(table, rows, expected, ok) for every table a count is expected of."""
    wanted = actual.sparkSession.createDataFrame(
        list(expected.items()), "table string, expected bigint"
    )
    return wanted.join(actual, "table", "left").select(
        "table", "rows", "expected", F.equal_null("rows", "expected").alias("ok")
    )


def domain_measures(name: str) -> dict[str, Column]:
    """The domain rules of a table as aggregates, to be taken while it is written."""
    return {
        f"{name}.{label}": F.expr(f"count_if({failing})") for label, failing in _rules(name)
    }


def domain_failures(tables: Tables, names: list[str]) -> dict[str, int]:
    """What domain_measures would have counted, of rows that are already written."""
    return {
        f"{r['table']}.{r['column']}: {r['rule']}": r["failing_rows"]
        for r in (domains(tables, names).collect() if names else ())
    }


def enforce(
    arrived: Tables, tables: Tables, names: list[str], outside: dict[str, int], at_once: int = 8
) -> None:
    """Raise IntegrityError if the rows that arrive in any of the tables break a declared rule.

    `outside` holds what the domain rules counted. Parents are looked up in whole tables. Keys and foreign keys are audited side
    by side as small jobs of their own; only broken ones reach the driver. Tables that arrive as a
    whole are held against a parent together; of others the few keys are looked up by themselves.
    """
    def whole(name: str) -> bool:
        return not TABLES[name].partition or (
            set(arrived(name).inputFiles()) == set(tables(name).inputFiles()))

    together: dict[tuple, list] = {}
    for name in filter(whole, names):
        for parent in TABLES[name].parents:
            together.setdefault((parent.table, parent.table_columns), []).append((name, parent))

    def bad_keys(name: str) -> list[str]:
        found = primary_keys(arrived, [name]).where("null_keys + duplicate_keys > 0").collect()
        return [f"{name} ({r['key']})" for r in found]

    def bad_children(parent: str, columns: tuple[str, ...], children: list) -> list[str]:
        lost = unmatched(tables(parent), list(columns), [
            (arrived(name), list(key.columns)) for name, key in children]).first()
        return [f"{name} ({', '.join(key.columns)}) -> {parent}"
                for (name, key), keys in zip(children, lost) if keys]

    def bad_parents(name: str) -> list[str]:
        found = foreign_keys(arrived, [name], tables).where("orphan_keys > 0").collect()
        return [f"{name} ({r['columns']}) -> {r['parent']}" for r in found]

    with ThreadPoolExecutor(at_once) as pool:
        jobs = [pool.submit(bad_keys, name) for name in names]
        jobs += [pool.submit(bad_children, *parent, children) for parent, children in together.items()]
        alone = [name for name in names if not any((name, p) in c for c in together.values()
                                                   for p in TABLES[name].parents)]
        jobs += [pool.submit(bad_parents, name) for name in alone if TABLES[name].parents]
        broken = [rule for job in jobs for rule in job.result()]
    broken += [rule for rule, failing in outside.items() if failing]
    if broken:
        raise IntegrityError("; ".join(broken))
