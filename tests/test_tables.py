"""Is the declared model consistent?"""

import pytest

from parcelhouse.plans import profile
from parcelhouse.sources.csv_files import CSV_FILES
from parcelhouse.sources.driver_tables import RawTables
from parcelhouse.plans.warehouse import Warehouse
from parcelhouse.tables import TABLES, in_layer

NAMES = list(TABLES)


def test_number_of_tables():
    counts = {layer: len(in_layer(layer)) for layer in ("raw", "staging", "analytics", "marts")}
    assert counts == {"raw": 9, "staging": 8, "analytics": 10, "marts": 4}


def test_number_of_foreign_keys():
    counts = {layer: sum(len(t.parents) for t in in_layer(layer))
              for layer in ("raw", "staging", "analytics")}
    assert counts == {"raw": 6, "staging": 5, "analytics": 9}


@pytest.mark.parametrize("name", NAMES)
def test_table_is_consistent(name):
    table = TABLES[name]
    names = set(table.names)
    assert len(names) == len(table.columns)
    assert table.key and set(table.key) <= names
    for unique in table.unique:
        assert set(unique) <= names
    assert set(table.between) | set(table.allowed) <= names
    for parent in table.parents:
        assert set(parent.columns) <= names
        other = TABLES[parent.table]
        assert parent.table_columns == other.key
        assert list(TABLES).index(parent.table) < NAMES.index(name)
        kinds = {c.name: c.type for c in other.columns}
        ours = {c.name: c.type for c in table.columns}
        for a, b in zip(parent.columns, parent.table_columns):
            assert ours[a] == kinds[b]


def test_every_raw_table_has_a_file():
    assert {f"raw.{n}" for n in CSV_FILES} == {t.name for t in in_layer("raw")}


@pytest.mark.parametrize("name", list(CSV_FILES))
def test_renamed_headers_are_columns(name):
    assert set(CSV_FILES[name].rename.values()) <= set(TABLES[f"raw.{name}"].names)


@pytest.mark.parametrize("name", [n for n in NAMES if not n.startswith("meta.")])
def test_built_table_has_declared_columns(spark, small, name):
    built = Warehouse(RawTables(spark, small)).table(name)
    assert profile.missing_columns(name, built.columns) == []
    declared = {c.name: c.type for c in TABLES[name].columns}
    assert {c: t for c, t in built.dtypes} == declared


def test_missing_columns_are_named():
    assert profile.missing_columns("raw.sellers", ["seller_id", "seller_city"]) == [
        "seller_zip_code_prefix", "seller_state"]
