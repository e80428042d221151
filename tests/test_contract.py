"""Every registered query gives the rows its SQL gives, on the smallest test tables."""

from __future__ import annotations

import glob
import os
import uuid

import duckdb
import pytest

import __spark_entry__ as contract
from sluiceworks.plans import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(round(v, 9) if isinstance(v, float) else v for v in (r[i] for i in order)) for r in rows),
        key=repr,
    )


def test_every_query_has_expected_rows():
    assert set(QUERIES) == set(ORACLE)
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = contract.queries()[name](spark, SF)
    found = duck.execute(contract.oracle_sql()[name])
    columns = [d[0] for d in found.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, found.fetchall())


@pytest.mark.parametrize("name", ["incr_jdbc", "db_upsert_row"])
def test_embedded_database_in_a_folder_named_by_uri(spark, duck, tmp_path, monkeypatch, name):
    folder = lambda _, label: f"file://{tmp_path}/{label}-{uuid.uuid4().hex}"
    monkeypatch.setattr("sluiceworks.plans.queries.scratch_dir", folder)
    test_query(spark, duck, name)


def test_entry(spark):
    assert contract.entry(spark).count() > 0
