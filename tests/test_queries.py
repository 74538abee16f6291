"""Every registered reference query against its SQL in DuckDB, over the whole small tables."""

from __future__ import annotations

import datetime
import math
import os

import duckdb
import pytest

from leaguespark.plans.registry import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


def cell(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else f"{x:.4f}"
    return x.isoformat() if isinstance(x, datetime.date) else str(x)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(cell(row[i]) for i in order) for row in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in os.listdir(SF_DIR):
        con.sql(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{SF_DIR}/{file}'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_gives_what_its_sql_gives(spark, duck, name):
    found = QUERIES[name](spark, SF_DIR)
    want = duck.sql(ORACLES[name])
    assert sorted(found.columns) == sorted(want.columns)
    assert rows_of(found.columns, found.collect()) == rows_of(want.columns, want.fetchall())
