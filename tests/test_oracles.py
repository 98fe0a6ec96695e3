"""Every registered query with SQL gives the rows that DuckDB gives on the same tables."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pytest

from lodestone.plans import fixtures, queries, records

QUERIES = {**queries.QUERIES, **records.QUERIES}
ORACLES = {**queries.ORACLES, **records.ORACLES}

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "null"
    if isinstance(v, bool):
        return str(int(v))
    return f"{float(v):.6g}" if isinstance(v, (int, float)) or type(v).__name__ == "Decimal" else str(v)


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(cell(r[i]) for i in order) for r in data])


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, str(DATA))
    found = rows(df.columns, [tuple(r) for r in df.collect()])
    cursor = duck.execute(ORACLES[name])
    names = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(names)
    assert found == rows(names, cursor.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)) + sorted(fixtures.QUERIES))
def test_other_queries_give_rows(spark, name):
    run = QUERIES.get(name) or fixtures.QUERIES[name]
    assert run(spark, str(DATA)).count() > 0


@pytest.mark.parametrize("partitions", ["1", "7"])
@pytest.mark.parametrize("name", ["asof_attach", "longest_run", "sliding_flag", "cascade_match", "detail_shards", "modal_name"])
def test_results_do_not_depend_on_partitions(spark, name, partitions):
    before = rows(*_collect(spark, name))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        assert rows(*_collect(spark, name)) == before
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def _collect(spark, name):
    df = QUERIES[name](spark, str(DATA))
    return df.columns, [tuple(r) for r in df.collect()]
