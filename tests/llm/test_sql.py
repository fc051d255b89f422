"""The corpus queries that SQL can state, against DuckDB over whole tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__
from reviewloom.llm.queries import ORACLE, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    got, want = QUERIES[name](spark, SF), con.execute(ORACLE[name])
    columns = sorted(got.columns)
    assert {c: TYPES[t] for c, t in got.dtypes} == {d[0]: str(d[1]) for d in want.description}
    at = [[d[0] for d in want.description].index(c) for c in columns]
    want = [tuple(row[i] for i in at) for row in want.fetchall()]
    assert sorted(map(tuple, got.select(columns).collect()), key=repr) == sorted(want, key=repr)


def test_one_query_per_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert QUERIES.items() <= __spark_entry__.queries().items()
    assert "pipeline" in __spark_entry__.queries()
