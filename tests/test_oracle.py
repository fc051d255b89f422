"""Every registered query against its SQL in DuckDB, over whole tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__
from __spark_entry__ import entry
from reviewloom.plans.registry import ORACLE, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    yield con
    con.close()


SQL_TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "float": "FLOAT",
             "double": "DOUBLE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


def _sorted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return (sorted(columns), sorted((tuple(r[i] for i in order) for r in rows), key=repr))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, duck, name):
    got = QUERIES[name](spark, SF)
    want = duck.execute(ORACLE[name])
    want_columns = [d[0] for d in want.description]
    assert {c: SQL_TYPES[t] for c, t in got.dtypes} == {d[0]: str(d[1]) for d in want.description}
    assert _sorted(got.columns, [tuple(r) for r in got.collect()]) == _sorted(want_columns, want.fetchall())


def test_every_query_but_the_model_has_sql():
    assert set(QUERIES) - set(ORACLE) == {"feedback_model"}
    assert set(ORACLE) <= set(QUERIES)
    assert QUERIES.items() <= __spark_entry__.queries().items()
    assert ORACLE.items() <= __spark_entry__.oracle_sql().items()


def test_entry(spark):
    got = entry(spark)
    assert got.columns == ["key", "value"]
    assert got.count() == 200


def test_model_labels_every_document(spark):
    got = QUERIES["feedback_model"](spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert got.count() == docs.count() == got.select("doc_id").distinct().count()
    found = {r.feedback for r in got.select("feedback").distinct().collect()}
    assert found <= {"POSITIVE", "NEGATIVE", "NEUTRAL"} and len(found) > 1
