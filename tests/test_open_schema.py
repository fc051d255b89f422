"""A stream whose fields nobody declared."""

import json

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import types as T

from reviewloom.streaming.open_schema import OpenTable, found_type, join, readable

KINDS = st.recursive(
    st.sampled_from([T.NullType(), T.BooleanType(), T.StringType(), T.LongType(), T.DoubleType()]),
    lambda inner: st.one_of(inner.map(T.ArrayType), st.dictionaries(st.sampled_from("abc"), inner, max_size=3).map(
        lambda d: T.StructType([T.StructField(n, k) for n, k in d.items()]))), max_leaves=6)


def unordered(kind):
    if isinstance(kind, T.StructType):
        return {f.name: unordered(f.dataType) for f in kind}
    return [unordered(kind.elementType)] if isinstance(kind, T.ArrayType) else type(kind)


@given(KINDS, KINDS, KINDS)
def test_join_is_a_lattice(a, b, c):
    same = lambda x, y: unordered(x) == unordered(y)
    assert join(a, a) == a
    assert same(join(a, b), join(b, a))
    assert same(join(join(a, b), c), join(a, join(b, c)))
    assert same(join(join(a, b), a), join(a, b))


def test_found_types(spark):
    assert found_type("OBJECT<a: BIGINT, `x OBJECT<y`: OBJECT<d: DECIMAL(2,1)>, n: VOID, e: ARRAY<VARIANT>, f: DOUBLE>") == T.StructType.fromDDL(
        "a bigint, `x OBJECT<y` struct<d: double>, n void, e array<string>, f double")
    assert found_type("VARIANT") == found_type(None) == found_type("VOID") == T.StructType([])
    assert readable(T.StructType.fromDDL("a void, b array<void>")) == T.StructType.fromDDL("a string, b array<string>")


def deliver(spark, table, *batches):
    for i, lines in enumerate(batches):
        table.deliver(spark.createDataFrame([(line,) for line in lines], "value string"), i)


def rows(df):
    return ordered(json.loads(r) for r in df.toJSON().collect())


def ordered(found):
    return sorted(found, key=lambda row: json.dumps(row, sort_keys=True))


def test_later_batches_widen_the_schema(spark, tmp_path):
    table = OpenTable(str(tmp_path))
    deliver(spark, table, ['{"a":1,"b":"x"}', '{"a":2}'], ['{"b":"y","a":3}'], ['{"a":2.5,"c":{"d":true}}', '{"c":{"e":[1,2]},"n":null}'])
    assert [v[0] for v in table.versions(spark)] == [0, 2]
    assert table.schema(spark, before=2) == T.StructType.fromDDL("a bigint, b string")
    got = table.read(spark)
    assert got.schema == T.StructType.fromDDL("a double, b string, c struct<d: boolean, e: array<bigint>>, n string")
    assert rows(got) == ordered([{"a": 1.0, "b": "x"}, {"a": 2.0}, {"a": 3.0, "b": "y"}, {"a": 2.5, "c": {"d": True}}, {"c": {"e": [1, 2]}}])


def test_values_that_do_not_go_together_become_text(spark, tmp_path):
    table = OpenTable(str(tmp_path))
    deliver(spark, table, ['{"a":1,"b":[1],"c":{"x":1}}'], ['{"a":"one","b":[true],"c":[2]}'])
    assert rows(table.read(spark)) == ordered([{"a": "1", "b": ["1"], "c": '{"x":1}'}, {"a": "one", "b": ["true"], "c": "[2]"}])


def test_odd_lines_and_names(spark, tmp_path):
    table = OpenTable(str(tmp_path))
    lines = ['{"x y":1,"it\'s":2,"d.o.t":3,"A":4}', ' {"a":5}', "[1]", "7", "broken", '{"open":', "", None, "{}"]
    deliver(spark, table, lines)
    got = table.read(spark)
    assert sorted(got.columns) == ["A", "d.o.t", "it's", "x y"]
    assert rows(got) == ordered([{"x y": 1, "it's": 2, "d.o.t": 3, "A": 4}, {"A": 5}, {}])
    assert sorted((r.line for r in table.rejected(spark).collect()), key=repr) == sorted(["[1]", "7", "broken", '{"open":', "", None], key=repr)


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    table = OpenTable(str(tmp_path))
    deliver(spark, table, ['{"a":1}'], ['{"b":1}'])
    before = (table.versions(spark), rows(table.read(spark)))
    table.deliver(spark.createDataFrame([('{"b":1}',)], "value string"), 1)
    assert (table.versions(spark), rows(table.read(spark))) == before


def test_empty_batches(spark, tmp_path):
    table = OpenTable(str(tmp_path))
    deliver(spark, table, [], ['{"a":1}'], [])
    assert rows(table.read(spark)) == [{"a": 1}]


def test_a_batch_is_scanned_once(spark, tmp_path):
    """The fields come from the pass that writes the rows."""
    reads = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    lines = spark.range(50).selectExpr("'{\"a\":' || id || '}' AS value").mapInArrow(count, "value string")
    OpenTable(str(tmp_path)).deliver(lines, 0)
    assert reads.value == 50
