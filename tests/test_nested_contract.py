"""Contracts compiled from schema files."""

import json

import pytest
from pyspark.sql import types as T

from reviewloom.operators.contract import check_contract
from reviewloom.operators.nested_contract import ContractError, check_nested, compile_contract, incompatibilities
from reviewloom.schema import REVIEW
from reviewloom.sources.tables import contract_lines

REVIEW_FILE = """{"type": "record", "name": "review", "fields": [
  {"name": "review_id", "type": "string"}, {"name": "user_id", "type": "string"}, {"name": "business_id", "type": "string"},
  {"name": "stars", "type": "float"}, {"name": "date", "type": "string"}, {"name": "text", "type": "string"},
]}"""

ORDER = {"type": "record", "name": "order", "namespace": "shop", "fields": [
    {"name": "id", "type": "long"},
    {"name": "state", "type": {"type": "enum", "name": "state", "symbols": ["open", "done"]}},
    {"name": "buyer", "type": ["null", {"type": "record", "name": "person", "fields": [
        {"name": "name", "type": "string"}, {"name": "age", "type": ["null", "int"], "default": None}]}]},
    {"name": "seller", "type": "person"},
    {"name": "items", "type": {"type": "array", "items": {"type": "record", "name": "item", "fields": [
        {"name": "sku", "type": "string"}, {"name": "n", "type": "int", "default": 1}]}}},
    {"name": "notes", "type": {"type": "map", "values": "string"}, "default": {}},
    {"name": "currency", "type": "string", "default": "EUR"},
]}


def order(**changes):
    row = {"id": 1, "state": "open", "buyer": {"name": "a", "age": 3}, "seller": {"name": "b"}, "items": [{"sku": "x", "n": 2}], "notes": {"k": "v"}}
    row |= changes
    return json.dumps({k: v for k, v in row.items() if v != "absent"})


def compiled(read):
    return compile_contract(json.dumps(read))


def test_flat_contract_is_the_fixed_schema(spark):
    contract = compile_contract(REVIEW_FILE)
    assert contract.schema == REVIEW
    lines = contract_lines(spark, "/root/testdata/sf0.001")
    key = lambda df: sorted(map(tuple, df.select(*REVIEW.names, "line", "status", "reason").collect()), key=repr)
    assert key(check_nested(lines, contract)) == key(check_contract(lines))


@pytest.mark.parametrize("line, reason", [
    (order(), None), (order(buyer=None), None), (order(buyer="absent"), None), (order(id="absent"), "missing:id"), (order(id=None), "missing:id"),
    (order(buyer={"age": 3}), "missing:buyer.name"), (order(seller={}), "missing:seller.name"), (order(seller=None), "missing:seller"),
    (order(items="absent"), "missing:items"), (order(items=[]), None), (order(items=[{"sku": "x"}, {"n": 1}]), "missing:items[].sku"),
    (order(items=[None]), "missing:items[]"), (order(state="lost"), "symbol:state"), (order(notes={"k": None}), "missing:notes[]"),
    (order(notes="absent"), None), (order(id="text"), "malformed"), (order(buyer=7), "malformed"), (order()[:30], "malformed"),
    (order() + order(), "malformed"), ("", "blank"), (None, "blank"), ("[]", "malformed"), ("{}", "missing:id")])
def test_reasons(spark, lines, line, reason):
    row = check_nested(lines(line), compiled(ORDER)).first()
    assert (row.reason, row.status) == (reason, "quarantine" if reason else "valid")


def test_defaults_are_filled_in(spark, lines):
    row = check_nested(lines(order(), order(currency="USD"), order(currency=None)), compiled(ORDER)).collect()
    assert [r.currency for r in row] == ["EUR", "USD", "EUR"]


def test_names_of_the_result_are_refused(lines):
    with pytest.raises(ContractError, match="status"):
        check_nested(lines("{}"), record(("status", "int")))


def test_column_types():
    assert compiled(ORDER).schema == T.StructType([
        T.StructField("id", T.LongType()), T.StructField("state", T.StringType()),
        T.StructField("buyer", T.StructType([T.StructField("name", T.StringType()), T.StructField("age", T.IntegerType())])),
        T.StructField("seller", T.StructType([T.StructField("name", T.StringType()), T.StructField("age", T.IntegerType())])),
        T.StructField("items", T.ArrayType(T.StructType([T.StructField("sku", T.StringType()), T.StructField("n", T.IntegerType())]))),
        T.StructField("notes", T.MapType(T.StringType(), T.StringType())), T.StructField("currency", T.StringType())])


@pytest.mark.parametrize("wrong", [
    {"type": "array", "items": "int"}, ["null", ORDER], {"type": "record", "name": "r", "fields": [{"name": "a", "type": ["int", "string"]}]},
    {"type": "record", "name": "r", "fields": [{"name": "a", "type": "r"}]}, {"type": "record", "name": "r", "fields": [{"name": "a", "type": "nothing"}]},
    {"type": "record", "name": "r", "fields": [{"name": "a", "type": "int"}, {"name": "A", "type": "int"}]}])
def test_what_cannot_be_a_contract_is_refused(wrong):
    with pytest.raises(ContractError):
        compiled(wrong)


def record(*fields):
    return compiled({"type": "record", "name": "r", "fields": [{"name": n, "type": k, **(d[0] if d else {})} for n, k, *d in fields]})


@pytest.mark.parametrize("reader, writer, wrong", [
    ([("a", "long")], [("a", "int")], []), ([("a", "int")], [("a", "long")], ["a is long in the data, not int"]),
    ([("a", "int"), ("b", "int")], [("a", "int")], ["b is not in the data and has no default"]),
    ([("a", "int"), ("b", "int", {"default": 1})], [("a", "int")], []), ([("a", ["null", "int"])], [], []),
    ([], [("a", "int")], []), ([("a", "int")], [("a", ["null", "int"])], ["a may be null in the data"]),
    ([("a", ["null", "int"])], [("a", "int")], []), ([("a", "double")], [("a", "float")], []),
    ([("a", {"type": "enum", "name": "e", "symbols": ["x"]})], [("a", {"type": "enum", "name": "e", "symbols": ["x", "y"]})], ["a may be y in the data"]),
    ([("a", {"type": "array", "items": "int"})], [("a", {"type": "array", "items": ["null", "int"]})], ["a[] may be null in the data"]),
    ([("a", {"type": "record", "name": "s", "fields": [{"name": "b", "type": "int"}]})], [("a", {"type": "record", "name": "s", "fields": []})],
     ["a.b is not in the data and has no default"]), ([("a", "int", {"default": 5})], [("a", ["null", "int"])], [])])
def test_compatibility(reader, writer, wrong):
    assert incompatibilities(record(*reader), record(*writer)) == wrong
