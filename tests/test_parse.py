import json
import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reviewloom.functions.records import is_json, to_json
from reviewloom.functions.text import WHITESPACE, decode_utf8, prompt, strip
from reviewloom.operators.contract import check_contract, split_contract, write_split
from reviewloom.operators.envelope import to_envelope
from reviewloom.operators.parse import decode_values, parse_records
from reviewloom.schema import REVIEW

FULL = ('{"review_id":"a","user_id":"u","business_id":"b","stars":5,'
        '"date":"2024-01-01 00:00:00","text":"fine"}')

# line -> (fields that are not null, reason given by the contract)
CASES = {
    FULL: ({"review_id": "a", "user_id": "u", "business_id": "b", "stars": 5.0,
            "date": "2024-01-01 00:00:00", "text": "fine"}, None),
    "not json": ({}, "malformed"),
    "": ({}, "blank"),
    None: ({}, "blank"),
    "  \t": ({}, "blank"),
    '{"review_id":"c","stars":"4.5","text":null}': ({"review_id": "c"}, "malformed"),
    '{"review_id":"e","stars":"bad","text":""}': ({"review_id": "e", "text": ""}, "malformed"),
    '{"review_id":"big","stars":1e400}': ({"review_id": "big", "stars": math.inf}, "missing:user_id"),
    '{"review_id":"n","text":{"a":1}}': ({"review_id": "n", "text": '{"a":1}'}, "missing:user_id"),
    '{"Review_ID":"case"}': ({}, "missing:review_id"),
    '  {"review_id":"s"}  ': ({"review_id": "s"}, "missing:user_id"),
    '{"review_id":"one"} {"review_id":"two"}': ({"review_id": "one"}, "malformed"),
    FULL + FULL: ({"review_id": "a", "user_id": "u", "business_id": "b", "stars": 5.0,
                   "date": "2024-01-01 00:00:00", "text": "fine"}, "malformed"),
    '{"review_id":"cut","te': ({}, "malformed"),
    '[{"review_id":"arr"}]': ({}, "malformed"),
    "[]": ({}, "malformed"),
    "null": ({}, "malformed"),
    FULL + ',"line":' + FULL: ({"review_id": "a", "user_id": "u", "business_id": "b", "stars": 5.0,
                                "date": "2024-01-01 00:00:00", "text": "fine"}, "malformed"),
    FULL.replace('"text":"fine"', '"text":[1,2]'): (
        {"review_id": "a", "user_id": "u", "business_id": "b", "stars": 5.0,
         "date": "2024-01-01 00:00:00", "text": "[1,2]"}, None),
    FULL.replace("}", ',"x":' + "7" * 1500 + "}"): (
        {"review_id": "a", "user_id": "u", "business_id": "b", "stars": 5.0,
         "date": "2024-01-01 00:00:00", "text": "fine"}, None),
    FULL.replace('"text":"fine"', '"extra":1'): (
        {"review_id": "a", "user_id": "u", "business_id": "b", "stars": 5.0,
         "date": "2024-01-01 00:00:00"}, "missing:text"),
}


def _set_fields(row):
    return {k: v for k, v in row.asDict().items() if v is not None}


@pytest.mark.parametrize("line", CASES, ids=str)
def test_permissive_keeps_every_line(lines, line):
    (row,) = parse_records(lines(line)).collect()
    assert _set_fields(row) == CASES[line][0]


def test_bare_nan_and_numbers_as_text(lines):
    (row,) = parse_records(lines('{"review_id":7,"stars":NaN,"text":NaN,"extra":1}')).collect()
    assert row.review_id == "7" and math.isnan(row.stars) and row.text == '"NaN"'


def test_contract_reasons(lines):
    got = {r.line: r.reason for r in check_contract(lines(*CASES)).collect()}
    assert got == {line: reason for line, (_, reason) in CASES.items()}


def test_split_is_complete_and_apart(lines):
    valid, bad = split_contract(lines(*CASES))
    n_valid = sum(reason is None for _, reason in CASES.values())
    assert [r.review_id for r in valid.collect()] == ["a"] * n_valid
    assert valid.schema.names == REVIEW.names
    assert bad.count() + valid.count() == len(CASES)


def test_write_split_keeps_raw_lines_of_bad_records_only(spark, lines, tmp_path):
    write_split(check_contract(lines(*CASES)), str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert {r.status: r.n for r in back.groupBy("status").agg(F.count("*").alias("n")).collect()} == {
        "valid": 3, "quarantine": len(CASES) - 3}
    assert back.filter("status = 'valid'").first().line is None
    assert back.filter("reason = 'malformed' AND line = 'not json'").count() == 1


def test_required_fields_are_a_choice(lines):
    checked = check_contract(lines('{"review_id":"x"}'), required=["review_id"])
    assert checked.first().status == "valid"


def test_drop_removes_only_what_is_not_json(lines):
    partly = '{"review_id":"c","stars":"4.5"}'
    got = parse_records(lines(FULL, "junk", "", None, "[]", "3", partly, "{'review_id':'q'}", "\t"), mode="drop")
    assert [r.review_id for r in got.collect()] == ["a", None, None, "c"]
    assert got.schema == parse_records(lines(FULL)).schema


def _python_reads(value):
    try:
        return value is not None and (json.loads(value), True)[1]
    except json.JSONDecodeError:
        return False


@settings(max_examples=12)
@given(st.lists(st.one_of(
    st.none(), st.text("{}[]:,\"'aeltrufNn0. \\\t", max_size=14),
    st.tuples(st.sampled_from([FULL, "{}", "1", '"x"']), st.sampled_from([',"x":', ',"end":true}', "],", "},{", ',{"a":', "]"]),
              st.sampled_from([FULL, "1", "", "2}"])).map("".join),
    st.recursive(st.one_of(st.none(), st.booleans(), st.integers(-9, 9), st.text(max_size=3)),
                 lambda v: st.one_of(st.lists(v, max_size=3),
                                     st.dictionaries(st.sampled_from([*REVIEW.names, "x"]), v, max_size=4)),
                 max_leaves=8).map(json.dumps)), min_size=60, max_size=120))
def test_drop_is_a_filter_on_the_line(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "value string")
    judged = df.select("value", is_json(F.col("value")).alias("good")).collect()
    assert [(r.value, r.good) for r in judged] == [(v, _python_reads(v)) for v in values]
    want = parse_records(df.filter(is_json(F.col("value"))))
    assert sorted(map(repr, parse_records(df, mode="drop").collect())) == sorted(map(repr, want.collect()))


def test_unknown_modes_are_refused(lines):
    with pytest.raises(ValueError):
        parse_records(lines(FULL), mode="split")
    with pytest.raises(ValueError):
        decode_utf8(F.col("value"), "ignore")


def test_is_json_is_never_null(lines):
    good = ["{}", "[]", "1", '"x"', "null", ' {"a":1} ', '{"a":NaN}', '{"a":1,"a":2}', '{"a":{"b":[1]}}']
    bad = [FULL + ',"x":1', FULL + ',"end":true}trash', FULL + ',"line":' + FULL, FULL + "," + FULL, FULL + '],"line":[' + FULL,
           "1,2", '"a","b"', "nope", "", "  ", None, '{"a":', "[1,", "tru", "{'a':1}", '{"a":1,"b":tru}', "01",
           "{} {}", "{}{}", "{},{}", '{"a":1} x', '{"a":1}}', '{"a":1}]', "1}", "1,", "\x0b1"]
    got = lines(*good, *bad).select(is_json(F.col("value")).alias("v")).collect()
    assert [r.v for r in got] == [True] * len(good) + [False] * len(bad)


def test_texts_of_any_length_stay_whole(spark):
    n = 21_000_000
    line = spark.range(1).select(F.concat(
        F.lit(FULL[:-6]), F.repeat(F.lit("x"), F.lit(n)), F.lit('"}')).alias("value"))
    for mode in ("permissive", "drop"):
        assert parse_records(line, mode=mode).select(F.length("text").alias("n")).first().n == n
    assert check_contract(line).first().status == "valid"


def test_decode_modes(spark):
    raw = spark.createDataFrame([(bytearray(b"a\xff\xfeb"),), (bytearray("é".encode()),), (None,)],
                                "value binary")
    assert [r.value for r in decode_values(raw).collect()] == ["a��b", "é", None]
    assert [r.value for r in decode_values(raw, "null").collect()] == [None, "é", None]
    with pytest.raises(Exception, match="MALFORMED_CHARACTER_CODING"):
        decode_values(raw, "fail").collect()


@settings(max_examples=8)
@given(st.lists(st.binary(max_size=40), min_size=30, max_size=60))
def test_replacing_decode_never_fails(spark, values):
    raw = spark.createDataFrame([(bytearray(v),) for v in values], "value binary")
    got = [r.value for r in decode_values(raw).collect()]
    assert len(got) == len(values)
    for value, text in zip(values, got):
        try:
            assert text == value.decode()
        except UnicodeDecodeError:
            assert "�" in text


def test_strip_is_pythons(lines):
    values = ["\t a \n", "foo vf", "　\x85b\xa0", WHITESPACE, "", "\x1cx y\x1f"]
    got = lines(*values).select(strip(F.col("value")).alias("v")).collect()
    assert [r.v for r in got] == [v.strip() for v in values]


def test_prompt_takes_any_text(lines):
    text = "100% {comment} %s %d \\ $1"
    (row,) = lines(text).select(prompt(F.col("value"), "say: %s!").alias("p")).collect()
    assert row.p == f"say: {text}!"


_text = st.one_of(st.none(), st.text(st.characters(exclude_categories=["Cs"]), max_size=30))
_stars = st.one_of(st.none(), st.floats(width=32, allow_nan=False, allow_infinity=False))


@settings(max_examples=8)
@given(st.lists(st.tuples(_text, _text, _text, _stars, _text, _text), min_size=20, max_size=50))
def test_parse_undoes_envelope(spark, records):
    df = spark.createDataFrame(records, REVIEW)
    back = parse_records(to_envelope(df).select("value"))
    assert sorted(map(repr, back.collect())) == sorted(map(repr, df.collect()))


def test_times_are_cut_to_seconds(spark):
    row = spark.sql("SELECT TIMESTAMP'2024-01-02 03:04:05.678' AS t, TIMESTAMP_NTZ'2024-01-02 03:04:05.678' AS n")
    assert row.select(to_json(["t", "n"]).alias("v")).first().v == (
        '{"t":"2024-01-02 03:04:05","n":"2024-01-02 03:04:05"}')
