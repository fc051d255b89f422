"""The physical plans: narrow, in the JVM, reading only what is needed."""

import re

import pytest

from reviewloom.plans.registry import QUERIES
import __spark_entry__  # noqa: F401

SF = "/root/testdata/sf0.001"
# Counts by label, and streams whose results are joined with what was set aside or kept beside them.
GATHERED = {"lexicon_quality", "poison_records", "label_ledger", "hops_reconciled"}
TABLE = [n for n in QUERIES if not n.startswith(("stream_", "delivery_", "landed_", "model_")) and n not in GATHERED]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in TABLE if n != "feedback_model"])
def test_no_shuffle_and_python_only_where_remote(spark, name):
    plan = _plan(QUERIES[name](spark, SF))
    assert "Exchange" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
    assert ("Python" in plan) == (name == "feedback_remote_fake")
    assert "BatchEvalPython" not in plan


@pytest.mark.parametrize("name, columns", [
    ("lexicon_counts", {"doc_id", "text"}), ("feedback_guard", {"doc_id", "text"}),
    ("feedback_remote_fake", {"doc_id", "text"}),
    ("events_props_parse", {"event_id", "props"}), ("event_time_json", {"event_id", "ts"}),
    ("label_normalise", {"event_id", "event_type"}), ("nan_clean", {"event_id", "value"}),
    ("strip_lines", {"conv_id", "turn", "text"})])
def test_scan_reads_only_the_needed_columns(spark, name, columns):
    (schema,) = set(re.findall(r"ReadSchema: struct<([^>]*)>", _plan(QUERIES[name](spark, SF))))
    assert {c.split(":")[0] for c in schema.split(",")} == columns


def test_model_labels_without_reading_the_texts_again(spark):
    plan = _plan(QUERIES["feedback_model"](spark, SF))
    assert "documents.parquet" not in plan and "text" not in plan and "Exchange" not in plan


@pytest.mark.parametrize("name", ["json_roundtrip", "feedback_lexicon", "malformed_permissive",
                                  "malformed_drop", "contract_valid", "contract_quarantine",
                                  "nan_lines_clean", "feedback_valid"])
def test_lines_are_parsed_once(spark, name):
    # Looking again at a line that does not fit reads none of the fields.
    reads_fields = re.findall(r"from_json\(StructField\((?:_\w+,ArrayType\(StructType\(StructField\()?review_id",
                              _plan(QUERIES[name](spark, SF)))
    assert len(reads_fields) == 1


def test_lexicon_splits_the_text_once(spark):
    assert _plan(QUERIES["feedback_lexicon"](spark, SF)).count("split(") == 1
    assert _plan(QUERIES["lexicon_counts"](spark, SF)).count("split(") == 1
