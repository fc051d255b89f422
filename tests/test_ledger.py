"""Labels kept by text."""

import pytest
from pyspark.sql import functions as F

from reviewloom.operators.ledger import LabelLedger
from reviewloom.operators.remote import RemoteScorer


def counting_client(folder, reply):
    """A client that leaves a file for every call."""
    def factory():
        import os
        import uuid

        def ask(prompt, timeout):
            with open(os.path.join(folder, uuid.uuid4().hex), "w") as file:
                file.write(prompt)
            return reply
        return ask
    return factory


@pytest.fixture
def calls(tmp_path):
    (tmp_path / "calls").mkdir()
    return lambda: sorted(path.read_text() for path in (tmp_path / "calls").iterdir())


def scorer(tmp_path, reply):
    return RemoteScorer(counting_client(str(tmp_path / "calls"), reply), template="%s")


def labels(df):
    return sorted(((r.id, r.text, r.feedback) for r in df.collect()), key=repr)


def test_each_distinct_text_is_asked_once_and_keeps_its_label(spark, tmp_path, calls):
    ledger = LabelLedger(spark, str(tmp_path / "ledger"), buckets=4)
    first = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, ""), (5, None), (6, " ")], "id int, text string")
    want = [(1, "a", "POSITIVE"), (2, "a", "POSITIVE"), (3, "b", "POSITIVE"), (4, "", "Empty"), (5, None, None), (6, " ", "POSITIVE")]
    assert labels(ledger.classify(first, scorer(tmp_path, "positive"))) == want
    assert calls() == [" ", "a", "b"]
    # Repeated with another reply, and a text that is new.
    assert labels(ledger.classify(first, scorer(tmp_path, "negative"))) == want
    more = spark.createDataFrame([(7, "b"), (8, "c")], "id int, text string")
    assert labels(ledger.classify(more, scorer(tmp_path, "negative"))) == [(7, "b", "POSITIVE"), (8, "c", "NEGATIVE")]
    assert calls() == [" ", "a", "b", "c"]
    assert {r.n_calls for r in ledger.calls(spark).collect()} == {1}


def test_a_ledger_is_found_again(spark, tmp_path, calls):
    rows = spark.createDataFrame([(1, "a")], "id int, text string")
    path = str(tmp_path / "it's a ledger")
    LabelLedger(spark, path, buckets=4).learn(rows, scorer(tmp_path, "positive"))
    other = spark.newSession()
    again = LabelLedger(other, path, buckets=4)
    assert labels(again.classify(other.createDataFrame([(1, "a")], "id int, text string"), scorer(tmp_path, "negative"))) == [(1, "a", "POSITIVE")]
    small = again.compact(other, str(tmp_path / "compacted"))
    assert sorted(map(tuple, small.read(other).collect())) == sorted(map(tuple, again.read(other).collect()))


def test_the_same_label_after_a_lost_catalog(spark, tmp_path, calls):
    rows = spark.createDataFrame([(i, f"t{i % 50}") for i in range(500)], "id int, text string")
    ledger = LabelLedger(spark, str(tmp_path / "ledger"), buckets=4)
    ledger.learn(rows, scorer(tmp_path, "neutral"))
    spark.sql(f"DROP TABLE {ledger.name}")  # the files stay: the table is external
    again = LabelLedger(spark, str(tmp_path / "ledger"), buckets=4)
    assert {r.feedback for r in again.classify(rows, scorer(tmp_path, "positive")).collect()} == {"NEUTRAL"}
    assert len(calls()) == 50


def test_empty_batches_and_extra_columns(spark, tmp_path, calls):
    ledger = LabelLedger(spark, str(tmp_path / "ledger"), buckets=4)
    none = spark.createDataFrame([], "id int, text string")
    assert labels(ledger.classify(none, scorer(tmp_path, "positive"))) == []
    rows = spark.createDataFrame([(1, "a", "x", "y", "z", "w")], "id int, text string, label string, text_key string, `a.b` string, feedback string")
    got = ledger.classify(rows, scorer(tmp_path, "positive"))
    assert got.columns == ["id", "text", "label", "text_key", "a.b", "feedback"]
    assert [tuple(r) for r in got.collect()] == [(1, "a", "x", "y", "z", "POSITIVE")]


def test_the_ledger_side_is_not_shuffled(spark, tmp_path):
    ledger = LabelLedger(spark, str(tmp_path / "ledger"), buckets=16)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        asked = spark.range(1000).select(F.unhex(F.sha2(F.col("id").cast("string").cast("binary"), 256)).alias("text_key")).distinct()
        plan = asked.join(ledger.read(spark), "text_key", "left_anti")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    scan = plan.index("FileScan parquet spark_catalog.default." + ledger.name)
    above = [line for line in plan[:scan].split("\n")]
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    at = depth(above[-1])
    parents = []
    for line in reversed(above[:-1]):
        if depth(line) < at:
            parents.append(line)
            at = depth(line)
    assert not any("Exchange" in line for line in parents if "Join" not in line), plan
