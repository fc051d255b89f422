"""Poison records told apart from the others."""

import random

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from reviewloom.plans.stream_queries import _at_most
from reviewloom.streaming.isolate import NumberedRows, TooManyBad, confirm, cut, find_bad, isolating_delivery, reason_of
from reviewloom.streaming.sinks import start_batches
from reviewloom.streaming.supervise import GaveUp, supervise


@given(st.integers(0, 50), st.integers(0, 50), st.integers(2, 9))
def test_cut_covers_the_range(begin, size, pieces):
    parts = cut(begin, begin + size, pieces)
    assert [p for b, e in parts for p in range(b, e)] == list(range(begin, begin + size))
    assert len(parts) <= pieces and all(e > b for b, e in parts)


@given(st.integers(1, 400), st.sets(st.integers(0, 399), max_size=12), st.integers(1, 16))
def test_finds_exactly_the_bad(n, bad, parallel):
    bad = {b for b in bad if b < n}
    tried = []

    def fails(begin, end):
        tried.append((begin, end))
        return ValueError("broken") if any(begin <= b < end for b in bad) else None

    assert find_bad(n, fails, parallel=parallel) == dict.fromkeys(bad, "broken")
    assert len(tried) <= max(parallel, 2) + (len(bad) + 1) * (2 * n.bit_length() + parallel + 2)


def test_a_row_that_fails_once_is_not_bad():
    seen = []

    def fails(begin, end):
        if begin <= 5 < end:
            seen.append((begin, end))
            return ValueError("odd") if seen.count((5, 6)) < 2 else None

    assert find_bad(10, fails) == {}


def test_too_many_bad_rows_give_up_early():
    tried = []

    def fails(begin, end):
        tried.append((begin, end))
        return ValueError("all")

    with pytest.raises(TooManyBad):
        find_bad(10**9, fails, max_bad=100)
    assert len(tried) < 1000


def test_known_places_are_not_tried_again():
    tried = []

    def fails(begin, end):
        tried.append((begin, end))
        return ValueError("broken") if any(begin <= b < end for b in (3, 4, 70, 99)) else None

    assert find_bad(100, fails, known={3: "x", 99: "x"}) == {4: "broken", 70: "broken"}
    assert tried[:2] == [(0, 3), (4, 99)] and not {(3, 4), (99, 100)} & set(tried)
    assert find_bad(2, fails, known={0: "x", 1: "x"}) == {}
    with pytest.raises(TooManyBad):
        find_bad(100, fails, max_bad=3, known={3: "x", 99: "x"})


def test_rows_that_failed_once_are_tried_until_they_failed_often_enough():
    seen = []

    def fails(begin, end):
        seen.append(begin)
        return ValueError("odd") if begin == 4 or seen.count(9) < 2 else None

    assert confirm([4, 9], fails, tries=3) == {4: "odd"}
    assert confirm([4], fails, tries=1) == {4: "odd"} and confirm([], fails) == {}


def test_reason():
    assert reason_of(ValueError("[FOREACH_BATCH_X] and [CAST_INVALID_INPUT] more [X.Y]")) == "CAST_INVALID_INPUT"
    assert reason_of(ValueError("plain\ntrace")) == "plain"


def test_rows_by_place(spark):
    rows = NumberedRows(spark.range(0, 1000, numPartitions=7).where("id % 3 > 0").withColumn("a.n", F.lit("x")))
    wanted = [i for i in range(1000) if i % 3]
    assert rows.total == len(wanted)
    place = wanted  # the partitions of a range follow each other
    assert sorted(r.id for r in rows.between(0, rows.total).collect()) == wanted
    for b, e in ((0, 1), (5, 5), (100, 400), (600, rows.total)):
        assert sorted(r.id for r in rows.between(b, e).collect()) == sorted(place[b:e])
    assert sorted(r.id for r in rows.without([0, 7, rows.total - 1]).collect()) == sorted(set(place) - {place[0], place[7], place[-1]})
    assert [tuple(r) for r in rows.only({3: "why"}).collect()] == [(place[3], "x", "why")]


def landed(spark, tmp_path, n=200):
    spark.range(n).selectExpr("id", "CAST(id AS STRING) AS value").repartition(2).write.parquet(str(tmp_path / "in"))
    return lambda: (spark.readStream.schema("id bigint, value string").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")))


def run(spark, tmp_path, source, process, deliver, **options):
    handle = isolating_delivery(process, deliver, str(tmp_path / "bad"), **options)
    return supervise(lambda: start_batches(source(), handle, "q", str(tmp_path / "checkpoints"), until_done=True), backoff_s=0)


def write_batches(tmp_path):
    return lambda rows, batch_id: rows.write.mode("overwrite").parquet(str(tmp_path / f"out/batch_id={batch_id}"))


def test_bad_rows_are_set_aside_and_the_rest_delivered_once(spark, tmp_path):
    bad = set(random.Random(4).sample(range(200), 5))
    process = lambda df: df.selectExpr("id", f"CAST(CASE WHEN id IN ({','.join(map(str, bad))}) THEN 'x' ELSE value END AS INT) AS n")
    outcome = run(spark, tmp_path, landed(spark, tmp_path), process, write_batches(tmp_path))
    assert 1 <= outcome.restarts <= 2
    assert sorted(r.n for r in spark.read.parquet(str(tmp_path / "out")).collect()) == sorted(set(range(200)) - bad)
    aside = spark.read.parquet(str(tmp_path / "bad"))
    assert sorted(r.id for r in aside.collect()) == sorted(bad)
    assert {r.reason for r in aside.collect()} == {"CAST_INVALID_INPUT"}


def test_outages_and_failures_of_the_sink_blame_no_row(spark, tmp_path):
    failures = [TimeoutError("timed out")] * 3

    def deliver(rows, batch_id):
        if failures:
            raise failures.pop()
        write_batches(tmp_path)(rows, batch_id)

    run(spark, tmp_path, landed(spark, tmp_path), lambda df: df, deliver)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 200 and not (tmp_path / "bad").exists()


def test_a_sink_that_always_fails_is_given_up(spark, tmp_path):
    def deliver(rows, batch_id):
        raise RuntimeError("disk full")

    with pytest.raises(GaveUp):
        run(spark, tmp_path, landed(spark, tmp_path), lambda df: df, deliver)
    assert not (tmp_path / "bad").exists()


def test_a_broken_job_sets_nothing_aside(spark, tmp_path):
    with pytest.raises((GaveUp, StreamingQueryException), match="fail"):
        run(spark, tmp_path, landed(spark, tmp_path), lambda df: df.selectExpr("CAST('x' || value AS INT) AS n"),
            write_batches(tmp_path), max_bad=20)
    assert not (tmp_path / "bad").exists()


def test_parts_are_dealt_to_partitions(spark):
    rows = NumberedRows(spark.range(0, 1000, numPartitions=3).withColumn("part", F.lit("x")))
    parts = [(3, 10), (10, 11), (330, 340), (990, 1000)]
    dealt = rows.dealt(parts)
    assert dealt.columns == ["id", "part"]
    assert sorted((r.p, r.id) for r in dealt.select("id", F.spark_partition_id().alias("p")).collect()) == [
        (i, place) for i, (b, e) in enumerate(parts) for place in range(b, e)]


def test_tries_of_a_round_are_planned_once(spark, tmp_path):
    """60 of 2,000 rows: some 800 tries, and a few plans for each round. No row is blamed for a try beside its own."""
    bad, plans = set(random.Random(6).sample(range(2000), 60)), []

    def process(df):
        plans.append(1)
        return df.selectExpr("id", f"CAST(CASE WHEN id IN ({','.join(map(str, bad))}) THEN 'x' ELSE value END AS INT) AS n", "map(id, value) AS m")

    run(spark, tmp_path, landed(spark, tmp_path, 2000), process, write_batches(tmp_path), narrow=True)
    assert len(plans) < 150
    assert sorted(r.n for r in spark.read.parquet(str(tmp_path / "out")).collect()) == sorted(set(range(2000)) - bad)
    aside = spark.read.parquet(str(tmp_path / "bad")).collect()
    assert sorted(r.id for r in aside) == sorted(bad) and {r.reason for r in aside} == {"CAST_INVALID_INPUT"}


def test_one_pass_tells_the_rows_that_fail(spark, tmp_path):
    """60 of 2,000 rows in two batches: each is planned for two failures, the pass, the tries of single rows and the others."""
    bad, plans = set(random.Random(6).sample(range(2000), 60)), []

    def process(df):
        plans.append(1)
        half = df.selectExpr("id", f"CAST(CASE WHEN id IN ({','.join(map(str, bad))}) THEN 'x' ELSE value END AS INT) AS n")
        return half.selectExpr("n", "n + 1 AS more", "map(id, n) AS m")

    run(spark, tmp_path, landed(spark, tmp_path, 2000), process, write_batches(tmp_path), narrow=True)
    assert len(plans) <= 10
    assert sorted(r.n for r in spark.read.parquet(str(tmp_path / "out")).collect()) == sorted(set(range(2000)) - bad)
    aside = spark.read.parquet(str(tmp_path / "bad")).collect()
    assert sorted(r.id for r in aside) == sorted(bad) and {r.reason for r in aside} == {"CAST_INVALID_INPUT"}


def test_caught_rows(spark):
    rows = NumberedRows(spark.range(0, 1000, numPartitions=7).selectExpr("id", "CASE WHEN id % 100 = 7 THEN 'x' ELSE CAST(id AS STRING) END AS value").where("id % 3 > 0"))
    wanted = [place for place, i in enumerate(i for i in range(1000) if i % 3) if i % 100 == 7]
    process = lambda df: df.selectExpr("CAST(value AS INT) AS n").selectExpr("n", "n + 1 AS more").where("more IS NOT NULL")
    plain = lambda df: df.select(F.col("value").cast("int").alias("n")).select("n", (F.col("n") + 1).alias("more"))
    assert rows.caught(plain, 10) == wanted and rows.caught(plain, len(wanted)) == wanted
    assert rows.caught(plain, len(wanted) - 1) is None
    assert rows.caught(lambda df: df, 10) == []
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):   # of a filter, which is no expression of a column
        rows.caught(process, 10)


@pytest.mark.parametrize("told", [[7, 8], [5], None])
def test_the_pass_is_not_trusted(spark, tmp_path, monkeypatch, told):
    """Rows that it misses are found by trying parts, and rows that do not fail by themselves are delivered."""
    monkeypatch.setattr(NumberedRows, "caught", lambda self, process, most: told)
    process = lambda df: df.selectExpr("CAST(CASE WHEN id IN (7, 30, 150) THEN 'x' ELSE value END AS INT) AS n")
    (spark.range(200).selectExpr("id", "CAST(id AS STRING) AS value").coalesce(1).write.parquet(str(tmp_path / "in")))
    source = lambda: spark.readStream.schema("id bigint, value string").parquet(str(tmp_path / "in"))
    run(spark, tmp_path, source, process, write_batches(tmp_path), narrow=True)
    assert sorted(r.n for r in spark.read.parquet(str(tmp_path / "out")).collect()) == sorted(set(range(200)) - {7, 30, 150})
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "bad")).collect()) == [7, 30, 150]


def test_batches_of_poison_have_files_for_all_slots():
    assert _at_most(250, 10, 125_000, 8) == (250, 10)          # a small table, as it is
    assert _at_most(8000, 8, 125_000, 8) == (8000, 8)
    assert _at_most(100_000, 8, 125_000, 8) == (15_625, 8)     # no longer a batch of one file
    assert _at_most(100_000, 8, 125_000, 1000) == (250, 500)
    assert _at_most(100_000, 8, 100, 8) == (250, 1)


def test_errors_without_a_condition_keep_their_reason(spark, tmp_path):
    @F.udf("int")
    def broken(value):
        if int(value) % 50 == 7:
            raise ValueError("never")
        return int(value)

    reasons = {}
    for narrow in (False, True):
        place = tmp_path / str(narrow)
        run(spark, place, landed(spark, place, 300), lambda df: df.select("id", broken("value").alias("n")), write_batches(place), narrow=narrow)
        reasons[narrow] = sorted((r.id, r.reason) for r in spark.read.parquet(str(place / "bad")).collect())
    assert [i for i, _ in reasons[True]] == list(range(7, 300, 50))
    assert {why for _, why in reasons[True]} == {why for _, why in reasons[False]}


def failing_client(folder):
    """A client that can never answer one prompt, and leaves a file per answer."""
    def factory():
        import os
        import uuid

        def ask(prompt, timeout):
            if "poison" in prompt:
                raise ValueError("cannot answer")
            with open(os.path.join(folder, uuid.uuid4().hex), "w") as file:
                file.write(prompt)
            return "positive"
        return ask
    return factory


def test_ranges_job_with_ledger_and_poison(spark, tmp_path):
    """All together: one file, byte ranges, a text that the client always fails on, no call made twice."""
    import json

    from reviewloom.operators.remote import RemoteScorer
    from reviewloom.plans.enrich import run_ranges_job
    from reviewloom.streaming.audit import read_audit, read_deliveries

    (tmp_path / "calls").mkdir()
    rows = [{"review_id": str(i), "text": "poison" if i == 41 else f"text {i % 30}"} for i in range(120)]
    (tmp_path / "lines.json").write_text("".join(json.dumps(r) + "\n" for r in rows))
    outcome = run_ranges_job(spark, str(tmp_path / "lines.json"), RemoteScorer(failing_client(str(tmp_path / "calls")), template="%s", retries=0),
                             str(tmp_path / "out"), str(tmp_path / "audit"), str(tmp_path / "checkpoints"), str(tmp_path / "bad"),
                             ledger_dir=str(tmp_path / "ledger"), bytes_per_batch=1500, until_done=True, backoff_s=0)
    assert outcome.restarts == 1
    assert sorted(int(r.key) for r in read_deliveries(spark, str(tmp_path / "out")).collect()) == [i for i in range(120) if i != 41]
    bad = spark.read.parquet(str(tmp_path / "bad")).collect()
    assert [json.loads(r.value)["review_id"] for r in bad] == ["41"]
    assert read_audit(spark, str(tmp_path / "audit")).agg(F.sum("n_rows")).first()[0] == 119
    written = [p.read_text() for p in (tmp_path / "calls").iterdir()]
    # A failed job may lose labels of texts that it asked about; what was written is not asked for again.
    assert set(written) == {f"text {i}" for i in range(30)} and len(written) < 120
