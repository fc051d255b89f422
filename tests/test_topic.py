"""The topic in a folder, its reports and its offsets."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from reviewloom.streaming.sinks import start_stream, write_batch
from reviewloom.streaming.topic import Reports, TopicSink, Written, read_refused, read_reports, read_topic, register, write_file


def messages(spark, n, parts=4):
    return spark.range(n, numPartitions=parts).select(
        F.col("id").cast("string").alias("key"), F.repeat(F.lit("v"), F.col("id").cast("int")).alias("value"), (F.col("id") % 3).cast("int").alias("partition"))


def test_batches_get_gapless_offsets(spark, tmp_path):
    register(spark)
    sink = TopicSink(str(tmp_path), 3, max_bytes=40)
    write_batch(messages(spark, 50), sink)
    write_batch(messages(spark, 30), sink)
    rows = read_topic(spark, str(tmp_path)).collect()
    wanted = [i for n in (50, 30) for i in range(n) if i <= 40]
    assert sorted(int(r.key.decode()) for r in rows) == sorted(wanted)
    for p in range(3):
        assert sorted(r.offset for r in rows if r.partition == p) == list(range(sum(i % 3 == p for i in wanted)))
    assert all(len(r.value) == int(r.key) and int(r.key) % 3 == r.partition for r in rows)
    bad = read_refused(spark, str(tmp_path)).collect()
    assert sorted(int(r.key) for r in bad) == list(range(41, 50)) and {r.error for r in bad} == {"too large"}
    reports = read_reports(spark, str(tmp_path))
    assert reports.agg(F.sum("n_records"), F.sum("n_failed")).first()[:] == (len(wanted), 9)
    assert reports.where("last_offset - first_offset + 1 <> n_records").count() == 0


def test_odd_records(spark, tmp_path):
    register(spark)
    rows = spark.createDataFrame([("a", "x", 0), (None, None, 1), ("c", "x", 5), ("d", "x", None), ("e", "", -1)],
                                 "key string, value string, partition int")
    write_batch(rows, TopicSink(str(tmp_path), 2))
    assert sorted(((r.partition, r.offset, r.key, r.value) for r in read_topic(spark, str(tmp_path)).collect()), key=repr) == [
        (0, 0, b"a", b"x"), (1, 0, None, None)]
    assert sorted((r.key.decode(), r.error) for r in read_refused(spark, str(tmp_path)).collect()) == [
        (k, "no such partition") for k in "cde"]


def test_empty_table(spark, tmp_path):
    register(spark)
    write_batch(messages(spark, 10).limit(0), TopicSink(str(tmp_path), 3))
    assert read_reports(spark, str(tmp_path)).count() == 0 and read_topic(spark, str(tmp_path)).count() == 0


def test_a_file_that_no_report_names_is_no_part(spark, tmp_path):
    register(spark)
    sink = TopicSink(str(tmp_path), 3)
    write_batch(messages(spark, 9), sink)
    batch = pa.RecordBatch.from_pydict({"key": ["lost"], "value": ["task"], "partition": pa.array([0], pa.int32())})
    write_file(sink.options(), [batch])
    assert read_topic(spark, str(tmp_path)).count() == 9


def test_a_repeated_batch_replaces_its_report(tmp_path, spark):
    options = TopicSink(str(tmp_path), 2).options()
    reports = Reports(options)
    reports.write(0, [Written("a", {0: (5, 0), 1: (2, 1)}), None], -1)
    reports.write(1, [Written("b", {0: (3, 0)})], 0)
    reports.write(1, [Written("c", {0: (2, 0)}), Written("d", {0: (1, 0), 1: (4, 0)})], 0)
    assert sorted(tuple(r) for r in read_reports(spark, str(tmp_path)).collect()) == [
        (0, "a", 0, 5, 0, 4, 0), (0, "a", 1, 2, 0, 1, 1), (1, "c", 0, 2, 5, 6, 0), (1, "d", 0, 1, 7, 7, 0), (1, "d", 1, 4, 2, 5, 0)]
    assert reports.next_offsets(1) == {0: 8, 1: 6} and reports.last() == 1


def test_a_failed_write_leaves_the_topic_as_it_was(spark, tmp_path):
    register(spark)
    sink = TopicSink(str(tmp_path), 3)
    write_batch(messages(spark, 9), sink)
    broken = messages(spark, 9).withColumn("value", F.when(F.col("key") == "8", F.raise_error(F.lit("broken"))).otherwise(F.col("value")))
    with pytest.raises(Exception, match="broken"):
        write_batch(broken, sink)
    assert read_topic(spark, str(tmp_path)).count() == 9


def test_stream_resumes_with_the_next_offsets(spark, tmp_path):
    register(spark)
    sink = TopicSink(str(tmp_path / "topic"), 3)
    for wave in range(2):
        messages(spark, 20).withColumn("key", F.concat(F.lit(f"{wave}-"), "key")).write.mode("append").parquet(str(tmp_path / "in"))
        source = spark.readStream.schema("key string, value string, partition int").option("maxFilesPerTrigger", 1)
        start_stream(source.parquet(str(tmp_path / "in")), sink, "q", str(tmp_path / "checkpoints"), until_done=True).awaitTermination()
    rows = read_topic(spark, str(tmp_path / "topic")).collect()
    assert len({r.key for r in rows}) == len(rows) == 40
    for p in range(3):
        assert sorted(r.offset for r in rows if r.partition == p) == list(range(sum(r.partition == p for r in rows)))
