"""The stream of byte ranges, and its pacing."""

import io
import json
import os
import random

import pytest
from hypothesis import given
from hypothesis import strategies as st

from reviewloom.sources import ranges
from reviewloom.sources.ranges import FileIndex, IndexLost, LineRangesReader, lines_between, locate, stream_ranges
from reviewloom.streaming.pacing import Pacer
from reviewloom.streaming.sinks import FileSink, finish, start_batches, start_stream


def lines_of(data, cuts, block):
    cuts = [0, *sorted(cuts), len(data)]
    return [line for a, b in zip(cuts, cuts[1:]) for column in lines_between(io.BytesIO(data), a, b, block)
            for line in column.cast("binary").to_pylist()]


def split(data):
    """Lines without their ends; an unfinished last line counts."""
    parts = data.split(b"\n")
    last = parts.pop()
    return [p[:-1] if p.endswith(b"\r") else p for p in parts] + ([last] if last else [])


@given(st.lists(st.sampled_from([b"a", b"bc", b"\n", b"\r", b"\r\n", "é".encode(), b"\xff"]), max_size=25).map(b"".join),
       st.lists(st.integers(0, 40), max_size=6), st.integers(1, 9), st.integers(1, 9))
def test_every_line_is_in_one_range(data, cuts, block, tail):
    before, ranges.TAIL_BLOCK = ranges.TAIL_BLOCK, tail
    try:
        assert lines_of(data, [c for c in cuts if c <= len(data)], block) == split(data)
    finally:
        ranges.TAIL_BLOCK = before


def write(folder, name, data):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "wb") as file:
        file.write(data)


def test_index_numbers_files_once(tmp_path):
    write(tmp_path / "in", "b", b"12345")
    write(tmp_path / "in", "_draft", b"x")
    write(tmp_path / "in/.hidden", "c", b"x")
    write(tmp_path / "in", "empty", b"")
    index = FileIndex(str(tmp_path / "index"))
    place = str(tmp_path / "in")
    index.discover(*locate(place))
    write(tmp_path / "in/sub", "a", b"123")
    index.discover(*locate(f"file:{place}"))
    index.admit({"file": 1, "byte": 2}, 9)
    again = FileIndex(str(tmp_path / "index"))
    again.discover(*locate(place))
    assert again.paths == index.paths == [f"{place}/b", f"{place}/sub/a"] and again.ends == [5, 8]
    assert again.admitted == {"offset": {"file": 1, "byte": 2}, "size": 9}
    assert [again.offset(p) for p in (0, 4, 5, 7, 8)] == [
        {"file": 0, "byte": 0}, {"file": 0, "byte": 4}, {"file": 1, "byte": 0}, {"file": 1, "byte": 2}, {"file": 2, "byte": 0}]
    assert all(again.position(again.offset(p)) == p for p in range(9))
    assert list(again.ranges(1, 7, 3)) == [(f"{place}/b", 1, 4), (f"{place}/b", 4, 5), (f"{place}/sub/a", 0, 2)]


def reader(tmp_path, **options):
    return LineRangesReader({"path": str(tmp_path / "in"), "index": str(tmp_path / "index"), "bytesperbatch": "10"} | options)


def test_offsets_go_on_after_a_restart(tmp_path):
    write(tmp_path / "in", "a", b"x" * 25)
    first = reader(tmp_path)
    assert [first.latestOffset(), first.latestOffset()] == [{"file": 0, "byte": 10}, {"file": 0, "byte": 20}]
    second = reader(tmp_path)
    # Spark repeats the batch that was under way, by its offsets, and then asks for the next.
    assert [r.value for r in second.partitions({"file": 0, "byte": 10}, {"file": 0, "byte": 20})] == [[(str(tmp_path / "in/a"), 10, 20)]]
    assert second.latestOffset() == second.latestOffset() == {"file": 1, "byte": 0}
    write(tmp_path / "in", "b", b"y" * 5)
    assert second.latestOffset() == {"file": 2, "byte": 0}


def test_small_files_share_a_task_and_large_ones_are_cut(tmp_path):
    for i, size in enumerate((3, 3, 3, 20)):
        write(tmp_path / "in", f"f{i}", b"x" * size)
        os.utime(tmp_path / "in" / f"f{i}", (i, i))
    parts = reader(tmp_path, bytespertask="8").partitions({"file": 0, "byte": 0}, {"file": 4, "byte": 0})
    assert [[(os.path.basename(p), a, b) for p, a, b in part.value] for part in parts] == [
        [("f0", 0, 3), ("f1", 0, 3)], [("f2", 0, 3)], [("f3", 0, 8)], [("f3", 8, 16)], [("f3", 16, 20)]]


def test_a_lost_index_is_refused(tmp_path):
    write(tmp_path / "in", "a", b"x" * 25)
    with pytest.raises(IndexLost):
        reader(tmp_path).partitions({"file": 2, "byte": 0}, {"file": 3, "byte": 0})
    with pytest.raises(IndexLost):
        reader(tmp_path).partitions({"file": 0, "byte": 20}, {"file": 0, "byte": 10})


def test_missing_path_raises_at_once(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        stream_ranges(spark, str(tmp_path / "none"), str(tmp_path / "index"))


def numbered(n, seed=1):
    rng = random.Random(seed)
    return [json.dumps({"n": i, "pad": "é" * rng.randrange(40)}, ensure_ascii=False) for i in range(n)]


def test_one_file_many_batches_and_a_file_that_comes_later(spark, tmp_path):
    wanted = numbered(3000)
    write(tmp_path / "in", "one", "\n".join(wanted[:2000]).encode())
    start = lambda: start_stream(
        stream_ranges(spark, str(tmp_path / "in"), str(tmp_path / "index"), bytes_per_batch=20_000, bytes_per_task=7_000),
        FileSink(str(tmp_path / "out")), "q", str(tmp_path / "checkpoints"))
    query = start()
    finish(query)
    assert len([p for p in query.recentProgress if p.numInputRows]) >= 4
    assert max(p.numInputRows for p in query.recentProgress) < 1000
    write(tmp_path / "in", "two", "\r\n".join(wanted[2000:]).encode())
    finish(start())
    got = [r.value for r in spark.read.schema("value string").parquet(str(tmp_path / "out")).collect()]
    assert sorted(got) == sorted(wanted)


def test_a_failed_batch_is_repeated_alike(spark, tmp_path):
    wanted = numbered(1000)
    write(tmp_path / "in", "one", "\n".join(wanted).encode() + b"\n")
    seen, fail = {}, [True, True]

    def handle(batch, batch_id):
        rows = [r.value for r in batch.collect()]
        assert seen.setdefault(batch_id, rows) == rows
        if batch_id == 1 and fail:
            fail.pop()
            raise RuntimeError("lost")

    for _ in range(3):
        query = start_batches(stream_ranges(spark, str(tmp_path / "in"), str(tmp_path / "index"), bytes_per_batch=9_000),
                              handle, "q", str(tmp_path / "checkpoints"))
        try:
            finish(query)
        except Exception as failure:
            assert "lost" in str(failure)
    assert not fail and sorted(sum(seen.values(), [])) == sorted(wanted)


# ---- pacing ----

def run_batches(pacer, seconds_of, n):
    took = []
    for _ in range(n):
        took.append(seconds_of(pacer.size, len(took)))
        pacer.finished(pacer.size, took[-1])
    return took


def test_pacer_holds_the_target():
    """Batches cost half a second and a rate that falls to a third midway and recovers."""
    rate = lambda i: 1e6 if i < 20 or i >= 40 else 3e5
    pacer = Pacer(first=10_000, target_s=5.0)
    took = run_batches(pacer, lambda size, i: 0.5 + size / rate(i), 60)
    for settled in (took[12:20], took[30:40], took[52:]):
        assert all(4.5 <= s <= 5.5 for s in settled), settled
    assert max(took) < 20


def test_pacer_bounds():
    assert run_batches(Pacer(100, None), lambda size, i: size, 3) == [100, 100, 100]
    pacer = Pacer(100, 1.0, least=50, most=400)
    run_batches(pacer, lambda size, i: 1e-6, 10)
    assert pacer.size == 400
    run_batches(pacer, lambda size, i: 1e6, 10)
    assert pacer.size == 50
    for wrong in ({"first": 0}, {"first": 1, "target_s": 0}):
        with pytest.raises(ValueError):
            Pacer(**wrong)


def test_source_admits_what_the_target_allows(tmp_path):
    write(tmp_path / "in", "a", b"x" * 10_000_000)
    now = [0.0]
    paced = LineRangesReader({"path": str(tmp_path / "in"), "index": str(tmp_path / "index"), "bytesperbatch": "1000",
                              "targetseconds": "2"}, clock=lambda: now[0])
    sizes, last = [], 0
    for _ in range(30):
        end = paced.latestOffset()
        at = paced.index.position(end)
        sizes.append(at - last)
        now[0] += 0.2 + sizes[-1] / 50_000  # the batch
        last = at
    assert all(1.8 <= 0.2 + size / 50_000 <= 2.2 for size in sizes[15:]), sizes
    # A restarted stream begins with the size it had.
    again = LineRangesReader({"path": str(tmp_path / "in"), "index": str(tmp_path / "index"), "bytesperbatch": "1000", "targetseconds": "2"})
    assert again.index is None
    again.latestOffset()
    assert again.pacer.size == paced.pacer.size


def test_stream_follows_slow_and_fast_batches(spark, tmp_path):
    """The stand-in for work sleeps in proportion to the rows; rows arrive whole."""
    import time
    wanted = numbered(4000)
    write(tmp_path / "in", "one", "\n".join(wanted).encode())
    rows, took = [], []

    def handle(batch, batch_id):
        found = [r.value for r in batch.collect()]
        rows.extend(found)
        took.append(len(found))
        time.sleep(len(found) * 0.001)

    finish(start_batches(stream_ranges(spark, str(tmp_path / "in"), str(tmp_path / "index"), bytes_per_batch=2_000, target_s=1.0),
                         handle, "q", str(tmp_path / "checkpoints")))
    assert sorted(rows) == sorted(wanted)
    assert took[0] < 60 < max(took) and len(took) < 40


def test_workers_need_no_copy_of_the_package(tmp_path):
    """The planner and the tasks run in processes that cannot import it."""
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = f"""
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
import __spark_entry__
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.checkpoint.dir", {str(tmp_path / "shared")!r}).getOrCreate())
queries = __spark_entry__.queries()
assert queries["stream_byte_ranges"](spark, "/root/testdata/sf0.001").count() == 200
assert queries["delivery_records"](spark, "/root/testdata/sf0.001").count() == 9
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, check=True, timeout=300)
