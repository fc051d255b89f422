"""Two hops compared by digests."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from reviewloom.streaming.reconcile import differing_ranges, digest, range_of, reconcile


def made(spark, rows):
    return spark.createDataFrame(rows, "key string, value string").repartition(3)


def found(df):
    return {r.key: (r.n_left, r.n_right, r.what) for r in df.collect()}


ROWS = [(f"k{i}", f"v{i}") for i in range(2000)]


def test_equal_tables_in_any_order_agree(spark):
    left, right = made(spark, ROWS), made(spark, ROWS[::-1]).repartition(7)
    assert found(reconcile(left, right, "key")) == {}
    assert differing_ranges(digest(left, "key"), digest(right, "key")).isEmpty()


@pytest.mark.parametrize("depth", [1, 4, 6, 16])
def test_each_defect_is_named(spark, depth):
    right = [r for r in ROWS if r[0] != "k3"] + [("k5", "v5"), ("new", "x")]
    right = [(k, "other" if k == "k9" else v) for k, v in right]
    assert found(reconcile(made(spark, ROWS), made(spark, right), "key", depth=depth)) == {
        "k3": (1, 0, "lost"), "k5": (1, 2, "doubled"), "new": (0, 1, "extra"), "k9": (1, 1, "changed")}


def test_nulls_and_repeated_keys(spark):
    left = [(None, "a"), (None, "b"), ("x", None), ("x", None), ("y", ""), ("z", "1"), ("z", "2")]
    right = [(None, "a"), (None, "b"), ("x", None), ("y", None), ("z", "1"), ("z", "2"), ("z", "3")]
    assert found(reconcile(made(spark, left), made(spark, right), "key")) == {
        "x": (2, 1, "counts differ"), "y": (1, 1, "changed"), "z": (2, 3, "counts differ")}
    assert found(reconcile(made(spark, left), made(spark, left[1:]), "key")) == {None: (2, 1, "counts differ")}
    assert found(reconcile(made(spark, []), made(spark, [(None, None)]), "key")) == {None: (0, 1, "extra")}
    assert found(reconcile(made(spark, []), made(spark, []), "key")) == {}


def test_only_differing_ranges_are_read_again(spark, tmp_path):
    left = made(spark, ROWS)
    right = made(spark, ROWS[:-1])
    ranges = differing_ranges(digest(left, "key"), digest(right, "key"))
    assert [r.range for r in ranges.collect()] == [left.where("key = 'k1999'").select(range_of(F.col("key"))).first()[0]]
    kept = [digest(df, "key") for df in (left, right)]
    # With digests at hand, the tables are read for these ranges alone.
    assert found(reconcile(left, right, "key", *kept)) == {"k1999": (1, 0, "lost")}


def test_random_defects_by_hand(spark):
    rng = random.Random(2)
    right = []
    for k, v in ROWS:
        luck = rng.random()
        right += [] if luck < 0.01 else [(k, v)] * 2 if luck < 0.02 else [(k, "odd")] if luck < 0.03 else [(k, v)]
    left, other = Counter(ROWS), Counter(right)
    wrong = {k for k, v in (left - other) | (other - left)}
    assert set(found(reconcile(made(spark, ROWS), made(spark, right), "key"))) == wrong
