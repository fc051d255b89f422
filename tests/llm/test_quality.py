import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewloom.llm import quality


def corpus(n=900, seed=1):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        good = rng.random() < 0.7
        words = [f"{'g' if good else 'j'}{rng.randrange(60)}" if rng.random() < 0.5 else f"w{rng.randrange(200)}" for _ in range(rng.randrange(20, 60))]
        docs.append((i, " ".join(words), good))
        if rng.random() < 0.4:
            labels.append((i, int(good), 0))
    return docs, labels


@pytest.fixture(scope="module")
def drawn(spark):
    docs, labels = corpus()
    frame = spark.createDataFrame([(i, t) for i, t, _ in docs], "doc_id bigint, text string").repartition(4)
    table = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    return docs, quality.resample(frame, table, share=0.5).collect()


def test_ranks_and_selection_are_exact(drawn):
    docs, rows = drawn
    assert sorted(r["rank"] for r in rows) == list(range(1, len(docs) + 1))
    keys = [r.gumbel_key for r in sorted(rows, key=lambda r: r["rank"])]
    assert keys == sorted(keys, reverse=True)
    assert sum(r.selected for r in rows) == round(0.5 * len(docs))


def test_held_out_quality(drawn):
    docs, rows = drawn
    good = {i: g for i, _, g in docs}
    test = [r for r in rows if r.held_out]
    pairs = [(a.importance > b.importance) for a in test if good[a.doc_id] for b in test if not good[b.doc_id]]
    assert np.mean(pairs) > 0.95
    chosen = [good[r.doc_id] for r in test if r.selected]
    assert np.mean(chosen) > 0.9


def test_importance_against_brute_force(spark, drawn):
    docs, rows = drawn
    _, labels = corpus()
    table = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    ids = set(quality.labelled_ids(table, "quality", 1, quality.MAX_TARGET).tolist())
    hasher = quality.Hasher(1 << 62)
    grams = {i: quality.ngrams(hasher(quality.TOKENS.findall(t.encode()))).astype(int) for i, t, _ in docs}
    raw = np.bincount(np.concatenate(list(grams.values())), minlength=quality.BUCKETS)
    target = np.bincount(np.concatenate([grams[i] for i in ids]), minlength=quality.BUCKETS)
    p = lambda x: np.log((x + 1.0) / (x.sum() + len(x)))
    ratio = p(target) - p(raw)
    for r in rows:
        assert r.importance == pytest.approx(ratio[grams[r.doc_id]].sum())


def test_gumbel_draws_in_proportion(spark):
    """Of two kinds of rows with importance 0 and log 3, the first drawn is of the second kind three times in four."""
    rows = spark.range(40_000).selectExpr("id AS row", "id % 2 AS kind")
    key = F.col("kind") * math.log(3) - F.log(-F.log(quality._uniform(1)))
    best = rows.select("kind", (F.col("row") / 2).cast("bigint").alias("pair"), key.alias("key")).groupBy("pair").agg(
        F.max_by("kind", "key").alias("kind"))
    assert best.agg(F.avg("kind")).first()[0] == pytest.approx(0.75, abs=0.015)


def test_ties_get_distinct_ranks(spark):
    rows = quality.ranked(spark.range(5000).selectExpr("id AS row", "CAST(id % 3 AS DOUBLE) AS key"), "key", 5000).collect()
    assert sorted(r["rank"] for r in rows) == list(range(1, 5001))
    keys = [r.key for r in sorted(rows, key=lambda r: r["rank"])]
    assert keys == sorted(keys, reverse=True)


def test_edge_rows(spark, documents):
    labels = spark.createDataFrame([(1, 1, 0), (None, 1, 0), (2, 0, 0), (3, None, 1)], "doc_id bigint, quality int, toxic int")
    cases = [(1, "a b"), (2, None), (2, ""), (None, "a"), (3, "x " * 60_000), (3, "one")]
    rows = quality.resample(documents(cases), labels).collect()
    assert sorted(r["rank"] for r in rows) == [1, 2, 3, 4, 5, 6]
    assert all(np.isfinite(r.gumbel_key) for r in rows)
    assert {r.importance for r in quality.resample(documents(cases), labels.limit(0)).collect()} == {0.0}
    assert quality.resample(documents([]), labels).count() == 0
