import random
import zlib

import numpy as np
import pytest

from reviewloom.llm import toxicity
from reviewloom.llm.features import Hasher


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


def corpus(n=1200, seed=3):
    """Toxic texts have some of ten words, a third of them as part of a longer word."""
    rng = random.Random(seed)
    bad = [f"vile{i}" for i in range(10)]
    docs, labels = [], []
    for i in range(n):
        words = [f"w{int(rng.expovariate(0.02))}" for _ in range(rng.randrange(5, 80))]
        toxic = rng.random() < 0.15
        if toxic:
            words += [rng.choice(bad) + ("ness" if rng.random() < 0.3 else "") for _ in range(rng.randrange(2, 5))]
            rng.shuffle(words)
        docs.append((i, " ".join(words)))
        if rng.random() < 0.5:
            labels.append((i, 1, int(toxic)))
    return docs, labels


@pytest.fixture(scope="module")
def scored(spark):
    docs, labels = corpus()
    frame = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id bigint, text string, score string")
    table = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    return docs, dict((i, t) for i, _, t in labels), toxicity.score_documents(frame, table).collect()


def test_held_out_accuracy(scored):
    _, truth, rows = scored
    test = [r for r in rows if held_out(r.doc_id) and r.doc_id in truth]
    recall = np.mean([r.predicted for r in test if truth[r.doc_id]])
    false = np.mean([r.predicted for r in test if not truth[r.doc_id]])
    assert len(test) > 100 and recall > 0.9 and false < 0.05


def test_columns(scored):
    docs, _, rows = scored
    assert len(rows) == len(docs)
    for r in rows:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) and r.held_out == held_out(r.doc_id)


def test_held_out_labels_are_never_used(spark, scored):
    docs, truth, rows = scored
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    turned = spark.createDataFrame([(i, 1, 1 - t if held_out(i) else t) for i, t in truth.items()],
                                   "doc_id bigint, quality int, toxic int")
    again = {r.doc_id: r.score for r in toxicity.score_documents(frame, turned).collect()}
    assert all(abs(again[r.doc_id] - r.score) < 1e-9 for r in rows)


def test_risk_is_corrected_when_negative():
    """Positives only: plain learning would call everything toxic or overfit; the prior holds it back."""
    rng = np.random.default_rng(1)
    positive = [np.unique(np.append(rng.integers(100, 2000, 30), 7)) for _ in range(300)]
    unlabelled = [np.unique(np.append(rng.integers(100, 2000, 30), 7 if rng.random() < 0.2 else 8)) for _ in range(2000)]
    bias, weights = toxicity.train_nnpu(positive, unlabelled, 0.2)
    with_word = np.mean([bias + weights[u].sum() > 0 for u in unlabelled if 7 in u])
    without = np.mean([bias + weights[u].sum() > 0 for u in unlabelled if 7 not in u])
    assert with_word > 0.95 and without < 0.02


def test_features_cover_beginnings():
    hasher = Hasher(toxicity.BUCKETS)
    a, b = (set(toxicity.features_of(t, hasher).tolist()) for t in (b"Abcdefgh", b"abcdeXYZ"))
    assert len(a) == 3 and len(a & b) == 2
    assert toxicity.features_of(b"", hasher).tolist() == []


def test_edge_rows(spark, documents):
    labels = spark.createDataFrame([(1, 1, 1), (2, 1, 0), (None, 1, 1), (5, None, None), (6, 0, 1)], "doc_id bigint, quality int, toxic int")
    rows = [(1, "bad"), (2, "good"), (2, "good"), (None, None), (3, ""), (4, "long " * 50_000)]
    got = toxicity.score_documents(documents(rows), labels).collect()
    assert sorted((r.doc_id is None, r.doc_id) for r in got) == sorted((i is None, i) for i, _ in rows)
    assert all(0 <= r.score <= 1 for r in got)
    assert toxicity.score_documents(documents([]), labels).count() == 0
    none = toxicity.score_documents(documents(rows), labels.limit(0)).collect()
    assert {r.score for r in none} == {0.0}


def test_given_labels(spark):
    from reviewloom.llm.queries import QUERIES
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = QUERIES["op5_toxicity"](spark, sf).where("held_out").join(labels, "doc_id").select("toxic", "predicted").collect()
    assert np.mean([r.predicted for r in rows if r.toxic]) > 0.85
    assert np.mean([r.predicted for r in rows if not r.toxic]) < 0.1
