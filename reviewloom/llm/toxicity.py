"""Toxicity scores by non-negative positive-unlabelled learning.

Positives are documents labelled toxic; everything else counts as unlabelled, toxic or not. With
the class prior p (the share of toxic rows among all labels outside the held-out fold) the risk of
a classifier g is

    p E+[l(g)] + max(0, Eu[l(-g)] - p E+[l(-g)])

where the second part estimates the risk on the negatives from unlabelled text, corrected by
the positives hidden in it. Where it falls below zero the classifier overfits and the
step goes the other way.

Features are the distinct words of the whole text and the beginnings of the words, hashed. Several
members are trained, each by numpy gradient descent in a Spark task of its own on a
sample of its own. The score is the mean of the members' probabilities.

Only words are inputs. Labels, from rows outside the held-out fold, choose the positives and the
prior. The training set is a bounded sample (``MAX_POSITIVE``, ``MAX_UNLABELLED`` per
member), taken by hash of the id; scoring covers every row.

Special cases: a null or empty text has no words and gets the score of the bias alone. A null
or repeated id is scored as any row. Without a positive label every score is 0. An empty table gives an empty result.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from .common import in_fold, stored
from .features import Hasher, contains, label_share, labelled_ids, words_of

BUCKETS = 1 << 18
PREFIXES = (4, 5)         # bytes of a word's beginning
MEMBERS = 3
MAX_POSITIVE = 4_000      # toxic documents, the same for all members
MAX_UNLABELLED = 8_000    # unlabelled documents of each member
MIN_DEVIATION = 4.0       # of a feature's count, see telling()
EPOCHS = 400
RATE = 0.05
RIDGE = 3e-4
GAMMA = 1.0               # how far a step goes back where the negative risk is below zero
THRESHOLD = 0.3
TRAIN_ROWS = "member int, positive boolean, words array<int>"
WEIGHTS = "member int, bias double, weights binary"


def features_of(text, hasher):
    """The sorted distinct feature numbers of a text's bytes."""
    distinct = set(words_of(text))
    for size in PREFIXES:
        # A space marks a beginning; no word has one.
        distinct.update([word[:size] + b" " * size for word in distinct if len(word) > size and word[-1] != 32])
    return np.unique(np.array(hasher(distinct), dtype=np.int32))


def training_batches(shared):
    """(id, text) to training rows: the positives for every member, and the unlabelled that a member draws."""
    def rows(batches):
        positives, every = shared.value
        hasher = Hasher(BUCKETS)
        for batch in batches:
            ids = batch.column(0).fill_null(-1).to_numpy(zero_copy_only=False)
            toxic = contains(positives, ids)
            spread = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
            drawn = spread % np.uint64(max(1, every)) == 0
            member = (spread // np.uint64(max(1, every))) % np.uint64(MEMBERS)
            chosen = np.flatnonzero(toxic | drawn)
            words = [features_of(text, hasher) for text in batch.column(1).take(pa.array(chosen)).to_pylist()]
            out = {"member": [], "positive": [], "words": []}
            for i, w in zip(chosen, words):
                uses = [(m, True) for m in range(MEMBERS)] if toxic[i] else []
                for m, is_positive in uses + [(int(member[i]), False)] * bool(drawn[i]):
                    out["member"].append(m)
                    out["positive"].append(is_positive)
                    out["words"].append(w)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["member"], type=pa.int32()), pa.array(out["positive"], type=pa.bool_()),
                 pa.array(out["words"], type=pa.list_(pa.int32()))], names=["member", "positive", "words"])
    return rows


class Sparse:
    """Rows of distinct feature numbers."""

    def __init__(self, rows):
        sizes = np.array([len(r) for r in rows], dtype=np.int64)
        self.n = len(rows)
        self.row = np.repeat(np.arange(self.n), sizes)
        self.column = np.concatenate(rows) if self.n else np.zeros(0, dtype=np.int64)

    def dot(self, weights):
        return np.bincount(self.row, weights=weights[self.column], minlength=self.n)

    def add_up(self, by_row, width):
        return np.bincount(self.column, weights=by_row[self.row], minlength=width)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


def telling(positive, unlabelled):
    """Features whose number of positives lies ``MIN_DEVIATION`` deviations from what unlabelled text suggests."""
    count = lambda rows: np.bincount(np.concatenate([np.zeros(0, dtype=np.int64), *rows]), minlength=BUCKETS)
    expected = len(positive) * (count(unlabelled) + 0.5) / (len(unlabelled) + 1)
    return np.flatnonzero(np.abs(count(positive) - expected) >= MIN_DEVIATION * np.sqrt(expected + 1))


def train_nnpu(positive, unlabelled, prior, epochs=EPOCHS, rate=RATE, ridge=RIDGE):
    """(bias, weights over BUCKETS) by Adam on the non-negative risk with the logistic loss.

    ``positive`` and ``unlabelled`` are lists of arrays of feature numbers.
    """
    kept = telling(positive, unlabelled)
    place = np.full(BUCKETS, -1)
    place[kept] = np.arange(len(kept))
    dense = lambda rows: Sparse([p[p >= 0] for p in (place[r] for r in rows)])
    p, u = dense(positive), dense(unlabelled)
    width = len(kept)
    x, mean, spread = np.zeros(width + 1), np.zeros(width + 1), np.zeros(width + 1)
    x[-1] = np.log(max(prior, 1e-6) / max(1 - prior, 1e-6))
    for step in range(1, epochs + 1):
        at_p, at_u = _sigmoid(p.dot(x) + x[-1]), _sigmoid(u.dot(x) + x[-1])
        # Logistic loss: l(g) = -log s, l(-g) = -log(1 - s).
        negative = np.mean(-np.log1p(-at_u + 1e-12)) - prior * np.mean(-np.log1p(-at_p + 1e-12))
        down_u, down_p = at_u / max(1, u.n), -prior * at_p / p.n
        if negative >= 0:
            by_p, by_u = prior * (at_p - 1) / p.n + down_p, down_u
        else:
            by_p, by_u = -GAMMA * down_p, -GAMMA * down_u
        slope = np.append(p.add_up(by_p, width) + u.add_up(by_u, width), by_p.sum() + by_u.sum())
        slope[:-1] += ridge * x[:-1]
        mean = 0.9 * mean + 0.1 * slope
        spread = 0.999 * spread + 0.001 * slope * slope
        x = x - rate * (mean / (1 - 0.9 ** step)) / (np.sqrt(spread / (1 - 0.999 ** step)) + 1e-8)
    weights = np.zeros(BUCKETS, dtype=np.float32)
    weights[kept] = x[:-1]
    return float(x[-1]), weights


def train_member(prior):
    def train(key, rows):
        words = [np.asarray(w, dtype=np.int64) for w in rows["words"]]
        positive = [w for w, is_positive in zip(words, rows["positive"]) if is_positive]
        unlabelled = [w for w, is_positive in zip(words, rows["positive"]) if not is_positive]
        if not positive or not unlabelled:
            return pd.DataFrame({"member": [], "bias": [], "weights": []}).astype({"member": "int32", "bias": "float64"})
        bias, weights = train_nnpu(positive, unlabelled, prior)
        return pd.DataFrame({"member": [np.int32(key[0])], "bias": [bias], "weights": [weights.tobytes()]})
    return train


def train(docs, labels):
    """The members' (bias, weights), at most MEMBERS of them, from ``docs`` and ``labels`` outside the held-out fold."""
    spark = docs.sparkSession
    prior, _ = label_share(labels, "toxic")
    positives = labelled_ids(labels, "toxic", 1, MAX_POSITIVE)
    rows = docs.where(~in_fold("doc_id", 4, 2) & F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("bigint").alias("id"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    limit = MAX_UNLABELLED * MEMBERS
    every = -(-rows.count() // limit)
    shared = spark.sparkContext.broadcast((positives, every))  # at most MAX_POSITIVE ids
    sample = stored(rows.mapInArrow(training_batches(shared), TRAIN_ROWS), "toxic-sample")
    models = sample.groupBy("member").applyInPandas(train_member(prior), WEIGHTS).collect()  # 1 MB each
    return [(m.bias, np.frombuffer(m.weights, dtype=np.float32)) for m in sorted(models, key=lambda m: m.member)]


def score_text(spark, models):
    """A function from a text column to its score."""
    shared = spark.sparkContext.broadcast(models)  # at most MEMBERS x BUCKETS numbers

    @F.pandas_udf("double")
    def score(columns: Iterator[pd.Series]) -> Iterator[pd.Series]:
        models = shared.value
        bias = np.array([b for b, _ in models])
        weights = np.stack([w for _, w in models], axis=1) if models else None
        hasher = Hasher(BUCKETS)
        for texts in columns:
            out = np.zeros(len(texts))
            for i, text in enumerate(texts if models else []):
                out[i] = _sigmoid(bias + weights[features_of(text.encode(), hasher)].sum(axis=0)).mean()
            yield pd.Series(out)
    return score


def score_documents(docs, labels, threshold=THRESHOLD):
    """doc_id, held_out, score and predicted of every row of ``docs``."""
    score = score_text(docs.sparkSession, train(docs, labels))
    return (docs.select("doc_id", score(F.coalesce("text", F.lit(""))).alias("score"))
            .select("doc_id", in_fold("doc_id", 4, 2).alias("held_out"), "score",
                    (F.col("score") >= threshold).cast("int").alias("predicted")))
