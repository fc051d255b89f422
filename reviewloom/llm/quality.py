"""Quality selection by importance resampling.

Two generative models of hashed n-grams (tokens and pairs of them) are counted: one over target text,
the documents labelled as of good quality, one over all raw text. Tokens are runs of letters and digits, in their case,
and runs of other signs. The importance of a document is the log of the ratio of its probabilities
under both, a sum over the whole text. Adding Gumbel noise and taking the k highest is a draw of
k documents without replacement, in proportion to their importance. The noise comes from a hash of
the row's number, so a draw from the same table can be repeated.

The raw model counts every text. The target model counts those of at most ``MAX_TARGET`` labelled rows
outside the held-out fold. k is ``share`` of all rows; by default the share of good quality among the
labels. Ranks are exact: rows are cut into ranges of the key, counted, and ranked within their range.

Special cases: a null or empty text has no n-grams and importance 0. Without labels of good quality
both models are equal and the draw is uniform. Rows with null or repeated ids are drawn as rows
of their own. An empty table gives an empty result.
"""

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from .common import in_fold, stored
from .features import Hasher, contains, label_share, labelled_ids

BUCKETS = 1 << 15
MAX_TARGET = 50_000
SMOOTHING = 1.0
CUT_ROWS = 20_000
SEED = 5
TOKENS = re.compile(rb"[0-9A-Za-z\x80-\xff]+|[^\s0-9A-Za-z\x80-\xff]+")


def ngrams(hashed):
    """Buckets of tokens and token pairs from the tokens' 64-bit numbers."""
    h = np.asarray(hashed, dtype=np.uint64)
    with np.errstate(over="ignore"):
        pairs = h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:] + np.uint64(1)
        pairs ^= pairs >> np.uint64(31)
    return np.concatenate([h, pairs]) % np.uint64(BUCKETS)


def count_batches(shared):
    """(id, text) to n-gram counts of target and raw text per task."""
    def counts(batches):
        targets = shared.value
        hasher = Hasher(1 << 62)
        raw, target = np.zeros(BUCKETS, dtype=np.int64), np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            ids = batch.column(0).fill_null(-1).to_numpy(zero_copy_only=False)
            chosen = contains(targets, ids)
            for text, is_target in zip(batch.column(1).to_pylist(), chosen):
                found = np.bincount(ngrams(hasher(TOKENS.findall(text))).astype(np.int64), minlength=BUCKETS)
                raw += found
                if is_target:
                    target += found
        at = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at.astype(np.int32)), pa.array(raw[at]), pa.array(target[at])], names=["bucket", "raw", "target"])
    return counts


def log_ratio(raw, target):
    """The log of target to raw probability of each bucket, smoothed."""
    if not target.sum():
        return np.zeros(len(raw))
    of = lambda x: np.log(x + SMOOTHING) - np.log(x.sum() + SMOOTHING * len(x))
    return of(target.astype(float)) - of(raw.astype(float))


def importance_batches(shared):
    """(row, id, text) to the log importance."""
    def scores(batches):
        ratio = shared.value
        hasher = Hasher(1 << 62)
        for batch in batches:
            out = np.zeros(batch.num_rows)
            for i, text in enumerate(batch.column(2).to_pylist()):
                found = ngrams(hasher(TOKENS.findall(text)))
                out[i] = ratio[found.astype(np.int64)].sum()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(out)], names=["row", "id", "importance"])
    return scores


def fit(docs, labels):
    """The log ratio of every bucket."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("id"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(labelled_ids(labels, "quality", 1, MAX_TARGET))
    counts = (rows.mapInArrow(count_batches(shared), "bucket int, raw bigint, target bigint")
              .groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect())  # BUCKETS rows
    raw, target = np.zeros(BUCKETS, dtype=np.int64), np.zeros(BUCKETS, dtype=np.int64)
    for row in counts:
        raw[row.bucket], target[row.bucket] = row.raw, row.target
    return log_ratio(raw, target)


def _uniform(seed):
    """A number between 0 and 1, neither included, from the row's number."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("row")), 11)
    return (bits.cast("double") + 0.5) / float(1 << 53)


def ranked(rows, key, n):
    """``rows`` with their place (from 1) by falling ``key``, without one task sorting all."""
    cuts = max(16, n // CUT_ROWS)
    cut = stored(rows.repartitionByRange(cuts, F.col(key).desc(), "row").withColumn("cut", F.spark_partition_id()), "cuts")
    sizes = sorted((r.cut, r["count"]) for r in cut.groupBy("cut").count().collect())  # a row per cut
    ends = np.cumsum([0] + [size for _, size in sizes]).tolist()
    starts = rows.sparkSession.createDataFrame([(c, start) for (c, _), start in zip(sizes, ends)], "cut int, start bigint")
    within = Window.partitionBy("cut").orderBy(F.col(key).desc(), "row")
    return (cut.withColumn("nth", F.row_number().over(within)).join(starts, "cut")
            .withColumn("rank", (F.col("start") + F.col("nth")).cast("bigint")).drop("cut", "nth", "start"))


def resample(docs, labels, share=None, seed=SEED):
    """doc_id, held_out, importance, gumbel_key, rank and selected of every row of ``docs``."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(fit(docs, labels))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("bigint").alias("id"),
                       F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    scored = rows.mapInArrow(importance_batches(shared), "row bigint, id bigint, importance double")
    scored = stored(scored.withColumn("gumbel_key", F.col("importance") - F.log(-F.log(_uniform(seed)))), "importance")
    n = scored.count()
    if share is None:
        known, labelled = label_share(labels, "quality")
        share = known if labelled else 0.5
    return ranked(scored, "gumbel_key", n).select(
        F.col("id").alias("doc_id"), in_fold("id", 4, 2).alias("held_out"), "importance", "gumbel_key", "rank",
        (F.col("rank") <= round(share * n)).alias("selected"))
