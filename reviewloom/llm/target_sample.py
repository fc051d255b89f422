"""Importance resampling towards a target distribution.

The features of a text are its words and pairs of neighbouring words. A Split by a regular expression, from the tokenizers
library and without any training, gives the words of the lower-cased text with their offsets; every offset pair, and
every window of two of them, is a feature, and the CRC-32 of its words, joined by a space, chooses its bucket. Histograms of the
buckets over all raw texts and over all target texts give every bucket a gain, 1000 times the log of its smoothed
probability in the target over that in the raw texts. A document's weight is its features' mean gain. With Gumbel
noise from a hash of the seed and the id added, the highest scores are a draw without replacement in proportion to the weights.

1. Each text is tokenized once; its buckets are written to the shared folder, two bytes a feature.
2. Tasks count buckets, and Spark adds the counts up: ``BUCKETS`` rows a task, ``BUCKETS`` rows to the driver.
3. The gains of a document's buckets are added up from a table of ``BUCKETS`` numbers.
4. Eligible documents are cut into ranges of the score, counted by range, and ranked within. Their number in
   the input settles ties beyond the id, so that equal rows, too, are spread over the ranges.

Texts are handled a part at a time, cut between words, so memory does not grow with a text beyond its buckets.

Special cases: null and empty texts, and those without words, have no features, weight 0, and too few words to be
drawn (with ``min_words`` above 0). A null id is hashed as an empty one and comes last among equal scores. Repeated rows are
drawn as rows of their own. Without target texts the gains come from smoothing alone. An empty table gives an empty result.
"""

import math
import re
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Window
from pyspark.sql import functions as F
from tokenizers import Regex
from tokenizers.pre_tokenizers import Split

from .common import LOWER, UPPER, stored

# Fixed values of the contract.
BUCKETS = 10_000
SHARE, MIN_WORDS, SEED = 25, 20, 7
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

GAP = re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]")
TO_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())
TEXT_AT_ONCE = 1 << 20   # characters that are tokenized at a time, about
BATCH_FEATURES = 1 << 21  # features of a batch of documents, about
CUT_ROWS = 100_000       # documents ranked by a task, about


# ---- features ----

def parts(text):
    """``text`` in parts that end before a separator."""
    at = 0
    while len(text) - at > TEXT_AT_ONCE:
        end = GAP.search(text, at + TEXT_AT_ONCE)
        if end is None:
            break
        yield text[at:end.start()]
        at = end.start()
    yield text[at:] if at else text


def offset_pairs():
    """A function from text to the offsets (first, end) of its words."""
    split = Split(Regex(WORD), "removed", invert=True)
    return lambda text: [pair for _, pair in split.pre_tokenize_str(text)]


def feature_buckets(text, pairs_of):
    """(number of words, buckets of all words, then of all pairs) of a text."""
    text = text.encode().translate(TO_LOWER).decode()
    single, double, last = [], [], None
    for part in parts(text):
        pairs = pairs_of(part)
        if not pairs:
            continue
        words = [part[a:b].encode() for a, b in pairs]
        ones = list(map(crc32, words))
        # A window of two offset pairs: the CRC goes on from the first word, over a space, to the second.
        opened = [crc32(b" ", one) for one in ones]
        twos = list(map(crc32, words[1:], opened))
        if last is not None:
            twos.append(crc32(words[0], last))
        last = opened[-1]
        single.append(np.array(ones, dtype=np.uint32))
        double.append(np.array(twos, dtype=np.uint32))
    crcs = np.concatenate(single + double) if single else np.zeros(0, dtype=np.uint32)
    return sum(map(len, single)), (crcs % BUCKETS).astype("<u2")


FEATURES = "part int, nth bigint, id bigint, n_words bigint, n_features bigint, buckets binary"


def feature_batches(batches):
    """(id, text) to the features of every row, with the task's part and the row's number in it."""
    pairs_of, part, nth = offset_pairs(), TaskContext.get().partitionId(), 0
    for batch in batches:
        rows, size = [], 0
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            n, buckets = feature_buckets(text.as_py(), pairs_of)
            rows.append((part, nth, doc, n, len(buckets), buckets.tobytes()))
            nth += 1
            size += len(buckets)
            if size >= BATCH_FEATURES:
                yield _features(rows)
                rows, size = [], 0
        yield _features(rows)


def _features(rows):
    kinds = [pa.int32(), *[pa.int64()] * 4, pa.binary()]
    columns = list(zip(*rows)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(columns, kinds)],
                                      names=[field.split()[0] for field in FEATURES.split(", ")])


def features(docs, text="text", id_column=None):
    """The rows of ``FEATURES`` for a table of texts; without an id column ``id`` is null."""
    of = F.col(id_column) if id_column else F.lit(None)
    return (docs.select(of.cast("bigint").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
            .mapInArrow(feature_batches, FEATURES))


def _numbers(column):
    """All buckets of a column of them, one after the other."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<u2")


# ---- histograms and gains ----

def count_batches(batches):
    counts = np.zeros(BUCKETS, dtype=np.int64)
    for batch in batches:
        counts += np.bincount(_numbers(batch.column(0)), minlength=BUCKETS)
    at = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(counts[at])], names=["bucket", "n"])


def histogram(found):
    """How often each bucket occurs in a table of ``FEATURES``."""
    counts = np.zeros(BUCKETS, dtype=np.int64)
    rows = found.select("buckets").mapInArrow(count_batches, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    for row in rows.collect():  # at most BUCKETS
        counts[row.bucket] = row.n
    return counts


def gains(raw, target):
    """The gain of every bucket, floored."""
    of_raw, of_target = float(raw.sum() + BUCKETS), float(target.sum() + BUCKETS)
    return np.array([math.floor(1000 * math.log((t + 1) * of_raw / ((s + 1) * of_target)))
                     for s, t in zip(raw.tolist(), target.tolist())], dtype=np.int64)


# ---- weights, scores, draw ----

WEIGHED = "part int, nth bigint, id bigint, n_words bigint, n_features bigint, weight bigint"


def weight_batches(shared):
    """Features to weights: the floored mean gain."""
    def weights(batches):
        gain = shared.value
        for batch in batches:
            n = batch.column(4).to_numpy()
            ends = np.concatenate([[0], np.cumsum(n)])
            total = np.concatenate([[0], np.cumsum(gain[_numbers(batch.column(5))])])
            total = total[ends[1:]] - total[ends[:-1]]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(np.where(n > 0, total // np.maximum(n, 1), 0))],
                                             names=[field.split()[0] for field in WEIGHED.split(", ")])
    return weights


def noise(id_column, seed):
    """Gumbel noise of an id, 1000 times and floored."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_column).cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    return F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("bigint")


ORDER = (F.desc, "score"), (F.asc_nulls_last, "id"), (F.asc, "part"), (F.asc, "nth")


def with_rank(rows, n):
    """``rows``, ``n`` of them, with their rank from 1 by falling score, then id; no task ranks all of them."""
    order = [by(name) for by, name in ORDER]
    cuts = max(8, -(-n // CUT_ROWS))
    cut = stored(rows.repartitionByRange(cuts, *order).withColumn("cut", F.spark_partition_id()), "score-cuts")
    sizes = sorted((r["cut"], r["count"]) for r in cut.groupBy("cut").count().collect())  # a row per cut
    ends = np.cumsum([0] + [size for _, size in sizes]).tolist()
    earlier = rows.sparkSession.createDataFrame([(c, end) for (c, _), end in zip(sizes, ends)], "cut int, earlier bigint")
    within = F.row_number().over(Window.partitionBy("cut").orderBy(*order))
    return (cut.withColumn("within", within).join(earlier, "cut")
            .withColumn("rank", (F.col("earlier") + F.col("within")).cast("bigint")).drop("cut", "within", "earlier"))


def draw(docs, target, share=SHARE, min_words=MIN_WORDS, seed=SEED, text="text", id_column="doc_id"):
    """The id column, n_words, n_features, weight, score and rank of every row of ``docs``.

    Of the rows with ``min_words`` words or more, ``share`` in a hundred (floored) are drawn and have a rank, from 1;
    the rank of the others is null.
    """
    found = stored(features(docs, text, id_column), "features")
    gain = gains(histogram(found), histogram(features(target, text)))
    shared = docs.sparkSession.sparkContext.broadcast(gain)  # BUCKETS numbers
    scored = stored(found.mapInArrow(weight_batches(shared), WEIGHED)
                    .withColumn("score", F.col("weight") + noise("id", seed)), "scores")
    eligible = scored.where(F.col("n_words") >= min_words)
    n = eligible.count()
    drawn = F.when(F.col("rank") <= share * n // 100, F.col("rank")).alias("rank")
    shown = [F.col("id").alias(id_column), "n_words", "n_features", "weight", "score"]
    others = scored.where(F.col("n_words") < min_words).select(*shown, F.lit(None).cast("bigint").alias("rank"))
    if not n:
        return others
    return with_rank(eligible, n).select(*shown, drawn).unionByName(others)
