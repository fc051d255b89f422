"""The corpus pipeline: documents through five operators, each stage written as Parquet.

    toxicity -> exact copies -> near copies -> decontamination -> tokens

A filtering stage returns the rows it keeps, with the columns of its input. Id and text decide which rows are one
document: rows that share both are copies of each other, and rows that share an id but not the text are judged each by
its own text. A null id is an id like any other, and the last among those of a group. Null and
empty texts are clean, are exact copies of each other, and have no near copies.
Columns beyond doc_id and text are carried along, whatever their names. An empty table stays empty.
"""

import ctypes
import functools
import gc
import itertools
import time

import public_tokenizers
import pyarrow as pa
from pyspark.sql import functions as F

from reviewloom.llm.bpe import round_trip
from reviewloom.llm.common import gathered, stored, table
from reviewloom.llm.decontaminate import contamination
from reviewloom.llm.exact_dedup import exact_groups, text_digest
from reviewloom.llm.jaccard_join import jaccard_groups, text_hash
from reviewloom.llm.toxicity import THRESHOLD, score_text, train

VOCABULARY = "byte_bpe_50k.tiktoken"

#: Bytes of an Arrow batch that goes to Python: with Spark's own default some long texts make a batch of 64 MB,
#: several times over in the memory of the executor and its Python workers.
BATCH_BYTES = 4 << 20

#: Keys that are broadcast whole; of more keys hashes are broadcast, and rows with one of these are compared by their keys.
MAX_KEYS = 100_000
MAX_HASHES = 5_000_000


def bounded(stage):
    """A stage whose batches to Python are bounded by bytes, and which begins with Python workers that hold no spare memory."""
    @functools.wraps(stage)
    def run_stage(spark, docs, sf_dir):
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
        hand_back(spark)
        return stage(spark, docs, sf_dir)
    return run_stage


def hand_back(spark):
    """Let idle Python workers return to the system what their last tasks needed.

    Spark keeps the workers, and they keep their memory: some 350 MB an executor stood idle while a stage without Python ran.
    Not before the decontamination, which runs no Python at all.
    The tasks are short and more than the slots, as Spark hands out the worker that was idle longest.
    """
    def trim(batches):
        for _ in batches:
            pass
        gc.collect()
        pa.default_memory_pool().release_unused()
        of_gnu = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if of_gnu:
            of_gnu(0)
        time.sleep(0.05)  # so that each slot takes its share
        yield from ()

    tasks = 4 * spark.sparkContext.defaultParallelism
    spark.range(0, tasks, numPartitions=tasks).mapInArrow(trim, "id bigint").write.format("noop").mode("overwrite").save()


def _own_names(docs, n):
    """``n`` names that no column of ``docs`` has, in any case."""
    taken = {column.lower() for column in docs.columns}
    free = (name for i in itertools.count() if (name := f"key_{i}") not in taken)
    return list(itertools.islice(free, n))


def _without(docs, gone, keys):
    """Rows of ``docs`` whose keys (name in ``gone`` to expression) are not in ``gone``.

    Rows are long, so those that stay are not shuffled to find that out: ``gone`` is broadcast, or else the hashes of its keys,
    and only rows with such a hash meet the keys in a shuffle.
    """
    mark, *names = _own_names(docs, 1 + len(keys))
    gone = gathered(gone.select([F.col(key).alias(name) for key, name in zip(keys, names)]).distinct(), "gone")
    same = [value.eqNullSafe(gone[name]) for value, name in zip(keys.values(), names)]
    n = gone.count()
    if n <= MAX_KEYS:
        return docs.join(F.broadcast(gone), same, "left_anti")
    if n > MAX_HASHES:
        return docs.join(gone, same, "left_anti")
    hashes = F.broadcast(gone.select(F.xxhash64(*names).alias(mark)).distinct())
    found = F.xxhash64(*[value.cast(gone.schema[name].dataType) for value, name in zip(keys.values(), names)]) == F.col(mark)
    return docs.join(hashes, found, "left_anti").union(docs.join(hashes, found, "left_semi").join(gone, same, "left_anti"))


def _only(docs, judged, keys):
    """One row of ``docs`` for each of the keys that ``judged`` keeps, and every row whose keys it doesn't name.

    ``judged`` has the keys, ``kept`` and ``n``, the number of rows with these keys.
    """
    left = _without(docs, judged.where("NOT kept"), keys)
    repeated = judged.where("kept AND n > 1")
    if repeated.isEmpty():
        return left
    # Rows with the same id and text: one of them stays.
    names = _own_names(docs, len(keys))
    some = gathered(repeated.select([F.col(key).alias(name) for key, name in zip(keys, names)]), "repeated")
    same = [value.eqNullSafe(some[name]) for value, name in zip(keys.values(), names)]
    twice = left.join(some, same).dropDuplicates(names).drop(*names)
    return _without(left, repeated, keys).unionByName(twice)


@bounded
def toxic(spark, docs, sf_dir):
    """Rows that the classifier scores below the threshold."""
    score = score_text(spark, train(docs, table(spark, sf_dir, "labels")))
    return docs.where(score(F.coalesce("text", F.lit(""))) < THRESHOLD)


@bounded
def exact(spark, docs, sf_dir):
    """One row of each group of equal texts: that with the smallest id."""
    groups = gathered(exact_groups(docs), "exact-groups")
    judged = groups.groupBy("doc_id", "text_sha256").agg(F.max("kept").alias("kept"), F.count("*").alias("n"))
    return _only(docs, judged, {"doc_id": docs["doc_id"], "text_sha256": text_digest("text")})


@bounded
def near(spark, docs, sf_dir):
    """One row of each component of near copies: that with the smallest id, then the smallest hash of its text."""
    groups = gathered(jaccard_groups(docs).where("component IS NOT NULL"), "near-groups")
    # A null id comes last; the rows of a component are pre-aggregated in their tasks.
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "h"))
    chosen = gathered(groups.groupBy("component").agg(first.alias("first")), "near-chosen")
    kept = chosen.select(F.col("first.id").alias("kept_id"), F.col("first.h").alias("kept_h"))
    # Joined by row, not by component: a large one has no place to gather.
    judged = (groups.groupBy("id", "h").agg(F.count("*").alias("n"))
              .join(kept, F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("h") == F.col("kept_h")), "left")
              .select("id", "h", "n", F.col("kept_h").isNotNull().alias("kept")))
    return _only(docs, judged, {"id": docs["doc_id"].cast("bigint"), "h": text_hash("text")})


def clean(spark, docs, sf_dir):
    """Rows without any window of the benchmark."""
    found = contamination(docs, table(spark, sf_dir, "benchmark"))
    return _without(docs, found.where("contaminated"), {"doc_id": docs["doc_id"], "text_key": F.xxhash64("text")})


@bounded
def tokens(spark, docs, sf_dir):
    """Token counts and digests of every row that is left."""
    return round_trip(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


STAGES = [("toxicity", toxic), ("exact_dedup", exact), ("near_dedup", near), ("decontaminate", clean), ("tokens", tokens)]


def run(spark, sf_dir):
    """Apply the stages to the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: The classifier of the first stage is fitted step by step, which SQL cannot state.
ORACLE_SQL = None
