"""Hashed word features, and bounded samples of labelled rows."""

import numpy as np
import xxhash
from pyspark.sql import functions as F

from .common import WORD_BYTES, in_fold

CACHE_WORDS = 200_000  # words whose hash a task remembers


def words_of(text):
    """Words of a text's bytes: small letters, digits and all beyond ASCII."""
    return text.translate(WORD_BYTES).split()


class Hasher:
    """Word to bucket; frequent words are hashed once per task."""

    def __init__(self, buckets):
        self.buckets, self.known = buckets, {}

    def __call__(self, words):
        known = self.known
        if len(known) > CACHE_WORDS:
            known.clear()
        for word in words:
            if word not in known:
                known[word] = xxhash.xxh3_64_intdigest(word) % self.buckets
        return [known[word] for word in words]


def labelled_ids(labels, column, value, limit, parts=4, part=2, id_column="doc_id"):
    """Ids of at most ``limit`` rows labelled ``value``, the first by hash, outside the held-out fold.

    The bound is the operator's documented parameter: ids only come to the driver.
    """
    rows = (labels.where((F.col(column) == value) & F.col(id_column).isNotNull() & ~in_fold(id_column, parts, part))
            .select(F.col(id_column).cast("bigint").alias("id")).distinct()
            .orderBy(F.xxhash64("id"), "id").limit(limit).collect())
    return np.array(sorted(r.id for r in rows), dtype=np.int64)


def label_share(labels, column, value=1, parts=4, part=2, id_column="doc_id"):
    """(share of ``value``, number) of all labelled rows outside the held-out fold."""
    row = (labels.where(F.col(column).isNotNull() & ~in_fold(id_column, parts, part))
           .agg(F.avg((F.col(column) == value).cast("double")).alias("share"), F.count("*").alias("n")).first())
    return row.share or 0.0, row.n


def contains(sorted_ids, ids):
    """Which of ``ids`` (a numpy array) are among the sorted ids."""
    if not len(sorted_ids):
        return np.zeros(len(ids), dtype=bool)
    at = np.searchsorted(sorted_ids, ids).clip(max=len(sorted_ids) - 1)
    return sorted_ids[at] == ids
