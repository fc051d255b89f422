"""Uniform shuffle into shards of exact sizes by a hypergeometric communication matrix.

1. Every row is numbered and stored with its input partition.
2. The matrix says how many rows of each partition go to each shard. It is
   drawn without replacement from the shards' free places, so its margins are
   exact: rows per partition, and shard sizes at most one apart.
3. Each partition is permuted; its first rows go to shard 0, the next to shard 1, ...
4. After the exchange each shard is permuted again. A shard may hold any share of the data,
   so it is cut by the leading bits of the random sort key; the positions within
   the cuts and the sizes of the earlier cuts give the slot.

Only the row counts of the partitions reach the driver. Everything else is DataFrame
operations. The same seed on the same input partitions gives the same shuffle.

Draws from fewer than 10^9 places are numpy's, which takes no more; larger ones invert the distribution around its
mode, as far as a double can tell it from nothing. So a table may have any number of rows that a bigint can count.

Special cases: a null text has no bytes and the checksum of an empty text. Null
or repeated ids and repeated texts are rows like any other. An empty table gives an empty result.
"""

import math

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from .common import stored

CUT_ROWS = 50_000  # rows of a cut, about
DRAW_LIMIT = 10 ** 9  # of numpy's hypergeometric
REACH = 40  # deviations from the mode beyond which a double has no probability left


def hypergeometric(rng, good, bad, n):
    """How many of ``n`` places, drawn without replacement, are among the ``good`` ones."""
    if not n or not good:
        return 0
    if max(good, bad, n) < DRAW_LIMIT:
        return int(rng.hypergeometric(good, bad, n))
    return wide_hypergeometric(rng, good, bad, n)


def wide_hypergeometric(rng, good, bad, n):
    """As ``hypergeometric``, for any numbers: by the ratios of neighbouring probabilities, from the mode outwards.

    The deviation, and with it the work, is at most half the root of ``n``, the rows of an input partition.
    """
    total = good + bad
    mode = (n + 1) * (good + 1) // (total + 2)
    reach = 50 + int(REACH * math.sqrt(n * (good / total) * (bad / total) * (total - n) / max(total - 1, 1)))
    first, last = max(0, n - bad, mode - reach), min(good, n, mode + reach)
    k = np.arange(last - first, dtype=np.float64)
    # Differences of whole numbers first, then doubles: each ratio of neighbours is right to its last bits.
    ratio = ((good - first) - k) * ((n - first) - k) / (((first + 1) + k) * ((bad - n + first + 1) + k))
    level = np.concatenate([[0.0], np.cumsum(np.log(ratio))])
    upto = np.cumsum(np.exp(level - level.max()))
    return first + int(np.searchsorted(upto, rng.random() * upto[-1], side="right"))


def draw_matrix(counts, shards, seed):
    """Exact counts (partition by shard) of a uniform shuffle of ``counts`` rows."""
    total = sum(counts)
    free = np.array([total // shards + (s < total % shards) for s in range(shards)])
    rng = np.random.default_rng(seed)
    matrix = []
    for n in counts:
        row, left, places = [], n, int(free.sum())
        for s in range(shards):
            places -= int(free[s])
            taken = hypergeometric(rng, int(free[s]), places, left)
            row.append(taken)
            left -= taken
        free -= row
        matrix.append(row)
    return matrix


def _random(seed):
    """A sort key from the row's number; the number itself breaks ties."""
    return F.xxhash64(F.lit(seed), F.col("row"))


def _cuts(rows, shards):
    """Bits of the sort key that cut a shard into pieces of about ``CUT_ROWS``."""
    return max(5, min(20, (rows // shards // CUT_ROWS).bit_length()))


def uniform_shards(rows, shards=8, seed=20):
    """``rows`` with shard and slot (gapless from 0 in each shard).

    The added columns replace columns of the same names.
    """
    spark = rows.sparkSession
    kept = [c for c in rows.columns if c.lower() not in ("shard", "slot")]
    data = stored(rows.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("data"),
                              F.monotonically_increasing_id().alias("row"),
                              F.spark_partition_id().alias("part")), "shard-rows")
    counts = sorted((r.part, r["count"]) for r in data.groupBy("part").count().collect())
    matrix = draw_matrix([n for _, n in counts], shards, seed)
    ends = spark.createDataFrame(
        [(part, np.cumsum(row).tolist()) for (part, _), row in zip(counts, matrix)],
        "part int, ends array<bigint>")

    local = Window.partitionBy("part").orderBy(_random(seed), "row")
    sent = (data.withColumn("place", F.row_number().over(local))
            .join(ends, "part")
            .withColumn("shard", F.size(F.filter("ends", lambda end: end < F.col("place")))))

    bits = _cuts(sum(n for _, n in counts), shards)
    sent = sent.withColumn("again", _random(seed + 1)).withColumn(
        "cut", F.shiftrightunsigned("again", 64 - bits)).select("shard", "cut", "again", "row", "data")
    sizes = sent.groupBy("shard", "cut").count()
    before = Window.partitionBy("shard").orderBy("cut").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("shard", "cut", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("shard", "cut").orderBy("again", "row")
    return (sent.withColumn("rank", F.row_number().over(within))
            .join(starts, ["shard", "cut"])
            .select("data.*", "shard", (F.col("start") + F.col("rank") - 1).cast("bigint").alias("slot")))


def shard_documents(docs, shards=8, seed=20):
    """doc_id, size, text_crc32 of ``docs`` with law, shard, slot and grown_shard."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id",
                       (F.octet_length(text) + 1).cast("bigint").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"))
    return uniform_shards(rows, shards, seed).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
