"""Helpers shared by the corpus operators."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ..session import work_dir

# Fixed values of the contracts.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Separators of words made of digits, letters and everything beyond ASCII; capitals
#: are word characters, so a text can be split before it is lower-cased.
WORD_GAPS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
SPACES = r"[\x20\x09-\x0D]+"

#: On a local file system an executor starts a helper program for every file that it makes, to set its permissions, and
#: until that program has begun its own work, the executor's memory counts twice. A file of checksums is one more file.
NO_CHECKSUM_FILES = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}
PARTITIONS_OF_FILE = 8
FILE_BYTES = 16 << 20

#: The same word rule for bytes: capitals become small, separators become spaces.
WORD_BYTES = bytes(
    c + 32 if 0x41 <= c <= 0x5A
    else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80
    else 0x20
    for c in range(256))


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def named(column):
    """The column of this name, whatever signs are in it."""
    return F.col("`" + column.replace("`", "``") + "`")


def stored(df, purpose):
    """``df`` written to the shared folder and read again, so that its lineage ends there."""
    spark = df.sparkSession
    path = work_dir(spark, f"llm-{purpose}")
    df.write.options(**NO_CHECKSUM_FILES).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def few_files(spark):
    """The most files of a table by ``gathered``: two for each core, or one for eight shuffle partitions if that is more."""
    return max(2 * spark.sparkContext.defaultParallelism, shuffle_partitions(spark) // PARTITIONS_OF_FILE)


def gathered(df, purpose, size=0):
    """``stored`` in few files, where the last step has as many partitions as its input takes and leaves each little.

    A task takes several partitions, one after the other; cores have as much to do as before. Of a step that reads
    ``size`` bytes, no fewer tasks than one for ``FILE_BYTES`` of them are left, if it has as many partitions.
    """
    return stored(df.coalesce(max(few_files(df.sparkSession), int(size // FILE_BYTES))), purpose)


def ascii_lower(text):
    """``text`` with A-Z lower-cased and every other character kept.

    Plain ``lower`` does the same, faster, where all characters are ASCII.
    """
    text = F.col(text) if isinstance(text, str) else text
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER))


def words(text):
    """The words of ``text`` by ``WORD_GAPS``, lower-cased; null has none."""
    return F.array_remove(F.split(F.coalesce(ascii_lower(text), F.lit("")), WORD_GAPS), "")


def shuffle_partitions(spark):
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def in_fold(doc_id, parts, part):
    """Whether crc32 of ``doc_id`` as text leaves ``part``; a null id counts as ''."""
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % parts == part


def most_frequent(counts, limit, n="n"):
    """The rows of ``counts`` with the highest ``n``, at most ``limit``, collected.

    All rows from a count on, on a scale of eight steps a doubling: so no task sends more rows
    to the driver than the result has.
    """
    step = F.floor(F.log2(n) * 8)
    left, least = limit, None
    for row in counts.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect():  # a few hundred rows
        if row["count"] > left:
            break
        left, least = left - row["count"], row.step
    return [] if least is None else counts.where(step >= least).collect()


def squeezed(numbers):
    """Unsigned 32-bit numbers, compressed: all low bytes, then all second bytes, ..."""
    numbers = np.ascontiguousarray(numbers, dtype=np.uint32)
    planes = numbers.view(np.uint8).reshape(-1, 4).T
    return len(numbers).to_bytes(8, "little") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unsqueezed(block):
    n = int.from_bytes(block[:8], "little")
    planes = pa.decompress(block[8:], decompressed_size=4 * n, codec="zstd", asbytes=True)
    return np.frombuffer(planes, dtype=np.uint8).reshape(4, n).T.copy().view(np.uint32).ravel()
