"""Exact deduplication over an extendible-hash index on shared files.

Texts are equal when they are identical after each run of ASCII white space
became one space. A 64-bit hash of the normalised text is the key. The leading bits of the key select
a cell; a directory maps cells to buckets and is doubled, one bit at a time,
until no bucket holds more than its share of bytes, splitting the overfull
buckets only. Each bucket belongs to one owner task, which sorts its entries by
key, chains the texts that share a key and compares their bytes.

Equal keys cannot be split by doubling. A bucket still overfull at the last bit
gets overflow pages, each with an owner of its own; the few distinct texts of
every page meet in a second round. So no task holds a whole group of copies.

Special cases: a null text counts as empty, so null and empty texts are one group.
Of rows with the same id and the same text exactly one is kept. A null id sorts
last; a group of null ids only has a null ``keep_id`` and still keeps one row. An
empty table gives an empty result. Other columns are ignored.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from .common import SPACES, few_files, gathered, shuffle_partitions, stored

MAX_DEPTH = 20          # at most 2**20 directory cells, about 20 MB
MIN_BUCKET_BYTES = 1 << 16
BUCKETS_PER_TASK = 4
ENTRY_OVERHEAD = 32     # bytes of an entry beside its text

ENTRY = ("bucket bigint, page int, pages int, key bigint, chain int, id bigint, "
         "keep bigint, members bigint, first boolean, sha string, text binary")
MERGED = "bucket bigint, page int, key bigint, chain int, keep bigint, members bigint, first boolean"


def normalised(text):
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), SPACES, " ")


def text_digest(text):
    """The digest by which groups are named: SHA-256 of the normalised text."""
    return F.sha2(normalised(text).cast("binary"), 256)


def split_depths(load, capacity):
    """The depth of each cell's bucket; ``load`` holds the bytes of 2**n cells.

    A bucket over capacity is split by its next bit; where that needs more bits
    than the directory has, the directory doubles.
    """
    bits = int(len(load)).bit_length() - 1
    depth = np.zeros(len(load), dtype=np.int64)
    for d in range(bits):
        over = load.reshape(2 ** d, -1).sum(axis=1) > capacity
        if not over.any():
            break
        depth += np.repeat(over, len(load) >> d)
    return depth


def directory(spark, load, capacity):
    """Rows (cell, bucket, pages). Pages are the overflow pages of a bucket at full depth."""
    bits = int(len(load)).bit_length() - 1
    depth = split_depths(load, capacity)
    cell = np.arange(len(load))
    bucket = (cell >> (bits - depth)) + (np.int64(1) << depth)  # the leading one tells depths apart
    pages = np.where(depth == bits, np.ceil(load / capacity), 1).clip(1).astype(np.int64)
    rows = list(zip(cell.tolist(), bucket.tolist(), pages.tolist()))
    return spark.createDataFrame(rows, "cell bigint, bucket bigint, pages bigint")


def _runs(batches, same):
    """Rows of consecutive batches, grouped where ``same`` columns agree."""
    run, at = [], None
    for batch in batches:
        columns = batch.to_pydict()
        for row in zip(*columns.values()):
            here = row[:same]
            if here != at:
                if run:
                    yield at, run
                run, at = [], here
            run.append(row[same:])
    if run:
        yield at, run


def _lowest(a, b):
    return b if a is None else a if b is None else min(a, b)


def _chains(texts):
    """The chain position of each text: equal bytes share one."""
    distinct, places = [], []
    for text in texts:
        for place, known in enumerate(distinct):
            if known == text:
                break
        else:
            place = len(distinct)
            distinct.append(text)
        places.append(place)
    return places


def own_pages(batches):
    """Owner task: chains the entries of each key of a page; rows come sorted by id."""
    out, rows, held = _schema(ENTRY), [], 0
    for (bucket, page, pages, key), run in _runs(batches, 4):
        places = _chains([text for _, text in run])
        keep, members, sha = {}, {}, {}
        for place, (doc_id, text) in zip(places, run):
            keep[place] = _lowest(keep.get(place), doc_id)
            members[place] = members.get(place, 0) + 1
            if place not in sha:
                sha[place] = hashlib.sha256(text).hexdigest()
        started = set()
        for place, (doc_id, text) in zip(places, run):
            first = place not in started
            started.add(place)
            rows.append((bucket, page, pages, key, place, doc_id, keep[place], members[place], first,
                         sha[place], text if first and pages > 1 else None))
            held += len(text) if first and pages > 1 else 64
        if held > 4 << 20:
            yield _batch(rows, out)
            rows, held = [], 0
    yield _batch(rows, out)


def merge_pages(batches):
    """Second owner of an overflowing key: joins the chains of its pages."""
    out = _schema(MERGED)
    for (bucket, key), run in _runs(batches, 2):
        places = _chains([text for *_, text in run])
        keep, members = {}, {}
        for place, (_, _, low, n, _) in zip(places, run):
            keep[place] = _lowest(keep.get(place), low)
            members[place] = members.get(place, 0) + n
        # The rows come sorted by their lowest id: the first of a chain has the row to keep.
        started, rows = set(), []
        for place, (page, chain, _, _, _) in zip(places, run):
            rows.append((bucket, page, key, chain, keep[place], members[place], place not in started))
            started.add(place)
        yield _batch(rows, out)


def _schema(ddl):
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "string": pa.string(),
             "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (f.split() for f in ddl.split(", "))])


def _batch(rows, schema):
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema)


def build_index(docs, text="text", id_column="doc_id", bucket_bytes=None, key=F.xxhash64):
    """Write the index of ``docs`` to the shared folder; return its (directory, entries).

    ``entries`` has a row per document: bucket, page, key, place in the chain,
    id, and what its page knows of the group (lowest id, size, whether the row is the first).
    ``bucket_bytes`` bounds a bucket or page; by default four fall to each shuffle partition.
    """
    spark = docs.sparkSession
    owners = BUCKETS_PER_TASK * shuffle_partitions(spark)
    bits = min(MAX_DEPTH, (owners - 1).bit_length() + 3)
    keyed = docs.select(F.col(id_column).cast("bigint").alias("id"), normalised(text).alias("text"))
    keyed = keyed.withColumn("key", key(F.col("text"))).withColumn(
        "cell", F.shiftrightunsigned("key", 64 - bits))

    load = np.zeros(2 ** bits)
    for row in (keyed.groupBy("cell").agg(F.sum(F.octet_length("text") + ENTRY_OVERHEAD).alias("bytes"))
                .collect()):  # at most 2**bits rows
        load[row.cell] = row.bytes
    capacity = bucket_bytes or max(MIN_BUCKET_BYTES, load.sum() / owners)
    cells = stored(directory(spark, load, capacity), "dedup-directory")

    paged = (keyed.join(F.broadcast(cells), "cell")  # bounded by MAX_DEPTH
             .withColumn("page", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.col("pages")).cast("int"))
             .select("bucket", "page", F.col("pages").cast("int"), "key", "id",
                     F.col("text").cast("binary").alias("text"))
             .repartition("bucket", "page")
             .sortWithinPartitions("bucket", "page", "key", F.col("id").asc_nulls_last()))
    return cells, gathered(paged.mapInArrow(own_pages, ENTRY), "dedup-entries", load.sum())


def exact_groups(docs, text="text", id_column="doc_id", bucket_bytes=None, key=F.xxhash64):
    """Each row's group: id, keep_id, group_size, kept, text_sha256."""
    _, entries = build_index(docs, text, id_column, bucket_bytes, key)
    place = ["bucket", "page", "key", "chain"]
    heads = (entries.where("pages > 1 AND first")
             .select("bucket", "key", "page", "chain", "keep", "members", "text")
             .repartition("bucket", "key")
             .sortWithinPartitions("bucket", "key", F.col("keep").asc_nulls_last(), "page"))
    merged = heads.mapInArrow(merge_pages, MERGED).select(
        *place, F.col("keep").alias("all_keep"), F.col("members").alias("all_members"),
        F.col("first").alias("all_first"))
    whole = F.col("all_members").isNull()
    groups = entries.drop("text").join(merged, place, "left").select(
        F.col("id").alias(id_column),
        F.when(whole, F.col("keep")).otherwise(F.col("all_keep")).alias("keep_id"),
        F.when(whole, F.col("members")).otherwise(F.col("all_members")).alias("group_size"),
        (F.col("first") & F.coalesce("all_first", F.lit(True))).alias("kept"),
        F.col("sha").alias("text_sha256"))
    return groups.coalesce(few_files(docs.sparkSession))  # short rows: whoever writes them makes few files
