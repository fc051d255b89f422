"""A topic in a folder, with a delivery report for every record.

``write_topic`` writes a table of messages, and ``TopicSink`` a stream: rows of ``key``, ``value`` and ``partition``. Every task writes a file of
its own and hands a commit message to the driver: per partition how many records it holds and how many failed. From these the driver gives
the records offsets, gapless in each partition from the last delivery on, and writes them as a report. The report is what counts: a
file that no report names, as a lost or repeated task leaves one, is no part of the topic, and a batch that is repeated replaces
its report. So each record has one offset, whatever failed on the way.

A record can be refused, as a broker refuses one: its value is larger than ``max_bytes``, or its partition is none of
the topic's. It is kept beside the others with its error and fails no task.

A partition is no task: a hot one is written by many. Nothing is shuffled; the messages carry a row per task and partition.
"""

import io
import json
import sys
import uuid
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceStreamArrowWriter, WriterCommitMessage

from ..sources.ranges import locate

# The classes travel by value, so neither the driver's planner nor the executors need a copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NAME = "file_topic"
MAX_BYTES = 1 << 20     # of a value
TOO_LARGE, NO_PARTITION = "too large", "no such partition"

RECORDS = pa.schema([("partition", pa.int32()), ("nth", pa.int64()), ("key", pa.binary()), ("value", pa.binary()),
                     ("error", pa.string())])
REPORT = pa.schema([("delivery", pa.int64()), ("file", pa.string()), ("partition", pa.int32()), ("n_records", pa.int64()),
                    ("first_offset", pa.int64()), ("last_offset", pa.int64()), ("n_failed", pa.int64())])
REPORT_SQL = ("delivery bigint, file string, partition int, n_records bigint, first_offset bigint, last_offset bigint, "
              "n_failed bigint")


@dataclass
class Written(WriterCommitMessage):
    """A task's file, and by partition: records, failures."""

    file: str
    counts: dict = field(default_factory=dict)


def refused(batch, partitions, max_bytes):
    """The error of every record, null for those that can be delivered."""
    partition = pc.fill_null(batch["partition"], -1)
    wrong = pc.or_(pc.less(partition, 0), pc.greater_equal(partition, partitions))
    large = pc.greater(pc.fill_null(pc.binary_length(batch["value"]), 0), max_bytes)
    return pc.case_when(pc.make_struct(wrong, large), NO_PARTITION, TOO_LARGE)


def write_file(options, batches):
    """Write the records of a task and tell what was written."""
    store, folder = locate(options["path"])
    partitions, max_bytes = int(options["partitions"]), int(options["maxbytes"])
    name = f"{uuid.uuid4().hex}.parquet"
    seen, failed = np.zeros(partitions, dtype=np.int64), {}
    store.create_dir(f"{folder}/records", recursive=True)
    with store.open_output_stream(f"{folder}/records/{name}") as out, pq.ParquetWriter(out, RECORDS) as writer:
        for batch in batches:
            table = pa.table({"partition": batch["partition"].cast(pa.int32()), "key": batch["key"].cast(pa.binary()),
                              "value": batch["value"].cast(pa.binary())})
            errors = refused(table.to_batches()[0] if table.num_rows else batch, partitions, max_bytes) if table.num_rows else pa.nulls(0, pa.string())
            good = pc.is_null(errors).to_numpy(zero_copy_only=False)
            where = pc.fill_null(table["partition"], -1).to_numpy()
            nth = np.zeros(len(where), dtype=np.int64)
            at = np.flatnonzero(good)
            order = at[np.argsort(where[at], kind="stable")]
            counts = np.bincount(where[at], minlength=partitions)
            nth[order] = seen[where[order]] + np.arange(len(order)) - np.repeat(np.cumsum(counts) - counts, counts)
            seen += counts
            for p, n in zip(*np.unique(where[~good], return_counts=True)):
                failed[int(p)] = failed.get(int(p), 0) + int(n)
            writer.write_table(pa.table([table["partition"], pa.array(nth, mask=~good), table["key"], table["value"], errors],
                                        schema=RECORDS))
    named = set(np.flatnonzero(seen).tolist()) | set(failed)
    return Written(name, {p: (int(seen[p]) if 0 <= p < partitions else 0, failed.get(p, 0)) for p in sorted(named)})


class Reports:
    """The reports of a topic, one per delivery, numbered."""

    def __init__(self, options):
        self.store, folder = locate(options["path"])
        self.records, self.folder = f"{folder}/records", f"{folder}/reports"
        self.store.create_dir(self.folder, recursive=True)

    def _path(self, delivery):
        return f"{self.folder}/{delivery:015d}.parquet"

    def last(self):
        names = [i.base_name for i in self.store.get_file_info(fs.FileSelector(self.folder)) if i.base_name[:1].isdigit()]
        return max((int(n.split(".")[0]) for n in names), default=-1)

    def next_offsets(self, delivery):
        """By partition the offset behind those before ``delivery``; each report states it."""
        if delivery < 0:
            return {}
        with self.store.open_input_file(self._path(delivery)) as file:
            kept = pq.read_schema(file).metadata[b"next_offsets"]
        return {int(p): n for p, n in json.loads(kept).items()}

    def write(self, delivery, messages, before):
        after, rows = self.next_offsets(before), []
        for message in messages:
            for p, (n, failed) in message.counts.items() if message else ():
                first = after.get(p, 0)
                rows.append((delivery, message.file, p, n, first if n else None, first + n - 1 if n else None, failed))
                if n:
                    after[p] = first + n
        columns = list(zip(*rows)) or [()] * len(REPORT)
        schema = REPORT.with_metadata({"next_offsets": json.dumps(after)})
        written = io.BytesIO()
        pq.write_table(pa.table([pa.array(c, type=f.type) for c, f in zip(columns, REPORT)], schema=schema), written)
        draft = f"{self.folder}/_{uuid.uuid4().hex}"
        with self.store.open_output_stream(draft) as out:
            out.write(written.getvalue())
        self.store.move(draft, self._path(delivery))

    def drop(self, messages):
        for message in messages:
            if message:
                self.store.delete_file(f"{self.records}/{message.file}")


class BatchWriter(DataSourceArrowWriter):
    def __init__(self, options):
        self.options = options

    def write(self, iterator):
        return write_file(self.options, iterator)

    def commit(self, messages):
        reports = Reports(self.options)
        last = reports.last()
        reports.write(last + 1, messages, last)

    def abort(self, messages):
        Reports(self.options).drop(messages)


class StreamWriter(DataSourceStreamArrowWriter):
    def __init__(self, options):
        self.options = options

    def write(self, iterator):
        return write_file(self.options, iterator)

    def commit(self, messages, batchId):
        # A repeated batch replaces its report and begins where it began before.
        Reports(self.options).write(batchId, messages, batchId - 1)

    def abort(self, messages, batchId):
        Reports(self.options).drop(messages)


class FileTopic(DataSource):
    @classmethod
    def name(cls):
        return NAME

    def _options(self):
        return {k: v for k, v in self.options.items()}

    def writer(self, schema, overwrite):
        return BatchWriter(self._options())

    def streamWriter(self, schema, overwrite):
        return StreamWriter(self._options())


@dataclass(frozen=True)
class TopicSink:
    """For ``start_stream`` and ``write_batch``: rows of key, value and partition. A topic takes one stream or any number
    of batches in a row, not both."""

    path: str
    partitions: int
    max_bytes: int = MAX_BYTES
    format: str = NAME

    def options(self):
        return {"path": self.path, "partitions": str(self.partitions), "maxbytes": str(self.max_bytes)}


def register(spark):
    """Make the sink known to a session."""
    spark.dataSource.register(FileTopic)


def read_reports(spark, path):
    """A row per delivery, file and partition."""
    return spark.read.schema(REPORT_SQL).parquet(f"{path}/reports")


def read_topic(spark, path):
    """partition, offset, key and value of all delivered records."""
    return _records(spark, path).where("error IS NULL").select(
        "partition", (F.col("first_offset") + F.col("nth")).alias("offset"), "key", "value")


def read_refused(spark, path):
    """partition, key, value and error of all records that were refused."""
    return _records(spark, path).where("error IS NOT NULL").select("partition", "key", "value", "error")


def _records(spark, path):
    named = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    rows = spark.read.schema("partition int, nth bigint, key binary, value binary, error string").parquet(f"{path}/records")
    reports = read_reports(spark, path).select("file", F.col("partition").alias("p"), "first_offset")
    own = [F.col("file") == F.col("written"), F.col("p").eqNullSafe(F.coalesce("partition", F.lit(-1)))]
    return rows.withColumn("written", named).join(reports, own)
