"""Where messages go, and how queries are started."""

import threading
from dataclasses import dataclass

from pyspark.errors import StreamingQueryException

from ..settings import KafkaSettings


@dataclass(frozen=True)
class KafkaSink:
    """At least once: a repeated batch may send a message twice, and a scorer that
    is not deterministic may have labelled it differently."""

    topic: str
    settings: KafkaSettings
    format: str = "kafka"

    def options(self):
        return self.settings.options() | {"topic": self.topic}


@dataclass(frozen=True)
class FileSink:
    """Exactly once for readers that use Spark: committed files are listed in a log.

    The log grows with the number of files. For a table of very many batches use
    ``audit.audited_delivery``, which keeps one folder per batch and no log.
    """

    path: str
    format: str = "parquet"
    partition_by: tuple = ()

    def options(self):
        return {"path": self.path}


@dataclass(frozen=True)
class LineSink:
    """One ``value`` per line, UTF-8."""

    path: str
    format: str = "text"

    def options(self):
        return {"path": self.path, "lineSep": "\n"}


@dataclass(frozen=True)
class ConsoleSink:
    """For debugging only."""

    rows: int = 20
    truncate: bool = True
    format: str = "console"

    def options(self):
        return {"numRows": str(self.rows), "truncate": str(self.truncate).lower()}


def write_batch(messages, sink, mode="append"):
    """Write a table of messages in parallel, one writer per partition."""
    _prepare(messages, "write", sink).mode(mode).save()


def start_stream(messages, sink, name, checkpoint_root, every=None, until_done=False):
    """Start an append-mode query and return its handle.

    The checkpoint is ``<checkpoint_root>/<name>``: a checkpoint belongs to one
    query, and a restart under the same name goes on where the last run stopped.
    ``every`` paces the batches (``"10 seconds"``); ``until_done`` handles what is
    there and stops. With neither, batches follow each other at once.
    """
    writer = _prepare(messages, "writeStream", sink)
    return _start(writer, name, checkpoint_root, every, until_done)


def finish(query):
    """Let a query work off all that its source has now, batch by batch, and stop it."""
    try:
        query.processAllAvailable()
    finally:
        query.stop()


def finish_aside(query):
    """As ``finish``, in a thread of its own, while the caller waits for the query; a failure is left to the caller."""
    def work():
        try:
            finish(query)
        except StreamingQueryException:
            pass
    threading.Thread(target=work, daemon=True).start()


def start_batches(df, handle_batch, name, checkpoint_root, every=None, until_done=False):
    """Start a query that hands every batch to ``handle_batch(batch, batch_id)``."""
    return _start(df.writeStream.foreachBatch(handle_batch), name, checkpoint_root, every, until_done)


def _prepare(messages, writer, sink):
    if isinstance(sink, LineSink):
        messages = messages.select("value")
    out = getattr(messages, writer).format(sink.format).options(**sink.options())
    partition_by = getattr(sink, "partition_by", ())
    return out.partitionBy(*partition_by) if partition_by else out


def _start(writer, name, checkpoint_root, every, until_done):
    if not checkpoint_root:
        raise ValueError("a stream needs a checkpoint folder")
    if every and until_done:
        raise ValueError("give every or until_done, not both")
    writer = (writer.queryName(name).outputMode("append")
              .option("checkpointLocation", f"{checkpoint_root.rstrip('/')}/{name}"))
    if until_done:
        writer = writer.trigger(availableNow=True)
    elif every:
        writer = writer.trigger(processingTime=every)
    return writer.start()
