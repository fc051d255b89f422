"""Delivery reports: one row of counts per batch."""

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.records import field
from ..operators.envelope import to_envelope
from ..schema import EMPTY, ENVELOPE, LABELS, UNKNOWN
from .sinks import write_batch

# Report column -> feedback value.
_LABEL_COUNTS = {f"n_{v.lower()}": v for v in (*LABELS, EMPTY, UNKNOWN)}
COUNTS = ("n_rows", "null_keys", "null_feedback", *_LABEL_COUNTS)

AUDIT = T.StructType(
    [T.StructField("query", T.StringType())]
    + [T.StructField(c, T.LongType()) for c in COUNTS])


def delivery_counts(key="review_id", feedback="feedback"):
    """The counts as aggregate columns."""
    out = {
        "n_rows": F.count(F.lit(1)),
        "null_keys": F.count_if(field(key).isNull()),
        "null_feedback": F.count_if(field(feedback).isNull()),
    }
    out |= {name: F.count_if(field(feedback) == value) for name, value in _LABEL_COUNTS.items()}
    return [col.alias(name) for name, col in out.items()]


def observe_delivery(df, name, key="review_id", feedback="feedback"):
    """Count while the rows pass; a stream reports the counts in its progress."""
    return df.observe(name, *delivery_counts(key, feedback))


def progress_counts(query, name):
    """Counts of the recent batches of a running or ended query, per batch id.

    Spark keeps the last ``spark.sql.streaming.numRecentProgressUpdates`` batches;
    ``audited_delivery`` keeps all of them in a table.
    """
    return {p.batchId: p.observedMetrics[name].asDict()
            for p in query.recentProgress if name in p.observedMetrics}


class ForeignFolder(RuntimeError):
    """The folder holds the batches of another checkpoint."""


def claim(spark, folder, query_id):
    """Mark ``folder`` as that of one query, or raise if it is another's.

    The id is the checkpoint's: it stays the same when a query is started again.
    """
    mark = f"{folder.rstrip('/')}/_owner"
    try:
        owner = spark.read.schema("owner string").parquet(mark).first().owner
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        spark.range(1, numPartitions=1).select(F.lit(query_id).alias("owner")).write.parquet(mark)
        return
    if owner != query_id:
        raise ForeignFolder(f"{folder} holds the batches of query {owner}, not of {query_id}: "
                            "use new folders with a new checkpoint")


def _query_id(spark):
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId")


def audited_delivery(name, out, audit_dir, key="review_id", feedback="feedback", quarantine_dir=None):
    """A batch handler that writes envelopes and one report row per batch.

    ``out`` is a folder or a sink such as ``KafkaSink``. In a folder each batch
    overwrites its own ``batch_id=<n>``, so a batch repeated after a failure replaces what
    it wrote before; a topic receives it again. The folders belong to one checkpoint
    and are marked so: the batches of a new one, which count from 0 again, are refused.

    With ``quarantine_dir`` the rows come from ``contract.check_contract``: those of
    status ``valid`` are delivered and counted, the others kept there by batch, as line and reason.

    Every row is scored once: the counts are taken while the envelopes are
    written, in the tasks that write them. Spark counts a finished task of that
    stage once, whatever was lost or tried again before.
    """
    folders = [d for d in (out if isinstance(out, str) else None, audit_dir, quarantine_dir) if d]
    claimed = []

    def deliver(batch, batch_id):
        spark = batch.sparkSession
        if not claimed:
            for folder in folders:
                claim(spark, folder, _query_id(spark))
            claimed.append(True)
        if quarantine_dir:
            (batch.where("status = 'quarantine'").select("line", "reason")
             .write.mode("overwrite").parquet(f"{quarantine_dir}/batch_id={batch_id}"))
            batch = batch.where("status = 'valid'").drop("line", "status", "reason")
        seen = Observation(f"{name}-{batch_id}-{uuid.uuid4().hex}")
        envelopes = to_envelope(batch.observe(seen, *delivery_counts(key, feedback)), key)
        if isinstance(out, str):
            envelopes.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
        else:
            write_batch(envelopes, out)
        counts = seen.get
        report = spark.range(1, numPartitions=1).select(
            F.lit(name).alias("query"),
            *[F.lit(counts.get(c, 0)).cast("bigint").alias(c) for c in COUNTS])
        report.write.mode("overwrite").parquet(f"{audit_dir}/batch_id={batch_id}")

    return deliver


def read_deliveries(spark, out_dir):
    return spark.read.schema(T.StructType(
        ENVELOPE.fields + [T.StructField("batch_id", T.LongType())])).parquet(out_dir)


def read_audit(spark, audit_dir):
    return spark.read.schema(T.StructType(
        AUDIT.fields + [T.StructField("batch_id", T.LongType())])).parquet(audit_dir)
