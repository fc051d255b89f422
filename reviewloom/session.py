"""Session creation and the shared work folder."""

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULTS = {
    # Review dates are plain strings, but JSON timestamps follow the session zone.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Join long rows to a smaller table without sorting them, where Spark's own
    # size check finds the hash side small enough.
    "spark.sql.join.preferSortMergeJoin": "false",
    # Write valid and quarantined records side by side instead of sorting them apart.
    "spark.sql.maxConcurrentOutputFileWriters": "4",
    # A remote scorer holds a batch at a time, and its calls take far longer than
    # handing a batch over.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}


def open_session(app_name="reviewloom", master=None, conf=None):
    """Get or create a session; ``conf`` overrides the defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark, purpose):
    """A fresh folder for landed files, tables and checkpoints.

    It lies under ``spark.checkpoint.dir``, the folder every executor can reach.
    Only a local session without that setting gets a temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        shared = tempfile.mkdtemp(prefix="reviewloom-")
    return f"{shared.rstrip('/')}/reviewloom/{purpose}-{uuid.uuid4().hex}"
