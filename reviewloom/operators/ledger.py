"""Labels kept by text, so that no text is asked about twice."""

import hashlib

from pyspark.sql import functions as F

from ..functions.records import field
from ..session import work_dir
from .classify import guard

_KEY, _LABEL, _TEXT = "__text_key", "__label", "__text"
BUCKETS = 64


class LabelLedger:
    """A keyed store of text hash to label, in the folder ``path``.

    ``classify`` asks the scorer once for each distinct text that the ledger doesn't know, writes the labels to the ledger, and only
    then labels the rows, from the ledger. So a batch that is repeated after a failure pays for no text
    again and keeps its labels, though the scorer may now reply otherwise; and copies of a text get the same label.

    The folder holds the hash (SHA-256, 32 bytes) and the label of every text, as a table in ``buckets`` by hash: its
    side of a batch's joins is not shuffled, and only the batch's distinct texts move. A batch reads the
    whole ledger, some 40 bytes a text, so let batches grow with it. ``compact`` merges the files of many batches.

    A ledger belongs to one scorer, with one prompt and set of labels, and to one writer at a time. Labels of a failed attempt
    that were not written yet are asked for again.
    """

    def __init__(self, spark, path, buckets=BUCKETS):
        self.path, self.buckets = path.rstrip("/"), buckets
        self.name = "label_ledger_" + hashlib.sha256(self.path.encode()).hexdigest()[:16]
        self._declare(spark, self.name, self.path)

    def _declare(self, spark, name, path):
        location = path.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} (text_key BINARY, label STRING) USING parquet "
                  f"CLUSTERED BY (text_key) SORTED BY (text_key) INTO {self.buckets} BUCKETS LOCATION '{location}'")

    def read(self, spark):
        """text_key and label of every text asked about so far; of two labels, should there be, the first by name."""
        spark.catalog.refreshTable(self.name)
        return spark.table(self.name).groupBy("text_key").agg(F.min("label").alias("label"))

    def calls(self, spark):
        """text_key and n_calls: how often a label was written for it."""
        spark.catalog.refreshTable(self.name)
        return spark.table(self.name).groupBy("text_key").agg(F.count("*").alias("n_calls"))

    def learn(self, texts, scorer, text_col="text"):
        """Ask for the labels of all distinct texts in ``texts`` that are not known yet, and write them."""
        spark = texts.sparkSession
        text = field(text_col)
        asked = (texts.where(F.octet_length(text) > 0).select(text_key(text).alias(_KEY), text.alias(_TEXT))
                 .groupBy(_KEY).agg(F.first(_TEXT).alias(_TEXT)))
        known = self.read(spark).select(F.col("text_key").alias(_KEY))
        scored = scorer.score(asked.join(known, _KEY, "left_anti"), _TEXT, _LABEL)
        self._write(scored.select(F.col(_KEY).alias("text_key"), F.col(_LABEL).alias("label")), self.name)

    def _write(self, labels, name):
        # One file a bucket.
        (labels.repartition(self.buckets, "text_key").write.mode("append").format("parquet")
         .bucketBy(self.buckets, "text_key").sortBy("text_key").saveAsTable(name))

    def classify(self, df, scorer, text_col="text", out_col="feedback", empty_label="Empty"):
        """As ``operators.classify.classify``, by way of the ledger. ``df`` is read three times."""
        self.learn(df, scorer, text_col)
        spark, text = df.sparkSession, field(text_col)
        # The batch's labels as a table of their own: Spark can then broadcast it, or split a text that many rows share.
        here = df.where(F.octet_length(text) > 0).select(text_key(text).alias("text_key")).distinct()
        path = work_dir(spark, "batch-labels")
        self.read(spark).join(here, "text_key", "left_semi").write.parquet(path)
        known = spark.read.parquet(path).select(F.col("text_key").alias(_KEY), F.col("label").alias(_LABEL))
        rows = df.withColumn(_KEY, F.when(F.octet_length(text) > 0, text_key(text))).join(known, _KEY, "left")
        label = guard(F.octet_length(text), F.col(_LABEL), empty_label)
        return rows.select(*[field(c) for c in df.columns if c != out_col], label.alias(out_col))

    def compact(self, spark, path):
        """A ledger at the new folder ``path`` with the same labels and one file a bucket."""
        other = LabelLedger(spark, path, self.buckets)
        other._write(self.read(spark), other.name)
        return other


def text_key(text):
    return F.unhex(F.sha2(text.cast("binary"), 256))
