"""Find the records that make a batch fail, set them aside, and deliver the others."""

import logging
import re
from bisect import bisect_right
from concurrent.futures import ThreadPoolExecutor
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..functions.records import field
from ..session import work_dir
from .supervise import is_outage

log = logging.getLogger(__name__)

MAX_BAD = 1000
DEALT_PIECES = 4
DEALT_ROWS = 10_000   # of a part, which one task reads
FOREVER_H = 10_000   # hours a job may take
# All steps of a plan in one expression, interpreted: compiled code computes parts that occur twice ahead of it, or else twice.
ONE_EXPRESSION = {"spark.sql.optimizer.collapseProjectAlwaysInline": "true", "spark.sql.subexpressionElimination.enabled": "true",
                  "spark.sql.codegen.wholeStage": "false", "spark.sql.codegen.factoryMode": "NO_CODEGEN"}


class TooManyBad(RuntimeError):
    """So many rows fail that the job must be wrong, not the rows."""


class NumberedRows:
    """A batch written to the shared folder, whose rows can be asked for by their place.

    Spark numbers rows within partitions; the first number and the count of each file turn places into its numbers.
    """

    def __init__(self, batch):
        spark = batch.sparkSession
        self.path = path = work_dir(spark, "isolate")
        (batch.select(F.struct(*map(field, batch.columns)).alias("row"), F.monotonically_increasing_id().alias("n"))
         .write.parquet(path))
        self.rows = spark.read.parquet(path)
        files = sorted(self.rows.groupBy("_metadata.file_path").agg(F.min("n"), F.count("*")).collect(), key=lambda file: file[1])
        self.files = {path: i for i, (path, _, _) in enumerate(files)}
        self.firsts = [first for _, first, _ in files]
        self.begins = list(accumulate((n for _, _, n in files), initial=0))

    @property
    def total(self):
        return self.begins[-1]

    def number(self, place):
        """Spark's number of the row at ``place``; for the end, one that no row reaches."""
        if place == self.total:
            return 1 << 62
        i = bisect_right(self.begins, place) - 1
        return self.firsts[i] + place - self.begins[i]

    def between(self, begin, end):
        """The rows from place ``begin`` to before ``end``. Files are sorted by number, so others are skipped."""
        return self.rows.where(F.col("n").between(self.number(begin), self.number(end) - 1)).select("row.*")

    def dealt(self, parts):
        """The rows of ``parts``, ranges of places in order, those of part i in partition i."""
        if all(end - begin == 1 for begin, end in parts):
            some = self.rows.sparkSession.createDataFrame([(self.number(p), i) for i, (p, _) in enumerate(parts)], "n bigint, part int")
            return self.rows.join(F.broadcast(some), "n").repartitionById(len(parts), "part").select("row.*")
        begins, ends = (np.array([self.number(place) for place in side]) for side in zip(*parts))

        @F.pandas_udf("int")
        def part_of(n: pd.Series) -> pd.Series:
            part = np.searchsorted(begins, n, side="right") - 1
            return pd.Series(np.where((part >= 0) & (n < ends[part]), part, -1))

        within = F.col("n").between(int(begins[0]), int(ends[-1]) - 1)
        return (self.rows.where(within).withColumn("part", part_of("n")).where("part >= 0")
                .repartitionById(len(parts), "part").select("row.*"))

    def caught(self, process, most):
        """The places of the rows for which ``process`` raises an error, found in one pass: None if there are more than ``most``.

        The pass fails where an error does not come from an expression over columns, as with Python or a generator.
        """
        session = self.rows.sparkSession
        spark = SparkSession(session.sparkContext, session._jsparkSession.cloneSession())
        for key, value in ONE_EXPRESSION.items():
            spark.conf.set(key, value)
        # Null for an error of its argument too, whatever step raises it; a hash is never null.
        computed = F.try_to_binary(F.col("hash").cast("string"), F.lit("utf-8"))
        found = (hashed(process(spark.read.parquet(self.path).select("row.*")), "_metadata.file_path", "_metadata.row_index")
                 .where(computed.isNull()).limit(most + 1).groupBy("file_path").agg(F.collect_list("row_index")).collect())
        places = sorted(self.begins[self.files[path]] + i for path, indexes in found for i in indexes)
        return places if len(places) <= most else None

    def without(self, places):
        gone = self.rows.sparkSession.createDataFrame([(self.number(p),) for p in places], "n bigint")
        return self.rows.join(F.broadcast(gone), "n", "left_anti").select("row.*")

    def only(self, reasons):
        """The rows at the places of ``reasons``, with their reason."""
        some = self.rows.sparkSession.createDataFrame([(self.number(p), why) for p, why in reasons.items()], "n bigint, reason string")
        return self.rows.join(F.broadcast(some), "n").select("row.*", "reason")


CONDITION = re.compile(r"\[([A-Z][A-Z0-9_.]+)\]")


def hashed(rows, *beside):
    """One number for each row, which takes all of its columns, and the columns ``beside``."""
    columns = [F.to_json(F.struct(field(c))) if "map<" in kind else field(c) for c, kind in rows.dtypes]
    return rows.select(*beside, F.xxhash64(*columns).alias("hash"))


def reason_of(failure):
    """The error's condition, such as ``MALFORMED_CHARACTER_CODING``, or else its first line."""
    text = str(failure)
    named = [c for c in CONDITION.findall(text) if not c.startswith(("FOREACH_BATCH", "TASK_WRITE_FAILED", "STREAM_"))]
    return named[0] if named else text.strip().split("\n")[0][:300]


def confirm(places, fails, tries=2, parallel=8, dealt=None):
    """{place: reason} of those rows at ``places``, each of which has failed once, that fail by themselves until it is ``tries`` times."""
    parts = [(place, place + 1) for place in places]
    attempt = dealt(parts) if dealt and len(parts) > parallel else fails
    with ThreadPoolExecutor(parallel) as pool:
        found = list(pool.map(lambda part: [attempt(*part) for _ in range(max(1, tries - 1))], parts))
    return {place: reason_of(failures[0]) for place, failures in zip(places, found) if all(failures)}


def find_bad(rows, fails, max_bad=MAX_BAD, tries=2, parallel=8, dealt=None, known=()):
    """{place: reason} of the rows that fail by themselves.

    ``fails(begin, end)`` gives the error of these rows or None. The failing ranges are halved, or cut finer while there are fewer
    of them than ``parallel``, and the parts tried side by side; so there are at most log2(rows) + 1
    rounds, and about log2(rows) tries for each bad row. A single row counts as bad if it fails ``tries`` times.

    ``dealt(parts)`` may give another ``fails`` for a round of more than ``parallel`` parts of at most ``DEALT_ROWS``, which tries
    each of them cheaper.
    Ranges are cut in ``DEALT_PIECES`` then, for as many tries in half the rounds.

    Places that are ``known`` to be bad are left out, and count; the ranges between them are tried whole at first.
    """
    edges = [-1, *sorted(known), rows]
    bad, suspects = {}, [(a + 1, b) for a, b in zip(edges, edges[1:]) if b > a + 1]
    whole = bool(known)
    with ThreadPoolExecutor(parallel) as pool:
        while suspects:
            if len(known) + len(bad) + (0 if whole else len(suspects)) > max_bad:
                raise TooManyBad(f"more than {max_bad} of {rows} rows fail")
            pieces = 1 if whole else max(DEALT_PIECES if dealt else 2, parallel // len(suspects))
            whole = False
            parts = [(b, e) for begin, end in suspects for b, e in cut(begin, end, pieces)]
            small = max(end - begin for begin, end in parts) <= DEALT_ROWS
            attempt = dealt(parts) if dealt and small and len(parts) > parallel else fails
            found = list(pool.map(lambda part: attempt(*part), parts))
            singles = [part for part, failure in zip(parts, found) if failure and part[1] - part[0] == 1]
            again = dict(zip(singles, pool.map(lambda part: all(attempt(*part) for _ in range(tries - 1)), singles)))
            suspects = []
            for (begin, end), failure in zip(parts, found):
                if failure is None:
                    continue
                if end - begin > 1:
                    suspects.append((begin, end))
                    continue
                if again[begin, end]:
                    bad[begin] = reason_of(failure)
    return bad


def cut(begin, end, pieces):
    """``begin`` to ``end`` in at most ``pieces`` parts of about the same size."""
    pieces = max(1, min(pieces, end - begin))
    edges = [begin + (end - begin) * i // pieces for i in range(pieces + 1)]
    return [(b, e) for b, e in zip(edges, edges[1:]) if b < e]


def isolating_delivery(process, deliver, quarantine_dir, after=2, max_bad=MAX_BAD, tries=2, parallel=8, outage=is_outage,
                        narrow=False):
    """A batch handler that hands ``process(batch)`` to ``deliver(rows, batch_id)`` and survives poison records.

    When a batch fails for the ``after``-th time, its rows are written down and tried in ever smaller parts, by computing
    ``process`` of them without writing anything, until the rows that fail are alone. They go to
    ``quarantine_dir/batch_id=<n>`` with the reason, and the others are delivered as the batch. Both are
    written over if the batch is repeated, as ``deliver`` must do with its own. Run it under ``supervise``, which starts the
    query again after the first failures.

    An outage is never blamed on rows: it is raised again. So is an error that no row shows alone, and
    ``TooManyBad`` where more than ``max_bad`` rows fail. ``process`` must work row by row. It runs some log2(rows) times for a bad
    row's neighbours, so a scorer that costs money belongs behind a ``LabelLedger``.

    With ``narrow``, for a ``process`` that leaves rows in their partitions (no join, no shuffle), the parts of a round are
    partitions of one table, planned and dealt once, and a try is a job over one of its partitions. Where all steps are expressions over
    columns, one pass tells the rows that fail, each is tried again by itself, and parts are tried only if the others fail still.
    """
    failures = {}

    def handle(batch, batch_id):
        try:
            deliver(process(batch), batch_id)
            failures.pop(batch_id, None)
            return
        except Exception as failure:
            failures[batch_id] = failures.get(batch_id, 0) + 1
            if outage(failure) or failures[batch_id] < after:
                raise
            first = failure
        rows = NumberedRows(batch)

        @inheritable_thread_target(batch.sparkSession)
        def fails(begin, end):
            try:
                process(rows.between(begin, end)).write.format("noop").mode("overwrite").save()
            except Exception as failure:
                if outage(failure):
                    raise
                return failure

        def dealt(parts):
            table, place = hashed(process(rows.dealt(parts)))._jdf.toJavaRDD().rdd(), {part: i for i, part in enumerate(parts)}
            jvm, kind = batch.sparkSession._jvm, table.elementClassTag()
            hours = jvm.scala.concurrent.duration.Duration.apply(FOREVER_H, "hours")

            @inheritable_thread_target(batch.sparkSession)
            def part_fails(begin, end):
                # A set is a function that tells what is in it. Jobs over one and the same RDD would fail together, so each has its own.
                one = jvm.org.apache.spark.rdd.PartitionPruningRDD.create(table, jvm.PythonUtils.toSeq([place[begin, end]]).toSet())
                # The error is looked up in the JVM: raised in Python it would take longer than the job.
                job = jvm.org.apache.spark.rdd.AsyncRDDActions(one, kind).countAsync()
                ended = jvm.org.apache.spark.util.ThreadUtils.awaitReady(job, hours).value().get()
                if ended.isSuccess():
                    return None
                failure = RuntimeError(ended.failed().get().toString())
                if outage(failure):
                    raise failure
                # An error without a condition is told as a batch tells it.
                return failure if CONDITION.search(str(failure)) else fails(begin, end)
            return part_fails

        def caught():
            try:
                return rows.caught(process, max_bad) or []
            except Exception as failure:
                if outage(failure):
                    raise
                return []

        def set_aside(bad):
            log.warning("batch %s: %d of %d rows are set aside", batch_id, len(bad), rows.total)
            rows.only(bad).write.mode("overwrite").parquet(f"{quarantine_dir.rstrip('/')}/batch_id={batch_id}")
            deliver(process(rows.without(bad)), batch_id)
            failures.pop(batch_id, None)

        bad = confirm(caught(), fails, tries, parallel, dealt) if narrow else {}
        if bad:
            try:
                set_aside(bad)
                return
            except Exception as failure:
                if outage(failure):
                    raise
                first = failure
        more = find_bad(rows.total, fails, max_bad, tries, parallel, dealt if narrow else None, bad)
        if not more:
            raise first
        set_aside(bad | more)

    return handle
