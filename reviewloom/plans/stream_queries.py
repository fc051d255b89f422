"""Registered queries that run a stream to its end and read what it wrote."""

import time

from pyspark.sql import functions as F

from ..functions.text import PROMPT
from ..operators.contract import check_contract, keep_bad_lines
from ..operators.envelope import to_envelope
from ..operators.ledger import LabelLedger, text_key
from ..operators.parse import decode_values, parse_records
from ..operators.remote import RemoteScorer
from ..schema import ENVELOPE, KAFKA_ROW, MESSAGE, REVIEW
from ..session import work_dir
from ..sources.lines import NO_FILE_TOO_OLD
from ..sources.ranges import stream_ranges, total_bytes
from ..sources.tables import contract_lines, gappy_reviews, kafka_rows, review_lines, reviews, table
from ..streaming.audit import AUDIT, COUNTS, audited_delivery, read_audit, read_deliveries
from ..streaming.isolate import MAX_BAD, isolating_delivery
from ..streaming.landing import MIN_ROWS_PER_FILE, land, pace, replay_stream
from ..streaming.sinks import FileSink, finish, start_batches, start_stream
from ..streaming.open_schema import OpenTable
from ..streaming.reconcile import digest, reconcile
from ..streaming.supervise import supervise
from ..streaming.topic import TopicSink, read_reports, register
from .enrich import enrich_lines, enrich_messages, label_lines, raw_messages
from .registry import query
from .table_queries import (LEXICON, SQL_CONTRACT, SQL_FEEDBACK, SQL_GAPPY, SQL_LABEL, SQL_REVIEWS, rule_client,
                            sql_json)


def _pace(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").count()  # answered from file footers
    return pace(rows, spark.sparkContext.defaultParallelism)


def _replay(spark, sf_dir, home, lines):
    """Land the lines under ``home`` and return a function that opens the stream."""
    rows_per_file, files = _pace(spark, sf_dir)
    land(lines, f"{home}/landed", rows_per_file)
    return lambda: replay_stream(spark, f"{home}/landed", files_per_trigger=files)


@query(SQL_FEEDBACK)
def stream_feedback(spark, sf_dir):
    """Landed lines, labelled batch by batch."""
    home = work_dir(spark, "stream-feedback")
    source = _replay(spark, sf_dir, home, review_lines(reviews(spark, sf_dir)))
    start_stream(enrich_lines(source(), LEXICON), FileSink(f"{home}/out"),
                 "enrich", f"{home}/checkpoints", until_done=True).awaitTermination()
    return spark.read.schema(ENVELOPE).parquet(f"{home}/out")


@query(SQL_FEEDBACK)
def stream_two_hop(spark, sf_dir):
    """Lines to a raw table of messages, and that table to labelled messages."""
    home = work_dir(spark, "two-hop")
    source = _replay(spark, sf_dir, home, review_lines(reviews(spark, sf_dir)))
    start_stream(raw_messages(source()), FileSink(f"{home}/raw"), "ingest",
                 f"{home}/checkpoints", until_done=True).awaitTermination()
    rows = (spark.readStream.schema(MESSAGE).options(**NO_FILE_TOO_OLD)
            .option("maxFilesPerTrigger", _pace(spark, sf_dir)[1]))
    start_stream(enrich_messages(rows.parquet(f"{home}/raw"), LEXICON),
                 FileSink(f"{home}/out"), "enrich", f"{home}/checkpoints", until_done=True).awaitTermination()
    return spark.read.schema(ENVELOPE).parquet(f"{home}/out")


@query(SQL_FEEDBACK)
def stream_resume(spark, sf_dir):
    """Half the input, stop, the other half, start again on the same checkpoint."""
    home = work_dir(spark, "resume")
    rows_per_file, files = _pace(spark, sf_dir)
    half = F.pmod(F.xxhash64("review_id"), F.lit(2))
    for wave in (0, 1):
        land(review_lines(reviews(spark, sf_dir).filter(half == wave)), f"{home}/landed",
             rows_per_file, mode="append")
        source = replay_stream(spark, f"{home}/landed", files_per_trigger=files)
        start_stream(enrich_lines(source, LEXICON), FileSink(f"{home}/out"),
                     "enrich", f"{home}/checkpoints", until_done=True).awaitTermination()
    return spark.read.schema(ENVELOPE).parquet(f"{home}/out")


def _after_batches(query, n):
    """Wait until ``n`` batches are done, or the query has failed or waits for input."""
    while query.isActive and not (query.lastProgress and query.lastProgress.batchId + 1 >= n):
        if query.status["message"].startswith("Waiting for data") and query.lastProgress:
            return
        time.sleep(0.05)
    if query.exception():
        raise query.exception()


@query(SQL_FEEDBACK)
def stream_byte_ranges(spark, sf_dir):
    """Files cut into byte ranges: stopped inside a file, started again, each line labelled once."""
    home = work_dir(spark, "byte-ranges")
    land(review_lines(reviews(spark, sf_dir)), f"{home}/landed")
    batch = max(1, total_bytes(f"{home}/landed") // 7)
    for stop_midway in (True, False):
        lines = stream_ranges(spark, f"{home}/landed", f"{home}/index", bytes_per_batch=batch,
                              bytes_per_task=max(1, batch // spark.sparkContext.defaultParallelism))
        running = start_stream(enrich_lines(lines, LEXICON), FileSink(f"{home}/out"), "ranges", f"{home}/checkpoints")
        if stop_midway:
            _after_batches(running, 2)
            running.stop()
        else:
            finish(running)
    return spark.read.schema(ENVELOPE).parquet(f"{home}/out")


@query(SQL_FEEDBACK)
def stream_recovery(spark, sf_dir):
    """The first batch fails after it was written; the supervised restart repeats it."""
    home = work_dir(spark, "recovery")
    source = _replay(spark, sf_dir, home, review_lines(reviews(spark, sf_dir)))
    deliver = audited_delivery("enrich", f"{home}/out", f"{home}/audit")
    failed = []

    def deliver_once_failing(batch, batch_id):
        deliver(batch, batch_id)
        if not failed:
            failed.append(batch_id)
            raise RuntimeError("lost after the write")

    def start():
        return start_batches(label_lines(source(), LEXICON), deliver_once_failing, "enrich",
                             f"{home}/checkpoints", until_done=True)

    supervise(start, backoff_s=0)
    return read_deliveries(spark, f"{home}/out").select(*ENVELOPE.names)


@query(f"""WITH {SQL_REVIEWS}, labelled AS (SELECT {SQL_LABEL} AS feedback FROM reviews)
SELECT 'enrich' AS query, count(*) AS n_rows, 0::BIGINT AS null_keys, 0::BIGINT AS null_feedback,
  count(*) FILTER (feedback = 'POSITIVE') AS n_positive,
  count(*) FILTER (feedback = 'NEGATIVE') AS n_negative,
  count(*) FILTER (feedback = 'NEUTRAL') AS n_neutral, 0::BIGINT AS n_empty, 0::BIGINT AS n_unknown
FROM labelled""")
def delivery_audit(spark, sf_dir):
    """Per-batch delivery reports, added up."""
    home = work_dir(spark, "audit")
    source = _replay(spark, sf_dir, home, review_lines(reviews(spark, sf_dir)))
    start_batches(label_lines(source(), LEXICON),
                  audited_delivery("enrich", f"{home}/out", f"{home}/audit"),
                  "enrich", f"{home}/checkpoints", until_done=True).awaitTermination()
    return (read_audit(spark, f"{home}/audit").groupBy("query")
            .agg(*[F.sum(c).alias(c) for c in COUNTS]).select(*AUDIT.names))


@query(f"""WITH {SQL_CONTRACT} SELECT review_id, stars, text,
  CASE WHEN reason IS NOT NULL THEN line END AS line, reason,
  CASE WHEN reason IS NULL THEN 'valid' ELSE 'quarantine' END AS status FROM checked""")
def stream_contract(spark, sf_dir):
    """A stream that keeps good and bad records in folders of their own."""
    home = work_dir(spark, "contract")
    source = _replay(spark, sf_dir, home, contract_lines(spark, sf_dir))
    checked = keep_bad_lines(check_contract(source()))
    start_stream(checked, FileSink(f"{home}/out", partition_by=("status",)), "check",
                 f"{home}/checkpoints", until_done=True).awaitTermination()
    return (spark.read.schema(checked.schema).parquet(f"{home}/out")
            .select("review_id", "stars", "text", "line", "reason", "status"))


POISON = 250   # one row in so many


def _at_most(rows_per_file, files, rows, slots):
    """(rows per file, files per batch) for batches of at most ``rows`` rows, cut so that each has files for all slots."""
    fewer = min(rows_per_file, max(rows // slots, MIN_ROWS_PER_FILE))
    return fewer, max(1, min(rows_per_file * files, rows) // fewer)


@query(f"""WITH {SQL_REVIEWS}, labelled AS (SELECT *, {SQL_LABEL} AS feedback, doc_id % {POISON} = 7 AS bad FROM reviews)
SELECT doc_id AS "offset", CASE WHEN bad THEN 'quarantine' ELSE 'delivered' END AS status,
  CASE WHEN NOT bad THEN {sql_json(*REVIEW.names, 'feedback')} END AS value,
  CASE WHEN bad THEN 'MALFORMED_CHARACTER_CODING' END AS reason FROM labelled""")
def poison_records(spark, sf_dir):
    """Messages that cannot be decoded stop their batch; they are found and set aside, the others delivered once."""
    home = work_dir(spark, "poison")
    rows = kafka_rows(reviews(spark, sf_dir))
    spoilt = F.when(F.pmod("offset", F.lit(POISON)) == 7, F.concat("value", F.lit(b"\xff"))).otherwise(F.col("value"))
    # A batch has half as many bad rows as may be set aside, or less.
    rows_per_file, files = _at_most(*_pace(spark, sf_dir), MAX_BAD * POISON // 2, spark.sparkContext.defaultParallelism)
    rows.withColumn("value", spoilt).write.option("maxRecordsPerFile", rows_per_file).parquet(f"{home}/topic")
    deliver = audited_delivery("enrich", f"{home}/out", f"{home}/audit")

    def start():
        topic = (spark.readStream.schema(KAFKA_ROW).options(**NO_FILE_TOO_OLD)
                 .option("maxFilesPerTrigger", files).parquet(f"{home}/topic"))
        return start_batches(topic, handle, "enrich", f"{home}/checkpoints", until_done=True)

    handle = isolating_delivery(lambda batch: label_lines(decode_values(batch, "fail"), LEXICON), deliver, f"{home}/bad",
                                 narrow=True)
    supervise(start, backoff_s=0)
    delivered = read_deliveries(spark, f"{home}/out").select(
        F.col("key").cast("bigint").alias("offset"), F.lit("delivered").alias("status"), "value", F.lit(None).cast("string").alias("reason"))
    bad = spark.read.schema(f"{KAFKA_ROW.toDDL()}, reason string").parquet(f"{home}/bad").select(
        "offset", F.lit("quarantine").alias("status"), F.lit(None).cast("string").alias("value"), "reason")
    return delivered.unionByName(bad)


@query(f"""WITH {SQL_GAPPY} SELECT review_id, text,
  CASE WHEN text IS NULL THEN NULL WHEN text = '' THEN 'Empty' ELSE
    CASE (length(text) + {len(PROMPT % '')}) % 4 WHEN 0 THEN 'POSITIVE' WHEN 1 THEN 'NEGATIVE'
      WHEN 2 THEN 'NEUTRAL' ELSE 'UNKNOWN' END END AS feedback,
  CASE WHEN text <> '' THEN 1 ELSE 0 END::BIGINT AS n_calls FROM gappy""")
def label_ledger(spark, sf_dir):
    """Every second batch is lost after its delivery and repeated, by when the client replies otherwise: labels stay, and
    no text is asked about twice, neither in its batch nor in another."""
    home = work_dir(spark, "ledger")
    source = _replay(spark, sf_dir, home, review_lines(gappy_reviews(spark, sf_dir)))
    ledger = LabelLedger(spark, f"{home}/labels", buckets=8)
    tries = {}

    def handle(batch, batch_id):
        tries[batch_id] = tries.get(batch_id, -1) + 1
        scorer = RemoteScorer(rule_client(shift=tries[batch_id]))
        labelled = ledger.classify(parse_records(batch).select("review_id", "text"), scorer)
        labelled.write.mode("overwrite").parquet(f"{home}/out/batch_id={batch_id}")
        if batch_id % 2 == 0 and not tries[batch_id]:
            raise RuntimeError("lost after the delivery")

    supervise(lambda: start_batches(source(), handle, "label", f"{home}/checkpoints", until_done=True), backoff_s=0)
    out = spark.read.parquet(f"{home}/out").withColumn("text_key", text_key(F.col("text")))
    return out.join(ledger.calls(spark), "text_key", "left").select(
        "review_id", "text", "feedback", F.coalesce("n_calls", F.lit(0)).cast("bigint").alias("n_calls"))


PARTITIONS, LARGEST = 8, 4000   # of the topic, and bytes of its largest value


@query(f"""WITH {SQL_REVIEWS}, sent AS (
  SELECT CAST(doc_id % {PARTITIONS + 1} AS INT) AS p, octet_length(encode({sql_json(*REVIEW.names)})) <= {LARGEST} AS fits FROM reviews)
SELECT p AS partition, count(*) FILTER (delivered) AS n_records, min(CASE WHEN delivered THEN 0 END)::BIGINT AS first_offset,
  nullif(count(*) FILTER (delivered), 0) - 1 AS last_offset, count(*) FILTER (NOT delivered) AS n_failed
FROM (SELECT p, fits AND p < {PARTITIONS} AS delivered FROM sent) GROUP BY p""")
def delivery_records(spark, sf_dir):
    """Messages streamed to a topic whose records are too large or name no partition now and then: what was delivered to each."""
    home = work_dir(spark, "topic")
    register(spark)
    source = _replay(spark, sf_dir, home, review_lines(reviews(spark, sf_dir)))
    messages = to_envelope(parse_records(source())).withColumn(
        "partition", F.pmod(F.col("key").cast("bigint"), F.lit(PARTITIONS + 1)).cast("int"))
    start_stream(messages, TopicSink(f"{home}/out", PARTITIONS, LARGEST), "deliver", f"{home}/checkpoints",
                 until_done=True).awaitTermination()
    # A partition that the topic does not have is reported under its own number.
    return read_reports(spark, f"{home}/out").groupBy("partition").agg(
        F.sum("n_records").alias("n_records"), F.min("first_offset").alias("first_offset"),
        F.max("last_offset").alias("last_offset"), F.sum("n_failed").alias("n_failed"))


@query(f"""WITH {SQL_REVIEWS} SELECT review_id AS key, 1::BIGINT AS n_left,
  CASE doc_id % 100 WHEN 13 THEN 0 WHEN 57 THEN 2 ELSE 1 END::BIGINT AS n_right,
  CASE doc_id % 100 WHEN 13 THEN 'lost' WHEN 57 THEN 'doubled' ELSE 'changed' END AS what
FROM reviews WHERE doc_id % 100 IN (13, 57, 71)""")
def hops_reconciled(spark, sf_dir):
    """A second hop that loses, doubles and changes some messages: digests written with both hops tell which."""
    home = work_dir(spark, "reconcile")
    source = _replay(spark, sf_dir, home, review_lines(reviews(spark, sf_dir)))
    first = to_envelope(parse_records(source()))
    start_stream(first, FileSink(f"{home}/first"), "first", f"{home}/checkpoints", until_done=True).awaitTermination()
    rows = spark.readStream.schema(ENVELOPE).options(**NO_FILE_TOO_OLD).parquet(f"{home}/first")
    digit = F.pmod(F.col("key").cast("bigint"), F.lit(100))
    copies = F.when(digit == 13, 0).when(digit == 57, 2).otherwise(1)
    # Not filter and union: one pass with as many copies as each message gets.
    second = rows.select("key", F.when(digit == 71, F.concat("value", F.lit(" "))).otherwise(F.col("value")).alias("value"),
                         F.explode(F.array_repeat(F.lit(0), copies)).alias("copy")).select("key", "value")
    start_stream(second, FileSink(f"{home}/second"), "second", f"{home}/checkpoints", until_done=True).awaitTermination()
    sides, digests = [], []
    for hop in ("first", "second"):
        side = spark.read.schema(ENVELOPE).parquet(f"{home}/{hop}")
        digest(side, "key").write.parquet(f"{home}/{hop}-digest")
        sides.append(side)
        digests.append(spark.read.parquet(f"{home}/{hop}-digest"))
    return reconcile(*sides, "key", *digests)


@query(f"""WITH {SQL_REVIEWS}, waves AS (
  SELECT event_id, event_type, props, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, user_id, value FROM events)
SELECT * REPLACE (CAST(user_id AS VARCHAR) AS user_id) FROM waves
  UNION ALL BY NAME SELECT * EXCLUDE doc_id REPLACE (CAST(stars AS DOUBLE) AS stars) FROM reviews""")
def stream_schema(spark, sf_dir):
    """Two waves of lines with fields of their own, and one field that is a number first and text later."""
    home = work_dir(spark, "open-schema")
    out = OpenTable(f"{home}/out")
    for wave in (table(spark, sf_dir, "events"), reviews(spark, sf_dir)):
        land(review_lines(wave), f"{home}/landed", _pace(spark, sf_dir)[0], mode="append")
        source = replay_stream(spark, f"{home}/landed", files_per_trigger=_pace(spark, sf_dir)[1])
        start_batches(source, out.deliver, "open", f"{home}/checkpoints", until_done=True).awaitTermination()
    return out.read(spark)
