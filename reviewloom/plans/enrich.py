"""The pipelines: the same plan for a table and for a stream."""

from pyspark.sql import functions as F

from ..functions.records import to_json
from ..operators.classify import classify
from ..operators.contract import check_contract, keep_bad_lines
from ..operators.envelope import to_envelope, to_messages
from ..operators.ledger import LabelLedger
from ..operators.parse import decode_values, parse_records
from ..schema import REVIEW
from ..sources.kafka import stream_topic
from ..sources.lines import read_lines, strip_lines
from ..sources.ranges import stream_ranges
from ..sources.sockets import stream_socket
from ..streaming.audit import audited_delivery, observe_delivery
from ..streaming.isolate import isolating_delivery
from ..streaming.landing import replay_stream
from ..streaming.sinks import KafkaSink, finish_aside, start_batches, start_stream, write_batch
from ..streaming.supervise import supervise

# Topic names.
RAW_TOPIC = "ingest-file"
ENRICHED_TOPIC = "ingested-file"
SOCKET_TOPIC = "customers_review"

DELIVERY = "delivery"


def label_lines(lines, scorer, mode="permissive"):
    """JSON lines to reviews with feedback."""
    return classify(parse_records(lines, mode=mode), scorer)


def enrich_lines(lines, scorer, mode="permissive"):
    """JSON lines to keyed messages with feedback."""
    return to_envelope(label_lines(lines, scorer, mode))


def enrich_messages(rows, scorer, mode="permissive", on_error="replace"):
    """Kafka-shaped rows to keyed messages with feedback."""
    return enrich_lines(decode_values(rows, on_error), scorer, mode)


def enrich_valid(lines, scorer):
    """Keyed messages from the lines that meet the contract, the others with a reason.

    One pass gives ``key, value`` for ``status`` valid and ``line, reason`` for
    quarantine; write it partitioned by ``status``. Quarantined texts are not scored.
    """
    valid = F.col("status") == "valid"
    return _labelled_or_quarantined(lines, scorer).select(
        F.when(valid, F.col("review_id")).alias("key"),
        F.when(valid, to_json([*REVIEW.names, "feedback"])).alias("value"),
        "line", "reason", "status")


def raw_messages(lines):
    """Lines of any content to messages without a key."""
    return to_messages(strip_lines(lines))


def produce_file(spark, path, sink):
    """Send every line of a file to the sink."""
    write_batch(raw_messages(read_lines(spark, path)), sink)


def _reported(lines, scorer, mode="permissive"):
    """As ``enrich_lines``; the query's progress reports the counts per batch under ``DELIVERY``."""
    return to_envelope(observe_delivery(label_lines(lines, scorer, mode), DELIVERY))


def _labelled_or_quarantined(lines, scorer):
    """Lines checked against the contract; only those that meet it are scored."""
    valid = F.col("status") == "valid"
    checked = keep_bad_lines(check_contract(lines)).withColumn("text", F.when(valid, F.col("text")))
    return classify(checked, scorer)


def _start_topic(lines, scorer, sink, name, checkpoint_root, every, mode, audit_dir, quarantine_dir):
    """Lines to a topic; with ``audit_dir`` each batch leaves a report there."""
    if mode == "split":
        if not (audit_dir and quarantine_dir):
            raise ValueError("mode split needs an audit and a quarantine folder")
        rows = _labelled_or_quarantined(lines, scorer)
    elif quarantine_dir:
        raise ValueError("a quarantine folder goes with mode split")
    elif not audit_dir:
        return start_stream(_reported(lines, scorer, mode), sink, name, checkpoint_root, every)
    else:
        rows = label_lines(lines, scorer, mode)
    deliver = audited_delivery(name, sink, audit_dir, quarantine_dir=quarantine_dir)
    return start_batches(rows, deliver, name, checkpoint_root, every)


def run_socket_job(spark, settings, scorer, host, port, checkpoint_root,
                   topic=SOCKET_TOPIC, name="socket-reviews", mode="permissive",
                   audit_dir=None, quarantine_dir=None, **supervision):
    """Socket lines to a topic, restarted after failures.

    ``mode`` keeps unreadable lines as empty messages (``permissive``), drops them, or keeps what
    does not meet the contract in ``quarantine_dir`` (``split``). ``audit_dir`` receives a report
    per batch that outlives restarts; without it the query's progress has the recent ones.
    """
    def start():
        return _start_topic(stream_socket(spark, host, port), scorer, KafkaSink(topic, settings),
                            name, checkpoint_root, None, mode, audit_dir, quarantine_dir)

    return supervise(start, **supervision)


def run_topic_job(spark, settings, scorer, checkpoint_root, source=RAW_TOPIC,
                  target=ENRICHED_TOPIC, name="topic-reviews", limits=None, every=None,
                  mode="permissive", on_error="replace", audit_dir=None, quarantine_dir=None,
                  **supervision):
    """Topic to topic, restarted after failures; options as in ``run_socket_job``.

    ``on_error`` says what becomes of bytes that are not UTF-8 (see ``decode_utf8``).
    """
    def start():
        rows = stream_topic(spark, settings, source, **(limits or {}))
        return _start_topic(decode_values(rows, on_error), scorer, KafkaSink(target, settings),
                            name, checkpoint_root, every, mode, audit_dir, quarantine_dir)

    return supervise(start, **supervision)


def run_files_job(spark, landed_dir, scorer, out_dir, audit_dir, checkpoint_root,
                  name="file-reviews", limits=None, every=None, until_done=False,
                  mode="permissive", quarantine_dir=None, **supervision):
    """Landed lines to a table with a delivery report per batch, restarted after failures."""
    if (mode == "split") != bool(quarantine_dir):
        raise ValueError("mode split and a quarantine folder go together")

    def start():
        lines = replay_stream(spark, landed_dir, **(limits or {}))
        rows = _labelled_or_quarantined(lines, scorer) if mode == "split" else label_lines(lines, scorer, mode)
        deliver = audited_delivery(name, out_dir, audit_dir, quarantine_dir=quarantine_dir)
        return start_batches(rows, deliver, name, checkpoint_root, every, until_done)

    return supervise(start, **supervision)


def run_ranges_job(spark, path, scorer, out_dir, audit_dir, checkpoint_root, bad_dir, name="range-reviews",
                   ledger_dir=None, bytes_per_batch=None, target_s=None, until_done=False, mode="permissive", after=2,
                   **supervision):
    """Line files of any size to a table, byte range by byte range, through failures of every kind.

    Batches admit ``bytes_per_batch``, or what lets each last ``target_s``. Records that make a batch fail ``after`` times
    go to ``bad_dir``. With ``ledger_dir`` a text is asked about once, whatever is repeated; the probes for bad records
    then run one after the other.
    """
    ledger = LabelLedger(spark, ledger_dir) if ledger_dir else None

    def process(batch):
        rows = parse_records(batch, mode=mode)
        return ledger.classify(rows, scorer) if ledger else classify(rows, scorer)

    deliver = audited_delivery(name, out_dir, audit_dir)
    handle = isolating_delivery(process, deliver, bad_dir, after, parallel=1 if ledger else 8)

    def start():
        lines = stream_ranges(spark, path, f"{checkpoint_root.rstrip('/')}/{name}-files", bytes_per_batch, target_s=target_s)
        return start_batches(lines, handle, name, checkpoint_root)

    return supervise(start, on_start=finish_aside if until_done else None, **supervision)
