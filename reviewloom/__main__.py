"""Run the jobs: ``python -m reviewloom <job> --help``, or through spark-submit.

Kafka connection settings come from KAFKA_BOOTSTRAP_SERVERS, KAFKA_SASL_USERNAME,
KAFKA_SASL_PASSWORD and the other variables named in ``settings.py``.
"""

import argparse

from .operators.lexicon import LexiconScorer
from .operators.model import ModelScorer
from .operators.remote import RemoteScorer, chat_client
from .plans import enrich
from .session import open_session
from .settings import KafkaSettings
from .sources.kafka import read_topic
from .sources.lines import read_lines
from .streaming.landing import MAX_ROWS_PER_FILE, land_lines
from .streaming.sinks import ConsoleSink, KafkaSink, write_batch


REMOTE_MODEL = "gpt-4o"
MAX_WORDS = 100_000  # a word list travels in the plan
# Bounds of one batch: they delay rows, never drop them, and limit what a failure repeats.
FILES_PER_BATCH = 10_000
MAX_OFFSETS = 10_000_000


def _words(spark, path):
    """A word list from any storage Spark reads, one word per line."""
    words = [w for r in read_lines(spark, path).limit(MAX_WORDS + 1).collect() if (w := r.value.strip())]
    if len(words) > MAX_WORDS:
        raise ValueError(f"{path} has more than {MAX_WORDS} words")
    return words


def _scorer(spark, args):
    if args.scorer == "lexicon":
        return LexiconScorer(_words(spark, args.positive), _words(spark, args.negative))
    if args.scorer == "model":
        return ModelScorer.load(args.model)
    return RemoteScorer(chat_client(args.model or REMOTE_MODEL), partitions=args.partitions,
                        max_in_flight=args.max_in_flight)


def _check(top, args):
    """Refuse what could only fail later."""
    if getattr(args, "scorer", None) == "lexicon" and not (args.positive and args.negative):
        top.error("--scorer lexicon needs --positive and --negative")
    if getattr(args, "scorer", None) == "model" and not args.model:
        top.error("--scorer model needs --model, the folder of a saved model")
    if args.job == "enrich-ranges" and args.mode == "split":
        top.error("enrich-ranges has no --mode split")
    if getattr(args, "mode", None) == "split" and not (args.quarantine and args.audit):
        top.error("--mode split needs --quarantine and --audit")
    if getattr(args, "quarantine", None) and args.mode != "split":
        top.error("--quarantine goes with --mode split")


def _add_scorer(parser):
    parser.add_argument("--scorer", choices=["remote", "lexicon", "model"], default="remote")
    parser.add_argument("--model", help=f"remote model name ({REMOTE_MODEL}), or folder of a saved model")
    parser.add_argument("--positive", help="file of positive words, one per line")
    parser.add_argument("--negative", help="file of negative words, one per line")
    parser.add_argument("--partitions", type=int, help="spread remote calls over this many tasks")
    parser.add_argument("--max-in-flight", type=int, help="remote calls under way in the whole job, at most")
    parser.add_argument("--checkpoint", required=True, help="checkpoint folder shared by the cluster")
    parser.add_argument("--backoff", type=float, default=10, help="seconds before the first restart")
    parser.add_argument("--max-backoff", type=float, default=300, help="seconds between restarts at most")
    parser.add_argument("--max-stuck", type=int, default=3, help="give up when one batch failed so often alike")
    parser.add_argument("--max-restarts", type=int, help="give up after so many restarts")
    parser.add_argument("--mode", choices=["permissive", "drop", "split"], default="permissive",
                        help="keep unreadable lines as empty messages, drop them, or quarantine what breaks the contract")
    parser.add_argument("--quarantine", help="folder for the lines that --mode split keeps apart")


def parser():
    top = argparse.ArgumentParser(prog="reviewloom", description=__doc__)
    jobs = top.add_subparsers(dest="job", required=True)

    job = jobs.add_parser("land", help="cut a line file into files a stream can replay")
    job.add_argument("--input", required=True)
    job.add_argument("--out", required=True)
    job.add_argument("--rows-per-file", type=int, default=MAX_ROWS_PER_FILE)
    job.add_argument("--on-bad", choices=["keep", "drop"], default="keep")

    job = jobs.add_parser("produce", help="send the lines of a file to a topic")
    job.add_argument("--input", required=True)
    job.add_argument("--topic", default=enrich.RAW_TOPIC)

    job = jobs.add_parser("consume", help="show the first rows of a topic, or write all it holds to a folder")
    job.add_argument("--topic", default=enrich.RAW_TOPIC)
    job.add_argument("--rows", type=int, default=20, help="rows to show")
    job.add_argument("--out", help="folder for everything the topic holds, as Parquet")

    job = jobs.add_parser("enrich-socket", help="socket lines to a topic")
    job.add_argument("--host", required=True)
    job.add_argument("--port", type=int, default=9999)
    job.add_argument("--topic", default=enrich.SOCKET_TOPIC)
    job.add_argument("--audit", help="folder for a report per batch")
    _add_scorer(job)

    job = jobs.add_parser("enrich-topic", help="topic to topic")
    job.add_argument("--source", default=enrich.RAW_TOPIC)
    job.add_argument("--target", default=enrich.ENRICHED_TOPIC)
    job.add_argument("--starting", default="latest")
    job.add_argument("--max-offsets", type=int, default=MAX_OFFSETS, help="offsets of a batch at most; 0 for no bound")
    job.add_argument("--on-error", choices=["replace", "null", "fail"], default="replace",
                     help="what becomes of bytes that are not UTF-8")
    job.add_argument("--audit", help="folder for a report per batch")
    _add_scorer(job)

    job = jobs.add_parser("enrich-files", help="landed files to a table")
    job.add_argument("--landed", required=True)
    job.add_argument("--out", required=True)
    job.add_argument("--audit", required=True)
    job.add_argument("--files-per-batch", type=int, default=FILES_PER_BATCH, help="files of a batch at most; 0 for no bound")
    job.add_argument("--archive", help="folder to which finished files are moved")
    job.add_argument("--every", help='pace of the batches, such as "10 seconds"')
    job.add_argument("--until-done", action="store_true", help="handle what is there and stop")
    _add_scorer(job)
    job = jobs.add_parser("enrich-ranges", help="line files of any size to a table, by byte ranges")
    job.add_argument("--input", required=True, help="file or folder of lines")
    job.add_argument("--out", required=True)
    job.add_argument("--audit", required=True)
    job.add_argument("--bad", required=True, help="folder for records that make their batch fail")
    job.add_argument("--ledger", help="folder of the labels of all texts asked about: none is asked about twice")
    job.add_argument("--bytes-per-batch", type=int, help="bytes of a batch, or of the first one with --target-seconds")
    job.add_argument("--target-seconds", type=float, help="how long a batch should last")
    job.add_argument("--until-done", action="store_true", help="handle what is there and stop")
    _add_scorer(job)
    return top


def main(argv=None):
    top = parser()
    args = top.parse_args(argv)
    _check(top, args)
    spark = open_session(f"reviewloom-{args.job}")
    if args.job == "land":
        land_lines(spark, args.input, args.out, args.rows_per_file, on_bad=args.on_bad)
    elif args.job == "produce":
        enrich.produce_file(spark, args.input, KafkaSink(args.topic, KafkaSettings.from_env()))
    elif args.job == "consume":
        rows = read_topic(spark, KafkaSettings.from_env(), args.topic)
        if args.out:
            rows.write.parquet(args.out)
        else:
            print(f"the first {args.rows} rows; --out writes all of them")
            write_batch(rows, ConsoleSink(rows=args.rows))
    else:
        enrich_job(spark, args)


def enrich_job(spark, args):
    scorer = _scorer(spark, args)
    options = {"mode": args.mode, "quarantine_dir": args.quarantine, "backoff_s": args.backoff,
               "max_backoff_s": args.max_backoff, "max_stuck": args.max_stuck, "max_restarts": args.max_restarts}
    if args.job == "enrich-socket":
        enrich.run_socket_job(spark, KafkaSettings.from_env(), scorer, args.host, args.port,
                              args.checkpoint, args.topic, audit_dir=args.audit, **options)
    elif args.job == "enrich-topic":
        enrich.run_topic_job(spark, KafkaSettings.from_env(), scorer, args.checkpoint,
                             args.source, args.target, on_error=args.on_error, audit_dir=args.audit,
                             limits={"starting": args.starting, "max_offsets": args.max_offsets}, **options)
    elif args.job == "enrich-ranges":
        del options["quarantine_dir"]
        enrich.run_ranges_job(spark, args.input, scorer, args.out, args.audit, args.checkpoint, args.bad, ledger_dir=args.ledger,
                              bytes_per_batch=args.bytes_per_batch, target_s=args.target_seconds, until_done=args.until_done, **options)
    else:
        limits = {"files_per_trigger": args.files_per_batch, "archive_dir": args.archive}
        enrich.run_files_job(spark, args.landed, scorer, args.out, args.audit, args.checkpoint,
                             limits=limits, every=args.every, until_done=args.until_done, **options)


if __name__ == "__main__":
    main()
