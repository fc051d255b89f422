"""Options and jobs. No broker or socket is opened here."""

import threading

import pytest
from pyspark.errors import AnalysisException

from reviewloom import __main__ as cli
from reviewloom.operators.remote import RemoteScorer
from reviewloom.plans import enrich, table_queries
from reviewloom.plans.enrich import raw_messages
from reviewloom.plans.table_queries import LEXICON
from reviewloom.schema import KAFKA_ROW
from reviewloom.session import work_dir
from reviewloom.settings import KafkaSettings
from reviewloom.sources.kafka import batch_options, decode_rows, stream_options
from reviewloom.sources.lines import read_json_lines, read_lines, stream_lines
from reviewloom.sources.sockets import stream_socket
from reviewloom.sources.tables import kafka_rows, reviews
from reviewloom.streaming.audit import progress_counts, read_audit, read_deliveries
from reviewloom.streaming.landing import land
from reviewloom.streaming.sinks import FileSink, KafkaSink

SETTINGS = KafkaSettings("broker:9092", username='us"er', password="p\\w", session_timeout_ms=50000)


def test_connection_options():
    assert SETTINGS.options() == {
        "kafka.bootstrap.servers": "broker:9092",
        "kafka.security.protocol": "SASL_SSL",
        "kafka.sasl.mechanism": "PLAIN",
        "kafka.sasl.jaas.config":
            "org.apache.kafka.common.security.plain.PlainLoginModule required "
            'username="us\\"er" password="p\\\\w";',
    }
    assert "p\\w" not in repr(SETTINGS)


@pytest.mark.parametrize("mechanism, module", [
    ("PLAIN", "plain.PlainLoginModule"), ("SCRAM-SHA-256", "scram.ScramLoginModule"), ("SCRAM-SHA-512", "scram.ScramLoginModule")])
def test_login_module_follows_the_mechanism(mechanism, module):
    options = KafkaSettings("h:1", mechanism=mechanism, username="u", password="p").options()
    assert module in options["kafka.sasl.jaas.config"] and options["kafka.sasl.mechanism"] == mechanism


def test_unknown_mechanism_is_refused():
    with pytest.raises(ValueError, match="GSSAPI"):
        KafkaSettings("h:1", mechanism="GSSAPI", username="u", password="p").options()


def test_plaintext_needs_no_secret_and_sasl_does():
    assert KafkaSettings("b:1", security_protocol="PLAINTEXT").options() == {
        "kafka.bootstrap.servers": "b:1", "kafka.security.protocol": "PLAINTEXT"}
    with pytest.raises(ValueError, match="username"):
        KafkaSettings("b:1").options()


def test_settings_from_environment_and_properties():
    env = {"KAFKA_BOOTSTRAP_SERVERS": "broker:9092", "KAFKA_SASL_USERNAME": 'us"er',
           "KAFKA_SASL_PASSWORD": "p\\w", "KAFKA_SESSION_TIMEOUT_MS": "50000"}
    props = {"bootstrap.servers": "broker:9092", "security.protocol": "SASL_SSL",
             "sasl.mechanisms": "PLAIN", "sasl.username": 'us"er', "sasl.password": "p\\w",
             "session.timeout.ms": 50000}
    assert KafkaSettings.from_env(env) == SETTINGS == KafkaSettings.from_properties(props)


def test_source_and_sink_options():
    common = SETTINGS.options()
    timeout = {"kafka.session.timeout.ms": "50000"}
    assert stream_options(SETTINGS, "t") == common | timeout | {"subscribe": "t", "startingOffsets": "latest"}
    assert stream_options(SETTINGS, "t", "earliest", 1000, 64) == common | timeout | {
        "subscribe": "t", "startingOffsets": "earliest", "maxOffsetsPerTrigger": "1000",
        "minPartitions": "64"}
    assert batch_options(SETTINGS, "t", 8, "group-1") == common | timeout | {
        "subscribe": "t", "startingOffsets": "earliest", "endingOffsets": "latest",
        "minPartitions": "8", "kafka.group.id": "group-1"}
    assert KafkaSink("t", SETTINGS).options() == common | {"topic": "t"}


def test_socket_relation(spark):
    lines = stream_socket(spark, "nowhere.invalid", 9999)
    assert lines.isStreaming and lines.columns == ["value"]


def test_line_files(spark, tmp_path):
    (tmp_path / "in.json").write_text('{"a":1}\n\nnope\n[2]\n')
    path = str(tmp_path / "in.json")
    assert [r.value for r in read_lines(spark, path).collect()] == ['{"a":1}', "", "nope", "[2]"]
    assert [r.value for r in read_json_lines(spark, path).collect()] == ['{"a":1}', "[2]"]
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_lines(spark, path + ".gone")


def test_messages_and_back(spark, lines):
    rows = decode_rows(raw_messages(lines(" a\t", "", "é \r")))
    assert [tuple(r) for r in rows.collect()] == [(None, "a"), (None, ""), (None, "é")]


def test_kafka_shaped_rows(spark):
    rows = kafka_rows(reviews(spark, "/root/testdata/sf0.001"))
    assert [(f.name, f.dataType) for f in rows.schema] == [(f.name, f.dataType) for f in KAFKA_ROW]
    assert rows.filter("timestamp IS NULL OR key IS NOT NULL").count() == 0


def test_work_dir_is_fresh_and_under_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    one, two = work_dir(spark, "x"), work_dir(spark, "x")
    assert one != two and one.startswith(shared)


def test_command_line_files_job(spark, tmp_path):
    (tmp_path / "in.json").write_text('{"review_id":"1","text":"good"}\nbad\n')
    for kind, word in (("positive", "good"), ("negative", "bad")):
        (tmp_path / kind).write_text(word + "\n\n")
    at = lambda name: str(tmp_path / name)
    cli.main(["land", "--input", at("in.json"), "--out", at("landed"), "--rows-per-file", "1"])
    cli.main(["enrich-files", "--landed", at("landed"), "--out", at("out"), "--audit", at("audit"),
              "--checkpoint", at("checkpoints"), "--files-per-batch", "1", "--until-done",
              "--scorer", "lexicon", "--positive", at("positive"), "--negative", at("negative")])
    got = sorted((r.key or "", r.value) for r in read_deliveries(spark, at("out")).collect())
    assert got == [("", "{}"), ("1", '{"review_id":"1","text":"good","feedback":"POSITIVE"}')]


def test_command_line_defaults():
    args = cli.parser().parse_args(["enrich-topic", "--checkpoint", "/c"])
    assert (args.source, args.target, args.starting) == ("ingest-file", "ingested-file", "latest")
    assert isinstance(cli._scorer(None, args), RemoteScorer)
    assert cli.parser().parse_args(["enrich-socket", "--host", "h", "--checkpoint", "/c"]).port == 9999


@pytest.mark.parametrize("extra", [
    ["--scorer", "lexicon"], ["--scorer", "lexicon", "--positive", "p"], ["--scorer", "model"],
    ["--mode", "split", "--audit", "a"], ["--mode", "split", "--quarantine", "q"], ["--quarantine", "q"]])
def test_command_line_refuses_early(extra):
    with pytest.raises(SystemExit):
        cli.main(["enrich-topic", "--checkpoint", "/c", *extra])


def test_consume_shows_or_writes(spark, tmp_path, monkeypatch, capsys):
    rows = spark.range(30).selectExpr("'k' AS key", "CAST(id AS STRING) AS value")
    monkeypatch.setattr(cli, "read_topic", lambda spark, settings, topic: rows)
    monkeypatch.setenv("KAFKA_BOOTSTRAP_SERVERS", "h:1")
    cli.main(["consume", "--out", str(tmp_path / "all")])
    assert spark.read.parquet(str(tmp_path / "all")).count() == 30
    cli.main(["consume", "--rows", "5"])
    assert "first 5 rows" in capsys.readouterr().out


# ---- job wiring, with files in place of the broker ----------------------

@pytest.fixture
def files_for_kafka(spark, monkeypatch):
    """Lets the jobs read Kafka-shaped rows from, and write messages to, a folder."""
    home = work_dir(spark, "jobs")
    kafka_rows(reviews(spark, "/root/testdata/sf0.001")).write.parquet(f"{home}/topic")

    def topic(spark, settings, name, **limits):
        assert (settings, name, limits) == (SETTINGS, "ingest-file", {"max_offsets": 5})
        return spark.readStream.schema(KAFKA_ROW).parquet(f"{home}/topic")

    def sink(name, settings):
        assert settings is SETTINGS
        return FileSink(f"{home}/{name}")

    monkeypatch.setattr(enrich, "stream_topic", topic)
    monkeypatch.setattr(enrich, "stream_socket", lambda spark, host, port: stream_lines(spark, f"{home}/lines"))
    monkeypatch.setattr(enrich, "KafkaSink", sink)
    return home


def _until_done(query):
    threading.Thread(target=lambda: (query.processAllAvailable(), query.stop())).start()


def test_topic_job(spark, files_for_kafka):
    outcome = enrich.run_topic_job(spark, SETTINGS, LEXICON, f"{files_for_kafka}/checkpoints",
                                   limits={"max_offsets": 5}, on_start=_until_done)
    counts = progress_counts(outcome.query, enrich.DELIVERY).values()
    assert sum(c["n_rows"] for c in counts) == 200 and sum(c["null_keys"] for c in counts) == 0
    got = spark.read.parquet(f"{files_for_kafka}/ingested-file")
    want = table_queries.feedback_lexicon(spark, "/root/testdata/sf0.001")
    assert got.schema == want.schema
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0


def test_topic_job_keeps_a_report_per_batch(spark, files_for_kafka, monkeypatch):
    """120 batches of one file and a restart: every batch is in the table."""
    home = files_for_kafka
    kafka_rows(reviews(spark, "/root/testdata/sf0.001")).repartition(120).write.parquet(f"{home}/many")
    monkeypatch.setattr(enrich, "stream_topic", lambda spark, settings, name, **limits: (
        spark.readStream.schema(KAFKA_ROW).option("maxFilesPerTrigger", 1).parquet(f"{home}/many")))
    deliver, failed = enrich.audited_delivery, []

    def failing_once(*args, **kwargs):
        handle = deliver(*args, **kwargs)

        def batch(df, batch_id):
            if batch_id == 60 and not failed:
                failed.append(batch_id)
                raise OSError("lost")
            handle(df, batch_id)
        return batch

    monkeypatch.setattr(enrich, "audited_delivery", failing_once)
    files = len(spark.read.parquet(f"{home}/many").inputFiles())
    outcome = enrich.run_topic_job(spark, SETTINGS, LEXICON, f"{home}/checkpoints", audit_dir=f"{home}/audit",
                                   on_start=_until_done, sleep=lambda s: None)
    report = read_audit(spark, f"{home}/audit").collect()
    assert outcome.restarts == 1 and failed == [60]
    assert sorted(r.batch_id for r in report) == list(range(files)) and files > 100
    assert sum(r.n_rows for r in report) == spark.read.parquet(f"{home}/ingested-file").count() == 200


def test_topic_job_quarantines(spark, files_for_kafka):
    home = files_for_kafka
    enrich.run_topic_job(spark, SETTINGS, LEXICON, f"{home}/checkpoints", limits={"max_offsets": 5}, mode="split",
                         audit_dir=f"{home}/audit", quarantine_dir=f"{home}/bad", on_start=_until_done)
    assert spark.read.parquet(f"{home}/ingested-file").count() == 200
    assert spark.read.schema("line string, reason string").parquet(f"{home}/bad").count() == 0
    for wrong in ({"mode": "split"}, {"quarantine_dir": "q"}):
        with pytest.raises(ValueError):
            enrich.run_topic_job(spark, SETTINGS, LEXICON, "c", limits={"max_offsets": 5}, **wrong)


def test_socket_job(spark, files_for_kafka, lines):
    land(lines('{"review_id":"1","text":"the"}', "junk"), f"{files_for_kafka}/lines")
    enrich.run_socket_job(spark, SETTINGS, LEXICON, "host", 9999,
                          f"{files_for_kafka}/checkpoints", on_start=_until_done)
    got = spark.read.parquet(f"{files_for_kafka}/customers_review").collect()
    assert sorted((r.key or "", r.value) for r in got) == [
        ("", "{}"), ("1", '{"review_id":"1","text":"the","feedback":"POSITIVE"}')]


def test_produce_file(spark, tmp_path):
    (tmp_path / "in.json").write_text(' {"a":1}\t\n\nnope\n')
    enrich.produce_file(spark, str(tmp_path / "in.json"), FileSink(str(tmp_path / "topic")))
    got = decode_rows(spark.read.parquet(str(tmp_path / "topic"))).collect()
    assert sorted(tuple(r)[1] for r in got) == ["", "nope", '{"a":1}'] and {r.key for r in got} == {None}
