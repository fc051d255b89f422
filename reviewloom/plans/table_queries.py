"""Registered queries over tables, each with the SQL that states its answer."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..functions.labels import normalise_label
from ..functions.numbers import nan_to_null
from ..functions.records import to_json
from ..functions.text import PROMPT, decode_utf8, encode_utf8, prompt, strip
from ..operators.classify import classify
from ..operators.contract import check_contract, split_contract
from ..operators.envelope import to_envelope
from ..operators.lexicon import LEAST_Z, PRIOR, LexiconScorer, learn_words
from ..operators.model import hash_texts, join_labels, train_model
from ..operators.nested_contract import check_nested, compile_contract
from ..operators.parse import parse_records
from ..operators.remote import RemoteScorer
from ..operators.union import union_records
from ..schema import REVIEW
from ..session import work_dir
from ..sources.lines import read_json_lines
from ..sources.tables import (MINUTES_PER_YEAR, contract_lines, corrupt_lines, gappy_reviews,
                              kafka_rows, nan_lines, review_lines, reviews, table,
                              trailing_lines, wide_lines)
from ..streaming.landing import land
from .enrich import enrich_messages, enrich_valid, raw_messages
from .registry import query

# The test prose is invented, so everyday function words stand in for sentiment.
LEXICON = LexiconScorer(positive=["the", "best", "and"], negative=["of", "to", "in"])

# ---- SQL building blocks -------------------------------------------------

SQL_REVIEWS = f"""reviews AS (
  SELECT doc_id, CAST(doc_id AS VARCHAR) AS review_id, lang AS user_id, source AS business_id,
         CAST(1 + n_chars % 5 AS FLOAT) AS stars,
         strftime(TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST(doc_id % {MINUTES_PER_YEAR} AS INT)),
                  '%Y-%m-%d %H:%M:%S') AS date,
         text
  FROM documents)"""

SQL_GAPPY = f"""{SQL_REVIEWS}, gappy AS (
  SELECT * REPLACE (CASE doc_id % 10 WHEN 1 THEN NULL WHEN 2 THEN '' WHEN 4 THEN '  '
                    ELSE text END AS text)
  FROM reviews)"""

SQL_FIELDS = ", ".join(REVIEW.names)


def sql_json(*columns):
    """The columns as one JSON object, nulls kept."""
    return "CAST(to_json({" + ", ".join(f"'{c}': {c}" for c in columns) + "}) AS VARCHAR)"


SQL_LINE = sql_json(*REVIEW.names)


def sql_hits(words):
    listed = ", ".join(f"'{w}'" for w in sorted(words))
    return ("CAST(len(list_filter(string_split_regex(lower(text), '[^a-z]+'), "
            f"lambda w: w IN ({listed}))) AS INT)")


SQL_LABEL = (f"CASE WHEN {sql_hits(LEXICON.positive)} > {sql_hits(LEXICON.negative)} THEN 'POSITIVE' "
             f"WHEN {sql_hits(LEXICON.positive)} < {sql_hits(LEXICON.negative)} THEN 'NEGATIVE' "
             "ELSE 'NEUTRAL' END")

# The answer of every lossless route from documents to labelled messages.
SQL_FEEDBACK = f"""WITH {SQL_REVIEWS}, labelled AS (SELECT *, {SQL_LABEL} AS feedback FROM reviews)
SELECT review_id AS key, {sql_json(*REVIEW.names, 'feedback')} AS value FROM labelled"""


def sql_read(name):
    """The field as SQL reads it from ``line``, null where the line is not JSON."""
    if name == "stars":  # a number in quotes is no number
        return ("CASE WHEN json_valid(line) AND json_type(line, '$.stars') <> 'VARCHAR' "
                "THEN CAST(json_extract(line, '$.stars') AS FLOAT) END")
    return f"CASE WHEN json_valid(line) THEN json_extract_string(line, '$.{name}') END"


SQL_READ = ", ".join(f"{sql_read(c)} AS {c}" for c in REVIEW.names)

SQL_CORRUPT = f"""{SQL_REVIEWS}, spoilt AS (
  SELECT CASE doc_id % 10 WHEN 3 THEN substr({SQL_LINE}, 1, 20) WHEN 7 THEN '' ELSE {SQL_LINE} END AS line
  FROM reviews)"""

SQL_CONTRACT = f"""{SQL_REVIEWS}, spoilt AS (
  SELECT CASE doc_id % 10
      WHEN 1 THEN {sql_json(*[c for c in REVIEW.names if c != 'text'])}
      WHEN 3 THEN substr({SQL_LINE}, 1, 20)
      WHEN 5 THEN {sql_json(*[c for c in REVIEW.names if c != 'review_id'])}
      WHEN 7 THEN ''
      WHEN 8 THEN regexp_replace({SQL_LINE}, '"stars":([0-9.]+)', '"stars":"\\1"')
      ELSE {SQL_LINE} END AS line
  FROM reviews), fields AS (SELECT line, {SQL_READ} FROM spoilt), checked AS (
  SELECT *, CASE WHEN trim(line) = '' THEN 'blank' WHEN NOT json_valid(line) THEN 'malformed'
      WHEN json_type(line, '$.stars') = 'VARCHAR' THEN 'malformed'
      {' '.join(f"WHEN {c} IS NULL THEN 'missing:{c}'" for c in REVIEW.names)} END AS reason
  FROM fields)"""


# ---- parsing and serialising ---------------------------------------------

@query(f"WITH {SQL_REVIEWS} SELECT {SQL_FIELDS} FROM reviews")
def reviews_view(spark, sf_dir):
    return reviews(spark, sf_dir)


@query(f"WITH {SQL_REVIEWS} SELECT {SQL_FIELDS} FROM reviews")
def json_roundtrip(spark, sf_dir):
    return parse_records(review_lines(reviews(spark, sf_dir)))


@query(f"WITH {SQL_REVIEWS} SELECT review_id AS key, {SQL_LINE} AS value FROM reviews")
def review_envelope(spark, sf_dir):
    return to_envelope(reviews(spark, sf_dir))


@query(f"""WITH {SQL_GAPPY} SELECT review_id AS key,
  CASE WHEN text IS NULL THEN {sql_json(*[c for c in REVIEW.names if c != 'text'])}
       ELSE {SQL_LINE} END AS value FROM gappy""")
def envelope_without_nulls(spark, sf_dir):
    return to_envelope(gappy_reviews(spark, sf_dir))


@query(f"WITH {SQL_GAPPY} SELECT review_id AS key, {SQL_LINE} AS value FROM gappy")
def envelope_with_nulls(spark, sf_dir):
    return to_envelope(gappy_reviews(spark, sf_dir), keep_nulls=True)


@query("""SELECT CAST(event_id AS VARCHAR) AS key,
  CAST(to_json({'event_id': event_id, 'ts': strftime(ts, '%Y-%m-%d %H:%M:%S'), 'user_id': user_id,
                'event_type': event_type, 'value': value, 'props': props}) AS VARCHAR) AS value
FROM events""")
def events_envelope(spark, sf_dir):
    return to_envelope(table(spark, sf_dir, "events"), key="event_id")


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def events_props_parse(spark, sf_dir):
    props = F.from_json("props", "k BIGINT")
    return table(spark, sf_dir, "events").select("event_id", props["k"].alias("k"))


@query("""SELECT event_id, '{"ts":"' || strftime(ts, '%Y-%m-%d %H:%M:%S') || '"}' AS value FROM events""")
def event_time_json(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", to_json(["ts"]).alias("value"))


@query(f"WITH {SQL_REVIEWS} SELECT review_id, CAST(octet_length(encode(text)) AS INT) AS n_bytes, text FROM reviews")
def utf8_bytes(spark, sf_dir):
    raw = reviews(spark, sf_dir).withColumn("raw", encode_utf8(F.col("text")))
    return raw.select("review_id", F.octet_length("raw").alias("n_bytes"),
                      decode_utf8(F.col("raw"), "fail").alias("text"))


@query(f"""WITH {SQL_REVIEWS} SELECT review_id,
  CASE WHEN doc_id % 10 = 6 THEN text || chr(65533) ELSE text END AS replaced,
  CASE WHEN doc_id % 10 <> 6 THEN text END AS nulled FROM reviews""")
def utf8_bad_bytes(spark, sf_dir):
    """6: a stray byte follows the text."""
    raw = encode_utf8(F.col("text"))
    spoilt = F.when(F.col("review_id").cast("bigint") % 10 == 6,
                    F.concat(raw, F.lit(b"\xff"))).otherwise(raw)
    return reviews(spark, sf_dir).withColumn("raw", spoilt).select(
        "review_id", decode_utf8(F.col("raw")).alias("replaced"),
        decode_utf8(F.col("raw"), "null").alias("nulled"))


@query(f"WITH {SQL_CORRUPT} SELECT {SQL_READ} FROM spoilt")
def malformed_permissive(spark, sf_dir):
    return parse_records(corrupt_lines(spark, sf_dir))


@query(f"WITH {SQL_CORRUPT} SELECT {SQL_READ} FROM spoilt WHERE json_valid(line)")
def malformed_drop(spark, sf_dir):
    return parse_records(corrupt_lines(spark, sf_dir), mode="drop")


@query(f"WITH {SQL_REVIEWS} SELECT {SQL_FIELDS} FROM reviews WHERE doc_id % 10 NOT IN (1, 2, 3, 4, 5, 6)")
def malformed_trailing(spark, sf_dir):
    """Lines with anything after their one value are dropped."""
    return parse_records(trailing_lines(spark, sf_dir), mode="drop")


@query(f"""WITH {SQL_REVIEWS} SELECT 'drop' AS mode, {SQL_FIELDS} FROM reviews
  UNION ALL SELECT 'permissive' AS mode, {SQL_FIELDS} FROM reviews""")
def long_numbers(spark, sf_dir):
    """Long numbers and deep nesting leave a line valid."""
    lines = wide_lines(spark, sf_dir)
    parts = [parse_records(lines, mode=mode).select(F.lit(mode).alias("mode"), "*") for mode in ("drop", "permissive")]
    return parts[0].unionByName(parts[1])


@query(f"WITH {SQL_CONTRACT} SELECT {SQL_FIELDS} FROM checked WHERE reason IS NULL")
def contract_valid(spark, sf_dir):
    valid, _ = split_contract(contract_lines(spark, sf_dir))
    return valid


@query(f"""WITH {SQL_CONTRACT} SELECT line, reason,
  CASE WHEN reason IS NULL THEN 'valid' ELSE 'quarantine' END AS status FROM checked""")
def contract_quarantine(spark, sf_dir):
    return check_contract(contract_lines(spark, sf_dir)).select("line", "reason", "status")


@query(f"""WITH {SQL_REVIEWS} SELECT review_id, user_id, business_id,
  CASE WHEN doc_id % 10 <> 2 THEN stars END AS stars, date,
  CASE WHEN doc_id % 10 <> 1 THEN text END AS text FROM reviews""")
def nan_lines_clean(spark, sf_dir):
    return nan_to_null(parse_records(nan_lines(spark, sf_dir)), text_cols=["text"])


@query("""WITH spoilt AS (
  SELECT event_id, CASE WHEN event_id % 10 = 0 THEN CAST('NaN' AS DOUBLE) ELSE value END AS value FROM events)
SELECT event_id, CASE WHEN NOT isnan(value) THEN value END AS value FROM spoilt""")
def nan_clean(spark, sf_dir):
    spoilt = F.when(F.col("event_id") % 10 == 0, float("nan")).otherwise(F.col("value"))
    return nan_to_null(table(spark, sf_dir, "events").select("event_id", spoilt.alias("value")))


@query(f"""WITH {SQL_REVIEWS} SELECT * FROM events
  UNION ALL BY NAME SELECT {SQL_FIELDS} FROM reviews""")
def schema_union(spark, sf_dir):
    return union_records([table(spark, sf_dir, "events"), reviews(spark, sf_dir)])


# ---- lines and messages --------------------------------------------------

@query("SELECT conv_id, turn, trim(text, E' \\t\\r\\n\\f\\x0b') AS text FROM conversations")
def strip_lines(spark, sf_dir):
    padded = F.concat(F.lit("\t \f"), F.col("text"), F.lit(" \r\n\v"))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", strip(padded).alias("text"))


@query(f"WITH {SQL_REVIEWS} SELECT CAST(NULL AS VARCHAR) AS key, {SQL_LINE} AS value FROM reviews")
def ingest_messages(spark, sf_dir):
    """Padded lines to messages without a key, and back as a consumer decodes them."""
    lines = review_lines(reviews(spark, sf_dir))
    padded = lines.select(F.concat(F.lit(" \t"), "value", F.lit("\r\n")).alias("value"))
    return raw_messages(padded).select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))


@query(f"WITH {SQL_CORRUPT} SELECT {SQL_READ} FROM spoilt WHERE json_valid(line)")
def landed_lines(spark, sf_dir):
    """Lines written to files, and read back without the bad ones."""
    folder = work_dir(spark, "landed-lines")
    land(corrupt_lines(spark, sf_dir), folder)
    return parse_records(read_json_lines(spark, folder))


@query("SELECT conv_id, turn, '" + PROMPT.replace("'", "''").replace("%s", "' || text || '")
       + "' AS prompt FROM conversations")
def prompt_text(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", prompt(F.col("text")).alias("prompt"))


# ---- labels --------------------------------------------------------------

@query(f"""SELECT doc_id, {sql_hits(LEXICON.positive)} AS n_positive,
  {sql_hits(LEXICON.negative)} AS n_negative FROM documents""")
def lexicon_counts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return LEXICON.counts(docs).select("doc_id", "n_positive", "n_negative")


@query(SQL_FEEDBACK)
def feedback_lexicon(spark, sf_dir):
    """Flagship: Kafka-shaped rows, decoded, parsed, labelled and enveloped."""
    return enrich_messages(kafka_rows(reviews(spark, sf_dir)), LEXICON)


@query(f"""WITH {SQL_GAPPY} SELECT review_id, text,
  CASE WHEN text IS NULL THEN NULL WHEN text = '' THEN 'Empty' ELSE {SQL_LABEL} END AS feedback
FROM gappy""")
def feedback_guard(spark, sf_dir):
    return classify(gappy_reviews(spark, sf_dir), LEXICON).select("review_id", "text", "feedback")


@query(f"""WITH {SQL_CONTRACT}, labelled AS (SELECT *, {SQL_LABEL} AS feedback FROM checked)
SELECT CASE WHEN reason IS NULL THEN review_id END AS key,
  CASE WHEN reason IS NULL THEN {sql_json(*REVIEW.names, 'feedback')} END AS value,
  CASE WHEN reason IS NOT NULL THEN line END AS line, reason,
  CASE WHEN reason IS NULL THEN 'valid' ELSE 'quarantine' END AS status FROM labelled""")
def feedback_valid(spark, sf_dir):
    """Labelled messages and quarantined lines from one pass."""
    return enrich_valid(contract_lines(spark, sf_dir), LEXICON)


@query("""SELECT event_id, CASE event_type WHEN 'view' THEN 'POSITIVE' WHEN 'click' THEN 'NEGATIVE'
  WHEN 'signup' THEN 'NEUTRAL' WHEN 'purchase' THEN 'UNKNOWN' END AS feedback,
  CASE event_type WHEN 'view' THEN 'UNKNOWN' WHEN 'click' THEN 'C' WHEN 'signup' THEN 'C++'
    WHEN 'purchase' THEN 'Good' END AS own_label,
  CASE event_type WHEN 'view' THEN 'Empty' WHEN 'click' THEN 'UNKNOWN' WHEN 'signup' THEN 'UNKNOWN'
    WHEN 'purchase' THEN 'UNKNOWN' END AS passed FROM events""")
def label_normalise(spark, sf_dir):
    kind = F.col("event_type")
    reply = (F.when(kind == "view", F.concat(F.lit("Positive. Sure about #"), "event_id"))
              .when(kind == "click", "negative")
              .when(kind == "signup", "it is Neutral, not POSITIVE")
              .when(kind == "purchase", "dunno"))
    odd = (F.when(kind == "view", "Empty").when(kind == "click", "grade c").when(kind == "signup", "I like c++!")
            .when(kind == "purchase", "gOOD"))
    return table(spark, sf_dir, "events").select(
        "event_id", normalise_label(reply).alias("feedback"),
        normalise_label(odd, ("Good", "Bad", "C", "C++")).alias("own_label"),
        normalise_label(odd, passed=("Empty",)).alias("passed"))


def rule_client(shift=0):
    """Factory of a plain function in place of a client: the reply follows the prompt's length; with another
    ``shift`` it is another one."""
    replies = ["Positive.", "\nnegative", "It is NEUTRAL, I think", "no idea"]
    return lambda: lambda prompt, timeout: replies[(len(prompt) + shift) % len(replies)]


@query(f"""WITH {SQL_GAPPY} SELECT review_id,
  CASE WHEN text IS NULL THEN NULL WHEN text = '' THEN 'Empty' ELSE
    CASE (length(text) + {len(PROMPT % '')}) % 4 WHEN 0 THEN 'POSITIVE' WHEN 1 THEN 'NEGATIVE'
      WHEN 2 THEN 'NEUTRAL' ELSE 'UNKNOWN' END END AS feedback FROM gappy""")
def feedback_remote_fake(spark, sf_dir):
    labelled = classify(gappy_reviews(spark, sf_dir).select("review_id", "text"),
                        RemoteScorer(rule_client()))
    return labelled.select("review_id", "feedback")


# The training label of a document: toxic ones are bad, clean ones of good quality are good.
MARK = "CASE WHEN toxic = 1 THEN 'NEGATIVE' WHEN quality = 1 THEN 'POSITIVE' ELSE 'NEUTRAL' END"


def _marks(spark, sf_dir):
    return table(spark, sf_dir, "labels").selectExpr("doc_id", f"{MARK} AS label")


@query()
def feedback_model(spark, sf_dir):
    """A model trained on all labelled documents labels all documents."""
    home = work_dir(spark, "model")
    hashed = hash_texts(table(spark, sf_dir, "documents").select("doc_id", "text"), f"{home}/hashed")
    marked = join_labels(hashed, _marks(spark, sf_dir), "doc_id")
    return train_model(marked, f"{home}/training").classify_hashed(hashed)


@query(r"""SELECT doc_id, length(text) AS n_chars,
  CAST(len(list_filter(string_split_regex(lower(text), '[^\p{L}]+'), lambda w: w <> '')) AS BIGINT) AS n_tokens
FROM documents""")
def model_features(spark, sf_dir):
    """What the model sees of a text: the hashed counts add up to the number of its words."""
    home = work_dir(spark, "model-features")
    hashed = hash_texts(table(spark, sf_dir, "documents").select("doc_id", "text"), f"{home}/hashed")
    counts = F.aggregate(vector_to_array("terms"), F.lit(0.0), lambda total, n: total + n)
    return hashed.select("doc_id", F.col("n_chars").cast("bigint").alias("n_chars"),
                         counts.cast("bigint").alias("n_tokens"))


@query(f"""SELECT label, count(*) AS n_rows FROM (SELECT {MARK} AS label FROM documents JOIN labels USING (doc_id))
GROUP BY label""")
def model_training(spark, sf_dir):
    """Training rows by class."""
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return join_labels(docs, _marks(spark, sf_dir), "doc_id").groupBy("label").agg(F.count("*").alias("n_rows"))


@query(f"""SELECT doc_id % 5 = 0 AS held_out, count(*) AS n_rows, TRUE AS beats_majority
FROM documents JOIN labels USING (doc_id) GROUP BY 1""")
def model_quality(spark, sf_dir):
    """Trained on four fifths: is the mean recall of the classes better than that of always naming the commonest?"""
    home = work_dir(spark, "model-quality")
    hashed = hash_texts(table(spark, sf_dir, "documents").select("doc_id", "text"), f"{home}/hashed")
    marked = join_labels(hashed, _marks(spark, sf_dir), "doc_id").withColumn("held_out", F.col("doc_id") % 5 == 0)
    scorer = train_model(marked.where("NOT held_out"), f"{home}/training")
    right = scorer.classify_hashed(marked).groupBy("held_out", "label").agg(
        F.avg((F.col("feedback") == F.col("label")).cast("double")).alias("recall"), F.count("*").alias("n"))
    return right.groupBy("held_out").agg(
        F.sum("n").alias("n_rows"), (F.avg("recall") > 1 / F.count("*")).alias("beats_majority"))


# ---- a lexicon learnt from labels ------------------------------------------

def _sql_z(own, total):
    share = f"({PRIOR} * n_all / t.n)"
    odds = lambda n, words: f"ln(({n} + {share}) / ({words} + {PRIOR} - {n} - {share}))"
    rest, others = f"(n_all - {own})", f"(t.n - {total})"
    return f"({odds(own, total)} - {odds(rest, others)}) / sqrt(1 / ({own} + {share}) + 1 / ({rest} + {share}))"


# Learnt from four fifths of the labelled documents.
SQL_LEARNT = f"""marked AS (SELECT doc_id, text, {MARK} AS label FROM documents JOIN labels USING (doc_id)),
seen AS (SELECT DISTINCT doc_id, label, unnest(string_split_regex(lower(text), '[^a-z]+')) AS word FROM marked WHERE doc_id % 5 <> 0),
counts AS (SELECT word, count(*) AS n_all, count(*) FILTER (label = 'POSITIVE') AS n_positive,
           count(*) FILTER (label = 'NEGATIVE') AS n_negative FROM seen WHERE word <> '' GROUP BY word),
t AS (SELECT CAST(sum(n_all) AS DOUBLE) AS n, CAST(sum(n_positive) AS DOUBLE) AS p, CAST(sum(n_negative) AS DOUBLE) AS m FROM counts),
learnt AS (SELECT word, n_all, n_positive, n_negative, {_sql_z('n_positive', 't.p')} AS z_positive,
           {_sql_z('n_negative', 't.m')} AS z_negative FROM counts, t),
worth AS (SELECT word, (z_positive >= {LEAST_Z})::INT - (z_negative >= {LEAST_Z})::INT AS worth FROM learnt),
hits AS (SELECT doc_id, sum(worth) AS balance FROM (SELECT doc_id, unnest(string_split_regex(lower(text), '[^a-z]+')) AS word FROM documents)
         JOIN worth USING (word) GROUP BY doc_id),
told AS (SELECT doc_id, CASE sign(coalesce(balance, 0)) WHEN 1 THEN 'POSITIVE' WHEN -1 THEN 'NEGATIVE' ELSE 'NEUTRAL' END AS feedback
         FROM documents LEFT JOIN hits USING (doc_id))"""


def _labelled_documents(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "text").join(_marks(spark, sf_dir), "doc_id")


def _learnt_words(spark, sf_dir):
    trained = _labelled_documents(spark, sf_dir).where("doc_id % 5 <> 0")
    return learn_words(trained, work_dir(spark, "lexicon"))


@query(f"""WITH {SQL_LEARNT} SELECT word, n_all, n_positive, n_negative,
  round(z_positive, 6) AS z_positive, round(z_negative, 6) AS z_negative FROM learnt""")
def lexicon_learnt(spark, sf_dir):
    """How telling every word is."""
    return _learnt_words(spark, sf_dir).select(
        "word", "n_all", "n_positive", "n_negative", F.round("z_positive", 6).alias("z_positive"), F.round("z_negative", 6).alias("z_negative"))


@query(f"WITH {SQL_LEARNT} SELECT doc_id, feedback FROM told")
def feedback_learnt(spark, sf_dir):
    """Documents labelled by the words that training found telling."""
    scorer = LexiconScorer.learnt(_learnt_words(spark, sf_dir))
    return classify(table(spark, sf_dir, "documents").select("doc_id", "text"), scorer).select("doc_id", "feedback")


@query(f"""WITH {SQL_LEARNT} SELECT doc_id % 5 = 0 AS held_out, label, feedback, count(*) AS n_rows
FROM marked JOIN told USING (doc_id) GROUP BY ALL""")
def lexicon_quality(spark, sf_dir):
    """How often the learnt lexicon is right, on the rows it was learnt from and on those held out."""
    scorer = LexiconScorer.learnt(_learnt_words(spark, sf_dir))
    told = classify(_labelled_documents(spark, sf_dir), scorer)
    return told.groupBy((F.col("doc_id") % 5 == 0).alias("held_out"), "label", "feedback").agg(F.count("*").alias("n_rows"))


# ---- a nested contract -------------------------------------------------------

NESTED = """{"type": "record", "name": "review", "fields": [
  {"name": "id", "type": "long"},
  {"name": "lang", "type": {"type": "enum", "name": "lang", "symbols": ["de", "en", "es", "fr"]}},
  {"name": "author", "type": {"type": "record", "name": "author", "fields": [
    {"name": "name", "type": "string"}, {"name": "mail", "type": ["null", "string"]}]}},
  {"name": "tags", "type": {"type": "array", "items": {"type": "record", "name": "tag", "fields": [{"name": "name", "type": "string"}]}}},
  {"name": "reply", "type": ["null", "author"]},
  {"name": "currency", "type": "string", "default": "EUR"}
]}"""


@query("""WITH told AS (SELECT doc_id, CASE doc_id % 10 WHEN 1 THEN 'missing:author.name' WHEN 2 THEN 'missing:tags[].name' WHEN 3 THEN 'malformed'
    WHEN 4 THEN 'symbol:lang' WHEN 5 THEN 'missing:reply.name' WHEN 7 THEN 'blank' WHEN 8 THEN 'malformed' END AS reason FROM documents)
SELECT CASE WHEN reason IS NULL THEN doc_id END AS id, CASE WHEN reason IS NULL THEN 'EUR' END AS currency,
  CASE WHEN reason IS NULL THEN 'valid' ELSE 'quarantine' END AS status, reason FROM told""")
def contract_nested(spark, sf_dir):
    """Nested lines with defects. 1: no author's name, 2: a tag without name, 3: cut, 4: no such language, 5: a reply without
    name, 6: no reply, 7: blank, 8: a text for an array."""
    digit = F.pmod("doc_id", F.lit(10))
    named = lambda name: F.struct(name.alias("name"), F.lit(None).cast("string").alias("mail"))
    missing = lambda n, value: F.when(digit != n, value)
    tags = F.array(F.struct(F.lit("a").alias("name")), F.struct(missing(2, F.col("source")).alias("name")))
    lang = F.when(digit == 4, "xx").when(F.col("lang").isin("de", "en", "es", "fr"), F.col("lang")).otherwise("en")
    fields = [F.col("doc_id").alias("id"), lang.alias("lang"), named(missing(1, F.col("source"))).alias("author"),
              F.when(digit != 6, named(missing(5, F.lit("x")))).alias("reply")]
    line = F.when(digit == 8, F.to_json(F.struct(*fields, F.lit("none").alias("tags")))).otherwise(F.to_json(F.struct(*fields, tags.alias("tags"))))
    spoilt = F.when(digit == 3, F.substring(line, 1, 20)).when(digit == 7, " ").otherwise(line)
    lines = table(spark, sf_dir, "documents").select(spoilt.alias("value"))
    valid = F.col("status") == "valid"
    return check_nested(lines, compile_contract(NESTED)).select(
        F.when(valid, F.col("id")).alias("id"), F.when(valid, F.col("currency")).alias("currency"), "status", "reason")
