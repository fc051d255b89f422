"""Review-shaped inputs derived from the driver's tables.

Defects are placed by the last digit of ``doc_id``, so plain SQL can say what
every operator must answer.
"""

from pyspark.sql import functions as F

from ..functions.records import to_json
from ..functions.text import encode_utf8
from ..schema import REVIEW

MINUTES_PER_YEAR = 525_600


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _last_digit(review_id="review_id"):
    return F.pmod(F.col(review_id).cast("bigint"), F.lit(10))


def reviews(spark, sf_dir):
    """The documents as reviews."""
    minute = f"make_dt_interval(0, 0, CAST(pmod(doc_id, {MINUTES_PER_YEAR}) AS INT), 0)"
    return table(spark, sf_dir, "documents").selectExpr(
        "CAST(doc_id AS STRING) AS review_id",
        "lang AS user_id",
        "source AS business_id",
        "CAST(1 + n_chars % 5 AS FLOAT) AS stars",
        f"CAST(TIMESTAMP_NTZ'2024-01-01 00:00:00' + {minute} AS STRING) AS date",
        "text")


def review_lines(df):
    return df.select(to_json(df.columns).alias("value"))


def gappy_reviews(spark, sf_dir):
    """1: text null, 2: text empty, 4: text two spaces."""
    digit = _last_digit()
    return reviews(spark, sf_dir).withColumn(
        "text", F.when(digit == 1, F.lit(None)).when(digit == 2, "").when(digit == 4, "  ")
                 .otherwise(F.col("text")))


def corrupt_lines(spark, sf_dir):
    """3: the line is cut after 20 characters, 7: the line is empty."""
    digit, line = _last_digit(), to_json(REVIEW.names)
    return reviews(spark, sf_dir).select(
        F.when(digit == 3, F.substring(line, 1, 20)).when(digit == 7, "").otherwise(line)
         .alias("value"))


def trailing_lines(spark, sf_dir):
    """Lines that hold more than one JSON value. 1: a further member, 2: an end and trash, 3: a second
    record as a member, 4: a second record, 5: an end of a list and a new one; 6: a bracket too many."""
    digit, line = _last_digit(), to_json(REVIEW.names)
    return reviews(spark, sf_dir).select(
        F.when(digit == 1, F.concat(line, F.lit(',"x":1')))
         .when(digit == 2, F.concat(line, F.lit(',"end":true}trash')))
         .when(digit == 3, F.concat(line, F.lit(',"line":'), line))
         .when(digit == 4, F.concat(line, F.lit(","), line))
         .when(digit == 5, F.concat(line, F.lit('],"line":['), line))
         .when(digit == 6, F.concat(line, F.lit("]")))
         .otherwise(line).alias("value"))


def wide_lines(spark, sf_dir):
    """Valid lines with an extra member. 1: a number of 1,500 digits, 2: a list nested 1,200 deep."""
    digit, line = _last_digit(), to_json(REVIEW.names)
    head = F.rtrim(line, F.lit("}"))
    return reviews(spark, sf_dir).select(
        F.when(digit == 1, F.concat(head, F.lit(',"x":' + "7" * 1500 + "}")))
         .when(digit == 2, F.concat(head, F.lit(',"x":' + "[" * 1200 + "]" * 1200 + "}")))
         .otherwise(line).alias("value"))


def contract_lines(spark, sf_dir):
    """As ``corrupt_lines``, and 1: no text, 5: no review_id, 8: stars in quotes."""
    digit, line = _last_digit(), to_json(REVIEW.names)
    return reviews(spark, sf_dir).select(
        F.when(digit == 3, F.substring(line, 1, 20)).when(digit == 7, "")
         .when(digit == 1, to_json([c for c in REVIEW.names if c != "text"]))
         .when(digit == 5, to_json([c for c in REVIEW.names if c != "review_id"]))
         .when(digit == 8, F.regexp_replace(line, r'"stars":([0-9.]+)', r'"stars":"$1"'))
         .otherwise(line).alias("value"))


def nan_lines(spark, sf_dir):
    """1: the text is a bare NaN, 2: the stars are."""
    digit, line = _last_digit(), to_json(REVIEW.names)
    head = to_json([c for c in REVIEW.names if c != "text"])
    return reviews(spark, sf_dir).select(
        F.when(digit == 1, F.concat(F.rtrim(head, F.lit("}")), F.lit(',"text":NaN}')))
         .when(digit == 2, F.regexp_replace(line, r'"stars":[0-9.]+', '"stars":NaN'))
         .otherwise(line).alias("value"))


def kafka_rows(df, topic="ingest-file"):
    """Reviews as the rows a Kafka source hands out."""
    return df.select(
        F.lit(None).cast("binary").alias("key"),
        encode_utf8(to_json(df.columns)).alias("value"),
        F.lit(topic).alias("topic"),
        F.lit(0).alias("partition"),
        F.col("review_id").cast("bigint").alias("offset"),
        F.col("date").cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"))
