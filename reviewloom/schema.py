"""Record shapes shared by every source, operator and sink."""

from pyspark.sql import types as T

# The six review fields, in wire order.
REVIEW = T.StructType([
    T.StructField("review_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("business_id", T.StringType()),
    T.StructField("stars", T.FloatType()),
    T.StructField("date", T.StringType()),
    T.StructField("text", T.StringType()),
])

# The record contract lists all six fields as non-optional.
REQUIRED = tuple(REVIEW.names)

# Feedback labels.
LABELS = ("POSITIVE", "NEGATIVE", "NEUTRAL")
EMPTY = "Empty"      # a review whose text is ""
UNKNOWN = "UNKNOWN"  # a reply that names none of the labels

ENVELOPE = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
])

# A raw message, before decoding.
MESSAGE = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
])

# What the public Kafka source hands out.
KAFKA_ROW = T.StructType(MESSAGE.fields + [
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("timestampType", T.IntegerType()),
])
