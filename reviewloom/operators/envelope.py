"""Records to keyed messages."""

from pyspark.sql import functions as F

from ..functions.records import field, to_json
from ..functions.text import encode_utf8


def to_envelope(df, key="review_id", value_cols=None, keep_nulls=False):
    """``key`` as text, and all columns (or ``value_cols``) as a JSON ``value``.

    Null fields are left out of the JSON unless ``keep_nulls``.
    """
    return df.select(
        field(key).cast("string").alias("key"),
        to_json(value_cols or df.columns, keep_nulls).alias("value"))


def to_messages(lines):
    """Raw lines as messages without a key."""
    return lines.select(
        F.lit(None).cast("binary").alias("key"), encode_utf8(lines["value"]).alias("value"))
