"""Separate records that meet the contract from those that do not."""

from pyspark.sql import functions as F

from ..functions.records import is_blank, is_whole, line_of, read_value
from ..schema import REQUIRED, REVIEW


def check_contract(lines, schema=REVIEW, required=REQUIRED):
    """Parse once and say for each line whether it meets the contract.

    Adds to the fields of ``schema``: ``line`` (the input), ``status`` (``valid``
    or ``quarantine``) and ``reason`` (null, ``blank``, ``malformed`` or
    ``missing:<first missing field>``). A line that holds more than one value is malformed, and so is
    a text where a number is asked for. A string field takes any value, as its JSON
    text, and a number may be NaN or beyond range (infinite).
    """
    return _judge(lines, schema, required).select(
        "data.*", "line",
        F.when(F.col("reason").isNull(), "valid").otherwise("quarantine").alias("status"),
        "reason")


def split_contract(lines, schema=REVIEW, required=REQUIRED):
    """(valid records, quarantined lines with their reason).

    Both come from one plan, so writing both reads the input twice; to write
    them in one pass use ``write_split``.
    """
    judged = _judge(lines, schema, required)
    # Not filter(): Spark would push it below the parse and parse every line twice.
    valid = F.when(F.col("reason").isNull(), F.array("data"))
    bad = F.when(F.col("reason").isNotNull(), F.array(F.struct("line", "reason")))
    return judged.select(F.inline(valid)), judged.select(F.inline(bad))


def _judge(lines, schema, required):
    """The columns ``line``, ``data`` (the fields of ``schema``) and ``reason``."""
    read = F.col("read")
    malformed = ~is_whole(read, schema.fields) | line_of(read).isNull()
    reason = F.when(is_blank(F.col("line")), "blank").when(malformed, "malformed")
    for name in required:
        reason = reason.when(line_of(read)[name].isNull(), f"missing:{name}")
    fields = F.struct(*[line_of(read)[n].alias(n) for n in schema.names])
    return (lines.select(F.col("value").alias("line"),
                         read_value(F.col("value"), schema.fields).alias("read"))
            .select("line", fields.alias("data"), reason.alias("reason")))


def keep_bad_lines(checked):
    """Drop the raw line of valid records, whose fields say it all."""
    return checked.withColumn("line", F.when(F.col("status") == "quarantine", F.col("line")))


def write_split(checked, path, mode="errorifexists"):
    """One pass, two folders: ``status=valid`` and ``status=quarantine``."""
    keep_bad_lines(checked).write.mode(mode).partitionBy("status").parquet(path)
