"""Lines or messages to review columns."""

from pyspark.sql import functions as F

from ..functions.records import from_json, is_blank, is_json, is_whole, line_of, read_value
from ..functions.text import decode_utf8
from ..schema import REVIEW


def decode_values(rows, on_error="replace"):
    """Kafka-shaped rows to lines; key, offset and timestamp are not used."""
    return rows.select(decode_utf8(rows["value"], on_error).alias("value"))


def parse_records(lines, schema=REVIEW, mode="permissive"):
    """JSON lines to the columns of ``schema``.

    ``permissive`` keeps every row: an unreadable line becomes a row of nulls,
    an unreadable field a null. ``drop`` removes the lines that are not JSON.
    Unknown fields are ignored and names are case-sensitive. To keep bad lines
    apart with a reason, use ``contract.check_contract``.
    """
    line = F.col("value")
    if mode == "permissive":
        return lines.select(from_json(line, schema).alias("data")).select("data.*")
    if mode != "drop":
        raise ValueError(f"mode must be permissive or drop, not {mode!r}")
    read = F.col("read")
    # A line that fits the schema is JSON; only the others need a second look.
    keep = ~is_blank(line) & (is_whole(read, schema.fields) | is_json(line))
    fields = F.struct(*[line_of(read)[n].alias(n) for n in schema.names])
    # Not filter(): Spark would push it below the parse and parse every line twice.
    return (lines.select("value", read_value(line, schema.fields).alias("read"))
            .select(F.inline(F.when(keep, F.array(fields)))))
