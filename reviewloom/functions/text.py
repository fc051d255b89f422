"""String and binary column functions."""

from pyspark.sql import functions as F

# Every character Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

PROMPT = (
    "Decide how the customer review below feels about the business. "
    "Answer with exactly one of these words and nothing more: "
    "POSITIVE, NEGATIVE, NEUTRAL.\n\nReview:\n%s"
)


def decode_utf8(col, on_error="replace"):
    """Binary to string. One bad byte must not stop a stream, so the default
    puts U+FFFD in its place; ``null`` drops the value, ``fail`` raises."""
    if on_error == "fail":
        return F.decode(col, "UTF-8")
    if on_error == "null":
        return F.try_validate_utf8(col.cast("string"))
    if on_error == "replace":
        return F.make_valid_utf8(col.cast("string"))
    raise ValueError(f"on_error must be replace, null or fail, not {on_error!r}")


def encode_utf8(col):
    return F.encode(col, "UTF-8")


def strip(col):
    """Strip like Python. The set is a column literal: SQL text would read \\f as f."""
    return F.btrim(col, F.lit(WHITESPACE))


def prompt(col, template=PROMPT):
    """Put the text into the instruction. The template holds one ``%s``; the
    text itself may hold any ``%`` or braces."""
    return F.format_string(template, col)
