"""JSON column functions."""

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import WHITESPACE

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
CORRUPT = "_corrupt_record"

# Without the first three, Spark takes long texts, long numbers and deep nesting for corrupt.
PARSE_OPTIONS = {
    "maxStringLen": str(2**31 - 1),
    "maxNumLen": str(2**31 - 1),
    "maxNestingDepth": str(2**31 - 1),
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": CORRUPT,
}


def field(name):
    """Column reference that survives dots in the name."""
    return F.col(f"`{name}`")


def from_json(col, schema, **options):
    """The fields of ``schema``; a field ``CORRUPT`` receives an unreadable line."""
    return F.from_json(col, schema, PARSE_OPTIONS | options)


def is_blank(col):
    """Null, empty or only white space. Trims the left end only: that is enough to
    tell, and the right end would cost a walk over the whole line."""
    return F.coalesce(F.ltrim(col, F.lit(WHITESPACE)) == "", F.lit(True))


# Names that no line can hold, drawn per process.
_LIST, _MARK = (f"_{uuid.uuid4().hex}" for _ in range(2))


def read_value(col, fields=()):
    """Read a line as one JSON value; ``line_of`` gives the ``fields``, ``is_whole`` tells if it is one.

    Spark stops reading after the first value. So the line is read as the first of
    a list of two, under a name drawn at random; the second, drawn as well, must come right after
    it. Without ``fields`` a value of any kind will do.
    """
    if fields:
        element = T.StructType([*fields, T.StructField(_MARK, T.StringType())])
        mark = f'{{"{_MARK}":"{_MARK}"}}'
    else:
        element, mark = T.StringType(), f'"{_MARK}"'
    pair = F.concat(F.lit(f'{{"{_LIST}":['), col, F.lit(f",{mark}]}}"))
    schema = T.StructType([T.StructField(_LIST, T.ArrayType(element)), T.StructField(CORRUPT, T.StringType())])
    return from_json(pair, schema, allowSingleQuotes="false")


def line_of(read):
    """The line's fields, null if it is not an object."""
    return F.get(read[_LIST], F.lit(0))


def is_whole(read, fields=()):
    mark = F.get(read[_LIST], F.lit(1))
    return F.coalesce(read[CORRUPT].isNull() & (F.size(read[_LIST]) == 2)
                      & ((mark[_MARK] if fields else mark) == _MARK), F.lit(False))


def is_json(col):
    """True where the line is one JSON value of any kind, false otherwise (null and
    blank included). NaN, repeated names, texts and numbers of any length and any nesting are accepted."""
    return ~is_blank(col) & is_whole(read_value(col))


def to_json(columns, keep_nulls=False, time_format=TIME_FORMAT):
    """The named columns as one JSON object, in the order given.

    Timestamps of both kinds are cut to seconds; ``timestampFormat`` alone
    would leave TIMESTAMP_NTZ untouched.
    """
    return F.to_json(F.struct(*[field(c) for c in columns]), {
        "ignoreNullFields": str(not keep_nulls).lower(),
        "timestampFormat": time_format,
        "timestampNTZFormat": time_format,
    })
