"""Records with different fields as one table."""

from functools import reduce

from pyspark.sql import types as T

from ..functions.records import PARSE_OPTIONS, field


def union_records(frames):
    """All rows of all frames over the union of their columns; absent means null.

    Numbers widen. A column that is text in one frame becomes text in all, as it
    would when the records were read from one JSON file.
    """
    text = {f.name for df in frames for f in df.schema if isinstance(f.dataType, T.StringType)}

    def as_text(df):
        clash = [f.name for f in df.schema
                 if f.name in text and not isinstance(f.dataType, T.StringType)]
        return df.withColumns({c: field(c).cast("string") for c in clash}) if clash else df

    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), map(as_text, frames))


def read_records(spark, path, schema=None):
    """JSON-lines files over the union of all keys found.

    Without ``schema`` Spark reads the input once more to find the keys and to
    widen numbers; declare it for large inputs, and always for streams.
    """
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.options(**PARSE_OPTIONS).json(path)
