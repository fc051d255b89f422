"""A stream of JSON lines whose fields nobody declared.

Every batch is written once, as variant values, and while the rows pass an aggregate merges the types of their fields, first in the
tasks and then in a tree: so the fields are known without a second scan. A batch that brings a new field, or a value that
the known type cannot hold, widens the schema by a version of its own. Reading applies the last version to all
batches, old and new; a field that a line does not have is null.

Types only ever grow, in this order: nothing, then boolean, text, whole number or number, struct or array of these; a whole
number becomes a number, and whatever else meets becomes text, a struct or an array as its JSON.
"""

import json
import re
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

_VOID, _TEXT, _WHOLE, _NUMBER = T.NullType(), T.StringType(), T.LongType(), T.DoubleType()
_VERSION = "fields string, batch_id bigint"


# ---- the lattice ----

def plain(kind):
    """A type that Spark found, as one of the lattice."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, plain(f.dataType)) for f in kind])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(plain(kind.elementType))
    if isinstance(kind, (T.IntegralType,)):
        return _WHOLE
    if isinstance(kind, (T.DecimalType, T.FractionalType)):
        return _NUMBER
    if isinstance(kind, (T.NullType, T.BooleanType)):
        return kind
    return _TEXT


def join(a, b):
    """The least type that holds the values of both. Fields keep the order in which they came."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        new = {f.name: f.dataType for f in b}
        fields = [T.StructField(f.name, join(f.dataType, new.pop(f.name, _VOID))) for f in a]
        return T.StructType(fields + [T.StructField(n, k) for n, k in new.items()])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(join(a.elementType, b.elementType))
    return _NUMBER if {type(a), type(b)} == {T.LongType, T.DoubleType} else _TEXT


def found_type(ddl):
    """The struct that ``schema_of_variant_agg`` names, empty if it found no object."""
    # Names stand in backticks where they are more than a word.
    parts = re.split(r"(`(?:[^`]|``)*`)", ddl or "")
    kind = T.DataType.fromDDL("".join(p if p.startswith("`") else re.sub(r"\bOBJECT<", "STRUCT<", p) for p in parts)) if ddl else _VOID
    return plain(kind) if isinstance(kind, T.StructType) else T.StructType([])


def readable(kind):
    """The type that values are read as: a field that was null everywhere is text."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, readable(f.dataType)) for f in kind]) if len(kind) else _TEXT
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(readable(kind.elementType))
    return _TEXT if isinstance(kind, T.NullType) else kind


# ---- the table ----

class OpenTable:
    """Lines in the folder ``path``: their values by batch, the versions of their schema, and what is no object."""

    def __init__(self, path):
        self.path = path.rstrip("/")

    def deliver(self, batch, batch_id):
        """A batch handler for lines (``value``). A repeated batch replaces what it wrote."""
        spark = batch.sparkSession
        line = F.col("value")
        is_object = F.coalesce(F.ltrim(line, F.lit(" \t\r\n")).startswith("{"), F.lit(False))
        rows = batch.select(F.when(is_object, F.try_parse_json(line)).alias("data"), line)
        seen = Observation(f"fields-{uuid.uuid4().hex}")
        # What cannot be read as an object is kept as its text.
        (rows.observe(seen, F.schema_of_variant_agg("data").alias("fields"))
         .select("data", F.when(F.col("data").isNull(), line).alias("line"))
         .write.mode("overwrite").parquet(f"{self.path}/rows/batch_id={batch_id}"))
        known = self.schema(spark, before=batch_id)
        wider = join(known, found_type(seen.get["fields"]))
        if wider != known or batch_id == 0:
            version = spark.createDataFrame([(wider.json(),)], "fields string").coalesce(1)
            version.write.mode("overwrite").parquet(f"{self.path}/versions/batch_id={batch_id}")

    def versions(self, spark):
        """(batch_id, schema) of every batch that widened the schema, in order."""
        try:
            rows = spark.read.schema(_VERSION).parquet(f"{self.path}/versions").collect()
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        return sorted(((r.batch_id, T.StructType.fromJson(json.loads(r.fields))) for r in rows), key=lambda v: v[0])

    def schema(self, spark, before=None):
        """The fields of all batches, or of those before one."""
        known = [schema for batch, schema in self.versions(spark) if before is None or batch < before]
        return known[-1] if known else T.StructType([])

    def read(self, spark):
        """All objects as rows of the last version's fields. Names that differ in case only share a column."""
        columns = {}
        for f in self.schema(spark):
            columns.setdefault(f.name.lower(), []).append(f)
        return self._rows(spark).where("data IS NOT NULL").select(
            *[F.coalesce(*[self._get(f.name, readable(kind)) for f in fields]).alias(fields[0].name)
              for fields in columns.values() for kind in [_shared(fields)]])

    def rejected(self, spark):
        """The lines that are no JSON object."""
        return self._rows(spark).where("data IS NULL").select("line")

    def _rows(self, spark):
        return spark.read.schema("data variant, line string, batch_id bigint").parquet(f"{self.path}/rows")

    def _get(self, name, kind):
        quote = '"' if "'" in name else "'"
        return F.try_variant_get("data", f"$[{quote}{name}{quote}]", _ddl(kind))


def _shared(fields):
    kind = _VOID
    for f in fields:
        kind = join(kind, f.dataType)
    return kind


def _ddl(kind):
    """A type as DDL with quoted names."""
    if isinstance(kind, T.StructType):
        return "struct<" + ", ".join(f"`{f.name.replace('`', '``')}`: {_ddl(f.dataType)}" for f in kind) + ">"
    return f"array<{_ddl(kind.elementType)}>" if isinstance(kind, T.ArrayType) else kind.simpleString()
