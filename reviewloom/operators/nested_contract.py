"""Contracts with nested records, compiled from Avro schemas.

A schema file names the record's fields, which of them may be null, and the values of enums. It becomes a Spark schema to parse with and one
expression that gives the first thing wrong with a record: ``missing:a.b``, ``missing:items[].sku`` for an element of an
array, or ``symbol:status`` for a value that an enum lacks. A field is required if its type isn't a union with null and it has no
default; inside an optional record it is required only where that record is there. Defaults of plain fields are filled in.
"""

import json
import re
from dataclasses import dataclass, field as member

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.records import is_blank, is_whole, line_of, read_value

# The plain types of the format.
PLAIN = {"null": T.NullType(), "boolean": T.BooleanType(), "int": T.IntegerType(), "long": T.LongType(), "float": T.FloatType(),
         "double": T.DoubleType(), "string": T.StringType(), "bytes": T.StringType()}
# What a reader of the first may be handed by a writer of the others.
PROMOTED = {"long": {"int"}, "float": {"int", "long"}, "double": {"int", "long", "float"}, "string": {"bytes"}, "bytes": {"string"}}
_TRAILING_COMMA = re.compile(r'("(?:[^"\\]|\\.)*")|,(?=\s*[\]}])', re.S)


class ContractError(ValueError):
    """The schema cannot be used as a contract."""


@dataclass(frozen=True)
class Node:
    """A type: its Avro name, and by kind the fields, the element or the symbols."""

    kind: str
    nullable: bool = False
    fields: tuple = ()      # of a record: (name, node, has a default, the default)
    element: object = None  # of an array or map
    symbols: tuple = ()     # of an enum

    def spark(self):
        if self.kind == "record":
            return T.StructType([T.StructField(name, node.spark()) for name, node, *_ in self.fields])
        if self.kind == "array":
            return T.ArrayType(self.element.spark())
        if self.kind == "map":
            return T.MapType(T.StringType(), self.element.spark())
        return T.StringType() if self.kind == "enum" else PLAIN[self.kind]


@dataclass(frozen=True)
class Contract:
    root: Node
    schema: T.StructType = member(init=False)

    def __post_init__(self):
        object.__setattr__(self, "schema", self.root.spark())


def compile_contract(text):
    """The contract of a schema file's text. A comma before a closing bracket is let pass."""
    read = json.loads(_TRAILING_COMMA.sub(lambda m: m.group(1) or "", text))
    root = _node(read, {}, "")
    if root.kind != "record" or root.nullable:
        raise ContractError("a contract is a record")
    return Contract(root)


def _node(read, named, path):
    if isinstance(read, list):
        kinds = [k for k in read if k != "null"]
        if len(kinds) != 1:
            raise ContractError(f"{path or 'the schema'}: a union of several types other than null has no column type")
        node = _node(kinds[0], named, path)
        return Node(node.kind, node.nullable or len(kinds) < len(read), node.fields, node.element, node.symbols)
    if isinstance(read, str):
        if read in PLAIN:
            return Node(read, nullable=read == "null")
        if read not in named:
            raise ContractError(f"{path}: no type {read!r} (a record within itself has no column type)")
        return named[read]
    kind = read.get("type")
    if kind in ("record", "error"):
        seen, fields = set(), []
        for f in read["fields"]:
            if f["name"].lower() in seen:
                raise ContractError(f"{path}{f['name']}: the name occurs twice")
            seen.add(f["name"].lower())
            fields.append((f["name"], _node(f["type"], named, f"{path}{f['name']}."), "default" in f, f.get("default")))
        node = Node("record", fields=tuple(fields))
    elif kind == "enum":
        node = Node("enum", symbols=tuple(read["symbols"]))
    elif kind in ("array", "map"):
        return Node(kind, element=_node(read["items" if kind == "array" else "values"], named, f"{path}[]."))
    elif kind in PLAIN or isinstance(kind, (dict, list)) or kind in named:
        return _node(kind, named, path)  # logical types are read as what they are stored as
    else:
        raise ContractError(f"{path or 'the schema'}: unknown type {kind!r}")
    if "name" in read:
        full = f"{read['namespace']}.{read['name']}" if "namespace" in read else read["name"]
        named[read["name"]] = named[full] = node
    return node


def first_fault(node, value, path=""):
    """The first thing wrong with a value, null if nothing is."""
    if node.kind == "record":
        faults = []
        for name, inner, has_default, _ in node.fields:
            part, place = value[name], f"{path}.{name}" if path else name
            if not inner.nullable and not has_default:
                faults.append(F.when(part.isNull(), f"missing:{place}"))
            deeper = first_fault(inner, part, place)
            if deeper is not None:
                faults.append(F.when(part.isNotNull(), deeper))
        return F.coalesce(*faults) if faults else None
    if node.kind in ("array", "map"):
        items = value if node.kind == "array" else F.map_values(value)
        place = f"{path}[]"

        def fault(item):
            parts = [] if node.element.nullable else [F.when(item.isNull(), f"missing:{place}")]
            deeper = first_fault(node.element, item, place)
            if deeper is not None:
                parts.append(F.when(item.isNotNull(), deeper))
            return F.coalesce(*parts, F.lit(None).cast("string"))

        if node.element.nullable and first_fault(node.element, F.lit(None).cast(node.element.spark()), place) is None:
            return None
        return F.get(F.filter(F.transform(items, fault), lambda f: f.isNotNull()), F.lit(0))
    if node.kind == "enum":
        return F.when(value.isNotNull() & ~value.isin(*node.symbols), f"symbol:{path}")
    return None


def with_defaults(node, value):
    """The value with the defaults of its plain fields, and of those of the records in it."""
    if node.kind != "record":
        return value
    parts = []
    for name, inner, has_default, default in node.fields:
        part = with_defaults(inner, value[name])
        if has_default and default is not None and inner.kind in {*PLAIN, "enum"}:
            part = F.coalesce(part, F.lit(default).cast(inner.spark()))
        parts.append(part.alias(name))
    return F.when(value.isNotNull(), F.struct(*parts))


def check_nested(lines, contract):
    """As ``contract.check_contract``: the contract's fields, ``line``, ``status`` and ``reason`` of every line, parsed once."""
    if clash := {"line", "status", "reason"} & {name.lower() for name in contract.schema.names}:
        raise ContractError(f"{', '.join(sorted(clash))}: the result has columns of its own by these names")
    read = F.col("read")
    record = line_of(read)
    malformed = ~is_whole(read, contract.schema.fields) | record.isNull()
    fault = first_fault(contract.root, record)
    reason = F.when(is_blank(F.col("line")), "blank").when(malformed, "malformed")
    return (lines.select(F.col("value").alias("line"), read_value(F.col("value"), contract.schema.fields).alias("read"))
            .select("line", reason.otherwise(fault if fault is not None else F.lit(None)).alias("reason"),
                    with_defaults(contract.root, record).alias("data"))
            .select("data.*", "line", F.when(F.col("reason").isNull(), "valid").otherwise("quarantine").alias("status"), "reason"))


def incompatibilities(reader, writer):
    """What keeps records that follow the contract ``writer`` from being read by ``reader``, as a list of texts."""
    return _clashes(reader.root, writer.root, "")


def _clashes(new, old, path):
    place = path or "the record"
    out = [] if new.nullable or not old.nullable else [f"{place} may be null in the data"]
    if old.kind == "null":
        return out
    if new.kind != old.kind:
        return out if old.kind in PROMOTED.get(new.kind, ()) else [*out, f"{place} is {old.kind} in the data, not {new.kind}"]
    if new.kind == "record":
        known = {name: node for name, node, *_ in old.fields}
        for name, node, has_default, _ in new.fields:
            inner = f"{path}.{name}" if path else name
            if name in known:
                # A default fills in for null, so a field that has one may be null in the data.
                given = Node(known[name].kind, known[name].nullable and not has_default, known[name].fields, known[name].element, known[name].symbols)
                out += _clashes(node, given, inner)
            elif not (has_default or node.nullable):
                out.append(f"{inner} is not in the data and has no default")
    elif new.kind in ("array", "map"):
        out += _clashes(new.element, old.element, f"{path}[]")
    elif new.kind == "enum" and (gone := sorted(set(old.symbols) - set(new.symbols))):
        out.append(f"{place} may be {', '.join(gone)} in the data")
    return out
