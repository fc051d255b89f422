"""License scan: an Aho-Corasick search for tags and notices, and an expression parser.

One automaton runs over the lower-cased text and finds identifier tags such as
``SPDX-License-Identifier:``. The expression after a tag is read by a
shunting-yard parser that knows ``and``, ``or``, ``with`` and brackets. A second
automaton runs over the words, joined by single spaces, and finds notice phrases.

An expression is evaluated to its obligation, a level from 0 (public domain) to
5 (unknown or proprietary): ``or`` takes the lower level of its sides, as the
reader may choose, ``and`` the higher, and ``with`` lowers a copyleft by one.
Where brackets or operators do not match, the longest valid beginning counts.

The score joins the evidence: 1 - product of (1 - weight) over the distinct marks found.

Rows are scanned one by one inside Arrow batches; there is no shuffle. Special cases: a
null or empty text has no words and no labels, and score 0. Repeated rows give
repeated results; other columns are ignored.
"""

import re

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from .common import WORD_BYTES

# The base phrases and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Notices that the scan adds, with labels of its own.
NOTICES = {
    "permission is hereby granted free of charge": "mit",
    "licensed under the apache license": "apache",
    "redistribution and use in source and binary forms": "bsd",
    "bsd license": "bsd",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "isc license": "isc",
    "creative commons attribution sharealike": "cc-by-sa",
    "creative commons attribution noncommercial": "cc-by-nc",
    "creative commons attribution": "cc-by",
    "creative commons zero": "cc0",
    "cc by sa": "cc-by-sa",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "public domain": "public-domain",
    "all rights reserved": "all-rights-reserved",
}
TAGS = ["spdx-license-identifier:", "license-identifier:", "license-expression:"]
# The names of licence identifiers, the longest first where one begins another, with label and obligation.
IDENTIFIERS = [
    ("cc-by-nc", "cc-by-nc", 4), ("cc-by-nd", "cc-by-nd", 4), ("cc-by-sa", "cc-by-sa", 3), ("cc-by", "cc-by", 1),
    ("cc0", "cc0", 0), ("unlicense", "public-domain", 0), ("wtfpl", "public-domain", 0), ("0bsd", "bsd", 0),
    ("agpl", "agpl", 4), ("lgpl", "lgpl", 2), ("gpl", "gpl", 3), ("mpl", "mpl", 2), ("epl", "epl", 2),
    ("cddl", "cddl", 2), ("cpl", "cpl", 2), ("eupl", "eupl", 3), ("osl", "osl", 3), ("gfdl", "gfdl", 3),
    ("odbl", "odbl", 3), ("ms-rl", "ms-rl", 2), ("ms-pl", "ms-pl", 1), ("artistic", "artistic", 2), ("cecill", "cecill", 3),
    ("apache", "apache", 1), ("mit", "mit", 1), ("bsd", "bsd", 1), ("isc", "isc", 1), ("zlib", "zlib", 1),
    ("bsl", "bsl", 1), ("afl", "afl", 1), ("ncsa", "ncsa", 1), ("openssl", "openssl", 1), ("postgresql", "postgresql", 1),
    ("python", "python", 1), ("psf", "python", 1), ("php", "php", 1), ("ruby", "ruby", 1), ("vim", "vim", 1), ("x11", "x11", 1),
]
VERSION = re.compile(r"$|[-.+]|v?[0-9]")   # what may follow a name
UNKNOWN = 5
PRIORITY = {"or": 1, "and": 2, "with": 3}
WEIGHTS = {"base": 0.6, "notice": 0.7, "tag": 0.95}
# A line end is a part of its own: it ends an expression.
PART = re.compile(rb"[\r\n()]|[^\s()]+")
OPERAND = re.compile(r"[a-z0-9](?:[a-z0-9.+:-]*[a-z0-9.+-])?")   # what ends with a colon is a tag

PLACE = "array<struct<label:string,kind:string,start:bigint,len:int>>"
FOUND = f"_id bigint, n_words bigint, places {PLACE}, expressions array<struct<text:string,labels:array<string>,obligation:int>>"


def identify(name):
    """(label, obligation) of a licence identifier: its name up to a version, a variant or the end."""
    for start, label, level in IDENTIFIERS:
        if name.startswith(start) and VERSION.match(name, len(start)):
            return label, level
    return "other", UNKNOWN


def _operand(part):
    return part not in PRIORITY and OPERAND.fullmatch(part)


def to_postfix(line):
    """The postfix form of the longest valid beginning of ``line``, and its text."""
    return read_expression(parts_after(line.encode(), 0))


def read_expression(parts):
    """The postfix form of the longest valid beginning of ``parts``, and its text.

    Reads no further than the first part that cannot go on.
    """
    valid = (0, (), 0)  # so many of out and used, and the operators that are still to come
    out, stack, used, opened = [], [], [], 0
    wants_operand, after_with = True, False
    for part in parts:
        if wants_operand and part == "(" and not after_with:
            stack.append(part)
            opened += 1
        elif wants_operand and _operand(part):
            out.append(("exception" if after_with else "licence", part))
            wants_operand = after_with = False
        elif not wants_operand and part in PRIORITY:
            while stack and stack[-1] != "(" and PRIORITY[stack[-1]] >= PRIORITY[part]:
                out.append(("operator", stack.pop()))
            stack.append(part)
            wants_operand, after_with = True, part == "with"
        elif not wants_operand and part == ")" and opened:
            while stack[-1] != "(":
                out.append(("operator", stack.pop()))
            stack.pop()
            opened -= 1
        else:
            break
        used.append(part)
        if not wants_operand and not opened:
            valid = len(out), tuple(reversed(stack)), len(used)  # at most one operator of each kind
    n, operators, n_used = valid
    text = " ".join(used[:n_used]).replace("( ", "(").replace(" )", ")")
    return out[:n] + [("operator", op) for op in operators], text


def parts_after(lowered, place):
    """The parts of the expression that begins at ``place`` of the bytes, one by one, to the end of the line."""
    for found in PART.finditer(lowered, place):
        part = found.group()
        if part in (b"\r", b"\n"):
            return
        yield part.decode("utf-8", "replace")


def evaluate(postfix):
    """(sorted labels, obligation) of a postfix expression."""
    labels, levels = set(), []
    for kind, part in postfix:
        if kind == "licence":
            label, level = identify(part)
            labels.add(label)
            levels.append(level)
        elif kind == "exception":
            levels.append(None)
        else:
            right, left = levels.pop(), levels.pop()
            levels.append(min(left, right) if part == "or" else max(left, right) if part == "and"
                          else left - 1 if 2 <= left < UNKNOWN else left)
    return sorted(labels), levels[0]


def automaton(patterns):
    found = ahocorasick.Automaton()
    for pattern, value in patterns.items():
        found.add_word(pattern, value)
    found.make_automaton()
    return found


def phrase_automaton():
    """Finds whole words: a pattern carries the spaces around it."""
    both = {}
    for kind, phrases in (("base", BASE), ("notice", NOTICES)):
        for phrase, label in phrases.items():
            both.setdefault(f" {phrase} ", []).append((label, kind, phrase.count(" ") + 1, len(phrase) + 2))
    return automaton(both)


def scan_text(text, phrases, tags):
    """(n_words, places, expressions) of the bytes of one text."""
    parts = text.translate(WORD_BYTES).split()
    stream = b" " + b" ".join(parts) + b" "
    hits = list(phrases.iter(stream.decode("latin-1")))  # a character per byte
    places = []
    if hits:
        gaps = np.flatnonzero(np.frombuffer(stream, dtype=np.uint8) == 32)
        for end, values in hits:
            for label, kind, length, size in values:
                places.append((label, kind, int(np.searchsorted(gaps, end + 1 - size)), length))
        places.sort(key=lambda p: (p[2], p[3], p[1], p[0]))
    expressions, lowered = {}, text.lower()
    for end, _ in tags.iter(lowered.decode("latin-1")):
        postfix, read = read_expression(parts_after(lowered, end + 1))
        if postfix and read not in expressions:
            expressions[read] = (read, *evaluate(postfix))
    return len(parts), places, list(expressions.values())


def scan_batches(batches):
    phrases, tags = phrase_automaton(), automaton({tag: tag for tag in TAGS})
    kinds = [pa.int64(), pa.int64(),
             pa.list_(pa.struct([("label", pa.string()), ("kind", pa.string()), ("start", pa.int64()), ("len", pa.int32())])),
             pa.list_(pa.struct([("text", pa.string()), ("labels", pa.list_(pa.string())), ("obligation", pa.int32())]))]
    for batch in batches:
        found = [scan_text(text, phrases, tags) for text in batch.column(1).to_pylist()]
        columns = [
            batch.column(0), [f[0] for f in found],
            [[dict(zip(("label", "kind", "start", "len"), p)) for p in f[1]] for f in found],
            [[dict(zip(("text", "labels", "obligation"), e)) for e in f[2]] for f in found]]
        yield pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(columns, kinds)],
                                         names=["_id", "n_words", "places", "expressions"])


def scan_licenses(docs, text="text", id_column="doc_id"):
    """id, n_words, places (label, kind, start, len) and expressions per row of ``docs``."""
    rows = docs.select(F.col(id_column).cast("bigint").alias("_id"),
                       F.coalesce(F.col(text), F.lit("")).cast("binary").alias("_text"))
    return rows.mapInArrow(scan_batches, FOUND).withColumnRenamed("_id", id_column)


def license_report(docs):
    """One row per document: counts, labels and score."""
    found = scan_licenses(docs)
    base = F.filter("places", lambda p: p["kind"] == "base")
    starts = F.transform("base", lambda p: p["start"])
    weight = F.create_map(*[x for kind, w in WEIGHTS.items() for x in (F.lit(kind), F.lit(w))])
    marks = F.array_union(
        F.transform("places", lambda p: F.struct(p["kind"].alias("kind"), p["label"].alias("label"))),
        F.transform("tagged", lambda t: F.struct(F.lit("tag").alias("kind"), t.alias("label"))))
    return (found.withColumn("base", base)
            .withColumn("tagged", F.array_distinct(F.flatten("expressions.labels")))
            .select("doc_id", "n_words", F.size("base").cast("bigint").alias("n_base"),
                    F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
                    F.array_join(F.array_sort(F.array_distinct("base.label")), ",").alias("base_labels"),
                    F.array_join(F.array_sort(F.array_union(F.array_distinct("places.label"), "tagged")), ",").alias("labels"),
                    F.aggregate(marks, F.lit(1.0), lambda rest, m: rest * (1 - weight[m["kind"]]),
                                lambda rest: 1 - rest).alias("score"),
                    F.array_min("expressions.obligation").alias("obligation"),
                    F.array_join("expressions.text", " | ").alias("expressions")))
