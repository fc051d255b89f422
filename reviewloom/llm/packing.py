"""Best-fit packing by minimum bin slack.

Documents become pieces of at most ``capacity`` tokens, and pieces are laid into sequences of that size so that as
few as possible are needed. Sequences are filled one after the other: the longest piece left opens one, and a
subset-sum dynamic program over the lengths that are left, on a bitset of reachable sums, finds the combination that
leaves the least slack. It is taken out, and the next sequence is filled from the rest.

Only lengths matter for that, and there are at most ``capacity`` of them: so the plan is made on the counts of pieces by length,
which are ``capacity`` numbers whatever the corpus. A combination stays the fullest for as long as there are
pieces for it, so it is repeated that often at once, and the plan has a bounded number of combinations: each ends the supply of
a length at its multiplicity. Everything else is Spark's:

1. Tasks cut documents and count, within their part of the input, the pieces of every length.
2. The counts per part and length are added up over the parts, which numbers the pieces of each length without
   bringing them together.
3. Every piece looks its number up in the plan: its sequence, and its place there.

A length that a third of all pieces share is a counter like any other. Whole pieces are shuffled once, by
part and length, to meet the counts; a group of that shuffle is no larger than an input split.

Special cases: a null or empty text is a document of the one closing token. Null and repeated ids and repeated texts are
documents like any other. Other columns, also of the names used here, are carried along by ``pack``, but for ``sequence_id``
and ``offset``, which it sets. A length beyond the capacity or below 1 is refused. An empty table gives an empty result.
"""

import json
import re
import unicodedata
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from .common import named, stored

CAPACITY = 2048
CLOSING = 0                 # the id behind every document
MAX_VOCABULARY = 1 << 26    # bytes of a tokenizer file that is broadcast
TEXT_AT_ONCE = 1 << 20      # characters that are tokenized at a time, about
KNOWN_WORDS = 300_000       # words whose ids a task remembers
BATCH_BYTES = 1 << 22       # bytes of ids in a batch of pieces, about


# ---- documents to pieces ----

# The steps before the model for which words can be looked up one by one.
LOWER_WORDS = {
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
         "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
}
BREAK = re.compile(r"[ \n\r\t]")


def _latin_words():
    """The split of ``LOWER_WORDS`` for texts of the first 256 characters, in the standard engine."""
    listed = lambda test: "".join(re.escape(chr(c)) for c in range(256) if test(chr(c)))
    letters, numbers = (listed(lambda c: unicodedata.category(c)[0] == kind) for kind in "LN")
    spaces = listed(lambda c: c.isspace() and c not in "\x1c\x1d\x1e\x1f")
    return re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^{spaces}{letters}{numbers}]+")


class WordIds(dict):
    """Word to the bytes of its ids; a new word is given to the model."""

    def __init__(self, tokenizer):
        super().__init__()
        self.model, self.bytes_as_text = tokenizer.model, tokenizer.pre_tokenizer[1]

    def __missing__(self, word):
        plain = word.isascii() and word.isprintable()
        written = word if plain else "".join(part for part, _ in self.bytes_as_text.pre_tokenize_str(word))
        ids = np.array([token.id for token in self.model.tokenize(written)], dtype="<u4").tobytes()
        self[word] = ids
        return ids


def chunks(text):
    """``text`` in parts that end before white space, where no word and no letter's form is cut."""
    at = 0
    while len(text) - at > TEXT_AT_ONCE:
        end = BREAK.search(text, at + TEXT_AT_ONCE)
        if end is None:
            break
        yield text[at:end.start()]
        at = end.start()
    yield text[at:] if at else text


def encoder(specification):
    """A function from text to its ids as little-endian 32-bit numbers, as the tokenizer of that JSON text gives them.

    Strings of special tokens are ordinary text. If the tokenizer works word by word as in ``LOWER_WORDS``, each word
    is given to its model once per task; any other tokenizer gets the text as it is.
    """
    tokenizer = Tokenizer.from_str(specification)
    tokenizer.encode_special_tokens = True
    read = json.loads(specification)
    if any(read[step] != LOWER_WORDS[step] for step in LOWER_WORDS):
        return lambda text: np.array(tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
    known, latin, split = WordIds(tokenizer), _latin_words(), tokenizer.pre_tokenizer[0]

    def ids(text):
        out = []
        for chunk in chunks(text):
            if len(known) > KNOWN_WORDS:
                known.clear()
            if chunk.isascii() or max(chunk) < "Ā":
                words = latin.findall(chunk.lower())
            else:
                words = [word for word, _ in split.pre_tokenize_str(tokenizer.normalizer.normalize_str(chunk))]
            out.append(b"".join(map(known.__getitem__, words)))
        return b"".join(out)
    return ids


PIECES = "_id bigint, piece int, start bigint, length bigint, ids binary"


def piece_batches(shared, capacity, closing):
    """(id, text) to the pieces of every document."""
    def pieces(batches):
        ids_of, end = encoder(shared.value), np.array([closing], dtype="<u4").tobytes()
        step = 4 * capacity
        for batch in batches:
            rows, size = [], 0
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = ids_of(text.as_py()) + end
                for i, at in enumerate(range(0, len(ids), step)):
                    part = ids[at:at + step]
                    rows.append((doc, i, at // 4, len(part) // 4, part))
                    size += len(part)
                    if size >= BATCH_BYTES:
                        yield _pieces(rows)
                        rows, size = [], 0
            yield _pieces(rows)
    return pieces


def _pieces(rows):
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
    columns = list(zip(*rows)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(columns, kinds)],
                                      names=[field.split()[0] for field in PIECES.split(", ")])


def cut_documents(docs, vocabulary, capacity=CAPACITY, closing=CLOSING, text="text", id_column="doc_id"):
    """The id column, piece, start, length and ids of all documents' pieces.

    A document is its text's ids by the tokenizer of the file ``vocabulary``, then ``closing``; one of more than
    ``capacity`` tokens is cut after every ``capacity`` of them. ``ids`` holds little-endian unsigned 32-bit numbers.
    """
    with open(vocabulary, encoding="utf-8") as file:
        specification = file.read(MAX_VOCABULARY + 1)
    if len(specification) > MAX_VOCABULARY:
        raise ValueError(f"{vocabulary} is larger than {MAX_VOCABULARY} characters, the most that is broadcast")
    shared = docs.sparkSession.sparkContext.broadcast(specification)
    return (docs.select(F.col(id_column).cast("bigint").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
            .mapInArrow(piece_batches(shared, capacity, closing), PIECES).withColumnRenamed("_id", id_column))


# ---- the plan ----

def fullest(counts, room):
    """The lengths, as a Counter, whose sum comes closest to ``room`` without going beyond it.

    ``counts`` maps the lengths to how many there are. Bit s of ``reached`` says that the sum s can be had from the lengths looked at
    so far, the longest first; among equal sums those of longer pieces are taken. Copies of a length are added 1, 2, 4,
    .. at a time.
    """
    reached, steps = 1, []
    within = (1 << room + 1) - 1
    for length in sorted(counts, reverse=True):
        left, some = min(counts[length], room // length), 1
        while left and not reached >> room:
            some = min(some, left)
            steps.append((length, some, reached))
            reached |= reached << some * length & within
            left -= some
            some *= 2
        if reached >> room:
            break
    total, chosen = reached.bit_length() - 1, Counter()
    for length, some, before in reversed(steps):
        if not before >> total & 1:
            chosen[length] += some
            total -= some * length
    return chosen


def fill(counts, capacity):
    """(times, lengths and how many of each, the longest first) of all sequences for ``counts`` of pieces by length."""
    counts = {length: n for length, n in counts.items() if n}
    out = []
    while counts:
        longest = max(counts)
        rest = {length: n for length, n in counts.items() if length + longest <= capacity}
        if longest in rest:
            rest[longest] -= 1
        chosen = fullest(rest, capacity - longest)
        chosen[longest] += 1
        times = min(counts[length] // n for length, n in chosen.items())
        out.append((times, sorted(chosen.items(), reverse=True)))
        for length, n in chosen.items():
            counts[length] -= times * n
            if not counts[length]:
                del counts[length]
    return out


def lookup(filled):
    """By length: where each combination's pieces begin, its first sequence, how many a sequence takes, and their offset."""
    table, used, sequence = {}, Counter(), 0
    for times, lengths in filled:
        offset = 0
        for length, n in lengths:
            table.setdefault(length, []).append((used[length], sequence, n, offset))
            used[length] += times * n
            offset += n * length
        sequence += times
    return {length: np.array(rows, dtype=np.int64).T for length, rows in table.items()}


def placed(table, lengths, numbers):
    """(sequence, offset) of the pieces with these numbers among those of their lengths."""
    sequence, offset = np.empty(len(lengths), dtype=np.int64), np.empty(len(lengths), dtype=np.int64)
    order = np.argsort(lengths, kind="stable")
    for group in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1):
        if len(group):
            length = int(lengths[group[0]])
            begin, first, n, base = table[length]
            at = np.searchsorted(begin, numbers[group], side="right") - 1
            nth = numbers[group] - begin[at]
            sequence[group] = first[at] + nth // n[at]
            offset[group] = base[at] + nth % n[at] * length
    return sequence, offset


# ---- Spark ----

def number_batches(capacity):
    """(row, length) with the task's part and the row's number among those of the part and length."""
    def numbered(batches):
        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, dtype=np.int64)
        for batch in batches:
            lengths = batch.column(1).fill_null(0).to_numpy(zero_copy_only=False)
            if len(lengths) and not (1 <= lengths.min() and lengths.max() <= capacity):
                raise ValueError(f"a piece has between 1 and {capacity} tokens")
            order = np.argsort(lengths, kind="stable")
            counts = np.bincount(lengths, minlength=capacity + 1)
            nth = np.empty(len(lengths), dtype=np.int64)
            nth[order] = np.arange(len(lengths)) - np.repeat(np.cumsum(counts) - counts, counts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(np.full(len(lengths), part, dtype=np.int32)), pa.array(seen[lengths] + nth)],
                names=["row", "length", "part", "nth"])
            seen += counts
    return numbered


def place_batches(shared):
    """(row, length, number) with the sequence and offset."""
    def places(batches):
        for batch in batches:
            found = placed(shared.value, batch.column(1).to_numpy(), batch.column(2).to_numpy())
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, found)], names=["row", "sequence_id", "offset"])
    return places


def pack(pieces, capacity=CAPACITY, length="length"):
    """``pieces`` with sequence_id and offset: no sequence holds more than ``capacity`` tokens, and its pieces fill it without gaps."""
    spark = pieces.sparkSession
    pieces = pieces.drop("sequence_id", "offset")
    row = T.StructField("row", pieces.schema)
    # Cut here: the counts and the places must agree on the numbers.
    numbered = stored(
        pieces.select(F.struct(*map(named, pieces.columns)).alias("row"), named(length).cast("bigint").alias("length"))
        .mapInArrow(number_batches(capacity), T.StructType([row, *_fields("length bigint, part int, nth bigint")])), "pieces")
    counts = numbered.groupBy("part", "length").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = stored(counts.select("part", "length", "n", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")), "piece-counts")
    # At most ``capacity`` rows.
    by_length = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    shared = spark.sparkContext.broadcast(lookup(fill(by_length, capacity)))
    return (numbered.join(counts.drop("n"), ["part", "length"])
            .select("row", "length", (F.col("before") + F.col("nth")).alias("number"))
            .mapInArrow(place_batches(shared), T.StructType([row, *_fields("sequence_id bigint, offset bigint")]))
            .select("row.*", "sequence_id", "offset"))


def _fields(ddl):
    return T.StructType.fromDDL(ddl).fields


def sequences(packed, ids="ids"):
    """sequence_id, length and ids (as ``cut_documents`` gives them) of the packed sequences."""
    laid = F.transform(F.sort_array(F.collect_list(F.struct("offset", F.col(ids).alias("ids")))), lambda piece: F.hex(piece["ids"]))
    return (packed.groupBy("sequence_id").agg(F.unhex(F.array_join(laid, "")).alias("ids"))
            .select("sequence_id", (F.octet_length("ids") / 4).cast("int").alias("length"), "ids"))
