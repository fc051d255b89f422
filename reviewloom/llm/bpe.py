"""Byte-level BPE encoding and decoding by a global shuffle of distinct words.

A word here is a match of the pre-tokenizer's pattern.

1. Each input partition numbers its distinct words and gives them as rows (part, number, word).
2. The words are shuffled by word and sorted, so that each distinct word of the corpus is
   merged once, in one task. The ids go back to the parts of origin, packed.
3. A second scan gives the texts as sequences of their words' numbers, by position. Both meet per
   input partition, where the ids take the words' places and every document is reassembled.
4. Decoding looks each id up in the token-byte table and joins the bytes.

The join back is per input partition, not per position: a word that fills a
third of all texts is one row per partition, and a position costs some two bytes of shuffle. Memory is
bounded by one input split. Should a partition differ between the two scans, a mark of its
words tells, and the job fails instead of giving wrong ids.

The vocabulary is a file of ranks, a parameter; it is read by the driver and broadcast, with a check of
its size. Null and empty texts have no tokens and decode to no bytes. Null or repeated ids
and repeated texts are rows like any other; an empty table gives an empty result.
"""

import base64
import hashlib
import heapq
import re
import unicodedata
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import functions as F

from .common import shuffle_partitions, squeezed, unsqueezed

MAX_RANKS = 1_000_000      # the vocabulary is broadcast only up to this size
PACK_WORDS = 20_000        # words of an Arrow batch
MERGE_WORDS = 200_000      # words that are merged, and packed by part, at a time
PACK_TOKENS = 200_000      # words of the documents in a packed row, about
NO_RANK = 1 << 40          # higher than any rank
LONG_WORD = 200            # bytes; a longer word is merged with a heap
TEXT_AT_ONCE = 1 << 20     # characters that are held as separate words at a time, about


def load_ranks(path):
    """Token bytes to rank of a file of lines ``base64 rank``."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
    if len(ranks) > MAX_RANKS:
        raise ValueError(f"{path} has {len(ranks)} tokens; at most {MAX_RANKS} are broadcast")
    return ranks


def merge(word, ranks):
    """The ids of the bytes of one word: the pair of lowest rank is joined, the leftmost first."""
    whole = ranks.get(word)
    if whole is not None:
        return [whole]
    if len(word) > LONG_WORD:
        return merge_long(word, ranks)
    parts = [word[i:i + 1] for i in range(len(word))]
    pairs = [ranks.get(a + b, NO_RANK) for a, b in zip(parts, parts[1:])]
    while pairs and (best := min(pairs)) != NO_RANK:
        i = pairs.index(best)
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
        del pairs[i]
        if i < len(pairs):
            pairs[i] = ranks.get(parts[i] + parts[i + 1], NO_RANK)
        if i:
            pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], NO_RANK)
    return [ranks[part] for part in parts]


def merge_long(word, ranks):
    """As ``merge``, in time n log n: pairs wait in a heap by rank and place, and parts are linked to their neighbours."""
    n = len(word)
    ends = list(range(1, n + 1))          # of the part that begins at a byte; 0 if none does
    before = list(range(-1, n - 1))       # the begin of the part before
    heap = [(rank, i, i + 2) for i in range(n - 1) if (rank := ranks.get(word[i:i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, end = heapq.heappop(heap)
        middle = ends[i]
        if not middle or middle == n or ends[middle] != end:
            continue                      # one of the two parts is no more
        ends[i], ends[middle] = end, 0
        if end < n:
            before[end] = i
        for begin, stop in ((before[i], end), (i, ends[end] if end < n else 0)):
            if begin >= 0 and stop and (rank := ranks.get(word[begin:stop])) is not None:
                heapq.heappush(heap, (rank, begin, stop))
    return [ranks[word[i:end]] for i, end in enumerate(ends) if end]


def _characters(test):
    """The first 256 characters that pass, for a character class."""
    return "".join(re.escape(chr(c)) for c in range(256) if test(chr(c)))


def splitter(pattern):
    """A function from text to its words.

    The pattern is read with white space as Unicode defines it. A text whose characters are all among the
    first 256 takes the same pattern with its classes spelled out, in the faster standard engine.
    """
    def with_classes(letter, number, space):
        neither = f"[^{space}{letter}{number}]"
        parts = [part.replace(r"\S", f"[^{space}]").replace(r"\s", f"[{space}]")
                 .replace(r"\p{L}", f"[{letter}]").replace(r"\p{N}", f"[{number}]")
                 for part in pattern.split(r"[^\s\p{L}\p{N}]")]
        return neither.join(parts)

    whole = regex.compile(with_classes(r"\p{L}", r"\p{N}", r"\p{White_Space}"))
    white = regex.compile(r"\p{White_Space}")
    short = re.compile(with_classes(_characters(lambda c: unicodedata.category(c)[0] == "L"),
                                    _characters(lambda c: unicodedata.category(c)[0] == "N"), _characters(white.match)))
    return lambda text: (short if text.isascii() or max(text) < "\u0100" else whole).findall(text)


class Part:
    """The distinct words of an input partition, numbered from the most frequent, and its texts as numbers.

    The numbers depend on the partition's texts only, not on their order.
    """

    def __init__(self, split, keep=False):
        self.split, self.keep = split, keep
        self.place, self.count, self.texts, self.sizes = {}, np.zeros(0, dtype=np.int64), [], []

    def add(self, texts):
        """Take up a column of texts, a few at a time."""
        some, size = [], 0
        for text in texts.to_pylist():
            some.append(text)
            size += len(text)
            if size >= TEXT_AT_ONCE:
                self._add(some)
                some, size = [], 0
        if some:
            self._add(some)

    def _add(self, texts):
        words = list(map(self.split, texts))
        found = pa.array(list(chain.from_iterable(words)), type=pa.string()).dictionary_encode()
        places = [self.place.setdefault(word, len(self.place)) for word in found.dictionary.to_pylist()]
        numbers = np.array(places, dtype=np.int64)[found.indices.to_numpy()] if places else np.zeros(0, dtype=np.int64)
        count = np.bincount(numbers, minlength=len(self.place))
        count[:len(self.count)] += self.count
        self.count = count
        if self.keep:
            self.texts.append(numbers.astype(np.uint32))
            self.sizes.extend(map(len, words))

    def numbered(self):
        """(words in the order of their numbers, the number of each place, a mark of the whole list)."""
        words = sorted(self.place)
        count = self.count[[self.place[word] for word in words]] if words else self.count
        words = [words[i] for i in np.argsort(-count, kind="stable")]
        number = np.empty(len(words), dtype=np.uint32)
        number[[self.place[word] for word in words]] = np.arange(len(words), dtype=np.uint32)
        mark = xxhash.xxh3_64_intdigest("\0".join(words).encode()) >> 1
        return words, number, mark


WORDS = "part int, mark bigint, number int, word string"


def word_batches(pattern):
    """(part, text) to the distinct words of each task."""
    def distinct(batches):
        at, part = None, Part(splitter(pattern))
        for batch in batches:
            if batch.num_rows:
                at = batch.column(0)[0].as_py()
                part.add(batch.column(1))
        words, _, mark = part.numbered()
        for i in range(0, len(words), PACK_WORDS):
            some = words[i:i + PACK_WORDS]
            yield pa.RecordBatch.from_arrays(
                [pa.array([at] * len(some), type=pa.int32()), pa.array([mark] * len(some), type=pa.int64()),
                 pa.array(np.arange(i, i + len(some), dtype=np.int32)), pa.array(some, type=pa.string())],
                names=["part", "mark", "number", "word"])
    return distinct


# kind 0: words, as their numbers (a), their numbers of ids (b) and the ids (c).
# kind 1: documents, as their ids, their numbers of words (b) and the words' numbers (c).
PACKS = "part int, kind int, mark bigint, docs array<bigint>, a binary, b binary, c binary"


def _packs(rows):
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary()]
    columns = list(zip(*rows)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(columns, kinds)],
                                      names=[field.split()[0] for field in PACKS.split(", ")])


def merge_batches(shared):
    """Words, sorted, to packs for each part; a word that several parts share is merged once."""
    def encode(batches):
        ranks = shared.value
        held, waiting, last = [], 0, (None, None)
        for batch in batches:
            held.append(batch)
            waiting += batch.num_rows
            if waiting >= MERGE_WORDS:
                packs, last = _merged(held, ranks, last)
                held, waiting = [], 0
                yield packs
        if waiting:
            yield _merged(held, ranks, last)[0]
    return encode


def _merged(batches, ranks, last):
    """Packs of some words, and the last of them with its ids."""
    rows = pa.Table.from_batches(batches).combine_chunks()
    found = rows.column("word").chunk(0).dictionary_encode()
    words = found.dictionary.to_pylist()
    ids = [last[1] if word == last[0] else merge(word.encode(), ranks) for word in words]
    sizes = np.array([len(x) for x in ids])
    starts = np.cumsum(sizes) - sizes
    flat = np.fromiter(chain.from_iterable(ids), dtype=np.uint32, count=int(sizes.sum()))
    part, mark, number = (rows.column(name).to_numpy() for name in ("part", "mark", "number"))
    at = found.indices.to_numpy()
    order = np.argsort(part, kind="stable")
    packs = []
    for group in np.split(order, np.flatnonzero(np.diff(part[order])) + 1):
        n = sizes[at[group]]
        packs.append((int(part[group[0]]), 0, int(mark[group[0]]), None, squeezed(number[group]),
                      squeezed(n), squeezed(flat[_ranges(starts[at[group]], n)])))
    return _packs(packs), (words[-1], ids[-1])


def _ranges(starts, sizes):
    """The indices of consecutive ranges, each given by its start and size."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def text_batches(pattern):
    """(part, id, text) to packs of documents."""
    def documents(batches):
        at, part, ids = None, Part(splitter(pattern), keep=True), []
        for batch in batches:
            if batch.num_rows:
                at = batch.column(0)[0].as_py()
                ids.extend(batch.column(1).to_pylist())
                part.add(batch.column(2))
        if not ids:
            return
        _, number, mark = part.numbered()
        words, sizes = np.concatenate(part.texts), np.array(part.sizes)
        ends = np.cumsum(sizes)
        first = 0
        while first < len(ids):
            before = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, before + PACK_TOKENS, side="right")))
            yield _packs([(at, 1, mark, ids[first:last], None, squeezed(sizes[first:last]),
                           squeezed(number[words[before:ends[last - 1]]]))])
            first = last
    return documents


ENCODED = "_id bigint, ids array<int>"


def assemble(batches):
    """Packs sorted by (part, kind) to documents with their ids."""
    at, words, table = None, [], None
    for batch in batches:
        for part, kind, mark, docs, a, b, c in zip(*(column.to_pylist() for column in batch.columns)):
            if part != at:
                at, words, table = part, [], None
            if kind == 0:
                words.append((mark, unsqueezed(a), unsqueezed(b), unsqueezed(c)))
                continue
            if table is None:
                table = WordTable(words)
                words = []
            yield table.documents(mark, docs, unsqueezed(b), unsqueezed(c))


class WordTable:
    """The ids of a part's words, by number."""

    def __init__(self, packs):
        self.marks = {mark for mark, *_ in packs}
        join = lambda i: np.concatenate([np.zeros(0, dtype=np.int64), *(pack[i] for pack in packs)]).astype(np.int64)
        number, sizes, self.ids = join(1), join(2), join(3).astype(np.int32)
        self.starts, self.sizes = np.zeros(len(number), dtype=np.int64), np.zeros(len(number), dtype=np.int64)
        self.starts[number], self.sizes[number] = np.cumsum(sizes) - sizes, sizes

    def documents(self, mark, docs, sizes, words):
        if len(words) and self.marks != {mark}:
            raise RuntimeError("an input partition changed between two scans: write the input to a table first")
        n = self.sizes[words]
        ids = self.ids[_ranges(self.starts[words], n)]
        word_ends, id_ends = (np.concatenate([[0], np.cumsum(x)]) for x in (sizes, n))
        offsets = id_ends[word_ends.astype(np.int64)].astype(np.int32)
        return pa.RecordBatch.from_arrays(
            [pa.array(docs, type=pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))], names=["_id", "ids"])


def _joined(docs, path, pattern, text, id_column):
    """Packs of every input partition, its words before its documents."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(load_ranks(path))  # bounded by MAX_RANKS
    rows = docs.select(F.spark_partition_id().alias("part"), F.col(id_column).cast("bigint").alias("id"),
                       F.coalesce(F.col(text), F.lit("")).alias("text"))
    words = (rows.select("part", "text").mapInArrow(word_batches(pattern), WORDS)
             .repartition(shuffle_partitions(spark), "word").sortWithinPartitions("word")
             .mapInArrow(merge_batches(shared), PACKS))
    texts = rows.mapInArrow(text_batches(pattern), PACKS)
    return words.unionAll(texts).repartition("part").sortWithinPartitions("part", "kind")


def encode(docs, path, pattern, text="text", id_column="doc_id"):
    """The id column of ``docs`` and ids (array<int>) of its texts, a row for each row.

    ``docs`` is scanned twice, so it must be a table or come from one without a shuffle.
    """
    return _joined(docs, path, pattern, text, id_column).mapInArrow(assemble, ENCODED).withColumnRenamed("_id", id_column)


def _joined_bytes(table, lists):
    """For lists of numbers: the entries of ``table`` (binary) that they name, joined, and where each list's bytes end."""
    numbers = lists.flatten()
    taken = table.take(numbers)
    ends = np.frombuffer(taken.buffers()[1], dtype=np.int64)[taken.offset:taken.offset + len(taken) + 1]
    data = memoryview(taken.buffers()[2] or b"")
    offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    return data, ends[offsets].tolist()


def _by_rank(ranks):
    """Token bytes by rank, as an array."""
    table = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    return pa.array(table, type=pa.large_binary())


def decode_batches(shared):
    """(id, ids) with the bytes that the ids stand for."""
    def decode(batches):
        table = _by_rank(shared.value)
        for batch in batches:
            data, ends = _joined_bytes(table, batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1),
                 pa.array([data[a:b].tobytes() for a, b in zip(ends, ends[1:])], type=pa.binary())],
                names=["_id", "ids", "bytes"])
    return decode


def decode(encoded, path, id_column="doc_id"):
    """The id column, ids and the bytes that the ids stand for."""
    spark = encoded.sparkSession
    shared = spark.sparkContext.broadcast(load_ranks(path))  # bounded by MAX_RANKS
    return (encoded.select(F.col(id_column).cast("bigint").alias("_id"), F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))
            .mapInArrow(decode_batches(shared), "_id bigint, ids array<int>, bytes binary")
            .withColumnRenamed("_id", id_column))


def digest_batches(size):
    """(id, ids, bytes) to the SHA-256 of the decimal ids, joined by a space, and of the bytes."""
    def digests(batches):
        decimal = pa.array([b"%d " % i for i in range(size)], type=pa.large_binary())
        sha = lambda data: hashlib.sha256(data).hexdigest()
        for batch in batches:
            data, ends = _joined_bytes(decimal, batch.column(1))
            counts = np.diff(batch.column(1).offsets.to_numpy()).astype(np.int64)
            ids = [sha(data[a:max(a, b - 1)]) for a, b in zip(ends, ends[1:])]  # without the last space
            whole = [sha(x.as_buffer()) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts), pa.array(ids, type=pa.string()), pa.array(whole, type=pa.string())],
                names=["_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return digests


def round_trip(docs, path, pattern, text="text", id_column="doc_id"):
    """The id column, n_tokens, ids_sha256 and decoded_sha256 of every row of ``docs``.

    Encoded, decoded and digested in one pass, so that the ids stay in their task.
    """
    ranks = load_ranks(path)
    shared = docs.sparkSession.sparkContext.broadcast(ranks)  # bounded by MAX_RANKS
    decoded, digests = decode_batches(shared), digest_batches(max(ranks.values(), default=-1) + 1)
    return (_joined(docs, path, pattern, text, id_column)
            .mapInArrow(lambda packs: digests(decoded(assemble(packs))),
                        "_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
            .withColumnRenamed("_id", id_column))
