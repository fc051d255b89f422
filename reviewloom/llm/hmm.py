"""Language-model scoring by a hidden Markov model.

Tokens are the words of a text, lower-cased, and one end. Every token has a symbol: the ``OWN`` most
frequent have one each, the others share ``SHARED`` by hash. Given the symbol, the word's
probability comes from the word counts:

    P(word | symbol) = (c + 1) / (n + v + 1)

with the word's count c, and the tokens n and distinct words v of its symbol, in training
texts; so all unseen words of a symbol share what one seen word of count 0 would get.
The hidden states emit symbols. The score of a text is exact under this model:

    log10 P(symbols) by the scaled forward recursion + sum over words of log10 P(word | symbol)

Training runs over every training text. In each step tasks add up the expected counts of
their texts (Baum-Welch), Spark sums them, and the driver divides: states x states
and states x symbols numbers, whatever the size of the corpus.

Counting gathers the whole vocabulary in Spark. Words beyond the ``HEAD`` most frequent stay
distributed: each document's rare words are joined with the counts; only the head, a list of
bounded length, is broadcast.

Special cases: a null or empty text is one end token. With no training text at all every
word is unseen and the states keep their start values. Rows are told apart by a row number,
so null or repeated ids are fine. An empty table gives an empty result.
"""

from collections import Counter
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from .common import in_fold, most_frequent, stored

STATES = 6
OWN = 1024
SHARED = 512
SYMBOLS = OWN + SHARED
STEPS = 4
STAY = 0.9              # chance to stay in a state, at the start of the training
UNEVEN = 4.0            # how much the states' emissions differ then
HEAD = 131_072          # most frequent words that are broadcast, at most
SMOOTHING = 0.01        # added to every expected count
FLUSH_WORDS = 300_000   # distinct words that a task counts before it hands them on
TEXT_AT_ONCE = 1 << 22  # bytes that are held as separate words at a time, about
TOKENS_AT_ONCE = 400_000  # tokens of the texts that one recursion handles together, about
MAX_AT_ONCE = 1024      # and texts
END = b""               # no word is empty
SEED = 17


def tokens_of(text):
    """Words of a text's bytes: ASCII capitals lower-cased, cut at ASCII white space."""
    return text.lower().split()


def symbol_of(word, own):
    symbol = own.get(word)
    return OWN + xxhash.xxh3_64_intdigest(word) % SHARED if symbol is None else symbol


def encoded(texts):
    """A column of texts, some at a time: (tokens of each text, distinct tokens, the place of each token among them).

    All tokens follow each other in one array; every text ends with END.
    """
    some, size = [], 0
    for text in texts.to_pylist():
        some.append(text)
        size += len(text)
        if size >= TEXT_AT_ONCE:
            yield _encoded(some)
            some, size = [], 0
    if some:
        yield _encoded(some)


def _encoded(texts):
    words = [tokens_of(text) + [END] for text in texts]
    found = pa.array(list(chain.from_iterable(words)), type=pa.binary()).dictionary_encode()
    return np.array([len(w) for w in words]), found.dictionary, found.indices.to_numpy()


def count_batches(batches):
    """(text) to partial counts (word, n)."""
    counts = Counter()
    for batch in batches:
        for _, words, places in encoded(batch.column(0)):
            counts.update(dict(zip(words.to_pylist(), np.bincount(places, minlength=len(words)).tolist())))
            if len(counts) > FLUSH_WORDS:
                yield _counts(counts)
                counts = Counter()
    yield _counts(counts)


def _counts(counts):
    return pa.RecordBatch.from_arrays(
        [pa.array(list(counts), type=pa.binary()), pa.array(list(counts.values()), type=pa.int64())], names=["word", "n"])


def word_counts(texts):
    """(word, n) of all texts, written: the end is the empty word."""
    return stored(texts.mapInArrow(count_batches, "word binary, n bigint")
                  .groupBy("word").agg(F.sum("n").alias("n")), "word-counts")


def frequent_words(counts, head):
    """At most ``head`` of the most frequent words, the most frequent first."""
    return sorted(most_frequent(counts, head), key=lambda r: (-r.n, bytes(r.word)))


def symbol_batches(shared):
    """(word, n) with the word's symbol."""
    def symbols(batches):
        own = shared.value
        for batch in batches:
            found = [symbol_of(word, own) for word in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(found, type=pa.int32())], names=["n", "symbol"])
    return symbols


def totals(counts, own):
    """Tokens and distinct words by symbol: two arrays of SYMBOLS numbers."""
    n, v = np.zeros(SYMBOLS, dtype=np.int64), np.zeros(SYMBOLS, dtype=np.int64)
    rows = counts.select("word", "n").mapInArrow(symbol_batches(own), "n bigint, symbol int")
    for row in rows.groupBy("symbol").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect():
        n[row.symbol], v[row.symbol] = row.n, row.v
    return n, v


DOCUMENT = ("row bigint, id bigint, held_out boolean, n_tokens bigint, head_known bigint, head_log double, "
            "symbols binary, rare array<struct<word:binary,times:int>>")


def document_batches(shared):
    """(row, id, held_out, text) to the document's symbols, the sums over its head words, and its rare words."""
    names = [field.split()[0] for field in DOCUMENT.split(", ")]

    def documents(batches):
        logs, own = shared.value
        for batch in batches:
            first = 0
            for sizes, words, places in encoded(batch.column(3)):
                known = words.to_pylist()
                symbols = np.array([symbol_of(w, own) for w in known], dtype=np.uint16)[places]
                log = np.array([logs.get(w, np.nan) for w in known])[places]
                starts = np.cumsum(sizes) - sizes
                in_head = ~np.isnan(log)
                rare, rare_ends = _rare(words, places, in_head, sizes)
                columns = [
                    pa.array(sizes), pa.array(np.add.reduceat(in_head.astype(np.int64), starts)),
                    pa.array(np.add.reduceat(np.nan_to_num(log), starts)),
                    pa.array([symbols[a:a + n].tobytes() for a, n in zip(starts, sizes)], type=pa.binary()),
                    pa.ListArray.from_arrays(pa.array(rare_ends, type=pa.int32()), rare)]
                yield pa.RecordBatch.from_arrays(
                    [c.slice(first, len(sizes)) for c in batch.columns[:3]] + columns, names=names)
                first += len(sizes)
    return documents


def _rare(words, places, in_head, sizes):
    """The words outside the head with their number of times, text by text, and the list's offsets."""
    text = np.repeat(np.arange(len(sizes)), sizes)[~in_head]
    pairs, times = np.unique(text * len(words) + places[~in_head], return_counts=True)
    ends = np.searchsorted(pairs, np.arange(len(sizes) + 1) * len(words))
    found = pa.StructArray.from_arrays(
        [words.take(pa.array(pairs % max(1, len(words)))), pa.array(times.astype(np.int32))], names=["word", "times"])
    return found, ends


def initial_model(tokens, states=STATES):
    """Start, transition and emission probabilities: states that last, each with its own leaning.

    ``tokens`` are the training tokens of each symbol.
    """
    leaning = 1 + UNEVEN * np.random.default_rng(SEED).random((states, SYMBOLS))
    emit = (tokens + 1) * leaning
    move = np.full((states, states), (1 - STAY) / states) + STAY * np.eye(states)
    return np.full(states, 1 / states), move, emit / emit.sum(axis=1, keepdims=True)


def _groups(sequences):
    """Indices of sequences of similar length, few enough for one recursion."""
    order = sorted(range(len(sequences)), key=lambda i: -len(sequences[i]))
    at = 0
    while at < len(order):
        longest = max(1, len(sequences[order[at]]))
        n = max(1, min(MAX_AT_ONCE, TOKENS_AT_ONCE // longest))
        yield order[at:at + n]
        at += n


class Lattice:
    """Symbols of sequences sorted by falling length, place by place: all first ones, all second ones, ..."""

    def __init__(self, sequences):
        lengths = np.array([len(s) for s in sequences])
        self.n, self.longest = len(sequences), int(lengths.max())
        self.alive = np.searchsorted(-lengths, -np.arange(self.longest), side="left")  # sequences longer than t
        self.start = np.concatenate([[0], np.cumsum(self.alive)])
        sequence = np.repeat(np.arange(self.n), lengths)
        place = np.arange(len(sequence)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        self.symbols = np.empty(len(sequence), dtype=np.int64)
        self.symbols[self.start[place] + sequence] = np.concatenate(sequences)

    def at(self, t):
        return slice(self.start[t], self.start[t + 1])


def forward(sequences, model, keep=False):
    """Scaled forward recursion over sequences sorted by falling length.

    Returns the natural log-likelihoods and, with ``keep``, the lattice, emissions, scaled alphas and scales.
    States are rows and tokens columns throughout, in the model's precision.
    """
    start, move, emit = model
    lattice = Lattice(sequences)
    emitted = np.ascontiguousarray(emit[:, lattice.symbols])
    alphas, scales = np.empty_like(emitted), np.empty(emitted.shape[1], dtype=emitted.dtype)
    logs, step = np.zeros(lattice.n), np.ascontiguousarray(move.T)
    alpha = np.repeat(start[:, None], lattice.n, axis=1)
    for t in range(lattice.longest):
        here, k = lattice.at(t), lattice.alive[t]
        alpha = (step @ alpha[:, :k] if t else alpha) * emitted[:, here]
        scale = alpha.sum(axis=0)
        alpha /= scale
        alphas[:, here], scales[here] = alpha, scale
    log_scales = np.log(scales.astype(np.float64))
    for t in range(lattice.longest):
        logs[:lattice.alive[t]] += log_scales[lattice.at(t)]
    return (logs, lattice, emitted, alphas, scales) if keep else logs


def expected_counts(sequences, model):
    """Start, transition and emission counts, and the log-likelihood, of some sequences."""
    start, move, emit = model
    logs, lattice, emitted, alphas, scales = forward(sequences, model, keep=True)
    emitted /= scales
    betas = np.ones_like(alphas)  # a sequence's last place keeps its ones
    for t in range(lattice.longest - 1, 0, -1):
        here = lattice.at(t)
        emitted[:, here] *= betas[:, here]
        before = lattice.start[t - 1]
        betas[:, before:before + lattice.alive[t]] = move @ emitted[:, here]
    gammas = alphas * betas
    emits = np.stack([np.bincount(lattice.symbols, weights=gamma, minlength=emit.shape[1]) for gamma in gammas])
    # Each token after the first is reached from the same sequence's token at the place before.
    first = lattice.alive[0]
    place = np.repeat(np.arange(lattice.longest), lattice.alive)[first:]
    reached_from = np.arange(first, alphas.shape[1]) - lattice.start[place] + lattice.start[place - 1]
    moves = alphas[:, reached_from] @ emitted[:, first:].T * move
    return gammas[:, :first].sum(axis=1), moves, emits, float(logs.sum())


def expectation_batches(shared):
    """(symbols) to a task's summed counts: rows (state, place, n)."""
    def expectations(batches):
        # Single precision is enough for counts; scores are computed in double.
        model = tuple(part.astype(np.float32) for part in shared.value)
        total = None
        for batch in batches:
            sequences = [np.frombuffer(s, dtype=np.uint16) for s in batch.column(0).to_pylist()]
            for group in _groups(sequences):
                starts, moves, emits, log = expected_counts([sequences[i] for i in group], model)
                # One row per state: start, moves, emissions; the likelihood in a row of its own.
                counts = np.column_stack([starts, moves, emits]).astype(np.float64)
                total = (counts, log) if total is None else (total[0] + counts, total[1] + log)
        if total is not None:
            state, place = np.indices(total[0].shape)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.append(state.ravel(), -1).astype(np.int32)), pa.array(np.append(place.ravel(), 0).astype(np.int32)),
                 pa.array(np.append(total[0].ravel(), total[1]))], names=["state", "place", "n"])
    return expectations


def train(sequences, tokens, states=STATES, steps=STEPS):
    """Baum-Welch over all rows of ``sequences`` (symbols binary): the model and the likelihood before each step."""
    context = sequences.sparkSession.sparkContext
    model, likelihoods = initial_model(tokens, states), []
    for _ in range(steps):
        shared = context.broadcast(model)  # states x (states + SYMBOLS + 1) numbers
        rows = (sequences.mapInArrow(expectation_batches(shared), "state int, place int, n double")
                .groupBy("state", "place").agg(F.sum("n").alias("n")).collect())  # as many numbers
        if not rows:
            break
        counts = np.zeros((states, 1 + states + SYMBOLS))
        for row in rows:
            if row.state < 0:
                likelihoods.append(row.n)
            else:
                counts[row.state, row.place] = row.n
        counts += SMOOTHING
        share = lambda x: x / x.sum(axis=-1, keepdims=True)
        model = share(counts[:, 0]), share(counts[:, 1:1 + states]), share(counts[:, 1 + states:])
    return model, likelihoods


def forward_batches(shared):
    """(row, symbols) to the log10 probability of the symbols and their own share of the words'."""
    def scores(batches):
        model, spread = shared.value
        for batch in batches:
            sequences = [np.frombuffer(s, dtype=np.uint16) for s in batch.column(1).to_pylist()]
            logs = np.zeros(len(sequences))
            for group in _groups(sequences):
                logs[group] = forward([sequences[i] for i in group], model) / np.log(10)
            words = np.array([-spread[s].sum() for s in sequences]) if sequences else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(logs + words)], names=["row", "symbol_log"])
    return scores


def score_documents(docs, states=STATES, steps=STEPS, head=HEAD, text="text", id_column="doc_id"):
    """One row per document; texts are learnt from where crc32(id) mod 7 is not 2."""
    spark = docs.sparkSession
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_column).cast("bigint").alias("id"),
                       in_fold(id_column, 7, 2).alias("held_out"),
                       F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    counts = word_counts(rows.where("NOT held_out").select("text"))
    frequent = frequent_words(counts, head)
    context = spark.sparkContext
    logs = {bytes(r.word): float(np.log10(r.n + 1)) for r in frequent}
    own = {bytes(r.word): i for i, r in enumerate(frequent[:OWN])}
    n, v = totals(counts, context.broadcast(own))
    documents = stored(rows.mapInArrow(document_batches(context.broadcast((logs, own))), DOCUMENT), "documents")

    model, _ = train(documents.where("NOT held_out").select("symbols"), n, states, steps)
    spread = np.log10(n + v + 1)
    shared = context.broadcast((model, spread))
    symbols = documents.select("row", "symbols").mapInArrow(
        forward_batches(shared), "row bigint, symbol_log double")
    rare = (documents.select("row", F.explode("rare").alias("r")).select("row", "r.word", "r.times")
            .join(counts.select("word", "n"), "word", "left")
            .groupBy("row").agg(
                F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("rare_known"),
                F.sum(F.when(F.col("n").isNotNull(), F.col("times") * F.log10(F.col("n") + 1)).otherwise(0.0)).alias("rare_log")))
    train_tokens, vocabulary = int(n.sum()), int(v.sum())
    every = float(np.log10(train_tokens + vocabulary + 1))
    word_log = F.col("head_log") + F.coalesce("rare_log", F.lit(0.0))
    return (documents.drop("symbols", "rare").join(symbols, "row").join(rare, "row", "left")
            .select(F.col("id").alias(id_column), "held_out", "n_tokens",
                    (F.col("head_known") + F.coalesce("rare_known", F.lit(0))).cast("bigint").alias("n_known"),
                    F.lit(train_tokens).cast("bigint").alias("train_tokens"),
                    (word_log - F.col("n_tokens") * every).alias("base_score"),
                    (F.col("symbol_log") + word_log).alias("score")))
