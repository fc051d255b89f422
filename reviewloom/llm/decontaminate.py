"""Benchmark decontamination by a prefix-filtered set join.

A window is ten consecutive words of a benchmark item, or all words of a shorter
item. A window is a sequence of shingles of up to three words. A document that
contains the window contains every one of its shingles, so one of them is a
sufficient prefix: the rarest, by its count over all documents. The join of the
documents' shingles with these prefixes gives candidates; a candidate must have
room for the window before and after the shingle (length and position), and then the
document's words are compared with the window's, word by word.

The document words are exploded and joined inside one stage: what leaves it are
counts and verified places only, so no text is shuffled. The windows are broadcast
in blocks of at most ``BLOCK_ROWS``; a larger benchmark makes more
passes over the documents.

Special cases: a null or empty text has no words, as document (not contaminated) and
as item (never found). Rows of documents with the same id and text get the same result, one
row each. Items with null ids are found but have no name in ``items``. Items
with the same id count once. Empty tables give no rows, or no hits.
"""

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from .common import stored, words

WINDOW = 10
SHINGLE = 3
BLOCK_ROWS = 100_000    # windows or shingles broadcast at once, some 15 MB
OWN_KEY = -1            # key of the row that stands for a document


def _slice(array, start, length):
    return F.concat_ws(" ", F.slice(array, start, length))


def item_windows(items, id_column="item_id", text="text", window=WINDOW):
    """Distinct windows: words as text, their number, and the ids of their items."""
    return (items.select(F.col(id_column).alias("item"), words(text).alias("w"))
            .where(F.size("w") > 0)
            .select("item", "w", F.least(F.size("w"), F.lit(window)).alias("len"))
            .select("item", "w", "len", F.explode(F.sequence(F.lit(1), F.size("w") - F.col("len") + 1)).alias("at"))
            .select("item", "len", _slice("w", F.col("at"), F.col("len")).alias("window"))
            .groupBy("window", "len").agg(F.collect_set("item").alias("items")))


def shingle_key(array, at, size):
    """A 64-bit key of ``size`` words; equal shingles have equal keys."""
    return F.xxhash64(*[F.get(array, at + i) for i in range(size)])


def window_shingles(windows, shingle=SHINGLE):
    """Every shingle of every window: its key, offset and number of words."""
    size = F.least(F.col("len"), F.lit(shingle))
    key = reduce(lambda rest, g: F.when(F.col("g") == g, shingle_key("w", F.col("offset"), g)).otherwise(rest),
                 range(1, shingle + 1), F.lit(None).cast("bigint"))
    return (windows.select("window", "len", F.split("window", " ").alias("w"), size.alias("g"))
            .select("window", "len", "g", "w", F.explode(F.sequence(F.lit(0), F.col("len") - F.col("g"))).alias("offset"))
            .select("window", "len", "g", "offset", key.alias("shingle")))


def doc_places(docs, sizes):
    """A row per document word and shingle size, with the shingle's key.

    A row with place -1 stands for the document itself, so that one pass gives
    both the number of words and the hits.
    """
    places = docs.withColumn("w", words("text")).select(
        "doc_id", F.xxhash64("text").alias("text_key"), "w",
        F.explode(F.sequence(F.lit(-1), F.size("w") - 1)).alias("place"))
    keys = [F.when(F.col("place") < 0, F.lit(OWN_KEY)).otherwise(shingle_key("w", F.col("place"), g))
            for g in sizes]
    if len(keys) == 1:
        return places.withColumn("shingle", keys[0])
    return places.withColumn("shingle", F.explode(
        F.when(F.col("place") < 0, F.array(keys[0])).otherwise(F.array(*keys))))


def _blocks(df, key, limit):
    """``df`` in broadcastable blocks of about ``limit`` rows."""
    n = max(1, -(-df.count() // limit))
    return [df] if n == 1 else [df.where(F.pmod(F.xxhash64(F.lit(7), key), F.lit(n)) == i) for i in range(n)]


def _union(parts):
    return reduce(lambda a, b: a.unionByName(b), parts)


def rarest_shingles(docs, shingles, sizes, block_rows=BLOCK_ROWS):
    """One prefix per window: its shingle with the lowest count over all documents.

    A window with a shingle that no document has cannot occur, and is dropped.
    """
    distinct = shingles.select("shingle").distinct()
    counts = _union([
        doc_places(docs, sizes).where("place >= 0").select("shingle")
        .join(F.broadcast(block), "shingle").groupBy("shingle").count()
        for block in _blocks(distinct, "shingle", block_rows)])
    order = Window.partitionBy("window").orderBy("n", "offset")
    ranked = shingles.join(counts, "shingle", "left").withColumn("n", F.coalesce("count", F.lit(0)))
    return ranked.withColumn("rank", F.row_number().over(order)).where("rank = 1 AND n > 0").select(
        "window", "len", "offset", "shingle")


def find_windows(docs, windows, block_rows=BLOCK_ROWS):
    """One row per document key: (doc_id, text_key, copies, n_words, hits).

    ``hits`` are the distinct (start, len, window) places that were verified.
    """
    shingles = window_shingles(windows)
    sizes = sorted(r.g for r in shingles.select("g").distinct().collect()) or [SHINGLE]  # at most SHINGLE
    prefixes = stored(rarest_shingles(docs, shingles, sizes, block_rows), "prefixes")
    # A document's own row joins a row without a window, once.
    own = docs.sparkSession.range(1).select(
        F.lit(None).cast("string").alias("window"), F.lit(0).alias("len"),
        F.lit(0).alias("offset"), F.lit(OWN_KEY).alias("shingle"))
    start = F.col("place") - F.col("offset")
    hit = (F.col("place") >= 0) & (start >= 0) & (start + F.col("len") <= F.size("w")) & (
        _slice("w", start + 1, F.col("len")) == F.col("window"))
    parts = []
    for i, block in enumerate(_blocks(prefixes, "shingle", block_rows)):
        table = block if i else block.unionByName(own)
        parts.append(doc_places(docs, sizes)
                     .join(F.broadcast(table), "shingle")
                     .where(F.when(F.col("window").isNull(), F.col("place") < 0).otherwise(hit))
                     .select("doc_id", "text_key",
                             F.when(F.col("place") < 0, F.size("w")).alias("n_words"),
                             F.when(F.col("place") >= 0, F.struct(start.alias("start"), F.col("len").alias("len"),
                                                                 F.col("window").alias("window"))).alias("hit")))
    return _union(parts).groupBy("doc_id", "text_key").agg(
        F.count("n_words").alias("copies"), F.max("n_words").cast("bigint").alias("n_words"),
        F.collect_set("hit").alias("hits"))


def spans(hits):
    """The distinct (start, end) places, in order."""
    return F.array_sort(F.array_distinct(F.transform(hits, lambda h: F.struct(
        h["start"].alias("start"), (h["start"] + h["len"]).alias("end")))))


def covered(places):
    """The number of words inside at least one of the places, which come in order."""
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    return F.aggregate(places, zero, lambda acc, s: F.struct(
        (acc["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(s["start"], acc["end"]))).alias("n"),
        F.greatest(acc["end"], s["end"]).alias("end")), lambda acc: acc["n"].cast("bigint"))


def contamination(docs, items, window=WINDOW, block_rows=BLOCK_ROWS):
    """Per distinct (doc_id, text): text_key (its hash), copies (rows), n_words, n_hit,
    items (sorted names), spans (word ranges) and contaminated."""
    windows = stored(item_windows(items, window=window), "windows")
    found = stored(find_windows(docs.select("doc_id", "text"), windows, block_rows)
                   .withColumn("windows", F.array_sort(F.array_distinct("hits.window")))
                   .withColumn("set", F.when(F.size("windows") > 0, F.sha2(F.array_join("windows", "\n").cast("binary"), 256))), "found")
    # The items of each distinct set of windows, once: many documents may share the windows of many items.
    sets = found.where("set IS NOT NULL").groupBy("set").agg(F.first("windows").alias("windows"))
    named = (sets.select("set", F.explode("windows").alias("window"))
             .join(windows, "window").select("set", F.explode("items").alias("item"))
             .groupBy("set").agg(F.collect_set(F.col("item").cast("string")).alias("items")))
    f, n = found.alias("f"), named.alias("n")
    joined = f.join(n, "set", "left").withColumn("spans", spans("f.hits"))
    none = F.array().cast("array<string>")
    return joined.select(
        "f.doc_id", "f.text_key", "f.copies", "f.n_words", covered("spans").alias("n_hit"),
        F.array_sort(F.coalesce("n.items", none)).alias("items"), "spans",
        (F.size("spans") > 0).alias("contaminated"))
