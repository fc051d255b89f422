import os
import random
from collections import Counter, defaultdict
from itertools import product
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from reviewloom.llm import packing
from reviewloom.llm.queries import QUERIES

from .conftest import texts_of

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    made = Tokenizer.from_file(VOCABULARY)
    made.encode_special_tokens = True
    return made


@pytest.fixture(scope="module")
def ids_of():
    with open(VOCABULARY, encoding="utf-8") as file:
        encode = packing.encoder(file.read())
    return lambda text: np.frombuffer(encode(text), dtype="<u4").tolist()


# ---- tokens ----

ODD = ["", " ", "Don't STOP'LL 'Re", "É à µß ÿ ²³¼ ª", "\x1c\x1d\x85\xa0x\x00\x07", "İstanbul ǅ ΑΣ Σ", "日本語 😀‍👩", "é é ́x", "a<|endoftext|>b",
       "don''t 12345 ٣٤", "x" * 300, " 　a​b", "Ω Å ﬁ", "aͅᾳ"]


def test_ids_equal_the_library(tokenizer, ids_of, spark, sf):
    texts = ODD + [t for _, t in texts_of(spark, sf)]
    for text in texts:
        assert ids_of(text) == tokenizer.encode(text, add_special_tokens=False).ids, repr(text[:80])


@settings(max_examples=3000)
@given(st.text(alphabet=st.one_of(st.characters(max_codepoint=0xff), st.sampled_from(" \n'aeSTvml0²É\x85"),
                                  st.characters(exclude_categories=["Cs"])), max_size=15))
def test_random_ids_equal_the_library(tokenizer, ids_of, text):
    assert ids_of(text) == tokenizer.encode(text, add_special_tokens=False).ids


def test_chunks_change_nothing(tokenizer, ids_of, monkeypatch):
    text = " ".join(random.Random(3).choices(["ab", "É", "don't", "x\ny", "ΑΣ", "12", "́", "日本"], k=400))
    want = tokenizer.encode(text, add_special_tokens=False).ids
    for size in (1, 2, 7, 100):
        monkeypatch.setattr(packing, "TEXT_AT_ONCE", size)
        assert "".join(packing.chunks(text)) == text
        assert ids_of(text) == want


def test_other_tokenizers_are_used_as_they_are():
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        specification = file.read()
    own = Tokenizer.from_str(specification)
    got = np.frombuffer(packing.encoder(specification)("Some words, É!"), dtype="<u4").tolist()
    assert got == own.encode("Some words, É!", add_special_tokens=False).ids


# ---- the plan ----

@settings(max_examples=500)
@given(st.dictionaries(st.integers(1, 12), st.integers(0, 4), max_size=5), st.integers(0, 30))
def test_fullest_by_brute_force(counts, room):
    lengths = list(counts)
    sums = [sum(n * length for n, length in zip(some, lengths)) for some in product(*(range(counts[length] + 1) for length in lengths))]
    chosen = packing.fullest(counts, room)
    assert all(n <= counts[length] for length, n in chosen.items())
    assert sum(length * n for length, n in chosen.items()) == max(s for s in sums if s <= room)


@settings(max_examples=300)
@given(st.lists(st.integers(1, 20), max_size=60))
def test_plan_lays_every_piece_once(lengths):
    filled = packing.fill(Counter(lengths), 20)
    table = packing.lookup(filled)
    lengths = np.array(lengths, dtype=np.int64)
    seen, numbers = Counter(), np.empty(len(lengths), dtype=np.int64)
    for i, length in enumerate(lengths):
        numbers[i] = seen[length]
        seen[length] += 1
    check_layout(lengths, *packing.placed(table, lengths, numbers), 20)
    n = sum(times for times, _ in filled)
    assert n <= best_fit_decreasing(lengths, 20) and n >= -(-int(lengths.sum()) // 20)


def best_fit_decreasing(lengths, capacity):
    room = []
    for length in sorted(lengths, reverse=True):
        fits = [(r, i) for i, r in enumerate(room) if r >= length]
        if fits:
            room[min(fits)[1]] -= length
        else:
            room.append(capacity - length)
    return len(room)


def check_layout(lengths, sequence, offset, capacity):
    """Gapless from 0 in every sequence, and none too long."""
    laid = defaultdict(list)
    for n, s, o in zip(lengths, sequence, offset):
        laid[s].append((int(o), int(n)))
    for places in laid.values():
        end = 0
        for o, n in sorted(places):
            assert o == end
            end += n
        assert end <= capacity
    return len(laid)


def test_plan_is_small_for_any_counts():
    rng = random.Random(1)
    counts = {length: rng.choice([1, 10**6, 10**12, rng.randrange(10**9)]) for length in range(1, 2049)}
    filled = packing.fill(dict(counts), 2048)
    used = Counter()
    for times, lengths in filled:
        assert sum(length * n for length, n in lengths) <= 2048
        for length, n in lengths:
            used[length] += times * n
    assert used == counts
    assert len(filled) < 20_000
    total = sum(length * n for length, n in counts.items())
    least = max(total / 2048, sum(n for length, n in counts.items() if length > 1024))
    assert sum(times for times, _ in filled) <= 1.03 * least


# ---- Spark ----

def test_query_by_hand(spark, sf, tokenizer):
    got = QUERIES["op12_best_fit"](spark, sf)
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert dict(got.dtypes) | {"doc_id": "bigint", "piece": "int", "ids_crc32": "bigint", "sequence_id": "bigint"} == dict(got.dtypes)
    rows = got.collect()
    want = []
    for i, text in texts_of(spark, sf):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        for k, at in enumerate(range(0, len(ids), 2048)):
            part = np.array(ids[at:at + 2048], dtype="<u4")
            want.append((i, k, at, len(part), crc32(part.tobytes())))
    assert sorted(tuple(r)[:5] for r in rows) == sorted(want)
    lengths = [r.length for r in rows]
    n = check_layout(lengths, [r.sequence_id for r in rows], [r.offset for r in rows], 2048)
    assert n <= best_fit_decreasing(lengths, 2048)
    assert n <= max(-(-sum(lengths) // 2048) + 1, sum(length > 1024 for length in lengths))


def test_edges(spark, documents, tokenizer):
    rows = [(None, "null id"), (1, None), (2, ""), (3, "a b c"), (3, "a b c"), (4, "word " * 5000), (None, None), (5, "É" * 30_000)]
    for some in (rows, []):
        df = documents(some)
        pieces = packing.cut_documents(df, VOCABULARY, capacity=64).withColumn("row", F.lit("x")).withColumn("part", F.lit("y"))
        pieces = pieces.withColumn("a`b.c", F.lit(1)).withColumn("offset", F.lit(7))
        packed = packing.pack(pieces, capacity=64)
        assert packed.columns == [c for c in pieces.columns if c != "offset"] + ["sequence_id", "offset"]
        got = packed.collect()
        check_layout([r.length for r in got], [r.sequence_id for r in got], [r.offset for r in got], 64)
        assert {(r.row, r.part, r["a`b.c"]) for r in got} <= {("x", "y", 1)}
        ids = defaultdict(list)
        for r in got:
            assert len(r.ids) == 4 * r.length
            ids[r.doc_id, r.piece].append(bytes(r.ids))
        want = defaultdict(list)
        for i, text in some:
            all_ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [0], dtype="<u4")
            for k, at in enumerate(range(0, len(all_ids), 64)):
                want[i, k].append(all_ids[at:at + 64].tobytes())
        assert {k: sorted(v) for k, v in ids.items()} == {k: sorted(v) for k, v in want.items()}
        whole = packing.sequences(packed).collect()
        assert sum(r.length for r in whole) == sum(r.length for r in got)
        assert Counter(r.sequence_id for r in whole) == Counter({r.sequence_id for r in got})
        for r in whole:
            assert bytes(r.ids) == b"".join(bytes(p.ids) for p in sorted((p for p in got if p.sequence_id == r.sequence_id), key=lambda p: p.offset))


def test_lengths_beyond_the_capacity_are_refused(spark):
    for length in (0, 65, None):
        with pytest.raises(Exception, match="between 1 and 64"):
            packing.pack(spark.createDataFrame([(length,)], "length bigint"), capacity=64).collect()


def test_hot_length_over_many_parts(spark):
    df = spark.range(0, 6_000, numPartitions=16).select("id", F.when(F.col("id") % 3 == 0, 700).otherwise(F.col("id") % 2000 + 1).alias("length"))
    got = packing.pack(df).toPandas()
    n = check_layout(got.length, got.sequence_id, got.offset, 2048)
    assert len(got) == got.id.nunique() == 6_000
    assert n <= 1.005 * best_fit_decreasing(got.length, 2048)
