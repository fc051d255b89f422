import hashlib
import math
import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from reviewloom.llm import target_sample as ts
from reviewloom.llm.queries import QUERIES

from .conftest import texts_of

WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words_of(text):
    return WORDS.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def buckets_of(text):
    words = words_of(text)
    return [crc32(f.encode()) % 10_000 for f in words + [f"{a} {b}" for a, b in zip(words, words[1:])]]


def by_hand(docs, target, min_words=20, share=25):
    """(doc_id, n_features, weight, score, rank) straight from the definition."""
    raw, wanted = Counter(), Counter()
    for _, text in docs:
        raw.update(buckets_of(text))
    for text in target:
        wanted.update(buckets_of(text))
    s, t = sum(raw.values()), sum(wanted.values())
    gain = {b: math.floor(1000 * math.log((wanted[b] + 1) * (s + 10_000) / ((raw[b] + 1) * (t + 10_000)))) for b in raw}
    rows = []
    for i, text in docs:
        found = [gain[b] for b in buckets_of(text)]
        weight = sum(found) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, len(found), weight, score, None, len(words_of(text)) >= min_words])
    able = sorted((r for r in rows if r[5]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, row in enumerate(able[:share * len(able) // 100], 1):
        row[4] = rank
    return sorted((tuple(r[:5]) for r in rows), key=repr)


@settings(max_examples=500)
@given(st.text(alphabet=st.sampled_from("aBé日😀 .9-\x7f\n"), max_size=25), st.integers(1, 30))
def test_buckets_by_hand(text, at_once):
    before, ts.TEXT_AT_ONCE = ts.TEXT_AT_ONCE, at_once
    try:
        n, found = ts.feature_buckets(text, ts.offset_pairs())
        assert n == len(words_of(text)) and sorted(found.tolist()) == sorted(buckets_of(text))
    finally:
        ts.TEXT_AT_ONCE = before


def test_long_text():
    text = "Ab cdé " * 700_000
    n, found = ts.feature_buckets(text, ts.offset_pairs())
    assert n == 1_400_000 and Counter(found.tolist()) == Counter(
        {crc32(b"ab") % 10_000: 700_000, crc32("cdé".encode()) % 10_000: 700_000, crc32("ab cdé".encode()) % 10_000: 700_000,
         crc32("cdé ab".encode()) % 10_000: 699_999})
    assert ts.feature_buckets("x" * 3_000_000, ts.offset_pairs())[0] == 1


def rows_of(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=repr)


def test_query_by_hand(spark, sf):
    target = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    got = QUERIES["op13_target_sample"](spark, sf)
    assert {t for _, t in got.dtypes} == {"bigint"}
    assert rows_of(got) == by_hand(texts_of(spark, sf), target)


def made_up(n, seed=1):
    rng = random.Random(seed)
    words = ["ab", "Cd", "é", "x9", "the", "of", "日本"]
    return [(i, " ".join(rng.choices(words, k=rng.randrange(0, 40)))) for i in range(n)]


def test_edges(spark, documents):
    rows = made_up(60) + [(None, None), (100, None), (101, ""), (102, " ., "), (103, "word " * 30), (104, "Word, " * 30)]
    target = spark.createDataFrame([("the ab the ab",), (None,), ("",)], "text string")
    got = ts.draw(documents(rows), target)
    assert got.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    assert rows_of(got) == by_hand(rows, ["the ab the ab"])
    assert rows_of(ts.draw(documents(rows), target.limit(0))) == by_hand(rows, [])
    assert rows_of(ts.draw(documents([]), target)) == []
    few = [(1, "a b"), (2, None)]
    assert rows_of(ts.draw(documents(few), target)) == by_hand(few, ["the ab the ab"])


def test_repeated_rows_and_null_ids_are_drawn_as_rows(spark, documents, monkeypatch):
    monkeypatch.setattr(ts, "CUT_ROWS", 40)
    text = " ".join(["word"] * 25)
    rows = [(None, text)] * 100 + [(7, text)] * 200 + made_up(100)
    got = ts.draw(documents(rows), spark.createDataFrame([("word",)], "text string")).collect()
    assert len(got) == 400
    able = [r for r in got if r.n_words >= 20]
    ranks = sorted(r["rank"] for r in got if r["rank"] is not None)
    assert ranks == list(range(1, 25 * len(able) // 100 + 1))
    order = sorted(able, key=lambda r: (r["rank"] is None, r["rank"]))
    keys = [(-r.score, r.doc_id is None, r.doc_id or 0) for r in order]
    assert keys[:len(ranks)] == sorted(keys)[:len(ranks)]


def test_gains_prefer_the_target():
    raw, target = np.array([10**6, 10**6] + [0] * 9998), np.array([0, 10**5] + [0] * 9998)
    gain = ts.gains(raw, target)
    assert gain[1] > 0 > gain[0]
    with pytest.raises(IndexError):
        gain[10_000]
