import hashlib
import re

import pytest

from reviewloom.llm.decontaminate import contamination, item_windows

ITEM = "One two three four five six seven eight nine ten eleven twelve"


def words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute(docs, items):
    """(doc_id, n_words, n_hit, items) by sliding every window over every document."""
    windows = []
    for item, text in items:
        w = words(text)
        size = min(10, len(w))
        windows += [(item, w[i:i + size]) for i in range(len(w) - size + 1) if size]
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for item, window in windows:
            for i in range(len(w) - len(window) + 1):
                if w[i:i + len(window)] == window:
                    hit.update(range(i, i + len(window)))
                    found.add(str(item))
        out.append((doc_id, len(w), len(hit), sorted(found)))
    return out


def rows(found):
    return [(r.doc_id, r.n_words, r.n_hit, r["items"]) for r in found.collect() for _ in range(r.copies)]


def order(result):
    return sorted(result, key=repr)


CASES = [
    (1, ITEM), (2, "x " + ITEM.upper() + ", y"), (3, " ".join(ITEM.split()[:10])), (4, " ".join(ITEM.split()[:9])),
    (5, "a " + ITEM + " b " + ITEM), (6, None), (7, ""), (8, "!!! ..."), (9, "uno-dos"), (10, "uno dos tres"),
    (10, "uno dos tres"), (10, ITEM), (None, "uno dos"), (None, None), (11, "solo"), (12, "É é ÉCOLE école a"),
    (13, "no windows here at all " * 400), (14, "the the the the the"),
]
ITEMS = [(100, ITEM), (20, "uno DOS"), (3, "solo"), (4, None), (5, ""), (6, "É"), (7, "the the"), (7, "the the"),
         (8, " ".join(ITEM.split()[1:]) + " thirteen")]


@pytest.mark.parametrize("block_rows", [1, 3, 100_000])
def test_against_sliding_windows(spark, documents, block_rows):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string").selectExpr("*", "1 AS w", "2 AS len")
    got = rows(contamination(documents(CASES), items, block_rows=block_rows))
    assert order(got) == order(brute(CASES, ITEMS))


def test_spans_and_flag(spark, documents):
    items = spark.createDataFrame([(1, "b c"), (2, "c d")], "item_id bigint, text string")
    row = contamination(documents([(1, "a b c d e b c")]), items).first()
    assert [tuple(s) for s in row.spans] == [(1, 3), (2, 4), (5, 7)] and row.n_hit == 5 and row.contaminated


def test_empty_tables(spark, documents):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    assert contamination(documents([]), items).count() == 0
    none = contamination(documents(CASES), items.limit(0))
    assert none.where("contaminated OR n_hit > 0").count() == 0
    assert sum(r.copies for r in none.collect()) == len(CASES)


def test_null_item_id_is_found_without_a_name(spark, documents):
    items = spark.createDataFrame([(None, "b c")], "item_id bigint, text string")
    row = contamination(documents([(1, "a b c")]), items).first()
    assert row["items"] == [] and row.contaminated


def test_windows_of_an_item(spark):
    items = spark.createDataFrame([(1, ITEM), (2, ITEM)], "item_id bigint, text string")
    got = {r.window: (r.len, tuple(sorted(r["items"]))) for r in item_windows(items).collect()}
    assert len(got) == 3 and set(got.values()) == {(10, (1, 2))}


def test_query_digest(spark, sf):
    from reviewloom.llm.queries import QUERIES
    row = QUERIES["op1_decontaminate"](spark, sf).where("n_items = 0").first()
    assert row.items_sha256 == hashlib.sha256(b"").hexdigest()


def test_plan_is_native(spark, sf):
    from reviewloom.llm.queries import QUERIES
    for name in ("op1_decontaminate", "op2_shard"):
        plan = QUERIES[name](spark, sf)._jdf.queryExecution().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_items_of_shared_windows_are_resolved_once(spark):
    """300 documents that hold a window which 300 items share: one set, of 300 items."""
    line = " ".join(f"w{i}" for i in range(10))
    docs = spark.createDataFrame([(i, f"{line} {i}") for i in range(300)], "doc_id bigint, text string")
    items = spark.createDataFrame([(f"i{i}", line) for i in range(300)], "item_id string, text string")
    got = contamination(docs, items).collect()
    assert len(got) == 300 and all(sorted(r["items"]) == sorted(f"i{i}" for i in range(300)) and r.n_hit == 10 for r in got)
