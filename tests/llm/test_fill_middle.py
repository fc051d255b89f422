import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reviewloom.llm import fill_middle as fim
from reviewloom.llm.queries import QUERIES

from .conftest import texts_of

UNITS = re.compile("[A-Za-z]+|[^A-Za-z]", re.DOTALL)


def by_hand(doc_id, text, seed=1):
    """(n, form, prefix_chars, middle_chars, output) straight from the definition."""
    text = text or ""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    units = UNITS.findall(text)
    n = len(units)
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = ("".join(units[x:y]) for x, y in ((0, a), (a, b), (b, n)))
    if h[3] % 100 < 20:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def cut(rows):
    """The operator's functions without Spark."""
    digests = [hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest() for i, _ in rows]
    hashes = np.array([[int(d[8 * k:8 * k + 8], 16) for d in digests] for k in range(4)], dtype=np.int64).reshape(4, -1)
    data, offsets = fim.buffer_of(pa.array([t or "" for _, t in rows], type=pa.string()))
    return fim.cut_texts(data, offsets, hashes)


def restored(made):
    data, offsets = fim.buffer_of(made.field("output"))
    return fim.join_texts(data, offsets, np.array(made.field("form").to_pylist(), dtype=object)).to_pylist()


EDGES = [(None, "null id"), (1, None), (2, ""), (3, "a <P> b"), (4, "<S"), (5, ">x"), (6, "<"), (7, "S>"), (8, "é"), (9, "日本語 abc 😀!"),
         (10, "word"), (11, " \n\t"), (12, "<M>"), (13, "x" * 5000 + " " + "é" * 5000), (7, "S>"), (7, "another"), (None, None)]


def test_edges_by_hand(spark, documents):
    for rows in (EDGES, EDGES[::-1], []):
        df = documents(rows).withColumn("output", F.lit("clash")).withColumn("form", F.lit("clash"))
        made = df.select("*", fim.fill_middle().alias("made"))
        back = made.select("doc_id", "text", "made.*", fim.restore("made.output", "made.form").alias("back")).collect()
        got = sorted(((r.doc_id, r.text, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in back), key=repr)
        assert got == sorted(((i, t, *by_hand(i, t)) for i, t in rows), key=repr)
        assert all(r.back == (r.text or "") for r in back)


TEXT = st.text(alphabet=st.sampled_from("ab <>PSMé日😀\n1"), max_size=12)


@settings(max_examples=400)
@given(st.lists(st.tuples(st.integers(-5, 10**12), TEXT), max_size=12), st.integers(1, 9), st.integers(1, 40))
def test_random_batches(rows, window, size):
    """Windows and slices of any size give what the definition gives."""
    before = fim.WINDOW, fim.SLICE
    fim.WINDOW, fim.SLICE = window, size
    try:
        made = cut(rows)
        assert made.to_pylist() == [dict(zip(("n", "form", "prefix_chars", "middle_chars", "output"), by_hand(*r))) for r in rows]
        assert restored(made) == [t for _, t in rows]
        offsets = fim.buffer_of(pa.array([t for _, t in rows], type=pa.string()))[1]
        ranges = list(fim.slices(offsets))
        assert [a for a, _ in ranges] == [0] + [b for _, b in ranges[:-1]] and ranges[-1][1] == len(rows)
    finally:
        fim.WINDOW, fim.SLICE = before


def test_every_form_occurs(spark, sf):
    rows = texts_of(spark, sf)
    forms = [by_hand(*r)[1] for r in rows]
    assert set(forms) == {"plain", "psm", "spm"}
    assert cut(rows).field("form").to_pylist() == forms


def test_long_text_in_bounded_time():
    text = "ab, é" * 2_000_000
    made = cut([(0, "x"), (3, text), (4, "y")])
    assert made.to_pylist()[1]["n"] == 8_000_000 and restored(made)[1] == text


def test_wrong_outputs_are_refused():
    for output, form in (("<P>a<S>b", "psm"), ("<P>a<S>b<M>c", "spm"), ("<P>a<S>b<M>c<M>", "psm"), ("a", "other")):
        data, offsets = fim.buffer_of(pa.array([output]))
        with pytest.raises(ValueError):
            fim.join_texts(data, offsets, np.array([form], dtype=object))


def test_query_by_hand(spark, sf):
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    got = QUERIES["op11_fill_middle"](spark, sf)
    assert got.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    want = []
    for i, text in texts_of(spark, sf):
        *fields, output = by_hand(i, text)
        want.append((i, *fields, sha(output), sha(text or "")))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
