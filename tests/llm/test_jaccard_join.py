import random
import time
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from reviewloom.llm import jaccard_join as jj
from reviewloom.llm.components import connected


def shingle_set(text):
    w = (text or "").encode().lower().split()
    k = min(5, len(w))
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if w else frozenset()


def brute(docs):
    """(doc_id, n_shingles, component_id) by comparing all pairs."""
    sets = [shingle_set(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= 75 * (len(a) + len(sets[j]) - both):
                root[find(i)] = find(j)
    groups = defaultdict(list)
    for i in range(len(docs)):
        groups[find(i)].append(docs[i][0])
    low = {r: min((x for x in ids if x is not None), default=None) for r, ids in groups.items()}
    return sorted(((d, len(sets[i]), low[find(i)]) for i, (d, _) in enumerate(docs)), key=repr)


def got(df):
    return sorted(map(tuple, df.collect()), key=repr)


def corpus(seed, n_base=12, copies=12, length=(4, 90)):
    """Texts, and copies of them with some words changed: similarities on both sides of the threshold."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(60)}"
    passage = [word() for _ in range(50)]
    docs = []
    for _ in range(n_base):
        base = [word() for _ in range(rng.randrange(*length))]
        if rng.random() < 0.5:
            base = base[:20] + passage
        for _ in range(rng.randrange(1, copies)):
            text = list(base)
            for _ in range(rng.randrange(0, 1 + len(text) // 25)):
                text[rng.randrange(len(text))] = word()
            docs.append(" ".join(text))
    rng.shuffle(docs)
    return list(enumerate(docs))


@pytest.mark.parametrize("seed, page", [(1, 2048), (2, 2048), (3, 3)])
def test_against_all_pairs(spark, documents, seed, page):
    docs = corpus(seed)
    assert got(jj.jaccard_components(documents(docs), page=page)) == brute(docs)


def test_threshold_is_exact(documents):
    """Seven shingles, six shared: 6 / 8 is on the threshold. Five of seven: 5 / 9 is not."""
    a = "a b c d e f g h i j k"
    docs = [(1, a), (2, "a b c d e f g h i j z"), (3, "q r s t u v w x y z k"), (4, "q r s t u v w x y m n")]
    assert got(jj.jaccard_components(documents(docs))) == brute(docs) == [
        (1, 7, 1), (2, 7, 1), (3, 7, 3), (4, 7, 4)]


CASES = [(5, None), (6, ""), (7, " \t\n"), (8, "one two"), (3, "ONE  two"), (9, "one two three"), (10, "É a b c d e"), (11, "é a b c d e"),
         (12, "x y z w v " * 6_000), (2, "x y z w v " * 6_000), (None, "one two"), (None, "null null"), (13, "one two"), (13, "one two"),
         (14, " ".join(f"t{i}" for i in range(30_000))), (15, " ".join(f"t{i}" for i in range(29_000)))]


def test_edge_rows(documents):
    assert got(jj.jaccard_components(documents(CASES))) == brute(CASES)
    assert jj.jaccard_components(documents([])).count() == 0
    assert jj.jaccard_components(documents([(1, None)])).collect() == [(1, 0, 1)]


def test_hot_group_of_near_copies(documents):
    """A third of the rows are near copies, another third exact ones."""
    rng = random.Random(5)
    base = [f"b{i}" for i in range(80)]
    docs = []
    for i in range(240):
        text = list(base)
        if i % 3 == 0:
            text[rng.randrange(80)] = f"x{i}"
        elif i % 3 == 2:
            text = [f"u{i}_{j}" for j in range(30)]
        docs.append((1000 - i, " ".join(text)))
    assert got(jj.jaccard_components(documents(docs), page=16)) == brute(docs)


def brute_links(docs):
    """(number of linked pairs of rows, (doc_id, n_shingles, n_links)) by comparing all pairs."""
    sets, n = [shingle_set(t) for _, t in docs], [0] * len(docs)
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= 75 * (len(a) + len(sets[j]) - both):
                n[i] += 1
                n[j] += 1
    return sum(n) // 2, sorted(((d, len(s), m) for (d, _), s, m in zip(docs, sets, n)), key=repr)


def near_copies():
    """Different near copies, all in one component, and copies of some."""
    base = [f"b{i}" for i in range(60)]
    docs = [" ".join([*base[:i], f"x{i}", *base[i + 1:]]) for i in range(0, 60, 2)]
    return list(enumerate(docs + docs[:5] + [" ".join(base)] * 3))


@pytest.mark.parametrize("docs, page", [(corpus(1), 2048), (corpus(2), 3), (near_copies(), 8), (CASES, 512)])
def test_links_within_components(documents, monkeypatch, docs, page):
    total, counts = brute_links(docs)
    assert got(jj.link_counts(documents(docs), page=page)) == counts
    monkeypatch.setattr(jj.verified, "__defaults__", (4, False))
    links = jj.jaccard_links(documents(docs), page=page).collect()
    classes = Counter(s for s in (shingle_set(t) for _, t in docs) if s)
    assert total == sum(r.rows_a * r.rows_b for r in links) + sum(m * (m - 1) // 2 for m in classes.values())


def test_no_links(documents):
    assert jj.jaccard_links(documents([])).count() == 0
    assert jj.link_counts(documents([(1, None)])).collect() == [(1, 0, 0)]


def test_whole_table(spark, sf):
    from reviewloom.llm.queries import QUERIES
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert got(QUERIES["op6_jaccard_join"](spark, sf)) == brute(docs)


def test_prefixes_of_similar_sets_meet():
    rng = np.random.default_rng(2)
    for _ in range(300):
        n = int(rng.integers(1, 60))
        a = np.unique(rng.integers(0, 1 << 60, n, dtype=np.uint64))
        gone = int(rng.integers(0, len(a) // 4 + 1))
        b = np.unique(np.append(rng.permutation(a)[gone:], rng.integers(0, 1 << 60, int(rng.integers(0, n // 4 + 1)), dtype=np.uint64)))
        both = len(np.intersect1d(a, b))
        if 100 * both >= 75 * (len(a) + len(b) - both):
            frequent = np.sort(rng.permutation(a)[: len(a) // 2])
            assert len(np.intersect1d(jj.prefix(a, frequent), jj.prefix(b, frequent)))


def test_bound_is_never_below_the_overlap():
    rng = np.random.default_rng(3)
    for _ in range(100):
        a, b = (np.unique(rng.integers(0, 500, 80).astype(np.uint64) * jj.MULTIPLIER) for _ in "ab")
        assert np.minimum(jj.point(a), jj.point(b)).sum() >= len(np.intersect1d(a, b))


@pytest.mark.parametrize("n, m", [(1, 1), (2, 90), (300, 7), (400, 400)])
def test_tree_finds_all_pairs_within_the_bound(n, m):
    rng = np.random.default_rng(n)
    base = rng.integers(0, 6, (8, jj.GROUPS))
    make = lambda k: (base[rng.integers(0, 8, k)] + (rng.random((k, jj.GROUPS)) < 0.1)).astype(np.uint8)
    a, b = make(n), make(m)
    ca, cb = rng.integers(0, 5, n), rng.integers(0, 5, m)
    pairs = lambda x, cx, y, cy: {
        (i, j) for i in range(len(x)) for j in range(len(y))
        if cx[i] != cy[j] and 7 * np.minimum(x[i], y[j]).sum(dtype=int) >= 3 * (x[i].sum(dtype=int) + y[j].sum(dtype=int))}
    ta, tb = jj.Tree(a, a.sum(axis=1, dtype=int), ca), jj.Tree(b, b.sum(axis=1, dtype=int), cb)
    assert set(zip(*(x.tolist() for x in jj.tree_join(ta, tb)))) == pairs(a, ca, b, cb)
    own = [tuple(sorted(p)) for p in zip(*(x.tolist() for x in jj.tree_join(ta)))]
    assert len(own) == len(set(own)) and set(own) == {p for p in pairs(a, ca, a, ca) if p[0] < p[1]}


def test_stars_run_across_batches():
    """(token, n, k): a copy counts once, and a step in size of more than a third ends a block."""
    rows = [(1, 9, 5), (2, 6, 1), (2, 6, 1), (2, 7, 3), (2, 8, 0), (2, 8, 0), (2, 11, 2), (2, 12, 9), (3, 30, 1), (3, 40, 2), (3, 54, 7), (4, 9, 9)]
    want = [(2, 1, 3, 1), (2, 1, 0, 2), (2, 2, 9, 1), (3, 1, 2, 1)]
    for size in range(1, len(rows) + 1):
        batches = [pa.record_batch({name: pa.array(column, pa.int64()) for name, column in zip("tnk", zip(*part))})
                   for part in (rows[i:i + size] for i in range(0, len(rows), size))]
        out = [tuple(r.values()) for b in jj.star_batches(iter(batches)) for r in b.to_pylist()]
        assert out == want, size


@pytest.mark.parametrize("links", [
    [], [(1, 2)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 30)], [(3, 3), (5, 4), (4, 5), (9, 1)],
    [(i, 2 * i) for i in range(1, 40)], [(-5, 7), (7, 100), (50, 100)]])
def test_components(spark, links):
    frame = spark.createDataFrame(links, "a bigint, b bigint")
    parent = {x: x for link in links if link[0] != link[1] for x in link}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in links:
        if a != b:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    assert {tuple(r) for r in connected(frame).collect()} == {(x, find(x)) for x in parent}


def near_copies(n, seed=5):
    """n texts, each with one near copy among the others."""
    rng = random.Random(seed)
    out = []
    for _ in range(n // 2):
        words = [f"w{rng.randrange(10**6)}" for _ in range(40)]
        out += [" ".join(words), " ".join([*words[:-1], "end"])]
    return out


def test_equal_and_null_ids_take_no_longer(spark, tmp_path):
    """Rows that share an id are fetched by their own text; joined by id alone, 2,000 of them were two million."""
    texts, took = near_copies(2000), {}
    for kind, ids in (("first", range(2000)), ("unique", range(2000)), ("one", [7] * 2000), ("null", [None] * 2000)):
        path = str(tmp_path / kind)
        spark.createDataFrame(list(zip(ids, texts)), "doc_id bigint, text string").write.parquet(path)
        since = time.monotonic()
        rows = jj.jaccard_groups(spark.read.parquet(path)).collect()
        took[kind] = time.monotonic() - since
        sizes = Counter(r.component for r in rows)
        assert len(rows) == 2000 and len(sizes) == 1000 and set(sizes.values()) == {2}
    assert max(took["one"], took["null"]) < 2 * took["unique"] + 3, took


def test_many_rows_with_the_same_id_and_text(spark):
    texts = near_copies(6)
    rows = [(None, texts[0])] * 300 + [(3, t) for t in texts] * 50 + [(3, texts[1])] * 200
    got = jj.jaccard_groups(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)).collect()
    assert Counter(Counter(r.component for r in got).values()) == Counter([300 + 100 + 200, 100, 100])


def test_pairs_of_a_hub_are_dealt_to_many_pages(spark):
    """Whichever side of its pairs the hub stands on."""
    for hub in (-5, 10**6):
        pairs = spark.createDataFrame([(min(hub, i), max(hub, i)) for i in range(1000)], "a bigint, b bigint")
        dealt = jj.dealt_pairs(pairs, 50, False).collect()
        assert sorted((r.a, r.b) for r in dealt) == sorted((min(hub, i), max(hub, i)) for i in range(1000))
        sizes = Counter(r.page for r in dealt)
        assert len(sizes) == 21 and max(sizes.values()) < 100


def test_every_document_counts_for_the_order(spark):
    """60,000 documents, of which 6 must share a shingle for it to be frequent: 7 share some, 5 others."""
    phrases = {f"p{i} of each some words": 7 if i % 2 else 5 for i in range(100)}
    rows = spark.createDataFrame(
        [(None, 0, f"{phrase} u{i}x{j}".encode()) for i, (phrase, n) in enumerate(phrases.items()) for j in range(n)]
        + [(i, 0, f"single{i}".encode()) for i in range(59_400)], "id bigint, h bigint, text binary")
    wanted = [jj.shingles(phrase.encode())[0] >> np.uint64(jj.COUNT_SHIFT) for phrase, n in phrases.items() if n == 7]
    assert list(jj.frequent_shingles(rows.repartition(16))) == sorted(wanted)


def test_counts_of_numbers_are_exact(monkeypatch):
    monkeypatch.setattr(jj, "COUNT_SHINGLES", 50)
    rng, texts = np.random.default_rng(5), []
    for i in range(400):
        texts.append(" ".join(f"w{x}" for x in rng.integers(0, 6, rng.integers(1, 12))).encode())
    found = {}
    for text in {jj.shingles(t).tobytes() for t in texts}:
        for member in np.frombuffer(text, dtype=np.uint64):
            found[int(member >> np.uint64(32))] = found.get(int(member >> np.uint64(32)), 0) + 1
    for pieces in (1, 3, 16):
        batches = jj.number_batches(pieces)([pa.RecordBatch.from_arrays([pa.array(texts[i:i + 90])], names=["text"]) for i in range(0, 400, 90)])
        rows = sorted((r for b in batches for r in zip(*(c.to_pylist() for c in b.columns))), key=lambda r: r[0])
        again = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["piece", "once", "more", "counts"])
        for least in (1, 3):
            got = [pair for b in jj.frequent_batches(least)([again]) for pair in zip(*(c.to_pylist() for c in b.columns))]
            assert sorted(got) == sorted((k, n) for k, n in found.items() if n >= least)


def test_large_corpus_orders_by_lower_counts(spark):
    """Of 120,000 documents not 12 must share a shingle for it to be frequent, but 8."""
    rows = spark.range(0, 120_000, numPartitions=8).selectExpr("id", "0L AS h", "cast(concat('single', id) AS binary) AS text")
    phrases = {f"p{i} of each some words": 8 if i % 2 else 7 for i in range(100)}
    shared = spark.createDataFrame([(None, 0, f"{phrase} u{i}x{j}".encode()) for i, (phrase, n) in enumerate(phrases.items()) for j in range(n)],
                                   "id bigint, h bigint, text binary")
    wanted = [jj.shingles(phrase.encode())[0] >> np.uint64(jj.COUNT_SHIFT) for phrase, n in phrases.items() if n == 8]
    assert list(jj.frequent_shingles(rows.unionByName(shared))) == sorted(wanted)


def test_numbers_and_points_are_shuffled_packed():
    rng = np.random.default_rng(3)
    numbers = np.unique(rng.integers(0, 1 << 32, 200_000, dtype=np.uint32))
    for some in (numbers, numbers[:1], numbers[:0], np.array([0, 1, (1 << 32) - 1], dtype=np.uint32)):
        assert np.array_equal(jj.from_steps(jj.steps(some)), some)
    assert len(jj.steps(numbers)) < 0.7 * numbers.nbytes
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 10**6, n)).encode() for n in (1, 30, 500, 5000)]
    rows = pa.RecordBatch.from_arrays([pa.array(range(4)), pa.array(range(4)), pa.array(texts)], names=["id", "h", "text"])
    batch, = jj.set_batches(type("Shared", (), {"value": np.zeros(0, dtype=np.uint64)}))([rows])
    points = batch.column("point").to_pylist()
    assert np.array_equal(jj.unpacked(points), [jj.point(jj.shingles(t)) for t in texts])
    assert sum(map(len, points)) < 0.5 * jj.GROUPS * len(points)


def test_members_of_large_blocks_need_no_join(spark):
    """(token, n, k), in batches of any size, to the members of blocks of three or more."""
    rows = [(1, 9, 5), (2, 6, 1), (2, 6, 1), (2, 7, 3), (2, 8, 0), (2, 8, 0), (2, 8, 4), (2, 11, 2), (2, 12, 9), (3, 30, 1), (3, 40, 2), (3, 41, -7), (4, 9, 9)]
    want = [(2, 1, 0), (2, 1, 1), (2, 1, 3), (2, 1, 4), (3, 1, -7), (3, 1, 1), (3, 1, 2)]
    for size in range(1, len(rows) + 1):
        batches = [pa.record_batch({name: pa.array(column, pa.int64()) for name, column in zip("tnk", zip(*part))})
                   for part in (rows[i:i + size] for i in range(0, len(rows), size))]
        stars = [tuple(r.values()) for b in jj.mated_batches(iter(batches)) for r in b.to_pylist()]
        members = jj.members_of(spark.createDataFrame(stars, jj.STARS))
        assert sorted(map(tuple, members.collect())) == want, size
    assert "Exchange" not in members._jdf.queryExecution().executedPlan().toString()
