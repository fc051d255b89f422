import hashlib
import re
from collections import defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewloom.llm import common
from reviewloom.llm.exact_dedup import build_index, exact_groups, split_depths
from reviewloom.session import work_dir


def brute(docs):
    groups = defaultdict(list)
    for doc_id, text in docs:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(doc_id)
    out = []
    for text, ids in groups.items():
        ids = sorted(ids, key=lambda i: (i is None, i))
        sha = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, ids[0], len(ids), place == 0, sha) for place, i in enumerate(ids)]
    return out


def order(rows):
    return sorted(map(tuple, rows), key=repr)


CASES = [(5, "a  b"), (3, "a\tb"), (4, "a\x0b\x0cb"), (1, None), (2, ""), (6, " "), (7, "  \n"), (8, "a b"), (8, "a b"),
         (None, "a b"), (None, "z"), (None, "z"), (9, "a b"), (10, "y" * 200_000), (11, "y" * 200_000), (12, "A b")]


@pytest.mark.parametrize("bucket_bytes", [None, 40])
def test_small_cases(documents, bucket_bytes):
    assert order(exact_groups(documents(CASES), bucket_bytes=bucket_bytes).collect()) == order(brute(CASES))


@pytest.mark.parametrize("bucket_bytes", [None, 200])
def test_keys_that_collide(documents, bucket_bytes):
    """All texts on one key: pages, chains and the second round do all the work."""
    docs = CASES + [(100 + i, f"t{i % 7}") for i in range(60)]
    got = exact_groups(documents(docs), bucket_bytes=bucket_bytes, key=lambda text: F.lit(7).cast("bigint"))
    assert order(got.collect()) == order(brute(docs))


def test_hot_group_is_paged(documents):
    docs = [(i, "same text" if i % 3 else f"own {i}") for i in range(600)]
    cells, entries = build_index(documents(docs), bucket_bytes=1500)
    pages = entries.groupBy("bucket", "page").count()
    assert cells.where("pages > 1").count() >= 1
    assert pages.agg(F.max("count")).first()[0] < 120
    assert order(exact_groups(documents(docs), bucket_bytes=1500).collect()) == order(brute(docs))


@pytest.fixture
def many_partitions(spark):
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "160")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("bucket_bytes", [None, 1500])
def test_few_files(spark, documents, many_partitions, bucket_bytes):
    """Every file starts a helper program on a local file system, with which the executor's memory counts twice for a moment."""
    docs = [(i, "same text" if i % 3 else f"own {i} " + "x" * 3000) for i in range(1200)]
    folder = Path(work_dir(spark, "any")).parent
    before = set(folder.glob("llm-dedup-*"))
    out = Path(work_dir(spark, "few-files").removeprefix("file:"))
    exact_groups(documents(docs), bucket_bytes=bucket_bytes).write.parquet(str(out))
    assert order(spark.read.parquet(str(out)).collect()) == order(brute(docs))
    written = [out, *set(folder.glob("llm-dedup-*")) - before]
    assert len(written) == 3
    assert max(len(list(path.glob("*.parquet"))) for path in written) <= common.few_files(spark) == 20


def test_large_tables_keep_their_tasks(spark, documents, many_partitions, monkeypatch):
    monkeypatch.setattr(common, "FILE_BYTES", 4000)
    docs = [(i, f"own {i} " + "x" * 3000) for i in range(100)]
    _, entries = build_index(documents(docs), bucket_bytes=3000)
    files = len(entries.inputFiles())
    assert common.few_files(spark) < files <= 75
    assert entries.count() == 100


def test_empty_table(documents):
    assert exact_groups(documents([])).count() == 0


def test_directory_doubles_only_where_needed():
    load = np.zeros(16)
    load[3], load[12] = 100, 10
    depth = split_depths(load, 50)
    assert depth[3] == 4 and depth[2] == 4 and depth[0] == 3 and depth[12] == 1
    assert split_depths(np.ones(16), 100).max() == 0
    # Every bucket that could be split fits.
    load = np.random.default_rng(1).random(64)
    depth = split_depths(load, 2)
    for d in range(7):
        cells = np.flatnonzero(depth == d)
        for prefix in set(cells >> (6 - d)):
            assert load[cells[cells >> (6 - d) == prefix]].sum() <= 2
