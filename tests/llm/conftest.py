import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Names that the operators use for columns of their own.
CLASHING = ["id", "row", "part", "k", "n", "token", "shard", "slot", "score", "cell", "bucket", "page", "key",
            "word", "kept", "text_key", "place", "w", "shingle", "g", "data", "cut", "rank", "symbols", "host", "hashes",
            "gone_0", "r_id", "key_0", "h", "first", "component", "row_id", "fim", "sequence_id", "length", "ids"]


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text) rows, with extra columns whose names clash."""
    def make(rows, clashing=True):
        df = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], SCHEMA)
        if clashing:
            for name in CLASHING:
                df = df.selectExpr("*", f"'x' AS {name}")
        return df
    return make


@pytest.fixture
def sf():
    return "/root/testdata/sf0.001"


def texts_of(spark, sf_dir):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
