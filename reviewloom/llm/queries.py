"""The registered corpus queries and the SQL that states their answers.

Each query derives the columns of its contract from its operator's own result.
"""

import public_tokenizers
from pyspark.sql import functions as F

from . import hmm, toxicity
from .bpe import round_trip
from .common import LOWER, UPPER, table
from .decontaminate import contamination
from .exact_dedup import exact_groups
from .fill_middle import fill_middle, restore
from .html_text import extract_text
from .jaccard_join import jaccard_components
from .licenses import license_report
from .packing import cut_documents, pack
from .quality import resample
from .sharding import shard_documents
from .target_sample import draw

QUERIES, ORACLE = {}, {}


def query(sql=None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE[fn.__name__] = sql
        return fn
    return add


#: DuckDB: the words of ``text`` in lower case.
SQL_WORDS = (r"regexp_extract_all(translate(coalesce(text, ''), '%s', '%s'), "
             r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')" % (UPPER, LOWER))


@query(f"""
WITH d AS (SELECT doc_id, {SQL_WORDS} AS w FROM documents),
i AS (SELECT item_id, {SQL_WORDS} AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, k, array_to_string(w[s:s + k - 1], ' ') AS win
       FROM (SELECT item_id, w, k, unnest(generate_series(1, len(w) - k + 1)) AS s
             FROM (SELECT item_id, w, least(len(w), 10) AS k FROM i WHERE len(w) > 0))),
dw AS (SELECT doc_id, k, s, array_to_string(w[s:s + k - 1], ' ') AS win
       FROM (SELECT doc_id, w, k, unnest(generate_series(1, len(w) - k + 1)) AS s
             FROM d, (SELECT DISTINCT k FROM iw) WHERE len(w) >= k)),
h AS (SELECT dw.doc_id, dw.s, dw.k, iw.item_id FROM dw JOIN iw USING (k, win)),
n AS (SELECT doc_id, count(DISTINCT p) AS n_hit
      FROM (SELECT doc_id, unnest(generate_series(s, s + k - 1)) AS p FROM h) GROUP BY doc_id),
m AS (SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items
      FROM (SELECT DISTINCT doc_id, item_id FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN m USING (doc_id)
""")
def op1_decontaminate(spark, sf_dir):
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return (found.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies"))).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated"))


@query()
def op2_shard(spark, sf_dir):
    """No SQL: the shards are drawn at random."""
    return shard_documents(table(spark, sf_dir, "documents"), shards=8)


@query(r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM d WINDOW g AS (PARTITION BY t)
""")
def op3_exact_dedup(spark, sf_dir):
    return exact_groups(table(spark, sf_dir, "documents"))


@query()
def op4_main_text(spark, sf_dir):
    """No SQL: HTML is a nested language."""
    return extract_text(table(spark, sf_dir, "pages")).select(
        "page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


@query()
def op5_toxicity(spark, sf_dir):
    """No SQL: weights are fitted step by step."""
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op6_jaccard_join(spark, sf_dir):
    """No SQL: it takes too long to join all shingles of whole tables."""
    return jaccard_components(table(spark, sf_dir, "documents"))


@query()
def op7_byte_bpe(spark, sf_dir):
    """No SQL: merges are applied in the order of their ranks."""
    return round_trip(table(spark, sf_dir, "documents"),
                      public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query()
def op8_licenses(spark, sf_dir):
    """No SQL: expressions are nested."""
    return license_report(table(spark, sf_dir, "documents"))


@query()
def op9_hmm_score(spark, sf_dir):
    """No SQL: the model is fitted step by step."""
    return hmm.score_documents(table(spark, sf_dir, "documents"))


@query()
def op10_importance(spark, sf_dir):
    """No SQL: the n-grams are hashed."""
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
                  sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
k AS (SELECT *, CAST(len(u) AS BIGINT) AS n, list_transform([1, 9, 17, 25], lambda i: CAST('0x' || substr(h, i, 8) AS BIGINT)) AS hs FROM d),
c AS (SELECT *, least(hs[1] % (n + 1), hs[2] % (n + 1)) AS a, greatest(hs[1] % (n + 1), hs[2] % (n + 1)) AS b,
             CASE WHEN text = '' OR regexp_matches(text, '<[PSM]>') OR hs[3] % 100 >= 90 THEN 'plain'
                  WHEN hs[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM k),
p AS (SELECT *, array_to_string(u[1:a], '') AS pre, array_to_string(u[a + 1:b], '') AS mid, array_to_string(u[b + 1:n], '') AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                   ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(text) AS restored_sha256
FROM p
""")
def op11_fill_middle(spark, sf_dir):
    made = table(spark, sf_dir, "documents").select("doc_id", fill_middle().alias("fim"))
    sha = lambda text: F.sha2(F.col(text).cast("binary"), 256)
    return (made.select("doc_id", "fim.*", restore("fim.output", "fim.form").alias("restored"))
            .select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                    sha("output").alias("output_sha256"), sha("restored").alias("restored_sha256")))


@query()
def op12_best_fit(spark, sf_dir):
    """No SQL: the tokens come from a vocabulary, the sequences from a dynamic program."""
    pieces = cut_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pack(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))


#: DuckDB: words and pairs of neighbouring words.
SQL_FEATURES = ("unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS feature")


@query(f"""
WITH crc AS (SELECT list(c ORDER BY i) AS tab FROM (
       SELECT i, list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS c
       FROM (SELECT unnest(range(256)) AS i))),
d AS (SELECT doc_id, {SQL_WORDS} AS w FROM documents),
df AS (SELECT doc_id, {SQL_FEATURES} FROM d),
bf AS (SELECT {SQL_FEATURES} FROM (SELECT {SQL_WORDS} AS w FROM benchmark)),
h AS (SELECT feature, hex(encode(feature)) AS h FROM (SELECT feature FROM df UNION SELECT feature FROM bf)),
b AS (SELECT feature, xor(list_reduce(list_transform(range(1, length(h), 2), lambda i: CAST('0x' || substr(h, i, 2) AS BIGINT)),
                                      lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255) + 1]), 4294967295), 4294967295) % 10000 AS bucket
      FROM h, crc),
r AS (SELECT bucket, count(*) AS n FROM df JOIN b USING (feature) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM bf JOIN b USING (feature) GROUP BY bucket),
g AS (SELECT bucket, CAST(floor(1000 * ln(CAST(coalesce(t.n, 0) + 1 AS DOUBLE) * ((SELECT count(*) FROM df) + 10000)
                                 / (CAST(r.n + 1 AS DOUBLE) * ((SELECT count(*) FROM bf) + 10000)))) AS BIGINT) AS gain
      FROM r LEFT JOIN t USING (bucket)),
m AS (SELECT doc_id, count(*) AS n_features, CAST(floor(CAST(sum(gain) AS DOUBLE) / count(*)) AS BIGINT) AS weight
      FROM df JOIN b USING (feature) JOIN g USING (bucket) GROUP BY doc_id),
s AS (SELECT doc_id, len(w) >= 20 AS eligible, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
             coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('7:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE)
                                                             / 4294967296))) AS BIGINT) AS score
      FROM d LEFT JOIN m USING (doc_id)),
k AS (SELECT *, row_number() OVER (PARTITION BY eligible ORDER BY score DESC, doc_id) AS nth,
             25 * count(*) FILTER (eligible) OVER () // 100 AS k FROM s)
SELECT doc_id, n_features, weight, score, CASE WHEN eligible AND nth <= k THEN nth END AS rank FROM k
""")
def op13_target_sample(spark, sf_dir):
    return draw(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("n_words")
