"""Spark ML scorer, trained on labelled texts."""

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, Normalizer, RegexTokenizer
from pyspark.sql import functions as F

from ..functions.records import field
from ..schema import EMPTY, LABELS
from .classify import guard

# Columns the fitted pipeline reads and writes.
_TEXT, _WORDS, _GUESS = "__text", "__words", "__guess"
_RARE, _UNIT, _WEIGHT = "__rare", "__unit", "__weight"
# Columns of a table of hashed texts.
TERMS, LENGTH = "terms", "n_chars"


@dataclass(frozen=True)
class ModelScorer:
    """Labels text with a fitted pipeline. Runs in the JVM, on batches and streams."""

    model: PipelineModel
    labels: tuple = LABELS

    def score(self, df, text_col, out_col):
        guessed = self.model.transform(
            df.withColumn(_TEXT, F.coalesce(field(text_col), F.lit(""))))
        return guessed.select(*[field(c) for c in df.columns], self._label().alias(out_col))

    def classify_hashed(self, hashed, out_col="feedback", empty_label=EMPTY):
        """As ``classify``, for a table from ``hash_texts``: the texts are not read again."""
        label = guard(F.col(LENGTH), self._label(), empty_label)
        kept = [field(c) for c in hashed.columns if c not in (TERMS, LENGTH, out_col)]
        return PipelineModel(self.model.stages[2:]).transform(hashed).select(*kept, label.alias(out_col))

    def _label(self):
        return F.element_at(F.array(*[F.lit(x) for x in self.labels]),
                            F.col(_GUESS).cast("int") + 1)

    def save(self, path):
        """Keep the model in a shared folder, so that a restarted stream scores alike."""
        self.model.write().overwrite().save(path)

    @classmethod
    def load(cls, path, labels=LABELS):
        return cls(PipelineModel.load(path), tuple(labels))


def _hashing(n_features):
    return PipelineModel([
        RegexTokenizer(inputCol=_TEXT, outputCol=_WORDS, pattern=r"[^\p{L}]+"),
        HashingTF(inputCol=_WORDS, outputCol=TERMS, numFeatures=n_features),
    ])


def hash_texts(df, out_dir, text_col="text", n_features=1 << 14):
    """Write hashed word counts in place of the texts, and read them back.

    The table is a fraction of the texts' size, so joining labels to it moves
    vectors instead of texts, and training and labelling read the texts once.
    """
    kept = [field(c) for c in df.columns if c != text_col]
    text = df.select(*kept, F.length(field(text_col)).alias(LENGTH),
                     F.coalesce(field(text_col), F.lit("")).alias(_TEXT))
    _hashing(n_features).transform(text).drop(_TEXT, _WORDS).write.parquet(out_dir)
    return df.sparkSession.read.parquet(out_dir)


def join_labels(rows, labels, id_col, max_rows=None):
    """``rows`` that have a label. ``max_rows`` keeps at most so many labels, the first by a hash
    of the id, and is off by default; a label table so bounded is small enough to broadcast."""
    if max_rows is not None:
        labels = labels.orderBy(F.xxhash64(id_col), id_col).limit(max_rows)
    return rows.join(labels, id_col)


def train_model(hashed, training_dir, label_col="label", labels=LABELS, max_iter=20,
                regularisation=0.05, tree_depth=3):
    """Fit a logistic regression on a table from ``hash_texts`` with a label column.

    Counts are weighed by rarity and each text brought to unit length, so that long texts and common words do
    not drown the rest; a row weighs more the rarer its class.

    The training rows are written to ``training_dir`` first, a folder all executors
    reach: when an executor is lost, its share is read again from there instead of
    joined again. Gradients are merged in a tree of ``tree_depth`` levels, so
    neither one task nor the driver receives a vector from every partition, and
    the number of features bounds their size. An unknown label is refused, a
    null text left out.
    """
    (hashed.filter(F.col(LENGTH).isNotNull())
     .select(_class_index(field(label_col), labels).alias("class"), TERMS)
     .write.parquet(training_dir))
    rows = hashed.sparkSession.read.parquet(training_dir)
    seen = {r["class"]: r["count"] for r in rows.groupBy("class").count().collect()}  # a row per label
    weight = F.lit(1.0)
    for index, n in seen.items():
        weight = F.when(F.col("class") == index, sum(seen.values()) / (len(seen) * n)).otherwise(weight)
    rarity = IDF(inputCol=TERMS, outputCol=_RARE).fit(rows)
    unit = Normalizer(inputCol=_RARE, outputCol=_UNIT)
    regression = LogisticRegression(
        featuresCol=_UNIT, labelCol="class", predictionCol=_GUESS, weightCol=_WEIGHT,
        rawPredictionCol="", probabilityCol="", family="multinomial",
        maxIter=max_iter, regParam=regularisation, aggregationDepth=tree_depth,
    ).fit(unit.transform(rarity.transform(rows.withColumn(_WEIGHT, weight))))
    steps = _hashing(regression.numFeatures).stages + [rarity, unit, regression]
    return ModelScorer(PipelineModel(steps), tuple(labels))


def _class_index(label, labels):
    refuse = F.raise_error(F.concat(
        F.lit("unknown label: "), F.coalesce(label, F.lit("null")))).cast("double")
    index = F.array_position(F.array(*[F.lit(x) for x in labels]), label) - 1
    return F.when(label.isin(*labels), index.cast("double")).otherwise(refuse)
