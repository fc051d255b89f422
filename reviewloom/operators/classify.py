"""Add the feedback label."""

from pyspark.sql import functions as F

from ..functions.records import field
from ..schema import EMPTY

_SCORE = "__score"


def guard(length, score, empty_label=EMPTY):
    """The label by the text's length: null for null, ``empty_label`` for 0, else the score."""
    return (F.when(length.isNull(), F.lit(None).cast("string"))
             .when(length == 0, F.lit(empty_label))
             .otherwise(score))


def classify(df, scorer, text_col="text", out_col="feedback", empty_label=EMPTY):
    """Null text gives null, ``""`` gives ``empty_label``, any other text the
    scorer's label. No row is removed.

    A scorer is any object with ``score(df, text_col, out_col) -> DataFrame``.
    Filter before this call: Spark pushes no filter below a remote scorer.
    """
    scored = scorer.score(df, text_col, _SCORE)
    label = guard(F.octet_length(field(text_col)), F.col(_SCORE), empty_label)
    kept = [field(c) for c in df.columns if c != out_col]
    return scored.select(*kept, label.alias(out_col))
