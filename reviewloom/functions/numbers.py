"""Undo the not-a-number values that some replay tools put in place of nulls."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from .records import field

# A bare NaN token parsed into a string field keeps its quotes.
NAN_TEXT = '"NaN"'


def nan_to_null(df, cols=None, text_cols=()):
    """NaN to null in ``cols`` (default: every float and double column), and the
    text ``"NaN"`` to null in ``text_cols``. Infinities stay."""
    kinds = {f.name: f.dataType for f in df.schema}
    if cols is None:
        cols = [n for n, t in kinds.items() if isinstance(t, (T.FloatType, T.DoubleType))]
    out = {c: F.nanvl(field(c), F.lit(None).cast(kinds[c])) for c in cols}
    out |= {c: F.nullif(field(c), F.lit(NAN_TEXT)) for c in text_cols}
    return df.withColumns(out) if out else df
