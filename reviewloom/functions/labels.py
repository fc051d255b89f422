"""Label clean-up for free-form replies."""

import re

from pyspark.sql import functions as F

from ..schema import LABELS, UNKNOWN

_WORD = r"[\p{L}\p{N}_]"


def normalise_label(col, labels=LABELS, default=UNKNOWN, passed=()):
    """The first label named in the reply, as ``labels`` spells it; ``default`` when none is.

    A label is found in any case, as a whole word, and may hold any characters. Null
    stays null, and so do replies listed in ``passed``.
    """
    # The longest first, so that a label is not taken for its own beginning.
    names = sorted(labels, key=len, reverse=True)
    found = F.lower(F.regexp_extract(
        col, rf"(?iu)(?<!{_WORD})({'|'.join(map(_quoted, names))})(?!{_WORD})", 1))
    label = F.lit(default)
    for name in names:
        label = F.when(found == F.lower(F.lit(name)), F.lit(name)).otherwise(label)
    return F.when(col.isNull() | col.isin(*passed), col).otherwise(label)


def _quoted(label):
    return re.sub(r"([^\w\s])", r"\\\1", label)
