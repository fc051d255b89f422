"""Word-list scorer: column expressions only, no Python in the tasks. The lists are given, or learnt from labels."""

from dataclasses import dataclass

from pyspark.sql import functions as F

from ..functions.records import field
from ..schema import LABELS

_ASCII_WORDS = "[^a-z]+"
PRIOR = 500.0         # words that are taken to have been seen before
LEAST_Z = 3.0         # of a word that goes on a list
MOST_WORDS = 20_000   # of a list


@dataclass(frozen=True)
class LexiconScorer:
    """POSITIVE when more positive than negative words occur, NEGATIVE when fewer,
    else NEUTRAL. Words are matched whole, in lower case, over the whole text.

    The ``scope`` words after one of ``negations`` count for the other side.
    """

    positive: frozenset
    negative: frozenset
    separators: str = _ASCII_WORDS
    negations: frozenset = frozenset()
    scope: int = 3

    def __init__(self, positive, negative, separators=_ASCII_WORDS, negations=(), scope=3):
        lists = {}
        for name, words in (("positive", positive), ("negative", negative), ("negations", negations)):
            lists[name] = frozenset(w.lower() for w in words)
            if separators == _ASCII_WORDS:
                odd = sorted(w for w in lists[name] if not (w.isascii() and w.isalpha()))
                if odd:
                    raise ValueError(f"{odd} can never match: words are split at {separators}")
            object.__setattr__(self, name, lists[name])
        object.__setattr__(self, "separators", separators)
        object.__setattr__(self, "scope", scope)

    @classmethod
    def learnt(cls, words, least_z=LEAST_Z, most_words=MOST_WORDS, **options):
        """A scorer from the words that ``learn_words`` found telling, the most telling first and at most ``most_words`` a side."""
        def side(label):
            z = F.col(f"z_{label}")
            rows = words.where(z >= least_z).orderBy(z.desc(), "word").limit(most_words).select("word").collect()
            return [row.word for row in rows]
        return cls(side("positive"), side("negative"), **options)

    def hits(self, text):
        """The words of the text that are on a list, repeats included. One look-up
        settles most words, whatever the length of the lists."""
        listed = sorted(self.positive | self.negative)
        return F.filter(F.split(F.lower(text), self.separators), lambda w: w.isin(listed))

    def counts(self, df, text_col="text"):
        """Adds ``n_positive`` and ``n_negative``."""
        def count(words):
            return F.size(F.filter("__hits", lambda w: w.isin(sorted(words))))
        return (df.withColumn("__hits", self.hits(field(text_col)))
                .select(*[field(c) for c in df.columns],
                        count(self.positive).alias("n_positive"),
                        count(self.negative).alias("n_negative")))

    def score(self, df, text_col, out_col):
        # Only the sign matters. A word on both lists cancels itself out.
        up, down = sorted(self.positive - self.negative), sorted(self.negative - self.positive)
        worth = lambda w: F.when(w.isin(up), 1).when(w.isin(down), -1).otherwise(0)
        if self.negations:
            balance = self._negated_balance(field(text_col), worth)
        else:
            balance = F.aggregate(self.hits(field(text_col)), F.lit(0), lambda total, w: total + worth(w))
        # elt names the balance once; a CASE on its sign would compute it per branch.
        place = (F.signum(balance) + 2).cast("int")
        return df.withColumn(out_col, F.elt(
            place, F.lit("NEGATIVE"), F.lit("NEUTRAL"), F.lit("POSITIVE")))

    def _negated_balance(self, text, worth):
        """The balance, reading all words from the left; ``left`` is how many of those to come a negation still turns."""
        words = F.filter(F.split(F.lower(text), self.separators), lambda w: w != "")
        start = F.struct(F.lit(0).alias("total"), F.lit(0).alias("left"))

        def step(at, w):
            sign = F.when(at["left"] > 0, -1).otherwise(1)
            left = F.when(w.isin(sorted(self.negations)), self.scope).otherwise(F.greatest(at["left"] - 1, F.lit(0)))
            return F.struct((at["total"] + sign * worth(w)).alias("total"), left.alias("left"))

        return F.aggregate(words, start, step, lambda at: at["total"])


def learn_words(labelled, out_dir, label_col="label", text_col="text", separators=_ASCII_WORDS, prior=PRIOR):
    """Every word of labelled texts with how telling it is for POSITIVE and for NEGATIVE.

    Columns: word, n_all, n_positive and n_negative (texts that have it), z_positive and z_negative. A z is the log-odds of the word in
    the texts of the label against all others, in standard deviations; a prior of ``prior`` words, spread over the
    vocabulary as the words themselves are, keeps rare words near 0. A text counts a word once, however often it repeats
    it. Null texts and labels count for no side.

    The counts are written to ``out_dir``, a folder all executors reach; three totals come to the driver.
    """
    positive, negative, _ = LABELS
    label = field(label_col)
    words = (labelled.where(label.isNotNull())
             .select(label.alias("label"), F.explode(F.array_distinct(F.split(F.lower(field(text_col)), separators))).alias("word"))
             .where("word <> ''"))
    (words.groupBy("word").agg(F.count("*").alias("n_all"), F.count_if(F.col("label") == positive).alias("n_positive"),
                               F.count_if(F.col("label") == negative).alias("n_negative"))
     .write.parquet(out_dir))
    counts = labelled.sparkSession.read.parquet(out_dir)
    total = counts.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in ("n_all", "n_positive", "n_negative")]).first()
    return counts.select("*", *[_z(n, total["n_all"], total[n], prior).alias("z" + n[1:]) for n in ("n_positive", "n_negative")])


def _z(column, total, of_label, prior):
    """The weighted log-odds of a word, in standard deviations."""
    own, rest = F.col(column), F.col("n_all") - F.col(column)
    share = prior * F.col("n_all") / F.lit(float(max(total, 1)))
    odds = lambda n, all_words: F.log((n + share) / (all_words + prior - n - share))
    return (odds(own, of_label) - odds(rest, total - of_label)) / F.sqrt(1 / (own + share) + 1 / (rest + share))
