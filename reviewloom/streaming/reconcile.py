"""Tell which keys two hops of a pipeline don't agree on.

Every row gets a hash of its key, which chooses one of ``2 ** DEPTH`` ranges, and a hash of key and value. A range's digest is the
number of its rows and the sum of their hashes, which no order changes. ``digest`` writes the digests of a table: the only
pass over it, made where the table is written. Two sides are then compared by their digests alone, from the
top of the tree of ranges down: digests of wider ranges are sums of finer ones, and only below those that differ is looked
on. Rows are read again for the ranges that differ in the end, and compared key by key there.

Equal tables cost a comparison of two short tables. The digests of a lost record, a doubled one and a changed value
differ in the count or in the sum; two tables of different rows agree by chance with a probability of about 2 ** -64.
"""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.records import field
from ..session import work_dir

DEPTH = 16      # bits of the key's hash that choose a range
STEP = 4        # bits by which a level of the tree is finer than the one above
_SUM = "decimal(38,0)"
DIGEST = T.StructType([T.StructField("range", T.LongType()), T.StructField("n", T.LongType()), T.StructField("sum", T.DecimalType(38, 0))])

LOST, EXTRA, DOUBLED, CHANGED, OTHER = "lost", "extra", "doubled", "changed", "counts differ"


def range_of(key, depth=DEPTH):
    """The range of a key: the first bits of its hash. A null key has one like any other."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(0), F.coalesce(key.cast("string"), F.lit("\0"))), 64 - depth)


def row_hash(columns):
    """A hash of a row that tells null from any value."""
    return F.xxhash64(*[x for c in columns for x in (field(c).isNull(), field(c))])


def digest(df, key, columns=None, depth=DEPTH):
    """``DIGEST`` rows of a table: at most 2 ** depth, each from partial sums of the tasks."""
    rows = df.select(range_of(field(key), depth).alias("range"), row_hash(columns or df.columns).cast(_SUM).alias("h"))
    return rows.groupBy("range").agg(F.count("*").alias("n"), F.sum("h").alias("sum"))


def differing_ranges(left, right, depth=DEPTH, step=STEP):
    """The ranges whose digests differ, found from the widest down.

    ``left`` and ``right`` are digests. The levels above the ranges are sums, so a level whose digests all agree
    ends the search, and each level looks only below the ranges that differed in the one above.
    """
    suspects = None
    for bits in [*range(step, depth, step), depth]:
        wide = F.shiftright("range", depth - bits)
        sides = []
        for side in (left, right):
            rows = side.select(wide.alias("range"), "n", "sum")
            if suspects is not None:
                above = F.shiftright("range", step if bits % step == 0 else bits % step)
                rows = rows.join(suspects.withColumnRenamed("range", "above"), above == F.col("above"), "left_semi")
            sides.append(rows.groupBy("range").agg(F.sum("n").alias("n"), F.sum("sum").cast(_SUM).alias("sum")))
        a, b = (side.select("range", F.col("n").alias(f"n_{x}"), F.col("sum").alias(f"sum_{x}")) for side, x in zip(sides, "ab"))
        found = a.join(b, "range", "full").where(~(F.col("n_a").eqNullSafe(F.col("n_b")) & F.col("sum_a").eqNullSafe(F.col("sum_b"))))
        suspects = _kept(found.select("range"))
        if suspects.isEmpty():
            break
    return suspects


def _kept(df):
    path = work_dir(df.sparkSession, "ranges")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def compare_keys(left, right, key, columns=None):
    """A row for each key that the two tables do not hold alike: key, n_left, n_right and what is wrong.

    Rows of a key are added up in the tasks first, so a key that many rows share has no place to gather.
    """
    def side(df, name):
        return (df.select(field(key).alias("key"), row_hash(columns or df.columns).cast(_SUM).alias("h"))
                .groupBy("key").agg(F.count("*").alias(f"n_{name}"), F.sum("h").alias(f"sum_{name}")))

    a, b = side(left, "left"), side(right, "right").withColumnRenamed("key", "other")
    both = a.join(b, F.col("key").eqNullSafe(F.col("other")), "full").where(
        ~(F.col("n_left").eqNullSafe(F.col("n_right")) & F.col("sum_left").eqNullSafe(F.col("sum_right"))))
    n_left, n_right = (F.coalesce(f"n_{x}", F.lit(0)).cast("bigint") for x in ("left", "right"))
    what = (F.when(n_right == 0, LOST).when(n_left == 0, EXTRA).when(n_left == n_right, CHANGED)
            .when((n_right > n_left) & (F.col("sum_right") * n_left == F.col("sum_left") * n_right), DOUBLED).otherwise(OTHER))
    return both.select(F.when(n_left > 0, F.col("key")).otherwise(F.col("other")).alias("key"),
                       n_left.alias("n_left"), n_right.alias("n_right"), what.alias("what"))


def reconcile(left, right, key, left_digest=None, right_digest=None, columns=None, depth=DEPTH):
    """The keys on which ``right`` differs from ``left``: lost, extra, doubled or changed.

    ``left_digest`` and ``right_digest`` are what ``digest`` gave when the tables were written; without them they
    are made here, with a pass over each table.
    """
    columns = columns or left.columns
    digests = [known if known is not None else _kept(digest(df, key, columns, depth)) for df, known in ((left, left_digest), (right, right_digest))]
    ranges = differing_ranges(*digests, depth)
    parts = [df.join(ranges, range_of(field(key), depth) == F.col("range"), "left_semi") for df in (left, right)]
    return compare_keys(*parts, key, columns)
