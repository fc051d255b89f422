"""N-gram Jaccard join by R-trees over count vectors.

A document's set holds its distinct five-word shingles; two documents link when their sets
have a Jaccard similarity of 0.75 or more. The shingles of a set are hashed into
``GROUPS`` groups, and the counts per group are a point. Two sets share at most the
sum of the coordinate-wise minima of their points; an R-tree over points gives the same bound for
whole boxes, by the minima of their upper corners. Pairs within the bound are verified on the sets.

Points of unrelated documents lie too close for boxes over a whole corpus to keep apart, so
trees are built over blocks. Similar sets share a shingle among the first n - ceil(0.75 n) + 1
of each in any fixed order of all shingles. The documents with the same such shingle
are a block, and every linked pair meets in one. Frequent shingles come last in the order.

Within a block sorted by size, a step of more than a third ends the block: no similar pair spans it.

1. Equal sets become one class; each task hands on the shingles of a class once.
2. In every block the smallest member is paired with each other one. Those of these pairs, linear
   in the block, that are within the bound are verified and joined to components; that settles copies in large groups.
3. In the blocks that still hold several components an R-tree join finds the pairs of
   different components within the bound: first the best partner of each document, and when these are verified and
   joined, all pairs that are left. Blocks with the same members are treated once. A block beyond ``PAGE`` members is cut in pages, and each
   pair of pages is a task of its own.

``jaccard_links`` and ``link_counts`` settle no block: the R-tree join gives all pairs of every block within the bound,
and all of them are verified.

Sets are fetched for verification only, for the documents of pairs within the bound. They are found again by the id and a hash of the
text of one row of their class, so rows that share an id, or have none, meet only their own.

Sets and classes are known by 64-bit hashes of the words and of the sorted set. Only the frequent
shingles reach the driver, by their number, the upper half of the hash, under which all documents' shingles are
counted (they set the order, never the result).

Special cases: null, empty and blank texts have an empty set and are linked with nothing.
Texts with fewer than five words have one shingle, the whole text. Repeated rows are copies. A null id
never names a component unless all ids of it are null. An empty table gives an empty result.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from .common import gathered, most_frequent, shuffle_partitions, squeezed, stored, unsqueezed
from .components import connected

SHINGLE = 5
GROUPS = 1024
LONG = 100_000          # the bound passes all sets of so many shingles, whose counts might not fit a byte
LEAF = 16               # points of a leaf, and nodes of an inner node
PAGE = 512              # members of a block that one task joins
VERIFY_PAGE = 256       # documents of a component that one task verifies, beside those they are paired with
FREQUENT_ROWS = 2       # a shingle in so many documents is frequent,
FREQUENT_OF = 20_000    # or in so many of each of these many,
FREQUENT_ANYWAY = 8     # or, in a large corpus, in so many,
FREQUENT_STEP = 1 << 18  # and one more for each of these many; numbers that agree by chance stay far below
MAX_FREQUENT = 200_000
COUNT_SHIFT = 32        # of a shingle's hash, to the number that it is counted by
COUNT_SHINGLES = 1 << 22  # shingles that a task counts before it hands them on
COUNT_ROWS = 4096       # documents whose numbers make a piece of all numbers
MAX_BROADCAST = 500_000  # ids broadcast at once
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def shingles(text, size=SHINGLE):
    """The sorted distinct shingle hashes (uint64) of a text's bytes."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    digest = xxhash.xxh3_64_intdigest
    hashes = np.fromiter(map(digest, words), dtype=np.uint64, count=len(words))
    size = min(size, len(words))
    n = len(words) - size + 1
    out = np.full(n, size, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i in range(size):
            out = out * MULTIPLIER + hashes[i:i + n]
        # Spread the sum over all bits.
        out ^= out >> np.uint64(32)
        out *= MULTIPLIER
        out ^= out >> np.uint64(29)
    return np.unique(out)


def set_key(members):
    return xxhash.xxh3_64_intdigest(members.tobytes()) - (1 << 63)


def needed(n):
    """The length of the prefix that must share a shingle with every similar set."""
    return n - (3 * n + 3) // 4 + 1


def prefix(members, frequent, shift=0):
    """The first shingles of a set: the rare before the frequent, which are known by their upper bits, each by hash."""
    n = needed(len(members))
    if len(frequent):
        numbers = members >> np.uint64(shift)
        at = np.searchsorted(frequent, numbers).clip(max=len(frequent) - 1)
        common = frequent[at] == numbers
        if common.any():
            members = np.concatenate([members[~common], members[common]])
    return members[:n]


def point(members):
    counts = np.bincount((members & np.uint64(GROUPS - 1)).astype(np.int64), minlength=GROUPS)
    return np.minimum(counts, 255).astype(np.uint8)


def packed(counts):
    """A point as it is shuffled and stored, about half as long as Spark's own compression makes it."""
    return pa.compress(counts.tobytes(), codec="zstd", asbytes=True)


def unpacked(points):
    """The packed points, one a row."""
    whole = [pa.decompress(p, decompressed_size=GROUPS, codec="zstd", asbytes=True) for p in points]
    return np.frombuffer(b"".join(whole), dtype=np.uint8).reshape(-1, GROUPS)


def most_shared(high_a, high_b, n_a, n_b):
    """What sets of at most so many members, whose counts are no higher, share at most; row by row."""
    least = np.minimum(n_a, n_b)
    shared = np.minimum(high_a, high_b).sum(axis=1, dtype=np.int64)
    return np.where(np.maximum(n_a, n_b) >= LONG, least, np.minimum(shared, least))


def within_bound(shared, n_a, n_b):
    """Whether ``shared`` of two sets can make, or makes, a similarity of 0.75: 100 i >= 75 u."""
    return 7 * shared >= 3 * (n_a + n_b)


# ---- sets ----

SETS = "id bigint, h bigint, n bigint, k bigint, tokens array<bigint>, point binary"


def set_batches(shared):
    """(id, h, text) to the set's size and key; the first of equal sets in a task has the prefix and the point."""
    def sets(batches):
        frequent, seen = shared.value, set()
        for batch in batches:
            sizes, keys, tokens, points = [], [], [], []
            for text in batch.column(2).to_pylist():
                members = shingles(text)
                key = set_key(members)
                new = len(members) and key not in seen
                seen.add(key)
                sizes.append(len(members))
                keys.append(key)
                tokens.append(prefix(members, frequent, COUNT_SHIFT).view(np.int64) if new else None)
                points.append(packed(point(members)) if new else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, type=pa.int64()), pa.array(keys, type=pa.int64()),
                 pa.array(tokens, type=pa.list_(pa.int64())), pa.array(points, type=pa.binary())],
                names=["id", "h", "n", "k", "tokens", "point"])
    return sets


NUMBERS = "piece bigint, once binary, more binary, counts binary"


def steps(numbers):
    """Sorted 32-bit numbers by the steps from each to the next, compressed."""
    return squeezed(np.diff(numbers, prepend=numbers[:1] * 0))


def from_steps(block):
    return np.cumsum(unsqueezed(block), dtype=np.uint32)


def number_batches(pieces):
    """(text) to the numbers of all shingles by piece: those that the task has seen once, and others with their counts.

    Equal sets of a task count once. The numbers are sorted, and given by their steps.
    """
    def counted(held):
        numbers, counts = np.unique(np.concatenate(held), return_counts=True)
        edges = np.searchsorted(numbers, -(-(np.arange(pieces + 1) << COUNT_SHIFT) // pieces))
        several = counts > 1
        rows = []
        for piece, (begin, end) in enumerate(zip(edges, edges[1:])):
            if begin < end:
                own, n, some = numbers[begin:end], counts[begin:end], several[begin:end]
                rows.append((piece, steps(own[~some]), steps(own[some]), squeezed(n[some])))
        return pa.RecordBatch.from_arrays(
            [pa.array(column, type=kind) for column, kind in zip(zip(*rows), (pa.int64(), *[pa.binary()] * 3))],
            names=["piece", "once", "more", "counts"])

    def number(batches):
        seen, held, size = set(), [], 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                members = shingles(text)
                key = set_key(members)
                if len(members) and key not in seen:
                    seen.add(key)
                    held.append((members >> np.uint64(COUNT_SHIFT)).astype(np.uint32))
                    size += len(members)
                if size >= COUNT_SHINGLES:
                    yield counted(held)
                    held, size = [], 0
        if held:
            yield counted(held)
    return number


def frequent_batches(least):
    """Rows of ``NUMBERS``, sorted by piece, to the numbers (number, n) that ``least`` documents have."""
    def frequent(held):
        once, more, counts = (np.concatenate([read(block) for block in column])
                              for column, read in zip(zip(*held), (from_steps, from_steps, unsqueezed)))
        numbers, n = np.unique(once, return_counts=True)
        # The few that came with counts are added by place.
        every = np.union1d(numbers, more)
        total = np.zeros(len(every), dtype=np.int64)
        total[np.searchsorted(every, numbers)] = n
        np.add.at(total, np.searchsorted(every, more), counts)
        kept = total >= least
        return pa.RecordBatch.from_arrays([pa.array(every[kept].astype(np.int64)), pa.array(total[kept])], names=["number", "n"])

    def pieces(batches):
        at, held = None, []
        for batch in batches:
            for piece, *row in zip(*(column.to_pylist() for column in batch.columns)):
                if piece != at:
                    if held:
                        yield frequent(held)
                    at, held = piece, []
                held.append(row)
        if held:
            yield frequent(held)
    return pieces


def frequent_shingles(rows):
    """The numbers of the shingles that many documents share, sorted; every document is counted."""
    spark = rows.sparkSession
    n = rows.count()
    parts = shuffle_partitions(spark)
    pieces = max(parts, -(-n // COUNT_ROWS))
    least = min(FREQUENT_ANYWAY + n // FREQUENT_STEP, max(FREQUENT_ROWS, -(-FREQUENT_ROWS * n // FREQUENT_OF)))
    counts = gathered(rows.select("text").mapInArrow(number_batches(pieces), NUMBERS)
                      .repartition(parts, "piece").sortWithinPartitions("piece")
                      .mapInArrow(frequent_batches(least), "number bigint, n bigint"), "frequent")
    top = most_frequent(counts, MAX_FREQUENT)
    return np.sort(np.array([r.number for r in top], dtype=np.int64).view(np.uint64))


# ---- blocks ----

STARS = "token bigint, low bigint, k bigint, place bigint, mate bigint"


def star_batches(batches):
    """(token, n, k), sorted, to a row per further member of a block, with the block's smallest member.

    Runs over blocks of any size without holding them. ``place`` counts the members after the first.
    """
    token = low = last = None
    last_n = place = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        t, n, k = (c.to_numpy() for c in batch.columns)
        first = np.empty(len(t), dtype=bool)
        first[1:] = (t[1:] != t[:-1]) | (3 * n[1:] > 4 * n[:-1])
        first[0] = t[0] != token or 3 * n[0] > 4 * last_n
        same = np.empty(len(t), dtype=bool)
        same[1:] = ~first[1:] & (k[1:] == k[:-1])
        same[0] = not first[0] and k[0] == last
        start = np.maximum.accumulate(np.where(first, np.arange(len(t)), -1))
        lows = np.where(start >= 0, k[np.maximum(start, 0)], low if low is not None else 0)
        member = ~first & ~same
        total = np.cumsum(member)
        before = np.where(start >= 0, total[np.maximum(start, 0)], -place)
        places = total - before
        yield pa.RecordBatch.from_arrays(
            [pa.array(t[member]), pa.array(lows[member]), pa.array(k[member]), pa.array(places[member])],
            names=["token", "low", "k", "place"])
        token, low, last, last_n, place = t[-1], lows[-1], k[-1], int(n[-1]), int(places[-1])


def mated_batches(batches):
    """``star_batches``; the second further member of a block has the first as its ``mate``."""
    last = 0
    for batch in star_batches(batches):
        k, place = batch.column("k").to_numpy(), batch.column("place").to_numpy()
        before = np.concatenate([[last], k])
        last = before[-1]
        yield batch.append_column("mate", pa.array(before[:-1], mask=place != 2))


def members_of(stars):
    """(token, low, k) of every member, the smallest too, of the blocks of three or more.

    A block's second further member stands for those before it, so no join has to tell which blocks have three.
    """
    some = F.when(F.col("place") == 2, F.array("low", "mate", "k")).otherwise(F.array("k"))
    return stars.where("place >= 2").select("token", "low", F.explode(some).alias("k"))


class Tree:
    """An R-tree packed over points sorted by size; nodes of a level are consecutive.

    A node keeps the upper corner of its points, the range of their sizes, and their
    component if they have one in common.
    """

    def __init__(self, points, sizes, components):
        # Points of one component and similar size stand together.
        self.order = np.lexsort((points.argmax(axis=1), sizes, components))
        high, least, most = points[self.order], sizes[self.order], sizes[self.order]
        own = components[self.order]
        self.levels = [(high, least, most, own)]
        while len(self.levels[-1][0]) > 1:
            high, least, most, own = self.levels[-1]
            cuts = np.arange(0, len(high), LEAF)
            low_own, high_own = np.minimum.reduceat(own, cuts), np.maximum.reduceat(own, cuts)
            self.levels.append((np.maximum.reduceat(high, cuts), np.minimum.reduceat(least, cuts),
                                np.maximum.reduceat(most, cuts), np.where(low_own == high_own, low_own, -1)))


def _may_hold(a, i, b, j):
    """Which nodes ``j`` of level ``b`` may hold a similar point of another component for nodes ``i`` of ``a``."""
    shared = most_shared(a[0][i], b[0][j], a[2][i], b[2][j])
    return within_bound(shared, a[1][i], b[1][j]) & ((a[3][i] != b[3][j]) | (a[3][i] < 0))


def tree_join(left, right=None):
    """Index pairs (of the input order) of points within the bound, from one tree or between two."""
    other = right or left
    level = max(len(left.levels), len(other.levels)) - 1
    top = lambda tree: tree.levels[min(level, len(tree.levels) - 1)]
    i, j = (x.ravel() for x in np.meshgrid(np.arange(len(top(left)[0])), np.arange(len(top(other)[0])), indexing="ij"))
    todo, found = [(level, i, j)], []
    while todo:
        level, i, j = todo.pop()
        if right is None:
            i, j = i[i <= j], j[i <= j]
        a, b = (tree.levels[min(level, len(tree.levels) - 1)] for tree in (left, other))
        for at in range(0, len(i), 4096):
            p, q = i[at:at + 4096], j[at:at + 4096]
            kept = _may_hold(a, p, b, q)
            p, q = p[kept], q[kept]
            if level == 0:
                if right is None:
                    p, q = p[p < q], q[p < q]
                found.append((left.order[p], other.order[q]))
                continue
            p_down, q_down = (_children(x, tree, level) for x, tree in ((p, left), (q, other)))
            for x, y in zip(p_down, q_down):
                todo.append((level - 1, np.repeat(x, len(y)), np.tile(y, len(x))))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(side) for side in zip(*found))


def _children(nodes, tree, level):
    if level >= len(tree.levels):  # the other tree is higher: stay
        return [np.array([node]) for node in nodes]
    below = len(tree.levels[level - 1][0])
    return [np.arange(node * LEAF, min(below, (node + 1) * LEAF)) for node in nodes]


def block_batches(nearest):
    """Members of blocks, sorted by (token, low, one, two), to pairs within the bound.

    A run is one block, or a pair of its pages: those of page ``one`` against those of page ``two``.
    With ``nearest`` each member is paired only with the one that it may share most with.
    """
    def blocks(batches):
        at, held = None, []
        for batch in batches:
            for *block, k, n, where, component, page in zip(*(c.to_pylist() for c in batch.columns)):
                if block != at:
                    if len(held) > 1:
                        yield _block_pairs(at, held, nearest)
                    at, held = block, []
                held.append((k, n, where, component, page))
        if len(held) > 1:
            yield _block_pairs(at, held, nearest)
    return blocks


def _block_pairs(block, held, nearest):
    keys, sizes, _, components, pages = (np.array(column) if i != 2 else None for i, column in enumerate(zip(*held)))
    points = unpacked(h[2] for h in held)
    numbers = np.unique(components, return_inverse=True)[1]
    tree = lambda x: Tree(points[x], sizes[x], numbers[x])
    if block[2] == block[3]:
        i, j = tree_join(tree(slice(None)))
    else:
        one, two = np.flatnonzero(pages == block[2]), np.flatnonzero(pages == block[3])
        i = j = np.zeros(0, dtype=np.int64)
        if len(one) and len(two):
            i, j = tree_join(tree(one), tree(two))
            i, j = one[i], two[j]
    if nearest and len(i):
        share = np.concatenate([most_shared(points[i[c:c + 4096]], points[j[c:c + 4096]], sizes[i[c:c + 4096]], sizes[j[c:c + 4096]])
                                for c in range(0, len(i), 4096)]) / (sizes[i] + sizes[j])
        ends, pair = np.concatenate([i, j]), np.tile(np.arange(len(i)), 2)
        order = np.lexsort((pair, -share[pair], ends))
        best = np.unique(pair[order][np.unique(ends[order], return_index=True)[1]])
        i, j = i[best], j[best]
    return pa.RecordBatch.from_arrays(
        [pa.array(np.minimum(keys[i], keys[j])), pa.array(np.maximum(keys[i], keys[j]))], names=["a", "b"])


# ---- pairs ----

def bound_batches(batches):
    """(a, b, sizes, points) to the pairs within the bound."""
    for batch in batches:
        a, b = batch.column(0), batch.column(1)
        n_a, n_b = (batch.column(i).to_numpy() for i in (2, 3))
        left, right = (unpacked(batch.column(i).to_pylist()) for i in (4, 5))
        kept = pa.array(within_bound(most_shared(left, right, n_a, n_b), n_a, n_b))
        yield pa.RecordBatch.from_arrays([a.filter(kept), b.filter(kept)], names=["a", "b"])


def bounded(pairs, classes):
    """Those of ``pairs`` (a, b) whose sizes and points allow them to be similar."""
    a, b = (classes.select(F.col("k").alias(x), F.col("n").alias(f"n_{x}"), F.col("point").alias(f"point_{x}")) for x in "ab")
    return (pairs.join(a, "a").join(b, "b").where("4 * least(n_a, n_b) >= 3 * greatest(n_a, n_b)")
            .select("a", "b", "n_a", "n_b", "point_a", "point_b").mapInArrow(bound_batches, "a bigint, b bigint"))


PAGE_ROWS = "root bigint, page bigint, kind int, a bigint, b bigint, members binary"


def member_batches(batches):
    """(root, page, k, text) to the sorted sets, as rows of kind 0. A text of another key has the same id and hash only."""
    for batch in batches:
        sets = [shingles(text) for text in batch.column(3).to_pylist()]
        own = pa.array([set_key(s) == k for s, k in zip(sets, batch.column(2).to_pylist())], type=pa.bool_())
        n = batch.num_rows
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array([0] * n, type=pa.int32()), batch.column(2), pa.nulls(n, pa.int64()),
             pa.array([s.tobytes() for s in sets], type=pa.binary())],
            names=["root", "page", "kind", "a", "b", "members"]).filter(own)


def verify_batches(batches):
    """Sets and pairs, sorted by (root, page, kind), to the pairs that are similar."""
    at, sets = None, {}
    for batch in batches:
        a, b = [], []
        for root, page, kind, x, y, members in zip(*(column.to_pylist() for column in batch.columns)):
            if (root, page) != at:
                at, sets = (root, page), {}
            if kind == 0:
                sets[x] = np.frombuffer(members, dtype=np.uint64)
            else:
                shared = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
                if within_bound(shared, len(sets[x]), len(sets[y])):
                    a.append(x)
                    b.append(y)
        yield pa.RecordBatch.from_arrays([pa.array(a, type=pa.int64()), pa.array(b, type=pa.int64())], names=["a", "b"])


def dealt_pairs(pairs, page, whole):
    """(root, page, a, b): ``pairs`` by their component, those of a large one by pages.

    A pair goes to the page of that of its two that has fewer pairs, which so is wanted there only, and a document that
    all others are paired with goes to several pages, with some of its partners each. With ``whole`` both sides are cut in pages,
    so that a task holds two pages of sets even if all sets of a large component are paired.
    """
    roots = connected(pairs)
    sizes = roots.groupBy("root").agg(F.ceil(F.count("*") / F.lit(page)).alias("pages"))
    sized = gathered(pairs.join(roots.withColumnRenamed("node", "a"), "a").join(sizes, "root").select("root", "pages", "a", "b"), "sized")
    cell = lambda k: F.pmod(F.xxhash64(k), F.col("pages"))
    if whole:
        return sized.select("root", (cell("a") * F.col("pages") + cell("b")).alias("page"), "a", "b")
    large = sized.where("pages > 1")
    degrees = gathered(large.select(F.explode(F.array("a", "b")).alias("k")).groupBy("k").agg(F.count("*").alias("degree")), "degrees")
    of = lambda x: degrees.select(F.col("k").alias(x), F.col("degree").alias(f"degree_{x}"))
    fewer = F.when(F.col("degree_a") < F.col("degree_b"), F.col("a")).otherwise(F.col("b"))
    return (sized.where("pages = 1").select("root", F.lit(0).cast("bigint").alias("page"), "a", "b")
            .unionByName(large.join(of("a"), "a").join(of("b"), "b").select("root", cell(fewer).alias("page"), "a", "b")))


def verified(pairs, rows, classes, page=VERIFY_PAGE, whole=False):
    """Those of ``pairs`` (a, b) that are similar, by the sets of their documents in ``rows`` (id, h, text).

    The pairs are dealt by ``dealt_pairs``, and each set goes where its pairs are.
    """
    dealt = gathered(dealt_pairs(pairs, page, whole), "dealt")
    wanted = gathered(dealt.select("root", "page", F.explode(F.array("a", "b")).alias("k")).distinct()
                      .join(classes.select("k", "row"), "k").select("root", "page", "k", "row"), "wanted")
    small = wanted.count() <= MAX_BROADCAST
    same = F.col("id").eqNullSafe(F.col("row.id")) & (F.col("h") == F.col("row.h"))
    texts = rows.join(F.broadcast(wanted) if small else wanted, same)
    sets = texts.select("root", "page", "k", "text").mapInArrow(member_batches, PAGE_ROWS)
    asked = dealt.select("root", "page", F.lit(1).alias("kind"), "a", "b", F.lit(None).cast("binary").alias("members"))
    where = ["root", "page"]
    return (sets.unionAll(asked).repartition(shuffle_partitions(rows.sparkSession), *where)
            .sortWithinPartitions(*where, "kind").mapInArrow(verify_batches, "a bigint, b bigint"))


def open_pairs(stars, pairs, roots, classes, page=PAGE, nearest=False):
    """Pairs of different components that an R-tree join of the unsettled blocks finds.

    A block is unsettled if its members, paired with the lowest, are not all of one component. With
    ``nearest`` only the best partner of each member is given.
    """
    a, b = (roots.select(F.col("node").alias(x), F.col("root").alias(f"root_{x}")) for x in "ab")
    failed = gathered(
        pairs.join(a, "a", "left").join(b, "b", "left")
        .where(F.coalesce("root_a", "a") != F.coalesce("root_b", "b"))
        .select(F.col("a").alias("low"), F.col("b").alias("k")), "failed")
    # A block of two is settled: its one pair has been looked at.
    block = ["token", "low"]
    members = members_of(stars)
    unsettled = gathered(members.join(failed, ["low", "k"], "left_semi").select(block).distinct(), "unsettled")
    return tree_pairs(gathered(members.join(unsettled, block, "left_semi"), "open-members"), roots, classes, page, nearest)


def tree_pairs(rows, roots, classes, page=PAGE, nearest=False):
    """Pairs of different components that an R-tree join of blocks, given by their members (token, low, k), finds."""
    block = ["token", "low"]
    # Blocks with the same members are one.
    same = rows.groupBy(block).agg(F.count("*").alias("size"), F.sum(F.xxhash64("k").cast("decimal(38,0)")).alias("sum"))
    blocks = gathered(same.groupBy("size", "sum", "low").agg(F.min("token").alias("token")).select(*block, "size"), "blocks")
    pages = F.ceil(F.col("size") / F.lit(page)).cast("int")
    rows = (rows.join(blocks, block)
            .join(roots.withColumnRenamed("node", "k"), "k", "left")
            .select(*block, "k", F.coalesce("root", "k").alias("component"), pages.alias("pages"))
            .withColumn("page", F.pmod(F.xxhash64("k"), F.col("pages")).cast("int")))
    split = (rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("pages") - 1)))
             .select(*block, F.least("page", "other").alias("one"), F.greatest("page", "other").alias("two"),
                     "k", "component", "page"))
    run = [*block, "one", "two"]
    return (split.join(classes.select("k", "n", "point"), "k")
            .select(*run, "k", "n", "point", "component", "page")
            .repartition(shuffle_partitions(rows.sparkSession), *run).sortWithinPartitions(*run)
            .mapInArrow(block_batches(nearest), "a bigint, b bigint").distinct())


def ordered(pairs):
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def blocks_of(docs, text, id_column):
    """Of ``docs``: rows (id, h, text), sets (id, h, n, k, ..), classes (k, first, row, n, point) and stars.

    ``row`` is the id and the text's hash of one row of the class; ``rows`` is to be joined by both, and has such a row once.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_column).cast("bigint").alias("id"), text_hash(text).alias("h"),
                       F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    shared = spark.sparkContext.broadcast(frequent_shingles(rows))  # at most MAX_FREQUENT numbers
    sets = stored(rows.mapInArrow(set_batches(shared), SETS), "sets")
    classes = gathered(sets.where("n > 0").groupBy("k").agg(
        F.min("id").alias("first"), F.min(F.struct("id", "h")).alias("row"), F.max("n").alias("n"), F.first("point", ignorenulls=True).alias("point")), "classes")

    stars = gathered(sets.where("tokens IS NOT NULL").select(F.explode("tokens").alias("token"), "n", "k")
                     .repartition(shuffle_partitions(spark), "token").sortWithinPartitions("token", "n", "k")
                     .mapInArrow(mated_batches, STARS), "stars")
    if not sets.where("n > 0").groupBy("id", "h").count().where("count > 1").isEmpty():
        # Rows that share id and text: one of them stands for all. Spark keeps one per task before it shuffles.
        rows = rows.groupBy("id", "h").agg(F.first("text").alias("text"))
    return rows, sets, classes, stars


def text_hash(text="text"):
    """A 64-bit hash of a text column; null counts as empty."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")).cast("binary"))


def _links(rows, classes, stars, page):
    pairs = ordered(stars.select(F.col("low").alias("a"), F.col("k").alias("b")))
    # A block of two is the pair of its star; in the larger ones no class has a component yet, so no pair is left out.
    single = classes.select(F.col("k").alias("node"), F.col("k").alias("root"))
    found = tree_pairs(members_of(stars), single, classes, page)
    asked = gathered(bounded(pairs, classes).unionByName(found).distinct(), "link-pairs")
    return gathered(verified(asked, rows, classes, whole=True), "all-links")


def jaccard_links(docs, text="text", id_column="doc_id", page=PAGE):
    """(a, b, rows_a, rows_b): every link of two classes of equal sets, each once, by their lowest ids and numbers of rows.

    Rows of one class are linked with each other and with all rows of a linked class. A group of m classes that
    are near copies has up to m (m - 1) / 2 links, and the time to find them grows likewise.
    """
    rows, sets, classes, stars = blocks_of(docs, text, id_column)
    links = _links(rows, classes, stars, page)
    sizes = classes.join(sets.where("n > 0").groupBy("k").agg(F.count("*").alias("rows")), "k")
    a, b = (sizes.select(F.col("k").alias(x), F.col("first").alias(f"first_{x}"), F.col("rows").alias(f"rows_{x}")) for x in "ab")
    return links.join(a, "a").join(b, "b").select(
        F.col("first_a").alias("a"), F.col("first_b").alias("b"), "rows_a", "rows_b")


def link_counts(docs, text="text", id_column="doc_id", page=PAGE):
    """id, n_shingles and n_links of every row of ``docs``: the number of other rows that it is linked with."""
    rows, sets, classes, stars = blocks_of(docs, text, id_column)
    links = _links(rows, classes, stars, page)
    sizes = gathered(sets.where("n > 0").groupBy("k").agg(F.count("*").alias("rows")), "class-rows")
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    other = both.join(sizes.withColumnRenamed("k", "b"), "b").groupBy("a").agg(F.sum("rows").alias("others"))
    counts = (sizes.join(other.withColumnRenamed("a", "k"), "k", "left")
              .select("k", (F.col("rows") - 1 + F.coalesce("others", F.lit(0))).alias("n_links")))
    return sets.select("id", "n", "k").join(counts, "k", "left").select(
        F.col("id").alias(id_column), F.col("n").alias("n_shingles"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


def jaccard_groups(docs, text="text", id_column="doc_id", page=PAGE):
    """id, h, n and component of every row of ``docs``, where h is the text's hash and component a number that rows of one
    component share, null for empty sets. Links within a settled component are not looked for."""
    return _groups(docs, text, id_column, page).select("id", "h", "n", F.col("root").alias("component"))


def _groups(docs, text, id_column, page):
    rows, sets, classes, stars = blocks_of(docs, text, id_column)
    pairs = gathered(stars.select(F.col("low").alias("a"), F.col("k").alias("b")).distinct(), "pairs")
    near = gathered(bounded(ordered(pairs), classes), "near")
    links = gathered(verified(near, rows, classes), "star-links")
    roots = gathered(connected(links), "roots")

    # First the best partners, which joins most of what belongs together, then all pairs that are left.
    asked, whole = ordered(pairs), roots
    for nearest in (True, False):
        found = gathered(open_pairs(stars, pairs, whole, classes, page, nearest).join(asked, ["a", "b"], "left_anti"), "tree-pairs")
        if found.isEmpty():
            continue
        more = verified(found, rows, classes)
        whole = gathered(connected(more.unionByName(whole.select(F.col("node").alias("a"), F.col("root").alias("b")))), "roots")
        asked = gathered(asked.unionByName(found), "asked")
    whole = gathered(classes.join(whole.withColumnRenamed("node", "k"), "k", "left")
                     .select("k", "first", F.coalesce("root", "k").alias("root")), "component-roots")
    lowest = whole.groupBy("root").agg(F.min("first").alias("lowest"))
    return sets.select("id", "h", "n", "k").join(whole.join(lowest, "root").select("k", "root", "lowest"), "k", "left")


def jaccard_components(docs, text="text", id_column="doc_id", page=PAGE):
    """id, n_shingles and component_id of every row of ``docs``; links within a settled component are not looked for."""
    return _groups(docs, text, id_column, page).select(
        F.col("id").alias(id_column), F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("lowest")).otherwise(F.col("id")).alias("component_id"))
