"""Fill-in-the-middle by displacement scatter.

A text is cut into prefix, middle and suffix, and rearranged, so that a model that reads from left to
right learns to write what stands in the middle:

    plain   the text as it is
    psm     <P>prefix<S>suffix<M>middle
    spm     <S>suffix<P>prefix<M>middle

Cuts fall between units: runs of the letters A to Z, and single other characters. A scan marks
the bytes where units begin. All texts of an Arrow batch lie in one buffer, and each of its bytes moves by a shift that
changes only where a piece begins; so the changes are written into a difference array, its cumulative sum is
the shift of every byte, and one scatter builds all outputs. Restoring finds the marks in the outputs and gathers the bytes
back in the same way; it sees the output and its form only.

Cuts and forms come from a hash of the seed and the row's id, so they are the same in every run. Rows are independent:
nothing is shuffled or kept between batches. Buffers are treated ``WINDOW`` bytes at a time, so a text of any length
takes a few times its own size.

Special cases: a null text counts as empty; an empty text, and one that holds a mark, is plain. A null id is hashed as an empty
one. Repeated ids get equal hashes, and equal rows equal outputs. Both functions give a column, so other columns
are carried along by whoever selects them; an empty table stays empty.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

# Fixed values of the format.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
ORDERS = {PSM: (PREFIX, SUFFIX, MIDDLE), SPM: (SUFFIX, PREFIX, MIDDLE)}

MARK = 3             # bytes of a mark
WINDOW = 1 << 20     # bytes treated at a time
SLICE = 1 << 22      # bytes of the texts treated together; a longer text stands alone
PLAIN_FROM = 90      # of 100 hash values, those from here on leave the text plain
SPM_BELOW = 20       # of 100 hash values, those below give spm

LETTER = np.array([chr(c).isascii() and chr(c).isalpha() for c in range(256)])
MADE = "n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"


# ---- buffers ----

def buffer_of(column):
    """(bytes, where each value begins, and the end) of a string or binary column without nulls."""
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def column_of(data, offsets):
    """The string column of such a buffer."""
    return pa.Array.from_buffers(pa.string(), len(offsets) - 1,
                                 [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)])


def slices(offsets):
    """Ranges of texts of about ``SLICE`` bytes."""
    first = 0
    if len(offsets) == 1:
        yield 0, 0
    while first < len(offsets) - 1:
        last = int(np.searchsorted(offsets, offsets[first] + SLICE, side="right")) - 1
        last = max(last, first + 1)
        yield first, last
        first = last


def windows(size):
    return range(0, size + 1, WINDOW)


def before(marked, places):
    """How many bytes are marked before each of the sorted ``places``."""
    counts, total = np.zeros(len(places), dtype=np.int64), 0
    for at in windows(len(marked)):
        upto = np.concatenate([[0], np.cumsum(marked[at:at + WINDOW], dtype=np.int64)])
        a, b = np.searchsorted(places, [at, at + WINDOW])
        counts[a:b] = total + upto[places[a:b] - at]
        total += upto[-1]
    return counts


def nth(marked, ranks):
    """The place of the marked byte of each of the sorted ``ranks`` (from 0); the end for those beyond the last."""
    places, total = np.full(len(ranks), len(marked), dtype=np.int64), 0
    for at in windows(len(marked)):
        here = np.flatnonzero(marked[at:at + WINDOW])
        a, b = np.searchsorted(ranks, [total, total + len(here)])
        places[a:b] = at + here[ranks[a:b] - total]
        total += len(here)
    return places


def beginnings(data, starts):
    """Masks of the bytes where a unit begins, and where a character begins."""
    unit, char = np.empty(len(data), dtype=bool), np.empty(len(data), dtype=bool)
    for at in windows(len(data)):
        part = data[at:at + WINDOW]
        if not len(part):
            break
        letter = LETTER[part]
        char[at:at + WINDOW] = (part & 0xC0) != 0x80
        after = np.empty(len(part), dtype=bool)     # a letter stands before
        after[0] = at > 0 and LETTER[data[at - 1]]
        after[1:] = letter[:-1]
        unit[at:at + WINDOW] = np.where(letter, ~after, char[at:at + WINDOW])
    unit[starts[starts < len(data)]] = True
    return unit, char


def marks_in(data, offsets):
    """(place, letter, text) of every mark that lies within one text."""
    found = []
    for at in windows(len(data)):
        place = at + np.flatnonzero(data[at:at + WINDOW] == PREFIX[0])
        place = place[place + MARK <= len(data)]
        letter = data[place + 1]
        whole = (data[place + 2] == PREFIX[2]) & np.isin(letter, [mark[1] for mark in (PREFIX, SUFFIX, MIDDLE)])
        found.append(place[whole])
    place = np.concatenate(found)
    text = np.searchsorted(offsets, place, side="right") - 1
    within = place + MARK <= offsets[text + 1]
    return place[within], data[place[within] + 1], text[within]


def shifts(places, values, size):
    """The shift of each of ``size`` bytes, a window at a time: ``values[i]`` holds from the sorted ``places[i]`` on."""
    change, last = np.diff(values, prepend=0), 0
    for at in range(0, size, WINDOW):
        difference = np.zeros(min(WINDOW, size - at), dtype=np.int64)
        a, b = np.searchsorted(places, [at, at + len(difference)])
        np.add.at(difference, places[a:b] - at, change[a:b])  # empty pieces share a place
        shift = last + np.cumsum(difference)
        last = shift[-1]
        yield at, shift


# ---- cutting and joining ----

def cut_texts(data, offsets, hashes):
    """Units, form, cuts (bytes and characters), and the outputs, of the texts of a buffer.

    ``hashes`` are the four numbers of each text.
    """
    starts, ends = offsets[:-1], offsets[1:]
    unit, char = beginnings(data, starts)
    upto = before(unit, offsets)
    n = np.diff(upto)
    one, two = hashes[0] % (n + 1), hashes[1] % (n + 1)
    # A cut behind a text's last unit is the first unit of what follows, which begins where the text ends.
    ranks = upto[:-1, None] + np.stack([np.minimum(one, two), np.maximum(one, two)], axis=1)
    low, high = nth(unit, ranks.ravel()).reshape(-1, 2).T
    chars = before(char, np.stack([starts, low, high], axis=1).ravel()).reshape(-1, 3)

    plain = (n == 0) | (hashes[2] % 100 >= PLAIN_FROM)
    plain[marks_in(data, offsets)[2]] = True
    suffix_first = ~plain & (hashes[3] % 100 < SPM_BELOW)
    grown = np.where(plain, 0, 3 * MARK)
    out = offsets + np.concatenate([[0], np.cumsum(grown)])

    base, prefix, suffix = out[:-1], low - starts, ends - high
    first = base + MARK                                     # after the first mark
    second = first + np.where(suffix_first, suffix, prefix) + MARK
    third = base + 3 * MARK + prefix + suffix
    shift = np.stack([np.where(suffix_first, second, first) - starts, third - low,
                      np.where(suffix_first, first, second) - high], axis=1)
    shift[plain] = (base - starts)[plain, None]
    output = np.empty(out[-1], dtype=np.uint8)
    for at, moved in shifts(np.stack([starts, low, high], axis=1).ravel(), shift.ravel(), len(data)):
        output[np.arange(at, at + len(moved)) + moved] = data[at:at + len(moved)]
    marks = np.array([[list(mark) for mark in ORDERS[form]] for form in (PSM, SPM)], dtype=np.uint8)
    for i, place in enumerate((first - MARK, second - MARK, third - MARK)):
        output[place[~plain, None] + np.arange(MARK)] = marks[suffix_first[~plain].astype(int), i]

    form = np.where(plain, PLAIN, np.where(suffix_first, SPM, PSM))
    return pa.StructArray.from_arrays(
        [pa.array(n), pa.array(form, type=pa.string()), pa.array(chars[:, 1] - chars[:, 0], mask=plain),
         pa.array(chars[:, 2] - chars[:, 1], mask=plain), column_of(output, out)],
        names=["n", "form", "prefix_chars", "middle_chars", "output"])


def join_texts(data, offsets, forms):
    """The texts that were cut, from outputs and forms."""
    starts, ends = offsets[:-1], offsets[1:]
    plain, suffix_first = forms == PLAIN, forms == SPM
    if not (plain | suffix_first | (forms == PSM)).all():
        raise ValueError("a form is plain, psm or spm")
    place, letter, text = marks_in(data, offsets)
    cut = ~plain[text]
    place, letter, text = place[cut], letter[cut], text[cut]
    wanted = np.array([[mark[1] for mark in ORDERS[form]] for form in (PSM, SPM)], dtype=np.uint8)
    order = wanted[suffix_first[~plain].astype(int)].ravel()
    if not (np.array_equal(text, np.repeat(np.flatnonzero(~plain), 3)) and np.array_equal(letter, order)):
        raise ValueError("a text that is not plain has each mark once, in the order of its form")
    where = np.repeat(starts[:, None], 3, axis=1)
    where[~plain] = place.reshape(-1, 3)

    out = offsets - np.concatenate([[0], np.cumsum(np.where(plain, 0, 3 * MARK))])
    first, second, third = (where + MARK).T
    one, two, three = where[:, 1] - first, where[:, 2] - second, ends - third   # the pieces' sizes
    prefix = np.where(suffix_first, two, one)
    begin = np.stack([out[:-1], out[:-1] + prefix, out[:-1] + prefix + three], axis=1)
    shift = np.stack([np.where(suffix_first, second, first), third, np.where(suffix_first, first, second)], axis=1) - begin
    begin[plain], shift[plain] = out[:-1][plain, None], (starts - out[:-1])[plain, None]
    restored = np.empty(out[-1], dtype=np.uint8)
    for at, moved in shifts(begin.ravel(), shift.ravel(), len(restored)):
        restored[at:at + len(moved)] = data[np.arange(at, at + len(moved)) + moved]
    return column_of(restored, out)


# ---- columns ----

def fill_middle(text="text", id_column="doc_id", seed=1):
    """The struct (n, form, prefix_chars, middle_chars, output) of a text column: the number of units, the form,
    the characters of prefix and middle (null if plain), and the rearranged text."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_column).cast("string"), F.lit(""))).cast("binary"), 256)
    hashes = [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("bigint") for i in range(4)]

    @F.arrow_udf(MADE)
    def made(text: pa.Array, h1: pa.Array, h2: pa.Array, h3: pa.Array, h4: pa.Array) -> pa.Array:
        data, offsets = buffer_of(text)
        numbers = np.stack([h.to_numpy() for h in (h1, h2, h3, h4)])
        return pa.concat_arrays(
            [cut_texts(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], numbers[:, a:b]) for a, b in slices(offsets)])

    return made(F.coalesce(F.col(text), F.lit("")), *hashes)


def restore(output="output", form="form"):
    """The text that was cut, from its output and form (columns or their names); a null form counts as plain."""
    @F.arrow_udf("string")
    def restored(output: pa.Array, form: pa.Array) -> pa.Array:
        data, offsets = buffer_of(output)
        forms = np.array(form.to_pylist(), dtype=object)
        return pa.concat_arrays(
            [join_texts(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], forms[a:b]) for a, b in slices(offsets)])

    return restored(F.coalesce(output, F.lit("")), F.coalesce(form, F.lit(PLAIN)))
