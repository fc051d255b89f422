"""Line files as a stream of byte ranges.

Spark's file source admits whole files, so one huge file is one batch, and a failure repeats all of it. This
source admits bytes: its offset is (file, byte), a batch ends anywhere inside a file, and a stopped stream goes on at
that byte. Nothing is landed or copied first.

A range holds the lines that begin in it; the last of them is read to its end, beyond the range if need be. So a line
on a cut belongs to one batch and one task, and every line to some. Lines end with a line feed, or a carriage return and
a line feed. Tasks read their ranges in blocks; only a line longer than a block takes more memory.

The files get numbers in the order in which they are found: by age, then by name. The numbers are kept in an index folder, which
belongs to one stream as its checkpoint does, and so is the offset admitted last, before Spark sees it. After a restart the source
goes on from there; Spark itself hands it every unfinished batch by its offsets. An index that
knows less than the checkpoint is refused, so a lost index cannot repeat or skip lines.

Files must not change once they are there; a file that is still written needs a name that starts with "_" or "." until then.
Paths are those of pyarrow: local and shared folders, hdfs://, s3://, gs://. The driver lists the files and keeps their
names and sizes; it reads none of them.
"""

import json
import sys
import time
import uuid
from bisect import bisect_right
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from ..streaming.pacing import Pacer

# The classes travel by value, so neither the driver's planner nor the executors need a copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NAME = "line_ranges"
BYTES_PER_BATCH = 1 << 30
BYTES_PER_TASK = 1 << 27
BLOCK = 1 << 22       # bytes read at a time
TAIL_BLOCK = 1 << 16  # and behind the range's end, for its last line


class IndexLost(RuntimeError):
    """The index folder knows less than the checkpoint."""


# ---- files ----

def locate(path):
    """(file system, path in it) of a path or URI."""
    if path.startswith("file:"):
        path = "file:///" + path[len("file:"):].lstrip("/")
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


class FileIndex:
    """The numbered files of a stream, and the offset admitted last.

    ``ends[i]`` is where file i ends if all files are laid end to end.
    """

    def __init__(self, folder):
        self.store, self.folder = locate(folder)
        self.store.create_dir(self.folder, recursive=True)
        self.paths, self.ends, self.admitted = [], [], None
        found = self.store.get_file_info(fs.FileSelector(self.folder))
        for info in sorted((i for i in found if i.base_name.startswith("files-") and i.extension == "json"), key=lambda i: i.base_name):
            self._add(json.loads(self._read(info.path)))
        offsets = sorted(i.path for i in found if i.base_name.startswith("admitted-") and i.extension == "json")
        if offsets:
            self.admitted = json.loads(self._read(offsets[-1]))
        self.saved, self.old = len(offsets) and int(offsets[-1].rpartition("-")[2][:-5]), offsets
        self.known = set(self.paths)

    def _read(self, path):
        with self.store.open_input_stream(path) as file:
            return file.read()

    def _write(self, name, value):
        # Whole or not at all.
        path, draft = f"{self.folder}/{name}.json", f"{self.folder}/_{uuid.uuid4().hex}"
        with self.store.open_output_stream(draft) as file:
            file.write(json.dumps(value).encode())
        self.store.move(draft, path)
        return path

    def _add(self, files):
        for path, size in files:
            self.paths.append(path)
            self.ends.append((self.ends[-1] if self.ends else 0) + size)

    def discover(self, store, path):
        """Number the files that are new below ``path``."""
        top = store.get_file_info(path)
        if top.type == fs.FileType.NotFound:
            raise FileNotFoundError(path)
        found = [top] if top.is_file else store.get_file_info(fs.FileSelector(path, recursive=True))
        new = [(i.mtime_ns or 0, i.path, i.size) for i in found if i.is_file and i.size and i.path not in self.known
               and not any(part[:1] in "_." for part in i.path[len(path):].split("/") if part)]
        if new:
            files = [(name, size) for _, name, size in sorted(new)]
            self._write(f"files-{len(self.paths):015d}", files)
            self._add(files)
            self.known.update(name for name, _ in files)

    def admit(self, offset, size):
        """Keep the offset, and the size of the batch that it ends, before it is given away."""
        self.admitted = {"offset": offset, "size": size}
        self.saved += 1
        self.old.append(self._write(f"admitted-{self.saved:015d}", self.admitted))
        while len(self.old) > 2:
            self.store.delete_file(self.old.pop(0))

    @property
    def total(self):
        return self.ends[-1] if self.ends else 0

    def position(self, offset):
        """Bytes before an offset."""
        number, byte = offset["file"], offset["byte"]
        if number > len(self.ends) or (byte and number == len(self.ends)):
            raise IndexLost(f"the offset is in file {number}, but {self.folder} has {len(self.ends)}: "
                            "was the index folder lost, or is it another stream's?")
        return (self.ends[number - 1] if number else 0) + byte

    def offset(self, position):
        number = bisect_right(self.ends, position)
        return {"file": number, "byte": position - (self.ends[number - 1] if number else 0)}

    def ranges(self, begin, end, most):
        """(path, begin, end) of all parts between two positions, none longer than ``most``."""
        number = bisect_right(self.ends, begin)
        while begin < end:
            base = self.ends[number - 1] if number else 0
            stop = min(end, self.ends[number], begin + most)
            yield self.paths[number], begin - base, stop - base
            begin = stop
            number += begin == self.ends[number]


# ---- lines ----

def column_of_lines(data, finished=True):
    """The lines in ``data``, without their ends, as an Arrow column. Bytes that are not UTF-8 stay as they are."""
    found = np.frombuffer(data, dtype=np.uint8)
    ends = np.flatnonzero(found == 10)
    if not finished:
        ends = np.append(ends, len(found))
    starts = np.concatenate([[0], ends[:-1] + 1])
    returns = (ends > starts) & (found[np.maximum(ends - 1, 0)] == 13)
    if not finished:
        returns[-1] = False
    kept = found != 10
    kept[ends[returns] - 1] = False
    offsets = np.concatenate([[0], np.cumsum(ends - starts - returns)]).astype(np.int32)
    return pa.Array.from_buffers(pa.string(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(found[kept])])


def _behind_line_feed(file, at):
    """Where the first line begins whose line feed before it is at ``at`` or later; None if there is none."""
    file.seek(at)
    while data := file.read(TAIL_BLOCK):
        found = data.find(b"\n")
        if found >= 0:
            return at + found + 1
        at += len(data)
    return None


def lines_between(file, begin, end, block=BLOCK):
    """Columns of the lines of an open file that begin at ``begin`` or later and before ``end``."""
    # The byte before the range tells whether a line begins with it.
    at = _behind_line_feed(file, begin - 1) if begin else 0
    if at is None or at >= end:
        return
    file.seek(at)
    read, open_line = at, []
    while at < end:
        data = file.read(min(block, end - read) if read < end else TAIL_BLOCK)
        read += len(data)
        if not data:
            if open_line:
                yield column_of_lines(b"".join(open_line), finished=False)
            return
        last = data.rfind(b"\n") + 1
        if not last:
            open_line.append(data)
            continue
        whole = b"".join([*open_line, data[:last]])
        open_line = [data[last:]] if last < len(data) else []
        if at + len(whole) > end:
            # Lines that begin behind the range are another's.
            whole = whole[:whole.find(b"\n", end - at - 1) + 1]
            yield column_of_lines(whole)
            return
        yield column_of_lines(whole)
        at += len(whole)


# ---- Spark ----

class Ranges(InputPartition):
    """What a task reads: (path, begin, end) for each of its ranges."""


class LineRangesReader(DataSourceStreamReader):
    """Spark makes several of these; only the one that is asked for offsets opens the index."""

    def __init__(self, options, clock=time.monotonic):
        self.options, self.clock = dict(options.items()), clock
        self.index = self.pacer = self.current = self.under_way = None

    def _open(self):
        if self.index is not None:
            return
        option = lambda name, default=None, kind=int: kind(self.options[name]) if name in self.options else default
        self.store, self.path = locate(self.options["path"])
        self.per_task = option("bytespertask", BYTES_PER_TASK)
        index = FileIndex(self.options["index"])
        index.discover(self.store, self.path)
        target = option("targetseconds", kind=float)
        size = index.admitted["size"] if index.admitted and target else 0
        self.pacer = Pacer(option("bytesperbatch", BYTES_PER_BATCH), target, option("leastbytes", 1), option("mostbytes"), size)
        self.current = index.admitted["offset"] if index.admitted else None
        self.index = index

    def initialOffset(self):
        return {"file": 0, "byte": 0}

    def latestOffset(self):
        """The end of the next batch; Spark asks again when that batch is finished."""
        now = self.clock()
        self._open()
        if self.under_way:
            amount, since = self.under_way
            self.pacer.finished(amount, now - since)
            self.under_way = None
        self.index.discover(self.store, self.path)
        current = self.current or self.initialOffset()
        begin = self.index.position(current)
        end = min(begin + self.pacer.size, self.index.total)
        if end > begin:
            current = self.index.offset(end)
            self.index.admit(current, self.pacer.size)
            self.under_way = end - begin, now
        self.current = current
        return current

    def partitions(self, start, end):
        self._open()
        begin, stop = self.index.position(start), self.index.position(end)
        if stop < begin:
            raise IndexLost(f"the batch would run from {start} back to {end}: was the index folder lost?")
        if self.current is None or self.index.position(self.current) < stop:
            self.current = end
        parts, size = [[]], 0
        for path, first, last in self.index.ranges(begin, stop, self.per_task):
            if size and size + last - first > self.per_task:
                parts.append([])
                size = 0
            parts[-1].append((path, first, last))
            size += last - first
        return [Ranges(part) for part in parts]

    def read(self, partition):
        store, _ = locate(self.options["path"])
        for path, begin, end in partition.value:
            with store.open_input_file(path) as file:
                for lines in lines_between(file, begin, end):
                    yield pa.RecordBatch.from_arrays([lines], names=["value"])


class LineRanges(DataSource):
    @classmethod
    def name(cls):
        return NAME

    def schema(self):
        return "value string"

    def streamReader(self, schema):
        return LineRangesReader(self.options)


def total_bytes(path):
    """Bytes of the files that a stream over ``path`` would read now."""
    store, place = locate(path)
    return sum(i.size for i in store.get_file_info(fs.FileSelector(place, recursive=True)) if i.is_file and not i.base_name[:1] in "_.")


def stream_ranges(spark, path, index, bytes_per_batch=None, bytes_per_task=None, target_s=None,
                  least_bytes=None, most_bytes=None):
    """The lines of the file or folder ``path`` as a stream; ``index`` is a folder of the stream's own.

    A batch admits ``bytes_per_batch``. With ``target_s`` that is the first batch only: each next one gets as many
    bytes as make it last that long, judged by the last ones, within ``least_bytes`` and ``most_bytes``. Do not
    combine it with a longer trigger interval, whose idle time would count.
    Read it with the usual triggers; "available now" would end after one batch, so use ``sinks.finish`` instead.
    """
    options = {"path": path, "index": index, "bytesPerBatch": bytes_per_batch, "bytesPerTask": bytes_per_task,
               "targetSeconds": target_s, "leastBytes": least_bytes, "mostBytes": most_bytes}
    store, place = locate(path)
    if store.get_file_info(place).type == fs.FileType.NotFound:
        raise FileNotFoundError(path)  # at once, instead of when the stream has started
    spark.dataSource.register(LineRanges)
    return spark.readStream.format(NAME).options(**{k: str(v) for k, v in options.items() if v is not None}).load()
