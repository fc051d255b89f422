"""Line files: one message per line."""

from pyspark.sql import functions as F

from ..functions.records import is_json
from ..functions.text import strip


def read_lines(spark, path):
    """Batch scan, one row per line. A missing path raises at once.

    Files are split by byte range, so one huge file still reads in parallel.
    """
    return spark.read.text(path)


def read_json_lines(spark, path):
    """Batch scan that skips the lines which are not JSON."""
    return drop_bad_lines(read_lines(spark, path))


def strip_lines(lines):
    return lines.select(strip(lines["value"]).alias("value"))


def drop_bad_lines(lines):
    # Not filter(): Spark would push it below the step that makes the line, and
    # run that step again for each mention of it.
    return lines.select(F.inline(F.when(is_json(lines["value"]), F.array(F.struct("value")))))


#: Files of any age are read: Spark skips files older than this, seen from the newest.
NO_FILE_TOO_OLD = {"maxFileAge": "36500d"}


def stream_lines(spark, path, files_per_trigger=None, bytes_per_trigger=None, glob=None,
                 line_sep=None, archive_dir=None):
    """Line files as a stream. ``path`` is a folder or a pattern.

    A file is admitted whole, so a batch is bounded by a number of files or of
    bytes, not both. Give ``glob`` to pick files within a folder. Lines end at
    any of the usual line ends unless ``line_sep`` names one. A file counts whatever
    its time stamp. Spark remembers each file it has read, so give a long-lived stream an
    ``archive_dir`` to which finished files are moved, or dated folders to read from.
    """
    if files_per_trigger and bytes_per_trigger:
        raise ValueError("bound a batch by files or by bytes, not by both")
    read_lines(spark, path)  # a missing folder raises here instead of idling for ever
    reader = spark.readStream.options(**NO_FILE_TOO_OLD)
    if archive_dir:
        reader = reader.options(cleanSource="archive", sourceArchiveDir=archive_dir)
    if line_sep:
        reader = reader.option("lineSep", line_sep)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(files_per_trigger))
    if bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", int(bytes_per_trigger))
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.text(path)
